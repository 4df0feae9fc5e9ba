"""Business keys: a prefix and a number padded with zeros."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefix and least digits of each kind of key.
FORMATS = {"customer": "CUST%05d", "product": "PROD%04d", "transaction": "TXN%07d"}


def business_key(kind: str, number: str) -> Column:
    return F.format_string(FORMATS[kind], number)
