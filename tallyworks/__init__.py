"""Retail revenue analytics expressed as Spark DataFrame plans."""
