"""Transactions, customers and products from CSV or parquet files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks import schemas

# Text that counts as a missing value in a CSV field.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def normalise_null_tokens(frame: DataFrame) -> DataFrame:
    """Turn null tokens in string columns, and NaN in doubles, into SQL nulls."""

    def known(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            column = F.when(~column.isin(NULL_TOKENS), column)
        elif isinstance(field.dataType, T.DoubleType):
            column = F.when(~F.isnan(column), column)
        return column.alias(field.name)

    return frame.select([known(field) for field in frame.schema.fields])


CORRUPT = "_corrupt_record"


def _header(spark: SparkSession, path: str, schema: T.StructType, multiline: bool) -> list[str]:
    """The file's columns in their own order; all declared ones must be among them."""
    found = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    names = [name.strip() for name in found.csv(path).columns]
    if missing := [name for name in schema.fieldNames() if name not in names]:
        raise ValueError(f"{path}: the header lacks the columns {', '.join(missing)}")
    return names


def _text_rows(spark: SparkSession, path: str, schema: T.StructType, multiline: bool) -> DataFrame:
    """All fields as text, null tokens as nulls; lines of another shape in CORRUPT.

    Columns go by the name in the header, whatever their order; others are left out.
    """
    header = _header(spark, path, schema, multiline)
    fields = [T.StructField(name, T.StringType()) for name in [*header, CORRUPT]]
    return (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        # quotes inside a field are doubled
        .option("escape", '"')
        .option("multiLine", multiline)
        # a part file whose header differs from the first fails instead of shifting columns
        .option("enforceSchema", False)
        .csv(path)
        .select(*schema.fieldNames(), CORRUPT)
    )


def _typed(text: Column, kind: T.DataType) -> Column:
    """The text's value, or null if it has none of this type."""
    if isinstance(kind, T.DateType):  # with or without a time part
        return text.try_cast("timestamp").cast("date")
    if isinstance(kind, T.IntegerType):  # also 3.0, but not 3.5
        number = text.try_cast("decimal(20,4)")
        return F.when(number == F.floor(number), number.try_cast(kind))
    if isinstance(kind, T.DoubleType):
        return text.try_cast("double")
    return text.try_cast(kind)


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """Typed rows of a CSV with the text of each, and what is wrong with it.

    With ``multiline``, quoted fields may hold line breaks; then a file is one split, so large
    inputs should come as many files. Without it, both halves of such a record have faults.

    ``faults`` names the columns whose text is neither a null token nor a value
    of the declared type, and CORRUPT for a line of another shape; ``source``
    holds the fields as read.
    """
    raw = _text_rows(spark, path, schema, multiline)
    known = normalise_null_tokens(raw)
    names = schema.fieldNames()
    faults = [
        F.when(
            F.col(field.name).isNotNull() & _typed(F.col(field.name), field.dataType).isNull(),
            F.lit(field.name),
        )
        for field in schema.fields
        if not isinstance(field.dataType, T.StringType)
    ]
    faults.append(F.when(F.col(CORRUPT).isNotNull(), F.lit(CORRUPT)))
    return known.select(
        *[
            (
                F.col(field.name)
                if isinstance(field.dataType, T.StringType)
                else _typed(F.col(field.name), field.dataType)
            ).alias(field.name)
            for field in schema.fields
        ],
        F.array_compact(F.array(*faults)).alias("faults"),
        F.struct(*names, CORRUPT).alias("source"),
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("faults") == 0).drop("faults", "source")


def quarantined(checked: DataFrame) -> DataFrame:
    """(faults, source) of the rows that ``accepted`` leaves out; nothing is lost in silence."""
    return checked.where(F.size("faults") > 0).select("faults", "source")


def _read(spark: SparkSession, path: str, schema: T.StructType, multiline: bool) -> DataFrame:
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.schema(schema).parquet(path)
    return accepted(read_checked(spark, path, schema, multiline))


def _quarantine(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool
) -> DataFrame | None:
    if path.rstrip("/").endswith(".parquet"):
        return None
    return quarantined(read_checked(spark, path, schema, multiline))


def quarantines(
    spark: SparkSession, transactions: str, customers: str, products: str, multiline: bool = False
) -> dict[str, DataFrame]:
    """Rows that the three readers refuse, by source; parquet files have declared types."""
    found = {
        "transactions": _quarantine(spark, transactions, schemas.TRANSACTIONS, multiline),
        "customers": _quarantine(spark, customers, schemas.CUSTOMERS, multiline),
        "products": _quarantine(spark, products, schemas.PRODUCTS, multiline),
    }
    return {name: rows for name, rows in found.items() if rows is not None}


def read_transactions(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return _read(spark, path, schemas.TRANSACTIONS, multiline)


def read_customers(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return _read(spark, path, schemas.CUSTOMERS, multiline)


def read_products(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return _read(spark, path, schemas.PRODUCTS, multiline)
