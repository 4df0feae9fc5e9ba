"""Transactions, customers and products from order/line-item star tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions.rounding import as_double_ratio, half_even
from tallyworks.operators.enrich import with_customer
from tallyworks.operators.joins import is_small, lookup
from tallyworks.schemas import MONEY
from tallyworks.session import input_bytes

# How line items map to the ledger's vocabulary.
NO_CAMPAIGN = "4-NOT SPECIFIED"
RETURN_FLAG = "R"
PENDING_FLAG = "A"

# Stored bytes for every core from which on a scan has row groups enough for all cores.
SPREAD_BYTES = 16 * 2**20

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def spread_small_scan(frame: DataFrame, *keys: str) -> DataFrame:
    """Repartition an input that has few row groups for every core.

    Such an input may be a single row group that one task would read and process
    alone. Spark divides larger inputs among the cores by itself, without an extra shuffle.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores, *keys) if input_bytes(frame) < cores * SPREAD_BYTES else frame


def discount_amount(gross: Column, discount_pct: Column) -> Column:
    """price x quantity x percent / 100 in exact decimals, two places."""
    share = discount_pct.cast("decimal(5,0)") * F.lit("0.01").cast("decimal(3,2)")
    return F.round(gross * share, 2).cast(MONEY)


def status(is_returned: Column, is_pending: Column) -> Column:
    return F.when(is_returned, "Returned").when(is_pending, "Pending").otherwise("Completed")


def transaction_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def lines_as_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The columns that ``priced`` derives the sales from: half as wide as what it derives."""
    return read_table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("gross"),
        F.round(F.abs("l_discount") * 100).cast("int").alias("discount_pct"),
        "l_returnflag",
        "l_linestatus",
    )


def with_sale(lines: DataFrame) -> DataFrame:
    """``lines_as_stored``, or wider ones, and what a sale derives from them."""
    is_returned = F.col("l_returnflag") == RETURN_FLAG
    return lines.withColumn(
        "discount_amount", discount_amount(F.col("gross"), F.col("discount_pct"))
    ).withColumns(
        {
            "transaction_id": transaction_id(),
            "product_id": F.col("l_partkey"),
            "channel": F.col("l_linestatus"),
            "unit_price": half_even(as_double_ratio(F.col("gross"), F.col("quantity"))).cast(MONEY),
            "revenue": (F.col("gross") - F.col("discount_amount")).cast(MONEY),
            "is_returned": is_returned,
            "status": status(is_returned, F.col("l_returnflag") == PENDING_FLAG),
        }
    )


def priced(lines: DataFrame, *more: str) -> DataFrame:
    """``lines_as_stored`` with exact prices, and the columns ``more`` as they are."""
    return with_sale(lines).select(
        "l_orderkey",
        "transaction_id",
        "product_id",
        "channel",
        "quantity",
        "unit_price",
        "discount_pct",
        "discount_amount",
        "revenue",
        "is_returned",
        "status",
        *more,
    )


def spread_lines(spark: SparkSession, folder: str) -> DataFrame:
    return spread_small_scan(lines_as_stored(spark, folder), "l_orderkey", "l_partkey", "l_suppkey")


def priced_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with exact prices; one scan, no join."""
    return priced(spread_lines(spark, folder))


TRANSACTION_COLUMNS = [
    "transaction_id",
    "date",
    "customer_id",
    "product_id",
    "channel",
    "campaign",
    "quantity",
    "unit_price",
    "discount_pct",
    "discount_amount",
    "revenue",
    "is_returned",
    "status",
]


def order_facts(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_custkey").alias("customer_id"),
        F.nullif("o_orderpriority", F.lit(NO_CAMPAIGN)).alias("campaign"),
    )


def ordered_lines(
    spark: SparkSession, folder: str, orders: DataFrame, lines: DataFrame | None = None
) -> DataFrame:
    """Lines as stored with the columns of their order, and the ``salt`` they were dealt by.

    ``lines`` may be such lines that have been looked up already; what they have besides stays.
    """
    if lines is None:
        lines = (spread_lines if is_small(orders) else lines_as_stored)(spark, folder)
    return lookup(
        lines,
        orders,
        "l_orderkey",
        spread_by=[transaction_id()],
        keys_from=read_table(spark, folder, "lineitem"),
        keep_salt=True,
    )


def with_order(
    spark: SparkSession, folder: str, orders: DataFrame, lines: DataFrame | None = None
) -> DataFrame:
    """The same, dealt to their orders as stored and priced afterwards."""
    more = [] if lines is None else ["category", "cost_price"]
    joined = ordered_lines(spark, folder, orders, lines)
    return priced(joined, *[c for c in orders.columns if c != "l_orderkey"], *more, "salt")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item; ``cost`` and ``profit`` follow from the product lookup.

    The lookup keeps every line, so ``priced_lines`` alone has the same revenues.
    """
    return with_order(spark, folder, order_facts(spark, folder)).select(TRANSACTION_COLUMNS)


def keyed_transactions(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    """Transactions, and what they were dealt by when they met their orders.

    The id begins with the order's key and the salt follows from the id, so equal rows lie together
    already. Where a line lacks its order's key an id may begin with another number: then no
    columns are named.
    """
    lines = read_table(spark, folder, "lineitem")
    together = ["l_orderkey", "salt"] if lines.where("l_orderkey IS NULL").isEmpty() else []
    rows = with_order(spark, folder, order_facts(spark, folder))
    return rows.select(*TRANSACTION_COLUMNS, *together), together


def placed_lines(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """``ordered_lines`` with region, segment and city: ``with_sale`` makes transactions of them.

    Customers join the orders first, which are fewer and narrower than the lines.
    """
    orders = with_customer(
        order_facts(spark, folder), customers(spark, folder), spread_by=["l_orderkey"]
    )
    return ordered_lines(spark, folder, orders, lines)


def keyed_lines(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame | None:
    """``placed_lines`` that are equal if and only if their transactions are, to be collapsed.

    The id tells the line's keys unless one is null, and the two amounts tell the gross price unless
    the discount is unknown or beyond the whole price. Where a line is such, there is no result.
    """
    odd = (
        "l_orderkey IS NULL OR l_partkey IS NULL OR l_suppkey IS NULL OR l_linenumber IS NULL"
        " OR l_discount IS NULL OR l_discount < -1 OR l_discount > 1"
    )
    if not read_table(spark, folder, "lineitem").where(odd).isEmpty():
        return None
    flag = F.col("l_returnflag")
    # other flags mean the same
    known = F.when(flag.isin(RETURN_FLAG, PENDING_FLAG), flag).when(flag.isNotNull(), "")
    return placed_lines(spark, folder, lines).withColumn("l_returnflag", known)


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").alias("c_nationkey"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
    )
    people = read_table(spark, folder, "customer")
    return lookup(people, places, "c_nationkey", spread_by=["c_custkey"]).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        "city",
        "region",
        F.col("c_mktsegment").alias("segment"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(MONEY).alias("unit_price"),
        F.col("p_retailprice").cast(MONEY).alias("cost_price"),
    )
