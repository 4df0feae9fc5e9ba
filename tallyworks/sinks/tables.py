"""Replace tables and CSV exports; optional JDBC target."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tallyworks.session import PARQUET_CODEC, underfills_cores

# Writers that a database is asked to take at once, unless the caller says otherwise.
JDBC_WRITERS = 32
JDBC_BATCH_ROWS = 10_000

#: Partitions that one task writes at once: as many files as Spark's scan gives it by default.
OPEN_PARTITIONS = 32


@contextmanager
def partitions_at_once(spark: SparkSession) -> Iterator[None]:
    """Write rows to their partitions as they come, instead of sorting whole rows by partition first.

    For rows that lie by partition already, so that a task meets few. One that meets more than
    ``OPEN_PARTITIONS`` sorts the rest of its rows. The setting is the session's while it holds.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(OPEN_PARTITIONS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def gathered(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Few key values per task, so that a task writes few files.

    Adaptive execution splits a value that is too large for one task. It would
    also merge a small table into one task, which a fixed count prevents.
    """
    if underfills_cores(frame):
        return frame.repartition(frame.sparkSession.sparkContext.defaultParallelism, *keys)
    return frame.hint("rebalance", *keys)


def write_table(
    frame: DataFrame,
    root: str,
    name: str,
    partition_by: Sequence[str] = (),
    is_gathered: bool = False,
) -> DataFrame:
    """Replace the parquet table ``name`` under ``root`` and return a reader of it.

    Rows of a partitioned table are brought together by its partition values, unless they were
    when they were narrower.
    """
    path = f"{root.rstrip('/')}/{name}"
    rows = gathered(frame, partition_by) if partition_by and not is_gathered else frame
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression=PARQUET_CODEC)
    return frame.sparkSession.read.schema(frame.schema).parquet(path).select(frame.columns)


def replace_partitions(
    frame: DataFrame,
    root: str,
    name: str,
    partition_by: Sequence[str],
    is_gathered: bool = False,
) -> DataFrame:
    """Replace only the partitions of the table ``name`` that ``frame`` has rows for.

    ``frame`` may read the table: Spark stages the new files and replaces the old ones at the end.
    """
    path = f"{root.rstrip('/')}/{name}"
    rows = frame if is_gathered else gathered(frame, partition_by)
    writer = rows.write.mode("overwrite")
    with partitions_at_once(frame.sparkSession):
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(
            path, compression=PARQUET_CODEC
        )
    return frame.sparkSession.read.schema(frame.schema).parquet(path).select(frame.columns)


def write_bucketed(frame: DataFrame, root: str, name: str, key: str, buckets: int) -> DataFrame:
    """Store ``frame`` as a catalog table in ``buckets`` files by ``key``, sorted, and return it.

    Tables with the same key and number of buckets join on it without an exchange. Rows of one key
    lie in one bucket: where a key is hot, use the salted lookup instead.
    """
    spark = frame.sparkSession
    path = f"{root.rstrip('/')}/{name}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dealt = frame.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return spark.table(name)


def write_csv(frame: DataFrame, root: str, name: str, compression: str = "none") -> str:
    """Replace the CSV export ``name``; adaptive execution sizes the part files.

    A file compressed with e.g. ``gzip`` takes a third of the bytes and is read by one task.
    """
    path = f"{root.rstrip('/')}/{name}"
    writer = frame.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.csv(path, compression=compression)
    return path


def jdbc_options(url: str, table: str, writers: int = JDBC_WRITERS, **properties: str) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "numPartitions": str(writers),
        "batchsize": str(JDBC_BATCH_ROWS),
        # keep the table and its grants, replace the rows
        "truncate": "true",
        **properties,
    }


def write_jdbc(
    frame: DataFrame, url: str, table: str, writers: int = JDBC_WRITERS, **properties: str
) -> None:
    """Replace a database table, e.g. ``jdbc:postgresql://host/sales``."""
    options = jdbc_options(url, table, writers, **properties)
    frame.write.format("jdbc").mode("overwrite").options(**options).save()
