"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets AQE split a hot join partition even when that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app_name: str = "tallyworks", cores: int | None = None, **settings: str) -> SparkSession:
    """Build a session; ``cores`` selects local mode, else the submit master is used.

    On a cluster leave ``spark.sql.shuffle.partitions`` to the submit command:
    AQE merges small partitions, so size it for the largest shuffle.
    """
    builder = SparkSession.builder.appName(app_name)
    if cores is not None:
        builder = builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", str(cores))
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bytes_setting(spark: SparkSession, key: str) -> int:
    """A size setting such as ``10MB`` in bytes."""
    setting = spark.conf.get(key).strip().lower()
    digits = setting.rstrip("bkmgti")
    unit = setting[len(digits) :].rstrip("ib") or "b"
    return int(digits) * {"b": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}[unit]


def input_bytes(frame: DataFrame) -> int:
    """Bytes of all inputs of ``frame``, from the optimizer's own statistics."""
    leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.length()))


def splits(frame: DataFrame) -> int:
    """How many full splits the inputs of ``frame`` amount to, but at least one for every core.

    Rows that are in no file count as more bytes than there can be.
    """
    spark = frame.sparkSession
    split = bytes_setting(spark, "spark.sql.files.maxPartitionBytes")
    return max(spark.sparkContext.defaultParallelism, -(-input_bytes(frame) // split))


def underfills_cores(frame: DataFrame) -> bool:
    """Whether the inputs of ``frame`` amount to less than one full split per core."""
    spark = frame.sparkSession
    split = bytes_setting(spark, "spark.sql.files.maxPartitionBytes")
    return input_bytes(frame) < spark.sparkContext.defaultParallelism * split


def concurrently(
    spark: SparkSession, actions: dict[str, Callable[[], Result]]
) -> dict[str, Result]:
    """Submit independent Spark actions together, so one's last tasks overlap the next."""
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(action))
            for name, action in actions.items()
        }
        return {name: future.result() for name, future in running.items()}


#: The folder of the run in progress, if one set it up.
RUN_SCRATCH: ContextVar[str | None] = ContextVar("RUN_SCRATCH", default=None)


@contextmanager
def scratch_below(spark: SparkSession, target: str) -> Iterator[str]:
    """Keep settled copies below ``target`` and remove them at the end, also after a failure."""
    root = f"{target.rstrip('/')}/_scratch-{uuid.uuid4().hex}"
    token = RUN_SCRATCH.set(root)
    try:
        yield root
    finally:
        RUN_SCRATCH.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the run's own scratch folder, else in ``spark.checkpoint.dir``.

    Every executor must reach it. In local mode, where neither is set, the warehouse folder serves;
    on a cluster it may lie on one machine, so there the setting is asked for.
    """
    root = RUN_SCRATCH.get() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: How stored tables and settled copies are compressed: a third smaller than with Spark's default.
PARQUET_CODEC = "zstd"


def settle(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` once to shared storage and return a reader of the copy.

    Several later jobs branch from it; the copy survives the loss of executors.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path, compression=PARQUET_CODEC)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
