"""Reading the inputs and cutting lineage in the cluster's shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows of a partition of a small table.
ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. A session of one local machine may do without; then a temporary one serves."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="aerolith-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and read from the shared folder from then on."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def freed(spark: SparkSession) -> None:
    """Shuffle files of tables that nothing names any more leave the disks; Spark drops them when the driver's JVM collects, which else may be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which its Python worker, which waits for other tasks, gives back what it does not use."""

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # not a C library that can
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return out


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """df in as many partitions as so many rows need, if it has more."""
    return df.coalesce(max(1, -(-rows // ROWS)))
