"""Stored products: decoding, writing one run at a time, reading regions, listings and hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import content_hash, missing_as_null

PRODUCT = """
source string, init_date date, cycle int, variable string, pressure_level double, step_hours int,
valid_time timestamp_ntz, latitude double, longitude double, value double, extra_level double
"""
PARTITIONS = ["source", "init_date", "cycle"]
#: Files up to this size are hashed in the JVM from one read; larger ones are streamed in parts.
ONE_READ = 1 << 30


def load_fields(spark: SparkSession, path: str, decoder: Callable[[str, bytes], pd.DataFrame] | None = None, schema: str | None = None) -> DataFrame:
    """Decoded records: Parquet, or files of any format that ``decoder(path, content)`` turns into rows of ``schema``, a task a file split. Numbers that are NaN become null."""
    if decoder is None:
        return without_nan(spark.read.parquet(path))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                yield decoder(name, content)

    return without_nan(spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema))


def load_headers(spark: SparkSession, path: str, decoder: Callable[[str, bytes], pd.DataFrame], schema: str) -> DataFrame:
    """A row a message: what ``decoder(path, content)`` finds in the headers of a file, with the file's path. No field is decoded.

    ``schema`` names path, msg_no and whatever tells messages apart.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                yield decoder(name, content)

    return without_nan(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content").mapInPandas(run, schema))


def load_messages(wanted: DataFrame, decoder: Callable[[str, bytes, list[int]], pd.DataFrame], schema: str) -> DataFrame:
    """The cells of the messages ``wanted`` (path, msg_no), as ``decoder(path, content, numbers)`` gives them.

    Files without a wanted message are not opened, other messages not decoded.
    The paths of the files, not their messages, pass through the driver, as they
    do when a folder is listed.
    """
    spark = wanted.sparkSession
    numbers = wanted.groupBy("path").agg(F.sort_array(F.collect_set("msg_no")).alias("numbers"))  # the messages of one file
    paths = [r["path"] for r in numbers.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], schema)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content, of in zip(frame["path"], frame["content"], frame["numbers"], strict=True):
                yield decoder(name, content, list(of))

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return without_nan(files.join(F.broadcast(numbers), "path").mapInPandas(run, schema))  # a row a file


def without_nan(records: DataFrame) -> DataFrame:
    """records with null for NaN, which decoders use for what is missing."""
    return records.withColumns({c: missing_as_null(F.col(c)) for c, kind in records.dtypes if kind in ("double", "float")})


def write_product(product: DataFrame, root: str, codec: str = "zstd", level: int = 3) -> None:
    """Replace exactly the runs that ``product`` holds; other runs below root are not touched.

    Rows are sorted so that a region read of a variable meets few row groups;
    a task gets a band of a level, never a variable of a run whole.
    A product without extra_level has none.
    """
    product = product if "extra_level" in product.columns else product.withColumn("extra_level", F.lit(None).cast("double"))
    ready = product.select(*(f"`{f.split()[0]}`" for f in PRODUCT.replace("\n", " ").split(",")))
    dealt = ready.repartition(*PARTITIONS, "variable", "pressure_level", F.floor(F.col("latitude") / 4)).sortWithinPartitions(*PARTITIONS, "variable", "pressure_level", "latitude", "longitude", "step_hours")
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "uncompressed" if codec == "none" else codec)
    if codec == "zstd":
        writer = writer.option("parquet.compression.codec.zstd.level", str(level))
    writer.partitionBy(*PARTITIONS).parquet(root)


def read_product(spark: SparkSession, root: str) -> DataFrame:
    """A stored product; the schema is given, as folder names alone would turn cycle 00 into a number by chance."""
    return spark.read.schema(PRODUCT).parquet(root)


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, size_bytes, modified) of the files below root; contents are not read, and empty files have no row."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select(_below(root), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))


def file_hashes(spark: SparkSession, root: str, one_read: int = ONE_READ) -> DataFrame:
    """(path, size_bytes, h): the SHA-256 of every file below root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    small = files.filter(F.col("length") <= one_read).select(_below(root), F.col("length").alias("size_bytes"), content_hash(F.col("content")).alias("h"))
    large = files.filter(F.col("length") > one_read).select(F.col("path").alias("full"), _below(root), F.col("length").alias("size_bytes"))

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for frame in frames:
            hashes = []
            for name in frame["full"]:
                store, place = fs.FileSystem.from_uri(name)
                digest = hashlib.sha256()
                with store.open_input_stream(place) as f:
                    while part := f.read(1 << 24):
                        digest.update(part)
                hashes.append(digest.hexdigest())
            yield frame.assign(h=hashes)[["path", "size_bytes", "h"]]

    return small.unionByName(large.mapInPandas(stream, "path string, size_bytes long, h string"))


def _below(root: str) -> F.Column:
    """The path relative to root, whatever scheme and authority the file system puts before it."""
    tail = root.split("://", 1)[-1].rstrip("/") + "/"
    return F.substring("path", F.locate(tail, F.col("path")) + len(tail), F.length("path")).alias("path")
