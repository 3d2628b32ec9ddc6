"""Manifests as they arrive, and scans for what is due."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from ..operators.readiness import INIT, pending
from ..plans.history import publish
from ..plans.publication import publish_runs
from ..sources.manifests import MANIFEST, read_manifests, shaped
from ..sources.shared import exists
from ..sources.tile_store import Sizes, run_inventory

LEDGER = "manifest_path string, modified timestamp, batch long, status string, error string"
#: Manifests of one trigger.
A_TRIGGER = 256


def _stream(spark: SparkSession, root: str, source: str | None, most: int) -> DataFrame:
    reader = spark.readStream.schema(MANIFEST).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.manifest.json").option("maxFilesPerTrigger", most)
    return reader.json(f"{root}/{source}" if source else root).select("*", "_metadata")


def read_ledger(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What has been handled under a checkpoint: a row a manifest, done or failed."""
    path = f"{checkpoint}-ledger"
    return spark.read.schema(LEDGER).json(path) if exists(spark, path) else spark.createDataFrame([], LEDGER)


def _ledgered(spark: SparkSession, checkpoint: str, handle: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """A sink that hands on each manifest of a batch on its own and writes down what came of it.

    A batch that comes again after a crash finds in the ledger which of its
    manifests are through, and hands on the others only. An entry is one file,
    named by its manifest, written after the handler returned: the handler must
    bear to see the manifest again that it worked on when the driver died, as
    those of this module do. A batch is read once: its manifests, ``A_TRIGGER``
    at most, pass through the driver, which starts their jobs.
    """

    def batch(rows: DataFrame, number: int) -> None:
        arrived = rows.filter(F.col("schema_version").eqNullSafe(F.lit(1))).collect()
        through = {(r["manifest_path"], r["modified"]) for r in read_ledger(spark, checkpoint).filter(F.col("batch") == number).collect()} if arrived else set()
        for run in arrived:
            key = (run["_metadata"]["file_path"], run["_metadata"]["file_modification_time"])
            if key in through:
                continue
            status, error = "done", None
            try:
                handle(spark.createDataFrame([run], rows.schema))
            except Exception as failure:  # written down; the other runs and the watch go on
                status, error = "failed", str(failure)[:1000]
            entry = spark.createDataFrame([(*key, number, status, error)], LEDGER).coalesce(1)
            entry.write.mode("overwrite").json(f"{checkpoint}-ledger/batch={number}/{hashlib.sha256(repr(key).encode()).hexdigest()[:24]}")
            if status == "failed":
                name = lambda part: run[part] if part != "name" else run["source"] and run["source"]["name"]
                spark.createDataFrame([(name("name"), run["date"], run["cycle"], error)], "name string, date string, cycle int, error string").coalesce(1).write.mode("append").json(f"{checkpoint}-failed")

    return batch


def watch(spark: SparkSession, root: str, checkpoint: str, handle: Callable[[DataFrame], None], source: str | None = None, interval: str = "30 seconds", once: bool = False, seed: bool = False, late: bool = False, most: int = A_TRIGGER) -> StreamingQuery:
    """Hand each new manifest to ``handle``, as a table of its own, once a checkpoint.

    The checkpoint keeps what was seen, also while nothing ran; the ledger beside
    it, ``<checkpoint>-ledger``, what was handled, so that a batch that comes
    again after a crash is not handled twice. ``seed`` only records what is there
    now. A run that ``handle`` fails on is kept in ``<checkpoint>-failed``, stops
    neither the runs that came with it nor the stream, and is found again by
    ``scan_once`` as long as it has no output. With ``late`` a run that was
    announced before is handed on again only if a newer manifest lists more steps.
    """
    stream = _stream(spark, root, source, most)
    stream = announcements(stream) if late else stream
    writer = stream.writeStream.foreachBatch((lambda rows, number: rows.count()) if seed else _ledgered(spark, checkpoint, handle))
    if late:
        writer = writer.outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(**({"availableNow": True} if once or seed else {"processingTime": interval})).start()


def announcements(stream: DataFrame) -> DataFrame:
    """Manifests of a stream, each run's first and those newer ones that list more steps than any before.

    State is kept by run: the steps and the time of the last manifest handed on,
    two numbers a run, which stay for as long as the stream. Of manifests of a
    run that arrive together the newest counts, of ties that with most steps.
    """
    metadata = stream.schema["_metadata"].dataType
    slim = F.struct(F.col("_metadata.file_path").alias("file_path"), F.unix_micros("_metadata.file_modification_time").alias("modified"))
    keyed = stream.filter(F.col("schema_version").eqNullSafe(F.lit(1))).select(
        F.col("source.name").alias("name"), F.col("date").alias("day"), F.col("cycle").alias("hour"), F.size(F.coalesce(F.array_distinct("files.step_hours"), F.array())).alias("steps"), F.unix_micros("_metadata.file_modification_time").alias("at"),
        F.to_json(F.struct(*[c for c in stream.columns if c != "_metadata"])).alias("body"), F.to_json(slim).alias("place"),
    )

    def newest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        steps, at = state.get if state.exists else (-1, -1)
        best = None
        for f in frames:
            for r in f.itertuples():
                if best is None or (r.at, r.steps) > (best.at, best.steps):
                    best = r
        if best is not None and best.steps > steps and best.at >= at:
            state.update((int(best.steps), int(best.at)))
            yield pd.DataFrame({"body": [best.body], "place": [best.place]})

    told = keyed.groupBy("name", "day", "hour").applyInPandasWithState(newest, "body string, place string", "steps long, at long", "append", GroupStateTimeout.NoTimeout)
    fields = [F.lit(None).cast(f.dataType).alias(f.name) for f in metadata.fields]
    place = F.from_json("place", "file_path string, modified long")
    known = {"file_path": place["file_path"], "file_modification_time": F.timestamp_micros(place["modified"]), "file_name": F.element_at(F.split(place["file_path"], "/"), -1)}
    fields = [known[f.name].cast(f.dataType).alias(f.name) if f.name in known else x for f, x in zip(metadata.fields, fields, strict=True)]
    body = F.from_json("body", _shape(stream))
    return told.select(*(body[c].alias(c) for c in stream.columns if c != "_metadata"), F.struct(*fields).alias("_metadata"))


def _shape(stream: DataFrame) -> StructType:
    return StructType.fromJson(json.loads(stream.drop("_metadata").schema.json()))


def catalog_upkeep(spark: SparkSession, build: Callable[[DataFrame], DataFrame], signatures: Callable[[DataFrame], DataFrame], root: str, catalog: str) -> Callable[[DataFrame], None]:
    """A handler for ``watch``: builds the product of what arrived, writes it and brings the catalog up to date.

    ``signatures`` gives (source, init, signature) of runs (INIT). A run that
    comes twice is withdrawn, written and entered again, with the same result.
    """

    def handle(rows: DataFrame) -> None:
        manifests = shaped(rows)
        due = manifests.select(*INIT)
        publish(spark, build(manifests), due, root, catalog, signatures(due))

    return handle


def publication_upkeep(build: Callable[[DataFrame], DataFrame], root: str, catalog: str, sizes: Sizes = Sizes()) -> Callable[[DataFrame], None]:
    """A handler for ``watch``: builds the product of what arrived and publishes it by tile, read back before the catalog names it.

    A run that is stored already from this very manifest or a newer one is left
    alone, so a manifest that comes twice does no work; one whose tiles are
    missing is an error, and is found again by the next scan.
    """

    def handle(rows: DataFrame) -> None:
        manifests = shaped(rows)
        spark = rows.sparkSession
        known = run_times(spark, root)
        stale = manifests.join(known, INIT, "left").filter(F.col("stored_at").isNull() | (F.col("stored_at") < F.col("manifest_time"))).select(*manifests.columns)
        due = stale.select(*INIT)
        if not due.isEmpty():
            publish_runs(build(stale), due, root, catalog, sizes, strict=True)

    return handle


def run_times(spark: SparkSession, root: str) -> DataFrame:
    """(INIT, stored_at): when each stored run was finished."""
    found = run_inventory(spark, root).filter("signature IS NOT NULL")
    return found.select(F.col("id_source").alias("source"), F.col("init").cast("date").alias("init_date"), F.hour(F.col("init")).alias("cycle"), F.col("newest").alias("stored_at"))


def scan_once(spark: SparkSession, root: str, outputs: DataFrame, source: str | None = None, force: bool = False) -> DataFrame:
    """What every announced run needs now. A batch join, as a manifest rewritten in place must count again, which a file stream does not see."""
    manifests, _ = read_manifests(spark, root, source)
    return pending(manifests, outputs, force)


def latest_announcement(manifests: DataFrame) -> DataFrame:
    """The newest announcement of each run: what a run announced early and again later is built from."""
    return manifests.groupBy(*INIT).agg(F.max_by(F.struct(*[c for c in manifests.columns if c not in INIT]), "manifest_time").alias("m")).select(*INIT, "m.*")
