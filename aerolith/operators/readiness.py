"""Which announced runs can be built, which must be, and what came of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INIT = ["source", "init_date", "cycle"]


def readiness(manifests: DataFrame) -> DataFrame:
    """manifests with status: unavailable, not_ready or ready, in this order."""
    none = (F.col("n_files") == 0) & (F.col("contract_status") == "unavailable")
    return manifests.withColumn("status", F.when(none, "unavailable").when(F.col("completed_at").isNull() | (F.col("n_failures") > 0), "not_ready").otherwise("ready"))


def pending(manifests: DataFrame, outputs: DataFrame, force: bool = False) -> DataFrame:
    """manifests with action: process, skip, or why not. An output counts if complete and not older than its manifest."""
    joined = readiness(manifests).join(outputs.select(*INIT, "complete", "marker_time"), INIT, "left")
    stale = F.lit(force) | F.col("complete").isNull() | (F.col("complete") == 0) | F.col("marker_time").isNull() | (F.col("marker_time") < F.col("manifest_time"))
    return joined.withColumn("action", F.when(F.col("status") != "ready", F.col("status")).when(stale, "process").otherwise("skip"))


def select_inits(inits: DataFrame, first: Column, last: Column, cycles: list[int], source: str | None = None) -> DataFrame:
    """Inits of a range of days, both ends included, of some cycles and maybe one source; rows without a day and, where completed_at is known, unfinished ones drop out."""
    out = inits.filter(F.col("init_date").between(first, last) & F.col("cycle").isin(*cycles))
    out = out.filter(F.col("completed_at").isNotNull()) if "completed_at" in inits.columns else out
    return out if source is None else out.filter(F.col("source") == source)


def scan_summary(actions: DataFrame) -> DataFrame:
    """A row a source: how many were processed, skipped, not ready, failed; alert only for failures."""
    count = lambda *names: F.count_if(F.col("action").isin(*names))
    out = actions.groupBy("source").agg(count("process").alias("processed"), count("skip").alias("skipped"), count("not_ready", "unavailable").alias("not_ready"), count("failed").alias("failed"))
    return out.withColumn("alert", (F.col("failed") > 0).cast("int"))


def batch_summary(actions: DataFrame) -> DataFrame:
    """ok, skipped, failed, and with_failures: failures that a manifest lists do not fail a batch."""
    count = lambda name: F.count_if(F.col("action") == name)
    return actions.groupBy("source").agg(count("process").alias("ok"), count("skip").alias("skipped"), count("failed").alias("failed"), F.count_if(F.col("n_failures") > 0).alias("with_failures"))


def resolve_files(listed: DataFrame, under_root: DataFrame, beside: DataFrame) -> DataFrame:
    """listed (path, directory, name) with found: under the root, else next to the manifest, else null."""
    at_root = under_root.select("path", F.col("location").alias("at_root"))
    near = beside.select("directory", "name", F.col("location").alias("near"))
    return listed.join(at_root, "path", "left").join(near, ["directory", "name"], "left").withColumn("found", F.coalesce("at_root", "near")).drop("at_root", "near")


def checksum_mismatch(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Files (path) whose size or hash differs from what the manifest says."""
    joined = expected.join(actual.select("path", F.col("size_bytes").alias("actual_size"), F.col("h").alias("actual_h")), "path")
    return joined.filter(~(F.col("size_bytes").eqNullSafe(F.col("actual_size")) & F.col("h").eqNullSafe(F.col("actual_h"))))


def tree_diff(hot: DataFrame, cold: DataFrame) -> DataFrame:
    """(path, state) over both trees: same, changed, only_hot, only_cold."""
    joined = hot.select("path", F.col("h").alias("a"), F.lit(1).alias("in_hot")).join(cold.select("path", F.col("h").alias("b"), F.lit(1).alias("in_cold")), "path", "full_outer")
    state = F.when(F.col("in_cold").isNull(), "only_hot").when(F.col("in_hot").isNull(), "only_cold").when(F.col("a").eqNullSafe(F.col("b")), "same").otherwise("changed")
    return joined.select("path", state.alias("state"))


def unlisted(listing: DataFrame, manifest_files: DataFrame) -> DataFrame:
    """(path, problem): files that no manifest lists, listed files that are absent, and unfinished ones."""
    extra = listing.join(manifest_files, "path", "left_anti").select("path", F.when(F.col("path").endswith(".part"), "unfinished").otherwise("unlisted").alias("problem"))
    return extra.unionByName(manifest_files.join(listing, "path", "left_anti").select("path", F.lit("absent").alias("problem")))


def missing_cycles(planned: DataFrame, present: DataFrame) -> DataFrame:
    return planned.join(present, INIT, "left_anti")


def archive_candidates(products: DataFrame, today: Column, keep_days: int = 30) -> DataFrame:
    """Days older than keep_days of which every cycle has a product and all its parts are complete."""
    days = products.groupBy("source", "init_date").agg(F.bool_and((F.col("parts") > 0) & (F.col("done") == F.col("parts"))).alias("whole"), F.count("*").alias("n_cycles"))
    return days.filter(F.col("whole") & (F.col("init_date") < F.date_sub(today, keep_days))).drop("whole")
