"""The gate before raw files are archived: a day passes if no check finds a violation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fields import axis_check
from .probability import receipt, validate
from .readiness import INIT, checksum_mismatch, missing_cycles, pending, tree_diff, unlisted
from .tiles import completeness, to_tiles, undeclared

VIOLATION = [*INIT, "check", "detail"]


def _rows(frame: DataFrame, check, detail) -> DataFrame:
    text = F.lit(detail) if isinstance(detail, str) else detail.cast("string")
    name = F.lit(check) if isinstance(check, str) else check
    return frame.select(*INIT, name.alias("check"), text.alias("detail"))


def run_violations(manifests: DataFrame, planned: DataFrame, outputs: DataFrame) -> DataFrame:
    """Cycles that are planned and not announced, runs not ready, products absent, incomplete or older than their manifest."""
    state = pending(manifests, outputs)
    late = state.filter(F.col("action") != "skip")
    reason = F.when(F.col("action") != "process", F.col("action")).when(F.col("complete").isNull(), "no product").when(F.col("complete") == 0, "incomplete product").otherwise("product older than manifest")
    return _rows(missing_cycles(planned, manifests), "missing cycle", "").unionByName(_rows(late, reason, F.lit("")))


def raw_violations(listed: DataFrame, actual: DataFrame) -> DataFrame:
    """Raw files (INIT, path, size_bytes, h) that differ from what manifests list, are absent, unlisted or unfinished."""
    keyed = lambda f: f.withColumn("path", F.to_json(F.struct(*INIT, "path")))  # noqa: E731  one key of run and path
    back = lambda f: f.withColumn("k", F.from_json("path", "source string, init_date date, cycle int, path string")).select("k.source", "k.init_date", "k.cycle", F.col("k.path").alias("file"), *[c for c in f.columns if c == "problem"])
    a, b = keyed(listed), keyed(actual)
    wrong = _rows(back(checksum_mismatch(a, b).select("path")), "raw hash", F.col("file"))
    return wrong.unionByName(_rows(back(_finished(unlisted(b, a))), F.concat(F.lit("raw "), F.col("problem")), F.col("file")))


def _finished(found: DataFrame) -> DataFrame:
    part = F.get_json_object("path", "$.path").endswith(".part") & (F.col("problem") == "unlisted")
    return found.withColumn("problem", F.when(part, "unfinished").otherwise(F.col("problem")))


def product_violations(product: DataFrame, expected: DataFrame, receipts: DataFrame | None = None) -> DataFrame:
    """Windows, ranges and bounds of products, and receipts (INIT, variable, n_actual) that say something else."""
    out = _rows(validate(product, expected, INIT), F.concat(F.lit("product "), F.col("check")), F.concat_ws(" ", "variable", F.col("step_hours").cast("string")))
    if receipts is None:
        return out
    now = receipt(product, expected, INIT).select(*INIT, "variable", F.col("n_actual").alias("counted"))
    differ = now.join(receipts, [*INIT, "variable"], "full_outer").filter(~F.col("counted").eqNullSafe(F.col("n_actual")))
    return out.unionByName(_rows(differ, "receipt", F.col("variable")))


def copy_violations(hot: DataFrame, cold: DataFrame) -> DataFrame:
    """(path, state) of files whose copy is not the same; an empty original is one too."""
    found = tree_diff(hot, cold).filter("state <> 'same'")
    none = hot.agg(F.count("*").alias("n")).filter("n = 0").select(F.lit("").alias("path"), F.lit("empty original").alias("state"))
    return found.unionByName(none)


def bundle_violations(manifests: DataFrame, actual: DataFrame, bundles: tuple[int, ...] = (240, 360)) -> DataFrame:
    """Bundles of probability runs that do not agree with their contract.

    manifests: INIT, probability_availability; actual: INIT, bundle,
    index_sha256 of the index files found. Every run declares all ``bundles``;
    an available one has selected records, an index with the declared hash and
    events, an unavailable one has none of these.
    """
    declared = manifests.select(*INIT, F.explode_outer("probability_availability.bundles").alias("b")).select(*INIT, "b.*")
    per_run = declared.groupBy(*INIT).agg(F.sort_array(F.collect_list("bundle")).alias("have")).filter(F.col("have") != F.lit(sorted(bundles)))
    found = declared.filter("bundle IS NOT NULL").join(actual.select(*INIT, "bundle", F.col("index_sha256").alias("h")), [*INIT, "bundle"], "left")
    there = F.col("status") == "available"
    reason = (
        F.when(~F.coalesce(F.col("status").isin("available", "unavailable"), F.lit(False)), "bundle status")
        .when(there & (F.coalesce("selected_records", F.lit(0)) < 1), "bundle records")
        .when(there & F.col("h").isNull(), "bundle index absent")
        .when(there & ~F.col("h").eqNullSafe(F.col("index_sha256")), "bundle index hash")
        .when(there & (F.size(F.coalesce("available_events", F.array())) < 1), "bundle events")
        .when(~there & ((F.coalesce("selected_records", F.lit(0)) > 0) | (F.size(F.coalesce("available_events", F.array())) > 0)), "bundle unavailable")
    )
    wrong = found.withColumn("reason", reason).filter("reason IS NOT NULL")
    return _rows(per_run, "bundles", F.to_json("have")).unionByName(_rows(wrong, F.col("reason"), F.col("bundle")))


def grid_violations(product: DataFrame, variables: list[str], declared: int, tile: int, spacing: float) -> DataFrame:
    """Products with tiles of the declared grid missing, variables that are not declared, or an axis that is not regular."""
    tiled = to_tiles(product, tile, tile)
    tiles = _rows(completeness(tiled, strict=True, declared=declared), "tiles", F.col("variable"))
    names = _rows(undeclared(product, variables), "undeclared variable", F.col("variable"))
    axes = [_rows(axis_check(product, a, spacing).filter("regular = 0"), "axis", a) for a in ("latitude", "longitude")]
    return tiles.unionByName(names).unionByName(axes[0]).unionByName(axes[1])


def gate(planned: DataFrame, manifests: DataFrame, outputs: DataFrame, listed: DataFrame, actual: DataFrame, bundles: DataFrame, product: DataFrame, expected: DataFrame, receipts: DataFrame, hot: DataFrame, cold: DataFrame, variables: list[str], declared: int, tile: int, spacing: float) -> DataFrame:
    """All violations (VIOLATION) of the runs ``planned`` by the five gates: runs, raw files and bundles, products, grids, copies.

    hot and cold: INIT, path, h of the originals and their copies; a run without
    originals is a violation.
    """
    keyed = lambda f: f.withColumn("path", F.to_json(F.struct(*INIT, "path"))).select("path", "h")  # noqa: E731  one key of run and path
    key = F.from_json("path", "source string, init_date date, cycle int, path string")
    copies = tree_diff(keyed(hot), keyed(cold)).filter("state <> 'same'").select(key.alias("k"), "state").select("k.*", "state")
    empty = planned.join(hot.select(*INIT).distinct(), INIT, "left_anti")
    parts = [
        run_violations(manifests, planned, outputs),
        raw_violations(listed, actual),
        bundle_violations(manifests, bundles),
        product_violations(product, expected, receipts),
        grid_violations(product, variables, declared, tile, spacing),
        _rows(copies, F.concat(F.lit("copy "), F.col("state")), F.col("path")),
        _rows(empty, "copy empty original", ""),
    ]
    return reduce(DataFrame.unionByName, parts).join(planned.select(*INIT).distinct(), INIT, "left_semi")


def verify_days(violations: DataFrame, planned: DataFrame) -> DataFrame:
    """A row a planned (source, init_date): how many violations it has, and whether it passes."""
    days = planned.select("source", "init_date").distinct()
    counted = violations.groupBy("source", "init_date").agg(F.count("*").alias("n_violations"))
    out = days.join(counted, ["source", "init_date"], "left").withColumn("n_violations", F.coalesce("n_violations", F.lit(0)).cast("long"))
    return out.withColumn("passes", (F.col("n_violations") == 0).cast("int"))
