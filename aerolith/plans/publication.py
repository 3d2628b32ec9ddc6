"""Publishing runs, and keeping the catalog in step with what is stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import catalog_check, catalog_diff, reconcile, with_init
from ..operators.tiles import INIT
from ..sources.catalog_store import products_of, read_catalog, read_coverage, rebuild_source, remove, replace_inits, stored_members, stored_state, upsert
from ..sources.shared import kept
from ..sources.tile_store import Sizes, TilesMissing, declaration, declared_definitions, drop_runs, read_meta, run_inventory, write_runs


def _sources(frame: DataFrame) -> list[str]:
    return [r["source"] for r in frame.select("source").distinct().collect()]  # the few sources of one call


def publish_runs(product: DataFrame, due: DataFrame, root: str, catalog: str, sizes: Sizes = Sizes(), attributes: DataFrame | None = None, meta: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Withdraw the runs ``due`` (INIT) from the catalog, write them, read them back, and put those that are whole into the catalog.

    Returns the missing tiles of runs that were not stored whole: these are
    deleted and stay out of the catalog, to be built again; with ``strict`` they
    are an error. A run of ``due`` of which the product holds nothing is
    withdrawn too. Readers never meet an old entry above new cells. ``meta``
    declares what the runs must hold, else the product does.
    """
    spark = product.sparkSession
    due = kept(due.select(*INIT).distinct())
    inits = with_init(due)
    for source in _sources(due):
        remove(spark, catalog, source, inits.filter(F.col("source") == source))
    drop_runs(spark, root, due)
    own = product.join(F.broadcast(due), INIT, "left_semi")  # the runs of one call
    meta = kept(declaration(own, sizes, attributes) if meta is None else meta.join(due, INIT, "left_semi"))
    missing = write_runs(own, root, sizes, meta)
    done = read_meta(spark, root).join(F.broadcast(due), INIT, "left_semi")
    rows = kept(products_of(declared_definitions(done), signatures_of(spark, root)))
    for source in _sources(due):
        upsert(spark, catalog, rows, source, inits)
    if strict and not missing.isEmpty():
        raise TilesMissing(", ".join(sorted({f"{r['source']} {r['init_date']} {r['cycle']:02}z {r['variable']}" for r in missing.limit(20).collect()})))
    return missing


def signatures_of(spark: SparkSession, root: str) -> DataFrame:
    return run_inventory(spark, root).select(F.col("id_source").alias("source"), "init", "signature")


def _folders(spark: SparkSession, root: str) -> DataFrame:
    """(id_source) whose folders are there, with or without runs."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/cells/source=*")
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place) or []
    return spark.createDataFrame([(f.getPath().getName().split("=", 1)[1],) for f in found], "id_source string")


def unusable_sources(spark: SparkSession, catalog: str) -> DataFrame:
    """Sources whose stored catalog is not ready or contradicts its coverage."""
    stored = read_catalog(spark, catalog)
    members = stored_members(stored)
    damaged = catalog_check(stored_state(stored), stored.select("source", "init").distinct(), read_coverage(spark, catalog)).select("source")
    counted = members.groupBy("source", "name").agg(F.count_distinct("init").alias("n"), F.min("init").alias("low"), F.max("init").alias("high"))
    joined = counted.join(read_coverage(spark, catalog), ["source", "name"], "full_outer")
    apart = joined.filter(~(F.col("n").eqNullSafe(F.col("n_inits")) & F.col("low").eqNullSafe(F.col("first_init")) & F.col("high").eqNullSafe(F.col("last_init")))).select("source")
    return damaged.unionByName(apart).distinct()


def apply_reconcile(spark: SparkSession, root: str, catalog: str, apply: bool = False, min_age_seconds: int = 120, force: bool = False, bulk: int = 256, before_commit: Callable[[], None] | None = None) -> DataFrame:
    """Bring the catalog in step with the stored runs; a report a source: reconcile's columns and applied.

    Without ``apply`` nothing is written. A source with files younger than
    ``min_age_seconds`` is deferred. Only declarations of runs that changed are
    read. The inventory is taken again before anything is written: a source that
    moved meanwhile is refused, and its catalog stays as it was. A source that
    is not ready or contradicts its coverage is rebuilt from its declarations,
    and so is one with more than ``bulk`` changes. ``before_commit`` runs between
    reading and the second look.
    """
    current = kept(run_inventory(spark, root))
    stored = read_catalog(spark, catalog)
    previous = stored.select(F.col("source").alias("id_source"), "init", "signature")
    young = current.filter(F.col("newest") > F.current_timestamp() - F.make_dt_interval(secs=F.lit(min_age_seconds))).select("id_source").distinct()
    bad = kept(unusable_sources(spark, catalog).select(F.col("source").alias("id_source")).unionByName(current.select("id_source").join(previous, "id_source", "left_anti")).distinct())
    folders = _folders(spark, root)
    look = lambda usable, how: reconcile(previous.join(bad, "id_source", how), current.join(bad, "id_source", how), usable, force, young, bulk, folders.join(bad, "id_source", how))
    known = stored.select(F.col("source").alias("id_source")).unionByName(current.select("id_source")).distinct()
    report = kept(look(True, "left_anti").unionByName(look(False, "left_semi")).join(known, "id_source", "left_semi"))
    if not apply:
        return report.withColumn("applied", F.lit(0))
    acting = report.filter(F.col("action").isin("rebuilt", "repaired")).select("id_source")
    state = kept(catalog_diff(previous.join(acting, "id_source", "left_semi"), current.join(acting, "id_source", "left_semi").filter("signature IS NOT NULL")))
    rebuilt = report.filter("action = 'rebuilt'").select("id_source")
    wanted = state.filter("state IN ('added', 'changed')").select("id_source", "init").unionByName(state.filter("state = 'same'").select("id_source", "init").join(rebuilt, "id_source", "left_semi"))
    wanted = wanted.select(F.col("id_source").alias("source"), "init")
    signed = current.select(F.col("id_source").alias("source"), "init", "signature")
    meta = with_init(read_meta(spark, root)).join(wanted, ["source", "init"], "left_semi")
    rows = kept(products_of(declared_definitions(meta), signed))
    if before_commit:
        before_commit()
    again = run_inventory(spark, root)
    moved = {r["id_source"] for r in catalog_diff(current, again).filter("state <> 'same'").select("id_source").distinct().collect()}
    done = []
    for r in report.select("id_source", "action").collect():  # sources
        source = r["id_source"]
        if r["action"] not in ("rebuilt", "repaired") or source in moved:
            continue
        if r["action"] == "rebuilt":
            rebuild_source(spark, catalog, source, rows)
        else:
            gone = state.filter((F.col("id_source") == source) & (F.col("state") == "removed")).select("init")
            replace_inits(spark, catalog, source, gone, rows)
        done.append(source)
    refused = F.col("id_source").isin(*moved) & F.col("action").isin("rebuilt", "repaired")
    return report.withColumn("applied", F.col("id_source").isin(*done).cast("int")).withColumn("action", F.when(refused, "refused").otherwise(F.col("action")))
