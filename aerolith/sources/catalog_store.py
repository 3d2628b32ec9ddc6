"""The stored catalog: product definitions and coverage, a partition a source each.

Definitions are the truth; coverage is kept beside them, and a change computes
only the names anew that inits which came or went have. A rewrite reads one
source's partition and replaces it in dynamic mode; there is one writer a source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import coverage, updated_coverage
from .shared import delete, exists, kept

CATALOG = "init timestamp_ntz, signature string, definitions array<struct<name:string,base:string,level:string,attrs:string>>, ready int, source string"
COVERAGE = "name string, first_init timestamp_ntz, last_init timestamp_ntz, n_inits long, source string"


def _read(spark: SparkSession, root: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(root) if exists(spark, root) else spark.createDataFrame([], schema)


def read_catalog(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, CATALOG)


def read_coverage(spark: SparkSession, root: str) -> DataFrame:
    """Stored coverage: what a full computation from the catalog gives."""
    return _read(spark, f"{root}-coverage", COVERAGE)


def products_of(defined: DataFrame, signatures: DataFrame) -> DataFrame:
    """Catalog rows from definitions (source, init, name, base, level, maybe attrs) and (source, init, signature); inits without signature are not whole and drop out."""
    defined = defined if "attrs" in defined.columns else defined.withColumn("attrs", F.lit(None).cast("string"))
    grouped = defined.groupBy("source", "init").agg(F.sort_array(F.collect_set(F.struct("name", "base", "level", "attrs"))).alias("definitions"))  # an init's variables
    return grouped.join(signatures.filter(F.col("signature").isNotNull()), ["source", "init"]).select("init", "signature", "definitions", F.lit(0).alias("ready"), "source")


def _write(rows: DataFrame, root: str) -> None:
    """Replace the partitions of the sources in ``rows``."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(root)


def _store(spark: SparkSession, root: str, source: str, rows: DataFrame) -> None:
    """Replace a source's partition. One left without rows is deleted, as dynamic mode keeps it."""
    rows = kept(rows)
    if rows.isEmpty():
        delete(spark, f"{root}/source={source}")
    else:
        _write(rows, root)


def replace_inits(spark: SparkSession, root: str, source: str, gone: DataFrame, rows: DataFrame, ready: int | None = None) -> None:
    """Take the inits ``gone`` (init) of a source out of the catalog and put ``rows`` in; coverage of the names that either have is computed anew.

    The source stays as ready as it was, unless ``ready`` says otherwise.
    """
    old = read_catalog(spark, root).filter(F.col("source") == source)
    rows = kept(rows.filter(F.col("source") == source))
    leaving = gone.select("init").unionByName(rows.select("init")).distinct()
    touched = stored_members(old.join(leaving, "init", "left_semi")).unionByName(stored_members(rows)).select("source", "name").distinct()
    touched = kept(touched)
    covered = read_coverage(spark, root).filter(F.col("source") == source)
    state = (old.agg(F.max("ready")).first()[0] or 0) if ready is None else ready
    new = kept(old.join(leaving, "init", "left_anti").unionByName(rows.select(*old.columns)).withColumn("ready", F.lit(state)))
    after = kept(updated_coverage(covered, stored_members(new), touched))
    _store(spark, root, source, new)
    _store(spark, f"{root}-coverage", source, after)


def upsert(spark: SparkSession, root: str, rows: DataFrame, source: str, touched: DataFrame | None = None) -> bool:
    """Put a source's inits into the catalog; False, and nothing written, if all are there with the same signature.

    ``touched`` (source, init) names the inits that were looked at: those that
    ``rows`` lacks are not whole any more and go. ready is kept as it is: only a
    rebuild sets it.
    """
    old = read_catalog(spark, root).filter(F.col("source") == source)
    new = rows.filter(F.col("source") == source)
    changed = new.join(old.select("init", F.col("signature").alias("known")), "init", "left").filter(~F.col("signature").eqNullSafe(F.col("known")))
    gone = old.select("init").limit(0)
    if touched is not None:
        gone = kept(old.select("init").join(touched.filter(F.col("source") == source).select("init"), "init", "left_semi").join(new.select("init"), "init", "left_anti"))
    changed = kept(changed.select(*old.columns))
    if changed.isEmpty() and gone.isEmpty():
        return False
    replace_inits(spark, root, source, gone, changed)
    return True


def remove(spark: SparkSession, root: str, source: str, inits: DataFrame) -> bool:
    """Withdraw inits (init) of a source, as before their products are written anew; whether any was there."""
    there = kept(read_catalog(spark, root).filter(F.col("source") == source).join(inits.select("init"), "init", "left_semi").select("init"))
    if there.isEmpty():
        return False
    replace_inits(spark, root, source, there, read_catalog(spark, root).limit(0))
    return True


def rebuild(spark: SparkSession, root: str, rows: DataFrame) -> None:
    """Replace the whole catalog by ``rows``, which come from the products, and set it ready; sources that vanished go."""
    rows = kept(rows.withColumn("ready", F.lit(1)))
    for part, path in ((rows, root), (coverage(stored_members(rows)), f"{root}-coverage")):
        part.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("source").parquet(path)


def rebuild_source(spark: SparkSession, root: str, source: str, rows: DataFrame) -> None:
    """Replace one source's catalog and coverage by ``rows`` and set it ready."""
    rows = kept(rows.filter(F.col("source") == source).withColumn("ready", F.lit(1)))
    _store(spark, root, source, rows)
    _store(spark, f"{root}-coverage", source, coverage(stored_members(rows)).select("name", "first_init", "last_init", "n_inits", "source"))


def stored_state(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("source").agg(F.count("*").alias("total"), F.min("init").alias("first_init"), F.max("init").alias("last_init"), F.min("ready").alias("ready"))


def stored_members(catalog: DataFrame) -> DataFrame:
    return catalog.select("source", "init", F.explode("definitions").alias("d")).select("source", "init", F.explode(F.array_distinct(F.array("d.name", "d.base"))).alias("name")).distinct()
