"""The catalog: which variable is covered by which inits, and whether it still holds.

An init is a day and a cycle as one time, so the runs of one day count each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import init_time, level_label

# Names that are coordinates and never variables.
COORDINATES = ("latitude", "longitude", "step", "time", "valid_time", "pressure_level", "isobaricInhPa", "number", "surface")
# Fixed value: names of stored products.
PRODUCT_NAME = r"^(\d{8})_(\d{2})z_(.+?)(?:-(sfc|pres))?\.zarr$"
#: The version that a stored state must have.
VERSION = 1


def with_init(frame: DataFrame) -> DataFrame:
    """frame with init, from init_date and cycle where it is not there yet."""
    return frame if "init" in frame.columns else frame.withColumn("init", init_time(F.col("init_date"), F.col("cycle")))


def product_identity(names: DataFrame, column: str = "name") -> DataFrame:
    """names with id_source, init (date and cycle), prefix and part; rows that are no product's name drop out."""
    piece = lambda k: F.regexp_extract(column, PRODUCT_NAME, k)
    init = F.try_to_timestamp(F.concat(piece(1), piece(2)), F.lit("yyyyMMddHH")).cast("timestamp_ntz")
    out = names.filter(F.col(column).rlike(PRODUCT_NAME) & ~F.col(column).startswith(".")).withColumns({"id_source": piece(3), "init": init, "prefix": F.concat(piece(1), F.lit("_"), piece(2), F.lit("z_"), piece(3)), "part": F.nullif(piece(4), F.lit(""))})
    return out.filter(F.col("init").isNotNull())


def definitions(product: DataFrame, boundaries: list[str] = ()) -> DataFrame:
    """(source, init, name, base, level): exposed names; levelled variables once a level; attrs too, if the product has them.

    Coordinates, boundary variables and variables without a present value are left out.
    """
    more = [c for c in ("attrs",) if c in product.columns]
    present = product.filter(F.col("value").isNotNull() & ~F.col("variable").isin(*COORDINATES, *boundaries))
    variables = with_init(present).select("source", "init", F.col("variable").alias("base"), "pressure_level", *more).distinct()
    level = level_label(F.col("pressure_level"))
    return variables.select("source", "init", F.when(level.isNull(), F.col("base")).otherwise(F.concat("base", F.lit("_"), level)).alias("name"), "base", level.alias("level"), *more)


def membership(defined: DataFrame) -> DataFrame:
    """(source, init, name): exposed names and base names."""
    return defined.select("source", "init", F.explode(F.array_distinct(F.array("name", "base"))).alias("name")).distinct()


def coverage(members: DataFrame) -> DataFrame:
    return members.groupBy("source", "name").agg(F.min("init").alias("first_init"), F.max("init").alias("last_init"), F.count_distinct("init").alias("n_inits"))


def updated_coverage(covered: DataFrame, members: DataFrame, touched: DataFrame) -> DataFrame:
    """``covered`` after a change: names of ``touched`` (source, name) are computed anew from ``members`` as they are now, the others stay as they were.

    Only the members of touched names are grouped, and a name that has none left goes.
    """
    names = touched.select("source", "name").distinct()
    stay = covered.join(names, ["source", "name"], "left_anti")
    return stay.unionByName(coverage(members.join(names, ["source", "name"], "left_semi")).select(*covered.columns))


def catalog_state(products: DataFrame) -> DataFrame:
    return with_init(products).groupBy("source").agg(F.count_distinct("init").alias("total"), F.min("init").alias("first_init"), F.max("init").alias("last_init"))


def coverage_query(covered: DataFrame, state: DataFrame) -> DataFrame:
    """Coverage as readers may see it: of sources whose catalog is ready."""
    return covered.join(state.filter(F.col("ready") == 1).select("source"), "source", "left_semi")


def latest_definitions(members: DataFrame, covered: DataFrame) -> DataFrame:
    """Names of each source's newest init that coverage lacks."""
    newest = members.withColumn("nth", F.dense_rank().over(Window.partitionBy("source").orderBy(F.desc("init")))).filter("nth = 1").drop("nth")
    return newest.join(covered, ["source", "name"], "left_anti")


def difference(members: DataFrame, reference: DataFrame) -> DataFrame:
    """members whose name ``reference`` lacks; empty if the first are a subset."""
    return members.join(reference.select("name").distinct(), "name", "left_anti").select(*members.columns)


def symmetric_difference(members: DataFrame, reference: DataFrame) -> DataFrame:
    """(name, side): names that only one of both has, first or second; empty if the sets are the same."""
    a, b = members.select("name").distinct(), reference.select("name").distinct()
    return a.join(b, "name", "left_anti").withColumn("side", F.lit("first")).unionByName(b.join(a, "name", "left_anti").withColumn("side", F.lit("second")))


def latest_inits(products: DataFrame, n: int) -> DataFrame:
    """The n newest inits of each source: a top-n report."""
    inits = with_init(products).select("source", "init").distinct()
    return inits.withColumn("nth", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("init")))).filter(F.col("nth") <= n)


def catalog_check(stored: DataFrame, products: DataFrame, covered: DataFrame) -> DataFrame:
    """violations (source, check) of a stored state (source, total, first_init, last_init, ready, maybe version) and coverage."""
    true = catalog_state(products).select("source", F.col("total").alias("t"), F.col("first_init").alias("f"), F.col("last_init").alias("l"))
    joined = stored.join(true, "source", "full_outer").join(stored.groupBy("source").agg(F.count("*").alias("states")), "source", "left")
    checks = {
        "several states": F.coalesce(F.col("states") > 1, F.lit(False)),
        "version": F.coalesce(F.col("version") != VERSION, F.lit(False)) if "version" in stored.columns else F.lit(False),
        "no state": F.col("total").isNull(),
        "not ready": F.coalesce(F.col("ready") != 1, F.lit(False)),
        "total": F.coalesce(F.col("total") != F.coalesce("t", F.lit(0)), F.lit(False)),
        "first": F.col("total").isNotNull() & ~F.col("first_init").eqNullSafe(F.col("f")),
        "last": F.col("total").isNotNull() & ~F.col("last_init").eqNullSafe(F.col("l")),
    }
    of_state = joined.select("source", F.explode(F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in checks.items())))).alias("check")).distinct()
    within = covered.join(stored.dropDuplicates(["source"]).select("source", "total", F.col("first_init").alias("low"), F.col("last_init").alias("high")), "source")
    bad = (F.col("n_inits") < 1) | (F.col("n_inits") > F.col("total")) | (F.col("first_init") > F.col("last_init")) | (F.col("first_init") < F.col("low")) | (F.col("last_init") > F.col("high"))
    return of_state.unionByName(within.filter(bad).select("source", F.concat(F.lit("coverage of "), "name").alias("check")))


def inventory(stores: DataFrame) -> DataFrame:
    """(id_source, init, n_parts, signature): parts of each init; no signature unless all are complete.

    The signature is the sorted list of (name, modified, size) of an init's parts, two or three.
    """
    part = F.struct(F.col("name").alias("name"), F.date_format("modified", "yyyy-MM-dd HH:mm:ss").alias("modified"), F.col("size_bytes").alias("size"))
    found = stores.groupBy("id_source", "init").agg(F.count("*").alias("n_parts"), F.min("complete").alias("whole"), F.to_json(F.sort_array(F.collect_set(part))).alias("signature"))
    return found.select("id_source", "init", "n_parts", F.when(F.col("whole") == 1, F.col("signature")).alias("signature"))


def catalog_diff(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(id_source, init, state): added, changed, removed or same by signature."""
    before = previous.select("id_source", "init", F.col("signature").alias("old"), F.lit(1).alias("was"))
    now = current.select("id_source", "init", F.col("signature").alias("new"), F.lit(1).alias("is"))
    joined = before.join(now, ["id_source", "init"], "full_outer")
    state = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "removed").when(F.col("old").eqNullSafe(F.col("new")), "same").otherwise("changed")
    return joined.select("id_source", "init", state.alias("state"))


def reconcile(previous: DataFrame, current: DataFrame, usable: bool = True, force: bool = False, recent: DataFrame | None = None, bulk: int = 256, folders: DataFrame | None = None) -> DataFrame:
    """A report a source: action (error, deferred, rebuilt, repaired, unchanged), added, changed, removed, total.

    ``current`` is an inventory, whose inits without a signature are not yet
    whole; ``recent`` (id_source) names sources whose files are still changing.
    A source that is known and of which nothing is found any more is an error,
    not a deletion: its catalog must stay as it is. ``folders`` (id_source) names
    sources whose folder is there, if it is empty too; these may lose all.
    """
    whole = current.filter(F.col("signature").isNotNull())
    seen = current.groupBy("id_source").agg(F.count("signature").alias("total")).withColumn("here", F.lit(1))
    rebuilding = force or not usable
    diff = catalog_diff(previous if usable else previous.limit(0), whole)
    counted = diff.groupBy("id_source").agg(F.count_if(F.col("state") == "added").alias("added"), F.count_if(F.col("state").isin("added", "changed")).alias("changed"), F.count_if(F.col("state") == "removed").alias("removed"))
    known = previous.select("id_source").distinct().withColumns({"added": F.lit(0), "changed": F.lit(0), "removed": F.lit(0)})
    counted = counted.unionByName(known.join(counted, "id_source", "left_anti"))  # also if the catalog is not usable
    if folders is not None:
        empty = folders.select("id_source").distinct().join(seen, "id_source", "left_anti")
        seen = seen.unionByName(empty.withColumns({"total": F.lit(0).cast("long"), "here": F.lit(1)}))
    out = seen.join(counted, "id_source", "full_outer").fillna(0, ["total", "added", "changed", "removed"])
    if rebuilding:
        out = out.withColumn("changed", F.col("total"))
    late = out.select("id_source").limit(0).withColumn("recent", F.lit(1)) if recent is None else recent.select("id_source").distinct().withColumn("recent", F.lit(1))
    out = out.join(late, "id_source", "left")
    action = F.when(F.col("here").isNull(), "error").when(F.col("recent") == 1, "deferred").when(F.lit(rebuilding) & (F.col("total") == 0), "deferred").when(F.lit(rebuilding) | (F.col("changed") > bulk), "rebuilt").when((F.col("changed") > 0) | (F.col("removed") > 0), "repaired").otherwise("unchanged")
    return out.select("id_source", action.alias("action"), "added", F.when(F.col("changed") > bulk, F.col("total")).otherwise(F.col("changed")).alias("changed"), "removed", "total")
