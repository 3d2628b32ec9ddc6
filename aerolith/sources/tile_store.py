"""Products stored by tile, with the declaration of each run beside its cells.

``<root>/cells`` holds a product's rows with their tile numbers, a folder a run,
variable and row of tiles, sorted by tile within, so that a region read opens the
folders of its rows of tiles and the row groups of its columns of tiles.
``<root>/meta`` holds what a run declares: the points of its axes with their tile
numbers, and its variables with their levels and attributes. A run's declaration
is written last, once its stored tiles have been read back and found complete, so
a run without one is not finished. Its files tell whether a run has changed.

The runs of a call and the bounds of a region are all that the driver sees.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import init_time, level_label
from ..operators.catalog import COORDINATES
from ..operators.tiles import INIT, TILES, expected_tiles, missing_tiles
from .products import PRODUCT
from .shared import delete, exists, kept

FOLDERS = [*INIT, "variable", "tile_latitude"]
#: Cells that the runs of a call can have, up to which they are dealt to all cores whatever their bytes: there opening folders takes the time.
FEW_CELLS = 16_000_000
META = "axis string, coordinate double, tile int, variable string, levels array<double>, attributes string, source string, init_date date, cycle int"
#: Axis, column of a product, column of its tile.
AXES = (("latitude", "latitude", "tile_latitude"), ("longitude", "longitude", "tile_longitude"), ("step", "step_hours", "tile_step"), ("level", "pressure_level", "tile_level"))


@dataclass(frozen=True)
class Sizes:
    """Points of a tile along each axis; None, 0 or -1 is one tile."""

    latitude: int | None = 64
    longitude: int | None = 64
    step: int | None = None
    level: int | None = None

    def of(self, axis: str) -> int | None:
        size = getattr(self, axis)
        return size if size and size > 0 else None


class TilesMissing(RuntimeError):
    """Stored runs lacked tiles that they declare; they have been deleted."""


CELLS = PRODUCT + "," + ", ".join(f"{t} int" for t in TILES)


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(",")]


def read_cells(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/cells"
    return spark.read.schema(CELLS).parquet(path) if exists(spark, path) else spark.createDataFrame([], CELLS)


def read_meta(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/meta"
    return spark.read.schema(META).parquet(path) if exists(spark, path) else spark.createDataFrame([], META)


def declaration(product: DataFrame, sizes: Sizes, attributes: DataFrame | None = None) -> DataFrame:
    """What the runs of a product declare (META), found in one pass over it. attributes: variable, attributes, and maybe source."""
    points = F.array(*(F.struct(F.lit(axis).alias("axis"), F.col(column).cast("double").alias("coordinate"), F.lit(None).cast("string").alias("variable")) for axis, column, _ in AXES))
    held = F.array(F.struct(F.lit("variable").alias("axis"), F.col("pressure_level").alias("coordinate"), F.when(F.col("value").isNotNull(), F.col("variable")).alias("variable")))
    seen = product.select(*INIT, F.explode(F.concat(points, held)).alias("p")).select(*INIT, "p.*").distinct()
    seen = kept(seen.filter((F.col("axis") != "variable") & F.col("coordinate").isNotNull() | F.col("variable").isNotNull()))  # points and names, not cells
    rank = F.row_number().over(Window.partitionBy(*INIT, "axis").orderBy("coordinate")) - 1
    size = reduce(lambda when, a: when.when(F.col("axis") == a[0], F.lit(sizes.of(a[0]))), AXES, F.when(F.lit(False), F.lit(None).cast("int")))
    axes = seen.filter("variable IS NULL").select(*INIT, "axis", "coordinate", F.coalesce(F.floor(rank / size), F.lit(0)).cast("int").alias("tile"))
    levels = F.sort_array(F.collect_set("coordinate"))  # a variable with and without levels is declared twice
    variables = seen.filter("variable IS NOT NULL").groupBy(*INIT, "variable", F.col("coordinate").isNull()).agg(levels.alias("levels")).select(*INIT, "variable", "levels")
    if attributes is None:
        variables = variables.withColumn("attributes", F.lit(None).cast("string"))
    else:
        variables = variables.join(attributes, [c for c in ("source", "variable") if c in attributes.columns], "left")
    return axes.unionByName(variables, allowMissingColumns=True).select(*_names(META))


def index_of(meta: DataFrame, sizes: Sizes) -> DataFrame:
    """The tiles that declared runs must have."""
    counts = [F.count_if(F.col("axis") == a).alias(f"n_{a}") for a, _, _ in AXES]
    shape = meta.groupBy(*INIT).agg(*counts)
    variables = meta.filter("variable IS NOT NULL").select(*INIT, "variable", (F.size("levels") > 0).alias("levelled"))
    return expected_tiles(shape, variables, sizes.latitude, sizes.longitude, sizes.step, sizes.level)


def declared_size(meta: DataFrame) -> tuple[int, int]:
    """The number of declared runs and the most cells that they can have."""
    points = [F.greatest(F.count_if(F.col("axis") == a), F.lit(1)).cast("double") for a in ("latitude", "longitude", "step")]
    fields = F.sum(F.when(F.col("variable").isNotNull(), F.greatest(F.size("levels"), F.lit(1))))
    each = meta.groupBy(*INIT).agg((points[0] * points[1] * points[2] * F.coalesce(fields, F.lit(0))).alias("cells"))
    runs, cells = each.agg(F.count("*"), F.coalesce(F.sum("cells"), F.lit(0.0))).first()
    return runs, int(cells)


def _with_tiles(product: DataFrame, meta: DataFrame) -> DataFrame:
    for axis, column, tile in AXES:
        points = meta.filter(F.col("axis") == axis).select(*INIT, F.col("coordinate").cast(product.schema[column].dataType).alias(column), F.col("tile").alias(tile))
        product = product.join(points, [*INIT, column], "left")  # static fields have no step, most variables no level
    return product


def run_folder(run) -> str:
    return f"source={run['source']}/init_date={run['init_date']}/cycle={run['cycle']}"


def drop_runs(spark: SparkSession, root: str, runs: DataFrame) -> None:
    """Delete runs (INIT), the declaration first."""
    for run in runs.select(*INIT).distinct().collect():  # the runs of one call
        delete(spark, f"{root}/meta/{run_folder(run)}")
        delete(spark, f"{root}/cells/{run_folder(run)}")


def write_runs(product: DataFrame, root: str, sizes: Sizes = Sizes(), meta: DataFrame | None = None, attributes: DataFrame | None = None, verify: bool = True, codec: str = "zstd", level: int = 3) -> DataFrame:
    """Write the runs of a product in place of what was there, read them back, and declare those that are whole.

    Returns the missing tiles (INIT, variable, tiles) of the others, which are
    deleted. ``meta`` declares the runs, for instance from headers; else what the
    product holds does. The product is read once for its declaration, if there
    is none, and once to be written. Rows are dealt by run, variable and tile;
    where one of these is large, Spark splits it, so that no task gets a
    variable of a run whole. Calls of FEW_CELLS at most are dealt to all cores.
    Without ``verify``, as for stations or tracks whose cells leave tiles empty by
    nature, every run is declared.
    """
    spark = product.sparkSession
    product = product if "extra_level" in product.columns else product.withColumn("extra_level", F.lit(None).cast("double"))
    meta = kept(declaration(product, sizes, attributes) if meta is None else meta.select(*_names(META)))
    runs = meta.select(*INIT).distinct()
    drop_runs(spark, root, runs)
    tiled = _with_tiles(product, meta).select(*_names(CELLS))
    cores, (n_runs, n_cells) = spark.sparkContext.defaultParallelism, declared_size(meta)
    if n_cells <= FEW_CELLS:
        dealt = tiled.repartition(cores, *FOLDERS)  # a file a folder
    else:
        dealt = spark.sql(f"SELECT /*+ REBALANCE({', '.join([*FOLDERS, 'tile_longitude'])}) */ * FROM {{tiled}}", tiled=tiled)
    ordered = dealt.sortWithinPartitions(*FOLDERS, "tile_longitude", "tile_level", "tile_step", "pressure_level", "latitude", "longitude", "step_hours")
    writer = ordered.write.mode("append").option("compression", "uncompressed" if codec == "none" else codec)
    writer = writer.option("parquet.compression.codec.zstd.level", str(level)) if codec == "zstd" else writer
    writer.partitionBy(*FOLDERS).parquet(f"{root}/cells")
    missing = kept(missing_in_store(spark, root, meta, sizes) if verify else index_of(meta.limit(0), sizes))
    drop_runs(spark, root, missing)
    declare(meta.join(missing.select(*INIT).distinct(), INIT, "left_anti"), root, min(n_runs, cores))
    return missing


def missing_in_store(spark: SparkSession, root: str, meta: DataFrame, sizes: Sizes) -> DataFrame:
    """Declared tiles that the stored files of the runs in ``meta`` do not hold; folders of other runs are not opened."""
    stored = read_cells(spark, root).join(F.broadcast(meta.select(*INIT).distinct()), INIT, "left_semi")  # the runs of one call
    return missing_tiles(stored, index_of(meta, sizes))


def declare(meta: DataFrame, root: str, tasks: int) -> None:
    """Mark runs as finished: their declarations, a file a run."""
    meta.repartition(max(1, tasks), *INIT).write.mode("append").partitionBy(*INIT).parquet(f"{root}/meta")


def read_region(spark: SparkSession, root: str, variables: list[str], south: float, north: float, west: float, east: float, pressure_level: float | None = None) -> DataFrame:
    """All steps of some variables in a box, from the tiles that the box meets and no others. Only finished runs are read.

    The box becomes bounds of tile numbers: those of rows choose folders, those of columns and levels row groups.
    """
    meta = read_meta(spark, root)
    within = {"latitude": F.col("coordinate").between(south, north), "longitude": F.col("coordinate").between(west, east), "level": F.lit(True) if pressure_level is None else F.col("coordinate") == pressure_level}
    bounds = meta.agg(*(f(F.when((F.col("axis") == a) & inside, F.col("tile"))).alias(f"{n}_{a}") for a, inside in within.items() for f, n in ((F.min, "low"), (F.max, "high")))).first()
    cells = read_cells(spark, root).filter(F.col("variable").isin(*variables))
    for a in ("latitude", "longitude", *(["level"] if pressure_level is not None else [])):
        low, high = bounds[f"low_{a}"], bounds[f"high_{a}"]
        cells = cells.filter(F.lit(False) if low is None else F.col(f"tile_{a}").between(low, high))
    inside = F.col("latitude").between(south, north) & F.col("longitude").between(west, east)
    inside = inside if pressure_level is None else inside & (F.col("pressure_level") == pressure_level)
    finished = meta.select(*INIT).distinct()
    return cells.filter(inside).join(finished, INIT, "left_semi").select(*_names(PRODUCT))


def stored_runs(spark: SparkSession, root: str) -> DataFrame:
    """(id_source, init, name, modified, size_bytes, complete) of the files of each run's declaration; a run with cells and no declaration has one row that is not complete.

    Names, times and sizes only: no file is opened.
    """
    schema = "id_source string, init timestamp_ntz, name string, modified timestamp, size_bytes long, complete int"
    out = spark.createDataFrame([], schema)
    for part, complete in (("meta", 1), ("cells", 0)):
        if exists(spark, f"{root}/{part}"):
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{root}/{part}")
            piece = lambda key: F.regexp_extract("path", f"/{key}=([^/]+)/", 1)
            init = init_time(piece("init_date").cast("date"), piece("cycle").cast("int"))
            found = files.select(piece("source").alias("id_source"), init.alias("init"), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("modificationTime").alias("modified"), F.col("length").alias("size_bytes"), F.lit(complete).alias("complete"))
            if part == "cells":
                found = found.groupBy("id_source", "init").agg(F.lit("").alias("name"), F.max("modified").alias("modified"), F.lit(0).cast("long").alias("size_bytes"), F.lit(0).alias("complete"))
                found = found.join(kept(out).select("id_source", "init").distinct(), ["id_source", "init"], "left_anti")
            out = out.unionByName(found)
    return out


def run_inventory(spark: SparkSession, root: str) -> DataFrame:
    """(id_source, init, signature, newest): what is stored of each run; no signature until it is finished."""
    part = F.struct("name", F.unix_micros("modified").alias("modified"), F.col("size_bytes").alias("size"))
    found = stored_runs(spark, root).groupBy("id_source", "init").agg(F.min("complete").alias("whole"), F.to_json(F.sort_array(F.collect_set(part))).alias("signature"), F.max("modified").alias("newest"))  # the few files of a run
    return found.select("id_source", "init", F.when(F.col("whole") == 1, F.col("signature")).alias("signature"), "newest")


def declared_definitions(meta: DataFrame) -> DataFrame:
    """(source, init, name, base, level, attrs) of declared variables, those with levels once a level; cells are not read."""
    level = level_label(F.col("coordinate"))
    each = meta.filter(F.col("variable").isNotNull() & ~F.col("variable").isin(*COORDINATES)).select("source", init_time(F.col("init_date"), F.col("cycle")).alias("init"), F.col("variable").alias("base"), F.col("attributes").alias("attrs"), F.explode_outer("levels").alias("coordinate"))
    return each.select("source", "init", F.when(level.isNull(), F.col("base")).otherwise(F.concat("base", F.lit("_"), level)).alias("name"), "base", level.alias("level"), "attrs")
