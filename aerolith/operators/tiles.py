"""Chunk layout of a product and whether every chunk of it is there."""

from __future__ import annotations

from functools import reduce
from operator import mul

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

INIT = ["source", "init_date", "cycle"]
TILES = ["tile_step", "tile_level", "tile_latitude", "tile_longitude"]


def _ranked(product: DataFrame, axis: str, size: int | None) -> DataFrame:
    """(init, axis, tile): the tile of each coordinate of an axis; no size, -1 or 0 means one tile."""
    points = product.select(*INIT, axis).distinct()
    rank = F.row_number().over(Window.partitionBy(*INIT).orderBy(axis)) - 1
    return points.withColumn(f"tile_{axis}", F.floor(rank / size).cast("int") if size and size > 0 else F.lit(0))


def to_tiles(product: DataFrame, latitude: int | None = 64, longitude: int | None = 64, step: int | None = None, level: int | None = None, axes: DataFrame | None = None) -> DataFrame:
    """product with tile_latitude and tile_longitude, and tile_step and tile_level if a size is given for them.

    The axes of an init are small beside its cells. ``axes`` (INIT, latitude,
    longitude, step_hours, pressure_level) declares them, for instance from
    headers; else they are those of the product, which is then read once more
    an axis.
    """
    of = product if axes is None else axes
    out = product.join(_ranked(of, "latitude", latitude), [*INIT, "latitude"]).join(_ranked(of, "longitude", longitude), [*INIT, "longitude"])
    if step:
        out = out.join(_ranked(of, "step_hours", step).withColumnRenamed("tile_step_hours", "tile_step"), [*INIT, "step_hours"])
    if level:
        levels = _ranked(of.filter("pressure_level IS NOT NULL"), "pressure_level", level).withColumnRenamed("tile_pressure_level", "tile_level")
        out = out.join(levels, [*INIT, "pressure_level"], "left")
    return out


def tile_series(tiled: DataFrame) -> DataFrame:
    """One row a tile and variable with all its values in order: what a region series reads."""
    keys = [*INIT, "variable", "pressure_level", *(c for c in ("extra_level", "tile_step", "tile_level") if c in tiled.columns), "tile_latitude", "tile_longitude"]
    return tiled.groupBy(*keys).agg(F.count_distinct("latitude", "longitude").alias("n_cells"), F.array_sort(F.collect_list(F.struct("step_hours", "latitude", "longitude", "value"))).alias("series"))


def declared_tiles(n_latitude: int, n_longitude: int, latitude: int, longitude: int) -> int:
    """Tiles of a grid of so many points in tiles of such a size."""
    return -(-n_latitude // latitude) * -(-n_longitude // longitude)


def completeness(tiled: DataFrame, strict: bool = False, declared: int | None = None) -> DataFrame:
    """(init, variable, n_written, n_expected) of variables whose tiles are not all there, over all axes that tiled has tiles of.

    A tile is written if it has a present value. The lenient form leaves out
    variables without any; the strict form reports them too. ``declared`` is the
    number of tiles of the declared grid; without it the tiles found say how
    many there are, so a last row or column that all variables lack goes unseen.
    Only variables with levels have tiles of levels. ``missing_tiles`` names the
    tiles and knows each variable's declared shape.
    """
    axes = [c for c in TILES if c in tiled.columns]
    levelled = F.max(F.col("tile_level").isNotNull()) if "tile_level" in axes else F.lit(False)
    flat = [c for c in axes if c != "tile_level"]
    most = tiled.groupBy(*INIT).agg(reduce(mul, (F.max(c) + 1 for c in flat)).cast("long").alias("n_flat"), (F.coalesce(F.max("tile_level"), F.lit(0)) + 1 if "tile_level" in axes else F.lit(1)).alias("n_level"))
    tile = F.when(F.col("value").isNotNull(), F.struct(*axes))
    written = tiled.groupBy(*INIT, "variable").agg(F.count_distinct(tile).alias("n_written"), levelled.alias("levelled"))
    expected = (F.col("n_flat") * F.when(F.col("levelled"), F.col("n_level")).otherwise(1)).cast("long")
    joined = written.join(most, INIT).withColumn("n_expected", expected if declared is None else F.lit(declared).cast("long")).drop("levelled", "n_flat", "n_level")
    return joined.filter((F.col("n_written") < F.col("n_expected")) & ((F.col("n_written") > 0) | F.lit(strict)))


def expected_tiles(shape: DataFrame, variables: DataFrame, latitude: int | None = 64, longitude: int | None = 64, step: int | None = None, level: int | None = None) -> DataFrame:
    """The tile index: every (INIT, variable, tile_step, tile_level, tile_latitude, tile_longitude) that a declared shape implies.

    shape: INIT, n_latitude, n_longitude, n_step, n_level, points of the axes of
    a run; variables: INIT, variable, levelled. tile_level is null where a
    variable has no levels. A row a tile, so the index is to the cells what one
    is to the cells of a tile.
    """
    sizes = {"step": step, "level": level, "latitude": latitude, "longitude": longitude}
    last = {a: (F.ceil(F.col(f"n_{a}") / size) if size and size > 0 else F.lit(1)) - 1 for a, size in sizes.items()}
    out = variables.select(*INIT, "variable", "levelled").join(shape, INIT)
    for axis in sizes:
        numbers = F.sequence(F.lit(0), last[axis].cast("int"))
        numbers = F.when(F.col("levelled"), numbers).otherwise(F.array(F.lit(None).cast("int"))) if axis == "level" else numbers
        out = out.withColumn(f"tile_{axis}", F.explode(numbers))
    return out.select(*INIT, "variable", *TILES)


def missing_tiles(stored: DataFrame, expected: DataFrame, strict: bool = True) -> DataFrame:
    """Tiles of the index without a present value in ``stored`` (INIT, variable, tiles, value); the lenient form leaves out variables that have none at all."""
    present = stored.filter(F.col("value").isNotNull())
    keys = [*INIT, "variable", *TILES]
    marked = lambda f: f.withColumn("of_level", F.coalesce("tile_level", F.lit(-1)))  # noqa: E731  a key that equals itself
    on = [c if c != "tile_level" else "of_level" for c in keys]
    out = marked(expected).join(marked(present.select(*keys)).select(*on).distinct(), on, "left_anti").select(*keys)
    return out if strict else out.join(present.select(*INIT, "variable").distinct(), [*INIT, "variable"], "left_semi")


def undeclared(product: DataFrame, variables: list[str]) -> DataFrame:
    """(init, variable) that a product holds and that are not among the declared ones."""
    return product.filter(~F.col("variable").isin(*variables)).select(*INIT, "variable").distinct()
