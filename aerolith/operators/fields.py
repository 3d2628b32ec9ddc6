"""Grid-point operators: cropping, the authoritative pass of a step, merging, regridding.

Tables are in long form, one row a grid point. A cube is the rows of one
(source, init_date, cycle, type_of_level, level, step_type, short_name).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import snap_decimals, step_type, valid_time, wrap_longitude
from ..sources.shared import kept

INIT = ["source", "init_date", "cycle"]
CUBE = [*INIT, "type_of_level", "level", "step_type", "short_name"]


def check_box(west: float, east: float, south: float, north: float) -> None:
    if not (-180 <= west < east <= 360 and -90 <= south < north <= 90):
        raise ValueError("a box needs -180 <= west < east <= 360 and -90 <= south < north <= 90")


def crop(cells: DataFrame, west: float, east: float, south: float, north: float, cube: list[str] = CUBE) -> DataFrame:
    """Rows inside the box, bounds included, with longitudes wrapped in cubes that go beyond 180.

    Whether a cube is wrapped depends on its greatest longitude: an aggregation
    to one row a cube, joined back; Spark broadcasts it while it is small.
    """
    check_box(west, east, south, north)
    # Latitudes do not depend on the cube, so they are cut before the join, wrapped or not.
    wide = cells.groupBy(*cube).agg(F.max("longitude").alias("east_most"))
    near = cells.filter(F.col("latitude").between(south, north))
    keys = [near[c].eqNullSafe(wide[c]) for c in cube]
    joined = near.join(wide, keys).select(near["*"], "east_most")
    moved = joined.withColumn("longitude", F.when(F.col("east_most") > 180, wrap_longitude(F.col("longitude"))).otherwise(F.col("longitude")))
    return moved.filter(F.col("longitude").between(west, east)).drop("east_most")


def slabs(cells: DataFrame) -> DataFrame:
    """A row a cube and step: best, its latest pass, and east_most, its cube's greatest longitude.

    This is what file headers say; where there is a table of headers, it gives
    the same rows without reading cells.
    """
    found = cells.groupBy(*CUBE, "step_hours").agg(F.max("file_step_hours").alias("best"), F.max("longitude").alias("east"))
    return found.select(*CUBE, "step_hours", "best", F.max("east").over(Window.partitionBy(*CUBE)).alias("east_most"))


def header_slabs(headers: DataFrame) -> DataFrame:
    """``slabs`` from headers (CUBE, step_hours, file_step_hours, east), a row a message: no cells are needed."""
    found = headers.groupBy(*CUBE, "step_hours").agg(F.max("file_step_hours").alias("best"), F.max("east").alias("east"))
    return found.select(*CUBE, "step_hours", "best", F.max("east").over(Window.partitionBy(*CUBE)).alias("east_most"))


def needed_messages(headers: DataFrame, west: float, east: float, south: float, north: float) -> DataFrame:
    """Of headers (path, msg_no, CUBE, step_hours, file_step_hours, west, east, south, north) those whose cells a product of the box can need.

    These are the messages of the latest pass of each step that meet the box;
    files that only hold earlier passes, or nothing of the box, have none.
    """
    check_box(west, east, south, north)
    best = header_slabs(headers)
    joined = headers.join(best, [headers[c].eqNullSafe(best[c]) for c in [*CUBE, "step_hours"]]).select(headers["*"], "best", "east_most").filter(F.col("file_step_hours").eqNullSafe(F.col("best")))
    # A cube that goes beyond 180 is wrapped: what lies east of it comes from the west, and a message across it meets any box.
    wrapped = F.col("east_most") > 180
    low = F.when(wrapped, F.when(F.col("west") > 180, F.col("west") - 360).when(F.col("east") > 180, F.lit(-180.0)).otherwise(F.col("west"))).otherwise(F.col("west"))
    high = F.when(wrapped, F.when(F.col("west") > 180, F.col("east") - 360).when(F.col("east") > 180, F.lit(180.0)).otherwise(F.col("east"))).otherwise(F.col("east"))
    meets = (low <= east) & (high >= west) & (F.col("south") <= north) & (F.col("north") >= south)
    return joined.filter(meets).select(*headers.columns)


def latest_in_box(cells: DataFrame, headers: DataFrame, west: float, east: float, south: float, north: float) -> DataFrame:
    """``crop`` and ``authoritative`` in one pass over the cells, which meet the small table of their ``slabs`` once.

    A slab's latest pass is chosen before the crop, so it wins also where none
    of its cells lies in the box.
    """
    check_box(west, east, south, north)
    slab = [*CUBE, "step_hours"]
    near = cells.filter(F.col("latitude").between(south, north))
    joined = near.join(headers, [near[c].eqNullSafe(headers[c]) for c in slab]).select(near["*"], "best", "east_most").filter(F.col("file_step_hours").eqNullSafe(F.col("best")))
    moved = joined.withColumn("longitude", F.when(F.col("east_most") > 180, wrap_longitude(F.col("longitude"))).otherwise(F.col("longitude")))
    return _last_messages(moved.filter(F.col("longitude").between(west, east)))


def _last_messages(cells: DataFrame) -> DataFrame:
    """Of rows of one cell of a slab that with the highest msg_no, of ties the greatest value."""
    slab = [*CUBE, "step_hours"]
    last = cells.groupBy(*slab, "latitude", "longitude").agg(F.max(F.struct("msg_no", "value")).alias("last"))
    return last.select(*slab, "latitude", "longitude", "last.msg_no", "last.value")


def with_step(cells: DataFrame) -> DataFrame:
    """cells with a step: static fields come without one and have null."""
    return cells if "step_hours" in cells.columns else cells.withColumn("step_hours", F.lit(None).cast("int"))


def steps(product: DataFrame) -> DataFrame:
    """How many steps each variable of an init has, the first and the last."""
    return product.groupBy(*INIT, "variable").agg(F.count_distinct("step_hours").alias("n_steps"), F.min("step_hours").alias("first_step"), F.max("step_hours").alias("last_step"))


def canonical_lead(messages: DataFrame) -> DataFrame:
    """messages with ``reject_reason``: a bad file name, no step, or a preview of another step; null for those to keep."""
    own = F.regexp_extract("file_name", r"^f(\d+)\.subset\.grib2$", 1)
    lead = F.nullif(own, F.lit("")).cast("int")
    reason = F.when(lead.isNull(), "bad file name").when(F.col("step_hours").isNull(), "no step").when(lead != F.col("step_hours"), "preview")
    return messages.withColumn("lead_hours", lead).withColumn("reject_reason", reason)


def cube_level_type(messages: DataFrame, cube: str = "cube") -> DataFrame:
    """The level type of each cube: that of its first message that has one, else unknown."""
    named = F.nullif("type_of_level", F.lit(""))
    first = F.min(F.when(named.isNotNull(), F.struct("msg_no", named.alias("kind"))))
    return messages.groupBy(cube).agg(F.coalesce(first["kind"], F.lit("unknown")).alias("type_of_level"))


def authoritative(cells: DataFrame) -> DataFrame:
    """Of slabs that share a step, the rows of the latest pass.

    The winner is chosen on slabs (the greatest file_step_hours of a cube's
    step) and joined back, so a later slab wins even where its cells are
    missing; of rows of one cell within it the highest msg_no stays. Nulls are
    values like others here: static fields have no step, and a slab without any
    file_step_hours keeps its rows.
    """
    slab = [*CUBE, "step_hours"]
    best = cells.groupBy(*slab).agg(F.max("file_step_hours").alias("best"))
    keys = [cells[c].eqNullSafe(best[c]) for c in slab]
    joined = cells.join(best, keys).select(cells["*"], "best").filter(F.col("file_step_hours").eqNullSafe(F.col("best")))
    return _last_messages(joined)


def merge(named: DataFrame) -> DataFrame:
    """One row a cell of each variable and, where there is one, extra_level, from all buckets.

    n_values is 0 without a value, 1 with one, and 2 if unlike values met, a
    conflict; least and greatest tell that in one shuffle.
    """
    extra = [c for c in ("extra_level",) if c in named.columns]
    keys = [*INIT, "variable", "pressure_level", *extra, "step_hours", "latitude", "longitude"]
    return named.groupBy(*keys).agg(F.max("value").alias("value"), F.when(F.count("value") == 0, 0).when(F.max("value") == F.min("value"), 1).otherwise(2).cast("long").alias("n_values"))


def combine_parts(surface: DataFrame, pressure: DataFrame, strict: bool = False) -> DataFrame:
    """The full state of an init from two products: their rows under one key; what one lacks stays missing.

    With ``strict`` a cell that both have is one row, and reading it is an
    error if they have unlike values.
    """
    both = surface.unionByName(pressure, allowMissingColumns=True)
    if not strict:
        return both
    keys = [c for c in both.columns if c not in ("value", "n_values")]
    clash = F.raise_error(F.concat(F.lit("unlike parts of "), F.col("variable"))).cast("double")
    return both.groupBy(*keys).agg(F.when(F.min("value") != F.max("value"), clash).otherwise(F.max("value")).alias("value"))


def in_order(product: DataFrame) -> DataFrame:
    """A product as readers want it: by init, variable and level, then step, latitude and longitude upward."""
    return product.orderBy(*INIT, "variable", *(c for c in ("pressure_level", "extra_level") if c in product.columns), "step_hours", "latitude", "longitude")


def with_valid_time(product: DataFrame) -> DataFrame:
    return product.withColumn("valid_time", valid_time(F.col("init_date"), F.col("cycle"), F.col("step_hours")))


def region(product: DataFrame, variables: list[str], south: float, north: float, west: float, east: float, pressure_level: float | None = None) -> DataFrame:
    """All steps of some variables in a box: filters only, which reach the partitions and row groups of a stored product."""
    out = product.filter(F.col("variable").isin(*variables) & F.col("latitude").between(south, north) & F.col("longitude").between(west, east))
    return out if pressure_level is None else out.filter(F.col("pressure_level") == pressure_level)


def wide(product: DataFrame, variables: list[str]) -> DataFrame:
    """A column a variable, a row a cell and step and, where there is one, extra_level."""
    extra = [c for c in ("extra_level",) if c in product.columns]
    return product.groupBy(*INIT, *extra, "step_hours", "latitude", "longitude").pivot("variable", variables).agg(F.max("value"))


def step_gaps(product: DataFrame, interval: int) -> DataFrame:
    """Steps of a variable that do not follow the one before by ``interval`` hours."""
    keys = [*INIT, "variable"]
    steps = product.select(*keys, "step_hours").distinct()
    before = F.lag("step_hours").over(Window.partitionBy(*keys).orderBy("step_hours"))
    return steps.withColumn("previous_step", before).filter(F.col("step_hours") - F.col("previous_step") != interval)


def axis_check(product: DataFrame, axis: str, spacing: float, tolerance: float = 1e-5) -> DataFrame:
    """A row an init: points of an axis, its least and greatest difference, and whether it is regular at ``spacing``."""
    points = product.select(*INIT, F.col(axis).alias("x")).filter(F.col("x").isNotNull()).distinct()
    gap = F.col("x") - F.lag("x").over(Window.partitionBy(*INIT).orderBy("x"))
    found = points.withColumn("gap", gap).groupBy(*INIT).agg(F.count("*").alias("n_points"), F.min("gap").alias("least_gap"), F.max("gap").alias("greatest_gap"))
    regular = (F.col("n_points") >= 2) & (F.abs(F.col("least_gap") - spacing) <= tolerance) & (F.abs(F.col("greatest_gap") - spacing) <= tolerance)
    return found.withColumn("regular", F.coalesce(regular, F.lit(False)).cast("int"))


def coordinate_union(cells: DataFrame, axis: str) -> DataFrame:
    return cells.select(*INIT, axis).distinct()


def bucket_signature(named: DataFrame) -> DataFrame:
    """Cubes by the variables they hold: a signature a cube, and how many cubes share it."""
    cube = [*INIT, "type_of_level", "step_type", "step_hours"]
    signed = named.groupBy(*cube).agg(F.concat_ws(",", F.array_sort(F.collect_set("variable"))).alias("variables"), F.max(F.col("pressure_level").isNotNull().cast("int")).alias("levelled"))
    return signed.groupBy("source", "variables", "levelled").agg(F.count("*").alias("n_cubes"))


def product_summary(product: DataFrame) -> DataFrame:
    return product.groupBy(*INIT).agg(F.count_distinct("variable").alias("n_variables"), F.count_distinct("step_hours").alias("n_steps"), F.min("latitude").alias("south"), F.max("latitude").alias("north"), F.min("longitude").alias("west"), F.max("longitude").alias("east"))


def step_types(messages: DataFrame) -> DataFrame:
    """messages with the step type filled in, as it splits cubes."""
    return messages.withColumn("step_type", step_type(F.col("step_type")))


def target_grid(spark, west: float, east: float, south: float, north: float, resolution: float) -> DataFrame:
    """Points (tlat, tlon) of a regular grid, both ends included, rounded to 6 decimals."""
    rows = spark.range(int(math.floor((north - south) / resolution + 0.5)) + 1).select(snap_decimals(F.lit(south) + F.col("id") * resolution).alias("tlat"))
    columns = spark.range(int(math.floor((east - west) / resolution + 0.5)) + 1).select(snap_decimals(F.lit(west) + F.col("id") * resolution).alias("tlon"))
    return rows.crossJoin(columns)  # the grid itself


def _on_sphere(frame: DataFrame, latitude: str, longitude: str, prefix: str) -> DataFrame:
    lat, lon = F.radians(latitude), F.radians(longitude)
    return frame.withColumns({f"{prefix}x": F.cos(lat) * F.cos(lon), f"{prefix}y": F.cos(lat) * F.sin(lon), f"{prefix}z": F.sin(lat)})


def _chord() -> F.Column:
    """Squared chord, rounded to 12 digits so that ties are ties."""
    return F.round(sum(((F.col(f"t{a}") - F.col(f"c{a}")) ** 2 for a in "xyz"), F.lit(0.0)), 12)


def nearest_cell(cells: DataFrame, targets: DataFrame, bucket: float = 1.0, margin: float = 1.0, strict: bool = False) -> DataFrame:
    """(tlat, tlon, cell_id, distance): the nearest cell of each target by chord, the lowest id of ties.

    Targets meet the cells of the 3 x 3 buckets around them by an equi-join. An
    answer counts if it is nearer than any cell outside these buckets can be;
    targets without such an answer go on to buckets four times as wide, until
    nine of them cover all candidates, those in the targets' box and a margin.
    A target keeps its row if there is no candidate at all; with ``strict``
    reading it is an error.
    """
    box = targets.agg(F.min("tlat"), F.max("tlat"), F.min("tlon"), F.max("tlon")).first()
    if box[0] is None:
        return targets.select("tlat", "tlon", F.lit(None).cast("long").alias("cell_id"), F.lit(None).cast("double").alias("distance"))
    inside = cells.filter(F.col("clat").between(box[0] - margin, box[1] + margin) & F.col("clon").between(box[2] - margin, box[3] + margin))
    inside = _on_sphere(inside, "clat", "clon", "c").select("cell_id", "clat", "clon", "cx", "cy", "cz")
    rest = _on_sphere(targets.select("tlat", "tlon"), "tlat", "tlon", "t")
    extent = max(box[1] - box[0], box[3] - box[2]) + 2 * margin
    out, last = [], False
    while not last:
        last = bucket >= extent  # the buckets around any target then hold all candidates
        met = kept(_around(inside, rest, bucket))
        done = F.lit(last) | F.coalesce(F.col("best.distance") < F.col("reach"), F.lit(False))
        out.append(met.filter(done).select("tlat", "tlon", "best.cell_id", "best.distance"))
        rest, bucket = met.filter(~done).select("tlat", "tlon", "tx", "ty", "tz"), bucket * 4
        last = last or rest.isEmpty()
    found = reduce(DataFrame.unionByName, out)
    lost = F.raise_error(F.concat(F.lit("no cell near "), F.col("tlat"), F.lit(" "), F.col("tlon"))).cast("long")
    return found.withColumn("cell_id", F.coalesce("cell_id", lost)) if strict else found


def _around(inside: DataFrame, aims: DataFrame, bucket: float) -> DataFrame:
    """aims with best (distance, cell_id) among the cells of the 3 x 3 buckets around, and reach: nearer than this is no cell outside them."""
    inside = inside.withColumns({"by": F.floor(F.col("clat") / bucket), "bx": F.floor(F.col("clon") / bucket)})
    aims = aims.withColumns({"ty0": F.floor(F.col("tlat") / bucket), "tx0": F.floor(F.col("tlon") / bucket)})
    near = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    around = aims.withColumn("n", F.explode(near)).withColumns({"by": F.col("ty0") + F.col("n.i"), "bx": F.col("tx0") + F.col("n.j")})
    best = F.min(F.struct("distance", "cell_id")).alias("best")
    found = around.join(inside, ["by", "bx"]).withColumn("distance", _chord()).groupBy("tlat", "tlon").agg(best)
    # The least way out of the block: to its nearest parallel, or to its nearest meridian, which a quarter turn away is no nearer.
    rise = F.radians(F.least(F.col("tlat") - (F.col("ty0") - 1) * bucket, (F.col("ty0") + 2) * bucket - F.col("tlat")))
    run = F.radians(F.least(F.col("tlon") - (F.col("tx0") - 1) * bucket, (F.col("tx0") + 2) * bucket - F.col("tlon"), F.lit(90.0)))
    reach = F.least((2 * F.sin(F.least(rise, F.radians(F.lit(180.0))) / 2)) ** 2, (F.sin(run) * F.cos(F.radians("tlat"))) ** 2)
    return aims.join(found, ["tlat", "tlon"], "left").select("tlat", "tlon", "tx", "ty", "tz", "best", reach.alias("reach"))


def regrid(cells: DataFrame, remap: DataFrame) -> DataFrame:
    """Values of cells by id, moved to the targets that each is nearest to; all other columns stay."""
    return cells.drop("latitude", "longitude").join(remap.select("cell_id", F.col("tlat").alias("latitude"), F.col("tlon").alias("longitude")), "cell_id").drop("cell_id")
