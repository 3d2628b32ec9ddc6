"""From raw records to a product, as one logical plan for any number of inits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import apply_rules, rules, with_extra_level
from ..operators.fields import latest_in_box, merge, slabs, with_step, with_valid_time
from ..sources.products import without_nan

Hook = Callable[[DataFrame], DataFrame]


def build_product(raw: DataFrame, west: float, east: float, south: float, north: float, refuse: bool = False, headers: DataFrame | None = None, names: DataFrame | None = None, regrid: Hook | None = None, crop: Hook | None = None, check: Hook | None = None) -> DataFrame:
    """Crop, keep the latest pass of each step, name, merge, and add the valid time.

    Every key begins with (source, init_date, cycle); crops come before the
    first shuffle of cells. ``headers``, if there are any, tell the latest
    passes without a look at cells. Levels that no name holds stay apart as
    extra_level. Cells with n_values above 1 are conflicts: the product reports
    them in that column, and with ``refuse`` reading one is an error.

    Hooks of a source: ``regrid`` brings its records to latitude and longitude,
    ``crop`` takes the place of the box, ``names`` is its table of rules, and
    ``check`` gets the product before it is returned and may raise or add to it.
    """
    cells = with_step(without_nan(regrid(raw) if regrid else raw))
    cells = crop(cells) if crop else cells
    headers = slabs(cells) if headers is None else headers
    table = rules(raw.sparkSession) if names is None else names
    latest = latest_in_box(cells, headers, *((-180.0, 360.0, -90.0, 90.0) if crop else (west, east, south, north)))
    product = with_valid_time(merge(with_extra_level(apply_rules(latest, table), apply_rules(headers, table))))
    conflict = F.raise_error(F.concat(F.lit("unlike values of "), F.col("variable"))).cast("double")
    product = product.withColumn("value", F.when(F.col("n_values") > 1, conflict).otherwise(F.col("value"))) if refuse else product
    return check(product) if check else product
