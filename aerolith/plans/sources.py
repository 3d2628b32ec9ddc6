"""Sources and what is particular to each: how its records are regridded, cropped, named and checked."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fields import crop, nearest_cell, regrid, target_grid
from ..operators.probability import forecast_only
from .pipeline import Hook, build_product


@dataclass(frozen=True)
class Source:
    """A source by the name that its manifests give, and its hooks, as ``build_product`` has them.

    ``contract`` gets the product and the manifests of the source's runs and
    returns violations.
    """

    name: str
    regrid: Hook | None = None
    crop: Hook | None = None
    names: DataFrame | None = None
    check: Hook | None = None
    contract: Callable[[DataFrame, DataFrame], DataFrame] | None = None


class Sources:
    """A registry: a name is taken once, and an unknown one is an error that tells the known ones."""

    def __init__(self, *sources: Source):
        self._known: dict[str, Source] = {}
        for s in sources:
            self.register(s)

    def register(self, source: Source) -> Source:
        if source.name in self._known:
            raise ValueError(f"source {source.name!r} is registered already")
        self._known[source.name] = source
        return source

    def __getitem__(self, name: str) -> Source:
        if name not in self._known:
            raise KeyError(f"unknown source {name!r}; known are {', '.join(self.names()) or 'none'}")
        return self._known[name]

    def names(self) -> list[str]:
        return sorted(self._known)

    def build(self, raw: DataFrame, west: float, east: float, south: float, north: float, headers: DataFrame | None = None, refuse: bool = False) -> DataFrame:
        """The products of all registered sources in one plan, each built with its own hooks.

        A branch reads its own source's records only, and all of them run
        together. Records of a source that is not registered are an error when
        the product is read.
        """
        names = self.names()
        other = raw.filter(F.col("source").isNull() | ~F.col("source").isin(*names))
        unknown = F.raise_error(F.concat(F.lit("unknown source "), F.coalesce("source", F.lit("null")), F.lit(f"; known are {', '.join(names)}")))
        branches = []
        for s in map(self.__getitem__, names):
            own = raw.filter(F.col("source") == s.name)
            heads = None if headers is None else headers.filter(F.col("source") == s.name)
            branches.append(build_product(own, west, east, south, north, refuse, heads, s.names, s.regrid, s.crop, s.check))
        product = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)
        lost = other.select(unknown.cast("string").alias("source"))
        return product.unionByName(lost, allowMissingColumns=True)

    def violations(self, product: DataFrame, manifests: DataFrame) -> DataFrame | None:
        """What the contracts of all sources find; None if no source has one."""
        found = [s.contract(product.filter(F.col("source") == s.name), manifests.filter(F.col("source") == s.name)) for s in map(self.__getitem__, self.names()) if s.contract]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found) if found else None


def boxed(name: str, west: float, east: float, south: float, north: float) -> Source:
    """A source that comes cropped to a box of its own."""
    return Source(name, crop=lambda cells: crop(cells, west, east, south, north))


def unstructured(spark: SparkSession, name: str, grid: str, cells: DataFrame, box: tuple[float, float, float, float], resolution: float, remaps: str | None = None) -> Source:
    """A source on a grid of cells (cell_id, clat, clon): its records take the nearest cell's value at each point of a regular grid.

    The pairs are searched once for a grid, box and resolution and kept in the folder ``remaps``.
    """
    remap = stored_remap(spark, remaps, grid, cells, box, resolution) if remaps else nearest_cell(cells, target_grid(spark, *box, resolution))
    return Source(name, regrid=lambda records: regrid(records, remap))


def composition(name: str) -> Source:
    """A source of atmospheric composition: forecasts only."""
    return Source(name, regrid=forecast_only)


def stored_remap(spark: SparkSession, root: str, grid: str, cells: DataFrame, box: tuple[float, float, float, float], resolution: float) -> DataFrame:
    """(tlat, tlon, cell_id, distance) of a named grid, box and resolution: read from ``root`` if it was ever searched, else searched and stored.

    A table counts once it was written whole.
    """
    from ..sources.shared import exists

    place = f"{root}/grid={grid}/box={'_'.join(f'{x:g}' for x in box)}/resolution={resolution:g}"
    if not exists(spark, f"{place}/_SUCCESS"):
        nearest_cell(cells, target_grid(spark, *box, resolution), strict=True).write.mode("overwrite").parquet(place)
    return spark.read.parquet(place)
