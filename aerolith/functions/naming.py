"""Variable names by source and level type, from a small table of rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scalars import step_type

RULE_SCHEMA = "source string, type_of_level string, rule string, unit string, renames map<string,string>, instant_renames map<string,string>"

# The rule of each level type. Entries: rule, and for some the
# base names that change first, and those that change for instant fields.
GFS = {
    "heightAboveGround": ("height",),
    "isobaricInhPa": ("pressure",),
    "surface": ("suffix", {}, {"t": "t_sfc"}),
    "atmosphere": ("suffix",),
    "atmosphereSingleLayer": ("passthrough",),
    "meanSea": ("passthrough",),
    "highCloudLayer": ("prefix",),
    "middleCloudLayer": ("prefix",),
    "lowCloudLayer": ("prefix",),
    "convectiveCloudLayer": ("suffix", {"tcc": "tcc_conv"}),
    "boundaryLayerCloudLayer": ("suffix", {"tcc": "tcc_bl"}),
}
ECMWF = {
    "heightAboveGround": ("height",),
    "isobaricInhPa": ("pressure",),
    "surface": ("suffix",),
    "entireAtmosphere": ("suffix",),
    "meanSea": ("passthrough",),
    "highCloudLayer": ("prefix",),
    "mediumCloudLayer": ("prefix",),
    "lowCloudLayer": ("prefix",),
    "mostUnstableParcel": ("passthrough",),
    "nominalTop": ("suffix",),
}
GRAPHCAST = {
    "heightAboveGround": ("height",),
    "isobaricInhPa": ("pressure",),
    "meanSea": ("passthrough",),
    "surface": ("suffix", {"unknown": "tp"}),
}
ICON = {
    "heightAboveGround": ("height",),
    "isobaricLayer": ("passthrough",),
    "meanSea": ("passthrough",),
    "surface": ("suffix",),
    "generalVerticalLayer": ("passthrough",),
    "generalVertical": ("passthrough",),
    "heightAboveSea": ("passthrough",),
}
SOURCES = {
    "gfs-0p25": GFS,
    "aifs-single": ECMWF,
    "ifs-hres": ECMWF,
    "ifs-hres-0p1": ECMWF,
    "ec_cams": ECMWF,
    "graphcast": GRAPHCAST,
    "graphcastgfs": GRAPHCAST,
    "graphcast-sfc": GRAPHCAST,
    "graphcast-pres": GRAPHCAST,
    "dwd-icon": ICON,
}


def rules(spark: SparkSession, sources: dict[str, dict] | None = None) -> DataFrame:
    """The rule table: a row a source and level type."""
    rows = [(source, level, entry[0], "m" if entry[0] == "height" else None, (entry[1:2] or ({},))[0], (entry[2:3] or ({},))[0]) for source, table in (sources or SOURCES).items() for level, entry in table.items()]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def check_rules(table: DataFrame) -> DataFrame:
    """Pairs of source and level type that have more than one rule; none in a valid table."""
    return table.groupBy("source", "type_of_level").count().filter("count > 1")


def list_sources(table: DataFrame) -> DataFrame:
    return table.select("source").distinct().orderBy("source")


def apply_rules(messages: DataFrame, table: DataFrame) -> DataFrame:
    """messages with variable, pressure_level and handled.

    A row's rule is that of its source and level type; without one the name
    passes through and handled is false. The rule table is a few hundred rows
    at most (a source has at most a dozen level types) and is broadcast.
    """
    name, level, kind = F.col("short_name"), F.col("level"), F.col("rule")
    step = step_type(F.col("step_type"))
    late = F.when(step == "instant", F.lit("")).otherwise(F.concat(F.lit("_"), step))
    base = F.coalesce(F.try_element_at("renames", name), name)
    height = F.concat(F.when(name.rlike(r"\d+[a-z]*$"), name).otherwise(F.concat(name, F.coalesce(level, F.lit(0.0)).cast("int").cast("string"), F.col("unit"))), late)
    suffix = F.when(step == "instant", F.coalesce(F.try_element_at("instant_renames", base), base)).otherwise(F.concat(base, late))
    variable = F.when(kind == "height", height).when(kind == "suffix", suffix).when(kind == "prefix", F.regexp_replace(name, "^(avg|max|min)_(.*)$", "$2_$1")).otherwise(name)
    joined = messages.join(F.broadcast(table), ["source", "type_of_level"], "left")
    out = joined.withColumn("variable", variable).withColumn("pressure_level", F.when(kind == "pressure", level)).withColumn("handled", kind.isNotNull())
    return out.select(*messages.columns, "variable", "pressure_level", "handled")


def with_extra_level(named: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """named with extra_level: the level where a cube has more than one that neither its name nor pressure_level holds, else null.

    The cubes with several levels are an aggregation, joined back null-safely;
    those under a height or pressure rule are not among them. ``headers``, a row
    a cube or a few after ``apply_rules``, spare a second look at the cells.
    """
    cube = [c for c in ("source", "init_date", "cycle", "type_of_level", "step_type", "short_name") if c in named.columns]
    free = (named if headers is None else headers).filter(~F.col("type_of_level").eqNullSafe("heightAboveGround") & F.col("pressure_level").isNull())
    several = free.groupBy(*cube).agg(F.count_distinct("level").alias("n"), F.max(F.col("level").isNull().cast("int")).alias("bare")).filter("n + bare > 1").drop("n", "bare").withColumn("several", F.lit(True))
    joined = named.join(several, [named[c].eqNullSafe(several[c]) for c in cube], "left")
    return joined.select(named["*"], F.when(F.col("several"), named["level"]).alias("extra_level"))


def drop_level_columns(named: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """named without the columns that its names now hold, and without others that a product does not have."""
    return named.drop("level", "type_of_level", "step_type", "short_name", "handled", *more)


def unhandled(named: DataFrame) -> DataFrame:
    """Level types without a rule, with the number of rows that passed through."""
    return named.filter(~F.col("handled")).groupBy("source", "type_of_level").agg(F.count("*").alias("n"))


def collisions(named: DataFrame) -> DataFrame:
    """Names that unlike inputs of one init and level share: how many inputs give each."""
    inputs = F.struct("type_of_level", F.when(F.col("pressure_level").isNull(), F.col("level")).alias("level"), "short_name")
    found = named.groupBy("source", "init_date", "cycle", "variable", "pressure_level").agg(F.count_distinct(inputs).alias("n_inputs"))
    return found.filter("n_inputs > 1")
