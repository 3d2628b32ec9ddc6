"""Scalar expressions of the forecast operators, all of them built-in columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wrap_longitude(longitude: Column) -> Column:
    """Degrees east in [-180, 180)."""
    return F.pmod(longitude + 180, F.lit(360.0)) - 180


def snap_decimals(x: Column, digits: int = 6) -> Column:
    """x rounded half to even, as coordinates are before they become keys."""
    return F.rint(x * 10**digits) / 10**digits


def snap_grid(x: Column, resolution: float) -> Column:
    return F.rint(x / resolution) * resolution


def step_type(x: Column) -> Column:
    """An absent step type means instant."""
    return F.coalesce(F.nullif(x, F.lit("")), F.lit("instant"))


def valid_time(init_date: Column, cycle: Column, step_hours: Column) -> Column:
    """init + step, without a time zone."""
    return init_date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), cycle + step_hours)


def init_time(init_date: Column, cycle: Column) -> Column:
    """The day and cycle of a run as one time, without a time zone: what tells runs of one day apart."""
    return valid_time(init_date, cycle, F.lit(0))


def content_hash(content: Column) -> Column:
    """What files are compared by."""
    return F.sha2(content, 256)


def is_close(a: Column, b: Column, relative: float = 1e-5, absolute: float = 1e-8) -> Column:
    return F.abs(a - b) <= absolute + relative * F.abs(b)


def missing_as_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def level_label(level: Column) -> Column:
    """A level as catalogs name it: a whole number without point, else the shortest decimal."""
    whole = level == F.floor(level)
    return F.when(whole, level.cast("bigint").cast("string")).otherwise(level.cast("string"))


#: Rain parameters, whose plain name means 24 hours.
RAIN = ("tpg1", "tpg5", "tpg10", "tpg20", "tpg25", "tpg50", "tpg100")


def event_name(param: Column, statistic: Column, hours: Column) -> Column:
    daily = (param.isin(*RAIN) | param.startswith("10fgg")) & (hours == 24)
    return F.when((hours == 0) | daily, param).otherwise(F.concat(param, F.lit("_"), statistic, hours.cast("string"), F.lit("h")))


#: What a parameter's name says of its event: pattern, number (None: the last group of the pattern), unit, comparison.
EVENTS = (
    (r"^tpg(\d+)$", None, "mm", "gt"),
    (r"^10(?:fgg|spg)(\d+)$", None, "m s-1", "gt"),
    (r"^2tl273$", 273.15, "K", "lt"),
    (r"^tpl01$", 0.1, "mm", "lt"),
    (r"^tprg(\d+)$", None, "mm day-1", "gt"),
    (r"^tprl(\d+)$", None, "mm day-1", "lt"),
)


def event_threshold(param: Column) -> Column:
    """(threshold, units, comparison) of an event parameter, null for an unknown one."""
    found = []
    for pattern, number, unit, comparison in EVENTS:
        value = F.lit(number) if number is not None else F.nullif(F.regexp_extract(param, pattern, 1), F.lit("")).try_cast("double")
        made = F.struct(value.alias("threshold"), F.lit(unit).alias("units"), F.lit(comparison).alias("comparison"))
        found.append(F.when(param.rlike(pattern), made))
    return F.coalesce(*found)
