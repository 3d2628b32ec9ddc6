"""Event probabilities: windows, thresholds, contracts, receipts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import RAIN, event_name, event_threshold, is_close, missing_as_null, valid_time

# Parameters of the catalogs, and the ends of multi-day windows.
IFS = ("tpg20", "tpg50", "tpg100", "10fgg15", "10fgg25")
HALF_DAILY = ("2tl273", "10spg10", "10spg15")
MULTI_DAY = {"2tl273": "max", "tpl01": "accum", "tprl1": "avg", "tprg3": "avg", "tprg5": "avg"}
MULTI_DAY_ENDS = {48: (168,), 72: (240,), 120: (240, 360)}


def expected_samples(spark: SparkSession, source: str) -> DataFrame:
    """(variable, step_hours): every window end that a source's catalog promises."""
    daily = F.sequence(F.lit(24), F.lit(360), F.lit(12))
    names = spark.createDataFrame([(p,) for p in (IFS if source == "ifs-ens-probabilities" else RAIN)], "variable string")
    out = names.select("variable", F.explode(daily).alias("step_hours"))
    if source != "ifs-ens-probabilities":
        half = spark.createDataFrame([(p,) for p in HALF_DAILY], "variable string")
        out = out.unionByName(half.select("variable", F.explode(F.sequence(F.lit(12), F.lit(360), F.lit(12))).alias("step_hours")))
        long = spark.createDataFrame([(f"{p}_{statistic}{hours}h", end) for p, statistic in MULTI_DAY.items() for hours, ends in MULTI_DAY_ENDS.items() for end in ends], "variable string, step_hours int")
        out = out.unionByName(long)
    return out


def contract_samples(manifests: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, variable, step_hours): the windows that each run's availability contract promises."""
    available = manifests.select(*keys, F.explode("probability_availability.available_samples").alias("variable", "steps"))
    return available.select(*keys, "variable", F.explode("steps").alias("step_hours"))


def forecast_only(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("data_type").eqNullSafe(F.lit("fc")))


def gate(messages: DataFrame) -> DataFrame:
    """messages with reject_reason: what is not an event probability over whole hours; null for those to keep."""
    reason = (
        F.when(~F.col("data_type").eqNullSafe(F.lit("ep")), "data type")
        .when(~F.col("units").eqNullSafe(F.lit("%")), "units")
        .when(~F.col("step_units").eqNullSafe(F.lit(1)), "step units")
        .when(F.col("start_step").isNull() | F.col("step_hours").isNull() | (F.col("step_hours") < F.col("start_step")), "window")
        .when(~F.coalesce(F.col("template").isin(5, 9), F.lit(False)), "template")
    )
    return messages.withColumn("reject_reason", reason)


def event_columns(messages: DataFrame) -> DataFrame:
    """messages with window_hours, window_start and window_end, variable, threshold, its units and comparison, time_label, and encoding_ok.

    The width and the statistic are part of the name, so windows of one
    parameter never meet. Rates per second are held against thresholds per day.
    The ends of a window are times, where init_date is there (without cycle, of
    the day's first run).
    """
    cycle = F.col("cycle") if "cycle" in messages.columns else F.lit(0)
    at = (lambda c: valid_time(F.col("init_date"), cycle, F.col(c))) if "init_date" in messages.columns else lambda c: F.lit(None).cast("timestamp_ntz")
    hours = F.col("step_hours") - F.col("start_step")
    limit = F.when(F.col("param").startswith("tpr"), F.col("lower_limit") * 86400).otherwise(F.col("lower_limit"))
    out = messages.withColumn("window_hours", hours).withColumn("variable", event_name(F.col("param"), F.col("step_type"), hours)).withColumn("event", event_threshold(F.col("param")))
    right = F.col("prob_type") == F.when(F.col("event.comparison") == "gt", 3).otherwise(0)
    ok = right & is_close(limit, F.col("event.threshold"))
    return out.select(*messages.columns, "window_hours", at("start_step").alias("window_start"), at("step_hours").alias("window_end"), "variable", "event.threshold", F.col("event.units").alias("threshold_units"), "event.comparison", F.when(hours > 0, "window_end").otherwise("instant").alias("time_label"), F.coalesce(ok, F.lit(False)).cast("int").alias("encoding_ok"))


def sample_windows(product: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, variable, step_hours) that have at least one present value; NaN is none."""
    return product.filter(missing_as_null(F.col("value")).isNotNull()).select(*keys, "variable", "step_hours").distinct()


def range_violations(product: DataFrame, keys: list[str]) -> DataFrame:
    """Variables with values below 0, above 100 or infinite, and how many; NaN is a missing value."""
    bad = (F.col("value") < 0) | (missing_as_null(F.col("value")) > 100)
    return product.groupBy(*keys, "variable").agg(F.count_if(bad).alias("n_bad")).filter("n_bad > 0")


def validate(product: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """violations (keys, variable, check, step_hours): windows missing or not expected, values out of range, bounds of windows.

    ``expected`` is (variable, step_hours), one catalog for all runs, a few
    hundred rows, and is broadcast; or it has ``keys`` too and is each run's own
    contract. Bounds are wrong if window_hours is null, not positive or longer
    than the step, unlike that of ``expected``, if it has one, or if valid_time,
    where it is known, is not the window's end.
    """
    at = [*keys, "variable", "step_hours"]
    own = all(k in expected.columns for k in keys)
    have = sample_windows(product, keys)
    known, on = (expected, at) if own else (F.broadcast(expected), ["variable", "step_hours"])
    wanted = expected if own else product.select(*keys).distinct().crossJoin(F.broadcast(expected))
    missing = wanted.join(have, at, "left_anti").select(*at, F.lit("missing window").alias("check"))
    extra = have.join(known, on, "left_anti").select(*at, F.lit("unexpected window").alias("check"))
    beyond = range_violations(product, keys).select(*keys, "variable", F.lit(None).cast("int").alias("step_hours"), F.lit("out of range").alias("check"))
    wrong = F.col("window_hours").isNull() | (F.col("window_hours") <= 0) | (F.col("window_hours") > F.col("step_hours"))
    if {"valid_time", "init_date", "cycle"} <= set(product.columns):
        wrong |= ~F.col("valid_time").eqNullSafe(valid_time(F.col("init_date"), F.col("cycle"), F.col("step_hours")))
    if "window_hours" in expected.columns:
        declared = known.withColumnRenamed("window_hours", "declared")
        product = product.join(declared, on, "left")
        wrong |= F.coalesce(F.col("window_hours") != F.col("declared"), F.lit(False))
    width = product.filter(wrong).select(*at, F.lit("bounds").alias("check")).distinct()
    return missing.unionByName(extra).unionByName(beyond).unionByName(width)


def validate_contract(contracts: DataFrame, full: DataFrame) -> DataFrame:
    """violations (contract_id, check) of availability contracts.

    contracts: contract_id, schema_version, policy, status, available and
    missing (maps of variable to sorted steps), missing_variables (sorted),
    grid_resolution_degrees, and maybe expected, a map too, which must be the
    catalog. ``full`` is the catalog (variable, step_hours).
    """
    catalog = full.groupBy("variable").agg(F.sort_array(F.collect_set("step_hours")).alias("steps")).agg(F.map_from_entries(F.collect_list(F.struct("variable", "steps"))).alias("catalog"))  # the catalog's few hundred rows
    joined = contracts.crossJoin(F.broadcast(catalog))
    known = lambda v: F.coalesce(F.try_element_at("catalog", v), F.array().cast("array<int>"))
    have = lambda v: F.coalesce(F.try_element_at("available", v), F.array().cast("array<int>"))
    bad_samples = (F.cardinality("available") == 0) | F.exists(F.map_entries("available"), lambda e: (F.size(e["value"]) == 0) | (F.size(F.array_except(e["value"], known(e["key"]))) > 0))
    absent = F.filter(F.map_entries(F.transform_values("catalog", lambda k, v: F.sort_array(F.array_except(v, have(k))))), lambda e: F.size(e["value"]) > 0)
    norm = lambda entries: F.sort_array(entries)
    wrong_missing = norm(absent) != norm(F.map_entries("missing"))
    no_variables = F.sort_array(F.array_except(F.map_keys("catalog"), F.map_keys("available"))) != F.col("missing_variables")
    wrong_status = F.col("status") != F.when(F.size(absent) > 0, "partial").otherwise("complete")
    checks = {
        "version or policy": (F.col("schema_version") != 1) | (F.col("policy") != "historical_available"),
        **({"expected": norm(F.map_entries(F.transform_values("expected", lambda k, v: F.sort_array(v)))) != norm(F.map_entries("catalog"))} if "expected" in contracts.columns else {}),
        "samples": bad_samples,
        "missing lists": wrong_missing | no_variables | wrong_status,
        "grid": F.col("grid_resolution_degrees").isNotNull() & ~F.col("grid_resolution_degrees").isin(0.25, 0.4),
    }
    named = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in checks.items())))
    return joined.select("contract_id", F.explode(named).alias("check"))


def receipt(product: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, variable, n_expected, n_actual, complete): what a product's receipt says of each variable, by one catalog or, if ``expected`` has ``keys``, by each run's contract."""
    own = all(k in expected.columns for k in keys)
    counted = expected.groupBy(*(keys if own else ()), "variable").agg(F.count("*").alias("n_expected"))
    wanted = counted if own else product.select(*keys).distinct().crossJoin(F.broadcast(counted))
    known = expected if own else F.broadcast(expected)
    have = sample_windows(product, keys).join(known, [*(keys if own else ()), "variable", "step_hours"], "left_semi").groupBy(*keys, "variable").agg(F.count("*").alias("n_actual"))
    out = wanted.join(have, [*keys, "variable"], "left").withColumn("n_actual", F.coalesce("n_actual", F.lit(0)).cast("long"))
    return out.withColumn("complete", (F.col("n_actual") == F.col("n_expected")).cast("int"))


# Units and step types that cumulative and gust parameters may come with.
ENERGY = (169, 228129, 228021, 228022, 47, 176, 175, 177, 179)
PRECIPITATION = (228, 143)
GUST = 228028
THREE_HOURLY = (228028, 131, 132, 130, 133, 157, 129)


def cams_semantics(messages: DataFrame) -> DataFrame:
    """messages with the step type their values really have, the native interval, and source_step_type. Values stay."""
    cumulative = F.col("param_id").isin(*ENERGY, *PRECIPITATION)
    kind = F.when(cumulative, "accum").when(F.col("param_id") == GUST, "max").otherwise(F.col("step_type"))
    out = messages.withColumn("source_step_type", F.col("step_type")).withColumn("native_interval_hours", F.when(F.col("param_id").isin(*THREE_HOURLY), 3).otherwise(1))
    return out.withColumn("step_type", kind)


def cams_violations(messages: DataFrame, cube: list[str]) -> DataFrame:
    """(cube, param_id, check): not a forecast, units or step type not verified, not zero at step 0."""
    energy, rain, gust = F.col("param_id").isin(*ENERGY), F.col("param_id").isin(*PRECIPITATION), F.col("param_id") == GUST
    units_ok = F.when(energy, F.col("units").isin("J m**-2", "J m-2")).when(rain, F.col("units").isin("m", "kg m**-2", "kg m-2")).when(gust, F.col("units").isin("m s**-1", "m s-1")).otherwise(True)
    type_ok = F.when(energy | rain, F.col("step_type").isin("instant", "accum")).when(gust, F.col("step_type").isin("instant", "max")).otherwise(True)
    checks = messages.groupBy(*cube, "param_id").agg(
        F.max((F.col("data_type") != "fc").cast("int")).alias("not a forecast"),
        F.max((~units_ok).cast("int")).alias("units"),
        F.max((~type_ok).cast("int")).alias("step type"),
        F.max(((energy | rain) & (F.col("step_hours") == 0) & (F.col("value") != 0)).cast("int")).alias("not zero at step 0"),
    )
    names = ("not a forecast", "units", "step type", "not zero at step 0")
    found = F.array_compact(F.array(*(F.when(F.col(f"`{n}`") == 1, F.lit(n)) for n in names)))
    return checks.select(*cube, "param_id", F.explode(found).alias("check"))
