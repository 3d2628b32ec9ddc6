"""Naming rules, crops, passes, merging, regridding: the literal cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aerolith.functions import naming, scalars
from aerolith.operators import fields, probability

HEAD = "source string, type_of_level string, level double, step_type string, short_name string"


def _names(spark, rows):
    named = naming.apply_rules(spark.createDataFrame(rows, HEAD), naming.rules(spark))
    return [(r["variable"], r["pressure_level"]) for r in named.collect()]


@pytest.mark.parametrize(
    ("row", "name"),
    [
        (("gfs-0p25", "heightAboveGround", 10.0, "instant", "u10"), "u10"),
        (("gfs-0p25", "heightAboveGround", 80.0, "instant", "pres"), "pres80m"),
        (("gfs-0p25", "heightAboveGround", 80.9, "instant", "q"), "q80m"),
        (("gfs-0p25", "heightAboveGround", 2.0, "max", "mx2t3"), "mx2t3_max"),
        (("gfs-0p25", "heightAboveGround", None, "instant", "q"), "q0m"),
        (("gfs-0p25", "surface", 0.0, "instant", "t"), "t_sfc"),
        (("ifs-hres", "surface", 0.0, "instant", "t"), "t"),
        (("gfs-0p25", "surface", 0.0, "avg", "prate"), "prate_avg"),
        (("gfs-0p25", "surface", 0.0, "", "sp"), "sp"),
        (("gfs-0p25", "convectiveCloudLayer", 0.0, "instant", "tcc"), "tcc_conv"),
        (("gfs-0p25", "boundaryLayerCloudLayer", 0.0, "avg", "tcc"), "tcc_bl_avg"),
        (("gfs-0p25", "atmosphere", 0.0, "avg", "tcc"), "tcc_avg"),
        (("gfs-0p25", "highCloudLayer", 0.0, "avg", "avg_hcc"), "hcc_avg"),
        (("gfs-0p25", "highCloudLayer", 0.0, "avg", "hcc"), "hcc"),
        (("graphcast", "surface", 0.0, "accum", "unknown"), "tp_accum"),
        (("dwd-icon", "unknown", 0.0, "max", "CAPE_ML"), "CAPE_ML"),
        (("nowhere", "surface", 0.0, "avg", "x"), "x"),
    ],
)
def test_names(spark, row, name):
    assert _names(spark, [row]) == [(name, None)]


def test_pressure_levels_stay_a_dimension(spark):
    rows = [("gfs-0p25", "isobaricInhPa", p, "instant", "t") for p in (1000.0, 850.0, 500.0)]
    assert sorted(_names(spark, rows)) == [("t", 500.0), ("t", 850.0), ("t", 1000.0)]


def test_rule_table_is_a_registry(spark):
    table = naming.rules(spark)
    assert naming.check_rules(table).count() == 0
    assert naming.check_rules(table.unionByName(table.limit(1))).count() == 1
    sources = [r["source"] for r in naming.list_sources(table).collect()]
    assert sources == sorted(sources) and {"gfs-0p25", "dwd-icon", "ec_cams"} <= set(sources)


def _cells(spark, points, value=1.0):
    rows = [("s", "c", float(lat), float(lon), value) for lat, lon in points]
    return spark.createDataFrame(rows, "source string, cube string, latitude double, longitude double, value double")


def test_crop_wraps_only_cubes_beyond_180_and_keeps_bounds(spark):
    wide = fields.crop(_cells(spark, [(10, 350), (10, 170), (20, 10), (21, 10)]), -20.0, 170.0, 10.0, 20.0, ["source", "cube"])
    assert sorted((r["latitude"], r["longitude"]) for r in wide.collect()) == [(10.0, -10.0), (10.0, 170.0), (20.0, 10.0)]
    same = fields.crop(_cells(spark, [(10, 180), (10, -180)]), -180.0, 180.0, 10.0, 20.0, ["source", "cube"])
    assert same.count() == 2
    assert fields.crop(_cells(spark, [(80, 0)]), -1.0, 1.0, 0.0, 1.0, ["source", "cube"]).count() == 0
    for box in ((10, 10, 0, 1), (0, 1, 5, 4), (-181, 0, 0, 1), (0, 361, 0, 1)):
        with pytest.raises(ValueError):
            fields.check_box(*box)


def test_boundary_noise_is_snapped(spark):
    rows = [(55.00000000000135, 69.99999999999434), (54.90000000000135, 70.09999999999434), (15.0000000000008, 139.99999999999037)]
    frame = spark.createDataFrame(rows, "a double, b double").select(scalars.snap_decimals(F.col("a")).alias("a"), scalars.snap_decimals(F.col("b")).alias("b"))
    assert [tuple(r) for r in frame.collect()] == [(55.0, 70.0), (54.9, 70.1), (15.0, 140.0)]
    halves = spark.createDataFrame([(2.5,), (3.5,), (-190.0,)], "x double").select(F.rint("x"), scalars.wrap_longitude(F.col("x")))
    assert [r[0] for r in halves.collect()][:2] == [2.0, 4.0] and halves.collect()[2][1] == 170.0


def test_canonical_lead(spark):
    rows = [("f000.subset.grib2", 0), ("f000.subset.grib2", 3), ("x000.grib2", 0), ("f006.subset.grib2", None)]
    found = fields.canonical_lead(spark.createDataFrame(rows, "file_name string, step_hours int"))
    assert [r["reject_reason"] for r in found.collect()] == [None, "preview", "bad file name", "no step"]


def _slab(step, file_step, msg, value, lat=1.0):
    return ("s", "2026-05-01", 0, "surface", 0.0, "instant", "t", step, file_step, msg, lat, 2.0, value)


SLAB = "source string, init_date string, cycle int, type_of_level string, level double, step_type string, short_name string, step_hours int, file_step_hours int, msg_no long, latitude double, longitude double, value double"


def test_later_pass_wins_even_where_it_is_missing(spark):
    rows = [_slab(3, 0, 9, 1.0), _slab(3, 0, 9, 1.5, 5.0), _slab(3, 3, 1, None), _slab(3, 3, 2, 7.0, 4.0), _slab(3, 3, 3, None, 4.0), _slab(6, 6, 1, 2.0)]
    found = fields.authoritative(spark.createDataFrame(rows, SLAB))
    assert sorted((r["step_hours"], r["latitude"], r["value"]) for r in found.collect() if r["value"] is not None) == [(6, 1.0, 2.0)]
    assert found.count() == 3


def test_passes_of_slabs_with_nulls(spark):
    static = ("s", "2026-05-01", 0, "surface", None, None, "lsm", None, None, 1, 1.0, 2.0, 5.0)
    rows = [static, _slab(None, 3, 1, 1.0), _slab(None, 6, 2, 2.0), _slab(3, None, 1, 3.0), _slab(6, None, 1, 4.0), _slab(6, 0, 2, 6.0)]
    found = fields.authoritative(spark.createDataFrame(rows, SLAB))
    assert sorted((r["short_name"], r["step_hours"] or -1, r["value"]) for r in found.collect()) == [("lsm", -1, 5.0), ("t", -1, 2.0), ("t", 3, 3.0), ("t", 6, 6.0)]


def test_levels_that_no_name_holds_stay_apart(spark):
    from datetime import date

    from aerolith.plans.pipeline import build_product

    row = lambda kind, level, name, value, msg=1: ("dwd-icon", date(2026, 5, 1), 0, kind, level, "instant", name, 0, 0, msg, 1.0, 2.0, value)
    rows = [row("generalVertical", float(k), "HHL", 10.0 * k) for k in (1, 2, 3)] + [row("meanSea", 0.0, "prmsl", 7.0), row("heightAboveGround", 2.0, "t", 1.0), row("heightAboveGround", 10.0, "t", 2.0)]
    raw = spark.createDataFrame(rows, SLAB.replace("init_date string", "init_date date"))
    found = build_product(raw, -10.0, 10.0, -10.0, 10.0, refuse=True).collect()
    assert sorted((r["variable"], r["extra_level"] or 0.0, r["value"], r["n_values"]) for r in found) == [("HHL", 1.0, 10.0, 1), ("HHL", 2.0, 20.0, 1), ("HHL", 3.0, 30.0, 1), ("prmsl", 0.0, 7.0, 1), ("t10m", 0.0, 2.0, 1), ("t2m", 0.0, 1.0, 1)]
    clash = raw.unionByName(spark.createDataFrame([row("surface", 0.0, "HHL", 1.0), row("meanSea", 0.0, "HHL", 2.0)], raw.schema))
    with pytest.raises(Exception, match="unlike values of HHL"):
        build_product(clash, -10.0, 10.0, -10.0, 10.0, refuse=True).collect()


def test_merge_reports_conflicts(spark):
    rows = [("s", "d", 0, "t", None, 3, 1.0, 1.0, v) for v in (None, 2.0, 2.0)] + [("s", "d", 0, "t", None, 6, 1.0, 1.0, v) for v in (2.0, 3.0)]
    found = fields.merge(spark.createDataFrame(rows, "source string, init_date string, cycle int, variable string, pressure_level double, step_hours int, latitude double, longitude double, value double"))
    assert sorted((r["step_hours"], r["n_values"]) for r in found.collect()) == [(3, 1), (6, 2)]


def test_nearest_cell_equals_brute_force(spark):
    import math
    import random

    rng = random.Random(3)
    cells = [(k, rng.uniform(10, 60), rng.uniform(60, 150)) for k in range(400)] + [(900, 20.0, 80.0), (901, 20.0, 80.0)]
    targets = [(20.0, 80.0)] + [(rng.uniform(15, 55), rng.uniform(70, 140)) for _ in range(60)]
    point = lambda lat, lon: tuple(f for f in (math.cos(math.radians(lat)) * math.cos(math.radians(lon)), math.cos(math.radians(lat)) * math.sin(math.radians(lon)), math.sin(math.radians(lat))))
    lats, lons = [t[0] for t in targets], [t[1] for t in targets]
    inside = [c for c in cells if min(lats) - 1 <= c[1] <= max(lats) + 1 and min(lons) - 1 <= c[2] <= max(lons) + 1]
    want = {t: min((round(sum((a - b) ** 2 for a, b in zip(point(*t), point(*c[1:]), strict=True)), 12), c[0]) for c in inside)[1] for t in targets}
    found = fields.nearest_cell(spark.createDataFrame(cells, "cell_id long, clat double, clon double"), spark.createDataFrame(targets, "tlat double, tlon double"))
    assert {(r["tlat"], r["tlon"]): r["cell_id"] for r in found.collect()} == want
    grid = fields.target_grid(spark, 70.0, 71.0, 15.0, 15.5, 0.125)
    assert grid.count() == 9 * 5 and grid.agg(F.max("tlon")).first()[0] == 71.0


def test_event_names_and_thresholds(spark):
    rows = [("2tl273", "instant", 0), ("2tl273", "max", 48), ("tpg50", "accum", 24), ("10fgg15", "max", 24), ("10spg10", "max", 24)]
    frame = spark.createDataFrame(rows, "p string, s string, h int").select(scalars.event_name(F.col("p"), F.col("s"), F.col("h")))
    assert [r[0] for r in frame.collect()] == ["2tl273", "2tl273_max48h", "tpg50", "10fgg15", "10spg10_max24h"]
    limits = spark.createDataFrame([("tpg25",), ("10spg15",), ("2tl273",), ("tpl01",), ("tprg3",), ("tprl1",), ("x",)], "p string").select(scalars.event_threshold(F.col("p")).alias("e"))
    got = [None if r["e"] is None else tuple(r["e"]) for r in limits.collect()]
    assert got == [(25.0, "mm", "gt"), (15.0, "m s-1", "gt"), (273.15, "K", "lt"), (0.1, "mm", "lt"), (3.0, "mm day-1", "gt"), (1.0, "mm day-1", "lt"), None]


def test_catalog_totals(spark):
    assert probability.expected_samples(spark, "ifs-ens-probabilities").count() == 145
    full = probability.expected_samples(spark, "aifs-ens-probabilities")
    assert full.count() == 313 and full.select("variable").distinct().count() == 25


def test_validation_finds_each_fault(spark):
    full = probability.expected_samples(spark, "ifs-ens-probabilities")
    good = full.withColumns({"source": F.lit("s"), "value": F.lit(25.0), "window_hours": F.lit(24)})
    check = lambda frame: {r["check"] for r in probability.validate(frame, full, ["source"]).collect()}
    assert check(good) == set()
    one = (F.col("variable") == "tpg20") & (F.col("step_hours") == 240)
    assert check(good.filter(~one)) == {"missing window"}
    assert check(good.withColumn("value", F.when(one, 101.0).otherwise(F.col("value")))) == {"out of range"}
    assert check(good.withColumn("value", F.when(one, float("inf")).otherwise(F.col("value")))) == {"out of range"}
    assert check(good.withColumn("value", F.when(~one, F.col("value")))) == {"missing window"}
    assert check(good.withColumn("window_hours", F.when(one, 0).otherwise(24))) == {"bounds"}
    assert check(good.unionByName(good.limit(1).withColumn("step_hours", F.lit(30)))) == {"unexpected window"}


def test_cams(spark):
    schema = "cube int, param_id int, data_type string, units string, step_type string, step_hours int, value double"
    good = [(1, 169, "fc", "J m**-2", "instant", h, h * 1200.0) for h in (0, 3, 6)] + [(1, 228, "fc", "kg m**-2", "instant", 0, 0.0), (1, 210207, "fc", "~", "instant", 0, 0.1), (1, 228028, "fc", "m s-1", "max", 3, 4.0)]
    named = {(r["param_id"], r["step_type"], r["source_step_type"], r["native_interval_hours"]) for r in probability.cams_semantics(spark.createDataFrame(good, schema)).collect()}
    assert named == {(169, "accum", "instant", 1), (228, "accum", "instant", 1), (210207, "instant", "instant", 1), (228028, "max", "max", 3)}
    faults = [(2, 169, "fc", "J m**-2", "instant", 0, 1.0), (3, 169, "fc", "W m**-2", "instant", 0, 0.0), (4, 228, "an", "m", "accum", 0, 0.0), (5, 228028, "fc", "m s-1", "avg", 0, 0.0)]
    found = {(r["cube"], r["check"]) for r in probability.cams_violations(spark.createDataFrame(good + faults, schema), ["cube"]).collect()}
    assert found == {(2, "not zero at step 0"), (3, "units"), (4, "not a forecast"), (5, "step type")}


def test_nearest_cell_of_far_and_of_no_cells(spark):
    cells = spark.createDataFrame([(1, 10.0, 10.0), (2, 40.0, 40.0)], "cell_id long, clat double, clon double")
    targets = spark.createDataFrame([(10.0, 12.0), (30.0, 30.0), (40.0, 39.0), (24.0, 10.0)], "tlat double, tlon double")
    for bucket in (0.01, 1.0, 50.0):
        found = {(r["tlat"], r["tlon"]): r["cell_id"] for r in fields.nearest_cell(cells, targets, bucket, margin=5.0).collect()}
        assert found == {(10.0, 12.0): 1, (30.0, 30.0): 2, (40.0, 39.0): 2, (24.0, 10.0): 1}
    none = fields.nearest_cell(cells.filter("cell_id = 9"), targets).collect()
    assert len(none) == 4 and {r["cell_id"] for r in none} == {None}
    with pytest.raises(Exception, match="no cell near"):
        fields.nearest_cell(cells.filter("cell_id = 9"), targets, strict=True).collect()


def test_hooks_of_a_source(spark):
    """A source on an unstructured grid comes to latitude and longitude, is cropped in its own way, and is checked."""
    from datetime import date

    from aerolith.plans.pipeline import build_product

    cells = spark.createDataFrame([(1, 10.0, 20.0), (2, 50.0, 20.0)], "cell_id long, clat double, clon double")
    remap = fields.nearest_cell(cells, spark.createDataFrame([(10.0, 20.0), (11.0, 20.0), (50.0, 20.0)], "tlat double, tlon double"))
    rows = [("dwd-icon", date(2026, 5, 1), 0, "meanSea", 0.0, "instant", "prmsl", 0, 0, k, k, float(v)) for k, v in ((1, 5.0), (2, float("nan")))]
    raw = spark.createDataFrame(rows, "source string, init_date date, cycle int, type_of_level string, level double, step_type string, short_name string, step_hours int, file_step_hours int, msg_no long, cell_id long, value double")
    seen = []

    def check(product):
        seen.append(product.count())
        return product.withColumn("checked", F.lit(True))

    hooks = {"regrid": lambda r: fields.regrid(r, remap), "check": check}
    found = build_product(raw, -180.0, 180.0, 0.0, 60.0, **hooks)
    assert sorted((r["latitude"], r["value"]) for r in found.collect() if r["checked"]) == [(10.0, 5.0), (11.0, 5.0), (50.0, None)] and seen == [3]
    small = build_product(raw, 0.0, 1.0, 0.0, 1.0, crop=lambda r: r.filter("latitude < 11"), **hooks)
    assert [r["latitude"] for r in small.collect()] == [10.0]
    headers = fields.slabs(hooks["regrid"](raw))
    assert build_product(raw, -180.0, 180.0, 0.0, 60.0, headers=headers, **hooks).count() == 3
    static = fields.with_step(raw.drop("step_hours"))
    assert static.filter("step_hours IS NULL").count() == 2 and fields.with_step(raw) is raw
    assert set(naming.drop_level_columns(naming.apply_rules(raw, naming.rules(spark))).columns) == {"source", "init_date", "cycle", "step_hours", "file_step_hours", "msg_no", "cell_id", "value", "variable", "pressure_level"}


def test_parts_are_combined_strictly(spark):
    schema = "source string, init_date string, cycle int, variable string, step_hours int, latitude double, longitude double, value double, pressure_level double"
    row = lambda value, level=None, name="t": ("s", "d", 0, name, 0, 1.0, 2.0, value, level)
    surface = spark.createDataFrame([row(1.0), row(None, name="u")], schema)
    pressure = spark.createDataFrame([row(5.0, 500.0), row(1.0), row(2.0, name="u")], schema)
    assert fields.combine_parts(surface, pressure).count() == 5
    found = fields.combine_parts(surface, pressure, strict=True).collect()
    assert sorted((r["variable"], r["pressure_level"] or 0.0, r["value"]) for r in found) == [("t", 0.0, 1.0), ("t", 500.0, 5.0), ("u", 0.0, 2.0)]
    with pytest.raises(Exception, match="unlike parts of t"):
        fields.combine_parts(surface, pressure.withColumn("value", F.col("value") + 1), strict=True).collect()
    mixed = fields.combine_parts(surface, pressure)
    assert [r["variable"] for r in fields.in_order(mixed).collect()] == ["t", "t", "t", "u", "u"]


def test_contract_of_another_catalog(spark):
    full = spark.createDataFrame([("a", 24), ("a", 36)], "variable string, step_hours int")
    schema = "contract_id int, schema_version int, policy string, status string, expected map<string,array<int>>, available map<string,array<int>>, missing map<string,array<int>>, missing_variables array<string>, grid_resolution_degrees double"
    rows = [(k, 1, "historical_available", "partial", e, {"a": [24]}, {"a": [36]}, [], 0.25) for k, e in enumerate(({"a": [36, 24]}, {"a": [24]}, {"a": [24, 36], "b": [24]}))]
    found = probability.validate_contract(spark.createDataFrame(rows, schema), full).collect()
    assert sorted((r["contract_id"], r["check"]) for r in found) == [(1, "expected"), (2, "expected")]
