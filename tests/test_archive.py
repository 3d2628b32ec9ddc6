"""The archive gate and the rebuild of old runs, one fault at a time."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from aerolith.operators import archive, probability
from aerolith.plans.history import restore_history
from aerolith.sources import catalog_store, products

DAY = datetime.date(2026, 5, 1)
NOW = datetime.datetime(2026, 5, 2)
INIT = "source string, init_date date, cycle int"
SOURCE = "ifs-ens-probabilities"


def _runs(spark, **change):
    row = {"n_files": 2, "n_failures": 0, "contract_status": None, "completed_at": NOW, "manifest_time": NOW} | change
    return spark.createDataFrame([(SOURCE, DAY, 0, *row.values())], INIT + ", n_files long, n_failures int, contract_status string, completed_at timestamp, manifest_time timestamp")


def _outputs(spark, complete=1, late=1):
    return spark.createDataFrame([(SOURCE, DAY, 0, complete, NOW + datetime.timedelta(late))], INIT + ", complete int, marker_time timestamp")


def _files(spark, files=(("f240", 3, "a"), ("f360", 4, "b"))):
    return spark.createDataFrame([(SOURCE, DAY, 0, *f) for f in files], INIT + ", path string, size_bytes long, h string")


def test_each_fault_is_found(spark):
    planned = spark.createDataFrame([(SOURCE, DAY, 0)], INIT)
    checks = lambda frame: sorted(r["check"] for r in frame.collect())
    run = lambda m, o, p=planned: checks(archive.run_violations(m, p, o))
    assert run(_runs(spark), _outputs(spark)) == []
    assert run(_runs(spark), _outputs(spark, late=-1)) == ["product older than manifest"]
    assert run(_runs(spark), _outputs(spark, complete=0)) == ["incomplete product"]
    assert run(_runs(spark), _outputs(spark).limit(0)) == ["no product"]
    assert run(_runs(spark, n_failures=1), _outputs(spark)) == ["not_ready"]
    assert run(_runs(spark), _outputs(spark), planned.unionByName(planned.withColumn("cycle", F.lit(12)))) == ["missing cycle"]
    raw = lambda *files: checks(archive.raw_violations(_files(spark), _files(spark, files)))
    assert raw(("f240", 3, "a"), ("f360", 4, "b")) == []
    assert raw(("f240", 3, "x"), ("f360", 4, "b")) == ["raw hash"]
    assert raw(("f240", 3, "a")) == ["raw absent"]
    assert raw(("f240", 3, "a"), ("f360", 4, "b"), ("f9", 1, "c"), ("f9.part", 1, "c")) == ["raw unfinished", "raw unlisted"]
    full = probability.expected_samples(spark, SOURCE)
    good = full.withColumns({"source": F.lit(SOURCE), "init_date": F.lit(DAY), "cycle": F.lit(0), "value": F.lit(25.0), "window_hours": F.lit(24)})
    receipts = probability.receipt(good, full, ["source", "init_date", "cycle"])
    assert archive.product_violations(good, full, receipts).count() == 0
    assert checks(archive.product_violations(good.filter("NOT (variable = 'tpg20' AND step_hours = 24)"), full, receipts)) == ["product missing window", "receipt"]
    assert archive.copy_violations(_files(spark), _files(spark)).count() == 0
    assert {r["state"] for r in archive.copy_violations(_files(spark).limit(0), _files(spark)).collect()} == {"only_cold", "empty original"}
    days = archive.verify_days(archive.run_violations(_runs(spark), planned, _outputs(spark)), planned).first()
    assert (days["n_violations"], days["passes"]) == (0, 1)


def test_history_is_restored_and_resumed(spark, tmp_path):
    root, catalog = str(tmp_path / "store"), str(tmp_path / "catalog")

    def build(due):
        one = due.select("source", "init_date", "cycle", F.lit("tpg20").alias("variable"), F.lit(None).cast("double").alias("pressure_level"), F.lit(24).alias("step_hours"))
        return one.withColumns({"valid_time": F.lit("2026-05-02").cast("timestamp_ntz"), "latitude": F.lit(30.0), "longitude": F.lit(100.0), "value": F.lit(25.0), "window_hours": F.lit(24)})

    signatures = spark.createDataFrame([(SOURCE, datetime.datetime(2026, 5, 1), "s")], "source string, init timestamp_ntz, signature string")
    go = lambda outputs, actual, expected=None: restore_history(spark, _runs(spark), outputs, _files(spark), actual, build, expected, root, catalog, signatures)
    none = _outputs(spark).limit(0)
    faults = go(none, _files(spark, (("f240", 3, "x"), ("f360", 4, "b"))))
    assert [r["check"] for r in faults.collect()] == ["raw hash"] and catalog_store.read_catalog(spark, catalog).count() == 0
    assert go(none, _files(spark)).count() == 0
    assert products.read_product(spark, root).count() == 1 and catalog_store.read_catalog(spark, catalog).count() == 1
    assert go(_outputs(spark), _files(spark)).count() == 0
    assert go(none, _files(spark), probability.expected_samples(spark, SOURCE)).count() == 144


def test_each_bundle_fault_is_found(spark):
    schema = INIT + ", probability_availability struct<bundles:array<struct<bundle:int,status:string,selected_records:int,index_sha256:string,available_events:array<array<string>>>>>"
    good = [(240, "available", 5, "x", [["tpg1"]]), (360, "unavailable", 0, None, [])]
    index = spark.createDataFrame([(SOURCE, DAY, 0, 240, "x")], INIT + ", bundle int, index_sha256 string")
    checks = lambda bundles, actual=index: sorted(r["check"] for r in archive.bundle_violations(spark.createDataFrame([(SOURCE, DAY, 0, (bundles,))], schema), actual).collect())
    assert checks(good) == []
    assert checks(good[:1]) == ["bundles"] and checks([*good, good[1]]) == ["bundles"]
    assert checks([(240, "odd", 5, "x", [["e"]]), good[1]]) == ["bundle status"]
    assert checks([(240, "available", 0, "x", [["e"]]), good[1]]) == ["bundle records"]
    assert checks(good, index.limit(0)) == ["bundle index absent"]
    assert checks(good, index.withColumn("index_sha256", F.lit("y"))) == ["bundle index hash"]
    assert checks([(240, "available", 5, "x", []), good[1]]) == ["bundle events"]
    assert checks([good[0], (360, "unavailable", 2, None, [])]) == ["bundle unavailable"]


def test_each_grid_fault_is_found(spark):
    cells = spark.createDataFrame([(SOURCE, DAY, 0, "tpg20", float(y), float(x), 1.0) for y in range(6) for x in range(6)], INIT + ", variable string, latitude double, longitude double, value double")
    checks = lambda p: sorted(r["check"] for r in archive.grid_violations(p, ["tpg20"], 4, 3, 1.0).collect())
    assert checks(cells) == []
    assert checks(cells.filter("latitude < 3")) == ["tiles"]
    assert checks(cells.unionByName(cells.withColumn("variable", F.lit("x")))) == ["undeclared variable"]
    assert checks(cells.withColumn("longitude", F.col("longitude") * 2)) == ["axis"]


def test_contracts_of_each_run(spark):
    """A run is held against what its own manifest promises."""
    contract = spark.createDataFrame([(SOURCE, DAY, 0, ({"tpg20": [24, 36]},)), (SOURCE, DAY, 12, ({"tpg20": [24]},))], INIT + ", probability_availability struct<available_samples:map<string,array<int>>>")
    expected = probability.contract_samples(contract, ["source", "init_date", "cycle"])
    made = expected.withColumns({"value": F.lit(1.0), "window_hours": F.lit(24)})
    found = lambda p, e=expected: [(r["cycle"], r["check"], r["step_hours"]) for r in probability.validate(p, e, ["source", "init_date", "cycle"]).collect()]
    assert found(made) == []
    assert found(made.filter("NOT (cycle = 0 AND step_hours = 36)")) == [(0, "missing window", 36)]
    assert found(made.withColumn("cycle", F.lit(12)).dropDuplicates(["step_hours"])) == [(0, "missing window", 24), (0, "missing window", 36), (12, "unexpected window", 36)]
    declared = expected.withColumn("window_hours", F.lit(24))
    assert found(made.withColumn("window_hours", F.lit(12)), declared)[0][1] == "bounds"
    assert found(made.withColumn("window_hours", F.lit(None).cast("int")))[0][1] == "bounds"
    ends = made.withColumn("valid_time", F.lit("2026-05-02").cast("timestamp_ntz"))
    assert sorted(found(ends)) == [(0, "bounds", 36), (12, "bounds", 24)]
    assert found(made.withColumn("value", F.lit(float("nan"))))[0][1] == "missing window"
    assert {(r["cycle"], r["n_expected"], r["complete"]) for r in probability.receipt(made, expected, ["source", "init_date", "cycle"]).collect()} == {(0, 2, 1), (12, 1, 1)}
