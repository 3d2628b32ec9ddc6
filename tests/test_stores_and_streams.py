"""Products, manifests, catalog and stream on files, and the oracle queries."""

from __future__ import annotations

import datetime
import hashlib
import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerolith.operators import catalog, readiness, tiles
from aerolith.sources import catalog_store, manifests, products
from aerolith.streaming import watch

DAY = datetime.date(2026, 5, 1)


def _product(spark, day=DAY, variable="t2m", value=1.0, cycle=0, n=4):
    rows = [("demo", day, cycle, variable, None, s, datetime.datetime(2026, 5, 1), float(y), float(x), value, None) for s in (0, 3) for y in range(n) for x in range(n)]
    return spark.createDataFrame(rows, products.PRODUCT)


def test_one_run_is_replaced_and_others_stay(spark, tmp_path):
    root = str(tmp_path / "store")
    later = DAY + datetime.timedelta(1)
    products.write_product(_product(spark).unionByName(_product(spark, later)), root)
    products.write_product(_product(spark, value=2.0), root, codec="none")
    found = products.read_product(spark, root)
    assert {(r["init_date"], r["value"]) for r in found.select("init_date", "value").distinct().collect()} == {(DAY, 2.0), (later, 1.0)}
    assert found.schema["cycle"].dataType.simpleString() == "int"
    levels = _product(spark, value=3.0, n=1).withColumn("extra_level", F.explode(F.array(F.lit(1.0), F.lit(2.0))))
    products.write_product(levels, root)
    stored = products.read_product(spark, root).filter(F.col("init_date") == F.lit(DAY))
    assert sorted((r["step_hours"], r["extra_level"]) for r in stored.collect()) == [(0, 1.0), (0, 2.0), (3, 1.0), (3, 2.0)]


def test_tiles_and_a_missing_chunk(spark):
    whole = _product(spark, n=8)
    tiled = tiles.to_tiles(whole, 4, 4)
    assert tiles.completeness(tiled).count() == 0
    holed = tiled.withColumn("value", F.when((F.col("tile_latitude") == 1) & (F.col("tile_longitude") == 0), None).otherwise(F.col("value")))
    row = tiles.completeness(holed).first()
    assert (row["n_written"], row["n_expected"]) == (3, 4)
    empty = tiled.withColumn("value", F.lit(None).cast("double"))
    assert tiles.completeness(empty).count() == 0 and tiles.completeness(empty, strict=True).count() == 1
    assert tiles.completeness(whole.transform(lambda p: tiles.to_tiles(p.filter("latitude < 4"), 4, 4, axes=whole)), declared=tiles.declared_tiles(8, 8, 4, 4)).first()["n_written"] == 2  # a last row that all variables lack
    stepped = tiles.to_tiles(whole, 4, 4, step=1)
    assert stepped.agg(F.max("tile_step")).first()[0] == 1
    assert [r["variable"] for r in tiles.undeclared(whole, ["x"]).collect()] == ["t2m"] and tiles.undeclared(whole, ["t2m"]).count() == 0
    assert tiles.to_tiles(whole, -1, None).agg(F.max("tile_latitude"), F.max("tile_longitude")).first() == (0, 0)


def test_hashes_and_listing(spark, tmp_path):
    for name, content in (("a/x.bin", b"one"), ("b.part", b"two" * 1000)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    want = {n: hashlib.sha256((tmp_path / n).read_bytes()).hexdigest() for n in ("a/x.bin", "b.part")}
    for limit in (1 << 30, 10):
        assert {r["path"]: r["h"] for r in products.file_hashes(spark, str(tmp_path), limit).collect()} == want
    assert {r["path"] for r in products.listing(spark, str(tmp_path), "*.part").collect()} == {"b.part"}


def test_decoder_hook(spark, tmp_path):
    (tmp_path / "f.txt").write_text("1 2 3")
    decode = lambda path, content: pd.DataFrame({"name": [os.path.basename(path)] * 3, "value": [float(x) for x in content.split()]})
    (tmp_path / "n.txt").write_text("1 nan 3")
    assert [r["value"] for r in products.load_fields(spark, str(tmp_path / "n.txt"), decode, "name string, value double").collect()] == [1.0, None, 3.0]
    assert [r["value"] for r in products.load_fields(spark, str(tmp_path / "f.txt"), decode, "name string, value double").collect()] == [1.0, 2.0, 3.0]


def _manifest(root, name, cycle=0, **more):
    body = {"schema_version": 1, "source": {"name": "demo"}, "date": "20260501", "cycle": cycle, "completed_at": "2026-05-01T06:00:00Z", "files": [{"step_hours": 0, "path": "f000", "size_bytes": 3, "sha256": "x"}], "failures": []}
    (root / name).parent.mkdir(parents=True, exist_ok=True)
    (root / name).write_text(json.dumps(body | more))


def test_manifests_and_routing(spark, tmp_path):
    assert manifests.read_manifests(spark, str(tmp_path / "none"))[0].count() == 0
    _manifest(tmp_path, "demo/new.manifest.json", 0)
    _manifest(tmp_path, "demo/built.manifest.json", 6)
    _manifest(tmp_path, "demo/early.manifest.json", 12, completed_at=None)
    _manifest(tmp_path, "demo/failed.manifest.json", 18, failures=[{"step": "3"}])
    _manifest(tmp_path, "demo/none.manifest.json", 3, files=[], probability_availability={"status": "unavailable"}, completed_at=None)
    _manifest(tmp_path, "other/odd.manifest.json", 9, schema_version=2)
    good, bad = manifests.read_manifests(spark, str(tmp_path))
    assert (good.count(), bad.count()) == (5, 1)
    assert manifests.manifest_files(good).select("records_selected").distinct().collect() == [(0,)]
    late = datetime.datetime(2100, 1, 1)
    outputs = spark.createDataFrame([("demo", DAY, 6, 1, late)], "source string, init_date date, cycle int, complete int, marker_time timestamp")
    route = lambda **k: {r["cycle"]: r["action"] for r in watch.scan_once(spark, str(tmp_path), outputs, "demo", **k).collect()}
    assert route() == {0: "process", 6: "skip", 12: "not_ready", 18: "not_ready", 3: "unavailable"}
    assert route(force=True)[6] == "process"
    for changed in (outputs.withColumn("complete", F.lit(0)), outputs.withColumn("marker_time", F.lit(datetime.datetime(2000, 1, 1)))):
        assert {r["cycle"]: r["action"] for r in watch.scan_once(spark, str(tmp_path), changed, "demo").collect()}[6] == "process"
    summary = readiness.scan_summary(watch.scan_once(spark, str(tmp_path), outputs, "demo")).first()
    assert (summary["processed"], summary["skipped"], summary["not_ready"], summary["failed"], summary["alert"]) == (1, 1, 3, 0, 0)
    assert watch.latest_announcement(good).count() == 5


def test_build_manifests_for_every_day(spark):
    days = [DAY + datetime.timedelta(k) for k in range(4)]
    listing = spark.createDataFrame([("demo", d, c, s, f"f{s}", 1, None) for d in days for c in (0, 5) for s in (3, 0)], "source string, init_date date, cycle int, step_hours int, path string, size_bytes long, sha256 string")
    made = manifests.build_manifests(listing, listing.filter(F.col("init_date") == days[1]), F.lit(days[0]), F.lit(days[2])).collect()
    assert sorted((r["init_date"], r["cycle"]) for r in made) == [(days[0], 0), (days[2], 0)]
    body = json.loads(made[0]["manifest"])
    assert [f["step_hours"] for f in body["files"]] == [0, 3] and body["failures"] == [] and body["variables"] == []
    noon = manifests.build_manifests(listing.withColumn("cycle", F.lit(12)), listing.limit(0), F.lit(DAY), F.lit(DAY)).first()
    assert {json.loads(noon["manifest"])[k] for k in ("init_time", "completed_at")} == {"2026-05-01T12:00:00Z"}


def test_watch_hands_on_each_manifest_once(spark, tmp_path):
    root, seen = tmp_path / "in", []
    _manifest(root, "demo/a.manifest.json", 0)

    def handle(rows):
        cycles = [r["cycle"] for r in rows.collect()]
        seen.extend(cycles)
        if 12 in cycles:
            raise RuntimeError("bad run")
        assert len(cycles) == 1

    def go(**k):
        watch.watch(spark, str(root), str(tmp_path / "checkpoint"), handle, once=True, **k).awaitTermination(120)

    go(seed=True)
    _manifest(root, "demo/b.manifest.json", 6)
    go()
    _manifest(root, "demo/c.manifest.json", 12)  # fails, and does not take the run that comes with it along
    _manifest(root, "demo/d.manifest.json", 18)
    go()
    assert seen[0] == 6 and sorted(seen) == [6, 12, 18]
    assert spark.read.json(str(tmp_path / "checkpoint-failed")).select("cycle").collect() == [(12,)]


def test_catalog_is_appended_rewritten_and_removed(spark, tmp_path):
    root = str(tmp_path / "catalog")
    days = [datetime.datetime(2026, 5, 1, 12), datetime.datetime(2026, 5, 2, 0), datetime.datetime(2026, 5, 2, 12)]  # two runs of one day

    def rows(day, names, signature, source="demo"):
        defined = spark.createDataFrame([(source, day, n, n.split("_")[0], None) for n in names], "source string, init timestamp_ntz, name string, base string, level string")
        return catalog_store.products_of(defined, spark.createDataFrame([(source, day, signature)], "source string, init timestamp_ntz, signature string"))

    read = lambda: catalog_store.read_catalog(spark, root)
    assert catalog_store.upsert(spark, root, rows(days[1], ["t", "t_850"], "a"), "demo")
    assert not catalog_store.upsert(spark, root, rows(days[1], ["t", "t_850"], "a"), "demo")
    assert catalog_store.upsert(spark, root, rows(days[0], ["t"], "b"), "demo")
    assert not catalog_store.upsert(spark, root, rows(days[2], ["t"], None), "demo")
    state = catalog_store.stored_state(read()).first()
    assert (state["total"], state["first_init"], state["last_init"], state["ready"]) == (2, days[0], days[1], 0)
    assert catalog_store.upsert(spark, root, rows(days[0], ["t"], "b", "gone"), "gone")
    catalog_store.rebuild(spark, root, rows(days[0], ["t"], "b").unionByName(rows(days[2], ["u"], "c")))
    assert [(r["source"], r["ready"]) for r in catalog_store.stored_state(read()).collect()] == [("demo", 1)]
    members = catalog_store.stored_members(read())
    assert {(r["name"], r["n_inits"]) for r in catalog.coverage(members).collect()} == {("t", 1), ("u", 1)}
    assert catalog.catalog_check(catalog_store.stored_state(read()), members, catalog.coverage(members)).count() == 0
    assert catalog_store.upsert(spark, root, rows(days[1], ["u"], "d"), "demo")
    catalog_store.remove(spark, root, "demo", spark.createDataFrame([(days[1],)], "init timestamp_ntz"))
    assert sorted(r["init"] for r in read().collect()) == [days[0], days[2]]  # the other run of that day stays
    for day in (days[0], days[2]):
        catalog_store.remove(spark, root, "demo", spark.createDataFrame([(day,)], "init timestamp_ntz"))
    assert read().count() == 0


def test_runs_of_one_day_count_each(spark):
    both = _product(spark, cycle=0).unionByName(_product(spark, cycle=12, variable="u10"))
    members = catalog.membership(catalog.definitions(both))
    noon = datetime.datetime(2026, 5, 1, 12)
    state = catalog.catalog_state(both).first()
    assert (state["total"], state["last_init"]) == (2, noon)
    covered = {r["name"]: (r["n_inits"], r["first_init"]) for r in catalog.coverage(members).collect()}
    assert covered == {"t2m": (1, datetime.datetime(2026, 5, 1)), "u10": (1, noon)}
    assert [r["init"] for r in catalog.latest_inits(both, 1).collect()] == [noon]
    assert [r["name"] for r in catalog.latest_definitions(members, catalog.coverage(members).filter("name <> 'u10'")).collect()] == ["u10"]
    stored = catalog.catalog_state(both).withColumns({"ready": F.lit(1), "version": F.lit(1)})
    checks = lambda x: [r["check"] for r in catalog.catalog_check(x, both, catalog.coverage(members)).collect()]
    assert checks(stored) == [] and checks(stored.unionByName(stored)) == ["several states"]
    assert checks(stored.withColumn("version", F.lit(2))) == ["version"]


def test_upkeep_of_products_and_catalog(spark, tmp_path):
    """Each arriving manifest's product is built, written and put into the catalog; the second time nothing changes."""
    root, folder, store = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "catalog")
    for name, cycle in (("a", 0), ("b", 12)):
        _manifest(root, f"demo/{name}.manifest.json", cycle)
    build = lambda m: m.select("source", "init_date", "cycle", F.lit("t2m").alias("variable"), F.lit(None).cast("double").alias("pressure_level"), F.lit(0).alias("step_hours"), F.lit("2026-05-01").cast("timestamp_ntz").alias("valid_time"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), F.lit(3.0).alias("value"))
    signatures = lambda due: catalog.with_init(due).select("source", "init", F.lit("s").alias("signature"))
    for k in range(2):
        handle = watch.catalog_upkeep(spark, build, signatures, folder, store)
        watch.watch(spark, str(root), str(tmp_path / f"checkpoint{k}"), handle, once=True).awaitTermination(120)
        assert not (tmp_path / f"checkpoint{k}-failed").exists()
        assert sorted(r["init"].hour for r in catalog_store.read_catalog(spark, store).collect()) == [0, 12]
        assert products.read_product(spark, folder).count() == 2


def test_reconcile_reports(spark):
    schema = "id_source string, init string, signature string"
    now = spark.createDataFrame([("s", "1", "a"), ("s", "2", "b"), ("s", "3", None)], schema)
    report = lambda before, **k: tuple(catalog.reconcile(spark.createDataFrame(before, schema), now, **k).first())
    assert report([("s", "1", "a"), ("s", "2", "b")]) == ("s", "unchanged", 0, 0, 0, 2)
    assert report([("s", "1", "x"), ("s", "9", "b")]) == ("s", "repaired", 1, 2, 1, 2)
    assert report([("s", "1", "x")], bulk=1) == ("s", "rebuilt", 1, 2, 0, 2)
    assert report([("s", "1", "a")], force=True)[1] == "rebuilt" and report([], usable=False)[1] == "rebuilt"
    assert report([("s", "1", "x")], recent=now.limit(1))[1] == "deferred"
    assert report([("s", "1", "a"), ("s", "2", "b")]) == ("s", "unchanged", 0, 0, 0, 2)
    gone = catalog.reconcile(now, now.limit(0)).first()
    assert (gone["action"], gone["removed"], gone["total"]) == ("error", 2, 0) or (gone["action"], gone["removed"]) == ("error", 3)
    assert catalog.reconcile(now, now.limit(0), usable=False).first()["action"] == "error"
    late = now.filter("init = '3'")
    assert catalog.reconcile(now.limit(0), late, usable=False).first()["action"] == "deferred"


def test_reconcile_query_without_whole_inits(spark, tmp_path):
    """A source of which no init is whole is in neither the query nor its SQL, one whose inits are not whole any more is in both."""
    import duckdb

    from aerolith.plans.registry import ORACLE_SQL, QUERIES

    def equal(name, keys):
        at = pd.Timestamp("1995-01-01")
        folder = tmp_path / name
        spark.createDataFrame([(k, c, (at + pd.Timedelta(days=k)).to_pydatetime()) for k, c in keys], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(str(folder / "orders.parquet"))
        base = duckdb.connect()
        base.sql(f"CREATE VIEW orders AS SELECT * FROM '{folder}/orders.parquet/*.parquet'")
        found = sorted(map(tuple, QUERIES["c07_reconcile"](spark, str(folder)).collect()))
        assert found == sorted(base.sql(ORACLE_SQL["c07_reconcile"]).fetchall())
        return [r[0] for r in found]

    unfinished = [(k, 2) for k in (11, 22, 33)]
    assert equal("none", [*unfinished, (44, 1), (55, 3)]) == []
    assert equal("some", [*unfinished, (1, 1), (2, 1), (3, 3)]) == ["gfs-0p25", "graphcast"]
    assert equal("gone", [*unfinished, (53, 2), (1, 1)]) == ["gfs-0p25", "ifs-hres"]


def _values(frame: pd.DataFrame) -> list:
    frame = frame[sorted(frame.columns)]
    one = lambda v: "" if pd.isna(v) else str(v)[:10] if str(v).endswith(" 00:00:00") else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(map(one, r)) for r in frame.itertuples(index=False))


def _names():
    from aerolith.plans.registry import ORACLE_SQL

    return sorted(ORACLE_SQL)


#: Queries whose cases need more rows than the smallest tables have.
LARGER = ("e06_contract", "w01_authoritative", "c06_catalog_check")


@pytest.mark.parametrize(("name", "larger"), [*((n, False) for n in _names()), *((n, True) for n in LARGER)])
def test_query_equals_its_sql(spark, small, name, larger):
    import duckdb

    from aerolith.plans.registry import ORACLE_SQL, QUERIES

    small = small.replace("sf0.001", "sf0.01") if larger else small
    base = duckdb.connect()
    for table in ("lineitem", "orders", "customer", "part", "events", "documents"):
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    found, want = QUERIES[name](spark, small).toPandas(), base.sql(ORACLE_SQL[name]).df()
    for c in found.columns.intersection(want.columns):  # nullable whole numbers come as floats from one engine
        if pd.api.types.is_numeric_dtype(found[c]) and pd.api.types.is_numeric_dtype(want[c]) and not pd.api.types.is_bool_dtype(want[c]):
            found[c], want[c] = found[c].astype("float64"), want[c].astype("float64")
    assert sorted(found.columns) == sorted(want.columns) and len(found)
    assert _values(found) == _values(want)
