"""Runs are withdrawn, written by tile, read back and put into the catalog, which follows what is stored."""

from __future__ import annotations

import datetime
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from aerolith.operators import catalog, tiles
from aerolith.plans import publication
from aerolith.sources import catalog_store, products, tile_store
from aerolith.sources.tile_store import Sizes

DAY = datetime.date(2026, 5, 1)
SIZES = Sizes(4, 4, 1, 1)


def _run(spark, cycle=0, names=("t2m",), levels=(), day=DAY, source="demo", n=8, value=1.0):
    """Surface variables and, with levels, one variable t on them; two steps."""
    at = datetime.datetime.combine(day, datetime.time(cycle))
    rows = [(source, day, cycle, v, p, s, at, float(y), float(x), value, None) for v, ps in [*((v, (None,)) for v in names), *([("t", levels)] if levels else [])] for p in ps for s in (0, 3) for y in range(n) for x in range(n)]
    return spark.createDataFrame(rows, products.PRODUCT)


def _inits(product):
    return product.select("source", "init_date", "cycle").distinct()


def _files(folder):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def _entries(spark, path):
    return {(r["init"].hour, d["name"]) for r in catalog_store.read_catalog(spark, path).collect() for d in r["definitions"]}


def _publish(spark, tmp_path, product, **more):
    return publication.publish_runs(product, _inits(product), str(tmp_path / "store"), str(tmp_path / "catalog"), SIZES, **more)


def test_expected_tiles_over_all_axes(spark):
    run = _run(spark, levels=(850.0, 500.0, 250.0))
    meta = tile_store.declaration(run, SIZES)
    expected = tile_store.index_of(meta, SIZES)
    assert {r["variable"]: r["count"] for r in expected.groupBy("variable").count().collect()} == {"t2m": 2 * 4, "t": 2 * 3 * 4}
    tiled = tile_store._with_tiles(run, meta)
    assert tiles.missing_tiles(tiled, expected).count() == 0
    holed = tiled.filter(~((F.col("variable") == "t") & (F.col("pressure_level") == 250) & (F.col("step_hours") == 3) & (F.col("latitude") < 4)))
    found = [tuple(r)[3:] for r in tiles.missing_tiles(holed, expected).collect()]
    assert sorted(found) == [("t", 1, 0, 0, 0), ("t", 1, 0, 0, 1)]  # 250 is the least level
    without = tiled.filter("variable <> 't2m'")
    assert tiles.missing_tiles(without, expected).count() == 8 and tiles.missing_tiles(without, expected, strict=False).count() == 0


def test_completeness_counts_all_tile_columns(spark):
    run = _run(spark, levels=(850.0, 500.0))
    tiled = tiles.to_tiles(run, 4, 4, step=1, level=1)
    assert tiles.completeness(tiled).count() == 0
    half = tiled.filter(~((F.col("variable") == "t2m") & (F.col("step_hours") == 3)))
    assert [tuple(r)[3:] for r in tiles.completeness(half).collect()] == [("t2m", 4, 8)]
    level = tiled.filter(~((F.col("variable") == "t") & (F.col("pressure_level") == 850) & (F.col("latitude") < 4)))
    assert [tuple(r)[3:] for r in tiles.completeness(level).collect()] == [("t", 12, 16)]
    assert tiles.completeness(tiles.to_tiles(_run(spark), 4, 4, step=1), declared=8).count() == 0


def test_a_lost_file_keeps_its_run_out(spark, tmp_path, monkeypatch):
    both = _run(spark, 0, ("t2m", "u10")).unionByName(_run(spark, 12))
    assert _publish(spark, tmp_path, both).count() == 0
    assert _entries(spark, str(tmp_path / "catalog")) == {(0, "t2m"), (0, "u10"), (12, "t2m")}
    look = publication.write_runs.__globals__["missing_in_store"]

    def lossy(spark, root, meta, sizes):
        os.remove(_files(f"{root}/cells/source=demo/init_date=2026-05-01/cycle=0/variable=u10/tile_latitude=1")[0])
        return look(spark, root, meta, sizes)

    monkeypatch.setattr(tile_store, "missing_in_store", lossy)
    again = _run(spark, 0, ("t2m", "u10"), value=2.0).unionByName(_run(spark, 12, value=2.0))
    missing = _publish(spark, tmp_path, again)
    assert {(r["cycle"], r["variable"], r["tile_latitude"]) for r in missing.collect()} == {(0, "u10", 1)}
    assert _entries(spark, str(tmp_path / "catalog")) == {(12, "t2m")}  # the other run of the call is published
    assert not _files(tmp_path / "store/cells/source=demo/init_date=2026-05-01/cycle=0") and not _files(tmp_path / "store/meta/source=demo/init_date=2026-05-01/cycle=0")
    assert {r["value"] for r in tile_store.read_region(spark, str(tmp_path / "store"), ["t2m", "u10"], 0, 9, 0, 9).collect()} == {2.0}
    with pytest.raises(tile_store.TilesMissing, match="demo 2026-05-01 00z u10"):
        _publish(spark, tmp_path, again.filter("cycle = 0"), strict=True)
    monkeypatch.undo()
    assert _publish(spark, tmp_path, again).count() == 0
    assert _entries(spark, str(tmp_path / "catalog")) == {(0, "t2m"), (0, "u10"), (12, "t2m")}


def test_a_rewritten_run_loses_old_variables_and_is_withdrawn_first(spark, tmp_path, monkeypatch):
    root, store = str(tmp_path / "store"), str(tmp_path / "catalog")
    _publish(spark, tmp_path, _run(spark, 0, ("t2m", "u10")).unionByName(_run(spark, 6)))
    seen, write = [], publication.write_runs

    def watching(*args, **more):
        seen.append(_entries(spark, store))
        return write(*args, **more)

    monkeypatch.setattr(publication, "write_runs", watching)
    _publish(spark, tmp_path, _run(spark, 0, ("v10",)))
    assert seen == [{(6, "t2m")}] and _entries(spark, store) == {(0, "v10"), (6, "t2m")}
    assert {r["variable"] for r in tile_store.read_cells(spark, root).filter("cycle = 0").select("variable").distinct().collect()} == {"v10"}
    publication.publish_runs(_run(spark, 0).limit(0), _inits(_run(spark, 0)), root, store, SIZES)  # a run that came to nothing
    assert _entries(spark, store) == {(6, "t2m")}


def test_declared_axes_and_attributes(spark, tmp_path):
    whole = _run(spark, levels=(850.0, 500.0))
    meta = tile_store.declaration(whole, SIZES, spark.createDataFrame([("demo", "t", '{"units":"K"}')], "source string, variable string, attributes string"))
    missing = _publish(spark, tmp_path, whole.filter("latitude < 4 OR variable = 't'"), meta=meta)
    assert {(r["variable"], r["tile_latitude"]) for r in missing.collect()} == {("t2m", 1)}
    assert _publish(spark, tmp_path, whole, meta=meta).count() == 0
    entry = catalog_store.read_catalog(spark, str(tmp_path / "catalog")).first()
    assert {(d["name"], d["base"], d["level"], d["attrs"]) for d in entry["definitions"]} == {("t2m", "t2m", None, None), ("t_850", "t", "850", '{"units":"K"}'), ("t_500", "t", "500", '{"units":"K"}')}


def test_region_reads_open_no_other_tiles(spark, tmp_path):
    root = str(tmp_path / "store")
    run = _run(spark, names=("t2m", "u10"), levels=(850.0, 500.0))
    _publish(spark, tmp_path, run)
    want = run.filter("variable = 't' AND latitude BETWEEN 1 AND 3 AND longitude BETWEEN 2 AND 5 AND pressure_level = 500")
    for other in _files(tmp_path / "store/cells"):
        if "tile_latitude=1" in other or "variable=u10" in other or "variable=t2m" in other:
            with open(other, "wb") as f:
                f.write(b"not a file that can be read")
            os.remove(os.path.join(os.path.dirname(other), f".{os.path.basename(other)}.crc"))
    found = tile_store.read_region(spark, root, ["t"], 1, 3, 2, 5, 500.0)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.select(*found.columns).collect())) and found.count() == 2 * 3 * 4
    assert tile_store.read_region(spark, root, ["t"], 40, 50, 2, 5).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "tile_longitude" in plan.split("PushedFilters")[1].split("]")[0] and "tile_latitude" in plan.split("PartitionFilters")[1].split("]")[0]


@pytest.mark.parametrize(("codec", "name"), [("zstd", "ZSTD"), ("none", "UNCOMPRESSED")])
def test_codecs_of_stored_files(spark, tmp_path, codec, name):
    import pyarrow.parquet as pq

    tile_store.write_runs(_run(spark), str(tmp_path / "a"), SIZES, codec=codec, level=7)
    products.write_product(_run(spark), str(tmp_path / "b"), codec=codec, level=7)
    for folder in ("a/cells", "b"):
        column = pq.ParquetFile(_files(tmp_path / folder)[0]).metadata.row_group(0).column(0)
        assert column.compression == name


def test_coverage_after_changes_is_that_of_a_full_computation(spark, tmp_path):
    """Random upserts and withdrawals, min and max included."""
    root, rng = str(tmp_path / "catalog"), random.Random(1)
    at = lambda k: datetime.datetime(2026, 1, 1) + datetime.timedelta(hours=6 * k)
    held = {}
    for _ in range(5):
        inits = rng.sample(range(6), 2)
        if rng.random() < 0.4 and held:
            catalog_store.remove(spark, root, "demo", spark.createDataFrame([(at(k),) for k in inits], "init timestamp_ntz"))
            held = {k: v for k, v in held.items() if k not in inits}
        else:
            new = {k: rng.sample(["t", "t_850", "u", "v"], rng.randint(1, 3)) for k in inits}
            lost = inits[0] if rng.random() < 0.3 else None  # looked at, and not whole any more
            defined = spark.createDataFrame([("demo", at(k), n, n.split("_")[0], None) for k, v in new.items() for n in v], "source string, init timestamp_ntz, name string, base string, level string")
            signed = spark.createDataFrame([("demo", at(k), None if k == lost else str(rng.random())) for k in inits], "source string, init timestamp_ntz, signature string")
            catalog_store.upsert(spark, root, catalog_store.products_of(defined, signed), "demo", signed)
            held = {k: v for k, v in (held | new).items() if k != lost}
        full = catalog.coverage(catalog_store.stored_members(catalog_store.read_catalog(spark, root)))
        rows = lambda f: sorted(tuple(r) for r in f.select("source", "name", "first_init", "last_init", "n_inits").collect())
        assert rows(catalog_store.read_coverage(spark, root)) == rows(full)
        want = {}
        for k, v in held.items():
            for name in {x for n in v for x in (n, n.split("_")[0])}:
                want.setdefault(name, []).append(at(k))
        assert rows(full) == sorted(("demo", n, min(x), max(x), len(x)) for n, x in want.items())


def _reconcile(spark, tmp_path, **more):
    found = publication.apply_reconcile(spark, str(tmp_path / "store"), str(tmp_path / "catalog"), **({"apply": True, "min_age_seconds": 0} | more))
    return {r["id_source"]: (r["action"], r["added"], r["changed"], r["removed"], r["total"], r["applied"]) for r in found.collect()}


def test_reconcile_is_applied(spark, tmp_path):
    store, path = str(tmp_path / "store"), str(tmp_path / "catalog")
    write = lambda *runs: [tile_store.write_runs(r, store, SIZES) for r in runs]
    write(_run(spark, 0))
    assert _reconcile(spark, tmp_path, apply=False) == {"demo": ("rebuilt", 1, 1, 0, 1, 0)}
    assert not os.path.exists(path)  # a dry run writes nothing
    assert _reconcile(spark, tmp_path, min_age_seconds=3600)["demo"][0] == "deferred" and not os.path.exists(path)
    assert _reconcile(spark, tmp_path) == {"demo": ("rebuilt", 1, 1, 0, 1, 1)}
    before = _files(path)
    assert _reconcile(spark, tmp_path) == {"demo": ("unchanged", 0, 0, 0, 1, 0)} and _files(path) == before
    write(_run(spark, 6, ("t2m", "u10")), _run(spark, 0, ("v10",)))  # a late run and a rewritten one
    assert _reconcile(spark, tmp_path) == {"demo": ("repaired", 1, 2, 0, 2, 1)}
    assert _entries(spark, path) == {(0, "v10"), (6, "t2m"), (6, "u10")}
    tile_store.drop_runs(spark, store, _inits(_run(spark, 6)))
    assert _reconcile(spark, tmp_path) == {"demo": ("repaired", 0, 0, 1, 1, 1)}
    assert {r["name"]: r["n_inits"] for r in catalog_store.read_coverage(spark, path).collect()} == {"v10": 1}
    assert catalog_store.stored_state(catalog_store.read_catalog(spark, path)).first()["ready"] == 1


def test_reconcile_keeps_the_catalog_where_it_is_not_sure(spark, tmp_path):
    store, path = str(tmp_path / "store"), str(tmp_path / "catalog")
    tile_store.write_runs(_run(spark, 0).unionByName(_run(spark, 0, source="other")), store, SIZES)
    _reconcile(spark, tmp_path)
    before = _entries(spark, path)
    tile_store.write_runs(_run(spark, 6).unionByName(_run(spark, 6, source="other")), store, SIZES)
    moving = lambda: tile_store.write_runs(_run(spark, 12), store, SIZES)
    found = _reconcile(spark, tmp_path, before_commit=moving)
    assert {s: (x[0], x[-1]) for s, x in found.items()} == {"demo": ("refused", 0), "other": ("repaired", 1)}
    assert {r["init"].hour for r in catalog_store.read_catalog(spark, path).filter("source = 'demo'").collect()} == {0} and before
    assert _reconcile(spark, tmp_path)["demo"] == ("repaired", 2, 2, 0, 3, 1)
    shutil.rmtree(f"{store}/meta/source=demo/init_date=2026-05-01/cycle=6")  # cells without a declaration: not finished
    assert _reconcile(spark, tmp_path)["demo"][:4] == ("repaired", 0, 0, 1)
    for part in ("cells", "meta"):
        shutil.rmtree(f"{store}/{part}/source=other")
    assert _reconcile(spark, tmp_path)["other"][0] == "error"  # a folder that vanished is no deletion
    os.makedirs(f"{store}/cells/source=other")
    assert _reconcile(spark, tmp_path)["other"] == ("repaired", 0, 0, 2, 0, 1)
    assert {r["source"] for r in catalog_store.read_catalog(spark, path).select("source").collect()} == {"demo"}


def test_damaged_coverage_is_rebuilt(spark, tmp_path):
    path = str(tmp_path / "catalog")
    tile_store.write_runs(_run(spark, 0).unionByName(_run(spark, 0, source="other")), str(tmp_path / "store"), SIZES)
    _reconcile(spark, tmp_path)
    wrong = catalog_store.read_coverage(spark, path).withColumn("n_inits", F.when(F.col("source") == "demo", 2).otherwise(1).cast("long"))
    catalog_store._write(spark.createDataFrame(wrong.collect(), wrong.schema), f"{path}-coverage")
    found = _reconcile(spark, tmp_path)
    assert (found["demo"][0], found["other"][0]) == ("rebuilt", "unchanged")
    assert {r["n_inits"] for r in catalog_store.read_coverage(spark, path).collect()} == {1}
