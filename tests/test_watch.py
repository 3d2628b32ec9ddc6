"""Streams of manifests: each handled once, late announcements, runs published as they arrive."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from aerolith.sources import catalog_store, tile_store
from aerolith.sources.tile_store import Sizes
from aerolith.streaming import watch


def _manifest(folder, name, cycle=0, steps=(0,), at=1_780_000_000, **more):
    body = {"schema_version": 1, "source": {"name": "demo"}, "date": "20260501", "cycle": cycle, "completed_at": "2026-05-01T06:00:00Z", "files": [{"step_hours": s, "path": f"f{s:03}", "size_bytes": 3, "sha256": "x"} for s in steps], "failures": []}
    path = folder / f"{name}.manifest.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(body | more))
    os.utime(path, (at, at))


class Crash(BaseException):
    """The driver dies."""


def test_a_batch_that_comes_again_is_not_handled_twice(spark, tmp_path):
    seen, dies = [], [True]

    def handle(rows):
        cycle = rows.first()["cycle"]
        seen.append(cycle)
        if cycle == 12 and dies[0]:
            raise Crash
        if cycle == 18:
            raise ValueError("bad run")

    for cycle in (0, 6, 12, 18):
        _manifest(tmp_path / "in", f"m{cycle:02}", cycle)
    rows, _ = spark.read.schema(watch.MANIFEST).option("multiLine", True).json(str(tmp_path / "in")).select("*", "_metadata").orderBy("cycle"), None
    sink = watch._ledgered(spark, str(tmp_path / "c"), handle)
    with pytest.raises(Crash):
        sink(rows, 0)
    assert seen == [0, 6, 12]
    dies[0] = False
    sink(rows, 0)
    sink(rows, 0)
    assert seen == [0, 6, 12, 12, 18]  # only what the crash cut short comes again
    ledger = watch.read_ledger(spark, str(tmp_path / "c"))
    assert {(r["manifest_path"].split("/")[-1][:3], r["status"]) for r in ledger.collect()} == {("m00", "done"), ("m06", "done"), ("m12", "done"), ("m18", "failed")}
    assert [(r["cycle"], r["error"]) for r in spark.read.json(str(tmp_path / "c-failed")).collect()] == [(18, "bad run")]


def test_late_announcements_across_restarts(spark, tmp_path):
    seen, root = [], tmp_path / "in"
    handle = lambda rows: seen.extend((r["source"]["name"], r["cycle"], len(r["files"]), r["_metadata"]["file_path"].split("/")[-1][0]) for r in rows.collect())

    def go():
        watch.watch(spark, str(root), str(tmp_path / "c"), handle, once=True, late=True).awaitTermination(200)
        out = sorted(seen)
        seen.clear()
        return out

    _manifest(root, "a", 0, (0, 3))
    _manifest(root, "b", 12, (0,))
    _manifest(root, "c", 12, (0, 3, 6), at=1_780_000_050)  # came with b, and is newer
    assert go() == [("demo", 0, 2, "a"), ("demo", 12, 3, "c")]
    _manifest(root, "d", 0, (0, 3, 6), at=1_780_000_100)
    _manifest(root, "e", 12, (0, 3), at=1_780_000_100)  # newer, but of fewer steps
    _manifest(root, "f", 6, (0,), schema_version=2)
    assert go() == [("demo", 0, 3, "d")]
    _manifest(root, "g", 0, (0, 3, 6, 9), at=1_770_000_000)  # of more steps, but older
    _manifest(root, "h", 12, (0, 3, 6, 9), at=1_780_000_200)
    assert go() == [("demo", 12, 4, "h")]


def test_arriving_runs_are_published_once(spark, tmp_path, monkeypatch):
    root, store, path = str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "catalog")
    built = []

    def build(manifests):
        built.append(manifests.count())
        cell = {"variable": F.lit("t2m"), "pressure_level": F.lit(None).cast("double"), "step_hours": F.lit(0), "valid_time": F.lit("2026-05-01").cast("timestamp_ntz"), "latitude": F.explode(F.array(F.lit(1.0), F.lit(2.0))), "longitude": F.lit(2.0), "value": F.lit(3.0)}
        return manifests.select("source", "init_date", "cycle", *(v.alias(k) for k, v in cell.items()))

    for cycle in (0, 12):
        _manifest(tmp_path / "in", f"m{cycle}", cycle)
    for k in range(2):  # two watches, as after the loss of a checkpoint
        watch.watch(spark, root, str(tmp_path / f"c{k}"), watch.publication_upkeep(build, store, path, Sizes(1, 1)), once=True).awaitTermination(300)
        assert {r["status"] for r in watch.read_ledger(spark, str(tmp_path / f"c{k}")).collect()} == {"done"}
        assert sorted(r["init"].hour for r in catalog_store.read_catalog(spark, path).collect()) == [0, 12]
    assert built == [1, 1] and tile_store.read_region(spark, store, ["t2m"], 0, 5, 0, 5).count() == 4
