"""Sources with hooks of their own, names of raw files, headers before cells."""

from __future__ import annotations

import datetime
import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerolith.operators import fields
from aerolith.plans import sources
from aerolith.plans.pipeline import build_product
from aerolith.sources import manifests, products

DAY = datetime.date(2026, 5, 1)
RAW = "source string, init_date date, cycle int, step_hours int, file_step_hours int, msg_no long, type_of_level string, level double, step_type string, short_name string, latitude double, longitude double, value double"


def _raw(spark, source, points, name="u10"):
    return spark.createDataFrame([(source, DAY, 0, 0, 0, k, "heightAboveGround", 10.0, "instant", name, float(y), float(x), float(k)) for k, (y, x) in enumerate(points)], RAW)


def test_a_name_is_taken_once():
    known = sources.Sources(sources.Source("a"), sources.Source("b"))
    assert known.names() == ["a", "b"] and known["a"].name == "a"
    with pytest.raises(ValueError, match="'a' is registered"):
        known.register(sources.Source("a"))
    with pytest.raises(KeyError, match="unknown source 'c'; known are a, b"):
        known["c"]


def test_sources_are_built_in_one_call(spark, tmp_path, monkeypatch):
    cells = spark.createDataFrame([(1, 20.1, 80.1), (2, 20.9, 80.9), (3, 21.0, 80.0), (4, 60.0, 10.0)], "cell_id long, clat double, clon double")
    icon = _raw(spark, "dwd-icon", [(0, 0)] * 5).withColumn("cell_id", F.col("msg_no")).drop("latitude", "longitude")
    make = lambda: sources.unstructured(spark, "dwd-icon", "r1", cells, (80.0, 81.0, 20.0, 21.0), 1.0, str(tmp_path / "remaps"))
    seen = []
    known = sources.Sources(make(), sources.boxed("graphcast", 0.0, 5.0, 0.0, 5.0), sources.Source("gfs-0p25", check=lambda p: p.withColumn("checked", F.lit(1)), contract=lambda p, m: seen.append(1) or p.join(m, fields.INIT, "left_anti").select(*fields.INIT, F.lit("no manifest").alias("check"))))
    raw = icon.unionByName(_raw(spark, "gfs-0p25", [(1, 1), (50, 50)]), allowMissingColumns=True).unionByName(_raw(spark, "graphcast", [(1, 1), (50, 50)]), allowMissingColumns=True)
    built = known.build(raw, 0.0, 100.0, 0.0, 90.0)
    found = {(r["source"], r["latitude"], r["longitude"], r["value"], r["checked"]) for r in built.collect()}
    assert found - {x for x in found if x[1:3] == (20.0, 81.0)} == {("gfs-0p25", 1.0, 1.0, 0.0, 1), ("gfs-0p25", 50.0, 50.0, 1.0, 1), ("graphcast", 1.0, 1.0, 0.0, None), ("dwd-icon", 20.0, 80.0, 1.0, None), ("dwd-icon", 21.0, 81.0, 2.0, None), ("dwd-icon", 21.0, 80.0, 3.0, None)}
    assert [x[3] in (1.0, 2.0) for x in found if x[1:3] == (20.0, 81.0)] == [True]  # about as far from either
    assert known.violations(built, raw.limit(0).select(*fields.INIT)).distinct().count() == 1 and seen
    monkeypatch.setattr(sources, "nearest_cell", lambda *a, **k: pytest.fail("searched again"))
    assert sources.Sources(make()).build(icon, 0.0, 100.0, 0.0, 90.0).count() == 4  # the pairs are read, not searched
    with pytest.raises(Exception, match="unknown source mystery"):
        known.build(_raw(spark, "mystery", [(1, 1)]).withColumn("cell_id", F.lit(1)), 0.0, 100.0, 0.0, 90.0).collect()


def test_names_of_raw_files_become_manifests(spark, tmp_path):
    root = tmp_path / "raw"
    for name in ("gfs-0p25/20260501/00z/f000.subset.grib2", "gfs-0p25/20260501/00z/f003.subset.grib2", "gfs-0p25/20260502/12z/f000.subset.grib2", "gfs-0p25/20260502/12z/f003.subset.grib2.part", "gfs-0p25/20269999/00z/f000.subset.grib2", "odd/run-2026050106/step_024.bin", "odd/notes.txt"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"x")
    forms = manifests.grammars(spark, {"odd": r"^odd/run-(\d{8})(\d{2})/step_(\d{3})\.bin$"})
    files, rejected = manifests.named_files(products.listing(spark, str(root)), forms)
    assert sorted(r["path"] for r in rejected.collect()) == ["gfs-0p25/20260502/12z/f003.subset.grib2.part", "gfs-0p25/20269999/00z/f000.subset.grib2", "odd/notes.txt"]
    hashed = files.join(products.file_hashes(spark, str(root)).select("path", F.col("h").alias("sha256")), "path")
    made = manifests.build_manifests(hashed, files.limit(0), F.lit(DAY), F.lit(DAY + datetime.timedelta(3)))
    assert manifests.write_manifests(made, str(root)) == 3
    assert os.path.exists(root / "gfs-0p25/20260502/12z/20260502_12z_gfs-0p25.manifest.json") and os.path.exists(root / "odd/20260501/06z/20260501_06z_odd.manifest.json")
    good, bad = manifests.read_manifests(spark, str(root))
    got = {(r["source"], r["init_date"].day, r["cycle"]): [f["step_hours"] for f in r["files"]] for r in good.collect()}
    assert got == {("gfs-0p25", 1, 0): [0, 3], ("gfs-0p25", 2, 12): [0], ("odd", 1, 6): [24]} and bad.count() == 0
    paths = [r["manifest_path"] for r in good.collect()]
    assert paths == sorted(paths) and all(len(f["sha256"]) == 64 for r in good.collect() for f in r["files"])
    again = manifests.build_manifests(hashed, good, F.lit(DAY), F.lit(DAY + datetime.timedelta(3)))
    assert manifests.write_manifests(again, str(root)) == 0


HEADER = "path string, source string, init_date date, cycle int, step_hours int, file_step_hours int, msg_no long, type_of_level string, level double, step_type string, short_name string, west double, east double, south double, north double"


def _headers():
    def decode(path, content):
        rows = [{"path": path, **m} for m in json.loads(content)["messages"]]
        frame = pd.DataFrame([{k: v for k, v in r.items() if k != "cells"} | {"west": min(c[1] for c in r["cells"]), "east": max(c[1] for c in r["cells"]), "south": min(c[0] for c in r["cells"]), "north": max(c[0] for c in r["cells"])} for r in rows])
        return frame.assign(init_date=DAY)[[f.split()[0] for f in HEADER.split(", ")]]

    return decode


def _decoder(log):
    def decode(path, content, numbers):
        with open(f"{log}/{os.path.basename(path)}-{'-'.join(map(str, numbers))}", "w"):
            pass
        rows = [{k: v for k, v in m.items() if k != "cells"} | {"latitude": y, "longitude": x, "value": v} for m in json.loads(content)["messages"] if m["msg_no"] in numbers for y, x, v in m["cells"]]
        return pd.DataFrame(rows).assign(init_date=DAY)[[f.split()[0] for f in RAW.split(", ")]]

    return decode


def test_headers_tell_which_files_are_decoded(spark, tmp_path):
    """Files of earlier passes, and those without a message in the box, are not opened for cells."""
    folder, log = tmp_path / "in", tmp_path / "log"
    folder.mkdir()
    log.mkdir()

    def message(number, step, file_step, name="u10", x=10.0):
        return {"source": "demo", "cycle": 0, "step_hours": step, "file_step_hours": file_step, "msg_no": number, "type_of_level": "heightAboveGround", "level": 10.0, "step_type": "instant", "short_name": name, "cells": [[5.0, x, float(number)], [6.0, x + 1, float(number)]]}

    files = {"f000": [message(1, 0, 0), message(2, 3, 0)], "f003": [message(3, 3, 3), message(4, 3, 3, "v10", 200.0)], "early": [message(5, 3, 1)], "far": [message(6, 0, 0, "v10", 100.0), message(7, 6, 6, "v10", 350.0)]}
    for name, messages in files.items():
        (folder / name).write_text(json.dumps({"messages": messages}))
    headers = products.load_headers(spark, str(folder), _headers(), HEADER)
    wanted = fields.needed_messages(headers, -20.0, 20.0, 0.0, 10.0)
    cells = products.load_messages(wanted.select("path", "msg_no"), _decoder(str(log)), RAW)
    product = build_product(cells, -20.0, 20.0, 0.0, 10.0, headers=fields.header_slabs(headers))
    found = sorted((r["variable"], r["step_hours"], r["longitude"], r["value"]) for r in product.collect())
    assert found == [("u10", 0, 10.0, 1.0), ("u10", 0, 11.0, 1.0), ("u10", 3, 10.0, 3.0), ("u10", 3, 11.0, 3.0), ("v10", 6, -10.0, 7.0), ("v10", 6, -9.0, 7.0)]
    assert set(os.listdir(log)) == {"f000-1", "f003-3", "far-7"}
    every = products.load_messages(headers.select("path", "msg_no"), _decoder(str(log)), RAW)
    assert sorted(found) == sorted((r["variable"], r["step_hours"], r["longitude"], r["value"]) for r in build_product(every, -20.0, 20.0, 0.0, 10.0).collect())
    assert products.load_messages(headers.limit(0), _decoder(str(log)), RAW).count() == 0
