"""Forecast-shaped views over the driver's tables, for both engines.

One text serves Spark and DuckDB: ``§`` stands for the suffix that makes a
number a double, and tables are in braces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FX_RAW = """
SELECT CASE WHEN k = 10 THEN 'graphcast' WHEN k > 10 THEN 'dwd-icon' WHEN l_returnflag = 'A' THEN 'gfs-0p25' WHEN l_returnflag = 'N' THEN 'ifs-hres' ELSE 'aifs-single' END AS source,
       CAST(date_trunc('year', l_shipdate) AS DATE) AS init_date, CAST((l_orderkey % 2) * 12 AS INT) AS cycle,
       CAST((l_linenumber - 1) * 3 AS INT) AS step_hours,
       CAST(CASE WHEN l_tax >= 0.075 THEN 0 ELSE (l_linenumber - 1) * 3 END AS INT) AS file_step_hours,
       l_orderkey * 8 + l_linenumber AS msg_no, type_of_level, CAST(level AS DOUBLE) AS level, step_type, short_name,
       CAST(55 - (l_partkey % 9) * 5 AS DOUBLE) AS latitude, CAST(60 + (l_suppkey % 25) * 10 AS DOUBLE) AS longitude,
       CASE WHEN l_discount < 0.005 THEN NULL ELSE CAST(l_extendedprice AS DOUBLE) END AS value
FROM {lineitem} JOIN (SELECT * FROM (VALUES
 (0, 'heightAboveGround', 10§, 'instant', 'u10'), (1, 'heightAboveGround', 80§, 'instant', 'pres'),
 (2, 'heightAboveGround', 100§, 'instant', 'u'), (3, 'isobaricInhPa', 850§, 'instant', 't'),
 (4, 'isobaricInhPa', 500§, 'instant', 't'), (5, 'surface', 0§, 'instant', 't'),
 (6, 'surface', 0§, 'accum', 'tp'), (7, 'atmosphere', 0§, 'avg', 'tcc'),
 (8, 'boundaryLayerCloudLayer', 0§, 'avg', 'tcc'), (9, 'highCloudLayer', 0§, 'avg', 'avg_hcc'),
 (10, 'surface', 0§, 'accum', 'unknown'), (11, 'generalVerticalLayer', 59§, 'instant', 'u'),
 (12, 'generalVerticalLayer', 60§, 'instant', 'u'), (13, 'isobaricLayer', 400§, 'instant', 'q'))
 AS v(k, type_of_level, level, step_type, short_name)) cat ON (l_partkey * 7 + l_orderkey) % 14 = k
"""

FX_CELLS = """
SELECT c_custkey AS cell_id, CAST(15 + (c_custkey * 37 % 4001) / 100.0 AS DOUBLE) AS clat,
       CAST(70 + (c_custkey * 101 % 7001) / 100.0 AS DOUBLE) AS clon FROM {customer}
"""

FX_TARGETS = """
SELECT DISTINCT CAST(15 + (p_partkey % 9) * 5 AS DOUBLE) AS tlat, CAST(70 + (p_partkey % 15) * 5 AS DOUBLE) AS tlon FROM {part}
"""

FX_STEP_FILES = """
SELECT event_id, ts, CASE user_id % 3 WHEN 0 THEN 'gfs-0p25' WHEN 1 THEN 'ifs-hres' ELSE 'dwd-icon' END AS source,
       CAST(ts AS DATE) AS init_date, CAST(floor(hour(ts) / 6) * 6 AS INT) AS cycle, CAST((event_id % 5) * 3 AS INT) AS step_hours FROM {events}
"""

FX_MANIFESTS = (
    """
SELECT source, init_date, cycle, count(*) AS n_files, CASE WHEN min(event_id) % 5 = 0 THEN 1 ELSE 0 END AS n_failures,
       max(ts) AS manifest_time, CASE WHEN count(*) % 4 = 0 THEN NULL ELSE max(ts) END AS completed_at
FROM ("""
    + FX_STEP_FILES
    + ") ev GROUP BY source, init_date, cycle"
)

FX_OUTPUTS = (
    """
SELECT source, init_date, cycle, CASE WHEN n_files % 5 = 0 THEN 0 ELSE 1 END AS complete,
       CASE WHEN n_files % 3 = 0 THEN TIMESTAMP '2000-01-01 00:00:00' ELSE manifest_time END AS marker_time
FROM ("""
    + FX_MANIFESTS
    + ") m WHERE day(init_date) % 3 <> 0"
)

FX_PROB = """
SELECT 'ifs-ens-probabilities' AS source, CAST(date_trunc('month', l_shipdate) AS DATE) AS init_date,
       CASE l_partkey % 5 WHEN 0 THEN 'tpg20' WHEN 1 THEN 'tpg50' WHEN 2 THEN 'tpg100' WHEN 3 THEN '10fgg15' ELSE '10fgg25' END AS variable,
       CAST(24 + (l_orderkey % 29) * 12 AS INT) AS step_hours, CAST(24 AS INT) AS window_hours, l_orderkey * 8 + l_linenumber AS msg_no,
       CASE WHEN l_discount < 0.005 THEN NULL WHEN l_quantity > 49.5 THEN 101§ ELSE CAST(l_quantity * 2 AS DOUBLE) END AS value
FROM {lineitem}
"""

FX_HOT = "SELECT concat('f', CAST(doc_id AS VARCHAR(20))) AS path, SHA(text) AS h FROM {documents}"
FX_COLD = "SELECT concat('f', CAST(doc_id AS VARCHAR(20))) AS path, SHA(CASE WHEN doc_id % 19 = 0 THEN concat(text, 'x') ELSE text END) AS h FROM {documents} WHERE doc_id % 17 <> 0"

FX_STORES = """
SELECT o_orderkey AS store_id, concat(CASE WHEN o_orderkey % 13 = 0 THEN '.' ELSE '' END,
         CASE WHEN o_orderkey % 29 = 0 THEN '20261341' ELSE replace(substr(CAST(o_orderdate AS VARCHAR(30)), 1, 10), '-', '') END, '_',
         CASE o_orderkey % 4 WHEN 0 THEN '00' WHEN 1 THEN '06' WHEN 2 THEN '12' ELSE '18' END, 'z_',
         CASE o_custkey % 3 WHEN 0 THEN 'graphcast' WHEN 1 THEN 'gfs-0p25' ELSE 'ifs-hres' END,
         CASE o_custkey % 5 WHEN 0 THEN '-sfc' WHEN 1 THEN '-pres' ELSE '' END, CASE WHEN o_orderkey % 31 = 0 THEN '.tmp' ELSE '.zarr' END) AS name,
       CAST(o_orderkey % 7 AS BIGINT) AS size_bytes, o_orderdate AS modified,
       CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE 1 END AS complete FROM {orders}
"""

FX_EVENTS = """
SELECT l_orderkey * 8 + l_linenumber AS msg_no, CAST(l_shipdate AS DATE) AS init_date,
       CASE l_partkey % 8 WHEN 0 THEN 'tpg1' WHEN 1 THEN 'tpg50' WHEN 2 THEN '10fgg15' WHEN 3 THEN '10spg10' WHEN 4 THEN '2tl273' WHEN 5 THEN 'tpl01' WHEN 6 THEN 'tprg3' ELSE 'tprl1' END AS param,
       CASE l_suppkey % 4 WHEN 0 THEN 'instant' WHEN 1 THEN 'max' WHEN 2 THEN 'accum' ELSE 'avg' END AS step_type,
       CAST(24 + (l_orderkey % 29) * 12 AS INT) AS step_hours,
       CAST(24 + (l_orderkey % 29) * 12 - CASE l_linenumber % 4 WHEN 0 THEN 0 WHEN 1 THEN 24 WHEN 2 THEN 48 ELSE 72 END AS INT) AS start_step,
       CASE WHEN l_orderkey % 17 = 0 THEN 'fc' ELSE 'ep' END AS data_type, CASE WHEN l_orderkey % 19 = 0 THEN '1' ELSE '%' END AS units,
       CASE WHEN l_orderkey % 23 = 0 THEN 2 ELSE 1 END AS step_units, CASE WHEN l_linenumber % 4 = 0 THEN 5 WHEN l_orderkey % 37 = 0 THEN 8 ELSE 9 END AS template,
       CASE WHEN l_orderkey % 3 = 0 THEN 3 ELSE 0 END AS prob_type,
       CASE l_partkey % 8 WHEN 0 THEN 1§ WHEN 1 THEN 50§ WHEN 2 THEN 15§ WHEN 3 THEN 10§ WHEN 4 THEN 273.15§§ WHEN 5 THEN 0.1§§ WHEN 6 THEN 3§ / 86400 ELSE 2§ / 86400 END AS lower_limit
FROM {lineitem}
"""

FX_CAMS = """
SELECT l_orderkey % 50 AS cube, l_orderkey * 8 + l_linenumber AS msg_no,
       CASE l_partkey % 6 WHEN 0 THEN 169 WHEN 1 THEN 228 WHEN 2 THEN 228028 WHEN 3 THEN 210207 WHEN 4 THEN 130 ELSE 176 END AS param_id,
       CASE WHEN l_suppkey % 40 = 0 THEN 'an' ELSE 'fc' END AS data_type,
       CASE l_partkey % 6 WHEN 0 THEN 'J m**-2' WHEN 1 THEN CASE WHEN l_suppkey % 9 = 0 THEN 'ft' ELSE 'kg m**-2' END WHEN 2 THEN 'm s**-1' ELSE '~' END AS units,
       CASE WHEN l_suppkey % 25 = 0 THEN 'avg' ELSE 'instant' END AS step_type,
       CAST((l_linenumber - 1) * 3 AS INT) AS step_hours,
       CASE WHEN l_linenumber = 1 AND l_orderkey % 4 <> 0 THEN 0§ ELSE CAST(l_quantity AS DOUBLE) END AS value
FROM {lineitem}
"""

VIEWS = {
    "fx_raw": FX_RAW, "fx_cells": FX_CELLS, "fx_targets": FX_TARGETS, "fx_step_files": FX_STEP_FILES, "fx_manifests": FX_MANIFESTS,
    "fx_outputs": FX_OUTPUTS, "fx_prob": FX_PROB, "fx_hot": FX_HOT, "fx_cold": FX_COLD, "fx_stores": FX_STORES, "fx_events": FX_EVENTS, "fx_cams": FX_CAMS,
}
TABLES = ("lineitem", "orders", "customer", "part", "events", "documents")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view in Spark; only the columns that it needs are read."""
    text = VIEWS[name].replace("§§", "D").replace("§", "D")
    text = text.replace("SHA(CASE WHEN doc_id % 19 = 0 THEN concat(text, 'x') ELSE text END)", "sha2(CASE WHEN doc_id % 19 = 0 THEN concat(text, 'x') ELSE text END, 256)").replace("SHA(text)", "sha2(text, 256)")
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def duck(body: str, *names: str) -> str:
    """DuckDB SQL: ``body`` with the named views before it."""
    texts = []
    for n in names:
        text = VIEWS[n].replace("§§", "").replace("§", ".0").replace("SHA(", "sha256(")
        for t in TABLES:
            text = text.replace("{" + t + "}", t)
        texts.append(f"{n} AS ({text})")
    body = body.strip()

    return "WITH " + ", ".join(texts) + (", " + body[5:] if body.startswith("WITH ") else "\n" + body)
