"""The registered queries on the smallest tables: columns, rows, and their SQL where there is one."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from aerolith.llm import html, language, mixing, packing, registry, secrets, winnowing

COLUMNS = {
    "op2_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op3_secrets": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op7_covertree": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op8_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op9_jaccard": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op10_winnowing": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op11_contamination": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op12_manifest": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
    "op13_runs": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_of_contracts(spark, small, name):
    found = registry.QUERIES[name](spark, small)
    kinds = dict(found.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    source = "embeddings" if name == "op7_covertree" else "documents"
    assert found.count() == spark.read.parquet(f"{small}/{source}.parquet").count()


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_queries_equal_their_sql(spark, small, name):
    import duckdb

    base = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    found = registry.QUERIES[name](spark, small)
    want = base.sql(registry.ORACLE_SQL[name])
    order = sorted(found.columns)
    assert order == sorted(want.columns)
    rows = lambda frame: sorted(tuple(None if x is None or x != x else str(x)[:10] if hasattr(x, "year") else x for x in r) for r in frame)
    assert rows(map(tuple, found.select(*order).collect())) == rows(base.sql(f"SELECT {', '.join(order)} FROM ({registry.ORACLE_SQL[name]})").fetchall())


def test_digest_of_base_spans(spark, small):
    """base_sha256 and the counts say what the plain definition finds; the field only adds spans."""
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    for r in registry.QUERIES["op3_secrets"](spark, small).collect():
        base = [f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in secrets.base_spans(texts[r["doc_id"]] or "")]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert [x for x in spans if not x.startswith("crf")] == base
        assert [r[f"n_{k}"] for k in secrets.KINDS[:3]] == [sum(x.startswith(k + ":") for x in base) for k in secrets.KINDS[:3]]


CLASHING = ("key", "size", "part", "n", "deal", "shard", "bin", "bucket", "ord", "ahead", "spans", "kind", "score", "lang_pred", "copies", "target", "taken", "source_size", "n_chars", "fingerprint", "id", "nth", "doc", "n_lines", "n_dropped", "gone", "made", "rest", "component", "r1", "rep")
OPERATORS = {
    "mix": mixing.mix,
    "scan": lambda docs: secrets.scan(docs, None),
    "pack": packing.pack,
    "extract": lambda docs: html.extract(docs.withColumnsRenamed({"doc_id": "page_id", "text": "html"})),
    "predict": lambda docs: language.predict(docs, None),
    "edits": winnowing.fingerprints_and_edits,
}


def _odd_documents(spark):
    rows = [(1, "one two", "en", "a"), (1, "one two", "en", "a"), (None, None, None, None), (3, "", "de", "a"), (4, "x " * 3000, "en", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_other_columns_change_nothing(spark, name):
    docs = _odd_documents(spark)
    more = docs.select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASHING)))
    rows = lambda frame: sorted(map(repr, frame.drop("bin").collect()))
    assert rows(OPERATORS[name](more)) == rows(OPERATORS[name](docs))
    assert OPERATORS[name](more.limit(0)).count() == 0


def test_stages_keep_other_columns(spark, small):
    import corpus_pipeline

    docs = _odd_documents(spark).select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASHING)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, small)
        assert found.columns == docs.columns, name
        assert all(r[c] == k for r in found.collect() for k, c in enumerate(CLASHING) if c != "n_chars"), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small).agg(F.sum("length")).first()[0] == 3004
