"""Document fingerprints by winnowing.

A text's k-grams of code points are hashed with a rolling polynomial; in every
window of w consecutive k-grams the least hash is chosen, the rightmost of
equal ones, and its position is kept. Any run of at least ``w + k - 1``
characters that two texts share therefore gives both a common hash.

Defined cases: a null text is an empty text and has the empty fingerprint; a
text with fewer than k characters has one gram, itself, at position 0; a text
with fewer than w grams is one window; equal texts have equal fingerprints;
two empty fingerprints have likeness 1, an empty and a full one 0. Rows that
repeat, also with the same id, keep their row each. Null ids come last in
descending order. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import table
from .textarrays import SLICE_BYTES, code_points, mix, powers

GRAM, WINDOW = 20, 32
#: Text of a bucket, about.
BUCKET_BYTES = 64 << 20
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)
_PLACE = np.uint64(0xFFFFFF)


class Fingerprints:
    """The chosen (hash, position) pairs of each of some texts, text by text."""

    def __init__(self, texts: list[str], gram: int = GRAM, window: int = WINDOW):
        codes, edges = code_points(texts)
        lengths = np.diff(edges)
        n = len(codes)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=sums[1:])
        grams = np.where(lengths >= gram, lengths - gram + 1, (lengths > 0).astype(np.int64))
        gram_edges = np.concatenate([[0], np.cumsum(grams)])
        offset = np.repeat(edges[:-1] - gram_edges[:-1], grams)
        starts = np.arange(gram_edges[-1]) + offset
        width = np.repeat(np.minimum(lengths, gram), grams)
        hashes = mix((sums[starts + width] - sums[starts]) * powers(_BASE_INV, n + 1)[starts] + width.astype(np.uint64))
        first = np.repeat(gram_edges[:-1], grams)
        place = (np.arange(gram_edges[-1]) - first).astype(np.uint64)
        keys = (hashes & ~_PLACE) | (_PLACE - (place & _PLACE))
        least, at, owner = self._windows(keys, grams, gram_edges, window)
        new = np.ones(len(least), bool)
        new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
        least, at, owner = least[new], at[new], owner[new]
        low = (_PLACE - (least & _PLACE)).astype(np.int64)
        self.positions = at + ((low - at) & int(_PLACE))
        self.hashes = least >> np.uint64(24)
        self.owners = owner
        self.bounds = np.searchsorted(owner, np.arange(len(texts) + 1))

    @staticmethod
    def _windows(keys: np.ndarray, grams: np.ndarray, edges: np.ndarray, window: int):
        """Least key of each window, the window's start in its text, and the text."""
        found = []
        if len(keys) >= window:
            least, span = keys, 1
            while span * 2 <= window:
                least, span = np.minimum(least[:-span], least[span:]), span * 2
            if window > span:
                least = np.minimum(least[: len(keys) - window + 1], least[window - span :])
            owner = np.repeat(np.arange(len(grams)), grams)
            whole = owner[: len(least)] == owner[window - 1 :]
            owner = owner[: len(least)][whole]
            found.append((least[whole], np.flatnonzero(whole) - edges[owner], owner))
        few = np.flatnonzero((grams > 0) & (grams < window))
        if len(few):
            least = np.array([keys[edges[r] : edges[r + 1]].min() for r in few], np.uint64)
            found.append((least, np.zeros(len(few), np.int64), few))
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        least, at, owner = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(owner, kind="stable")
        return least[order], at[order], owner[order]

    def strings(self) -> list[str]:
        """For each text 18 hex digits a chosen gram: hash (10), position (8)."""
        packed = np.empty((len(self.hashes), 9), np.uint8)
        packed[:, :5] = self.hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:]
        packed[:, 5:] = self.positions.astype(">u4").view(np.uint8).reshape(-1, 4)
        digits = packed.tobytes().hex()
        return [digits[18 * a : 18 * b] for a, b in zip(self.bounds[:-1], self.bounds[1:], strict=True)]

    def distinct(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct hashes of the given texts, and the place of each text among them."""
        counts = self.bounds[rows + 1] - self.bounds[rows]
        owner = np.repeat(np.arange(len(rows)), counts)
        index = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(self.bounds[rows], counts)
        hashes = self.hashes[index]
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        return hashes[new], owner[new]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Jaccard likeness of n pairs of sets of hashes, 1 for two empty sets."""
    hashes, owners = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    both = np.bincount(owners[1:][(hashes[1:] == hashes[:-1]) & (owners[1:] == owners[:-1])], minlength=n)
    either = np.bincount(owners, minlength=n) - both
    return np.where(either == 0, 1.0, both / np.maximum(either, 1))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Id, n_chars and fingerprint of every row's whole text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(map(len, texts), pa.int64()), pa.array(Fingerprints(texts, gram, window).strings(), pa.string())], ["doc_id", "n_chars", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_chars long, fingerprint string")


def _chunks(rows):
    ids, texts, size = [], [], 0
    for i, t in rows:
        t = t or ""
        if texts and size + len(t) > SLICE_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(i)
        texts.append(t)
        size += len(t)
    if texts:
        yield ids, texts


def _followed(docs: DataFrame) -> DataFrame:
    """Rows (bucket, ahead, doc_id, ord, text): each bucket's rows in descending order of id, then, marked ahead, the row that follows its last.

    One shuffle of the texts. The bounds of buckets, one for ``BUCKET_BYTES`` of
    text and one a shuffle partition at least, and the largest id of each are all
    that the driver sees. Rows of one id stand in one bucket.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    keyed = docs.select("doc_id", "text", F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("ord"))
    cuts = keyed.agg(F.percentile_approx("ord", [i / parts for i in range(1, parts)] or [0.5], max(10_000, 2 * parts))).first()[0] or []
    bounds = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, ids.to_numpy(np.int64)), dtype="int32")

    dealt = keyed.withColumn("bucket", bucket("ord"))
    heads = sorted((r["bucket"], r["head"]) for r in dealt.groupBy("bucket").agg(F.max("ord").alias("head")).collect())
    before = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    # An id a bucket; of its rows the first counts.
    ahead = keyed.join(F.broadcast(spark.createDataFrame(before, "ord long, bucket int")), "ord") if before else keyed.withColumn("bucket", F.lit(0)).limit(0)
    both = dealt.withColumn("ahead", F.lit(False)).unionByName(ahead.withColumn("ahead", F.lit(True)))
    return both.repartition(parts, "bucket").sortWithinPartitions("bucket", "ahead", F.desc("ord"), "text")


def fingerprints_and_edits(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of doc_id's texts, of their edited texts, and their likenesses to those and to the next document's.

    The edited text: the last third (rounded down) replaced by the first as
    many code points of the next document in descending doc_id, the first's
    for the last.
    """

    def compare(ids: list, texts: list[str]) -> pa.RecordBatch:
        n = len(ids)
        cut = [len(t) // 3 for t in texts[:-1]]
        edited = [t[: len(t) - c] + following[:c] for t, following, c in zip(texts[:-1], texts[1:], cut, strict=True)]
        own, other = Fingerprints(texts, gram, window), Fingerprints(edited, gram, window)
        rows = np.arange(n)
        mine = own.distinct(rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(map(len, texts[:-1]), pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()),
                pa.array(own.strings()[:-1], pa.string()),
                pa.array(other.strings(), pa.string()),
                pa.array(likeness(mine, other.distinct(rows), n), pa.float64()),
                pa.array(likeness(mine, own.distinct(rows + 1), n), pa.float64()),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, ended = [], [], 0, False  # texts[len(ids)], if there, follows the last of ids
        for batch in batches:
            for i, t, ahead in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)), strict=True):
                if ahead and ended:
                    continue
                t = t or ""
                texts.append(t)
                size += len(t)
                if (ahead or size > SLICE_BYTES) and ids:
                    yield compare(ids, texts)
                    ids, texts, size = [], [] if ahead else [t], 0
                if not ahead:
                    ids.append(i)
                ended = ahead

    found = _followed(docs).select("doc_id", "text", "ahead").mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return found


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints_and_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
