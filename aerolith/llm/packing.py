"""Variable-capacity best-fit packing of documents into sequences.

Pieces go from the longest to the shortest into the open bin that they leave
the least room in. Where none has room, a bin opens with the capacity that
costs least for each token that the pieces still to come can fill it with, and
at the end each bin shrinks to the least permitted capacity that holds its
contents. A document longer than the largest capacity is cut into pieces of
that capacity and a rest, so every token is in exactly one bin.

Pieces are dealt by a number of their own to shards of about ``SHARD_PIECES``, so
that rows that repeat do not meet in one, and each shard is packed on its own, so a shard's size does not grow with the input and at most
one bin of each capacity a shard is filled badly.

Defined cases: a null or empty text is one piece of length 0 in no bin; rows
that repeat are packed each; no rows give no rows. Columns other than id and
text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import cut, table
from .textarrays import Words, slices, text_buffers

CAPACITIES = (512, 1024, 2048, 4096)
SHARD_PIECES = 20_000
PACKED = "doc_id {kind}, piece int, start long, length int, bin long, position int, capacity int, tokens int"


def bin_cost(capacity: int) -> float:
    """Cost of one sequence: a fixed part, its positions, and attention among them."""
    return 64 + capacity + capacity * capacity / 32768


def best_fit(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For pieces of descending, positive lengths: bin, position in it, and each bin's capacity and contents."""
    sizes = sorted(capacities)
    following = np.concatenate([np.cumsum(lengths[::-1])[::-1], [0]])  # tokens from this piece on
    falling = -lengths
    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has room r
    room, held = [], []
    for i, n in enumerate(lengths.tolist()):
        fitting = rooms >> n
        if fitting:
            left = n + (fitting & -fitting).bit_length() - 1
            b = by_room[left].pop()
            if not by_room[left]:
                rooms &= ~(1 << left)
        else:
            b, best = len(room), None
            for c in sizes:
                if c >= n:
                    first = max(i + 1, int(np.searchsorted(falling, n - c)))  # the first later piece that fits beside this
                    rate = bin_cost(c) / min(c, n + int(following[first]))
                    if best is None or rate < best:
                        best, left = rate, c
            room.append(left)
            held.append(0)
        bins[i], places[i] = b, held[b]
        held[b] += n
        left -= n
        room[b] = left
        if left:
            by_room.setdefault(left, []).append(b)
            rooms |= 1 << left
    contents = np.array(held, np.int64)
    return bins, places, np.array(sizes, np.int64)[np.searchsorted(sizes, contents)] if len(contents) else contents, contents


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: int = max(CAPACITIES)) -> DataFrame:
    """(doc_id, piece, start, length) in words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = text_buffers(batch.column(1))
            sizes = np.concatenate([np.zeros(0, np.int64), *(Words(raw, ends, lo, hi, hashes=False).counts for lo, hi in slices(ends))])
            counts = np.maximum(1, -(-sizes // largest))
            row = np.repeat(np.arange(len(sizes)), counts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = piece * largest
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(np.minimum(largest, sizes[row] - start), pa.int32())], ["doc_id", "piece", "start", "length"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, piece int, start long, length int")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacities: tuple[int, ...] = CAPACITIES, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """(doc_id, piece, start, length, bin, position, capacity, tokens), one row a piece.

    start and length are in words of the document, position in words of the
    bin, tokens is what the bin holds.
    """
    # Numbers are given to rows that are written, so they stay.
    found = cut(pieces(docs, id_col, text_col, max(capacities))).withColumn("deal", F.monotonically_increasing_id())
    full = found.filter("length > 0")
    shards = max(1, -(-full.count() // shard_pieces))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "deal"], ascending=[False, True, True, True]).reset_index(drop=True)
        bins, places, sizes, contents = best_fit(frame["length"].to_numpy(np.int64), capacities)
        frame["bin"] = (frame["shard"].to_numpy(np.int64) << 32) + bins
        frame["position"], frame["capacity"], frame["tokens"] = places.astype(np.int32), sizes[bins].astype(np.int32), contents[bins].astype(np.int32)
        return frame[["doc_id", "piece", "start", "length", "bin", "position", "capacity", "tokens"]]

    schema = PACKED.format(kind=docs.schema[id_col].dataType.simpleString())
    dealt = full.withColumn("shard", F.pmod(F.xxhash64("deal"), F.lit(shards)))
    none = found.filter("length = 0").select("doc_id", "piece", "start", "length", F.lit(None).cast("long").alias("bin"), *(F.lit(None).cast("int").alias(c) for c in ("position", "capacity", "tokens")))
    return dealt.groupBy("shard").applyInPandas(run, schema).unionByName(none)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
