"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length (words) in each source. A source takes
all its documents as often as its target holds its whole size, then a part of
them for what remains of the target: the same share of the documents of every
length, rounded along the lengths so that any band of them keeps the share, and
for the budget still open, a few times the longest document at every size, a
bounded-knapsack dynamic program over the lengths left. Which documents of a
length are taken follows from a seeded hash of their ids.

Defined cases: a null or empty text has size 0 and takes nothing; a null
source is one source, ordered last; rows that repeat an id are rows of their
own; no rows give no rows; an empty source has target 0. Columns other than
id, source and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import cut, table
from .textarrays import Words, slices, text_buffers

WEIGHTS, SHARE, REPEATS, SEED = (5.0, 2.0, 1.0), 1.0, 3, 17
#: The budget that shares leave to the dynamic program, in longest documents. Rounding is off by two of them at most, so it never takes too much.
OPEN = 8
#: Documents of one length in one source are dealt to so many hash parts before they are numbered.
PARTS = 1024


def sized(docs: DataFrame, columns: list[str], text_col: str = "text") -> DataFrame:
    """The given columns and ``size``, the number of words of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = text_buffers(batch.column(len(columns)))
            sizes = [Words(raw, ends, lo, hi, hashes=False).counts for lo, hi in slices(ends)]
            size = pa.array(np.concatenate([np.zeros(0, np.int64), *sizes]), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], size], [*columns, "size"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.select(*columns, text_col).mapInArrow(run, f"{kinds}, size long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``sources`` with ``target``: weights in order of code point, nulls last, repeating.

    No target is above ``repeats`` times its source's size; an excess goes to the
    others by weight, until none is above. With sources in order of size over
    weight, those above the cap come first, so that running sums give the level.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    values = F.array(*map(F.lit, weights))
    weighed = sources.withColumn("weight", F.element_at(values, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    capped = weighed.withColumn("cap", F.lit(float(repeats)) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), F.col("source").cast("binary"))
    capped = capped.withColumn("before_cap", F.sum("cap").over(by_ratio) - F.col("cap")).withColumn("before_weight", F.sum("weight").over(by_ratio) - F.col("weight"))
    capped = capped.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(every)).withColumn("weights", F.sum("weight").over(every))
    level = (F.col("budget") - F.col("before_cap")) / (F.col("weights") - F.col("before_weight"))
    level = F.min(F.when(F.col("ratio") >= level, F.struct("ratio", level.alias("level")))).over(every)["level"]  # of the first below its cap
    return capped.withColumn("level", level).select(*sources.columns, F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight"))).alias("target"))


def shared_out(counts: np.ndarray, words: int, total: int, seed: int = SEED) -> np.ndarray:
    """The share words / total of the documents of every length, rounded so that the sum over the first lengths is off by less than one, whichever they are."""
    start = int(np.random.default_rng(seed).integers(total)) if total else 0
    upto = [0, *((words * n + start) // total for n in map(int, np.cumsum(counts)))]
    return np.diff(np.array([start // total, *upto[1:]], np.int64))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each length (ascending) to take so that their words come as near below ``budget`` as the program finds."""
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    take = np.zeros(len(lengths), np.int64)
    if budget <= 0 or not total:
        return take
    by_share = budget - OPEN * int(lengths.max())
    if by_share > 0:
        take = shared_out(counts, by_share, total, seed)
    left, open_ = counts - take, budget - int((lengths * take).sum())
    # Lots of 1, 2, 4 ... documents of a length; ``made_by`` is the lot by which a sum was first made.
    bound = min(open_, int((lengths * left).sum()))
    made_by = np.full(bound + 1, -1, np.int32)
    reached = np.zeros(bound + 1, bool)
    reached[0] = True
    lots: list[tuple[int, int]] = []
    for i in np.random.default_rng(seed).permutation(len(lengths)):
        more, lot = int(left[i]), 1
        while more and lengths[i] and not reached[bound]:
            n = min(lot, more)
            step = n * int(lengths[i])
            more, lot = more - n, lot * 2
            if step > bound:
                break
            new = np.flatnonzero(reached[:-step] & ~reached[step:]) + step
            reached[new], made_by[new] = True, len(lots)
            lots.append((i, n))
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, n = lots[made_by[at]]
        take[i] += n
        at -= n * int(lengths[i])
    return take


def _seeded(id_col: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_col))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) of every row; a row is taken ``copies`` times, at most ``repeats``."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), text_col)
    # ``key`` stands for the source where rows meet, as a null meets none; part deals a length's rows out.
    base = cut(sized(named, ["doc_id", "source"], text_col)).withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).withColumn("part", F.pmod(_seeded("doc_id", seed), F.lit(PARTS)).cast("int"))
    counts = cut(base.groupBy("key", "source", "size", "part").agg(F.count("*").alias("n")))
    sources = counts.groupBy("key", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    whole = F.round("target").cast("long")
    aims = targets(sources, weights, share, repeats).withColumn("full", F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("long"))
    aims = cut(aims.withColumn("rest", whole - F.col("full") * F.col("source_size")))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("size")
        take = fit_budget(frame["size"].to_numpy(np.int64), frame["n"].to_numpy(np.int64), int(frame["rest"].iloc[0]))
        return frame.assign(take=take)[["key", "size", "take"]]

    # One row a source and exact length: as many as there are lengths, not documents.
    lengths = counts.groupBy("key", "size").agg(F.sum("n").alias("n")).join(aims.select("key", "rest"), "key")
    chosen = cut(lengths.groupBy("key").applyInPandas(fit, "key string, size long, take long"))
    # Rows before each hash part of a length: parts lie wholly inside or outside the count, but for one.
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("key", "size").orderBy("part")) - F.col("n"))
    quota = before.join(chosen, ["key", "size"]).select("key", "size", "part", (F.col("take") - F.col("before")).alias("quota"))
    nth = F.row_number().over(Window.partitionBy("key", "size", "part").orderBy(_seeded("doc_id", seed + 1), "doc_id"))
    rows = base.join(quota, ["key", "size", "part"]).withColumn("extra", (nth <= F.col("quota")).cast("long"))
    rows = rows.join(aims.drop("source"), "key").withColumn("copies", F.when(F.col("size") > 0, F.col("full") + F.col("extra")).otherwise(0))
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")
