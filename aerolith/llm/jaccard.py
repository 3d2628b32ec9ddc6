"""N-gram Jaccard join over signature trees.

A document is the set of its distinct runs of k words. Two documents link when
their sets' Jaccard similarity is at least num / den. The join is exact:

1. Equal sets fold to one class with a number of its own.
2. Under one order of all shingles (frequent ones last, then by hash), linked
   sets share a shingle among their first ``n - ceil(n * num / den) + 1``. Sets
   that share such a shingle are dealt to one forest part by it.
   Of shingles that the same sets share, one part is enough.
3. In each part, sets stand in a signature tree: a node holds the OR of its
   sets' token bitmaps and their range of sizes. A dual traversal from the root
   prunes pairs of nodes whose sizes or greatest possible overlap rule a link
   out. A part of at most ``LEAF`` sets is one leaf, and its pairs are held
   bitmap against bitmap. A bitmap has at least two bits a token; sets of
   unlike widths meet at the smaller one, to which the larger is folded.
4. What is left is verified on the whole sets. A first traversal keeps each
   set's best partner only; the second leaves out pairs that already are in one
   component, so a large group of near copies does not become all its pairs. A
   part of too many sets is dealt as pairs of blocks.

The list of frequent shingles only orders; any list gives the same links.

Defined cases: a null text or one without words has an empty set, linked with
nothing and its own component; fewer than k words are one shingle; rows that
repeat are linked to each other if their ids differ, and each keeps its row;
rows of one id are one document in links, whose sets are all reached from each
other; a null id has a null component. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import components
from .storage import cut, gathered, table
from .textarrays import Words, mix, shingles, slices, text_buffers

#: Sets of a leaf that stands alone, children of a node, sets of a block, and the bound on the list of frequent shingles.
LEAF, FANOUT, BLOCK, FREQUENT = 16, 4, 4096, 300_000
#: Least and greatest bits of a bitmap.
NARROW, WIDE = 256, 1 << 16
_SALTS = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_PAIRS = 1 << 15


def _sets(raw: np.ndarray, ends: np.ndarray, k: int):
    """For each slice of rows: its range, shingle hashes by row and then hash, their rows, and each row's place."""
    for lo, hi in slices(ends):
        hashes, owners = shingles(Words(raw, ends, lo, hi), k)
        yield lo, hi, hashes, owners, np.searchsorted(owners, np.arange(hi - lo + 1))


def _digests(hashes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit digests of each row's set."""
    out = []
    for salt in _SALTS:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ salt), dtype=np.uint64)])
        out.append((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))
    return out


def _bitmaps(hashes: np.ndarray, owners: np.ndarray, n: np.ndarray) -> list[bytes | None]:
    """Each row's bitmap, of the least power of two of bits that is twice its size, in bounds."""
    width = np.clip(1 << np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64), NARROW, WIDE)
    out: list[bytes | None] = [None] * len(n)
    places = (hashes >> np.uint64(20)).astype(np.int64)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero((width == w) & (n > 0))
        for s in range(0, len(rows), max(1, (1 << 22) // w)):
            some = rows[s : s + max(1, (1 << 22) // w)]
            grid = np.zeros((len(some), w), bool)
            number = np.full(len(n), -1)
            number[some] = np.arange(len(some))
            mine = number[owners] >= 0
            grid[number[owners[mine]], places[mine] % w] = True
            for r, bits in zip(some.tolist(), np.packbits(grid, axis=1, bitorder="little"), strict=True):
                out[r] = bits.tobytes()
    return out


def _folded(bits: list[bytes], width: int) -> np.ndarray:
    """Bitmaps as words, those wider than ``width`` bits folded to it."""
    out = np.empty((len(bits), width // 64), np.uint64)
    sizes = np.array([len(b) for b in bits])
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        rows = np.frombuffer(b"".join([bits[i] for i in at]), np.uint64).reshape(len(at), -1, width // 64)
        out[at] = np.bitwise_or.reduce(rows, axis=1)
    return out


def _slack(sizes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Tokens beyond set bits: so many more than their common bits two sets can share."""
    return sizes - np.bitwise_count(bits).sum(1, dtype=np.int64)


def may_link(bits_a: list[bytes], bits_b: list[bytes], n_a: np.ndarray, n_b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which pairs of sets the bitmaps do not rule out."""
    out = np.zeros(len(n_a), bool)
    width = np.minimum([len(b) for b in bits_a], [len(b) for b in bits_b]) * 8
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        for s in range(0, len(at), max(1, (1 << 25) // w)):
            some = at[s : s + max(1, (1 << 25) // w)]
            x, y = _folded([bits_a[i] for i in some], w), _folded([bits_b[i] for i in some], w)
            m, n = n_a[some], n_b[some]
            common = np.bitwise_count(x & y).sum(1, dtype=np.int64) + np.minimum(_slack(m, x), _slack(n, y))
            out[some] = np.minimum(common, np.minimum(m, n)) * (num + den) >= num * (m + n)
    return out


def frequent_shingles(docs: DataFrame, k: int, text_col: str = "text", most: int = FREQUENT) -> np.ndarray:
    """The ``most`` most frequent of the shingles that are in three documents of some batch of rows, counted over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = text_buffers(batch.column(0))
            kept, seen = [], set()
            for lo, hi, hashes, owners, bounds in _sets(raw, ends, k):
                new = np.array([d not in seen and not seen.add(d) for d in _digests(hashes, bounds)[0].tolist()], bool)
                kept.append(hashes[new[owners]])
            found, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *kept]), return_counts=True)
            often = counts >= 3
            yield pa.RecordBatch.from_arrays([pa.array(found[often].view(np.int64)), pa.array(counts[often])], ["token", "n"])

    counted = docs.select(text_col).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    tokens = counted.orderBy(F.desc("n"), "token").limit(most).select("token").toPandas()["token"]
    return np.sort(tokens.to_numpy(np.int64).view(np.uint64))


def profiles(docs: DataFrame, k: int, num: int, den: int, frequent: np.ndarray) -> DataFrame:
    """(doc_id, n, d1, d2, prefix, bits) of every row: set size, digests, the first shingles in order, bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # at most FREQUENT numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = shared.value
        for batch in batches:
            raw, ends = text_buffers(batch.column(1))
            for lo, hi, hashes, owners, bounds in _sets(raw, ends, k):
                n = np.diff(bounds)
                first, second = _digests(hashes, bounds)
                bits = _bitmaps(hashes, owners, n)
                order = hashes
                if len(late) and len(hashes):
                    is_late = late[np.minimum(np.searchsorted(late, hashes), len(late) - 1)] == hashes
                    if is_late.any():
                        order = hashes[np.argsort(owners * 2 + is_late, kind="stable")]
                size = np.where(n > 0, n + (-n * num) // den + 1, 0)
                place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(bounds[:-1], size)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(order[place].view(np.int64)))
                blobs = pa.array(bits, pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(first), pa.array(second), lists, blobs], ["doc_id", "n", "d1", "d2", "prefix", "bits"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, d1 long, d2 long, prefix array<long>, bits binary")


class SignatureTree:
    """Levels of nodes over sets in order of size: OR of bitmaps, least and greatest size, greatest number of tokens beyond set bits."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.levels = [(bits, sizes, sizes, _slack(sizes, bits))]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, slack = self.levels[-1]
            at = np.arange(0, len(bits), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(slack, at)))

    def pairs(self, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs i < j of sets that may link, with the bound on their overlap, in lots."""
        todo = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        step_i, step_j = (x.reshape(-1) for x in np.meshgrid(np.arange(FANOUT), np.arange(FANOUT), indexing="ij"))
        while todo:
            level, i, j = todo.pop()
            if len(i) > _PAIRS:
                todo += [(level, i[:_PAIRS], j[:_PAIRS]), (level, i[_PAIRS:], j[_PAIRS:])]
                continue
            bits, low, high, slack = self.levels[level]
            fits = den * high[i] >= num * low[j]  # j's sizes are not below i's
            fits &= (i < j) if level == 0 else (i <= j)
            i, j = i[fits], j[fits]
            common = np.bitwise_count(bits[i] & bits[j]).sum(1, dtype=np.int64) + np.minimum(slack[i], slack[j])
            overlap = np.minimum(common, np.minimum(high[i], high[j]))
            # A link needs overlap * (num + den) >= num * (sum of sizes).
            may = overlap * (num + den) >= num * (low[i] + low[j])
            i, j, overlap = i[may], j[may], overlap[may]
            if not len(i):
                continue
            if level == 0:
                yield i, j, overlap
                continue
            below = len(self.levels[level - 1][0])
            a = (i[:, None] * FANOUT + step_i).reshape(-1)
            b = (j[:, None] * FANOUT + step_j).reshape(-1)
            inside = (a < below) & (b < below) & (a <= b)
            todo.append((level - 1, a[inside], b[inside]))


def _earlier(tokens: list, own: int) -> np.ndarray:
    """Bitmaps of the shared tokens that come before ``own`` in each list, exact within the part."""
    lists = [np.asarray(t, np.int64) for t in tokens]
    lists = [t[t < own] for t in lists]
    owner = np.repeat(np.arange(len(lists)), [len(t) for t in lists])
    values, index, counts = np.unique(np.concatenate([np.zeros(0, np.int64), *lists]), return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1
    keep = counts[index] > 1
    out = np.zeros((len(lists), max(1, -(-int((counts > 1).sum()) // 64))), np.uint64)
    np.bitwise_or.at(out, (owner[keep], number[index[keep]] // 64), np.uint64(1) << (number[index[keep]] % 64).astype(np.uint64))
    return out


def traverse(parts: DataFrame, num: int, den: int, best_only: bool) -> DataFrame:
    """Pairs (a, b) of sets of one part (token, width, pair of blocks) that may link.

    With best_only each set's best partner of a smaller id; else every pair of
    different components, in the part of their first common token only.
    """

    def part(rows: dict[str, np.ndarray | list]) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((rows["rep"], rows["n"]))
        n, rep, block, comp, native = (rows[c][order] for c in ("n", "rep", "block", "comp", "native"))
        bits = _folded([rows["bits"][o] for o in order], int(rows["width"][0]))
        cross = int(rows["i"][0]) != int(rows["j"][0])
        earlier = None if best_only else _earlier([rows["tokens"][o] for o in order], int(rows["token"][0]))
        found = []
        best = {}
        for i, j, overlap in SignatureTree(n, bits).pairs(num, den):
            use = (rep[i] != rep[j]) & (native[i] | native[j])
            if cross:
                use &= block[i] != block[j]
            if not best_only:
                use &= comp[i] != comp[j]
            i, j, overlap = i[use], j[use], overlap[use]
            if best_only:
                a, b = np.where(rep[i] < rep[j], i, j), np.where(rep[i] < rep[j], j, i)
                like = overlap / (n[a] + n[b] - overlap)
                for x in np.lexsort((rep[a], -like)).tolist():
                    b_x, score = int(b[x]), (-float(like[x]), int(rep[a[x]]))
                    if b_x not in best or score < best[b_x]:
                        best[b_x] = score
            else:
                new = np.concatenate([~(earlier[i[s : s + _PAIRS]] & earlier[j[s : s + _PAIRS]]).any(1) for s in range(0, len(i), _PAIRS)] or [np.zeros(0, bool)])
                found.append((np.minimum(rep[i], rep[j])[new], np.maximum(rep[i], rep[j])[new]))
        if best_only:
            return np.array([v[1] for v in best.values()], np.int64), rep[np.array(list(best), np.int64)] if best else np.zeros(0, np.int64)
        return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*found, strict=True) if found else ((), ())))

    key_names = ["token", "width", "i", "j"]
    names = [*key_names, "rep", "n", "block", "comp", "native", "bits", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def work(t: pa.Table, all_: bool) -> tuple[pa.RecordBatch, pa.Table]:
            key = np.stack([t[c].to_numpy() for c in key_names])
            edges = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1, [t.num_rows]])
            last = len(edges) - 1 if all_ else len(edges) - 2
            whole = {c: t[c].to_pylist() if c in ("bits", "tokens") else np.asarray(t[c]) for c in names}
            out = [part({c: whole[c][a:b] for c in names}) for a, b in zip(edges[:last], edges[1 : last + 1], strict=True)]
            a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*out, strict=True) if out else ((), ())))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"]), t.slice(edges[last])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            if held and any(t[c][t.num_rows - 1] != held[0][c][0] for c in key_names) or not held:
                done, rest = work(pa.concat_tables([*held, t]), False)
                held = [rest]
                yield done
            else:
                held.append(t)
        if held:
            yield work(pa.concat_tables(held), True)[0]

    return parts.select(*names).repartition(*key_names).sortWithinPartitions(*key_names).mapInArrow(run, "a long, b long").distinct()


def leaf_pairs(parts: DataFrame, maps: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) within parts of at most LEAF sets that sizes and bitmaps do not rule out."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = may_link(batch.column(4).to_pylist(), batch.column(5).to_pylist(), np.asarray(batch.column(2)), np.asarray(batch.column(3)), num, den)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in batch.columns[:2]], ["a", "b"])

    x, y = parts.alias("x"), parts.alias("y")
    fits = (F.col("x.n") * den >= F.col("y.n") * num) & (F.col("y.n") * den >= F.col("x.n") * num)
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.rep") < F.col("y.rep")) & fits).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b")).distinct()
    left, right = (maps.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in ("a", "b"))
    return pairs.join(left, ["a", "n_a"]).join(right, ["b", "n_b"]).select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(judge, "a long, b long")


def deal(parts: DataFrame, maps: DataFrame, num: int, den: int) -> DataFrame:
    """Rows of parts of more than LEAF sets, dealt by token, width of bitmap and pair of blocks."""
    large = parts.filter(F.col("size") > LEAF)
    lists = parts.groupBy("rep").agg(F.sort_array(F.collect_set("token")).alias("tokens"))  # at most a prefix
    own = (F.length("bits") * 8).cast("int")
    # A set also meets those of the next narrower bitmaps if they can be large enough.
    narrower = F.when((own > NARROW) & (F.col("n") * num <= F.lit(den / 4) * own), (own / 2).cast("int"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = large.join(maps, ["rep", "n"]).join(lists, "rep").withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    dealt = dealt.withColumn("width", F.explode(F.array_compact(F.array(own, narrower)))).withColumn("native", F.col("width") == own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.select("token", "width", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "n", "block", "native", "bits", "tokens")


def verify(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, num: int, den: int, few: int = 200_000) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets link; the set of a class is read from its documents of the least id."""
    pairs = cut(pairs)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    wanted = cut(classes.join(ids, "rep").select("rep", "d1", "d2", "n", "least"))
    rows = wanted.count()
    if rows <= few:
        wanted = F.broadcast(gathered(wanted, rows))  # at most ``few`` rows of numbers
    named = wanted.select(F.col("least").alias("doc_id")).distinct()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = text_buffers(batch.column(0))
            for lo, hi, hashes, _, bounds in _sets(raw, ends, k):
                blobs = [hashes[bounds[r] : bounds[r + 1]].tobytes() for r in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([*(pa.array(d) for d in _digests(hashes, bounds)), pa.array(np.diff(bounds)), pa.array(blobs, pa.binary())], ["d1", "d2", "n", "shingles"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(den * common >= num * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    read = docs.join(F.broadcast(named) if rows <= few else named, "doc_id", "left_semi").select("text").mapInArrow(sets, "d1 long, d2 long, n long, shingles binary")
    whole = cut(read.join(wanted, ["d1", "d2", "n"]).select("rep", "shingles").dropDuplicates(["rep"]))
    left, right = (whole.select(F.col("rep").alias(c), F.col("shingles").alias(f"of_{c}")) for c in ("a", "b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b").mapInArrow(judge, "a long, b long").distinct()


def jaccard_join(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(doc_id, n_shingles, component_id, links_found) of every row of docs (doc_id long, text).

    links_found is the number of other sets that were linked to the row's own
    directly in building components, which suffices for components and is not
    every link.
    """
    docs = docs.select("doc_id", "text")
    rows = cut(profiles(docs, k, num, den, frequent_shingles(docs, k)))
    named = rows.filter("n > 0 AND doc_id IS NOT NULL")
    # Numbers given to rows that are written, so they stay.
    classes = cut(named.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("least"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits")))
    classes = classes.withColumn("rep", F.monotonically_increasing_id())
    tokens = classes.select(F.explode("prefix").alias("token"), "rep", "n")
    of = Window.partitionBy("token")
    shared = tokens.withColumn("size", F.count("*").over(of)).withColumn("who", F.bit_xor(F.xxhash64("rep")).over(of)).withColumn("whom", F.bit_xor(F.xxhash64("rep", F.lit(1))).over(of)).filter("size > 1")
    shared = cut(shared)
    one = shared.groupBy("size", "who", "whom").agg(F.min("token").alias("token")).select("token")
    parts = cut(shared.join(one, "token", "left_semi").select("token", "rep", "n", "size"))
    maps = classes.select("rep", "n", "bits")
    small = leaf_pairs(parts.filter(F.col("size") <= LEAF), maps, num, den)
    dealt = deal(parts, maps, num, den)
    first = cut(verify(docs, classes, small.unionByName(traverse(dealt.withColumn("comp", F.col("rep")), num, den, True)).distinct(), k, num, den))
    found = components(first)
    known = dealt.join(found.select(F.col("id").alias("rep"), F.col("component")), "rep", "left").withColumn("comp", F.coalesce("component", "rep"))
    second = cut(verify(docs, classes, traverse(known, num, den, False), k, num, den))
    links = first.unionByName(second)
    groups = components(links.unionByName(_own_links(named, classes))).withColumnRenamed("id", "rep")
    grouped = cut(classes.join(groups, "rep").select("rep", "least", "component"))
    named_after = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    labels = classes.join(grouped.join(named_after, "component").select("rep", "component_id"), "rep", "left").join(degree, "rep", "left")
    labels = labels.select("d1", "d2", "n", F.coalesce("component_id", "least").alias("component_id"), "links")
    out = rows.select("doc_id", "n", "d1", "d2").join(labels, ["d1", "d2", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce("links", F.lit(0)).cast("long").alias("links_found"))


def _own_links(named: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of ids whose rows have unlike sets."""
    unlike = (F.max("d1") != F.min("d1")) | (F.max("d2") != F.min("d2")) | (F.max("n") != F.min("n"))
    several = named.groupBy("doc_id").agg(unlike.alias("unlike")).filter("unlike").select("doc_id")
    held = named.join(several, "doc_id").join(classes, ["d1", "d2", "n"]).select("doc_id", "rep").distinct()
    return held.join(held.groupBy("doc_id").agg(F.min("rep").alias("b")), "doc_id").filter("rep <> b").select(F.col("rep").alias("a"), "b")


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"), 4, 85, 100).select("doc_id", "n_shingles", "component_id")


OP9_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(a, b) AS (SELECT DISTINCT a, a FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(m, doc_id) AS component_id
FROM (SELECT doc_id FROM documents) LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON a = doc_id
"""
