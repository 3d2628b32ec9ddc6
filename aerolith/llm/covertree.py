"""Near-duplicates among embeddings by dual traversal of cover trees.

Vectors are compared where their labels (and lengths) are equal. On unit
vectors a cosine of at least t is a distance of at most sqrt(2 - 2 t). A cover
tree's levels have halving radii; each node keeps the greatest distance to what
is below it. Two trees are walked together, and a pair of nodes is dropped when
its centres are farther apart than the threshold and both covering radii, and
taken whole when they are nearer than the threshold less both. Vectors that have
no other within a level's radius stand in leaves of ``LEAF`` of them, which are
held vector against vector by one product of matrices.

Equal vectors of a label fold to one class, with a count and a number of its
own. A label of many vectors is dealt to cells around pivots (a bounded sample
of it), cells to blocks, and pairs of blocks of cells whose covering radii let
them meet go to tasks. A task returns counts of links and stars of its links, so
that its output grows with its vectors and not with their pairs. Among vectors
of many dimensions that lie in no clusters no radius rules a pair of blocks out;
then work grows with the square of a label's vectors, as products of matrices.

Defined cases: a null label, and a vector that is null, empty, zero, or holds a
null or a non-finite component, link with nothing; rows that repeat count as
other vectors if they are other rows, and share a component; rows of one id with
unlike vectors are linked each by its own; a null id belongs to a component by
its vector and is never its least id; no rows give no rows.
Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import LOT, components, stars_of
from .storage import cut, table

#: Vectors of a block; labels that get pivots, and pivots of a label, at most.
BLOCK, PIVOT_LABELS, PIVOTS = 2048, 64, 64
#: Vectors of a leaf without a radius, and centres that are tried at once.
LEAF, TRIED = 128, 64
#: Doubts of rounding: nearer than this to the threshold, a pair is decided by its own cosine.
DOUBT = 1e-7


class CoverTree:
    """Nested nets over unit vectors, the radius halving from level to level.

    Nodes lie in arrays: ``centre``, ``radius`` (the greatest distance to a
    vector below), and ``first``/``last``, a range of the node's children or,
    in a leaf, of its vectors in ``members``.
    """

    def __init__(self, vectors: np.ndarray, least: float):
        self.vectors, self.members = vectors, np.arange(len(vectors))
        self.centre, self.radius, self.first, self.last, self.leaf = [0], [0.0], [0], [0], [True]
        # Each entry: node, level radius, its vectors, their distances to its centre.
        todo = [(0, 2.0, np.arange(len(vectors)), self._distances(0, np.arange(len(vectors))))]
        ordered = []
        count = 0
        while todo:
            node, r, inside, far = todo.pop()
            self.radius[node] = float(far.max())
            if self.radius[node] <= least or len(inside) == 1:
                self.first[node], self.last[node] = count, count + len(inside)
                ordered.append(inside)
                count += len(inside)
                continue
            while r / 2 >= self.radius[node]:
                r /= 2
            self.leaf[node] = False
            self.first[node] = len(self.centre)
            alone = []
            for centre, near, near_far in self._nets(self.centre[node], inside, far, r / 2):
                if len(near) == 1:
                    alone.append(near)
                else:
                    todo.append((self._child(centre), r / 2, near, near_far))
            alone = np.concatenate(alone) if alone else np.zeros(0, np.int64)
            for s in range(0, len(alone), LEAF):
                some = alone[s : s + LEAF]
                child = self._child(some[0])
                self.radius[child] = float(self._distances(some[0], some).max())
                self.first[child], self.last[child] = count, count + len(some)
                ordered.append(some)
                count += len(some)
            self.last[node] = len(self.centre)
        self.members = np.concatenate(ordered)
        self.centre, self.first, self.last = (np.array(x, np.int64) for x in (self.centre, self.first, self.last))
        self.radius, self.leaf = np.array(self.radius), np.array(self.leaf)
        self.first_below, self.last_below = self._ranges()

    def _child(self, centre: int) -> int:
        self.centre.append(int(centre))
        for values, x in ((self.radius, 0.0), (self.first, 0), (self.last, 0), (self.leaf, True)):
            values.append(x)
        return len(self.centre) - 1

    def _nets(self, centre: int, inside: np.ndarray, far: np.ndarray, r: float):
        """(centre, vectors, distances): each vector with the first centre within r, which ``centre`` and then the first vectors left over are."""
        near = far <= r
        yield centre, inside[near], far[near]
        rest = inside[~near]
        while len(rest):
            tried = rest[:TRIED]
            gaps = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (self.vectors[tried] @ self.vectors[rest].T)))
            gaps[np.arange(len(tried)), np.arange(len(tried))] = 0.0
            left = np.ones(len(rest), bool)
            close = gaps <= r
            for k in range(len(tried)):
                if left[k]:
                    near = np.flatnonzero(close[k] & left)
                    left[near] = False
                    yield tried[k], rest[near], gaps[k][near]
            rest = rest[left]

    def _distances(self, centre: int, which: np.ndarray) -> np.ndarray:
        out = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (self.vectors[which] @ self.vectors[centre])))
        out[which == centre] = 0.0
        return out

    def _ranges(self) -> tuple[np.ndarray, np.ndarray]:
        """The range of members below each node: depth-first order keeps it whole."""
        first, last = self.first.copy(), self.last.copy()
        for node in range(len(self.centre) - 1, -1, -1):
            if not self.leaf[node]:
                children = slice(self.first[node], self.last[node])
                first[node], last[node] = first[children].min(), last[children].max()
        return first, last


def dual_traversal(one: CoverTree, two: CoverTree, cosine: float):
    """Lots of links (i, j), indices of the trees' vectors, and of ranges of members that link whole: yields (i, j, None) or (members, members, True)."""
    reach = np.sqrt(2.0 - 2.0 * cosine)
    same = one is two
    todo = [(np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        a, b = todo.pop()
        gap = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.einsum("ij,ij->i", one.vectors[one.centre[a]], two.vectors[two.centre[b]])))
        both = one.radius[a] + two.radius[b]
        near = gap <= reach + both + DOUBT
        a, b, gap, both = a[near], b[near], gap[near], both[near]
        whole = gap + both <= reach - DOUBT
        if same:
            whole &= a != b
        for x, y in zip(a[whole].tolist(), b[whole].tolist(), strict=True):
            yield one.members[one.first_below[x] : one.last_below[x]], two.members[two.first_below[y] : two.last_below[y]], True
        a, b = a[~whole], b[~whole]
        leaves = one.leaf[a] & two.leaf[b]
        for x, y in zip(a[leaves].tolist(), b[leaves].tolist(), strict=True):
            p, q = one.members[one.first[x] : one.last[x]], two.members[two.first[y] : two.last[y]]
            i, j = np.nonzero(one.vectors[p] @ two.vectors[q].T >= cosine)
            i, j = p[i], q[j]
            if same and x == y:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j, None
        a, b = a[~leaves], b[~leaves]
        next_a, next_b = [], []
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            # Go down on the wider side, on both if they are of one size, so levels stay together.
            down_a = not one.leaf[x] and (two.leaf[y] or one.radius[x] * 2 > two.radius[y])
            down_b = not two.leaf[y] and (one.leaf[x] or two.radius[y] * 2 > one.radius[x])
            left = np.arange(one.first[x], one.last[x]) if down_a else np.array([x])
            right = np.arange(two.first[y], two.last[y]) if down_b else np.array([y])
            gap = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (one.vectors[one.centre[left]] @ two.vectors[two.centre[right]].T)))
            keep = gap <= reach + one.radius[left][:, None] + two.radius[right] + DOUBT
            if same and x == y:
                keep &= left[:, None] <= right
            i, j = np.nonzero(keep)
            next_a.append(left[i])
            next_b.append(right[j])
        if next_a:
            a, b = np.concatenate(next_a), np.concatenate(next_b)
            todo += [(a[s : s + 65536], b[s : s + 65536]) for s in range(0, len(a), 65536)]


class _Stars:
    """Stars of the links so far; links are held in lots."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        self.held.append((i, j))
        self.rows += len(i)
        if self.rows > LOT:
            self.value()

    def value(self) -> tuple[np.ndarray, np.ndarray]:
        i, j = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*self.held, strict=True)) if self.held else (np.zeros(0, np.int64),) * 2
        self.held = [stars_of(i, j)]
        self.rows = 0
        return self.held[0]


def block_links(one: np.ndarray, weights_one: np.ndarray, two: np.ndarray | None, weights_two: np.ndarray | None, cosine: float) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Weighted numbers of links of the vectors of one block, or of two one after the other, and stars (i, j) of the links."""
    least = np.sqrt(2.0 - 2.0 * cosine) / 4
    left = CoverTree(one, least)
    right = left if two is None else CoverTree(two, least)
    shift = 0 if two is None else len(one)
    weights = weights_one if two is None else np.concatenate([weights_one, weights_two])
    counts, stars = np.zeros(len(weights), np.int64), _Stars()
    for i, j, whole in dual_traversal(left, right, cosine):
        j = j + shift
        if whole:
            counts[i] += weights[j].sum()
            counts[j] += weights[i].sum()
            stars.add(i, np.full(len(i), j[0]))
            stars.add(np.full(len(j), i[0]), j)
        else:
            np.add.at(counts, i, weights[j])
            np.add.at(counts, j, weights[i])
            stars.add(i, j)
    return counts, stars.value()


def _unit(vectors: pd.Series) -> np.ndarray:
    out = np.stack([np.asarray(v, np.float64) for v in vectors])
    # Scaled first, so that the squares of very large or small components stay finite.
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.sqrt(np.einsum("ij,ij->i", out, out))[:, None]


def near_duplicates(rows: DataFrame, cosine: float) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of rows (vec_id long, embedding array, label)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    useful = F.coalesce(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.select("vec_id", F.col("label").cast("string").alias("label"), "embedding")
    # Rows that share label and vector are one class. Numbers are given to rows that are written, so they stay.
    classes = cut(rows.filter(useful).groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies")))
    classes = classes.withColumn("rep", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding"))
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("m"))
    large = sizes.filter(F.col("m") > BLOCK).orderBy(F.desc("m"), "label", "dim").limit(PIVOT_LABELS)
    share = F.least(F.ceil(2 * F.col("m") / BLOCK), F.lit(4 * PIVOTS)) / F.col("m")
    place = F.xxhash64("label", "embedding")
    drawn = classes.join(F.broadcast(large), ["label", "dim"]).filter(F.pmod(place, F.lit(10**9)) < share * 10**9)
    drawn = drawn.withColumn("nth", F.row_number().over(Window.partitionBy("label", "dim").orderBy(place))).filter(F.col("nth") <= PIVOTS)
    pivots: dict[tuple, list] = {}
    for r in drawn.orderBy("label", "dim", "nth").select("label", "dim", "embedding").collect():  # PIVOT_LABELS * PIVOTS rows at most
        pivots.setdefault((r["label"], r["dim"]), []).append(r["embedding"])
    shared = classes.sparkSession.sparkContext.broadcast({k: _unit(pd.Series(v)) for k, v in pivots.items()})  # PIVOT_LABELS * PIVOTS vectors at most

    def place(batches):
        for f in batches:
            cell, far = np.zeros(len(f), np.int32), np.full(len(f), 2.0)
            for key, at in f.groupby(["label", "dim"], sort=False).indices.items():
                centres = shared.value.get(key)
                if centres is not None:
                    near = _unit(f["embedding"].iloc[at]) @ centres.T
                    cell[at] = near.argmax(1)
                    far[at] = np.sqrt(np.maximum(0, 2 - 2 * near.max(1)))
            yield f.assign(cell=cell, far=far)[["label", "dim", "rep", "copies", "embedding", "cell", "far"]]

    kind = classes.schema["embedding"].dataType.simpleString()
    placed = cut(classes.select("label", "dim", "rep", "copies", "embedding").mapInPandas(place, f"label string, dim int, rep long, copies long, embedding {kind}, cell int, far double"))
    cells = cut(placed.groupBy("label", "dim", "cell").agg(F.count("*").alias("m"), F.max("far").alias("radius")))
    reach = float(np.sqrt(2 - 2 * cosine)) + DOUBT

    @F.pandas_udf("double")
    def apart(label: pd.Series, dim: pd.Series, i: pd.Series, j: pd.Series) -> pd.Series:
        known = shared.value
        return pd.Series([0.0 if (c := known.get((n, d))) is None else float(np.linalg.norm(c[p] - c[q])) for n, d, p, q in zip(label, dim, i, j, strict=True)], dtype="float64")

    # PIVOTS cells a label at most meet each other; then the blocks of those that may hold a link.
    x, y = cells.alias("x"), cells.alias("y")
    meet = x.join(y, (F.col("x.label") == F.col("y.label")) & (F.col("x.dim") == F.col("y.dim")) & (F.col("x.cell") <= F.col("y.cell")))
    meet = meet.select("x.label", "x.dim", F.col("x.cell").alias("ci"), F.col("y.cell").alias("cj"), (F.col("x.radius") + F.col("y.radius")).alias("both"), F.col("x.m").alias("mi"), F.col("y.m").alias("mj"))
    meet = meet.filter(apart("label", "dim", "ci", "cj") <= F.col("both") + reach)
    blocks = lambda m: F.explode(F.sequence(F.lit(0), F.ceil(F.col(m) / BLOCK).cast("int") - 1))
    meet = meet.withColumn("bi", blocks("mi")).withColumn("bj", blocks("mj")).filter("ci < cj OR bi <= bj")
    sides = meet.select("label", "dim", "ci", "bi", "cj", "bj", F.explode(F.array_distinct(F.array(F.struct(F.col("ci").alias("cell"), F.col("bi").alias("block")), F.struct(F.col("cj").alias("cell"), F.col("bj").alias("block"))))).alias("s")).select("label", "dim", "ci", "bi", "cj", "bj", "s.cell", "s.block")
    numbered = placed.join(cells.select("label", "dim", "cell", "m"), ["label", "dim", "cell"])
    numbered = numbered.withColumn("block", F.pmod(F.xxhash64("rep"), F.ceil(F.col("m") / BLOCK)).cast("int"))
    tasks = numbered.join(sides, ["label", "dim", "cell", "block"]).select("label", "dim", "ci", "bi", "cj", "bj", "cell", "block", "rep", "copies", "embedding")

    def compare(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("rep")
        first = ((f["cell"] == f["ci"]) & (f["block"] == f["bi"])).to_numpy()
        alone = f["ci"].iloc[0] == f["cj"].iloc[0] and f["bi"].iloc[0] == f["bj"].iloc[0]
        if not alone and (first.all() or not first.any()):
            return pd.DataFrame({"a": [], "b": [], "n": []}, dtype="int64")
        f = pd.concat([f[first], f[~first]])
        vectors, copies, ids = _unit(f["embedding"]), f["copies"].to_numpy(np.int64), f["rep"].to_numpy(np.int64)
        k = int(first.sum())
        counts, (i, j) = block_links(vectors, copies, None, None, cosine) if alone else block_links(vectors[:k], copies[:k], vectors[k:], copies[k:], cosine)
        linked = counts > 0
        return pd.DataFrame({"a": np.concatenate([ids[linked], ids[i]]), "b": np.concatenate([ids[linked], ids[j]]), "n": np.concatenate([counts[linked], np.zeros(len(i), np.int64)])})

    found = cut(tasks.groupBy("label", "dim", "ci", "bi", "cj", "bj").applyInPandas(compare, "a long, b long, n long"))
    counts = found.filter("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    groups = components(found.filter("a <> b").select("a", "b")).withColumnRenamed("id", "rep")
    known = classes.join(counts, "rep", "left").join(groups, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select("label", "embedding", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"), "component_id")
    out = rows.join(known, ["label", "embedding"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def op7_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), 0.93)
