"""Merkle manifest of a dataset as a postorder append log.

The rows of each tree are its leaves in an order; every 8 consecutive nodes of a
level become one of the next, until one is left. Nodes are written in the order
in which they are completed: a node follows the last leaf below it. So a log only
grows at its end, the place of any node in it is a closed form of the sizes of
the complete subtrees before it, and the nodes of an aligned block of leaves lie
in one piece.

Builders are aligned: each gets the 8 ** 4 leaves (``levels``) below one node of the
fourth level and writes that block's piece of the log. The blocks' own nodes are the
leaves of the next tier of builders, so a tree of n leaves takes log n / log 4096
rounds, and no task holds more than a block of it. Proofs go the other way, from
the highest tier down: a block's task finds the siblings of its leaves by their
places in its piece and puts the path of the block itself after them. The trees'
roots are the leaves of one more tree.

Leaves are digested where the rows are read; texts are never shuffled. Leaves are
numbered by ranges of their order, so a tree that holds most rows is dealt to
many tasks, and so are rows that repeat.

Defined cases: a null field counts as ``-``; rows without id come first; rows of
one id stand by digest, and equal rows have places of their own; a tree of one
leaf is that leaf; a leaf without siblings has the digest of an empty text as
proof; an empty table has no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import cut, table

FAN = 8
#: Levels that a builder completes.
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SIZE = 32


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 over each field's bytes, told apart by their number."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text)), 256)


# --- places in a postorder log ------------------------------------------------


def heights(n: int) -> list[int]:
    """Nodes of each level of a tree of n leaves."""
    sizes = [n]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // FAN))
    return sizes


def places(n: int, level: int, index: np.ndarray) -> np.ndarray:
    """The place in the log of a tree, or of a block of one, of n leaves of some nodes of a level.

    A complete node comes after the complete nodes of its level and below up to
    its last leaf, and those above up to the leaf before. What n leaves leave
    incomplete is completed at the end, from below.
    """
    index = np.asarray(index, np.int64)
    sizes = heights(n)
    end = (index + 1) * FAN**level
    at = sum(end // FAN**k if k <= level else (end - 1) // FAN**k for k in range(len(sizes))) - 1
    whole = sum(n // FAN**k for k in range(len(sizes)))
    late = whole + sum(n % FAN**k > 0 for k in range(level))
    return np.where(end <= n, at, late)


def piece_of(digests: list[bytes], levels: int) -> bytes:
    """The log of a block: its leaves and ``levels`` levels above, in order of completion."""
    open_: list[list[bytes]] = [[] for _ in range(levels + 1)]
    log = []

    def put(level: int, digest: bytes) -> None:
        log.append(digest)
        if level < levels:
            open_[level].append(digest)
            if len(open_[level]) == FAN:
                close(level)

    def close(level: int) -> None:
        below = b"".join(open_[level]).hex().encode()
        open_[level].clear()
        put(level + 1, hashlib.sha256(below).digest())

    for d in digests:
        put(0, d)
    for level in range(levels):
        if open_[level]:
            close(level)
    return b"".join(log)


def levels_of(total: int, most: int) -> int:
    """Levels that the builders of a tier of ``total`` nodes complete: up to the root, if one block has them all."""
    return len(heights(total)) - 1 if total <= FAN**most else most


# --- tasks -----------------------------------------------------------------


def _build(rows: pd.DataFrame, most: int) -> pd.DataFrame:
    rows = rows.sort_values("idx")
    levels = levels_of(int(rows["total"].iloc[0]), most)
    piece = piece_of(list(map(bytes, rows["digest"])), levels)
    return pd.DataFrame({"tree": [rows["tree"].iloc[0]], "block": [rows["block"].iloc[0]], "n_leaves": [len(rows)], "total": [rows["total"].iloc[0]], "piece": [piece], "digest": [piece[-SIZE:]]})


def _paths(rows: pd.DataFrame, built: pd.DataFrame, most: int) -> pd.DataFrame:
    """rows (tree, idx, total and others) with path and top instead of total: for each level the number of siblings before, that of all, and the siblings; the root of the tree."""
    out = rows.drop(columns=["total", "block"])
    if rows.empty or built.empty:
        return out.head(0).assign(path=None, top=None)
    piece, above = bytes(built["piece"].iloc[0]), bytes(built["path"].iloc[0])
    n, levels = int(built["n_leaves"].iloc[0]), levels_of(int(rows["total"].iloc[0]), most)
    nodes = np.frombuffer(piece, np.uint8).reshape(-1, SIZE)
    own = rows["idx"].to_numpy(np.int64) % FAN**most
    parts: list[list[bytes]] = [[] for _ in own]
    for level in range(levels):
        size = -(-n // FAN**level)
        digests = nodes[places(n, level, np.arange(size))]
        for k, at in enumerate((own // FAN**level).tolist()):
            low = at - at % FAN
            high = min(low + FAN, size)
            parts[k].append(bytes((at - low, high - low - 1)) + digests[low:at].tobytes() + digests[at + 1 : high].tobytes())
    return out.assign(path=[b"".join(p) + above for p in parts], top=[bytes(built["top"].iloc[0])] * len(out))


def steps(path: bytes) -> list[tuple[int, list[str]]]:
    """(siblings before, siblings as hex text) of each level of a path."""
    out, at = [], 0
    while at < len(path):
        before, count = path[at], path[at + 1]
        at += 2
        out.append((before, [path[at + SIZE * k : at + SIZE * (k + 1)].hex() for k in range(count)]))
        at += SIZE * count
    return out


def folded(leaf: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and its siblings give."""
    for before, siblings in path:
        leaf = hashlib.sha256("".join([*siblings[:before], leaf, *siblings[before:]]).encode()).hexdigest()
    return leaf


# --- the log and its proofs --------------------------------------------------


def numbered(nodes: DataFrame, order: list[Column]) -> DataFrame:
    """nodes with idx, their place in their tree, and total, the nodes of it; no task gets a whole tree.

    nodes must be computed already, as ranges are found from a sample of it.
    """
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tied = nodes.withColumn("tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(parts, "tree", *order, "tie").sortWithinPartitions("tree", *order, "tie")
    ranged = cut(ranged.drop("tie").withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    runs = ranged.groupBy("tree", part.alias("part")).agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    runs = runs.select("tree", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(Window.partitionBy("tree")).alias("total"))
    joined = ranged.withColumn("part", part).join(runs, ["tree", "part"])
    return joined.withColumn("idx", F.col("place") + F.col("shift")).drop("place", "shift", "part")


def build(leaves: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """The log of every tree of leaves (tree, idx, total, digest), a table a tier, lowest first: (tree, block, n_leaves, total, piece, digest)."""
    tiers, nodes, block = [], leaves.select("tree", "idx", "total", "digest"), FAN**levels
    most = leaves.agg(F.max("total")).first()[0]
    while most:
        dealt = nodes.withColumn("block", F.floor(F.col("idx") / block))
        built = cut(dealt.groupBy("tree", "block").applyInPandas(lambda rows: _build(rows, levels), "tree string, block long, n_leaves long, total long, piece binary, digest binary"))
        tiers.append(built)
        nodes = built.filter(F.col("total") > block).select("tree", F.col("block").alias("idx"), F.ceil(F.col("total") / block).alias("total"), "digest")
        most = -(-most // block) if most > block else 0
    return tiers


def roots(tiers: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """(tree, digest) of the root of every tree."""
    tops = [t.filter(F.col("total") <= FAN**levels).select("tree", "digest") for t in tiers]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def log_nodes(tiers: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """(tree, place, digest): the log of each tree, node by node."""
    out = None
    for k, tier in enumerate(tiers):
        marked = tier.withColumn("tier", F.lit(k))
        out = marked if out is None else out.unionByName(marked)
    sizes = tiers[0].select("tree", F.col("total").alias("n")).distinct()

    def spread(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        for r in rows.itertuples():
            base = r.tier * levels
            piece = bytes(r.piece)
            for level in range(levels_of(int(r.total), levels) + 1):
                if level == 0 and r.tier:
                    continue  # the root of a block below, which is in its piece
                own = np.arange(-(-int(r.n_leaves) // FAN**level))
                index = own + int(r.block) * FAN ** (levels - level)
                at = places(int(r.n_leaves), level, own)
                found += [(r.tree, int(p), piece[SIZE * a : SIZE * (a + 1)]) for p, a in zip(places(int(r.n), base + level, index), at, strict=True)]
        return pd.DataFrame(found, columns=["tree", "place", "digest"])

    return out.join(sizes, "tree").mapInPandas(lambda frames: map(spread, frames), "tree string, place long, digest binary")


def proofs(leaves: DataFrame, tiers: list[DataFrame], above: DataFrame | None = None, levels: int = LEVELS) -> DataFrame:
    """leaves with path and top, the root of the tree; ``above`` (tree, path, top) is what follows the root of a tree and what stands for its top.

    Paths are made where the leaves lie and are not shuffled.
    """
    block = FAN**levels
    ends = roots(tiers, levels).select("tree", F.lit(b"").alias("path"), F.col("digest").alias("top")) if above is None else above
    columns = ["tree", "block", "n_leaves", "piece", "path", "top"]
    upper = None  # the blocks of the tier below, with their paths
    for k in range(len(tiers) - 1, -1, -1):
        tops = tiers[k].filter(F.col("total") <= block).join(ends, "tree").select(*columns)
        if upper is not None:
            rest = tiers[k].filter(F.col("total") > block).join(upper.withColumnRenamed("idx", "block"), ["tree", "block"])
            tops = tops.unionByName(rest.select(*columns))
        below = leaves if k == 0 else tiers[k - 1].filter(F.col("total") > block).select("tree", F.col("block").alias("idx"), F.ceil(F.col("total") / block).alias("total"))
        kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in below.schema if f.name != "total"]
        dealt = below.withColumn("block", F.floor(F.col("idx") / block))
        upper = dealt.groupBy("tree", "block").cogroup(tops.groupBy("tree", "block")).applyInPandas(lambda rows, built: _paths(rows, built, levels), ", ".join([*kinds, "path binary", "top binary"]))
    return upper


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, tree: str = "lang", id_col: str = "doc_id", tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """Every row's leaf, what it is digested to now, the roots of its tree and of all, and its path: doc_id, leaf, now, subroot, root, path.

    A tree a value of ``tree``, null first, then by bytes. ``tampered`` is the
    digest that a row has now, if that is another.
    """
    leaf = leaf_digest([F.col(f) for f in fields])
    now = leaf if tampered is None else F.coalesce(tampered, leaf)
    name = F.when(F.col(tree).isNull(), "").otherwise(F.concat(F.lit("="), F.col(tree).cast("string")))
    digested = cut(docs.select(name.alias("tree"), F.col(id_col).alias("doc_id"), F.unhex(leaf).alias("digest"), F.unhex(now).alias("now")))
    leaves = cut(numbered(digested, [F.col("doc_id").asc_nulls_first(), F.col("digest")]))
    tiers = build(leaves, levels)
    if not tiers:
        none = F.lit(None).cast("binary")
        return leaves.select("doc_id", F.col("digest").alias("leaf"), "now", none.alias("subroot"), none.alias("root"), none.alias("path"))
    named = cut(numbered(roots(tiers, levels).select(F.lit("").alias("tree"), F.col("tree").alias("own"), "digest"), [F.col("own")]))
    upper = build(named, levels)
    root = F.lit(bytes(roots(upper, levels).first()["digest"]))
    ends = cut(proofs(named, upper, levels=levels).select(F.col("own").alias("tree"), "path", F.col("digest").alias("top")))
    found = proofs(leaves, tiers, ends, levels)
    return found.select("doc_id", F.col("digest").alias("leaf"), "now", F.col("top").alias("subroot"), root.alias("root"), "path")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roots and proofs of documents; texts of a third of the ids have lost their capitals since."""
    docs = table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = [F.translate("text", ascii_uppercase, ascii_lowercase) if f == "text" else F.col(f) for f in FIELDS]
    found = manifest(docs, tampered=F.when(changed, leaf_digest(lower)))

    def check(frames):
        for f in frames:
            paths = [steps(bytes(p)) for p in f["path"]]
            hexed = lambda c: [bytes(d).hex() for d in f[c]]
            out = pd.DataFrame({"doc_id": f["doc_id"], "leaf": hexed("leaf"), "subroot": hexed("subroot"), "root": hexed("root")})
            out["proof_sha256"] = [hashlib.sha256("".join("".join(s) for _, s in p).encode()).hexdigest() for p in paths]
            out["folded_root"] = [folded(d, p) for d, p in zip(hexed("now"), paths, strict=True)]
            out["verified"] = out["folded_root"] == out["root"]
            yield out

    return found.mapInPandas(check, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def _climb(nodes: str, proof: str, depth: int) -> str:
    """SQL of ``depth`` levels over ``nodes``0 (tree, idx, h, c); it carries ``proof``0 (doc_id, leaf, tree, idx, proof, fold) along."""
    out = []
    for k in range(depth):
        out.append(f"""
s{nodes}{k} AS (SELECT a.tree, a.idx, a.c, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM {nodes}{k} a JOIN {nodes}{k} b ON a.tree = b.tree AND a.idx // 8 = b.idx // 8 GROUP BY a.tree, a.idx, a.c),
{nodes}{k + 1} AS (SELECT tree, idx // 8 AS idx, CASE WHEN max(c) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h, (max(c) + 7) // 8 AS c FROM {nodes}{k} GROUP BY tree, idx // 8),
{proof}{k + 1} AS (SELECT f.* REPLACE (f.idx // 8 AS idx, CASE WHEN c = 1 THEN proof ELSE proof || l || r END AS proof, CASE WHEN c = 1 THEN fold ELSE sha256(l || fold || r) END AS fold) FROM {proof}{k} f JOIN s{nodes}{k} s ON f.tree = s.tree AND f.idx = s.idx)""")
    return ",".join(out)


def _leaf_sql(text: str) -> str:
    fields = [text if f == "text" else f"CAST({f} AS VARCHAR)" for f in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + ")"


#: Levels of the SQL: enough for 8 ** 7 leaves a tree and 8 ** 4 trees. DuckDB has no crc32, so it is a table of eight steps a byte.
_CRC_SQL = """
crc AS (SELECT doc_id AS id, CASE WHEN doc_id IS NULL THEN NULL ELSE xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1))::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) END AS crc
  FROM (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents))"""
OP12_SQL = f"""
WITH {_CRC_SQL.strip()},
leaves AS (SELECT d.doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree, {_leaf_sql("text")} AS leaf,
    CASE WHEN crc % 3 = 0 THEN {_leaf_sql(f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')")} ELSE {_leaf_sql("text")} END AS now
  FROM documents d JOIN crc ON d.doc_id IS NOT DISTINCT FROM crc.id),
f0 AS (SELECT doc_id, leaf, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, '' AS proof, now AS fold FROM leaves),
n0 AS (SELECT tree, idx, leaf AS h, count(*) OVER (PARTITION BY tree) AS c FROM f0),{_climb("n", "f", 7)},
tops AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS idx FROM n7),
m0 AS (SELECT '' AS tree, idx, h, count(*) OVER () AS c FROM tops),
g0 AS (SELECT f.doc_id, f.leaf, t.h AS subroot, '' AS tree, t.idx, f.proof, f.fold FROM f7 f JOIN tops t USING (tree)),{_climb("m", "g", 4)}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = h AS verified FROM g4 JOIN m4 USING (tree)"""
