"""Phrase index, Merkle log and periodic runs against plain definitions."""

from __future__ import annotations

import hashlib
import random
import re
import uuid
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import merklelog, periodicity, phraseindex
from aerolith.llm.storage import shared_folder

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _words(text):
    return WORD.findall((text or "").translate(LOWER))


# --- phrase index ------------------------------------------------------------


def _contamination(docs, items, size):
    windows = {}
    for i, text in items:
        w = _words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(i)
    out = []
    for i, text in docs:
        w, hit, names = _words(text), set(), set()
        for n in {len(p) for p in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    names |= windows[tuple(w[k : k + n])]
        names = sorted(str(x) for x in names if x is not None)
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def _tables(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("few", [True, False])
def test_contamination_is_what_plain_search_finds(spark, monkeypatch, few):
    """Also where nothing is broadcast."""
    if not few:
        monkeypatch.setattr(phraseindex, "SMALL", -1)
    rng = random.Random(3)
    text = lambda n, k: " ".join(rng.choice("the of Ωmega a é b2 c d".split()[:k]) for _ in range(n))
    items = [(k, text(rng.randint(1, 30), 8)) for k in range(12)] + [(12, "one"), (13, "!?"), (None, "solo word here"), (3, "a second text of item three"), (14, None)]
    docs = [(k, text(rng.randint(0, 60), 8)) for k in range(25)]
    docs += [(k, f"{text(20, 3)}. {items[k % 12][1].upper()}, {text(9, 8)}; {items[5][1]}") for k in range(25, 40)]
    docs += [(7, "ONE a solo-word\x00here"), (7, "ONE a solo-word\x00here"), (None, "one"), (None, None), (50, ""), (51, "a " * 4000)]
    a, b = _tables(spark, docs, items)
    found = sorted((tuple(r) for r in phraseindex.contamination(a, b, 5).collect()), key=repr)
    assert found == _contamination(docs, items, 5)
    assert sum(r[5] for r in found) > 20


def test_contamination_of_odd_tables(spark):
    docs, items = _tables(spark, [(1, "a b"), (2, None)], [(1, "a b c d")])
    assert sorted(tuple(r)[:3] for r in phraseindex.contamination(docs, items.limit(0)).collect()) == [(1, 2, 0), (2, 0, 0)]
    assert phraseindex.contamination(docs.limit(0), items).count() == 0
    more = [docs.select("*", *(F.lit(9).alias(c) for c in ("doc", "term", "words", "n", "place", "word", "position"))), items.select("*", *(F.lit(9).alias(c) for c in ("words", "at", "phrase", "doc_id")))]
    assert sorted(map(tuple, phraseindex.contamination(*more, 2).collect())) == sorted(map(tuple, phraseindex.contamination(docs, items, 2).collect()))


@pytest.mark.parametrize("few", [True, False])
def test_near_matches_are_what_plain_search_finds(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(phraseindex, "SMALL", -1)
    rng = random.Random(4)
    docs = [(k, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(5, 120)))) for k in range(30)]
    items = [(1, "a b c"), (2, "h"), (3, "g h"), (4, "d d e f g"), (5, "a zz")]
    a, b = _tables(spark, docs, items)
    phrases, sources = phraseindex.numbered_phrases(phraseindex.windows_of(b))
    known = phraseindex.vocabulary(phrases)
    index = phraseindex.build_index(a, known, f"{shared_folder(spark)}/t-{uuid.uuid4().hex}")
    heads = index.filter("term = 0").select("doc", "doc_id")
    got = {(r["doc_id"], r["item_id"], r["position"]) for r in phraseindex.near_matches(index, known, phrases, 3).drop("doc_id").join(heads, "doc").join(sources, "phrase_id").collect()}
    terms = {r["word"]: r["term"] for r in known.collect()}
    texts = {i: t.split() for i, t in docs}
    count = defaultdict(int)
    for w in texts.values():
        for x in w:
            count[x] += 1
    want = set()
    for item, phrase in items:
        order = sorted(set(phrase.split()), key=lambda x: (count[x], min(k for k, y in enumerate(phrase.split()) if y == x), terms[x]))
        for i, w in texts.items():
            want |= {(i, item, p) for p, x in enumerate(w) if x == order[0] and all(any(w[q] == y for q in range(max(0, p - 3), min(len(w), p + 4))) for y in order[1:])}
    assert got == want and len({x[1] for x in got}) == 4


# --- Merkle log --------------------------------------------------------------


def _appended(n):
    """(level, index) of the nodes of a tree of n leaves as they are completed."""
    height, log = len(merklelog.heights(n)) - 1, []
    waiting, made = [0] * (height + 1), [0] * (height + 1)

    def put(level):
        log.append((level, made[level]))
        made[level] += 1
        waiting[level] += 1
        if level < height and waiting[level] == merklelog.FAN:
            waiting[level] = 0
            put(level + 1)

    for _ in range(n):
        put(0)
    for level in range(height):
        if waiting[level]:
            waiting[level] = 0
            put(level + 1)
    return log


@pytest.mark.parametrize("n", [*range(1, 80), 511, 512, 513, 4096, 4097, 4680])
def test_places_in_the_log(n):
    log = {node: k for k, node in enumerate(_appended(n))}
    for level, size in enumerate(merklelog.heights(n)):
        assert merklelog.places(n, level, np.arange(size)).tolist() == [log[level, k] for k in range(size)]


def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_hash(*out[-1][k : k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def _siblings(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = range(at - at % 8, min(at - at % 8 + 8, len(nodes)))
        out.append(([nodes[k] for k in run if k < at], [nodes[k] for k in run if k > at]))
        at //= 8
    return out


def _leaf(row):
    return _hash(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


@pytest.mark.parametrize("levels", [4, 1])
def test_manifest_of_odd_rows(spark, levels):
    """Against plain trees; small blocks make several tiers."""
    rng = random.Random(1)
    rows = [(k, "s", rng.choice(["en", "é"]), k, f"Text {k}") for k in range(150)]
    rows += [(None, None, None, None, None), (None, None, None, None, "x"), (5, "a", "en", 1, "A"), (5, "a", "en", 1, "A"), (5, "b", "en", 1, ""), (-3, "a", "lone", 1, "ß" * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    docs = docs.select("*", *(F.lit(1).alias(c) for c in ("tree", "digest", "idx", "total", "now", "path", "tie", "place")))
    got = []
    for r in merklelog.manifest(docs, levels=levels).collect():
        path = merklelog.steps(bytes(r["path"]))
        got.append((r["doc_id"], r["leaf"].hex(), r["subroot"].hex(), r["root"].hex(), tuple((b, tuple(s)) for b, s in path)))
        assert merklelog.folded(r["leaf"].hex(), path) == r["root"].hex() and merklelog.folded(_hash("other"), path) != r["root"].hex()
    trees = defaultdict(list)
    for row in rows:
        trees[row[2]].append((row[0] is not None, row[0] or 0, _leaf(row), row[0]))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    subtrees = [_levels([x[2] for x in sorted(trees[name], key=lambda x: x[:3])]) for name in names]
    upper = _levels([t[-1][0] for t in subtrees])
    want = []
    for k, (name, tree) in enumerate(zip(names, subtrees, strict=True)):
        for at, leaf in enumerate(sorted(trees[name], key=lambda x: x[:3])):
            siblings = _siblings(tree, at) + _siblings(upper, k)
            want.append((leaf[3], leaf[2], tree[-1][0], upper[-1][0], tuple((len(a), tuple(a + b)) for a, b in siblings)))
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert merklelog.manifest(docs.limit(0)).count() == 0


def test_log_holds_every_node_at_its_place(spark):
    for n in (1, 8, 9, 75):
        digests = [_hash(str(k)) for k in range(n)]
        leaves = spark.createDataFrame([("t", k, n, bytes.fromhex(d)) for k, d in enumerate(digests)], "tree string, idx long, total long, digest binary")
        log = {r["place"]: r["digest"].hex() for r in merklelog.log_nodes(merklelog.build(leaves, 1), 1).collect()}
        tree = _levels(digests)
        assert log == {k: tree[level][i] for k, (level, i) in enumerate(_appended(n))}


# --- periodic runs -----------------------------------------------------------


def _runs(words):
    n, out = len(words), {}
    for q in range(1, n // 3 + 1):
        start = 0
        for k in range(n - q + 1):
            if k == n - q or words[k] != words[k + q]:
                if k - start + q >= max(24, 3 * q) and (start, k - start + q) not in out:
                    out[start, k - start + q] = q
                start = k + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda x: (x[0], x[2]))


def test_runs_are_what_plain_search_finds(monkeypatch):
    rng = random.Random(9)
    for trial in range(400):
        if trial == 200:  # the way of long texts
            monkeypatch.setattr(periodicity, "COMMON", 0)
            monkeypatch.setattr(periodicity, "PLACES", 50)
        n, k = rng.randint(0, 180), rng.choice([1, 2, 3, 40])
        words = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randint(0, 4) if n > 5 else 0):
            a, p = rng.randrange(n), rng.randint(1, 30)
            for i in range(a + p, min(n, a + rng.randint(10, 120))):
                words[i] = words[i - p]
        assert [tuple(r) for r in periodicity.runs_of(np.array(words, np.int32)).tolist()] == _runs(words)


def test_extensions_of_any_places():
    rng = random.Random(2)
    for trial in range(60):
        n = rng.randint(1, 300)
        words = np.array([rng.randrange(2) for _ in range(n)])
        words = np.tile(words[: max(1, n // 5)], 6)[:n] if trial % 2 else words
        n = len(words)
        i = np.array([rng.randrange(n) for _ in range(40)])
        j = np.array([rng.randint(a + 1, n) for a in i])
        for a, b, c in zip(i, j, periodicity.Extensions(words).common(i, j), strict=True):
            same = [words[a + k] == words[b + k] for k in range(n - b)]
            assert c == (same.index(False) if False in same else n - b)


def _periodic_row(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = _runs(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_run_query_is_its_plain_definition(spark, small):
    from aerolith.llm.registry import QUERIES

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(map(tuple, QUERIES["op13_runs"](spark, small).collect()))
    short = {i for i, t in docs if len((t or "").split()) < 1500}
    assert len(short) > 150 and [r for r in found if r[0] in short] == sorted(_periodic_row(i, t) for i, t in docs if i in short)
    assert len(found) == len(docs) and sum(r[1] > 0 for r in found) > 10


def test_runs_of_odd_rows(spark):
    rows = [(1, "x " * 30), (1, "x " * 30), (None, None), (None, "a\xa0b \x0bc"), (3, ""), (4, "ab   " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *(F.lit(1).alias(c) for c in ("runs", "n_words", "collapsed")))
    found = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], bytes(r["collapsed"]).decode()) for r in periodicity.periodic_runs(docs).collect()]
    want = [(1, 30, [(0, 30, 1)], "x")] * 2 + [(None, 0, [], ""), (None, 2, [], "a\xa0b c"), (3, 0, [], ""), (4, 40_000, [(0, 40_000, 2)], "ab  ")]
    assert sorted(map(repr, found)) == sorted(map(repr, want))
    assert periodicity.periodic_runs(docs.limit(0)).count() == 0
