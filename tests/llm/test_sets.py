"""Mixing, packing, embeddings, and the pipeline."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from aerolith.llm import covertree, mixing, packing


def _targets(sizes, weights=mixing.WEIGHTS, repeats=mixing.REPEATS):
    """Targets by taking back what is above the cap, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > repeats * sizes[s]]
        if not above:
            return capped | share
        capped |= {s: float(repeats * sizes[s]) for s in above}


def test_fit_budget_is_exact_where_a_sum_exists():
    rng = np.random.default_rng(5)
    for _ in range(60):
        lengths = np.unique(rng.integers(1, 60, rng.integers(1, 8)))
        counts = rng.integers(1, 6, len(lengths))
        budget = int(rng.integers(0, int((lengths * counts).sum()) + 5))
        take = mixing.fit_budget(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all() and (lengths * take).sum() <= budget
        reach = {0}
        for n, c in zip(lengths.tolist(), counts.tolist(), strict=True):
            reach = {s + k * n for s in reach for k in range(c + 1)}
        near = max(s for s in reach if s <= budget)  # no choice of documents comes nearer
        assert near - (2 if budget > mixing.OPEN * lengths.max() else 0) <= (lengths * take).sum() <= near
    rare, one = np.arange(1, 3000), np.ones(2999, np.int64)
    take = mixing.fit_budget(rare, one, int(rare.sum()) // 2)
    assert (rare * take).sum() == int(rare.sum()) // 2 and 0.3 < take[:1500].mean() < 0.7  # not only the longest
    lengths, counts = np.arange(1, 3000), np.full(2999, 50)
    assert abs((lengths * mixing.fit_budget(lengths, counts, 100_000_003)).sum() - 100_000_003) <= 0


@pytest.mark.parametrize("share", [0.02, 0.15, 0.3, 0.77])
def test_fit_budget_keeps_the_share_of_every_band(share):
    """Also where each length is rare and the budget large."""
    rng = np.random.default_rng(1)
    lengths = np.arange(1, 20_001)
    counts = rng.integers(0, 4, len(lengths))
    budget = int((lengths * counts).sum() * share)
    take = mixing.fit_budget(lengths, counts, budget)
    assert (lengths * take).sum() == budget and (take <= counts).all() and (take >= 0).all()
    for low in range(0, 20_000, 2500):
        band = slice(low, low + 2500)
        assert abs(take[band].sum() / counts[band].sum() - share) < 0.03
    for low in (0, 3, 700):
        out = mixing.shared_out(counts[low:], 10_007, int(counts[low:].sum()) * 3)
        assert (np.abs(np.cumsum(out) - np.cumsum(counts[low:]) * 10_007 / (int(counts[low:].sum()) * 3)) < 1).all()


def test_mixture_has_as_many_rows_as_copies(spark, small):
    """Also of rows without an id, or that share one."""
    import corpus_pipeline

    rng = random.Random(6)
    rows = [(k // 3 if k % 4 else None, f"s{k % 3}" if k % 7 else None, " ".join("w" * rng.randint(0, 30)), k) for k in range(200)] + [(None, None, "x y z", -1)] * 9 + [(5, "s1", None, -2)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, mark long").repartition(3)
    found = corpus_pipeline.mixture(spark, docs, small).collect()
    mixed = mixing.mix(docs).collect()
    assert Counter((r["doc_id"], r["source"], r["text"]) for r in found).total() == sum(r["copies"] for r in mixed)
    words = Counter()
    for r in found:
        words[r["source"]] += len((r["text"] or "").split())
    want = Counter()
    for r in mixed:
        want[r["source"]] += r["taken"]
    assert words == +want
    by_mark = Counter(r["mark"] for r in found)
    assert max(v for m, v in by_mark.items() if m >= 0) <= mixing.REPEATS and by_mark[-1] <= 9 * mixing.REPEATS


def test_mix_of_documents(spark):
    rng = random.Random(2)
    rows = [(k, None if k % 11 == 0 else f"s{k % 5}", " ".join("w" * rng.randint(1, 60 if k % 5 else 6))) for k in range(600)]
    rows += [(1000, "s1", None), (1001, "s2", ""), (1002, "empty", " \n"), (1003, "s1", "a b"), (1003, "s1", "a b"), (1004, "é", "x " * 5000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    found = mixing.mix(frame).collect()
    assert len(found) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, s, t in rows:
        sizes[s] += len((t or "").split())
    want = _targets(sizes)
    for r in found:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]]) and 0 <= r["taken"] <= 3 * r["size"]
    for s in sizes:
        # As near as the documents' lengths allow; one long document alone cannot be split.
        assert abs(taken[s] - want[s]) <= (5000 if s == "é" else 1), s
    again = mixing.mix(frame.orderBy("text")).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))
    assert mixing.mix(spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0


def test_best_fit_bins_hold_what_they_say():
    rng = np.random.default_rng(4)
    for capacities in ((512, 1024, 2048, 4096), (100,), (7, 100, 101)):
        lengths = np.sort(rng.integers(1, max(capacities) + 1, 500))[::-1]
        bins, places, sizes, contents = packing.best_fit(lengths, capacities)
        filled = np.bincount(bins, lengths).astype(int)
        assert (filled == contents).all() and (contents <= sizes).all()
        assert all(s == min(c for c in capacities if c >= n) for s, n in zip(sizes, contents, strict=True))
        for b in range(len(sizes)):
            mine = np.flatnonzero(bins == b)
            assert places[mine].tolist() == np.concatenate([[0], np.cumsum(lengths[mine])[:-1]]).tolist()
        assert sum(map(packing.bin_cost, sizes)) <= 1.15 * lengths.sum() / max(capacities) * packing.bin_cost(max(capacities)) + 5 * packing.bin_cost(max(capacities))
    assert [len(x) for x in packing.best_fit(np.zeros(0, np.int64))] == [0, 0, 0, 0]


def test_best_fit_is_near_the_least_cost():
    """Of up to seven pieces the cost is near that of the best of all ways to pack them."""
    rng = np.random.default_rng(6)
    capacities = (8, 16, 32)
    cost = [min((packing.bin_cost(c) for c in capacities if c >= n), default=np.inf) for n in range(200)]
    over = []
    for _ in range(60):
        lengths = np.sort(rng.integers(1, 33, rng.integers(1, 8)))[::-1]
        n = len(lengths)
        total = [int(sum(lengths[k] for k in range(n) if m >> k & 1)) for m in range(1 << n)]
        best = [0.0] + [np.inf] * ((1 << n) - 1)
        for m in range(1, 1 << n):
            part = m
            while part:
                if cost[total[part]] < np.inf:
                    best[m] = min(best[m], best[m ^ part] + cost[total[part]])
                part = part - 1 & m
        sizes = packing.best_fit(lengths, capacities)[2]
        over.append(sum(map(packing.bin_cost, sizes)) / best[-1])
    assert min(over) >= 1 - 1e-9 and max(over) <= 1.7 and np.mean(over) <= 1.1


def test_packing_of_rows_that_repeat_is_dealt_out(spark):
    docs = spark.createDataFrame([(None, "x y z", 1, 2)] * 300, "doc_id long, text string, deal int, bin int")
    found = packing.pack(docs, shard_pieces=30).collect()
    assert len({r["bin"] >> 32 for r in found}) >= 8 and sum(r["length"] for r in found) == 900


def test_packing_keeps_every_word_once(spark):
    rng = random.Random(1)
    rows = [(k, "x " * rng.randint(0, 900)) for k in range(200)] + [(500, "y " * 9000), (501, None), (7, "x"), (7, "x"), (None, "z z")]
    found = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), shard_pieces=60).collect()
    words = Counter()
    for r in found:
        words[r["doc_id"]] += r["length"]
    want = Counter()
    for i, t in rows:
        want[i] += len((t or "").split())
    assert words == want
    bins = defaultdict(list)
    for r in found:
        if r["length"]:
            bins[r["bin"]].append(r)
        else:
            assert r["bin"] is None
    for of in bins.values():
        of.sort(key=lambda r: r["position"])
        at = 0
        for r in of:
            assert r["position"] == at
            at += r["length"]
        assert at == of[0]["tokens"] <= of[0]["capacity"]
    long = sorted((r["start"], r["length"]) for r in found if r["doc_id"] == 500)
    assert long == [(0, 4096), (4096, 4096), (8192, 808)]
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def _brute_vectors(rows, cosine):
    links = defaultdict(set)
    unit = {}
    for k, (_, v, label) in enumerate(rows):
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            unit[k] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    for a in unit:
        for b in unit:
            if a != b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= cosine:
                links[a].add(b)
    least = {k: np.inf if rows[k][0] is None else rows[k][0] for k in range(len(rows))}
    changed = True
    while changed:
        changed = False
        for a, others in links.items():
            m = min([least[a], *(least[b] for b in others)])
            changed |= m != least[a]
            least[a] = m
    of = {k: None if least[k] == np.inf else least[k] for k in least}
    return sorted(((rows[k][0], len(links[k]), of[k], None if rows[k][0] is None or of[k] is None else rows[k][0] == of[k]) for k in range(len(rows))), key=str)


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(covertree, "BLOCK", 25)
    rng = np.random.default_rng(7)
    rows = []
    for k in range(260):
        centre = np.random.default_rng(k % 20).normal(size=8)
        rows.append((k, (centre + rng.normal(size=8) * rng.choice([0.02, 0.15, 0.3])).astype(np.float32).astype(float).tolist(), int(k % 3 == 0)))
    rows += [(300 + k, rows[0][1], rows[0][2]) for k in range(12)]
    rows += [(400, None, 1), (401, rows[3][1], None), (402, [0.0] * 8, 1), (403, [float("nan")] * 8, 1), (404, [None, 1.0], 1), (405, [float("inf"), 1.0], 1), (406, [], 1), (407, [1.0, 2.0], 1), (408, [2.0, 4.0], 1), (409, [1e-40, 0.0], 1)]
    rows += [(5, rows[3][1], rows[3][2]), (5, [1.0, -2.0, 0.5], 1), (5, [1.0, -2.0, 0.6], 1), (None, rows[4][1], rows[4][2])]
    # Columns of the names that are used within stay out of the way.
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "vec_id long, embedding array<float>, label int, rep int, least int, cell int, component_id int")
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], n) for i, v, n in rows]
    found = covertree.near_duplicates(frame, 0.93).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(tuple, found), key=str) == _brute_vectors(exact, 0.93)
    assert covertree.near_duplicates(frame.limit(0), 0.93).count() == 0


def test_cover_tree_holds():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5))
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree = covertree.CoverTree(x, 0.05)
    assert sorted(tree.members.tolist()) == list(range(300))
    for node in range(len(tree.centre)):
        below = tree.members[tree.first_below[node] : tree.last_below[node]]
        assert np.linalg.norm(x[below] - x[tree.centre[node]], axis=1).max() <= tree.radius[node] + 1e-6
    pairs = set()
    for i, j, whole in covertree.dual_traversal(tree, tree, 0.9):
        pairs |= {(min(a, b), max(a, b)) for a in i.tolist() for b in j.tolist()} if whole else {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    close = x @ x.T >= 0.9
    assert pairs == {(a, b) for a in range(300) for b in range(a + 1, 300) if close[a, b]}


def test_pipeline(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, small)
        assert out.columns == docs.columns, name
        rows = out.collect()
        if name == "language":
            assert len(rows) == docs.count()
        if name == "near_copies":
            assert len({r["doc_id"] for r in rows}) == len(rows)
        kept = spark.createDataFrame(rows, docs.schema)
    words = sum(len((r["text"] or "").split()) for r in kept.collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, small).collect()
    assert sum(r["length"] for r in packed) == words
    assert sum(r["length"] for r in corpus_pipeline.run(spark, small).collect()) == words
