"""Line deduplication and the Jaccard join against brute force."""

from __future__ import annotations

import random
import re
import time
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from aerolith.llm import jaccard, linededup
from aerolith.llm import components as components_module
from aerolith.llm.components import components
from aerolith.llm.textarrays import text_buffers

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def _near(rng, text):
    words = text.split(" ")
    for _ in range(rng.randint(1, 3)):
        words[rng.randrange(len(words))] = _words(rng, 1)
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base = [_words(rng, 60) for _ in range(6)]
    texts = [_near(rng, base[k % 6]) for k in range(90)] + [_words(rng, rng.randint(1, 80)) for _ in range(40)]
    texts += [base[0]] * 30 + [None, "", " \n ", "one", "one", "One two", "a b c", "A  b\tc", _words(rng, 4000)]
    texts += ["\n".join(rng.sample(base, 3)) for _ in range(10)] + [_near(rng, base[1]) + "\n" + base[1].upper() + "!" for _ in range(5)]
    return [(k, t, None, None, None) for k, t in enumerate(texts)]


@pytest.mark.parametrize("lot", [1 << 20, 16])
def test_components_of_a_path_a_star_and_a_loop(spark, monkeypatch, lot):
    monkeypatch.setattr(components_module, "LOT", lot)  # so that few links take the rounds
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[k] == 0 for k in range(41)) and all(found[k] == 100 for k in range(100, 160)) and found[202] == 200 and 300 not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _sets(rows, k):
    out = {}
    for i, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        out[i] = set() if not w else {tuple(w)} if len(w) < k else {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
    return out


def _groups(nodes, links):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return least


@pytest.mark.parametrize(("k", "num", "den"), [(4, 85, 100), (5, 80, 100)])
def test_jaccard_join_equals_brute_force(spark, corpus, k, num, den, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAF", 3)  # so that trees are used on few rows
    monkeypatch.setattr(jaccard, "BLOCK", 20)
    sets = _sets(corpus, k)
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    least = _groups(sets, links)
    found = jaccard.jaccard_join(spark.createDataFrame(corpus, DOCS), k, num, den).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == {i: (len(sets[i]), least[i]) for i in sets}
    assert len(links) > 500


def test_jaccard_join_of_odd_rows(spark):
    rows = [(1, "a b c d e", None, None, None), (1, "a b c d e", None, None, None), (None, "a b c d e", None, None, None), (3, None, None, None, None)]
    found = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_join(spark.createDataFrame(rows, DOCS), 4, 85, 100).collect())
    assert found == [(-1, 2, None), (1, 2, 1), (1, 2, 1), (3, 0, 3)]
    assert jaccard.jaccard_join(spark.createDataFrame([], DOCS), 4, 85, 100).count() == 0


def test_jaccard_join_of_an_id_with_two_sets(spark):
    rng = random.Random(8)
    a, b = _words(rng, 60), _words(rng, 60)
    rows = [(5, a), (5, b), (8, a + " more"), (9, b + " more"), (4, _words(rng, 60))]
    docs = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in rows], "doc_id long, text string, rep int, d1 int, n int, least int, component_id int")
    found = sorted((r["doc_id"], r["component_id"]) for r in jaccard.jaccard_join(docs, 4, 85, 100).collect())
    assert found == [(4, 4), (5, 5), (5, 5), (8, 5), (9, 5)]


def test_signature_tree_loses_no_pair():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 4000, rng.integers(20, 200))) for _ in range(120)]
    sets += [np.unique(np.concatenate([s[: -max(1, len(s) // 20)], rng.integers(0, 4000, 3)])) for s in sets[:40]]
    sets.sort(key=len)
    grid = np.zeros((len(sets), 512), bool)
    for r, s in enumerate(sets):
        grid[r, s % 512] = True
    bits = np.packbits(grid, axis=1, bitorder="little").view(np.uint64)
    tree = jaccard.SignatureTree(np.array([len(s) for s in sets]), bits)
    found = {(int(a), int(b)) for i, j, _ in tree.pairs(80, 100) for a, b in zip(i, j, strict=True)}
    want = {(a, b) for a, b in combinations(range(len(sets)), 2) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    assert want and want <= found and len(found) < 3000


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_edit_distance_bound():
    rng = random.Random(2)
    for _ in range(300):
        a = "".join(rng.choice("abcé") for _ in range(rng.randint(0, 30)))
        b = "".join(rng.choice("abcé") for _ in range(rng.randint(0, 30))) if rng.random() < 0.5 else a[:10] + "x" + a[12:]
        d = _distance(a, b)
        assert d <= linededup.at_most(a, b, 99)
        assert all(linededup.within(a, b, m) == (d <= m) for m in range(0, 12))
    for _ in range(40):
        a = "".join(rng.choice("abcd ") for _ in range(rng.randint(150, 260)))
        b = "".join(rng.choice("abcd ") if rng.random() < 0.2 else c for c in a)[: rng.randint(140, 260)] if rng.random() < 0.7 else "".join(rng.choice("abcd ") for _ in range(200))
        d = _distance(a, b)
        assert all(linededup.within(a, b, m) == (d <= m) for m in (d // 2, d - 1, d, d + 1, 2 * d))
    for _ in range(200):
        a, b = (" ".join(rng.choice(["ab", "c", "dé", "efg", ""]) for _ in range(rng.randint(0, 12))) for _ in range(2))
        assert _distance(a, b) <= min(linededup.at_most(a, b, m) for m in (0, 5, 99))


def _edited(rng, line, share, letters):
    out = list(line)
    for _ in range(round(share * len(line))):
        k, kind = rng.randrange(len(out) + 1), rng.randrange(3)
        out[k : k + (kind != 1)] = rng.choice(letters) * (kind != 2)
    return "".join(out)


@pytest.mark.parametrize("at_once", [2048, 50])
def test_many_pairs_are_judged_as_each_of_them(monkeypatch, at_once):
    """Lengths about those of whole words of 64 rows, edits at an end, lines of one kind among those of another."""
    monkeypatch.setattr(linededup, "PAIRS_AT_ONCE", at_once)
    rng = random.Random(12)
    one, two = ["", "", "a"], ["", "a", ""]
    for letters in ("abcd ", "etaoin shrdlu", "éß漢字\U0001f600xy "):
        for _ in range(500):
            size = rng.choice([1, 2, 5, 63, 64, 65, 127, 128, 129, 192, 193, rng.randint(1, 400)])
            line = "".join(rng.choice(letters) for _ in range(size))
            near = _edited(rng, line, rng.choice([0, 0.1, 0.2, 0.25, 0.4]), letters)
            moved = near[size // 10 :] + "".join(rng.choice(letters) for _ in range(size // 10))
            one.append(line)
            two.append(rng.choice([near, moved, line[::-1]]))
    want = [linededup.similar(a, b, 0.8) for a, b in zip(one, two, strict=True)]
    assert 300 < sum(want) < 1200
    assert linededup.all_similar(pa.array(one), pa.array(two), 0.8).tolist() == want
    assert linededup.all_similar(pa.array(["x"] + one).slice(1), pa.array(two), 0.8).tolist() == want


def test_distances_of_many_pairs():
    rng = random.Random(13)
    pairs = [("".join(rng.choice("abc") for _ in range(rng.randint(0, 150))), rng.randint(0, 40)) for _ in range(120)]
    pairs = [(a, _edited(rng, a, 0.2, "abc") if k % 3 else a[::-1], m) for k, (a, m) in enumerate(pairs)]
    pairs = sorted(((*sorted((a, b), key=len), m) for a, b, m in pairs), key=lambda x: -len(x[1]))
    texts = [x[0] for x in pairs] + [x[1] for x in pairs]
    sizes = np.array([len(x) for x in texts])
    places = (np.cumsum(sizes) - sizes).reshape(2, -1)
    codes = np.array([ord(c) for x in texts for c in x], np.uint32)
    found = linededup.all_within(codes, *places, *sizes.reshape(2, -1), np.array([x[2] for x in pairs]))
    want = [_distance(a, b) <= m for a, b, m in pairs]
    assert found.tolist() == want and 20 < sum(want) < 100


def test_pairs_just_beyond_the_similarity_take_little_time():
    """They share too many runs to be ruled out without an edit distance; on 0.5 GB most of the time went to them."""
    rng = random.Random(14)
    letters = "etaoinshrdlu    "
    one = ["".join(rng.choice(letters) for _ in range(rng.randint(400, 500))) for _ in range(2000)]
    two = [_edited(rng, x, 0.3, letters) for x in one]
    began = time.process_time()
    one_by_one = [linededup.similar(a, b, 0.8) for a, b in zip(one[:200], two, strict=False)]
    between = time.process_time()
    assert linededup.all_similar(pa.array(one), pa.array(two), 0.8)[:200].tolist() == one_by_one
    assert (time.process_time() - between) / 2000 < 0.5 * (between - began) / 200


def test_stretches_that_a_line_has_not_never_rule_out_a_near_pair():
    """No pair that the edit distance allows is ruled out, and lines of the same syllables, which share too many runs of three, are."""
    rng = random.Random(15)
    parts = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 4))) for _ in range(60)] + [" "] * 25
    for letters in (parts, list("ab"), list("éß漢字\U0001f600xy ")):
        one = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 90))) for _ in range(120)]
        two = [_edited(rng, x, rng.choice([0, 0.1, 0.2, 0.3]), "".join(letters)) if k % 3 and x else "".join(rng.choice(letters) for _ in range(len(x) // 2)) for k, x in enumerate(one)]
        sizes = np.array([len(x) for x in one + two])
        codes, places = np.array([ord(c) for x in one + two for c in x], np.uint32), (np.cumsum(sizes) - sizes).reshape(2, -1)
        exact = np.array([_distance(a, b) for a, b in zip(one, two, strict=True)])
        for most in (exact, exact - 1, exact // 2, exact * 0 + 3):
            apart = linededup.all_apart(codes, *places, *sizes.reshape(2, -1), np.maximum(most, 0))
            assert not (apart & (exact <= np.maximum(most, 0))).any()
        want = [linededup.similar(a, b, 0.8) for a, b in zip(one, two, strict=True)]
        may = linededup.may_be_similar(pa.array(one), pa.array(two), 0.8)
        assert may[want].all() and sum(want) > 10
    lines = ["".join(rng.choice(parts) for _ in range(150)) for _ in range(200)]
    assert linededup.may_be_similar(pa.array(lines[:100]), pa.array([x[: len(y)] for x, y in zip(lines[100:], lines, strict=False)]), 0.8).mean() < 0.2


def _near_by_bits(simhash, a, b, longer):
    bits = [int(x).bit_count() for x in (simhash[a] ^ simhash[b]).view(np.uint64)]
    return bits[0] + bits[1] <= 44 - 2 * max(0, np.log2(longer / 24)) or bits[2] <= 20


def _brute_lines(rows):
    """Texts without repeated lines, from all pairs of lines."""
    lines = []
    for i, text, *_ in rows:
        for n, line in enumerate((text or "").split("\n")):
            norm = linededup.normal(line)
            if norm:
                lines.append((i, n, norm))
    classes = sorted({x[2] for x in lines})
    raw, ends = text_buffers(pa.array(classes))
    made = linededup.Lines(raw, ends, 0, len(classes))
    blocks = [set(b) for b in made.blocks().T.tolist()]
    links = [(a, b) for a, b in combinations(range(len(classes)), 2) if blocks[a] & blocks[b] and _near_by_bits(made.simhash, a, b, max(len(classes[a]), len(classes[b]))) and linededup.similar(classes[a], classes[b], linededup.SIMILARITY)]
    group = _groups(range(len(classes)), links)
    number = {c: k for k, c in enumerate(classes)}
    seen, gone = set(), set()
    for i, n, norm in sorted(lines):
        g = group[number[norm]]
        if g in seen:
            gone.add((i, n))
        seen.add(g)
    return {i: None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if (i, n) not in gone) for i, text, *_ in rows}, len(links)


def test_lines_equal_brute_force(spark, corpus, monkeypatch):
    monkeypatch.setattr(linededup, "BUCKET", 8)  # so that blocks are used on few rows
    want, links = _brute_lines(corpus)
    found = linededup.dedup_lines(spark.createDataFrame(corpus, DOCS)).collect()
    assert {r["doc_id"]: r["text"] for r in found} == want
    assert links > 20 and sum(r["n_dropped"] for r in found) > 30


def test_lines_move_in_rounds(spark, corpus, monkeypatch):
    """However many lines are near, a round moves a part of the rows and of the characters of all classes, and all rounds together find what one does."""
    monkeypatch.setattr(linededup, "BUCKET", 8)
    monkeypatch.setattr(linededup, "ROWS_A_ROUND", 0.5)
    monkeypatch.setattr(linededup, "CHARS_A_ROUND", 0.25)
    monkeypatch.setattr(linededup, "LEAST_ROWS", 0)
    monkeypatch.setattr(linededup, "LEAST_CHARS", 0)
    searched, judged, mates, links = [], [], linededup._with_mates, linededup._links
    monkeypatch.setattr(linededup, "_with_mates", lambda rows, similarity: searched.append(rows.count()) or mates(rows, similarity))
    monkeypatch.setattr(linededup, "_links", lambda rows, similarity: judged.append(sum(len(r["of"]) for r in rows.select("of").collect())) or links(rows, similarity))
    lines = {linededup.normal(x) for _, t, *_ in corpus for x in (t or "").split("\n")} - {""}
    want, _ = _brute_lines(corpus)
    assert {r["doc_id"]: r["text"] for r in linededup.dedup_lines(spark.createDataFrame(corpus, DOCS)).collect()} == want
    assert len(searched) > 2 and max(searched) < 0.5 * sum(searched) and sum(searched) > len(lines)
    assert len(judged) > 2 and max(judged) < 0.5 * sum(judged) and sum(judged) > 0.5 * sum(map(len, lines))


def test_lines_of_documents_equal_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want, _ = _brute_lines(rows)
    assert {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs).collect()} == want


def test_lines_of_odd_rows(spark):
    line = "these are five plain words"
    rows = [(None, line), (2, line + "\n" + line), (2, line + "\n" + line), (1, "short line\n\nshort line\n"), (4, None), (5, ""), (6, "THESE are,   five plain WORDS!"), (7, "--\n--"), (8, "\n".join(f"{line} and {line}" for _ in range(9)))]
    names = ["doc_id", "row", "r1", "place", "id", "gone", "made", "n", "text", "rest", "n_lines"]
    docs = spark.createDataFrame([(i, *range(k, k + 7), t, f"of {k}", 1) for k, (i, t) in enumerate(rows)], "doc_id long, row int, r1 int, place int, id int, gone int, made int, n int, text string, rest string, n_lines int")
    assert docs.columns[:8] == names[:8]
    for few in (linededup.FEW, 0):  # small tables are broadcast, large ones are not
        with pytest.MonkeyPatch.context() as m:
            m.setattr(linededup, "FEW", few)
            found = linededup.dedup_lines(docs)
            assert found.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
            got = {r["row"]: r for r in found.collect()}
        assert all(r["rest"] == f"of {k}" and (r["r1"], r["place"], r["id"], r["gone"], r["made"], r["n"]) == tuple(range(k + 1, k + 7)) for k, r in got.items())
        want = [("", 1, 1), (line, 2, 1), (line, 2, 1), ("short line\n\n", 4, 1), (None, 0, 0), ("", 0, 0), ("", 1, 1), ("--\n--", 2, 0), (f"{line} and {line}", 9, 8)]
        assert [(got[k]["text"], got[k]["n_lines"], got[k]["n_dropped"]) for k in range(len(rows))] == want
    assert linededup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_recall_of_lines_of_documents(spark, small):
    """Of all pairs of lines of the given documents with the edit similarity, found by edit distance alone, nine in ten are candidates."""
    texts = [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    lines = sorted({linededup.normal(x) for t in texts for x in (t or "").split("\n")} - {""}, key=len)
    made = linededup.Lines(*text_buffers(pa.array(lines)), 0, len(lines))
    blocks, sizes = [set(b) for b in made.blocks().T.tolist()], np.array([len(x) for x in lines])
    letters = np.array([np.bincount([ord(c) % 64 for c in x], minlength=64) for x in lines])
    pairs = []
    for k in range(len(lines)):
        end = int(np.searchsorted(sizes, sizes[k] / linededup.SIMILARITY + 1e-9, "right"))
        near = np.abs(letters[k + 1 : end] - letters[k]).sum(1) <= 2 * (1 - linededup.SIMILARITY) * sizes[k + 1 : end] + 1e-9  # an edit changes two counts at most
        pairs += [(k, j) for j in (np.flatnonzero(near) + k + 1).tolist() if linededup.similar(lines[k], lines[j], linededup.SIMILARITY)]
    found = [blocks[a] & blocks[b] and _near_by_bits(made.simhash, a, b, max(len(lines[a]), len(lines[b]))) for a, b in pairs]
    assert len(pairs) > 20 and np.mean([bool(x) for x in found]) >= 0.9


def test_lines_of_edit_similarity_alone(spark):
    """Of pairs of lines at the edit similarity, by no other rule, nearly all fold, whatever their length and number of changed words."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(4, 9)))
    texts = []
    for n in (8, 10, 20, 30, 60):
        for share in (0.05, 0.1, 0.15, 0.2):
            made = 0
            while made < 20:
                line = [word() for _ in range(n)]
                near = list(line)
                for k in rng.sample(range(n), max(1, round(share * n))):
                    near[k] = word()
                if linededup.similar(" ".join(line), " ".join(near), linededup.SIMILARITY):
                    texts += [" ".join(line), " ".join(near)]
                    made += 1
    found = linededup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    gone = {r["doc_id"] for r in found if r["n_dropped"]}
    assert all(k % 2 for k in gone) and len(gone) >= 0.95 * len(texts) / 2


@pytest.mark.parametrize(("share", "least"), [(0.05, 0.95), (0.1, 0.6), (0.15, 0.15)])
@pytest.mark.parametrize("words", [4, 8, 12, 20, 40, 80])
def test_recall_of_scattered_letters(words, share, least):
    """Pairs at the edit similarity that differ by letters changed, put in or left out anywhere."""
    rng = random.Random(words)
    letters = "etaoinshrdlucmfwyp"
    ones, twos = [], []
    while len(ones) < 200:
        line = " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(words))
        near = list(line)
        for _ in range(max(1, round(share * len(line)))):
            k, kind = rng.randrange(len(near)), rng.randrange(3)
            near[k : k + (kind != 1)] = rng.choice(letters + " ") * (kind != 2)
        near = linededup.normal("".join(near))
        if linededup.similar(line, near, linededup.SIMILARITY):
            ones.append(line)
            twos.append(near)
    made = linededup.Lines(*text_buffers(pa.array(ones + twos)), 0, 400)
    blocks = [set(b) for b in made.blocks().T.tolist()]
    found = [bool(blocks[k] & blocks[k + 200]) and _near_by_bits(made.simhash, k, k + 200, max(len(ones[k]), len(twos[k]))) for k in range(200)]
    assert np.mean(found) >= least


def test_simhash_has_the_bits_of_more_than_half_of_the_runs():
    rng = np.random.default_rng(5)
    counts = np.array([0, 1, 2, 3, 15, 16, 17, 0, 33, 64, 300, 1000, 5, 0])
    hashes, rows = rng.integers(0, 2**64, counts.sum(), dtype=np.uint64), np.repeat(np.arange(len(counts)), counts)
    bits = np.unpackbits(linededup._BITS.view(np.uint8).reshape(-1, 16), axis=1, bitorder="little")[hashes >> np.uint64(51)].astype(int)
    want = [2 * bits[rows == k].sum(0) > n for k, n in enumerate(counts.tolist())]
    found = linededup.Lines._simhash(hashes, rows, len(counts))
    assert (np.unpackbits(found.view(np.uint8), axis=1, bitorder="little").astype(bool) == np.array(want)).all()
    assert not linededup.Lines._simhash(hashes[:0], rows[:0], 3).any()


@pytest.mark.parametrize("most", [2048, 3])
@pytest.mark.parametrize("batch", ["10000", "1", "7"])
def test_blocks_of_the_same_lines_are_one_bucket(spark, monkeypatch, most, batch):
    """No pair of a block is lost, none is made, and blocks that the same lines share are kept once."""
    monkeypatch.setattr(linededup, "BUCKET", most)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    rng = random.Random(9)
    rows = [(block, k, 100 + k % 3) for block in range(1, 9) for k in (1, 2, 3)]  # the same three lines in eight blocks
    rows += [(9, k, 50) for k in range(10, 30)] + [(10, k, length) for k, length in ((1, 101), (40, 60), (41, 300), (42, 310))] + [(11, 43, 10)]
    rows += [(12 + rng.randrange(20), k, 20 + 17 * k) for k in range(50, 90)]
    length = {k: n for _, k, n in rows}
    near = lambda a, b: abs(length[a] - length[b]) <= 0.2 * max(length[a], length[b]) + 1e-9
    pairs = lambda found: {(a, b) for x in found.values() for a, b in combinations(sorted(x), 2) if near(a, b)}
    want, got = {}, {}
    for block, k, n in rows:
        want.setdefault(block, set()).add(k)
    blocks = spark.createDataFrame([(block << 24 | n, k) for block, k, n in rows * 2], "bucket long, id long")
    try:
        found = [tuple(r) for r in linededup._shared(blocks, 0.8).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for bucket, k in found:
        got.setdefault(bucket, set()).add(k)
    assert len(found) == len(set(found)) and pairs(got) == pairs(want)
    assert not {40, 43} & {k for _, k in found}
    assert most < 2048 or len(found) == len({k for _, k in found})


def test_runs_shared_never_rule_out_a_near_pair():
    rng = random.Random(4)
    for _ in range(300):
        a = "".join(rng.choice("abc é") for _ in range(rng.randint(0, 60)))
        b = "".join(rng.choice("abc é") if rng.random() < 0.15 else c for c in a)[rng.randint(0, 2) :]
        d = _distance(a, b)
        assert not linededup.too_far(a, b, d)
    assert linededup.too_far("abcdefghij" * 3, "zyxwvutsrq" * 3, 5)


@pytest.mark.parametrize("held", [1 << 17, 500])
def test_near_pairs_come_a_few_at_a_time(monkeypatch, held):
    """A bucket of near lines is not held as all its pairs, and none is lost."""
    monkeypatch.setattr(linededup, "PAIRS_HELD", held)
    bucket, length = np.repeat([0, 1, 2], [1500, 3, 40]), np.full(1543, 100)
    found = list(linededup._near_pairs(bucket, np.zeros((1543, 3), np.uint64), length, 0.8))
    assert max(len(x) for x, _, _ in found) <= held + 128 * 1500
    pairs = {(a, b) for x, y, _ in found for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    assert len(pairs) == sum(len(x) for x, _, _ in found) == sum(n * (n - 1) // 2 for n in (1500, 3, 40)) and all(a < b and bucket[a] == bucket[b] for a, b in pairs)


def test_candidates_of_common_blocks_are_no_table(spark):
    """Lines near by SimHash of which few are similar: no join makes rows of their pairs, and the groups are those of all pairs."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(6))
    common, texts = [word() for _ in range(14)], []
    for _ in range(160):
        line = [*common[:8], *(word() if rng.random() < 0.5 else w for w in common[8:])]
        texts.append(" ".join(line))
    made, seen = [], spark._jsparkSession.sharedState().statusStore()
    before = seen.executionsCount()
    want, links = _brute_lines([(k, t) for k, t in enumerate(texts)])
    found = linededup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    for k in range(before, seen.executionsCount()):
        run = seen.executionsList(k, 1).apply(0).executionId()
        values, nodes = seen.executionMetrics(run), seen.planGraph(run).allNodes()
        for n in (nodes.apply(i) for i in range(nodes.size())):
            for m in (n.metrics().apply(i) for i in range(n.metrics().size())):
                if "Join" in n.name() and m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    made.append(int(values.apply(m.accumulatorId()).replace(",", "")))
    assert {r["doc_id"]: r["text"] for r in found} == want and links > 500
    assert made and max(made) <= 160 * 2 * linededup.BLOCKS
