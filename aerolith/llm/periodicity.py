"""Periodic runs of words, by longest common extensions over a difference cover.

Of a text's words only the suffixes that start in a difference cover modulo 31
(6 of 31 places) are sorted. Any two places reach a pair of sampled places
after the same number of words, at most 30; these few words are compared, and
beyond them a sparse table of minima over the common prefixes of neighbours in
the sorted order tells the rest. Runs come from harmonic grids: a run of period
q holds grid places kq, (k + 1)q and (k + 2)q, so each q looks at every q-th
place only, n ln n places in all. At the first grid place of a run its words
agree with those a period later for a number of words that is known beforehand;
places where the first few of them differ are left out at once, and texts that
have no place left need no suffixes sorted. The extensions of the others,
forward and backward, give the whole runs. Places of many q are handled
together, a million at a time, so that memory follows the text.

Defined cases: a null text has no words and no run; a stretch counts once, with
its smallest period; rows that repeat, also with the same or without an id, keep
their row each; an empty table has no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .storage import table

#: A run has at least so many words, and so many periods.
LEAST, PERIODS = 24, 3
#: A perfect difference cover, every residue is a difference of two of its members.
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Grid places that are handled together.
PLACES = 1 << 20
#: Texts of up to so many words share one table of grid places.
COMMON = 4096
#: Words that are compared at a grid place before extensions are asked for.
FIRST = 6
DIGEST = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"

_INSIDE = np.isin(np.arange(MODULUS), COVER)


def _reach() -> np.ndarray:
    """For residues i and j the least d with i + d and j + d in the cover."""
    i, j, d = np.ogrid[:MODULUS, :MODULUS, :MODULUS]
    return (_INSIDE[(i + d) % MODULUS] & _INSIDE[(j + d) % MODULUS]).argmax(axis=2)


_REACH = _reach()


def _named(columns: list[np.ndarray]) -> np.ndarray:
    """Numbers of rows, equal for equal rows and in their order, the first column counting most."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        moved = c[order]
        new[1:] |= moved[1:] != moved[:-1]
    names = np.empty(len(order), np.int32)
    names[order] = np.cumsum(new)
    return names


class Extensions:
    """Longest common extensions to the right of pairs of places of a text, given as numbers of its words."""

    def __init__(self, words: np.ndarray):
        self.n = n = len(words)
        self.words = np.concatenate([words.astype(np.int32), np.full(MODULUS, -1, np.int32)])  # an end differs from every word
        places = np.flatnonzero(_INSIDE[np.arange(n + 1) % MODULUS])
        # Blocks of MODULUS words, those of one residue in a row: a suffix of the row is a sampled suffix of the text.
        self.at = at = places[np.lexsort((places, places % MODULUS))]
        names = [_named([self.words[np.minimum(at + k, n)] for k in range(MODULUS)])]
        m = len(at)
        ends = np.flatnonzero(np.append(at[1:] % MODULUS != at[:-1] % MODULUS, True)) if m else np.zeros(0, np.int64)
        stop = ends[np.searchsorted(ends, np.arange(m))]
        while m and names[-1].max() < m - 1:  # until all differ, which they do by where they end
            ahead = np.arange(m) + (1 << (len(names) - 1))
            following = np.where(ahead <= stop, names[-1][np.minimum(ahead, m - 1)], -1)
            names.append(_named([names[-1], following]))
        self.rank = np.zeros(n + 1, np.int32)
        self.rank[at] = names[-1]
        by_rank = np.argsort(names[-1])
        self.minima = [self._of_neighbours(names, by_rank[:-1], by_rank[1:])]
        while (2 << (len(self.minima) - 1)) < m:
            half, before = 1 << (len(self.minima) - 1), self.minima[-1]
            self.minima.append(np.minimum(before[:-half], before[half:]))

    def _of_neighbours(self, names: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common words of neighbouring suffixes: blocks by their names, from the longest span down, then single words.

        Blocks that reach the end of the text are equal to no other, so none leads beyond it.
        """
        x, y, common = x.copy(), y.copy(), np.zeros(len(x), np.int64)
        for level in range(len(names) - 1, -1, -1):
            same = names[level][x] == names[level][y]
            common += same * (MODULUS << level)
            x, y = x + (same << level), y + (same << level)
        return common + self._compared(self.at[x], self.at[y], np.full(len(x), MODULUS))

    def _compared(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Common words at i and j, up to ``limit`` of them, one by one."""
        common, going, k = np.zeros(len(i), np.int64), np.arange(len(i)), 0
        while len(going):
            going = going[(limit[going] > k)]
            going = going[self.words[i[going] + k] == self.words[j[going] + k]]
            k += 1
            common[going] = k
        return common

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For pairs of places i < j <= n how many words from i on equal those from j on."""
        reach = _REACH[i % MODULUS, j % MODULUS]
        out = self._compared(i, j, reach)
        on = np.flatnonzero(out == reach)
        a, b = self.rank[i[on] + reach[on]], self.rank[j[on] + reach[on]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        least = np.empty(len(on), np.int64)
        for l in np.unique(level):
            k = np.flatnonzero(level == l)
            least[k] = np.minimum(self.minima[l][low[k]], self.minima[l][high[k] - (1 << l)])
        out[on] += least
        return out


@lru_cache(1)
def _common_grid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grid places and periods of texts of up to COMMON words, by the last place that they need."""
    place, q = next(_grids(COMMON, COMMON**2))
    last = place + 2 * q
    order = np.argsort(last, kind="stable")
    return place[order], q[order], last[order]


def _grids(n: int, places: int = PLACES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, q) with place a multiple of q and place + 2q < n, in lots of about ``places``."""
    q = np.arange(1, (n - 1) // 2 + 1)
    counts = (n - 1) // q - 1
    edges = np.concatenate([[0], np.cumsum(counts)])
    low = 0
    while low < len(q):
        high = max(low + 1, int(np.searchsorted(edges, edges[low] + places, "right")) - 1)
        own = np.repeat(q[low:high], counts[low:high])
        nth = np.arange(len(own)) - np.repeat(edges[low:high] - edges[low], counts[low:high])
        yield nth * own, own
        low = high


def _likely(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid places that may be the first of a run: the first words of three periods and the next ones of two agree."""
    n = len(words)
    if n <= COMMON:
        place, q, last = _common_grid()
        upto = np.searchsorted(last, n)
        lots = iter([(place[:upto], q[:upto])])
    else:
        lots = _grids(n)
    for place, q in lots:
        keep = words[place] == words[place + q]
        place, q = place[keep], q[keep]
        keep = words[place] == words[place + 2 * q]
        place, q = place[keep], q[keep]
        for k in range(1, FIRST):
            if not len(q):
                break
            needed = k < np.maximum(LEAST, PERIODS * q) - 2 * q + 1
            ahead = np.minimum(place + q + k, n - 1)
            keep = ~needed | ((place + q + k < n) & (words[place + k] == words[ahead]))
            place, q = place[keep], q[keep]
        if len(q):
            yield place, q


def runs_of(words: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period."""
    n = len(words)
    found, right, left = [np.zeros((0, 3), np.int64)], None, None
    if n < LEAST:
        return found[0]
    for place, q in _likely(words):
        if right is None:
            right, left = Extensions(words), Extensions(words[::-1])
        ahead = right.common(place, place + q)
        start = place - left.common(n - place - q, n - place)
        length = place + q + ahead - start
        keep = length >= np.maximum(LEAST, PERIODS * q)
        found.append(np.unique(np.stack([start[keep], length[keep], q[keep]], axis=1), axis=0))
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)  # of one stretch the smallest period
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def numbered(words: list[bytes]) -> np.ndarray:
    """A number for each word, the same for equal ones."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))


def kept_places(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each of n words stays: those in a run after its first period go."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:n]) == 0


def greatest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period, of ties that of the smallest start, then period."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def with_repeats(doc_id: int | None, n: int) -> np.ndarray:
    """The places of the words of a text of n words once a part of some documents, told by their id, is made to repeat."""
    at = np.arange(n)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return at
    g = h // 10
    a = g % n
    at[a:] = a + (at[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return at


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeats: bool = False) -> DataFrame:
    """A row a document: id, runs (start, length, period) of its whole text, and text with the repeats collapsed. No shuffle.

    With ``repeats`` some documents, by their integer id, are first made to repeat themselves.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shape = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, texts, counts = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
                words = (text or b"").split()  # at the same six characters as the pattern
                order = with_repeats(doc_id, len(words)) if repeats else np.arange(len(words))
                runs = runs_of(numbered(words)[order])
                kept = order[kept_places(len(words), runs)] if len(runs) else order
                texts.append(b" ".join(map(words.__getitem__, kept.tolist())) if len(runs) or repeats else b" ".join(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs.tolist()])
                counts.append(len(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(found, shape), pa.array(texts, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs and collapsed texts of documents, as digests."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, runs, collapsed in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                runs = np.array([(r["start"], r["length"], r["period"]) for r in runs], np.int64).reshape(-1, 3)
                start, length, period = greatest(runs) or (None, None, None)
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
                exponent = None if period is None else 1000 * length // period
                rows.append((doc_id, len(runs), start, length, period, exponent, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            kinds = [f.split(" ") for f in DIGEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if kind == "long" else pa.string()) for c, (_, kind) in zip(columns, kinds, strict=True)], [name for name, _ in kinds])

    found = periodic_runs(table(spark, sf_dir, "documents"), repeats=True)
    return found.select("doc_id", "runs", "collapsed").mapInArrow(digest, DIGEST)

