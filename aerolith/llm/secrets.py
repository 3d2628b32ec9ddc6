"""Secret scans: fixed patterns and a linear-chain conditional random field.

The field tags each token of a text as the begin of a secret, inside one or
outside, from the token's shape, the words around it and features of the whole
text, and is decoded by Viterbi. It is trained on windows of a bounded
sample: around the patterns' matches, and in texts without one at random tokens
and at the longest. So that it does not only learn the patterns again, each
match also stands in the sample with the words around it hidden, with the shape
of another random value in place of its own, and with both, so that context and
shape carry the label each by itself; and ``PLAIN_WINDOWS`` times with a plain
word, a number or a short name in its place, which is no secret. The field adds spans of kind ``crf`` where
it sees a secret that no pattern matched; the patterns' spans always stay.

Defined cases: a null or empty text has no spans, and its digest is that of an
empty string; rows that repeat keep their row each; with no match in the
sample there is no field, and only the patterns are used; texts of any length
are read whole. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import table
from .textarrays import _LOWER, slices, span_hashes, text_buffers

# The patterns of the base scan. A run too short to count holds no
# longer one, so the least lengths of access and hex are part of their patterns;
# assign's is not, as a match that fails still takes its characters.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}", re.A)
HEX = re.compile(r"[0-9a-f]{24,}", re.A)
KINDS = ("assign", "access", "hex", "crf")
#: A text with a match of a base pattern matches this.
ANY = r"""(?i:password|passwd|secret|token|api_?key)["']? *[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""

O, B, I = 0, 1, 2
SPAN, LEXICON, SHAPES, FILES = 21, 4096, 6 * 32, 16
#: Bounds of the training sample: rows, windows.
SAMPLE_ROWS, SAMPLE_WINDOWS = 20_000, 4_000

_KIND = np.zeros(256, np.uint8)  # 0 blank, 1 delimiter, 2 core
_KIND[33:] = 2
_KIND[[ord(c) for c in "\"'=:,;()[]{}<>|`"]] = 1
_KIND[:9] = _KIND[14:32] = 2
_BITS = np.full(256, 16 | 8, np.uint8)
_BITS[48:58] = 1
_BITS[65:91] = 2 | 8
_BITS[97:103] = 4
_BITS[103:123] = 4 | 8
_LENGTHS = np.array([2, 4, 8, 16, 24])
#: Shapes of plain words, of numbers, and of names of a few letters and digits.
PLAIN = tuple(32 * size + bits for size in (1, 2, 3) for bits in (4 | 8, 2 | 4 | 8, 1, 4, 2 | 8)) + tuple(32 * size + bits for size in (0, 1) for bits in (1, 4 | 8, 1 | 4 | 8, 1 | 4))
PLAIN_WINDOWS = 4
#: Shapes of random values of 16 bytes and of 24 or more: lower, upper or both cases with digits, and hexadecimal.
VALUES = tuple(32 * size + bits for size in (4, 5) for bits in (1 | 4 | 8, 1 | 2 | 8, 1 | 2 | 4 | 8, 1 | 4))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, in code points, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), kind, m.end()) for kind, pattern in ((1, ACCESS), (2, HEX)) for m in pattern.finditer(text)]
    return sorted(found)


def _secret_parts(text: str) -> list[tuple[int, int]]:
    """The secrets themselves within the base matches."""
    found = [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    return found + [m.span() for pattern in (ACCESS, HEX) for m in pattern.finditer(text)]


class Tokens:
    """Tokens of rows lo..hi (runs of core or of delimiter bytes) and the index of each of their seven features."""

    def __init__(self, raw: np.ndarray, ends: np.ndarray, lo: int, hi: int):
        first = ends[lo]
        data = raw[first : ends[hi]]
        edges = ends[lo : hi + 1] - first
        kind = _KIND[data]
        change = np.ones(len(data) + 1, bool)
        change[1:-1] = kind[1:] != kind[:-1]
        change[edges] = True
        at = np.flatnonzero(change)
        starts, stops = at[:-1], at[1:]
        full = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
        self.starts, self.stops = starts[full], stops[full]
        self.core = kind[self.starts] == 2
        self.edges = edges
        self.bounds = np.searchsorted(self.starts, edges)
        n = len(self.starts)
        bits = np.zeros(n, np.uint8)
        if n:
            pairs = np.empty(2 * n, np.int64)
            pairs[0::2], pairs[1::2] = self.starts, self.stops
            bits = np.bitwise_or.reduceat(np.append(_BITS[data], np.uint8(0)), pairs)[::2]
        shape = np.searchsorted(_LENGTHS, self.stops - self.starts, "right") * 32 + bits
        words = (span_hashes(_LOWER[data], self.starts, self.stops) >> np.uint64(52)).astype(np.int64)
        counts = np.diff(self.bounds)
        rows = np.repeat(np.arange(len(counts)), counts)
        signs = np.concatenate([[0], np.cumsum(data == 61)])
        share = 1000 * (signs[edges[1:]] - signs[edges[:-1]]) / np.maximum(counts, 1)
        digits = np.concatenate([[0], np.cumsum(bits & 1)])
        numeric = 100 * (digits[self.bounds[1:]] - digits[self.bounds[:-1]]) / np.maximum(counts, 1)
        files = np.searchsorted([0.5, 5, 50], share) * 4 + np.searchsorted([0.5, 5, 30], numeric)

        def shifted(x: np.ndarray, by: int, missing: int) -> np.ndarray:
            out = np.full(n, missing)
            if n > abs(by):
                if by > 0:
                    same = rows[by:] == rows[:-by]
                    out[by:][same] = x[:-by][same]
                else:
                    same = rows[-by:] == rows[:by]
                    out[:by][same] = x[-by:][same]
            return out

        self.features = [shape, shifted(shape, 1, SHAPES), shifted(shape, -1, SHAPES), shifted(words, 1, LEXICON), shifted(words, 2, LEXICON), shifted(words, -1, LEXICON), files[rows] if n else np.zeros(0, np.int64)]


SIZES = [SHAPES + 1] * 3 + [LEXICON + 1] * 3 + [FILES]


class Field:
    """Weights of the field: a table for each feature, and transitions."""

    def __init__(self, tables: list[np.ndarray], moves: np.ndarray):
        self.tables, self.moves = [t.astype(np.float32) for t in tables], moves.astype(np.float32)
        m = self.moves
        # What putting O in place of B or I at one token can cost in transitions, at most.
        self.slack = float(max(m[p, s] + m[s, q] - m[p, O] - m[O, q] for p in range(3) for q in range(3) for s in (B, I)))

    def emissions(self, features: list[np.ndarray]) -> np.ndarray:
        out = self.tables[0][features[0]]
        for t, f in zip(self.tables[1:], features[1:], strict=True):
            out += t[f]
        return out

    def decode(self, tokens: Tokens) -> np.ndarray:
        """The best labels of every text's tokens.

        Where O beats B and I by more than transitions can give back, every best
        path is at O, so that texts fall apart there; Viterbi runs over the rest.
        """
        e = self.emissions(tokens.features)
        labels = np.zeros(len(e), np.int8)
        if not len(e):
            return labels
        open_ = e[:, O] - np.maximum(e[:, B], e[:, I]) <= max(0.0, self.slack)
        inner = np.zeros(len(e) + 1, bool)  # a break before this token
        inner[tokens.bounds] = True
        inner[1:-1] |= open_[1:] != open_[:-1]
        inner[0] = inner[-1] = True
        at = np.flatnonzero(inner)
        a, b = at[:-1], at[1:]
        keep = open_[a]
        a, b = a[keep], b[keep]
        left = np.isin(a, tokens.bounds)  # a text's first token has no transition before it
        right = np.isin(b, tokens.bounds)
        lengths = b - a
        for n in np.unique(lengths):
            which = np.flatnonzero(lengths == n)
            seg = e[a[which][:, None] + np.arange(n)]
            score = seg[:, 0] + np.where(left[which][:, None], 0, self.moves[O])
            back = np.zeros((n, len(which), 3), np.int8)
            for t in range(1, n):
                total = score[:, :, None] + self.moves
                back[t] = total.argmax(1)
                score = total.max(1) + seg[:, t]
            score = score + np.where(right[which][:, None], 0, self.moves[:, O])
            state = score.argmax(1)
            for t in range(n - 1, -1, -1):
                labels[a[which] + t] = state
                state = back[t][np.arange(len(which)), state]
        return labels


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def train(features: np.ndarray, labels: np.ndarray, lengths: np.ndarray, steps: int = 140, rate: float = 0.15, decay: float = 2e-4) -> Field:
    """Maximum likelihood by Adam; features (7, n, SPAN), labels (n, SPAN), lengths (n,)."""
    n = len(labels)
    tables, moves = [np.zeros((s, 3)) for s in SIZES], np.zeros((3, 3))
    real = np.arange(SPAN)[None] < lengths[:, None]
    gold = np.zeros((n, SPAN, 3))
    np.put_along_axis(gold, labels[:, :, None].astype(np.int64), 1.0, 2)
    gold *= real[:, :, None]
    gold_moves = np.zeros((3, 3))
    np.add.at(gold_moves, (labels[:, :-1][real[:, 1:]], labels[:, 1:][real[:, 1:]]), 1.0)
    memory = [[np.zeros_like(p), np.zeros_like(p)] for p in (*tables, moves)]
    for step in range(1, steps + 1):
        e = sum(t[f] for t, f in zip(tables, features, strict=True))
        forward, backward = np.zeros((SPAN, n, 3)), np.zeros((SPAN, n, 3))
        forward[0] = e[:, 0]
        for t in range(1, SPAN):
            reached = _log_sum(forward[t - 1][:, :, None] + moves, 1) + e[:, t]
            forward[t] = np.where(real[:, t, None], reached, forward[t - 1])
        for t in range(SPAN - 2, -1, -1):
            left = _log_sum(moves + (e[:, t + 1] + backward[t + 1])[:, None], 2)
            backward[t] = np.where(real[:, t + 1, None], left, 0)
        z = _log_sum(forward[-1], 1)
        share = np.exp(forward + backward - z[None, :, None]).transpose(1, 0, 2) * real[:, :, None]
        expected = np.zeros((3, 3))
        for t in range(1, SPAN):
            pair = np.exp(forward[t - 1][:, :, None] + moves + (e[:, t] + backward[t])[:, None] - z[:, None, None])
            expected += pair[real[:, t]].sum(0)
        rest = (gold - share).reshape(-1, 3)
        slopes = [np.stack([np.bincount(f.reshape(-1), rest[:, k], s) for k in range(3)], 1) for f, s in zip(features, SIZES, strict=True)]
        for p, g, (m, v) in zip((*tables, moves), (*slopes, gold_moves - expected), memory, strict=True):
            g = g / n - decay * p
            m += 0.1 * (g - m)
            v += 0.1 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.9**step)) + 1e-8)
    return Field(tables, moves)


def _windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Training windows: around each match, and one in each text without; columns has, key, length, values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = text_buffers(batch.column(1))
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = {"has": [], "key": [], "length": [], "values": []}
            for lo, hi in slices(ends):
                tokens = Tokens(raw, ends, lo, hi)
                stacked = np.stack(tokens.features)
                for r in range(lo, hi):
                    a, b = tokens.bounds[r - lo], tokens.bounds[r - lo + 1]
                    if a == b:
                        continue
                    text, labels = texts[r] or "", np.zeros(b - a, np.int64)
                    base, centres = tokens.edges[r - lo], []
                    parts = sorted(_secret_parts(text))
                    place = np.append(np.flatnonzero((raw[ends[r] : ends[r + 1]] & 0xC0) != 0x80), ends[r + 1] - ends[r]) if parts else None
                    for start, stop in parts:
                        s, e = base + place[start], base + place[stop]
                        i, j = np.searchsorted(tokens.stops[a:b], s, "right"), np.searchsorted(tokens.starts[a:b], e)
                        if labels[i:j].any():
                            continue
                        labels[i:j] = I
                        labels[i] = B
                        centres.append(int(i))
                    longest = a + int(np.argmax(tokens.stops[a:b] - tokens.starts[a:b]))
                    for c in centres or ([abs(keys[r] or 0) % (b - a)] if (keys[r] or 0) % 2 else [longest - a]):
                        lo_, hi_ = max(0, c - SPAN // 2), min(b - a, c - SPAN // 2 + SPAN)
                        values = np.zeros((8, SPAN), np.int32)
                        values[:7, : hi_ - lo_] = stacked[:, a + lo_ : a + hi_]
                        values[7, : hi_ - lo_] = labels[lo_:hi_]
                        for name, v in (("has", bool(centres)), ("key", keys[r]), ("length", hi_ - lo_), ("values", values.reshape(-1).tolist())):
                            out[name].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out["has"], pa.bool_()), pa.array(out["key"], pa.int64()), pa.array(out["length"], pa.int32()), pa.array(out["values"], pa.list_(pa.int32()))], list(out))

    return docs.select(F.xxhash64(F.col(id_col)).alias("key"), text_col).mapInArrow(run, "has boolean, key long, length int, values array<int>")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS, sample_windows: int = SAMPLE_WINDOWS) -> Field | None:
    """A field trained on a sample of at most about ``sample_rows`` rows and ``sample_windows`` windows; None if no pattern matches there."""
    total = docs.count()
    if not total:
        return None
    share = min(1.0, sample_rows / total)
    sample = docs.filter(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_000)) < int(1_000_000 * share))
    found = _windows(sample, id_col, text_col)
    # Each match makes several windows; these fill half of the sample's bound at most.
    has = found.filter("has").orderBy("key", "values").limit(sample_windows // (2 * (4 + PLAIN_WINDOWS))).collect()
    if not has:
        return None
    rows = has + found.filter("NOT has").orderBy("key", "values").limit(sample_windows // 2).collect()
    values = np.array([r["values"] for r in rows]).reshape(len(rows), 8, SPAN)
    lengths = np.array([r["length"] for r in rows])
    values, lengths = np.concatenate([values, *masked(values[: len(has)])]), np.concatenate([lengths, *[lengths[: len(has)]] * (3 + PLAIN_WINDOWS)])
    return train(values[:, :7].transpose(1, 0, 2), values[:, 7], lengths)


def masked(values: np.ndarray) -> list[np.ndarray]:
    """Windows (n, 8, SPAN) with words hidden, with the shapes of secrets replaced by those of other random values, with both, and with plain words in place of secrets, every other one with the words around hidden."""
    row, at = np.nonzero((values[:, 7] != O) & (values[:, 0] >= 32 * 3))  # not the delimiters and short parts of a secret

    def replaced(shapes: tuple[int, ...], turn: int) -> np.ndarray:
        made, new = values.copy(), np.array(shapes)[(row * 5 + at + turn * 7) % len(shapes)]
        made[row, 0, at] = new
        made[row[at > 0], 2, at[at > 0] - 1] = new[at > 0]
        inner = at < SPAN - 1
        made[row[inner], 1, at[inner] + 1] = new[inner]
        return made

    shaped, plain = replaced(VALUES, 0), [replaced(PLAIN, k) for k in range(PLAIN_WINDOWS)]
    out = [values.copy(), shaped, shaped.copy(), *plain]
    for made in (out[0], out[2], *plain[::2]):
        made[:, 3:6] = LEXICON
    for made in plain:
        made[:, 7] = O
    return out


def scan(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): for every row an array of (kind, start, end), in code points, in order. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(field)  # fixed in size
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            column = batch.column(1)
            raw, ends = text_buffers(column)
            may = pc.match_substring_regex(column, ANY).fill_null(False).to_numpy(zero_copy_only=False)
            base = {int(r): base_spans(column[int(r)].as_py()) for r in np.flatnonzero(may)}
            added: dict[int, list] = {}
            for lo, hi in slices(ends) if model else ():
                tokens = Tokens(raw, ends, lo, hi)
                labels = model.decode(tokens)
                hit = np.flatnonzero((labels > 0) & tokens.core)
                for r in np.unique(np.searchsorted(tokens.bounds, hit, "right") - 1):
                    row = int(lo + r)
                    added[row] = _new_spans(tokens, labels, int(r), bytes(raw[ends[row] : ends[row + 1]]), base.get(row, []))
            out = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(base.get(r, []) + added.get(r, []))] if r in base or r in added else [] for r in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, spans)], ["doc_id", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def _new_spans(tokens: Tokens, labels: np.ndarray, r: int, raw: bytes, base: list) -> list[tuple[int, int, int]]:
    """Runs of B I* in row r, from its first to its last core token, that touch no base span."""
    a, b = int(tokens.bounds[r]), int(tokens.bounds[r + 1])
    out, run = [], []
    chars = np.append(0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
    for i in [*range(a, b), -1]:
        label = labels[i] if i >= 0 else O
        if run and (label != I or i < 0):
            core = [j for j in run if tokens.core[j]]
            if core:
                s, e = (int(chars[x - tokens.edges[r]]) for x in (tokens.starts[core[0]], tokens.stops[core[-1]]))
                if not any(s < q and p < e for p, _, q in base):
                    out.append((s, 3, e))
            run = []
        if label != O and i >= 0:
            run.append(i)
    return out


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, fit(docs))
    joined = lambda keep: F.array_join(F.transform(F.filter("spans", keep), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS),
        F.sha2(joined(lambda s: s["kind"] != "crf"), 256).alias("base_sha256"),
        joined(lambda s: F.lit(True)).alias("spans"),
    )
