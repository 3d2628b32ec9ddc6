"""Language identification by a bidirectional gated recurrent network over bytes.

Every byte of a text gets a label: two gated recurrent layers read it from the
left and from the right, and a softmax over the languages follows at each
position. A document's probabilities are the mean over all its positions. The
network reads a text in runs of ``RUN`` bytes, the last one shorter, so that
runs of many texts advance together; every byte of the whole text is read.
It is trained in numpy by backpropagation through time on runs from a bounded
sample of labelled rows.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text if no row to learn from has a letter. Ties go to the first
language in order. Rows that repeat keep their row each. Other columns are not
read in predicting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import table
from .textarrays import slices, text_buffers

RUN, UNITS = 64, 8
#: Bounds of the training sample: rows a language, rows of all languages (but 8 of each), runs of a row.
SAMPLE_ROWS, SAMPLE_TOTAL, ROW_RUNS = 400, 25_600, 6
_LANES = 4096


class Network:
    """Weights: inputs (2, 3, U, 256), states (2, 3, U, U), out (K, 2U), out_bias (K, 1); both directions lie side by side."""

    NAMES = ("inputs", "states", "out", "out_bias")

    def __init__(self, languages: list[str], units: int = UNITS, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.languages = languages
        self.inputs = draw.normal(0, 0.3, (2, 3 * units, 256)).astype(np.float32)
        self.states = draw.normal(0, 1 / np.sqrt(units), (2, 3 * units, units)).astype(np.float32)
        self.out = draw.normal(0, 0.1, (len(languages), 2 * units)).astype(np.float32)
        self.out_bias = np.zeros((len(languages), 1), np.float32)
        self.units = units

    def parameters(self) -> list[np.ndarray]:
        return [getattr(self, n) for n in self.NAMES]

    def forward(self, codes: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """Hidden states (T, 2, U, n) of runs codes (T, n); direction 1 reads from the right, and its state t is that of position t."""
        steps, n = codes.shape
        u = self.units
        hidden = np.empty((steps, 2, u, n), np.float32)
        state = np.zeros((2, u, n), np.float32)
        given = np.empty((2, 3 * u, n), np.float32)
        drive = np.empty((2, 3 * u, n), np.float32)
        gates = np.empty((2, 2 * u, n), np.float32)
        fresh = np.empty((2, u, n), np.float32)
        if kept is not None:
            kept.update(z=[], r=[], c=[], pull=[], state=[])
        for t in range(steps):
            np.take(self.inputs[0], codes[t], axis=1, out=given[0], mode="clip")
            np.take(self.inputs[1], codes[steps - 1 - t], axis=1, out=given[1], mode="clip")
            np.matmul(self.states, state, out=drive)
            np.add(given[:, : 2 * u], drive[:, : 2 * u], out=gates)
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5  # the logistic function
            z, r = gates[:, :u], gates[:, u:]
            pull = drive[:, 2 * u :]
            np.multiply(r, pull, out=fresh)
            fresh += given[:, 2 * u :]
            np.tanh(fresh, out=fresh)
            if kept is not None:
                for name, value in (("z", z), ("r", r), ("c", fresh), ("pull", pull), ("state", state)):
                    kept[name].append(value.copy())
            state = state - fresh
            state *= z
            state += fresh
            hidden[t, 0], hidden[steps - 1 - t, 1] = state[0], state[1]
        return hidden

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Label probabilities (K, T, n) at every position."""
        steps, n = codes.shape
        hidden = self.forward(codes)
        scores = np.matmul(self.out, hidden.reshape(steps, 2 * self.units, n)) + self.out_bias
        scores -= scores.max(1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(1, keepdims=True)
        return scores.transpose(1, 0, 2)


def gradients(net: Network, codes: np.ndarray, labels: np.ndarray, real: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over the real positions and its slopes, by backpropagation through time."""
    steps, n = codes.shape
    u = net.units
    kept: dict = {}
    hidden = net.forward(codes, kept).reshape(steps, 2 * u, n)
    scores = np.matmul(net.out, hidden) + net.out_bias
    scores -= scores.max(1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(1, keepdims=True)
    count = real.sum()
    picked = scores[:, labels, np.arange(n)]
    loss = float(-(np.log(picked + 1e-9) * real).sum() / count)
    slope = scores
    slope[:, labels, np.arange(n)] -= 1
    slope *= (real / count)[:, None]
    d_out = np.einsum("tkn,tun->ku", slope, hidden)
    d_bias = slope.sum((0, 2))[:, None]
    d_hidden = np.matmul(net.out.T, slope).reshape(steps, 2, u, n)
    d_inputs, d_states = np.zeros_like(net.inputs), np.zeros_like(net.states)
    carry = np.zeros((2, u, n), np.float32)
    one_hot_at = np.arange(n)
    for t in range(steps - 1, -1, -1):
        z, r, c, pull, state = (kept[k][t] for k in ("z", "r", "c", "pull", "state"))
        carry = carry + np.stack([d_hidden[t, 0], d_hidden[steps - 1 - t, 1]])
        d_c = carry * (1 - z) * (1 - c * c)
        d_z = carry * (state - c) * z * (1 - z)
        d_r = d_c * pull * r * (1 - r)
        d_given = np.concatenate([d_z, d_r, d_c], 1)
        d_drive = np.concatenate([d_z, d_r, d_c * r], 1)
        d_states += np.matmul(d_drive, state.transpose(0, 2, 1))
        for way, at in ((0, t), (1, steps - 1 - t)):
            hot = np.zeros((n, 256), np.float32)
            hot[one_hot_at, codes[at]] = 1
            d_inputs[way] += d_given[way] @ hot
        carry = carry * z + np.matmul(net.states.transpose(0, 2, 1), d_drive)
    return loss, [d_inputs, d_states, d_out, d_bias]


def train(runs: np.ndarray, lengths: np.ndarray, labels: np.ndarray, languages: list[str], passes: int = 12, lot: int = 256, rate: float = 0.02, seed: int = 7) -> Network:
    """A network trained with Adam on runs (n, RUN) of the given lengths and label numbers."""
    net, draw = Network(languages, seed=seed), np.random.default_rng(seed)
    memory = [[np.zeros_like(p), np.zeros_like(p)] for p in net.parameters()]
    step, total = 0, passes * -(-len(runs) // lot)
    for _ in range(passes):
        order = draw.permutation(len(runs))
        for at in range(0, len(order), lot):
            which = order[at : at + lot]
            real = (np.arange(runs.shape[1])[:, None] < lengths[which]).astype(np.float32)
            _, slopes = gradients(net, runs[which].T, labels[which], real)
            size = np.sqrt(sum(float((g * g).sum()) for g in slopes))
            step += 1
            pace = rate * (1 - 0.9 * step / total)
            for p, g, (m, v) in zip(net.parameters(), slopes, memory, strict=True):
                g = g * min(1.0, 1.0 / (size + 1e-9))
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def held_out(docs: DataFrame) -> F.Column:
    """True for rows that are never learnt from."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS, sample_total: int = SAMPLE_TOTAL, row_runs: int = ROW_RUNS) -> Network | None:
    """A network for all languages of ``labelled``.

    It learns from about ``sample_rows`` rows of each, fewer where there are so
    many languages that ``sample_total`` would be passed, chosen by a hash of key
    and text, and from ``row_runs`` runs of each row. None if no such row has a letter.
    """
    counts = labelled.filter(F.col(lang_col).isNotNull()).groupBy(lang_col).count().collect()  # a row a language
    if not counts:
        return None
    sample_rows = max(8, min(sample_rows, sample_total // len(counts)))
    names = sorted(r[lang_col] for r in counts)
    shares = {r[lang_col]: min(1.0, 1.25 * sample_rows / r["count"]) for r in counts}
    limit = F.create_map(*(F.lit(x) for n in names for x in (n, int(shares[n] * 1_000_000))))
    keyed = labelled.filter(F.pmod(F.xxhash64(F.col(key_col)), F.lit(1_000_000)) < limit[F.col(lang_col)])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"lang": [], "key": [], "run": []}
            letters = has_letter(batch.column(2))
            raw, ends = text_buffers(batch.column(2))
            for i, (lang, key) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if not letters[i]:
                    continue
                size = int(ends[i + 1] - ends[i])
                starts = range(0, size, RUN)
                draw = np.random.default_rng(key & 0xFFFFFFFF)
                for s in sorted(draw.choice(len(starts), min(row_runs, len(starts)), replace=False)):
                    a = int(ends[i]) + starts[int(s)]
                    out["lang"].append(lang)
                    out["key"].append(key)
                    out["run"].append(raw[a : min(a + RUN, int(ends[i + 1]))].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out["lang"], pa.string()), pa.array(out["key"], pa.int64()), pa.array(out["run"], pa.binary())], list(out))

    picked = keyed.select(lang_col, F.xxhash64(F.col(key_col), F.col(text_col)).alias("key"), text_col).mapInArrow(runs, "lang string, key long, run binary")
    rows = picked.orderBy("key", "run").limit(len(names) * 2 * sample_rows * row_runs).collect()
    if not rows:
        return None
    number = {n: k for k, n in enumerate(names)}
    data, lengths = np.zeros((len(rows), RUN), np.uint8), np.array([len(r["run"]) for r in rows])
    for i, r in enumerate(rows):
        data[i, : lengths[i]] = np.frombuffer(r["run"], np.uint8)
    # Equal weight for each language: rows of rare ones are repeated.
    labels = np.array([number[r["lang"]] for r in rows])
    most = np.bincount(labels, minlength=len(names)).max()
    even = np.concatenate([np.resize(np.flatnonzero(labels == k), most) for k in range(len(names)) if (labels == k).any()])
    return train(data[even], lengths[even], labels[even], names)


def has_letter(texts: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(texts, r"\pL").fill_null(False).to_numpy(zero_copy_only=False)


def pooled(net: Network, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The mean label probabilities (rows, K) over every byte of each text."""
    sizes = np.diff(ends)
    counts = -(-sizes // RUN)
    first = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(sizes)), counts)
    starts = ends[:-1][owner] + RUN * (np.arange(first[-1]) - first[owner])
    lengths = np.minimum(RUN, ends[1:][owner] - starts)
    sums = np.zeros((len(sizes), len(net.languages)))
    full = np.flatnonzero(lengths == RUN)
    rest = np.flatnonzero(lengths < RUN)
    lots = [(full[a : a + _LANES], RUN) for a in range(0, len(full), _LANES)]
    # A text's last run advances with others of just its length.
    rest = rest[np.argsort(lengths[rest], kind="stable")]
    edges = np.flatnonzero(np.diff(lengths[rest])) + 1
    lots += [(which, int(lengths[which[0]])) for which in np.split(rest, edges) if len(which)]
    for which, n in lots:
        codes = raw[starts[which] + np.arange(n)[:, None]]
        given = net.probabilities(codes).sum(1)
        for k in range(len(net.languages)):
            sums[:, k] += np.bincount(owner[which], given[k], len(sizes))
    return sums / np.maximum(sizes, 1)[:, None]


def best_language(texts: pa.Array, model: Network | None) -> tuple[np.ndarray, np.ndarray]:
    """The language and score of each of an array of texts, about 4 MB of them at once."""
    names, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
    known = has_letter(texts)
    if model is not None and known.any():
        raw, ends = text_buffers(texts)
        for lo, hi in slices(ends, 4 << 20):
            means = pooled(model, raw, ends[lo : hi + 1])
            best = means.argmax(1)
            here = known[lo:hi]
            names[lo:hi][here] = np.array(model.languages, object)[best[here]]
            scores[lo:hi][here] = np.clip(means[np.arange(hi - lo), best], 0, 1)[here]
    return names, scores


def predict(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row's whole text. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # fixed in size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = best_language(batch.column(1), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def least_score(net: Network | None, margin: float) -> float:
    """The mean probability that lies ``margin`` of the way from chance, one in so many languages, to certainty."""
    chance = 1 / len(net.languages) if net else 1.0
    return min(chance + margin * (1 - chance), 0.999)


def recognised(docs: DataFrame, net: Network | None, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose text is in some language by a score of ``least_score`` or more. No shuffle."""
    shared, at = docs.sparkSession.sparkContext.broadcast(net), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = best_language(batch.column(at), shared.value)
            yield batch.filter(pa.array((names != "und") & (scores >= least_score)))

    return docs.mapInArrow(run, docs.schema)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = fit(docs.filter(~held_out(docs)))
    found = predict(docs, net)
    return found.select("doc_id", held_out(found).alias("held_out"), "lang_pred", "score")
