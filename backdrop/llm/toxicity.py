"""Toxicity by a bidirectional gated recurrent network.

A word enters as its own vector (words of the training sample) and as the mean
of the vectors of its character 4-grams (every word). Two gated recurrent
layers read a window of words in either direction, attention pools their
states, and a logistic unit scores the window. All overlapping windows of a
text are scored; the text's score is that of its worst window, calibrated on
the training texts.

The network is trained in numpy on a bounded sample of labelled rows: at most
``TRAIN_ROWS`` of each label, the first by hash of their id, without texts of
over ``TRAIN_BYTES``. Scoring has no such bounds.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from backdrop.llm.common import bounded_batches, documents, fold, texts_of

HELD_OUT_MOD = 5
WINDOW = 32
STRIDE = 16
TRAIN_ROWS = 2000
TRAIN_BYTES = 16 << 10
# Words with a vector of their own and 4-grams that count are those in at
# least this share of the training texts: rarer ones would be learned by heart.
VOCABULARY = 1 << 15
MIN_SHARE = 0.005
MIN_TEXTS = 3
GRAM_BITS = 16
WIDTH = 8
HIDDEN = 8
ATTENTION = 6
EPOCHS = 5
BATCH = 512
# Batches are smaller where a round would have fewer steps.
LEAST_STEPS = 120
RATE = 0.01
SEED = 8
GROUP_CHARS = 1 << 20

_WORD = re.compile(r"[^\W_]+")

Model = dict[str, np.ndarray]


def words_of(text: str) -> list[str]:
    """Words in lower case; a run of one repeated word is read as one."""
    return [w for w, _ in groupby(_WORD.findall(text.lower()))]


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed character 4-grams of words, where those of each word start, and how many it has."""
    data = [f"<{w}>>".encode() for w in words]
    n = np.array([len(d) for d in data]) - 3
    raw = np.frombuffer(b"".join(data) + b"\0\0\0", np.uint8).astype(np.uint32)
    mixed = (raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]) * np.uint32(2654435761) >> np.uint32(32 - GRAM_BITS)
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    first = np.repeat(np.cumsum(n + 3) - n - 3 - starts, n) + np.arange(n.sum())
    return mixed[first], starts, n


def window_rows(counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of each window (-1: none) and the text of each window; a text without words has one empty window."""
    at: list[np.ndarray] = []
    of: list[int] = []
    base = 0
    for i, n in enumerate(counts):
        starts = np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE)
        places = starts[:, None] + np.arange(WINDOW)
        at.append(np.where(places < n, places + base, -1))
        of += [i] * len(starts)
        base += n
    return np.concatenate(at), np.array(of)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _gru(gates: np.ndarray, ids: np.ndarray, u: np.ndarray, backwards: bool, keep: list | None = None) -> np.ndarray:
    """States (time, window, unit) of one direction; ``gates`` has the input part of each word."""
    steps = range(WINDOW - 1, -1, -1) if backwards else range(WINDOW)
    h = np.zeros((len(ids), HIDDEN), np.float32)
    out = np.empty((WINDOW, len(ids), HIDDEN), np.float32)
    for t in steps:
        here = (ids[:, t] >= 0)[:, None].astype(np.float32)
        x, hu = gates[ids[:, t]], h @ u
        zr = _sigmoid(x[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = 2 * _sigmoid(2 * (x[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])) - 1
        new = h + here * z * (c - h)
        if keep is not None:
            keep.append((t, here, h, z, r, c, hu[:, 2 * HIDDEN :]))
        h = out[t] = new
    return out


def _gru_back(keep: list, d_out: np.ndarray, u: np.ndarray, ids: np.ndarray, d_gates: np.ndarray) -> np.ndarray:
    """Gradient of ``u``; adds that of the input part of the gates to ``d_gates``."""
    d_u, carry = np.zeros_like(u), np.zeros_like(d_out[0])
    for t, here, h, z, r, c, hc in reversed(keep):
        d = carry + d_out[t]
        live = d * here
        d_c = live * z * (1 - c * c)
        d_gate = np.concatenate([live * (c - h) * z * (1 - z), d_c * hc * r * (1 - r)], 1)
        d_hu = np.concatenate([d_gate, d_c * r], 1)
        np.add.at(d_gates, ids[:, t], np.concatenate([d_gate, d_c], 1))
        d_u += h.T @ d_hu
        carry = d - live * z + d_hu @ u.T
    return d_u


def _pool(m: Model, states: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    keys = np.tanh(states @ m["key"])
    weight = np.where(ids.T >= 0, keys @ m["query"], -30).astype(np.float32)
    weight = np.exp(weight - weight.max(0))
    weight /= weight.sum(0)
    pooled = np.einsum("tn,tnd->nd", weight, states)
    return keys, weight, pooled, pooled @ m["out"] + m["bias"][0]


def _inputs(m: Model, number: dict[str, int], words: list[str]) -> tuple[np.ndarray, ...]:
    own = np.array([number.get(w, 0) for w in words], np.int64)
    if words:
        grams, starts, n = grams_of(words)
        chars = np.add.reduceat(m["chars"][grams], starts, axis=0) / n[:, None].astype(np.float32)
    else:
        grams = n = np.empty(0, np.int64)
        chars = np.empty((0, WIDTH), np.float32)
    x = np.concatenate([m["words"][own], chars], 1)
    gates = [np.concatenate([x @ m[f"in{d}"] + m[f"gate{d}"], np.zeros((1, 3 * HIDDEN), np.float32)]) for d in "fb"]
    return own, x, grams, n, gates


def window_logits(m: Model, number: dict[str, int], words: list[str], ids: np.ndarray) -> np.ndarray:
    """Logits of windows over distinct ``words``; -1 in ``ids`` stands for no word."""
    *_, gates = _inputs(m, number, words)
    out = []
    for i in range(0, len(ids), 4096):
        part = ids[i : i + 4096]
        states = np.concatenate([_gru(gates[0], part, m["uf"], False), _gru(gates[1], part, m["ub"], True)], 2)
        out.append(_pool(m, states, part)[-1])
    return np.concatenate(out)


def _gradient(m: Model, number: dict[str, int], words: list[str], ids: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Model:
    own, x, grams, n, gates = _inputs(m, number, words)
    keeps: list[list] = [[], []]
    states = np.concatenate([_gru(gates[0], ids, m["uf"], False, keeps[0]), _gru(gates[1], ids, m["ub"], True, keeps[1])], 2)
    keys, weight, pooled, logit = _pool(m, states, ids)
    d_logit = ((_sigmoid(logit) - labels) * weights / weights.sum()).astype(np.float32)
    g = {"out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()], np.float32)}
    d_pooled = d_logit[:, None] * m["out"]
    d_weight = np.einsum("nd,tnd->tn", d_pooled, states)
    d_score = weight * (d_weight - (weight * d_weight).sum(0))
    d_score[ids.T < 0] = 0
    g["query"] = np.einsum("tn,tna->a", d_score, keys)
    d_keys = d_score[:, :, None] * m["query"] * (1 - keys * keys)
    g["key"] = np.einsum("tnd,tna->da", states, d_keys)
    d_states = weight[:, :, None] * d_pooled + d_keys @ m["key"].T
    d_x = np.zeros_like(x)
    for i, d in enumerate("fb"):
        d_gates = np.zeros_like(gates[i])
        g[f"u{d}"] = _gru_back(keeps[i], np.ascontiguousarray(d_states[:, :, i * HIDDEN : (i + 1) * HIDDEN]), m[f"u{d}"], ids, d_gates)
        g[f"in{d}"], g[f"gate{d}"] = x.T @ d_gates[:-1], d_gates[:-1].sum(0)
        d_x += d_gates[:-1] @ m[f"in{d}"].T
    g["words"], g["chars"] = np.zeros_like(m["words"]), np.zeros_like(m["chars"])
    np.add.at(g["words"], own, d_x[:, :WIDTH])
    g["words"][0] = 0  # words without a vector of their own
    np.add.at(g["chars"], grams, np.repeat(d_x[:, WIDTH:] / n[:, None].astype(np.float32), n, axis=0))
    return g


def _distinct(tokens: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, windows over them, and the text of each window."""
    number: dict[str, int] = {}
    flat = np.array([number.setdefault(w, len(number)) for t in tokens for w in t] + [-1], np.int64)
    at, of = window_rows([len(t) for t in tokens])
    return list(number), flat[at], of


def _initial(rng: np.random.Generator, n_words: int) -> Model:
    normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    m = {"words": np.zeros((n_words + 1, WIDTH), np.float32), "chars": normal(1 << GRAM_BITS, WIDTH, scale=0.02),
         "key": normal(2 * HIDDEN, ATTENTION, scale=0.3), "query": normal(ATTENTION, scale=0.3),
         "out": normal(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}
    for d in "fb":
        m[f"in{d}"], m[f"u{d}"] = normal(2 * WIDTH, 3 * HIDDEN, scale=0.3), normal(HIDDEN, 3 * HIDDEN, scale=0.3)
        m[f"gate{d}"] = np.zeros(3 * HIDDEN, np.float32)
    return m


class Network:
    """A trained network with its vocabulary and the calibration of the worst window."""

    def __init__(self, prior: float) -> None:
        self.prior = prior
        self.model: Model | None = None
        self.number: dict[str, int] = {}
        self.slope, self.shift = 1.0, 0.0

    def worst(self, texts: list[str]) -> np.ndarray:
        """Largest window logit of each text."""
        words, ids, of = _distinct([words_of(t) for t in texts])
        logits = window_logits(self.model, self.number, words, ids)
        return np.maximum.reduceat(logits, np.flatnonzero(np.diff(of, prepend=-1)))

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.model is None:
            return np.full(len(texts), self.prior)
        return _sigmoid(self.slope * self.worst(texts).astype(np.float64) + self.shift)


def train(texts: list[str], labels: list[int], toxic_share: float) -> Network:
    """A network from labelled texts; without both labels, the constant ``toxic_share``.

    The first round takes every window of a toxic text for toxic. Later rounds
    keep a half, a quarter, then an eighth of those, the worst by the network
    so far, since most windows of a toxic text are clean. Every fourth text of
    either label only calibrates the score.
    """
    net = Network(toxic_share)
    if len(set(labels)) < 2:
        return net
    rng = np.random.default_rng(SEED)
    y = np.array(labels)
    apart = np.zeros(len(y), bool)
    for label in (0, 1):
        apart[np.flatnonzero(y == label)[3::4]] = True
    if len(set(y[apart])) < 2:
        apart[:] = False
    tokens = [words_of(t) for t, a in zip(texts, apart, strict=True) if not a]
    seen = Counter(w for t in tokens for w in set(t))
    least = max(MIN_TEXTS, round(MIN_SHARE * len(tokens)))
    vocabulary = sorted((w for w, n in seen.items() if n >= least), key=lambda w: (-seen[w], w))[:VOCABULARY]
    net.number = {w: i + 1 for i, w in enumerate(vocabulary)}
    m = net.model = _initial(rng, len(vocabulary))
    live = np.zeros(1 << GRAM_BITS, np.int64)
    for t in tokens:
        if t:
            live[np.unique(grams_of(list(set(t)))[0])] += 1
    live = live >= least
    m["chars"][~live] = 0
    words, ids, of = _distinct(tokens)
    toxic = y[~apart].astype(np.float32)[of]
    first, second = ({k: np.zeros_like(v) for k, v in m.items()} for _ in range(2))
    step = 0
    use = np.arange(len(ids))
    for epoch in range(EPOCHS):
        batch = min(BATCH, max(1, len(use) // LEAST_STEPS))
        for part in np.array_split(rng.permutation(use), max(1, len(use) // batch)):
            held, place = np.unique(ids[part], return_inverse=True)
            held, place = (held[1:], place.reshape(-1, WINDOW) - 1) if held[0] < 0 else (held, place.reshape(-1, WINDOW))
            share = toxic[use].mean()
            weights = np.where(toxic[part] > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
            grad = _gradient(m, net.number, [words[i] for i in held], place, toxic[part], weights)
            grad["chars"][~live] = 0
            step += 1
            for k, g in grad.items():  # Adam
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                m[k] -= RATE * (1 - epoch / EPOCHS) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
        logits = window_logits(m, net.number, words, ids)
        rank = np.lexsort((-logits, of))
        place_in_text = np.empty(len(of), np.int64)
        place_in_text[rank] = np.arange(len(of)) - np.flatnonzero(np.diff(of, prepend=-1))[of[rank]]
        of_text = np.bincount(of)[of]
        use = np.flatnonzero((toxic == 0) | (place_in_text < np.maximum(1, of_text >> min(epoch + 1, 3))))
    judged = apart if apart.any() else ~apart
    worst = net.worst([t for t, j in zip(texts, judged, strict=True) if j]).astype(np.float64)
    net.slope, net.shift = _calibrate(worst, y[judged].astype(np.float64), toxic_share)
    return net


def _calibrate(x: np.ndarray, y: np.ndarray, toxic_share: float) -> tuple[float, float]:
    """Slope and shift of a logistic curve, each label weighed by its share among all labelled rows."""
    share = min(0.99, max(0.01, toxic_share))
    w = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    scale, middle = x.std() + 1e-6, x.mean()
    z = np.stack([(x - middle) / scale, np.ones_like(x)], 1)
    beta = np.zeros(2)
    for _ in range(25):  # Newton steps with a small ridge, since the labels may be separable
        p = _sigmoid(z @ beta)
        hess = (z * (w * p * (1 - p))[:, None]).T @ z + np.eye(2) * 0.02 * len(x) / 100
        beta += np.linalg.solve(hess, z.T @ (w * (y - p)) - 0.02 * len(x) / 100 * beta)
    return beta[0] / scale, beta[1] - beta[0] * middle / scale


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic",
          held_out_mod: int = HELD_OUT_MOD) -> Network:
    """A network from the labelled rows of ``docs`` that are not held out.

    Of several labels for an id the worst counts; NULL labels, ids and texts
    teach nothing. At most ``2 * TRAIN_ROWS`` texts of at most ``TRAIN_BYTES``
    reach the driver.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(toxic_col).cast("int").alias("toxic")).where(
        (F.col("id").isNotNull()) & F.col("toxic").isin(0, 1) & (fold(F.col("id"), held_out_mod) != 0))
    marked = marked.groupBy("id").agg(F.max("toxic").alias("toxic"))
    share = marked.agg(F.avg("toxic")).first()[0]
    first = lambda y: marked.where(F.col("toxic") == y).orderBy(F.xxhash64("id"), "id").limit(TRAIN_ROWS)
    sample = F.broadcast(first(0).unionByName(first(1)))  # at most 2 * TRAIN_ROWS rows
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.octet_length("text") <= TRAIN_BYTES)
    # Rows that repeat an id would grow the sample, so it is bounded once more.
    rows = rows.join(sample, "id").orderBy(F.xxhash64("id"), "id", "text").limit(2 * TRAIN_ROWS)
    found = rows.select("text", "toxic").toPandas()
    return train(found["text"].tolist(), found["toxic"].tolist(), float(share or 0.0))


def _score(net: Network, text_at: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, scores, start, held = texts_of(b.column(text_at)), [], 0, 0
            for i, t in enumerate(texts):
                if i > start and held + len(t) > GROUP_CHARS:
                    scores.append(net.scores(texts[start:i]))
                    start, held = i, 0
                held += len(t)
            scores.append(net.scores(texts[start:]) if texts else np.empty(0))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(scores), pa.float64())],
                                             names=[*b.schema.names, "score"])

    return run


def score_rows(rows: DataFrame, net: Network, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of ``rows`` and their score, 0 to 1, in a last column.

    A NULL or empty text, or one without words, is scored as an empty window.
    Repeated rows are scored each and alike. ``score_col`` must not be a column of ``rows``.
    """
    bounded_batches(rows.sparkSession)
    names = [f"c{i}" for i in range(len(rows.columns))]
    plain = rows.toDF(*names)
    schema = StructType([*plain.schema.fields, StructField("score", DoubleType())])
    made = plain.mapInArrow(_score(net, rows.columns.index(text_col)), schema)
    return made.toDF(*rows.columns, score_col)


def op8_bigru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from ``labels``."""
    docs = documents(spark, sf_dir)
    net = learn(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    rows = docs.select("doc_id", (fold(F.col("doc_id"), HELD_OUT_MOD) == 0).alias("held_out"), "text")
    return score_rows(rows, net).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
