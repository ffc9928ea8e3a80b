"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages, and only the document has a label. Each passage is encoded from
the mean of learned embeddings of its words, their shapes and how they repeat. Gated attention
gives each passage a weight, the weights of a document sum to one, and the weighted passage
representation is scored. All parts are learned together from document labels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import (
    LOWER,
    bound_batches,
    mix,
    remainder,
    slices,
    span_hashes,
    text_bytes,
    text_of,
    training_sample,
    word_spans,
)

PASSAGE = 48
BUCKETS = 1 << 13
WIDTH, GATE = 16, 8
MOST_CHARS = 200_000
PER_CLASS = 1200
EPOCHS = 8
LEAST_STEPS = 300  # a small sample is gone through more often
BATCH = 64
THRESHOLD = 0.3

# A byte's class: small letter, capital, digit, white space, itself for other ASCII, beyond ASCII.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = 97, 65, 48, 97


@dataclass
class Bags:
    """Passages of documents: four features per word, and three numbers per passage."""

    features: np.ndarray  # words x 4 buckets
    words: np.ndarray  # first word of every passage, and the end
    passages: np.ndarray  # first passage of every document, and the end
    numbers: np.ndarray


def bags_of(strings: pa.Array) -> Bags:
    """Words in passages of ``PASSAGE``; a text without words is one passage without words."""
    data, offsets = text_bytes(strings)
    starts, ends, before = word_spans(data, offsets)
    n = len(starts)
    word = span_hashes(LOWER[data], starts, ends)
    shape = _SHAPE[data]
    head = span_hashes(shape, starts, np.minimum(starts + 2, ends))
    tail = span_hashes(shape, np.maximum(ends - 3, starts), ends)
    size = np.minimum(ends - starts, 40).astype(np.uint64)
    counts = np.diff(before)
    passages = np.maximum(1, -(-counts // PASSAGE))
    ends_ = np.cumsum(passages)
    doc = np.repeat(np.arange(len(counts)), passages)
    turn = np.arange(ends_[-1] if len(ends_) else 0) - np.repeat(ends_ - passages, passages)
    first = np.append(before[doc] + turn * PASSAGE, n)
    owner = np.repeat(np.arange(len(doc)), np.diff(first))
    again = np.zeros(n, bool)
    again[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    repeats = np.bincount(owner, again, len(doc))
    # Distinct words of a passage, by sorting (passage, word).
    key = np.sort(mix(word + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20) | owner.astype(np.uint64) << np.uint64(44))
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key >> np.uint64(44)).astype(np.int64), new, len(doc)) if n else np.zeros(len(doc))
    total = np.diff(first)
    some = np.maximum(total, 1)
    features = np.column_stack([
        (mix(x + np.uint64(k)) % np.uint64(BUCKETS)).astype(np.int32) for k, x in enumerate((word, head, tail, mix(size)))
    ]) if n else np.zeros((0, 4), np.int32)
    numbers = np.column_stack([repeats / some, distinct / some, total / PASSAGE]).astype(np.float32)
    return Bags(features, first, np.append(0, ends_), numbers)


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of rows between cuts; zero for empty stretches."""
    out = np.zeros((len(cuts) - 1, *values.shape[1:]), values.dtype)
    some = np.flatnonzero(np.diff(cuts) > 0)
    if len(some):
        out[some] = np.add.reduceat(values, cuts[:-1][some])
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    def __init__(self, rng):
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.parts = {
            "E": small(BUCKETS, WIDTH), "N": small(3, WIDTH), "b": small(WIDTH),
            "V": small(WIDTH, GATE), "U": small(WIDTH, GATE), "w": small(GATE), "c": small(WIDTH), "d": small(1),
        }

    def forward(self, bags: Bags):
        p = self.parts
        mean = _sums(p["E"][bags.features].sum(1), bags.words) / np.maximum(np.diff(bags.words), 1)[:, None].astype(np.float32)
        h = np.tanh(mean + bags.numbers @ p["N"] + p["b"])
        v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        raw = (v * u) @ p["w"]
        doc = np.repeat(np.arange(len(bags.passages) - 1), np.diff(bags.passages))
        top = np.full(len(bags.passages) - 1, -np.inf, np.float32)
        np.maximum.at(top, doc, raw)
        e = np.exp(raw - top[doc])
        a = e / _sums(e, bags.passages)[doc]
        z = _sums(h * a[:, None], bags.passages)
        return _sigmoid(z @ p["c"] + p["d"][0]), (h, v, u, a, z, doc)

    def gradients(self, bags: Bags, y: np.ndarray):
        p = self.parts
        score, (h, v, u, a, z, doc) = self.forward(bags)
        error = ((score - y) / len(y)).astype(np.float32)
        dz = error[:, None] * p["c"]
        da = (h * dz[doc]).sum(1)
        draw = a * (da - _sums(a * da, bags.passages)[doc])
        dv, du = draw[:, None] * p["w"] * u * (1 - v * v), draw[:, None] * p["w"] * v * u * (1 - u)
        dh = a[:, None] * dz[doc] + dv @ p["V"].T + du @ p["U"].T
        dx = dh * (1 - h * h)
        sizes = np.diff(bags.words)
        per_word = np.repeat(dx / np.maximum(sizes, 1)[:, None], sizes, 0)
        flat = bags.features.ravel()
        used, at = np.unique(flat, return_inverse=True)
        rows = np.repeat(per_word, 4, 0)
        de = np.column_stack([np.bincount(at, rows[:, j], len(used)) for j in range(WIDTH)]) if len(flat) else np.zeros((0, WIDTH))
        return {
            "E": (used, de), "N": bags.numbers.T @ dx, "b": dx.sum(0), "V": h.T @ dv, "U": h.T @ du,
            "w": ((v * u) * draw[:, None]).sum(0), "c": z.T @ error, "d": error.sum(keepdims=True),
        }


def fit(texts: pa.Array, y: np.ndarray, prior: float, epochs: int = EPOCHS) -> Model:
    """Adam over batches of documents; then the constant is moved from the sample's share of label 1 to ``prior``."""
    rng = np.random.default_rng(11)
    model = Model(rng)
    m = {k: np.zeros_like(v) for k, v in model.parts.items()}
    s = {k: np.zeros_like(v) for k, v in model.parts.items()}
    t = 0
    groups = [np.arange(i, min(i + BATCH, len(y))) for i in range(0, len(y), BATCH)]
    bags = [bags_of(texts.take(pa.array(g))) for g in groups]
    for _ in range(max(epochs, -(-LEAST_STEPS // len(groups)))):
        for i in rng.permutation(len(groups)):
            t += 1
            for k, g in model.gradients(bags[i], y[groups[i]]).items():
                at, g = g if k == "E" else (slice(None), g)
                m[k][at] = 0.9 * m[k][at] + 0.1 * g
                s[k][at] = 0.99 * s[k][at] + 0.01 * g * g
                model.parts[k][at] -= 0.02 * (m[k][at] / (1 - 0.9**t)) / (np.sqrt(s[k][at] / (1 - 0.99**t)) + 1e-8)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    prior = float(np.clip(prior, 1e-3, 1 - 1e-3))
    model.parts["d"] += np.float32(np.log(prior / (1 - prior)) - np.log(share / (1 - share)))
    return model


def held_out() -> F.Column:
    return F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | None:
    """Fit on at most ``per_class`` whole labelled documents of either label, none of them held out.

    Texts of more than ``MOST_CHARS`` code points are not learned from, so the sample is bounded in size as well.
    The share of label 1 is counted over all labels that are not held out. None without labels.
    """
    known = labels.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality"))
    prior = known.agg(F.avg("quality")).first()[0]
    # At most two rows per document allowed for: the ids of the sample.
    sample = training_sample(known, "quality", (per_class, per_class))
    short = docs.select("doc_id", text_of().alias("text")).filter(F.length("text") <= MOST_CHARS)
    chosen = short.join(F.broadcast(sample), "doc_id")
    got = chosen.select("text", "quality", F.md5(F.col("doc_id").cast("string")).alias("k")).toArrow()
    got = got.sort_by([("k", "ascending"), ("text", "ascending")])
    if prior is None or not got.num_rows:
        return None
    return fit(got.column("text").combine_chunks(), got.column("quality").to_numpy().astype(np.float32), prior)


def score(docs: DataFrame, model: Model | None, columns: list[str], attention: bool = False) -> DataFrame:
    """``columns`` of ``docs``, ``score`` and ``predicted`` of every whole text; with ``attention`` the weights of its passages.

    Null and empty texts are one passage without words, scored like any other. Without a model
    the score is 0.5.
    """
    bound_batches(docs.sparkSession)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema.fields)

    def predict(batches):
        for whole in batches:
            for batch in slices(whole, "_text"):
                n = batch.num_rows
                p, weights = np.full(n, 0.5), [[1.0]] * n
                if model is not None:
                    bags = bags_of(batch.column("_text"))
                    p, (_, _, _, a, _, _) = model.forward(bags)
                    weights = np.split(a.astype(float), bags.passages[1:-1]) if attention else weights
                p = p.astype(float)
                arrays = [*[batch.column(c) for c in columns], pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))]
                names = [*columns, "score", "predicted"]
                if attention:
                    arrays, names = [*arrays, pa.array([list(w) for w in weights], pa.list_(pa.float64()))], [*names, "attention"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    rows = docs.select(*[F.col(f"`{c}`") for c in columns], text_of().alias("_text"))
    return rows.mapInArrow(predict, f"{kinds}, score double, predicted int" + ", attention array<double>" * attention)
