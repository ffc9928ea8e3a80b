"""Toxicity by a classifier chain of linear models over words and word beginnings.

Categories are predicted in order; the model of each sees the words and the probabilities of the
categories before it. In training these are predicted out of fold, so that a model learns from
probabilities as good as those it will be given.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import (
    IS_PUNCTUATION,
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

# The label table says only whether a document is toxic. The categories before that one are
# narrower: toxic, and with one of these words.
CATEGORIES = {
    "insult": ("idiot", "moron", "stupid", "loser", "clown"),
    "contempt": ("pathetic", "worthless", "trash", "scum", "disgusting"),
}
PREFIXES = (4, 5, 6)
PER_CLASS = (2500, 1500)  # not toxic, toxic
MOST_FEATURES = 4096
LEAST_DOCUMENTS = 4
FOLDS = 4
THRESHOLD = 0.2


def doc_features(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words of every text and of their beginnings, and the text each belongs to."""
    data, offsets = text_bytes(strings)
    data = LOWER[data]
    starts, ends, before = word_spans(data, offsets, IS_PUNCTUATION)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    hashes, docs = [span_hashes(data, starts, ends)], [doc]
    for k in PREFIXES:
        long = ends - starts >= k
        s = starts[long]
        hashes.append(mix(span_hashes(data, s, s + k) + np.uint64(k)))
        docs.append(doc[long])
    return np.concatenate(hashes), np.concatenate(docs)


def seed_hash(word: str) -> int:
    return int(span_hashes(np.frombuffer(word.encode(), np.uint8), np.array([0]), np.array([len(word.encode())]))[0])


class Rows:
    """Binary features of documents: ``feature[begin[i]:begin[i + 1]]`` are those of document ``i``."""

    def __init__(self, doc: np.ndarray, feature: np.ndarray, n: int, width: int):
        key = np.unique(doc.astype(np.int64) * width + feature)
        self.doc, self.feature, self.n, self.width = key // width, key % width, n, width

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, weights[self.feature], self.n)

    def gather(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.feature, values[self.doc], self.width)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(rows: Rows, extra: np.ndarray, y: np.ndarray, use: np.ndarray, steps: int = 250, l2: float = 1e-3) -> np.ndarray:
    """Logistic regression by Adam over the documents in ``use``: weights of features, of ``extra``, and a constant."""
    w = np.zeros(rows.width + extra.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    k = rows.width
    for t in range(1, steps + 1):
        p = _sigmoid(rows.times(w[:k]) + extra @ w[k:-1] + w[-1])
        error = np.where(use, p - y, 0.0) / use.sum()
        g = np.concatenate([rows.gather(error), extra.T @ error, [error.sum()]]) + l2 * np.append(w[:-1], 0.0) / 10
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


@dataclass
class Chain:
    """``keys``: hashes of the features, sorted; ``weights``: a row per category; ``shifts``: from the sample's log-odds to the corpus's."""

    names: list[str]
    keys: np.ndarray
    weights: list[np.ndarray]
    shifts: list[float]

    def __post_init__(self):
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.keys & np.uint64((1 << 20) - 1)] = True

    def known(self, hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hit = np.flatnonzero(self.maybe[hashes & np.uint64((1 << 20) - 1)])
        hashes, docs = hashes[hit], docs[hit]
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        same = self.keys[at] == hashes if len(self.keys) else np.zeros(len(at), bool)
        return docs[same], at[same]

    def predict(self, rows: Rows) -> np.ndarray:
        """A column of probabilities per category. Along the chain go those of the sample, as in training."""
        fed, out = np.zeros((rows.n, 0)), np.zeros((rows.n, 0))
        for w, shift in zip(self.weights, self.shifts, strict=True):
            score = rows.times(w[: rows.width]) + _logit(fed) @ w[rows.width : -1] + w[-1]
            fed = np.column_stack([fed, _sigmoid(score)])
            out = np.column_stack([out, _sigmoid(score + shift)])
        return out


def fit_chain(rows: Rows, keys: np.ndarray, labels: dict[str, np.ndarray], folds: np.ndarray, thinner: float = 1.0) -> Chain:
    """``thinner``: how much rarer the labels are in the corpus than in the sample; reported probabilities follow."""
    earlier, weights, shifts = np.zeros((rows.n, 0)), [], []
    everyone = np.ones(rows.n, bool)
    for y in labels.values():
        extra = _logit(earlier)
        weights.append(fit_linear(rows, extra, y, everyone))
        shifts.append(float(_logit(y.mean() * thinner) - _logit(y.mean())))
        unseen = np.zeros(rows.n)
        for fold in range(FOLDS):
            inside = folds == fold
            w = fit_linear(rows, extra, y, ~inside)
            p = _sigmoid(rows.times(w[: rows.width]) + extra @ w[rows.width : -1] + w[-1])
            unseen[inside] = p[inside]
        earlier = np.column_stack([earlier, unseen])
    return Chain(list(labels), keys, weights, shifts)


def train(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS) -> Chain | None:
    """Fit on at most ``per_class`` labelled documents of the two kinds; None without any toxic one.

    Features are taken from tasks; the driver sees those of the sample only. The features kept
    occur in ``LEAST_DOCUMENTS`` documents of the sample and tell the kinds apart best.
    """
    bound_batches(docs.sparkSession)
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    prior = labels.filter(F.col("toxic").isin(0, 1)).agg(F.avg("toxic")).first()[0]
    sample = training_sample(labels, "toxic", per_class)

    def extract(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                hashes, doc = doc_features(batch.column("text"))
                order = np.argsort(doc, kind="stable")
                cuts = np.searchsorted(doc[order], np.arange(1, batch.num_rows))
                unique = [np.unique(part).view(np.int64) for part in np.split(hashes[order], cuts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("toxic"), pa.array([u.tobytes() for u in unique], pa.binary())],
                    ["doc_id", "toxic", "features"])

    # Two rows per class and documented number at most: the ids of the sample.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    chosen = texts.join(F.broadcast(sample.withColumn("doc_id", F.col("doc_id").cast("long"))), "doc_id")
    got = chosen.select("doc_id", "toxic", "text").mapInArrow(extract, "doc_id long, toxic int, features binary").toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("features", "ascending")])
    toxic = got.column("toxic").to_numpy().astype(float)
    if not len(toxic) or not toxic.any():
        return None
    parts = [np.frombuffer(b, np.uint64) for b in got.column("features").to_pylist()]
    folds = got.column("doc_id").to_numpy() % FOLDS
    del got
    pa.default_memory_pool().release_unused()
    seeds = {name: np.array([seed_hash(w) for w in words], np.uint64) for name, words in CATEGORIES.items()}
    classes = {name: toxic * np.array([np.isin(s, p).any() for p in parts]) for name, s in seeds.items()}
    # Most features are rare. Counting the low bits of their hashes, never too few, rules those
    # out before the exact count, which would else take most of the driver's memory.
    low = np.uint64((1 << 22) - 1)
    rough = np.zeros(1 << 22, np.uint16)
    for p in parts:
        rough[np.unique(p & low)] += 1
    least = min(LEAST_DOCUMENTS, len(toxic))
    parts = [p[rough[p & low] >= least] for p in parts]
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    keys, feature = np.unique(np.concatenate(parts), return_inverse=True)
    seen, bad = np.bincount(feature), np.bincount(feature, toxic[doc])
    rate = toxic.mean()
    gain = (bad - seen * rate) ** 2 / (seen * rate * (1 - rate) + 1e-9)
    gain[seen < least] = -1
    chosen = np.sort(np.argsort(-gain, kind="stable")[:MOST_FEATURES])
    chosen = chosen[gain[chosen] > 0]
    place = np.full(len(keys), -1)
    place[chosen] = np.arange(len(chosen))
    inside = place[feature] >= 0
    rows = Rows(doc[inside], place[feature[inside]], len(parts), max(1, len(chosen)))
    return fit_chain(rows, keys[chosen], classes | {"toxic": toxic}, folds, prior / rate)


def score(docs: DataFrame, chain: Chain | None, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs``, a probability per category and ``is_toxic`` for every whole text.

    Null and empty texts have no features and get the constant of the models, which is low. Without
    a model all probabilities are 0.
    """
    bound_batches(docs.sparkSession)
    names = [f"p_{n}" for n in (*CATEGORIES, "toxic")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema.fields)

    def predict(batches):
        for whole in batches:
            for batch in slices(whole, "_text"):
                n = batch.num_rows
                p = np.zeros((n, len(names)))
                if chain is not None:
                    doc, feature = chain.known(*doc_features(batch.column("_text")))
                    p = chain.predict(Rows(doc, feature, n, max(1, len(chain.keys))))
                arrays = [*[batch.column(c) for c in columns], *[pa.array(p[:, i]) for i in range(len(names))], pa.array(p[:, -1] >= THRESHOLD)]
                yield pa.RecordBatch.from_arrays(arrays, [*columns, *names, "is_toxic"])

    rows = docs.select(*[F.col(f"`{c}`") for c in columns], text_of().alias("_text"))
    return rows.mapInArrow(predict, f"{kinds}, {', '.join(f'{n} double' for n in names)}, is_toxic boolean")


def clean(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with their columns as they are."""
    whole = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    return score(whole, chain, ["_doc"]).filter(~F.col("is_toxic")).select("_doc.*")


def held_out() -> F.Column:
    """Whether a document is kept from training, to measure on."""
    return F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
