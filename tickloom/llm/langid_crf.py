"""Language of words and documents by a linear-chain conditional random field.

Every word of a text has a label, a language; its score is the sum of learned weights of its
beginnings, endings, character n-grams and, if it is in the lexicon, of the word itself; labels
of neighbours are tied by learned transitions. Forward-backward gives each word's probabilities,
and a document's score for a language is the mean over its words, so text that switches between
languages is labelled word by word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import IS_NO_LETTER, LOWER, bound_batches, mix, remainder, slices, span_hashes, text_bytes, text_of, word_spans

PER_LANGUAGE = 200
MOST_CHARS = 1_000_000
BUCKETS = 1 << 17
LEXICON = 20_000
LEXICON_DOCUMENTS = 5
STEPS = 40
UNKNOWN = "und"


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and for the two-byte letters of Latin-1."""
    out = LOWER[data]
    pair = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[pair] += 0x20
    return out


def _ramp(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the affixes and n-grams of words, and the word each belongs to."""
    out, words = [], []

    def add(kind, s, e, w):
        code = mix(span_hashes(data, s, e) + np.uint64(kind))
        out.append((code % np.uint64(BUCKETS)).astype(np.int64))
        words.append(w)

    length = ends - starts
    every = np.arange(len(starts))
    for k in (1, 2, 3, 4):
        long = length >= k
        add(k, starts[long], starts[long] + k, every[long])
        add(10 + k, ends[long] - k, ends[long], every[long])
    for k in (2, 3):
        which, turn = _ramp(np.maximum(length - k + 1, 0))
        at = starts[which] + turn
        add(20 + k, at, at + k, which)
    return np.concatenate(out), np.concatenate(words)


@dataclass
class Words:
    """The words of a batch: distinct hashes, where each first occurs, and the distinct word of every word."""

    distinct: np.ndarray
    kind: np.ndarray
    before: np.ndarray
    bucket: np.ndarray
    owner: np.ndarray


def words_of(strings: pa.Array) -> Words:
    data, offsets = text_bytes(strings)
    data = lowered(data)
    starts, ends, before = word_spans(data, offsets, IS_NO_LETTER)
    distinct, first, kind = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    order = np.argsort(first)
    bucket, owner = word_features(data, starts[first[order]], ends[first[order]])
    return Words(distinct, kind, before, bucket, order[owner])


@dataclass
class Model:
    languages: list[str]
    lexicon: np.ndarray
    weights: np.ndarray
    lexicon_weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: Words) -> np.ndarray:
        """Scores of the distinct words."""
        n, k = len(words.distinct), len(self.languages)
        out = np.column_stack([np.bincount(words.owner, self.weights[words.bucket, j], n) for j in range(k)]) if n else np.zeros((0, k))
        at = np.searchsorted(self.lexicon, words.distinct)
        at[at == len(self.lexicon)] = 0
        if len(self.lexicon):
            known = self.lexicon[at] == words.distinct
            out[known] += self.lexicon_weights[at[known]]
        return out


def forward_backward(scores: np.ndarray, before: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """Probabilities of the labels of every word; with ``pairs`` also the expected transitions.

    Sequences are the words between ``before[i]`` and ``before[i + 1]``. All sequences advance
    together, a word at a time, laid out by time so that each step is one slice.
    """
    lengths = np.diff(before)
    order = np.argsort(-lengths, kind="stable")
    lengths_ = lengths[order]
    steps = int(lengths_[0]) if len(lengths_) else 0
    active = np.searchsorted(-lengths_, -np.arange(steps), "left")
    at = np.append(0, np.cumsum(active))
    which, turn = _ramp(lengths)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    place = at[turn] + rank[which] if steps else np.zeros(0, np.int64)
    potentials = np.empty_like(scores)
    potentials[place] = np.exp(scores - scores.max(1, keepdims=True)) if steps else scores
    matrix = np.exp(transitions)
    ahead, back = np.empty_like(scores), np.ones_like(scores)
    for t in range(steps):
        low, high = at[t], at[t + 1]
        a = potentials[low:high] if t == 0 else (ahead[at[t - 1] : at[t - 1] + high - low] @ matrix) * potentials[low:high]
        ahead[low:high] = a / a.sum(1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        n = active[t + 1]
        b = (back[at[t + 1] : at[t + 1] + n] * potentials[at[t + 1] : at[t + 1] + n]) @ matrix.T
        back[at[t] : at[t] + n] = b / b.sum(1, keepdims=True)
    both = ahead * back
    both /= both.sum(1, keepdims=True) if steps else 1
    expected = np.zeros_like(matrix)
    if pairs and steps > 1:
        head = np.concatenate([np.arange(at[t], at[t] + active[t + 1]) for t in range(steps - 1)])
        tail = np.concatenate([np.arange(at[t + 1], at[t + 1] + active[t + 1]) for t in range(steps - 1)])
        right = back[tail] * potentials[tail]
        scale = np.einsum("ni,ij,nj->n", ahead[head], matrix, right)
        expected = (ahead[head] / scale[:, None]).T @ right * matrix
    return both[place], expected


def _switched(kind: np.ndarray, label: np.ndarray, before: np.ndarray, rng) -> tuple[np.ndarray, ...]:
    """Training sequences: every other text as it is, the rest woven in pairs, some words of each in turn."""
    n = len(before) - 1
    order = rng.permutation(n)
    take, seqs = [], [0]
    for i in order[::2]:
        take.append(np.arange(before[i], before[i + 1]))
        seqs.append(seqs[-1] + len(take[-1]))
    rest = order[1::2]
    for a, b in zip(rest[::2], np.append(rest[1::2], rest[:1])[: len(rest[::2])], strict=False):
        parts, ends = [], {a: before[a], b: before[b]}
        for turn in range(1 << 30):
            i = (a, b)[turn % 2]
            if all(ends[j] >= before[j + 1] for j in (a, b)):
                break
            stop = min(before[i + 1], ends[i] + rng.integers(8, 40))
            parts.append(np.arange(ends[i], stop))
            ends[i] = stop
            if a == b and stop >= before[a + 1]:
                break
        take += parts
        seqs.append(seqs[-1] + sum(map(len, parts)))
    take = np.concatenate(take) if take else np.zeros(0, np.int64)
    return kind[take], label[take], np.array(seqs)


def fit(texts: pa.Array, languages: np.ndarray, steps: int = STEPS) -> Model:
    """Maximum likelihood by Adam; texts carry the label of their document on every word."""
    names, label = np.unique(languages, return_inverse=True)
    words = words_of(texts)
    counts = np.diff(words.before)
    doc = np.repeat(np.arange(len(counts)), counts)
    pairs = np.unique(words.kind.astype(np.int64) * len(counts) + doc) // max(1, len(counts))
    spread = np.bincount(pairs, minlength=len(words.distinct))
    common = np.flatnonzero(spread >= LEXICON_DOCUMENTS)
    common = np.sort(common[np.argsort(-spread[common], kind="stable")[:LEXICON]])
    k = len(names)
    model = Model(list(map(str, names)), words.distinct[common], np.zeros((BUCKETS, k)), np.zeros((len(common), k)), np.zeros((k, k)))
    kind, y, before = _switched(words.kind, label[doc], words.before, np.random.default_rng(7))
    if not len(kind):
        return model
    linked = np.ones(len(kind), bool)
    linked[before[:-1][np.diff(before) > 0]] = False
    at = np.flatnonzero(linked)
    seen = np.bincount(y[at - 1] * k + y[at], minlength=k * k).reshape(k, k)
    truth = np.bincount(kind * k + y, minlength=len(words.distinct) * k).reshape(-1, k)
    parts = [model.weights, model.lexicon_weights, model.transitions]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    for t in range(1, steps + 1):
        both, expected = forward_backward(model.emissions(words)[kind], before, model.transitions, True)
        error = np.column_stack([np.bincount(kind, both[:, j], len(words.distinct)) for j in range(k)]) - truth
        n = len(kind)
        grads = [
            np.column_stack([np.bincount(words.bucket, error[words.owner, j], BUCKETS) for j in range(k)]) / n + 1e-6 * model.weights,
            error[common] / n + 1e-6 * model.lexicon_weights,
            (expected - seen) / n + 1e-6 * model.transitions,
        ]
        for p, g, (m, v) in zip(parts, grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return model


def held_out() -> F.Column:
    return F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, most_chars: int = MOST_CHARS) -> Model | None:
    """Fit on at most ``per_language`` documents of each language, none of them held out, and about ``most_chars`` code points each.

    The documents are the first by hash of ``doc_id``, taken whole; once a language has that much
    text, further documents of it are left aside, as are those that alone have more. So what comes to the driver is
    bounded in size. One pass finds the documents of all languages, by id, and a second one reads
    their texts. None if no document has a language.
    """
    known = docs.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.withColumns({"_k": F.md5(F.col("doc_id").cast("string")), "_n": F.length("text")}).filter(F.col("_n") <= most_chars)
    # Tasks keep the first rows of each language before the shuffle.
    first = Window.partitionBy("lang").orderBy("_k", "_n")
    ids = known.select("doc_id", "lang", "_k", "_n").withColumn("_row", F.row_number().over(first)).filter(F.col("_row") <= per_language)
    before = Window.partitionBy("lang").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    ids = ids.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).filter(F.col("_before") < most_chars)
    # At most per_language rows per language.
    chosen = known.join(F.broadcast(ids.select("doc_id", "lang", "_n").distinct()), ["doc_id", "lang", "_n"], "left_semi")
    got = chosen.select("lang", "text", "_k").toArrow().sort_by([("_k", "ascending"), ("text", "ascending")])
    return fit(got.column("text").combine_chunks(), np.array(got.column("lang").to_pylist(), object).astype(str)) if got.num_rows else None


def identify(docs: DataFrame, model: Model | None, spans: bool = False) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` of every whole text; with ``spans`` also the runs of words of one language.

    ``und`` with score 0 for null texts and texts without a letter, and for all without a model.
    A run is its first word, from 0, the number of its words and the language; words are runs of letters.
    """
    bound_batches(docs.sparkSession)
    run = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("lang", pa.string())]))

    def predict(batches):
        for whole in batches:
            for batch in slices(whole, "_text", 4 << 20):
                n, texts = batch.num_rows, batch.column("_text")
                pred, score = np.full(n, UNKNOWN, object), np.zeros(n)
                runs = [[] for _ in range(n)]
                if model is not None:
                    words = words_of(texts)
                    both, _ = forward_backward(model.emissions(words)[words.kind], words.before, model.transitions)
                    sums = np.concatenate([np.zeros((1, both.shape[1])), np.cumsum(both, 0)])
                    counts = np.diff(words.before)
                    mean = (sums[words.before[1:]] - sums[words.before[:-1]]) / np.maximum(counts, 1)[:, None]
                    best = mean.argmax(1)
                    some = counts > 0
                    pred[some] = np.array(model.languages, object)[best[some]]
                    score[some] = np.clip(mean[np.arange(n), best], 0, 1)[some]
                    # What is not ASCII counted as letters; where there are no others, look closer.
                    data, offsets = text_bytes(texts)
                    sure = np.append(0, np.cumsum(~IS_NO_LETTER[data] & (data < 0x80)))
                    for i in np.flatnonzero(some & (sure[offsets[1:]] == sure[offsets[:-1]])):
                        if not any(c.isalpha() for c in texts[int(i)].as_py()):
                            pred[i], score[i] = UNKNOWN, 0.0
                    if spans:
                        label = both.argmax(1)
                        for i in np.flatnonzero(pred != UNKNOWN):
                            part = label[words.before[i] : words.before[i + 1]]
                            heads = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
                            runs[i] = [{"first": int(a), "words": int(b - a), "lang": model.languages[part[a]]}
                                       for a, b in zip(heads, np.append(heads[1:], len(part)), strict=True)]
                arrays = [batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score)]
                names = ["doc_id", "lang_pred", "score"]
                if spans:
                    arrays, names = [*arrays, pa.array(runs, run)], [*names, "spans"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double" + ", spans array<struct<first:bigint,words:bigint,lang:string>>" * spans
    return docs.select("doc_id", text_of().alias("_text")).mapInArrow(predict, schema)
