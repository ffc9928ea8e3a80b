import random

import numpy as np
import pyarrow as pa
import pytest
from documents_llm import no_documents, odd_documents, prose  # noqa: F401
from pyspark.sql import functions as F

from tickloom.llm import langid_crf, mil, toxicity

SPEECH = {
    "aa": "banana mango papaya guava kiwi melon lime".split(),
    "bb": "stahl eisen kupfer nickel zinn silber blei".split(),
}


def speech(lang, seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(SPEECH[lang]) + r.choice(["", "ta" if lang == "aa" else "ung"]) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    rows = [(i, speech(("aa", "bb")[i % 2], i, 30 + i), ("aa", "bb")[i % 2]) for i in range(80)]
    rows += [(100, None, "aa"), (101, "", "bb"), (102, "12 34 -- !", "aa"), (103, "« — » … ×", None), (None, speech("aa", 5, 20), "aa")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_of_held_out_documents(spark, spoken):
    model = langid_crf.train(spoken)
    assert model.languages == ["aa", "bb"]
    got = {r["doc_id"]: r for r in langid_crf.identify(spoken, model).collect()}
    assert len(got) == spoken.count()
    assert all(got[i]["lang_pred"] == ("aa", "bb")[i % 2] for i in range(80))
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0) for i in (100, 101, 102, 103))
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_words_of_a_text_that_switches_languages(spark, spoken):
    model = langid_crf.train(spoken)
    text = " ".join([speech("aa", 1, 12), speech("bb", 2, 9), speech("aa", 3, 14)])
    row = langid_crf.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model, spans=True).first()
    assert [(r["first"], r["words"], r["lang"]) for r in row["spans"]] == [(0, 12, "aa"), (12, 9, "bb"), (21, 14, "aa")]


def test_forward_backward_against_all_labellings():
    r = np.random.default_rng(1)
    before, k = np.array([0, 4, 4, 9, 10]), 3
    scores, links = r.normal(0, 1, (10, k)), r.normal(0, 1, (k, k))
    both, pairs = langid_crf.forward_backward(scores, before, links, True)
    want, expected = np.zeros_like(scores), np.zeros((k, k))
    for a, b in zip(before[:-1], before[1:], strict=True):
        n = b - a
        paths = np.array(np.meshgrid(*[range(k)] * n, indexing="ij")).reshape(n, -1).T if n else []
        weights = np.array([np.exp(scores[np.arange(a, b), p].sum() + links[p[:-1], p[1:]].sum()) for p in paths])
        for p, w in zip(paths, weights / weights.sum() if n else [], strict=True):
            want[np.arange(a, b), p] += w
            np.add.at(expected, (p[:-1], p[1:]), w)
    assert np.allclose(both, want) and np.allclose(pairs, expected)


def test_models_without_anything_to_learn(spark, no_documents, odd_documents):
    assert langid_crf.train(no_documents) is None
    assert {r["lang_pred"] for r in langid_crf.identify(odd_documents, None).collect()} == {"und"}
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert mil.train(odd_documents, labels) is None and toxicity.train(odd_documents, labels) is None
    assert {r["score"] for r in mil.score(odd_documents, None, ["doc_id"]).select("score").collect()} == {0.5}
    assert toxicity.clean(odd_documents, None).count() == odd_documents.count()
    assert mil.score(no_documents, None, ["doc_id"]).count() == 0


def test_odd_rows_are_labelled(odd_documents):
    model = langid_crf.train(odd_documents)
    got = langid_crf.identify(odd_documents, model).collect()
    assert len(got) == odd_documents.count()
    assert all(r["lang_pred"] == "und" for r in got if r["doc_id"] in (2, 3, 4, 6))


@pytest.fixture(scope="module")
def rated(spark):
    r = random.Random(2)
    rows = []
    for i in range(300):
        bad = i % 4 == 0
        words = prose(i, r.randint(60, 250)).split()
        if bad:
            at = r.randrange(len(words) - 40)
            words[at : at + 40] = [w + r.choice(["###", "%%", "&&&"]) for w in words[at : at + 40]]
        rows.append((i, " ".join(words), int(not bad)))
    rows += [(1000, None, None), (1001, "", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_quality_of_held_out_documents_and_attention(rated):
    labels = rated.select("doc_id", "quality")
    model = mil.train(rated, labels)
    got = mil.score(rated, model, ["doc_id"], attention=True).join(labels, "doc_id").withColumn("held_out", mil.held_out()).collect()
    unseen = [r for r in got if r["held_out"] and r["quality"] is not None]
    assert len(unseen) > 30 and sum(r["predicted"] == r["quality"] for r in unseen) >= 0.95 * len(unseen)
    assert all(abs(sum(r["attention"]) - 1) < 1e-5 and 0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_gradients_of_the_bag_model():
    texts = pa.array(["one two three " * 40, "", "alpha ###", "four five " * 70])
    bags, y = mil.bags_of(texts), np.array([1, 0, 0, 1], np.float32)
    model = mil.Model(np.random.default_rng(3))
    model.parts = {k: v.astype(np.float64) * 3 for k, v in model.parts.items()}
    loss = lambda: -np.mean(np.log(np.where(y == 1, model.forward(bags)[0], 1 - model.forward(bags)[0])))
    for name, g in model.gradients(bags, y).items():
        at, g = (g[0][0], g[1][0]) if name == "E" else (0, g[0])
        part = model.parts[name]
        spot = (at, 1) if part.ndim == 2 else (at,)
        g = g[1] if part.ndim == 2 else g
        part[spot] += 1e-5
        high = loss()
        part[spot] -= 2e-5
        assert (high - loss()) / 2e-5 == pytest.approx(float(g), abs=1e-4), name
        part[spot] += 1e-5


@pytest.fixture(scope="module")
def spoken_ill(spark):
    r = random.Random(4)
    bad = [w for words in toxicity.CATEGORIES.values() for w in words]
    rows = []
    for i in range(500):
        words = prose(1000 + i, r.randint(30, 300)).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(r.randint(2, 4)):
                words.insert(r.randrange(len(words)), r.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxic_documents_are_caught_and_clean_ones_left(spark, spoken_ill):
    chain = toxicity.train(spoken_ill, spoken_ill.filter(~toxicity.held_out()).select("doc_id", "toxic"))
    assert chain.names == ["insult", "contempt", "toxic"]
    assert [len(w) - len(chain.keys) for w in chain.weights] == [1, 2, 3]
    got = toxicity.score(spoken_ill, chain, ["doc_id", "toxic"]).withColumn("held_out", toxicity.held_out()).collect()
    unseen = [r for r in got if r["held_out"]]
    assert all(not r["is_toxic"] for r in unseen if not r["toxic"])
    assert sum(r["is_toxic"] for r in unseen if r["toxic"]) >= 0.9 * sum(r["toxic"] for r in unseen)
    extra = spoken_ill.withColumn("is_toxic", F.lit("mine")).withColumn("_text", F.lit(1))
    kept = toxicity.clean(extra, chain)
    assert kept.columns == extra.columns and kept.filter("toxic = 1").count() <= 10 and kept.filter("toxic = 0").count() == 400


def test_rarer_labels_move_the_reported_probabilities_only():
    r = np.random.default_rng(6)
    n, width = 400, 12
    on = r.random((n, width)) < 0.3
    toxic = (on[:, :3].sum(1) >= 2).astype(float)
    labels = {"insult": toxic * on[:, 0], "contempt": toxic * on[:, 1], "toxic": toxic}
    rows = toxicity.Rows(*np.nonzero(on), n, width)
    keys, folds = np.arange(width, dtype=np.uint64), np.arange(n) % toxicity.FOLDS
    even, rare = (toxicity.fit_chain(rows, keys, labels, folds, thinner) for thinner in (1.0, 0.2))
    odds = lambda p: np.log(p / (1 - p))
    moved = odds(rare.predict(rows)) - odds(even.predict(rows))
    for i, y in enumerate(labels.values()):
        assert np.allclose(moved[:, i], odds(0.2 * y.mean()) - odds(y.mean()), atol=1e-6)


def test_held_out_toxic_documents_are_caught_where_the_sample_is_bounded(spark, spoken_ill):
    labels = spoken_ill.filter(~toxicity.held_out()).select("doc_id", "toxic")
    got = toxicity.score(spoken_ill, toxicity.train(spoken_ill, labels, (30, 60)), ["doc_id", "toxic"])
    unseen = got.filter(toxicity.held_out() & (F.col("toxic") == 1)).collect()
    assert sum(r["is_toxic"] for r in unseen) >= 0.9 * len(unseen)


def test_the_prior_moves_reported_probabilities_alone():
    """The chain is fed as it was trained: a rarer label shifts every log-odds by one constant a category."""
    r = np.random.default_rng(3)
    has = r.random((200, 6)) < 0.4
    doc, feature = np.nonzero(has)
    rows = toxicity.Rows(doc, feature, 200, 6)
    labels = {"first": (has[:, 0] & (r.random(200) < 0.7)).astype(float), "last": ((has[:, 0] | has[:, 1]) & (r.random(200) < 0.7)).astype(float)}

    def odds(thinner):
        p = toxicity.fit_chain(rows, np.arange(6, dtype=np.uint64), labels, np.arange(200) % toxicity.FOLDS, thinner).predict(rows)
        return np.log(p / (1 - p))

    moved = odds(0.05) - odds(1.0)
    assert np.allclose(moved, moved[0]) and (moved < -2).all()
