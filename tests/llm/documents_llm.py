"""Documents for the tests of the text operators."""

import random

import pytest

WORDS = "amber basin cedar delta ember fjord grove haven inlet jetty knoll ledge marsh north oasis plain quarry ridge shoal tundra".split()


def prose(seed, n, line=12):
    """``n`` words in sentences and lines, the same for the same seed."""
    r = random.Random(seed)
    words = [r.choice(WORDS) + r.choice(["", "", "s", "ed", "ing"]) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + line]) + "." for i in range(0, n, line))


@pytest.fixture(scope="module")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated ids and rows, and columns with clashing names."""
    long = prose(99, 30_000)
    texts = [
        (1, prose(1, 200), "en", "a"), (1, prose(1, 200), "en", "a"), (1, prose(2, 90), "en", "a"), (2, None, "en", "a"),
        (3, "", "en", "b"), (4, "", None, None), (None, prose(4, 80), "en", "b"), (None, None, None, None), (5, long, "en", "b"),
        (6, " \n\t ", "de", "b"), (7, "x", "de", "c"), (8, prose(8, 70), None, "c"), (9, prose(9, 60), "en", None), (10, prose(1, 200), "en", "c"),
    ]
    rows = [(*t, len(t[1] or ""), "extra", 1.5, i) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, _text string, size double, row int"
    ).withColumnsRenamed({}).selectExpr("*", "row as key", "row as tokens", "row as kept", "row as score", "row as _key", "row as shard")


@pytest.fixture(scope="module")
def no_documents(odd_documents):
    return odd_documents.limit(0)
