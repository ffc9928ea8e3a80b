import pytest
from documents_llm import no_documents, odd_documents  # noqa: F401
from pyspark.sql import functions as F

from tickloom.llm import mixing


def by_hand(sizes, weights=(3, 1, 2)):
    """Targets by giving out the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, stopped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in stopped)
        free = [s for s in names if s not in stopped]
        share = {s: rest * w[s] / sum(w[t] for t in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return share | {s: 2.0 * sizes[s] for s in stopped}
        stopped |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 100, "c": 5, "d": 40, None: 7}, {"a": 50}, {"a": 1, "b": 1, "c": 1}, {"x": 0, "y": 9}])
def test_targets_are_those_of_sharing_the_excess_again_and_again(spark, sizes):
    got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = by_hand(sizes)
    assert {r["source"]: r["target"] for r in got} == pytest.approx(want)


def test_budgets_are_exact_and_copies_are_cut_once(spark):
    rows = [(i, "w " * (1 + i % 7), "big" if i % 3 else "small") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).withColumn("taken", mixing.taken()).toPandas()
    for _, part in got.groupby("source"):
        assert part["taken"].sum() == int(part["target"].iloc[0])
        assert ((part["part"] > 0) & (part["part"] < part["size"])).sum() <= 1
    assert (got["taken"] <= 2 * got["size"]).all()
    words = mixing.mixed_documents(docs).select("doc_id", F.size(F.split(F.trim("text"), " ")).alias("n")).groupBy("doc_id").agg(F.sum("n").alias("n"))
    assert {r["doc_id"]: r["n"] for r in words.collect()} == {r.doc_id: r.taken for r in got.itertuples() if r.taken}


def test_odd_rows(odd_documents, no_documents):
    got = mixing.mix(odd_documents).collect()
    assert len(got) == odd_documents.count()
    assert {r["size"] for r in got if r["doc_id"] in (2, 3, 4, 6)} == {0}
    mixed = mixing.mixed_documents(odd_documents)
    assert mixed.columns == odd_documents.columns
    assert {r["size"] for r in mixed.collect()} == {1.5}
    assert mixing.mix(no_documents).count() == 0 and mixing.mixed_documents(no_documents).count() == 0
