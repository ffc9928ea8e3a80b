import numpy as np
import public_tokenizers
import pytest
from compare import differences, duck

import __spark_entry__ as entry
import corpus_pipeline
from tickloom.llm import chosen_path, langid_crf, mil, mixing, quality_rules
from tickloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op4_language": {"doc_id", "held_out", "lang_pred", "score"},
    "op5_shards": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op6_near_duplicates": {"doc_id", "class_id", "n_links"},
    "op7_quality": {"doc_id", "held_out", "score", "predicted"},
    "op8_toxicity": {"doc_id", "held_out", "p_toxic", "is_toxic"},
    "op9_token_files": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op10_pack": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op13_whitening": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
}


def test_all_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(COLUMNS) | set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_twin(spark, name):
    assert differences(spark, duck(SF), SF, name) is None


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - {"op10_pack", "op13_whitening"}))
def test_query_has_a_row_per_document(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert COLUMNS[name] <= set(got.columns)
    assert sorted(got["doc_id"]) == list(range(200))
    if name == "op4_language":
        truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas().merge(got, on="doc_id")
        assert (truth["lang"] == truth["lang_pred"])[truth["held_out"]].mean() >= 0.95
    if name == "op7_quality":
        truth = spark.read.parquet(f"{SF}/labels.parquet").toPandas().merge(got, on="doc_id")
        assert (truth["quality"] == truth["predicted"]).mean() >= 0.95


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage against what its operator says of its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outputs = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        outputs.append((docs, spark.read.parquet(f"{tmp_path}/{i}")))
        docs = outputs[-1][1]
    for before, after in outputs[:-1]:
        assert after.columns == before.columns
    ids = lambda df: [r[0] for r in df.select("doc_id").orderBy("doc_id").collect()]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = set(ids(outputs[0][0])) - set(ids(outputs[0][1]))
    assert all(labels.get(i) != 0 for i in gone) and any(labels.get(i) == 1 for i in gone)
    judged = quality_rules.judge(outputs[1][0]).filter("kept")
    assert ids(judged) == ids(outputs[1][1])
    classes = chosen_path.join(outputs[2][0]).select("class_id").distinct()
    assert sorted(r[0] for r in classes.collect()) == ids(outputs[2][1])
    words = mixing.mix(outputs[3][0]).select(mixing.taken().alias("n")).toPandas()["n"].sum()
    mixed = outputs[3][1].toPandas()
    assert sum(len(t.split()) for t in mixed["text"].fillna("")) == words
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = sum(len(e.ids) + 1 for e in tokenizer.encode_batch(list(mixed["text"].fillna("")), add_special_tokens=False))
    packed = outputs[4][1].toPandas()
    assert packed["length"].sum() == total
    sizes = packed.groupby("sequence_id")["length"].sum()
    assert (sizes.sort_index().iloc[:-1] == 2048).all() and np.array_equal(sizes.index, np.arange(len(sizes)))


def test_thresholds_of_the_contract():
    assert mil.THRESHOLD == 0.3 and chosen_path.SIMILARITY == 0.8 and chosen_path.WORDS == 5 and langid_crf.UNKNOWN == "und"
