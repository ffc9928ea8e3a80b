import random

from tickloom.operators.sequences import number_rows, with_previous


def test_numbers_are_dense_and_ordered_over_many_slices(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "7")
    codes = [f"Brand#{i:05d}" for i in range(2000)]
    random.Random(1).shuffle(codes)
    df = spark.createDataFrame([(c,) for c in codes], "code string").repartition(5)
    numbered = number_rows(df, ["code"], "id", 10)
    assert numbered.columns == ["code", "id"]
    got = {r.code: r.id for r in numbered.collect()}
    assert got == {c: i for i, c in enumerate(sorted(codes), start=11)}


def test_previous_value_of_a_key_that_spans_slices(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "7")
    dice = random.Random(2)
    # Key 0 owns a third of the rows, and the ranges cut it into several slices.
    rows = [(0 if i % 3 == 0 else dice.randint(1, 50), i, dice.choice("xyz")) for i in range(3000)]
    expected, last = {}, {}
    for key, order, value in rows:
        expected[order] = last.get(key)
        last[key] = value
    shuffled = rows[:]
    dice.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "key int, pos bigint, value string").repartition(6)
    out = with_previous(df, "key", ["pos"], "value", "before")
    assert out.columns == ["key", "pos", "value", "before"]
    assert {r.pos: r.before for r in out.collect()} == expected
