"""Mix sources to target weights: hash-random order, distributed prefix sums, an exact cut, repeated epochs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import SPACE, running_before, text_of, word_count
from tickloom.session import materialise

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_EPOCHS = 2


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = SHARE_PERCENT, epochs: int = MOST_EPOCHS) -> DataFrame:
    """``(source, source_size)`` with ``weight`` and ``target``.

    Sources in code point order, null last, take the weights in turn and share ``percent`` of all
    sizes. A target stops at ``epochs`` times its source's size, and what is over goes to the
    others by weight. In the order of size over weight the sources that stop are the first ones,
    so two running sums find them all at once. One row per source passes through one task.
    """
    if percent > 100 * epochs:
        raise ValueError("the sources cannot fill that share")
    everything = Window.partitionBy()
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((turn - 1) % len(weights) + 1).cast("int")).cast("long")
    common = 1
    for w in weights:
        common *= w
    order = Window.orderBy("_level", F.col("source").asc_nulls_last())
    stopped = F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    left = F.col("_all") * percent - F.col("_stopped") * (100 * epochs)
    rows = (
        sizes.withColumn("weight", weight)
        .withColumn("_level", F.col("source_size") * (F.lit(common) / F.col("weight")).cast("long"))
        .withColumn("_all", F.sum("source_size").over(everything))
        .withColumn("_stopped", F.coalesce(stopped, F.lit(0)))
        .withColumn("_weights", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_stops", left * F.col("weight") >= F.col("source_size") * F.col("_weights") * (100 * epochs))
    )
    open_ = lambda c: F.when(~F.col("_stops"), F.col(c))
    rows = rows.withColumns({
        "_stopped": F.min(open_("_stopped")).over(everything), "_weights": F.max(open_("_weights")).over(everything),
    })
    share = (left * F.col("weight")).cast("double") / (F.col("_weights") * 100).cast("double")
    target = F.when(F.col("_stops"), (F.col("source_size") * epochs).cast("double")).otherwise(share)
    return rows.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, carry: Sequence[str] = (), **options) -> DataFrame:
    """``doc_id``, ``source``, ``carry``, ``size`` (words; null text none), ``source_size``, ``target``, ``epochs``, ``part``.

    The mix takes a document ``epochs`` times whole and then its first ``part`` words. Within a
    source, documents stand in the order of the hash of ``doc_id``; the epoch that is not whole
    takes them up to the exact budget, the whole words of the target, and cuts the one there.
    Repeated ids are ordered by a hash of the text; rows alike in both may swap places. A null
    source is a source of its own; sources without words, and empty tables, have nothing taken.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.select("doc_id", "source", *carry, word_count().alias("size"), key.alias("_key"), F.xxhash64(text_of()).alias("_tie"))
    rows = rows.withColumn("_group", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")))
    if not carry:
        # Counting words is the costly part; without texts to carry, the counts are stored.
        rows = materialise(rows, "word-counts")
    # The sums of the sources, a row each, serve several windows.
    sums = materialise(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    aims = targets(sums, **options).select(F.col("source").alias("_source"), "source_size", "target")
    placed = running_before(rows, ["_group"], "_key", "size", "_before", ["_tie"])
    placed = placed.join(aims, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - F.col("epochs") * F.col("source_size") - F.col("_before")
    return placed.withColumn("epochs", epochs).withColumn(
        "part", F.least(F.col("size"), F.greatest(F.lit(0), rest)).cast("long")
    ).drop("_key", "_tie", "_before", "_group")


def taken() -> Column:
    return F.col("epochs") * F.col("size") + F.col("part")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``: one row for each time a document is taken.

    A document cut at the budget has its first words, with single spaces between them. ``n_chars``
    is counted anew where there is such a column.
    """
    whole = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    rows = mix(whole, ["text", "_doc"], **options)
    full = F.col("epochs") + F.when(F.col("part") == F.col("size"), F.sign("part").cast("long")).otherwise(F.lit(0))
    cut = (F.col("part") > 0) & (F.col("part") < F.col("size"))
    copies = F.concat(F.array_repeat(F.lit(False), full.cast("int")), F.array_repeat(F.lit(True), cut.cast("int")))
    rows = rows.withColumn("_cut", F.explode(copies))
    words = F.array_remove(F.split(text_of(), SPACE), "")
    begin = F.array_join(F.slice(words, 1, F.greatest(F.lit(1), F.col("part")).cast("int")), " ")
    rows = rows.withColumn("text", F.when(F.col("_cut"), begin).otherwise(F.col("text")))
    anew = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        anew["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[anew.get(c, F.col("_doc").getField(c)).alias(c) for c in docs.columns])
