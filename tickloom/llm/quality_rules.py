"""Quality rules with thresholds learned per language and source from mergeable quantile sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import SPACE, text_of
from tickloom.session import materialise

# Signals in thousandths (mean word length in hundredths), and the least spread that a
# threshold assumes: documents closer than that to the middle half are never rejected.
SIGNALS = {"symbols": 20, "dup_lines": 150, "repeats": 100, "capitals": 60, "marks": 20, "word_length": 60}
LOW_SIDE = ("word_length",)
SPREADS = 3
# The corpus stands beside a language, and the language beside a source, like this many documents more. So a group is
# judged by its own documents the more it has, without a size at which verdicts change.
PRIOR_DOCUMENTS = 100
# A sketch keeps this many leading bits of a value: exact below 128, 1/64 above.
BITS = 7


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words covered by three-word windows that occur twice or more."""

    def covered(places):
        steps = F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1), p + 3) - p))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def repeated(windows):
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s):
            twin = lambda e, j, d: F.coalesce(F.get(s, j + d)["h"] == e["h"], F.lit(False))
            marked = F.transform(s, lambda e, j: F.when(twin(e, j, -1) | twin(e, j, 1), e["i"]))
            return F.array_sort(F.array_compact(marked))

        some = _let(_let(pairs, places), covered)
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(some)

    window = lambda ws: F.transform(
        F.slice(ws, 1, F.greatest(F.size(ws) - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2)))
    return _let(words, lambda ws: _let(window(ws), repeated))


def signals(docs: DataFrame, carry: list[str] = ()) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, ``carry`` and the counts of every whole text; null texts count as empty."""
    text = text_of()
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select("doc_id", "lang", "source", *carry, text.alias("_text"), words.alias("_words"), lines.alias("_lines"))
    return rows.select(
        "doc_id", "lang", "source", *carry,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words")).cast("long").alias("n_repeat_words"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_count("_text", F.lit("[!?]")).cast("long").alias("n_marks"),
    )


def _values() -> dict[str, Column]:
    def share(part, of, scale=1000):
        return F.when(F.col(of) > 0, F.floor(F.col(part) * scale / F.col(of))).otherwise(F.lit(0)).cast("long")

    return {
        "symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"), "capitals": share("n_capitals", "word_chars"),
        "marks": share("n_marks", "word_chars"), "word_length": share("word_chars", "n_words", 100),
    }


def bucket(value: str) -> Column:
    """The lower end of the sketch's bucket that a value falls into."""
    shift = f"greatest(0, length(bin({value})) - {BITS})"
    return F.expr(f"shiftleft(shiftright({value}, {shift}), {shift})")


def sketch(rows: DataFrame) -> DataFrame:
    """``(lang, source, signal, bucket, n)`` of rows with a column per signal.

    A histogram over buckets of bounded relative width. Sketches merge by adding up ``n``; tasks
    do so before the shuffle, so a source of any size arrives as a few hundred rows.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("signal"), F.col(s).alias("value")) for s in SIGNALS]))
    flat = rows.select("lang", "source", pairs.alias("p")).select("lang", "source", "p.signal", "p.value")
    return flat.groupBy("lang", "source", "signal", bucket("value").alias("bucket")).agg(F.count("*").alias("n"))


def quartiles(sketches: DataFrame, group: list[str]) -> DataFrame:
    """Per group, ``q1_<signal>`` and ``q3_<signal>`` of the group's merged sketch, and ``docs``."""
    merged = sketches.groupBy(*group, "signal", "bucket").agg(F.sum("n").alias("n"))
    one = Window.partitionBy(*group, "signal")
    upto = one.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.withColumns({"_upto": F.sum("n").over(upto), "_all": F.sum("n").over(one)})
    quartile = lambda k: F.min(F.when(F.col("_upto") * 4 >= F.col("_all") * k, F.col("bucket")))
    ends = ranked.groupBy(*group, "signal").agg(quartile(1).alias("q1"), quartile(3).alias("q3"), F.max("_all").alias("docs"))
    of = lambda s, c: F.max(F.when(F.col("signal") == s, F.col(c))).alias(f"{c}_{s}")
    return ends.groupBy(*group).agg(*[of(s, c) for s in SIGNALS for c in ("q1", "q3")], F.max("docs").alias("docs"))


def thresholds(sketches: DataFrame) -> DataFrame:
    """One row of fences per (lang, source), ``high_<signal>`` and ``low_<signal>``.

    The quartiles of the source, drawn towards those of its language, and these towards the corpus's, widened by
    ``SPREADS`` spreads. The spread is that between the quartiles, or the signal's least one.
    """
    names = [f"{c}_{s}" for s in SIGNALS for c in ("q1", "q3")]

    def named(df, prefix):
        return df.select(*[c for c in ("lang", "source") if c in df.columns], *[F.col(c).alias(prefix + c) for c in [*names, "docs"]])

    own = named(quartiles(sketches, ["lang", "source"]), "o_")
    lang = named(quartiles(sketches, ["lang"]), "l_").withColumnRenamed("lang", "_lang")
    corpus = named(quartiles(sketches, []), "c_")
    rows = own.join(lang, F.col("lang").eqNullSafe(F.col("_lang"))).crossJoin(F.broadcast(corpus))  # the corpus is one row
    k = PRIOR_DOCUMENTS
    rows = rows.withColumns({f"l_{c}": F.expr(f"(l_docs * l_{c} + {k} * c_{c}) div (l_docs + {k})") for c in names})
    rows = rows.withColumns({c: F.expr(f"(o_docs * o_{c} + {k} * l_{c}) div (o_docs + {k})") for c in names})
    reach = {s: F.greatest(F.col(f"q3_{s}") - F.col(f"q1_{s}"), F.lit(least)) * SPREADS for s, least in SIGNALS.items()}
    return rows.select(
        F.col("lang").alias("_l"), F.col("source").alias("_s"), *[(F.col(f"q3_{s}") + reach[s]).alias(f"high_{s}") for s in SIGNALS],
        *[(F.col(f"q1_{s}") - reach[s]).alias(f"low_{s}") for s in LOW_SIDE])


def judge(docs: DataFrame, carry: list[str] = ()) -> DataFrame:
    """The counts of ``signals``, the signals, ``base_failed`` and ``kept`` for every row.

    ``base_failed``: under 50 words, or more than half of the words repeated. Sketches are made
    from the other documents; one of these is kept if all its signals lie within the fences of
    its language and source. Null languages and sources are groups of their own. Repeated rows
    are judged each; an empty table gives no rows.
    """
    counts = signals(docs, carry).withColumns(_values())
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    # The counts are stored: both the sketches and the join read them.
    rows = materialise(counts.withColumn("base_failed", failed), "quality-signals")
    limits = thresholds(sketch(rows.filter(~F.col("base_failed"))))
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    good = ~F.col("base_failed")
    for s in SIGNALS:
        good = good & F.coalesce(F.col(s) <= F.col(f"high_{s}"), F.lit(True))
    for s in LOW_SIDE:
        good = good & F.coalesce(F.col(s) >= F.col(f"low_{s}"), F.lit(True))
    return joined.withColumn("kept", good).drop("_l", "_s")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns as they are."""
    whole = docs.select("doc_id", "text", "lang", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    return judge(whole, ["_doc"]).filter("kept").select("_doc.*")
