"""Groups of spelling variants by reduced-alphabet generation.

Letters are hashed to eight symbols. Two words one edit apart have reduced words that are equal or one
edit apart. So the one-edit neighbourhood of every distinct *reduced* word is generated, as
polynomial hashes, and joined with the reduced vocabulary. Insertions into one word are deletions from
the other, so the full relation is covered with each pair generated by one side. Pairs of reduced words
become pairs of words, and those are verified on the original strings.

A reduced word that stands for more than ``CROWDED`` words has a bucket too full to compare all of it.
Its words are found in an exact way instead: the full one-edit neighbourhood of the *original* word over
all letters, joined with the vocabulary itself. Nothing is capped.

Defined results: a null text has no words; an id that is null counts as an empty string in the hash of
the contract; a repeated row counts as often as it occurs; a word of any length is compared whole. An
empty table gives no rows. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import bound_batches, slices, text_bytes, text_of
from tickloom.session import materialise

SYMBOLS = 8
CROWDED = 200
LEAST_LENGTH, LEAST_COUNT, FORM_RATIO = 7, 2, 10
DAMAGE = 31
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SECOND = 0xC2B2AE3D27D4EB4F
# Neighbours that a part of a batch may hold, and bytes of the words it is taken from.
_BATCH, _SLICE = 1 << 17, 1 << 18
_LONG = 64


def words(docs: DataFrame, key: str = "doc_id", least: int = LEAST_LENGTH) -> DataFrame:
    """``word, n``: the runs of letters after the contract's damage, of at least ``least`` code points.

    Runs shorter than ``least`` stay so, and are not even cut out. Tasks count before the shuffle, so a
    word that is everywhere arrives as one row per task.
    """
    run = r"[A-Za-zÀ-ÿ]{%d,}" % least
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_id"), F.explode(F.regexp_extract_all(text_of(), F.lit(run), F.lit(0))).alias("_run"))
    runs = runs.select("_id", F.translate("_run", string.ascii_uppercase, string.ascii_lowercase).alias("_run"))
    h = F.crc32(F.concat_ws(":", "_id", "_run").cast("binary"))
    runs = runs.select("_run", h.alias("_h"))
    at = (F.col("_h") % F.length("_run")).cast("int")
    cut = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.length("_run")))
    damaged = runs.select(F.when(F.col("_h") % DAMAGE == 0, cut).otherwise(F.col("_run")).alias("word"))
    return damaged.filter(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))


def _spread(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return values ^ (values >> np.uint64(33))


def _symbols(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in one array, and where each word begins."""
    data, offsets = text_bytes(strings)
    starts = (data & 0xC0) != 0x80
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
    before = np.concatenate([[0], np.cumsum(starts)])
    return points, before[offsets]


def _hash_symbols(points: np.ndarray, symbols: int | None) -> np.ndarray:
    """The symbol of every letter, from 1 on; without ``symbols`` the letter itself."""
    if symbols is None:
        return points
    return (_spread(points * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(symbols) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _places(offsets: np.ndarray) -> np.ndarray:
    return np.arange(offsets[-1]) - np.repeat(offsets[:-1], np.diff(offsets))


def _word_hash(code: np.ndarray, offsets: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hash of every word: the sum of code times base to the place, modulo 2**64."""
    terms = code * _powers(base, int(np.diff(offsets).max(initial=0)) + 1)[_places(offsets)]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def keyed(symbols: int | None = SYMBOLS):
    """A ``mapInArrow`` function: two hashes of the reduced word in front of ``word, n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "word", _SLICE):
                points, offsets = _symbols(batch.column("word"))
                code = _hash_symbols(points, symbols)
                keys = [pa.array(_word_hash(code, offsets, base).view(np.int64)) for base in (_BASE, _SECOND)]
                yield pa.RecordBatch.from_arrays([*keys, *batch.columns], ["reduced", "check", *batch.schema.names])

    return run


def edits(code: np.ndarray, offsets: np.ndarray, alphabet: np.ndarray, full: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Owner and hash of every word and of the strings one edit away, in bounded parts.

    The hash of an edited word follows from the sums before and behind the place of the edit. One
    edit away is a symmetric relation. Without ``full`` every pair is generated by one of its sides: by the
    longer one, which deletes a symbol, or by the one whose symbol is the smaller, which replaces it.
    """
    lengths = np.diff(offsets)
    base = _powers(_BASE, int(lengths.max(initial=0)) + 2)
    places, owner = _places(offsets), np.repeat(np.arange(len(lengths)), lengths)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(code * base[places], dtype=np.uint64)])
    whole = sums[offsets[1:]] - sums[offsets[:-1]]
    words_ = np.arange(len(lengths))
    yield words_, whole
    # Deleting any symbol of a run gives the same string; the last one stands for all.
    last = np.ones(len(code), bool)
    last[:-1] = (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])
    step = max(1, _BATCH // (2 * len(alphabet) + 1))
    for low in range(0, len(code), step):
        at = np.arange(low, min(low + step, len(code)))
        mine, symbol, power = owner[at], code[at], base[places[at]]
        before, all_ = sums[at] - sums[offsets[mine]], whole[mine]
        gone = last[at]
        yield mine[gone], (before + (all_ - before - symbol * power) * np.uint64(_INVERSE))[gone]
        other = alphabet[None, :] != symbol[:, None] if full else alphabet[None, :] > symbol[:, None]
        yield np.repeat(mine, other.sum(1)), (all_[:, None] + (alphabet[None, :] - symbol[:, None]) * power[:, None])[other]
        if full:
            put = (before + (all_ - before) * np.uint64(_BASE))[:, None] + alphabet[None, :] * power[:, None]
            yield np.repeat(mine, len(alphabet)), put.ravel()
    if full:
        yield np.repeat(words_, len(alphabet)), (whole[:, None] + alphabet[None, :] * base[lengths][:, None]).ravel()


def neighbourhoods(alphabet: np.ndarray, symbols: int | None, keep: str, full: bool):
    """A ``mapInArrow`` function: ``near, <keep>`` for what :func:`edits` gives of ``word``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "word", _SLICE):
                points, offsets = _symbols(batch.column("word"))
                for owner, near in edits(_hash_symbols(points, symbols), offsets, alphabet, full):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(near.view(np.int64)), batch.column(keep).take(pa.array(owner))], ["near", keep])

    return run


def _verified(a: Column, b: Column) -> Column:
    """Exactly one inserted, deleted or replaced code point.

    The built-in distance takes time that grows with the square of the length. So long words are compared
    behind the first place where they differ.
    """
    by = F.length(a) - F.length(b)
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y)
    first = F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)), F.least(F.length(a), F.length(b)) + 1).cast("int")
    rest = lambda word, skip: F.substring(word, first + skip, F.length(word))
    one = rest(a, F.when(by >= 0, 1).otherwise(0)) == rest(b, F.when(by <= 0, 1).otherwise(0))
    return (F.abs(by) <= 1) & F.when(F.length(a) <= _LONG, F.levenshtein(a, b, 1) == 1).otherwise((a != b) & one)


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """``word, n, other, other_n`` for every ordered pair of words one edit apart, each once.

    ``vocabulary`` has distinct words and their ``n``. A pair of words that both stand in roomy
    buckets comes from those, any other pair from the neighbourhood of a crowded word.
    """
    spark = vocabulary.sparkSession
    bound_batches(spark)
    keys = "reduced bigint, check bigint, word string, n bigint"
    listed = materialise(vocabulary.select("word", "n").mapInArrow(keyed(), keys), "reduced")
    sizes = materialise(listed.groupBy("reduced", "check").agg(F.min("word").alias("word"), F.count("*").alias("_size")), "reduced-sizes")
    crowd = sizes.select("reduced", "check", (F.col("_size") > CROWDED).alias("_crowded"))
    marked = materialise(listed.join(crowd, ["reduced", "check"]).drop("check"), "reduced-marked")
    roomy, crowded = marked.filter("NOT _crowded").drop("_crowded"), marked.filter("_crowded").select("word", "n")

    symbols = np.arange(1, SYMBOLS + 1, dtype=np.uint64)
    one_each = sizes.filter(F.col("_size") <= CROWDED).select("reduced", "word")
    # The input is far smaller than what comes out of it, so it is dealt to all tasks.
    dealt = one_each.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    near = dealt.mapInArrow(neighbourhoods(symbols, SYMBOLS, "reduced", full=False), "near bigint, reduced bigint")
    # Pairs of reduced words that both occur.
    links = materialise(near.join(one_each.select(F.col("reduced").alias("near")).distinct(), "near").distinct(), "reduced-links")
    other = roomy.select(F.col("reduced").alias("near"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = roomy.join(links, "reduced").join(other, "near")
    # Words with one reduced word meet in both orders, all others in one.
    pairs = pairs.filter((F.col("reduced") != F.col("near")) | (F.col("word") < F.col("other")))
    pairs = pairs.filter(_verified(F.col("word"), F.col("other"))).select("word", "n", "other", "other_n")

    letters = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint64)
    # Hashes of original words this time; the strings are compared in the end all the same.
    exact = crowded.select("word", F.struct("word", "n").alias("_from")).mapInArrow(
        neighbourhoods(letters, None, "_from", full=True), "near bigint, _from struct<word: string, n: bigint>").distinct()
    named = marked.select("_crowded", "word", "n").mapInArrow(keyed(None), "reduced bigint, check bigint, _crowded boolean, word string, n bigint")
    found = named.join(exact, F.col("reduced") == F.col("near")).filter(_verified(F.col("word"), F.col("_from.word")))
    found = found.select("word", "n", F.col("_from.word").alias("other"), F.col("_from.n").alias("other_n"), "_crowded")
    # Two crowded words find each other; a roomy one is found only.
    both = F.when(F.col("_crowded"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    return _turned(pairs.withColumn("_turn", F.explode(F.array(F.lit(False), F.lit(True))))).unionByName(
        _turned(found.withColumn("_turn", F.explode(both))))


def _turned(pairs: DataFrame) -> DataFrame:
    """Pairs marked ``_turn`` the other way round."""
    names = {"word": "other", "n": "other_n", "other": "word", "other_n": "n"}
    return pairs.select(*[F.when(F.col("_turn"), F.col(b)).otherwise(F.col(a)).alias(a) for a, b in names.items()])


def forms(vocabulary: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n``: for every word its near word of largest ``n``, if that is large enough."""
    best = near_pairs(vocabulary).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("_best"))
    rows = vocabulary.select("word", "n").join(best, "word", "left")
    much = -F.col("_best.minus") >= FORM_RATIO * F.col("n")
    return rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(much, F.col("_best.other")).alias("form"), F.when(much, -F.col("_best.minus")).alias("form_n"))


def with_roots(rows: DataFrame) -> DataFrame:
    """Add ``root``: from a word along the forms to the last one; the word itself if it has none.

    Each step multiplies ``n`` by ten at least, so no path is longer than 18; looking twice as far
    in each round, five rounds follow any.
    """
    steps = materialise(rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms")
    for _ in range(5):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = steps.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        moved = materialise(moved, "roots")
        steps = moved.drop("_moved")
        if moved.filter("_moved").isEmpty():
            break
    return rows.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Words of at least seven letters and two occurrences, with their form and root."""
    vocabulary = materialise(words(docs, key).filter(F.col("n") >= LEAST_COUNT), "vocabulary")
    return with_roots(materialise(forms(vocabulary), "word-forms")).select("word", "form", "root", "n", "n_near", "form_n")
