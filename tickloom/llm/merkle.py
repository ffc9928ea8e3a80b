"""Document fingerprints: Merkle trees over pieces, paragraphs and sections, in DataFrame functions only.

A paragraph is a line; its pieces end after punctuation, or after ``PIECE`` characters. A section
ends after a paragraph whose hash begins with 0 or 1, so that an edit moves no other section's
bounds. The hash of a paragraph is that of its pieces' hashes, the hash of a section that of its
paragraphs', and the root that of the sections'. Pieces and separators cover the text, so roots
are equal where texts are.

A fingerprint is ``root SP section|section|...``; a section is ``hash:paragraph;paragraph;...`` with
the first eight digits of its hash; a paragraph is ``piece piece ...`` with 24 bits of each hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import text_of
from tickloom.session import materialise

PIECE = 64
PIECES = rf"[^,.;:!?\n]{{1,{PIECE}}}[,.;:!?]*|[,.;:!?]+"
ROOT = 64


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text that is not null."""

    def paragraph(line):
        hashes = F.transform(F.regexp_extract_all(line, F.lit(PIECES), F.lit(0)), F.md5)
        # One pass of hashing serves the node and the digits shown.
        return F.get(F.transform(F.array(hashes), lambda hs: F.struct(
            F.sha2(F.array_join(hs, ""), 256).alias("node"),
            F.array_join(F.transform(hs, lambda h: F.substring(F.base64(F.unhex(h)), 1, 4)), " ").alias("shown"),
        )), F.lit(0))

    def joined(paragraphs, field):
        ends = F.transform(paragraphs, lambda p: F.concat(p[field], F.when(p["node"] < F.lit("2"), F.lit("|")).otherwise(F.lit(";"))))
        return F.split(F.regexp_replace(F.array_join(ends, ""), r"\|$", ""), r"\|")

    def tree(paragraphs):
        sections = F.zip_with(
            joined(paragraphs, "node"), joined(paragraphs, "shown"),
            lambda node, shown: F.struct(F.sha2(node, 256).alias("node"), shown.alias("shown")))
        return F.get(F.transform(F.array(sections), lambda ss: F.concat(
            F.sha2(F.array_join(F.transform(ss, lambda s: s["node"]), ""), 256), F.lit(" "),
            F.array_join(F.transform(ss, lambda s: F.concat(F.substring(s["node"], 1, 8), F.lit(":"), s["shown"])), "|"),
        )), F.lit(0))

    return F.get(F.transform(F.array(F.transform(F.split(text, "\n"), paragraph)), tree), F.lit(0))


def root(print_: Column) -> Column:
    return F.substring(print_, 1, ROOT)


def _pieces(print_: Column) -> Column:
    shown = F.split(F.substring(print_, ROOT + 2, 1 << 30), "[0-9a-f]{8}:|[ ;|]")
    return F.array_distinct(F.array_remove(shown, ""))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else twice the common pieces over all pieces of both (Dice)."""
    pair = F.array(F.struct(_pieces(a).alias("a"), _pieces(b).alias("b")))
    both = F.get(F.transform(pair, lambda p: F.when(
        F.size(p["a"]) + F.size(p["b"]) > 0,
        F.size(F.array_intersect(p["a"], p["b"])).cast("double") * 2 / (F.size(p["a"]) + F.size(p["b"])).cast("double"),
    ).otherwise(F.lit(0.0))), F.lit(0))
    return F.when(root(a) == root(b), F.lit(1.0)).otherwise(both)


def edits(a: Column, b: Column) -> Column:
    """Where ``b`` differs from ``a``: ``(section, paragraph)`` numbers in ``b``, from 0, of paragraphs that ``a`` lacks.

    Sections with equal hashes are passed over without a look at their paragraphs. Empty for equal roots.
    """
    sections = lambda p: F.split(F.substring(p, ROOT + 2, 1 << 30), r"\|")
    paragraphs = lambda s: F.split(F.substring(s, 10, 1 << 30), ";")
    old = F.array_except(sections(a), sections(b))
    known = F.flatten(F.transform(old, paragraphs))
    found = F.flatten(F.transform(sections(b), lambda s, i: F.when(
        F.array_contains(sections(a), s), F.array().cast("array<struct<section:int,paragraph:int>>")
    ).otherwise(F.array_compact(F.transform(paragraphs(s), lambda p, j: F.when(
        ~F.array_contains(known, p), F.struct(i.alias("section"), j.alias("paragraph"))))))))
    return F.when(root(a) == root(b), F.array().cast("array<struct<section:int,paragraph:int>>")).otherwise(found)


def predecessors(docs: DataFrame) -> DataFrame:
    """``(_null, _id)`` of every distinct ``doc_id``, with ``(_prev_null, _prev_id)`` of the one before and ``_need``.

    ``_need`` is the length of what the document before takes over: half its characters. Ids in
    ascending order, null last; before the first comes the last. Ids are cut into ranges, stored,
    and looked back within a range; the first of a range takes the last of the one before.
    """
    sizes = docs.select(*_key(), F.floor(F.char_length(text_of()) / 2).cast("int").alias("_half"))
    ids = sizes.groupBy("_null", "_id").agg(F.max("_half").alias("_half"))
    ranged = materialise(materialise(ids, "ids").repartitionByRange("_null", "_id").withColumn("_slice", F.spark_partition_id()), "ids")
    row = F.struct("_null", "_id", "_half")
    tails = ranged.groupBy("_slice").agg(F.max(row).alias("_tail"))
    # One row per range, as many as there are shuffle partitions at most.
    ordered = Window.orderBy("_slice")
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tails = tails.select("_slice", F.coalesce(F.lag("_tail").over(ordered), F.last("_tail").over(everything)).alias("_back"))
    behind = F.lag(row).over(Window.partitionBy("_slice").orderBy("_null", "_id"))
    rows = ranged.withColumn("_prev", behind).join(F.broadcast(tails), "_slice")
    before = F.coalesce("_prev", "_back")
    return rows.select("_null", "_id", before["_null"].alias("_prev_null"), before["_id"].alias("_prev_id"), before["_half"].alias("_need"))


def _key() -> list[Column]:
    return [F.col("doc_id").isNull().alias("_null"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id")]


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how near they and the next document's are.

    The edited text is the text with its last ``floor(n_chars / 2)`` characters replaced by the
    first as many of the next document, in ascending ``doc_id``; null texts are empty, null ids
    come last. Of several rows with the next id, the one with the least text hash is taken. A
    document alone is followed by itself. An empty table gives no rows.
    """
    first = F.row_number().over(Window.partitionBy("_null", "_id").orderBy("_h"))
    rows = docs.select(*_key(), text_of().alias("_text"), F.xxhash64(text_of()).alias("_h")).withColumn("_rank", first)
    text = F.col("_text")
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    # Both sides number the rows of an id, and neither says so in a way that lets the optimizer
    # cut one of them down before the shuffle: so they share a single shuffle of the texts by id.
    # What a document hands to the one before it, half as many characters and its fingerprint,
    # is shuffled once more.
    left = rows.filter("_rank >= 1").select(
        "_null", "_id", n.cast("long").alias("n_chars"), half.alias("_half"),
        F.substring(text, F.lit(1), n - half).alias("_begin"), fingerprint(text).alias("fingerprint"))
    right = rows.filter(F.least("_rank", F.lit(2)) == 1).join(predecessors(docs), ["_null", "_id"])
    right = right.select(
        F.col("_prev_null").alias("_null"), F.col("_prev_id").alias("_id"),
        F.substring(text, F.lit(1), F.col("_need")).alias("_end"), fingerprint(text).alias("_next"))
    joined = left.join(right, ["_null", "_id"])
    edited = F.concat("_begin", F.substring("_end", F.lit(1), F.col("_half")))
    doc_id = F.when(~F.col("_null"), F.col("_id")).alias("doc_id")
    joined = joined.select(doc_id, "n_chars", "fingerprint", edited.alias("_edited"), "_next")
    joined = joined.withColumns({"edited_sha256": F.sha2("_edited", 256), "edited_fingerprint": fingerprint(F.col("_edited"))})
    return joined.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"))
