"""Long repeats between documents, found and removed by recompression.

A sequence of words is rewritten round by round: a run of equal symbols becomes one symbol, then
pairs of a left and a right symbol do, the sides being dealt by hash anew in every round. A symbol's name
is a hash of what it stands for, so all tasks give equal content one name, whatever is around it.
Equal windows of words therefore agree in all symbols but those at their ends, which might
still join something outside. Round by round these end symbols are taken off; the ones taken off and those
left in the last round spell the window. Of those left, the neighbours with the least hash are its *anchor*:
a window's anchor does not depend on its surroundings, and windows that overlap mostly share it.

Spark's rounds work on the symbols: all documents' anchors are counted by name, and those in one document
only are done with. Neighbouring windows with one anchor form a block. Blocks are compared by name and
content over all documents; a block that also begins in a smaller document is a repeat as a whole, so a
long repeat takes few rows, and a passage that very many documents share one row per task. Only where a
name goes with several contents, at the edges of repeats, single windows are compared. Both are told apart by
128 bits: a block by its name and its content, a window by its spelling and a polynomial over its words.

Defined results: a null text has no words; a null id counts as larger than any other, and rows with
the same id do not remove each other's words; a text shorter than the window keeps all. Texts of any
length are gone through whole, a bounded number of windows at a time. An empty table gives no rows. Only the id and
the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import bound_batches, mix, slices, span_hashes, text_bytes, text_of, word_spans
from tickloom.session import materialise

WINDOW = 50
# Three rounds leave about 16 of 50 words' symbols. More make anchors longer but windows share them less: with five
# rounds there were twice as many blocks. An anchor is JOINT neighbouring symbols, about twelve words. A window
# that would be left with fewer than FEW (runs, short periods) takes its anchor a round earlier.
ROUNDS, JOINT = 3, 5
FEW = JOINT + 2
# Windows worked on at once.
CHUNK = 1 << 17
_A, _B, _K = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_ONE = np.uint64(1)


def _salt(level: int) -> np.uint64:
    return np.uint64(level * int(_B) % (1 << 64))


# -- rounds ---------------------------------------------------------------------------------


def name_runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sequence with every run of equal symbols as one; for each symbol its run, and where runs begin."""
    new = np.ones(len(symbols), bool)
    new[1:] = symbols[1:] != symbols[:-1]
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(symbols))).astype(np.uint64)
    named = np.where(size > 1, mix(symbols[begin] * _A + size * _B + _K), symbols[begin])
    return named, np.cumsum(new) - 1, begin


def sides(symbols: np.ndarray, level: int) -> np.ndarray:
    """True for right symbols, by a hash that differs from round to round."""
    return (mix(symbols + _salt(level + 1)) >> np.uint64(40)) & _ONE == _ONE


def name_pairs(symbols: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sequence with every left symbol before a right one joined with it; for each symbol its new place."""
    first = np.zeros(len(symbols), bool)
    first[:-1] = ~right[:-1] & right[1:]
    stays = np.ones(len(symbols), bool)
    stays[1:] = ~first[:-1]
    named = symbols.copy()
    at = np.flatnonzero(first)
    named[at] = mix(symbols[at] * _A + symbols[at + 1] * _B + _ONE)
    return named[stays], np.cumsum(stays) - 1, np.flatnonzero(stays)


def _contract(symbols, begin, left, right, spelled, level):
    """One round: the shorter sequence, and for each window its range in it and what is spelled so far."""
    named, run, run_begin = name_runs(symbols)
    run_end = np.append(run_begin[1:], len(symbols))
    first, last = run[left], run[right - 1]
    alone = first == last
    count = (np.minimum(run_end[first], right) - left).astype(np.uint64)
    spelled = spelled * _K + mix(symbols[left] * _A + count * _B)
    count = np.where(alone, 0, right - np.maximum(run_begin[last], left)).astype(np.uint64)
    spelled = spelled * _K + np.where(alone, _ONE, mix(symbols[right - 1] * _A + count * _B))
    left = first + 1
    right = np.maximum(last, left)

    is_right = sides(named, level)
    there = right > left
    # Where a range is empty the look-up must not leave the sequence; its result is not used.
    safe = np.minimum(left, len(named) - 1)
    off = there & is_right[safe]
    spelled = spelled * _K + np.where(off, named[safe], _ONE)
    left = left + off
    safe = right - 1
    off = (right > left) & ~is_right[safe]
    spelled = spelled * _K + np.where(off, named[safe], _ONE)
    right = right - off
    joined, place, kept = name_pairs(named, is_right)
    there = right > left
    new_left = place[np.minimum(left, len(named) - 1)]
    new_right = np.where(there, place[np.maximum(right - 1, 0)] + 1, new_left)
    return joined, begin[run_begin][kept], new_left, new_right, spelled


def parse(words: np.ndarray, starts: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window of ``width`` words: the name of its anchor, the word it begins at, and its spelling.

    Name, the anchor's place within the window and spelling depend on the words of the window alone.
    """
    anchor, place, spelling = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.int64), np.zeros(len(starts), np.uint64)
    symbols, begin, live = words, np.arange(len(words)), np.arange(len(starts))
    left, right, spelled, level = starts, starts + width, np.zeros(len(starts), np.uint64), 0
    while len(live):
        if level < ROUNDS:
            symbols_, begin_, left_, right_, spelled_ = _contract(symbols, begin, left, right, spelled, level)
        done = (right_ - left_ < FEW) if level < ROUNDS else np.ones(len(live), bool)
        at, low, high, text = live[done], left[done], right[done], spelled[done]
        # Neighbouring symbols by one hash; the least hash in the window is its anchor.
        joint = symbols.copy()
        for step in range(1, JOINT):
            joint[:-step] = mix(joint[:-step] * _A + symbols[step:] * _B)
        short = high - low < JOINT  # of a narrow window: then all symbols together
        best, where = np.where(short, _ONE, joint[low]), low
        for step in range(int((high - low).max(initial=0))):
            inside = low + step < high
            here = np.where(inside, low + step, low)
            text = np.where(inside, text * _K + mix(symbols[here]), text)
            best = np.where(short & inside, best * _K + mix(symbols[here]), best)
            less = (joint[here] < best) & (low + step + JOINT <= high)
            best, where = np.where(less, joint[here], best), np.where(less, here, where)
        anchor[at], place[at], spelling[at] = best, begin[where], mix(text + _salt(level))
        rest = ~done
        if not rest.any():
            break
        symbols, begin, left, right, spelled, live = symbols_, begin_, left_[rest], right_[rest], spelled_[rest], live[rest]
        level += 1
    return anchor, place, spelling


def polynomial(words: np.ndarray, starts: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """A hash of the words of every window that does not come from the rounds."""
    out = np.zeros(len(starts), np.uint64)
    words = mix(words ^ _B)
    for step in range(width):
        out = out * _B + words[starts + step]
    return mix(out)


# -- blocks of a batch ------------------------------------------------------------------------


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, begin and end of the words, the number of words before each text, and their hashes."""
    data, offsets = text_bytes(texts)
    starts, ends, before = word_spans(data, offsets)
    return data, starts, ends, before, mix(span_hashes(data, starts, ends) + (ends - starts).astype(np.uint64) * _A)


def _window_starts(before: np.ndarray, width: int) -> np.ndarray:
    sizes = np.maximum(np.diff(before) - width + 1, 0)
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(before[:-1] - (ends - sizes), sizes)


def blocks(words: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows with one anchor: its name, a hash of all their words, the first window, their number."""
    out = [[], [], [], []]
    for low in range(0, len(starts), CHUNK):
        part = starts[low : low + CHUNK]
        base = part[0]
        near, part = words[base : part[-1] + width], part - base
        name, place, spelling = parse(near, part, width)
        other = polynomial(near, part, width)
        new = np.ones(len(part), bool)
        new[1:] = (name[1:] != name[:-1]) | (place[1:] != place[:-1]) | (part[1:] != part[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(part)) - 1
        size = (last - first + 1).astype(np.uint64)
        # The first and the last window of a block cover its words, as both hold the anchor.
        content = mix(spelling[first] * _A + mix(spelling[last] * _B + size)) ^ mix(other[first] * _K + mix(other[last] * _A + size))
        for store, values in zip(out, (name[first], content, part[first] + base, size.astype(np.int64)), strict=True):
            store.append(values)
    kinds = (np.uint64, np.uint64, np.int64, np.int64)
    return tuple(np.concatenate(x) if x else np.zeros(0, kind) for x, kind in zip(out, kinds, strict=True))


_signed = lambda x: pa.array(x.view(np.int64))


def _find_blocks(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                _, _, _, before, words = _words(batch.column("text"))
                name, content, first, size = blocks(words, _window_starts(before, width), width)
                text = np.searchsorted(before, first, "right") - 1
                ids = [batch.column(c).take(pa.array(text)) for c in ("rank", "text_key")]
                yield pa.RecordBatch.from_arrays(
                    [_signed(name), _signed(content), *ids, pa.array((first - before[text]).astype(np.int32)), pa.array(size.astype(np.int32))],
                    ["name", "content", "rank", "text_key", "first", "size"])

    return run


def _find_windows(width: int):
    """Single windows of the blocks in ``listed``, each with its first window and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                _, _, _, before, words = _words(batch.column("text"))
                lists = batch.column("listed")
                owner = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
                entries = lists.flatten()
                size = np.asarray(entries.field("size")).astype(np.int64)
                of = np.repeat(np.arange(len(size)), size)
                step = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
                position = np.asarray(entries.field("first")).astype(np.int64)[of] + step
                starts = position + before[owner][of]
                for low in range(0, len(starts), CHUNK):
                    part = slice(low, low + CHUNK)
                    # Only the words that these windows cover are rewritten.
                    used = np.zeros(len(words) + 1, np.int64)
                    np.add.at(used, starts[part], 1)
                    np.add.at(used, starts[part] + width, -1)
                    covered = np.cumsum(used[:-1]) > 0
                    at = (np.cumsum(covered) - 1)[starts[part]]
                    _, _, spelling = parse(words[covered], at, width)
                    ids = [batch.column(c).take(pa.array(owner[of[part]])) for c in ("rank", "text_key")]
                    yield pa.RecordBatch.from_arrays(
                        [_signed(spelling), _signed(polynomial(words[covered], at, width)), *ids, pa.array(position[part].astype(np.int32))],
                        ["window", "window_hash", "rank", "text_key", "first"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and adjacent spans of a text as one."""
    for batch in batches:
        lists = batch.column("spans")
        owner = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
        entries = lists.flatten()
        begin, end = (np.asarray(entries.field(c)).astype(np.int64) for c in ("begin", "end"))
        order = np.lexsort((begin, owner))
        owner, begin, end = owner[order], begin[order], end[order]
        # Furthest end so far within a text: owners are kept apart by a stride beyond every end.
        stride = int(end.max(initial=0)) + 1
        reach = np.maximum.accumulate(end + owner * stride) if len(end) else end
        new = np.ones(len(end), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (begin[1:] + owner[1:] * stride > reach[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(end)) - 1
        offsets = np.searchsorted(owner[first], np.arange(batch.num_rows + 1))
        spans = pa.StructArray.from_arrays([pa.array(begin[first]), pa.array((reach - owner * stride)[last])], ["begin", "end"])
        yield pa.RecordBatch.from_arrays(
            [batch.column("rank"), batch.column("text_key"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)], ["rank", "text_key", "spans"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words that ``spans`` cover."""
    for whole in batches:
        for batch in slices(whole, "text"):
            data, offsets = text_bytes(batch.column("text"))
            starts, ends, before = word_spans(data, offsets)
            spans = batch.column("spans")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(spans.offsets))) if len(spans) else np.zeros(0, np.int64)
            entries = spans.flatten()
            change = np.zeros(len(starts) + 1, np.int64)
            np.add.at(change, np.asarray(entries.field("begin")) + before[owner], 1)
            np.add.at(change, np.asarray(entries.field("end")) + before[owner], -1)
            keep = np.cumsum(change[:-1]) == 0
            kept_before = np.concatenate([[0], np.cumsum(keep)])[before]
            # Every kept word with one more place for the space behind it.
            begin, length = starts[keep], ends[keep] - starts[keep] + 1
            stops = np.cumsum(length)
            at = np.arange(stops[-1] if len(stops) else 0) + np.repeat(begin - (stops - length), length)
            joined = np.append(data, np.uint8(0x20))[at]
            joined[stops - 1] = 0x20
            edges = np.concatenate([[0], stops])[kept_before].tolist()
            raw = joined.tobytes()
            texts = [raw[a : b - 1] if b > a else b"" for a, b in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays([
                batch.column("_key"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(np.diff(before)),
                pa.array(np.diff(before) - np.diff(kept_before)),
            ], ["key", "kept", "n_words", "n_removed"])


# -- the job --------------------------------------------------------------------------------------


def _ranked(docs: DataFrame, key: str) -> DataFrame:
    rank = F.coalesce(F.col(key).cast("bigint"), F.lit((1 << 63) - 1))
    return docs.select(F.col(key).alias("_key"), rank.alias("rank"), F.xxhash64(text_of()).alias("text_key"), text_of().alias("text"))


def _join(left: DataFrame, right: DataFrame, keys: list[str], total: int, how: str = "inner") -> DataFrame:
    """Join with a frame that has each key once, and in ``_n`` how many of the ``total`` rows on the left have it.

    Keys with more than a thousandth of the rows would each be one task's work. There are fewer than a thousand
    of them, whatever the size of the tables, so their part of the right side is broadcast, and the rows
    stay where they are. All others are shuffled, always: plans are the same at every size.
    """
    hot, cold = right.filter(F.col("_n") > total / 1000).drop("_n"), right.filter(F.col("_n") <= total / 1000).drop("_n")
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return left.join(F.broadcast(hot), keys, how).unionByName(rest.join(cold.hint("merge"), keys, how))


def repeats(docs: DataFrame, key: str = "doc_id", width: int = WINDOW) -> DataFrame:
    """``rank, text_key, spans``: of each text the spans of words in windows that begin in a document with a smaller id, too.

    ``rank`` is the id (the largest long for a null), ``text_key`` a hash that tells texts with one id apart.
    """
    bound_batches(docs.sparkSession)
    ranked = _ranked(docs, key).select("rank", "text_key", "text")
    ids = "rank bigint, text_key bigint"
    found = materialise(ranked.mapInArrow(_find_blocks(width), f"name bigint, content bigint, {ids}, first int, size int"), "blocks")
    # First round over all documents: names that more than one document has.
    least_most = (F.min("rank").alias("_least"), F.max("rank").alias("_most"), F.count("*").alias("_n"))
    shared = materialise(found.groupBy("name").agg(*least_most).filter("_least < _most").select("name", "_n"), "shared-names")
    found = materialise(_join(found, shared, ["name"], found.count(), "left_semi"), "shared-blocks")
    # Second: contents of a name, and the least document of each.
    total = found.count()
    contents = materialise(found.groupBy("name", "content").agg(F.min("rank").alias("_least"), F.count("*").alias("_n")), "contents")
    several = contents.groupBy("name").agg(F.count("*").alias("_contents"), F.sum("_n").alias("_n")).filter("_contents > 1").select("name", "_n")
    found = _join(found, contents, ["name", "content"], total)
    span = lambda first, size: F.struct(first.cast("bigint").alias("begin"), (first + size + (width - 1)).cast("bigint").alias("end"))
    whole = found.filter("rank > _least").select("rank", "text_key", span(F.col("first"), F.col("size")).alias("span"))
    # Third: where contents differ, the windows of the blocks that come first with theirs.
    edges = _join(found.filter("rank = _least"), materialise(several, "several"), ["name"], total, "left_semi")
    listed = edges.groupBy("rank", "text_key").agg(F.collect_set(F.struct("first", "size")).alias("listed"))
    texts = ranked.join(materialise(listed, "edges").hint("merge"), ["rank", "text_key"]).select("rank", "text_key", "text", "listed")
    windows = materialise(texts.mapInArrow(_find_windows(width), f"window bigint, window_hash bigint, {ids}, first int"), "windows")
    least = windows.groupBy("window", "window_hash").agg(*least_most).filter("_least < _most").drop("_most")
    hits = _join(windows, materialise(least, "least"), ["window", "window_hash"], windows.count()).filter("_least < rank")
    spans = whole.unionByName(hits.select("rank", "text_key", span(F.col("first"), F.lit(1)).alias("span")))
    together = spans.groupBy("rank", "text_key").agg(F.collect_set("span").alias("spans"))
    return together.mapInArrow(_merge, f"{ids}, spans array<struct<begin: bigint, end: bigint>>")


def without_repeats(docs: DataFrame, key: str = "doc_id", width: int = WINDOW) -> DataFrame:
    """``<key>, kept, n_words, n_removed`` for every row: its words that are not part of such a window, joined by one space."""
    spans = materialise(repeats(docs, key, width), "spans")
    rows = _ranked(docs, key).join(spans.hint("merge"), ["rank", "text_key"], "left").select("_key", "text", "spans")
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(_cut, f"key {kind}, kept string, n_words bigint, n_removed bigint").withColumnRenamed("key", key)
