"""Shards of near-equal size that split no group: minimax contiguous partition of the groups.

Groups, the rows of one text, stand in the order of the text's hash. The smallest capacity for
which cutting greedily needs no more than the wanted shards is found by binary search over
capacities; the cuts are where greedy cutting with that capacity makes them.

The search runs on sums over ranges of hashes. A range in which a cut may fall is split into finer
ranges until it holds a single group. So the driver sees a few thousand sums at a time, never the
groups, and still finds what a search over all groups would.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import running_before, text_of
from tickloom.session import materialise

DIGITS = 3
FINER = 2
HASH = 32


def greedy(ends: np.ndarray, shards: int, capacity: int, whole: np.ndarray | None = None) -> np.ndarray:
    """Where greedy cutting ends each shard, as a running sum over ranges that end at ``ends``.

    Without ``whole`` no range is split, which may cut too early; with it, ranges that it does not
    mark are cut anywhere, which may cut too late. Feasible if the last cut is the last end.
    """
    at, out = 0, []
    for _ in range(shards):
        reach = at + capacity
        i = int(np.searchsorted(ends, reach, "right"))
        at = max(at, int(ends[i - 1])) if i else at
        if whole is not None and i < len(ends) and not whole[i]:
            at = reach
        out.append(at)
    return np.array(out)


def least_capacity(ends: np.ndarray, shards: int, low: int, whole: np.ndarray | None = None) -> int:
    """Binary search for the smallest feasible capacity from ``low`` on."""
    high = int(ends[-1])
    while low < high:
        middle = (low + high) // 2
        if greedy(ends, shards, middle, whole)[-1] < ends[-1]:
            low = middle + 1
        else:
            high = middle
    return low


def partition(groups: DataFrame, shards: int) -> tuple[list[str], int]:
    """From ``(key, bytes)`` per group, the keys at which shards 1, 2, ... begin, and the capacity.

    Fewer than ``shards - 1`` keys come back when the last shards are empty.
    """
    spark = groups.sparkSession

    def sums(df, digits):
        rows = df.groupBy(F.substring("key", 1, digits).alias("k")).agg(F.sum("bytes").alias("b"), F.count("*").alias("n"))
        return [(r["k"], r["b"], r["n"]) for r in rows.collect()]

    total, largest = groups.agg(F.sum("bytes"), F.max("bytes")).first()
    if not total:
        return [], 0
    least = max(int(largest), -(-int(total) // shards))
    ranges = sorted(sums(groups, DIGITS))
    while True:
        sizes = np.array([b for _, b, _ in ranges], np.int64)
        ends = np.cumsum(sizes)
        begins, whole = ends - sizes, np.array([n == 1 for _, _, n in ranges])
        open_ = ~whole & (sizes > least)
        if not open_.any():
            late, early = least_capacity(ends, shards, least), least_capacity(ends, shards, least, whole)
            # The capacity lies between the two, so each cut lies between these.
            near, far = greedy(ends, shards, early), greedy(ends, shards, late, whole)
            for a, b in zip(near, far, strict=True):
                open_ |= ~whole & (ends > a) & (begins < b)
        if not open_.any():
            begin_at = {int(b): k for b, (k, _, _) in zip(begins, ranges, strict=True)}
            cuts = [int(c) for c in greedy(ends, shards, late)[:-1] if c < ends[-1]]
            return [begin_at[c] for c in cuts], late
        finer, settled = {}, []
        for row, split in zip(ranges, open_, strict=True):
            if split:
                finer.setdefault(len(row[0]), []).append((row[0],))
            else:
                settled.append(row)
        for digits, chosen in finer.items():
            # No more rows than there are ranges on the driver.
            wanted = spark.createDataFrame(chosen, "_k string")
            inside = groups.join(F.broadcast(wanted), F.substring("key", 1, digits) == F.col("_k"), "left_semi")
            settled += sums(inside, min(HASH, digits + FINER))
        ranges = sorted(settled)


def shard_of(key: Column, begins: list[str]) -> Column:
    shard = F.lit(0)
    for begin in begins:
        shard = shard + (key >= F.lit(begin)).cast("int")
    return shard


def assign(docs: DataFrame, shards: int = 16, carry: list[str] = ()) -> DataFrame:
    """``doc_id``, ``carry``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1; null and empty texts are one group. A group is never
    split, so a shard can be larger than an equal share by what its last group is. Slots of a shard
    run from 0 in the order of the first digits of the text's hash, then of the hash of ``doc_id``,
    so that the rows of one text, however many, are numbered by many tasks. Rows alike in both
    hashes may swap slots. An empty table gives no rows.
    """
    text = text_of()
    rows = docs.select("doc_id", *carry, (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.md5(text).alias("key"))
    rows = materialise(rows, "sized")
    groups = materialise(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    begins, _ = partition(groups, shards)
    order = F.concat(F.substring("key", 1, DIGITS), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    placed = rows.withColumns({"shard": shard_of(F.col("key"), begins), "_order": order, "_one": F.lit(1)})
    placed = running_before(placed, ["shard"], "_order", "_one", "slot", ["key", "size"], DIGITS + FINER)
    return placed.select("doc_id", *carry, "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
