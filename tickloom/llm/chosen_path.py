"""Documents whose sets of word 5-grams have a Jaccard similarity of 0.8 or more, by chosen paths.

A set follows a path by sampling some of its tokens with a hash that all sets share: sets that
have a token in common, and sample it, come into the bucket of that token. Small buckets are
compared by brute force, on sketches. A bucket that is too large is split again on further
sampled tokens, and at the last level compared block by block. The runs, each with hash functions of its own,
are as many as the target recall asks for if no bucket is split; sets that had to go on from a split one go through
as many more as it asks for if every bucket is split to the last level. What the sketches leave as possible links is put into connected components, and the
exact similarity of all pairs in a component is then worked out, in blocks.

In a large bucket its first set is a pivot. All that may be near the pivot is tied to it, and what
is as near as a link goes no further: whatever that could link to is, by the triangle inequality
of the Jaccard distance, near enough to the pivot to be tied to it as well. So dense groups of
near copies leave the recursion at once, and need no further runs: a bucket that a set leaves this
way has met all its links.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import bound_batches, mix, slices, span_hashes, text_bytes, text_of, word_spans
from tickloom.session import materialise

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9995
BINS = 128
BRANCH = 1.25
SMALL = 2000
DEPTH = 7
# The estimate of the similarity to a pivot from which a set goes no further.
ABSORBED = 0.68
BLOCK_TEXTS, BLOCK_TOKENS = 2000, 1_000_000
# Two blocks of so many sets are compared at once where a bucket is not split any more.
BLOCK_SETS = 1000


def missed(runs: int, splits: int, similarity: float = SIMILARITY) -> float:
    """Probability that a pair meets in no bucket after ``runs`` runs whose buckets are split ``splits`` times more.

    In one run the pair samples a Poisson number of common tokens, at the least similarity and
    the least favourable sizes ``similarity * BRANCH`` on average: one set holds the other. Each of
    its buckets that is split leads to a Poisson number of common finer ones. All runs use the same
    sketches, so the mean goes over the bins in which these agree.
    """
    total = 0.0
    for same in range(BINS + 1):
        odds = math.comb(BINS, same) * similarity**same * (1 - similarity) ** (BINS - same)
        alive = 1.0
        for _ in range(splits):
            alive = -math.expm1(-BRANCH / SIMILARITY * same / BINS * alive)
        total += odds * math.exp(-runs * similarity * BRANCH * alive)
    return total


def runs_for(recall: float, similarity: float = SIMILARITY, splits: int = DEPTH - 1) -> int:
    """Runs after which a pair has met with the given probability; by default also where all its buckets are split to the last level."""
    runs = 1
    while missed(runs, splits, similarity) > 1 - recall:
        runs += 1
    return runs


def shingles(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit tokens of every text, and for each text the number of tokens before its own.

    A text of fewer than five words, but one at least, has all its words as its one token.
    """
    data, offsets = text_bytes(strings)
    starts, ends, before = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    counts = np.diff(before)
    n = len(words)
    doc = np.repeat(np.arange(len(counts)), counts)
    turn = np.arange(n) - np.repeat(before[:-1], counts)
    length = np.minimum(counts, WORDS)[doc] if n else np.zeros(0, np.int64)
    whole = turn + length <= counts[doc] if n else np.zeros(0, bool)
    token = np.zeros(n, np.uint64)
    for k in range(WORDS):
        part = np.zeros(n, np.uint64)
        part[: n - k] = words[k:]
        token = token * np.uint64(0x9E3779B97F4A7C15) + np.where(k < length, part, np.uint64(0))
    token, doc = mix(token[whole]), doc[whole]
    cuts = np.searchsorted(doc, np.arange(len(counts) + 1))
    parts = [np.unique(token[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.append(0, np.cumsum(sizes))


def sketches(tokens: np.ndarray, before: np.ndarray) -> np.ndarray:
    """A byte for each of ``BINS`` parts of the token space: of its least token, 0 where there is none."""
    n = len(before) - 1
    doc = np.repeat(np.arange(n), np.diff(before))
    least = np.full(n * BINS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, doc * BINS + (tokens & np.uint64(BINS - 1)).astype(np.int64), tokens >> np.uint64(7))
    byte = (mix(least) % np.uint64(255)).astype(np.uint8) + 1
    byte[least == np.iinfo(np.uint64).max] = 0
    return byte.reshape(n, BINS)


def likeness(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of sketches, row by row, and the number of bins it rests on."""
    used = ((a | b) != 0).sum(1)
    return ((a == b) & (a != 0)).sum(1) / np.maximum(used, 1), used


def _paths(tokens: np.ndarray, before: np.ndarray, runs: range) -> list[np.ndarray]:
    """The buckets of every set after the first split of each of the runs."""
    sizes = np.diff(before)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    limit = np.minimum(BRANCH / np.maximum(sizes, 1) * 2.0**32, 2.0**32 - 1).astype(np.uint64)[doc]
    out, owner = [], []
    for run in runs:
        salt = np.uint64((0x9E3779B97F4A7C15 * (2 * run + 1)) & 0xFFFFFFFFFFFFFFFF)
        code = (tokens ^ salt) * np.uint64(0xD6E8FEB86659FD93)
        hit = np.flatnonzero((code >> np.uint64(32)) <= limit)
        out.append(mix(tokens[hit] ^ mix(salt + np.zeros(len(hit), np.uint64))))
        owner.append(doc[hit])
    out, owner = np.concatenate(out), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(1, len(sizes)))
    return np.split(out[order].view(np.int64), cuts)


def _prepare(docs: DataFrame, recall: float) -> DataFrame:
    """Per row: ``row``, ``doc_id``, ``key`` of the text, size of its set, sketch and buckets; stored.

    ``paths`` are the buckets of the runs that are enough where none is split, ``more`` those of all further runs.
    """
    first, all_ = runs_for(recall, splits=0), runs_for(recall)

    def build(batches):
        for whole in batches:
            for batch in slices(whole, "_text"):
                tokens, before = shingles(batch.column("_text"))
                paths, more = ([p.tolist() for p in _paths(tokens, before, runs)] for runs in (range(first), range(first, all_)))
                sketch = [s.tobytes() for s in sketches(tokens, before)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), batch.column("key"), pa.array(np.diff(before)),
                    pa.array(sketch, pa.binary()), pa.array(paths, pa.list_(pa.int64())), pa.array(more, pa.list_(pa.int64())),
                ], ["doc_id", "key", "tokens", "sketch", "paths", "more"])

    text = text_of()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("key"), text.alias("_text"))
    rows = rows.mapInArrow(build, "doc_id long, key string, tokens long, sketch binary, paths array<bigint>, more array<bigint>")
    return materialise(rows.withColumn("row", F.monotonically_increasing_id()), "sets")


def _min_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each member's component, over links ``a[i], b[i]``."""
    label = np.arange(n)
    while True:
        old = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == old).all():
            return label


def _close_pairs(sketch: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members of one bucket whose sketches leave a link possible, all pairs compared."""
    some = (sketch != 0).astype(np.float32)
    size = some.sum(1)
    firsts, seconds = [], []
    step = max(1, (1 << 20) // len(sketch))
    for at in range(0, len(sketch), step):
        rows = slice(at, at + step)
        same = np.zeros((len(sketch[rows]), len(sketch)), np.uint8)
        for k in range(BINS):
            same += sketch[rows, k][:, None] == sketch[:, k][None, :]
        used = size[rows][:, None] + size[None, :] - some[rows] @ some.T
        close = same - (BINS - used) >= _least(used) * used
        close &= 9 * (BINS - same.astype(np.int64)) <= tokens[rows][:, None] + tokens[None, :]
        close &= np.minimum(tokens[rows][:, None], tokens[None, :]) >= SIMILARITY * np.maximum(tokens[rows][:, None], tokens[None, :])
        i, j = np.nonzero(close)
        keep = i + at < j
        firsts.append(i[keep] + at)
        seconds.append(j[keep])
    return np.concatenate(firsts), np.concatenate(seconds)


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bins in which sketches differ, row by row.

    Each holds a token that only one of the sets has. Linked sets have at most a ninth of their tokens together that way, as
    ``common >= 4 / 9 * (|a| + |b|)``; so more bins than that rule a link out, for certain. For short texts, whose
    tokens have a bin each, this says as much as the sets themselves.
    """
    return (a != b).sum(1)


def _least(used: np.ndarray) -> np.ndarray:
    """The estimate from which a link is possible: four and a half standard errors below its similarity."""
    return SIMILARITY - 4.5 * np.sqrt(SIMILARITY * (1 - SIMILARITY) / np.maximum(used, 1))


def _small_links(buckets: DataFrame) -> DataFrame:
    """``(a, b)``: ties between the members of small buckets whose sketches leave a link possible."""

    def compare(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            members = batch.column("members")
            cuts = members.offsets.to_numpy().astype(np.int64)
            flat = members.values.slice(cuts[0], cuts[-1] - cuts[0])
            cuts = cuts - cuts[0]
            node, tokens = flat.field("node").to_numpy(), flat.field("tokens").to_numpy()
            sketch = np.frombuffer(b"".join(flat.field("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
            size = np.diff(cuts)
            first, second = [], []
            for m in np.unique(size[size <= 64]):  # small ones, those of one size at once
                i, j = np.triu_indices(m, 1)
                base = cuts[:-1][size == m]
                a, b = (base[:, None] + i).ravel(), (base[:, None] + j).ravel()
                near = np.minimum(tokens[a], tokens[b]) >= SIMILARITY * np.maximum(tokens[a], tokens[b])
                a, b = a[near], b[near]
                for at in range(0, len(a), 1 << 16):
                    x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
                    value, used = likeness(sketch[x], sketch[y])
                    close = (value >= _least(used)) & (9 * _differ(sketch[x], sketch[y]) <= tokens[x] + tokens[y])
                    first.append(x[close])
                    second.append(y[close])
            for low, m in zip(cuts[:-1][size > 64], size[size > 64], strict=True):
                a, b = _close_pairs(sketch[low : low + m], tokens[low : low + m])
                first.append(a + low)
                second.append(b + low)
            first, second = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (first, second))
            label = _min_labels(len(node), first, second)
            tied = np.flatnonzero(label != np.arange(len(node)))
            yield pa.RecordBatch.from_arrays([pa.array(node[label[tied]]), pa.array(node[tied])], ["a", "b"])

    return buckets.mapInArrow(compare, "a long, b long")


def _split_large(rows: DataFrame, level: int) -> DataFrame:
    """``(kind, a, b)`` from members of large buckets.

    0 for a tie ``a, b``, 1 for a member ``b`` of the finer bucket ``a``, 2 for a set ``b`` that goes on from the bucket ``a``,
    be it to finer ones or to none.
    """

    def split(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            path, node, pivot, tokens = (batch.column(c).to_numpy() for c in ("path", "node", "pivot", "tokens"))
            own, other = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("sketch", "pivot_sketch"))
            value, used = likeness(own, other)
            # What may link to a set that goes no further has a bin in common with the pivot
            # wherever that set has, but for the bins in which a link can differ.
            # The bins that differ are a metric. A set that goes no further differs from the pivot in a fourth of its
            # tokens at most; one linked to it, of at least 4/5 its size, differs from it in no more than a fourth of
            # its own, so from the pivot in 9/16 of them.
            differ = _differ(own, other)
            tied = (value >= _least(used) - (1 - ABSORBED)) & (16 * differ <= 9 * tokens) & (node != pivot)
            rest = np.flatnonzero(~((value >= ABSORBED) & (4 * differ <= tokens)) & (node != pivot))
            filled = own[rest] != 0
            # A bin and its byte stand for a token; the rate is higher as fewer of these are shared.
            limit = np.minimum(BRANCH / SIMILARITY / np.maximum(filled.sum(1), 1), 1.0) * 2.0**32
            bins = np.arange(BINS, dtype=np.uint64)
            code = mix(path[rest].view(np.uint64)[:, None] ^ (own[rest].astype(np.uint64) << np.uint64(8) | bins) * np.uint64(0x9E3779B97F4A7C15))
            i, j = np.nonzero(filled & ((code >> np.uint64(32)) <= limit[:, None]))
            child = mix(code[i, j] + np.uint64(level)).view(np.int64)
            kinds = np.repeat([0, 1, 2], [tied.sum(), len(i), len(rest)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(kinds), pa.array(np.concatenate([pivot[tied], child, path[rest]])),
                pa.array(np.concatenate([node[tied], node[rest][i], node[rest]])),
            ], ["kind", "a", "b"])

    return rows.mapInArrow(split, "kind int, a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``(a, b)``: the least node of its connected component.

    Alternates large-star and small-star steps: every node ties its larger, then its smaller
    neighbours to the least one it knows. Each round is a stored table; rounds grow with the
    logarithm of the nodes. No neighbourhood is gathered, only minima. The rounds end once every
    node is either a root or tied to one root alone, which a further round would leave as it is.
    """
    now = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("ties"))
        if not around.filter("m < a AND ties > 1").take(1):
            break
        least = around.select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, F.col("a") == F.col("n")).select(F.col("m").alias("a"), "b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m")).withColumnRenamed("b", "n")
        small = large.join(least, F.col("b") == F.col("n")).select("a", "b", "m")
        pairs = F.array(F.struct(F.col("m").alias("a"), F.col("a").alias("b")), F.struct(F.col("m").alias("a"), F.col("b").alias("b")))
        step = small.select(F.explode(pairs).alias("p")).select("p.a", "p.b").filter("a <> b").distinct()
        now = materialise(step, "edges")
    children = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return children.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def candidates(sets: DataFrame) -> DataFrame:
    """``(a, b)``: ties between sets (``node``, ``tokens``, ``sketch``, ``paths``, ``more``) that may be linked."""
    known = sets.select("node", "tokens", "sketch").hint("merge")
    members = sets.select("node", F.explode(F.array_distinct("paths")).alias("path"))
    small, ties = [], []
    for level in range(1, DEPTH + 1):
        buckets = _buckets(members)
        small.append(buckets.filter(F.col("size") <= SMALL).select("path", "node"))
        large = buckets.filter(F.col("size") > SMALL)
        if not large.take(1):
            break
        if level < DEPTH:
            # Looked up by pivot, so that no shuffle is on a large bucket; a row for SMALL members at most.
            pivots = large.select("pivot").distinct().join(
                known.select(F.col("node").alias("pivot"), F.col("sketch").alias("pivot_sketch")), "pivot")
            split = large.join(known, "node").join(F.broadcast(pivots), "pivot")
            split = materialise(_split_large(split.select("path", "node", "tokens", "pivot", "sketch", "pivot_sketch"), level), "split")
            ties.append(split.filter("kind = 0").select("a", "b"))
            members = split.filter("kind = 1").select(F.col("b").alias("node"), F.col("a").alias("path"))
            if level == 1:
                # Paths that go on may end before a pair meets: their sets go through further runs. Of linked sets
                # that a bucket does not tie neither is near its pivot, so both are among these.
                again = sets.join(split.filter("kind = 2").select(F.col("b").alias("node")).distinct(), "node", "left_semi")
                members = members.unionByName(again.select("node", F.explode(F.array_distinct("more")).alias("path")))
        else:  # not split by then: all pairs of blocks of members
            n = F.ceil(F.col("size") / BLOCK_SETS).cast("int")
            own = F.pmod(F.xxhash64("node"), n).cast("int")
            pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.struct(F.least(j, own).alias("i"), F.greatest(j, own).alias("j")))
            placed = large.withColumn("pair", F.explode(F.filter(pairs, lambda p: (p["i"] < p["j"]) | (n == 1))))
            ties.append(_small_links(_gathered(placed.join(known, "node"), "path", "pair")))
    # The small buckets of all levels at once.
    ties.append(_small_links(_gathered(reduce(DataFrame.unionByName, small).join(known, "node"), "path")))
    return reduce(DataFrame.unionByName, ties)


def _buckets(members: DataFrame) -> DataFrame:
    """Members of buckets with more than one, with the bucket's size and its least member; stored, as small and large ones come from it."""
    counts = members.groupBy("path").agg(F.count("*").alias("size"), F.min("node").alias("pivot")).filter("size > 1")
    return materialise(members.join(counts, "path"), "buckets")


def _gathered(members: DataFrame, *keys: str) -> DataFrame:
    """The members of every bucket, of a bounded number each, in one row."""
    return members.groupBy(*keys).agg(F.collect_list(F.struct("node", "tokens", "sketch")).alias("members")).select("members")


def _common(a: tuple, b: tuple, shape: tuple[int, int], width: int) -> np.ndarray:
    """Sizes of the intersections of two lists of sets, each given as (set, token) pairs sorted by token."""
    (ar, ac), (br, bc) = a, b
    da, db = np.bincount(ac, minlength=width), np.bincount(bc, minlength=width)
    fa, fb = np.cumsum(da) - da, np.cumsum(db) - db
    work = da * db
    out = np.zeros(shape, np.float32)
    dense = np.flatnonzero(work > max(64, 0.01 * shape[0] * shape[1]))
    for at in range(0, len(dense), 2048):
        part = dense[at : at + 2048]
        place = np.full(width, -1)
        place[part] = np.arange(len(part))
        x, y = np.zeros((shape[0], len(part)), np.float32), np.zeros((shape[1], len(part)), np.float32)
        ka, kb = place[ac] >= 0, place[bc] >= 0
        x[ar[ka], place[ac[ka]]] = 1
        y[br[kb], place[bc[kb]]] = 1
        out += x @ y.T
    is_dense = np.zeros(width, bool)
    is_dense[dense] = True
    sparse = np.flatnonzero((work > 0) & ~is_dense)
    for part in np.array_split(sparse, max(1, int(work[sparse].sum()) >> 22)):
        which = np.repeat(np.arange(len(part)), work[part])
        turn = np.arange(len(which)) - np.repeat(np.cumsum(work[part]) - work[part], work[part])
        c = part[which]
        i, j = ar[fa[c] + turn // db[c]], br[fb[c] + turn % db[c]]
        out += np.bincount(i * shape[1] + j, minlength=shape[0] * shape[1]).reshape(shape).astype(np.float32)
    return out


def linked(texts: pa.Array, side: np.ndarray) -> np.ndarray:
    """Which texts with ``side`` 0 (rows) are linked to which with ``side`` 1, or to each other if all are 0."""
    tokens, before = shingles(texts)
    sizes = np.diff(before)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    values, column = np.unique(tokens, return_inverse=True)
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(right):
        right = left
    place = np.empty(len(sizes), np.int64)
    place[left] = np.arange(len(left))
    own = side[doc] == 0
    a = (place[doc[own]], column[own])
    if right is not left:
        place[right] = np.arange(len(right))
        b = (place[doc[~own]], column[~own])
    else:
        b = a
    common = _common(a, b, (len(left), len(right)), len(values))
    # Jaccard >= 4/5 in whole numbers: 5 common >= 4 (|a| + |b| - common).
    found = (9 * common >= 4 * (sizes[left][:, None] + sizes[right][None, :])) & (common > 0)
    if right is left:
        np.fill_diagonal(found, False)
    return found


def _verify(rows: DataFrame) -> DataFrame:
    """``(node, root, links, texts, part)`` from the members of components, ``task`` by ``task``.

    ``links`` and ``texts`` count linked documents and texts; ``root`` is the least node that the
    node is connected to within the task, and ``part`` whether its component has other tasks.
    """

    def check(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        comp = table.column("comp").to_numpy()
        order = np.lexsort((table.column("node").to_numpy(), comp))
        table, comp = table.take(pa.array(order)), comp[order]
        node, times, side, blocks = (table.column(c).to_numpy() for c in ("node", "times", "side", "blocks"))
        cross = table.column("cross").to_numpy(zero_copy_only=False)
        texts = table.column("text").combine_chunks()
        out = []
        cuts = np.flatnonzero(np.append(True, comp[1:] != comp[:-1]))
        for low, high in zip(cuts, np.append(cuts[1:], len(comp)), strict=True):
            # A row of the corpus that is there twice is one text.
            keep = low + np.flatnonzero(np.append(True, node[low + 1 : high] != node[low : high - 1]))
            s, n, t = side[keep], node[keep], times[keep]
            if cross[low] and s.min() == s.max():  # two blocks, one of them empty
                continue
            found = linked(texts.take(pa.array(keep)), s)
            left = np.flatnonzero(s == 0)
            right = np.flatnonzero(s == 1)
            both = len(right) > 0
            i, j = np.nonzero(found)
            a, b = left[i], (right if both else left)[j]
            label = _min_labels(len(n), a, b)
            links, count = np.bincount(a, t[b], len(n)), np.bincount(a, minlength=len(n))
            if both:
                links, count = links + np.bincount(b, t[a], len(n)), count + np.bincount(b, minlength=len(n))
            out.append((n, n[label], links.astype(np.int64), count, np.full(len(n), blocks[low] > 1)))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] or [*[np.zeros(0, np.int64)] * 4, np.zeros(0, bool)]
        return pa.table(columns, ["node", "root", "links", "texts", "part"])

    return rows.groupBy("task").applyInArrow(check, "node long, root long, links long, texts long, part boolean")


def join(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``class_id``, ``n_links``, ``n_text_links`` and ``is_first``.

    A class is a connected component of links; ``class_id`` is its least ``doc_id``. ``n_links``
    counts the other documents linked to this one, copies included, ``n_text_links`` the other
    texts. Equal texts are linked, null and empty ones too; texts without words link to nothing
    else. ``is_first`` marks one row of each class: of the rows with the least id, the first.
    Rows without an id count like others; a class of such rows alone has a null ``class_id``.

    The least similarity of a link is 0.8; a pair that similar is found with probability
    ``recall`` or more by the model of :func:`missed`, and every pair found is exact.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = _prepare(docs, recall)
    # One node per text. Copies are put together before the shuffle.
    by_id = F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    keys = materialise(rows.groupBy("key").agg(F.min("row").alias("node"), F.count("*").alias("times"), F.min(by_id).alias("first")), "texts")
    # Stored, as every level looks sets up.
    sets = materialise(rows.drop("key").join(keys.select("node", "key", "times"), F.col("row") == F.col("node")).drop("row"), "nodes")
    # Components in tasks: small ones many to a task, large ones as pairs of blocks.
    groups = components(candidates(sets))
    sized = materialise(groups.join(sets.select("node", "tokens", "key", "doc_id", "times"), "node"), "members")
    extent = sized.groupBy("root").agg(F.count("*").alias("n"), F.sum("tokens").alias("t"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_TEXTS, F.col("t") / BLOCK_TOKENS)).cast("int")
    extent = extent.select(F.col("root").alias("comp"), blocks.alias("blocks"), "t")
    total = extent.agg(F.sum("t")).first()[0] or 0
    tasks = max(1, int(total) // (BLOCK_TOKENS // 2))
    placed = sized.join(extent.drop("t"), F.col("root") == F.col("comp"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        F.least(j, F.col("block").cast("int")).alias("i"), F.greatest(j, F.col("block").cast("int")).alias("j")))
    placed = placed.withColumn("block", block).withColumn("pair", F.explode(pairs))
    task = F.when(F.col("blocks") == 1, F.concat_ws(":", F.lit("s"), F.pmod(F.xxhash64("comp"), F.lit(tasks))))
    placed = placed.select(
        "node", "comp", "times", "key", "blocks", F.col("doc_id").alias("_doc"),
        F.coalesce(task, F.concat_ws(":", "comp", "pair.i", "pair.j")).alias("task"),
        (F.col("pair.i") != F.col("pair.j")).alias("cross"),
        ((F.col("pair.i") != F.col("pair.j")) & (F.col("block") == F.col("pair.j"))).cast("int").alias("side"))
    text = text_of()
    texts = docs.select(F.col("doc_id").cast("long").alias("_d"), F.md5(text).alias("_key"), text.alias("text"))
    # Shuffled however few candidates there are, so that the plan is the same at every size.
    texts = placed.hint("merge").join(texts, (F.col("key") == F.col("_key")) & F.col("_doc").eqNullSafe(F.col("_d")))
    checked = materialise(_verify(texts.select("task", "comp", "node", "times", "blocks", "cross", "side", "text")), "links")
    counts = checked.groupBy("node").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    # Only what is known of cut components has to be put together.
    roots = components(checked.filter("part").select(F.col("root").alias("a"), F.col("node").alias("b")))
    roots = roots.unionByName(checked.filter("NOT part").select("node", "root"))
    whole = keys.join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = whole.groupBy("root").agg(F.min("first").alias("_first"))
    whole = whole.join(firsts, "root").select(
        F.col("key").alias("_key"), F.col("_first.id").alias("class_id"), F.col("_first.row").alias("first"),
        (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_text_links"))
    result = rows.select("row", "doc_id", "key").join(whole, F.col("key") == F.col("_key"))
    return result.select("doc_id", "class_id", "n_links", "n_text_links", (F.col("row") == F.col("first")).alias("is_first"), "key")




def deduplicated(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` that stand for their class, one of each, with their columns as they are.

    A row is told by its id and text; of rows alike in both one stays, whichever.
    """
    firsts = join(docs.select("doc_id", "text"), recall).filter("is_first").select(F.col("doc_id").alias("_id"), F.col("key").alias("_k"))
    whole = docs.select(
        F.col("doc_id").cast("long").alias("_d"), F.md5(text_of()).alias("_key"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    kept = whole.join(firsts, (F.col("_key") == F.col("_k")) & F.col("_d").eqNullSafe(F.col("_id")), "left_semi")
    turn = F.row_number().over(Window.partitionBy("_key", "_d").orderBy(F.lit(0)))
    return kept.withColumn("_turn", turn).filter("_turn = 1").select("_doc.*")
