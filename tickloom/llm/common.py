"""Words, hashes, prefix sums and training samples shared by the operators."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A word is a run of anything but ASCII white space; the same pattern serves Java, DuckDB and Python.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
ARROW_BYTES = "8m"
CHUNK_BYTES = 1 << 20


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def remainder(column: str, divisor: int) -> Column:
    """``crc32`` of an id written as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % divisor


def bound_batches(spark: SparkSession) -> None:
    """Keep what one Arrow batch holds small, whatever the length of the texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":  # Spark's default; a setting of the user's stays
        spark.conf.set(key, ARROW_BYTES)


def worker_state(name: str, build: Callable[[], object]) -> object:
    """One object per Python worker, kept from task to task."""
    store = sys.modules.setdefault("tickloom_worker_state", types.ModuleType("tickloom_worker_state"))
    if not hasattr(store, name):
        setattr(store, name, build())
    return getattr(store, name)


def slices(batch: pa.RecordBatch, column: str, most: int = 2 * CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a part take ``most`` bytes, or are a single text."""
    sizes = np.fromiter((len(x) for x in batch.column(column).cast(pa.binary()).fill_null(b"").to_numpy(False)), np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, stop - at)
        at = stop
    give_back()


def give_back() -> None:
    """Return memory that is free to the system: a worker lives on, idle, beside later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and where each text begins; null is empty."""
    strings = strings.cast(pa.large_string()).fill_null("")
    _, offsets, data = strings.buffers()
    offsets = np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


# ASCII letters and digits, and all that is not ASCII.
IS_PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
IS_NO_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and for each text the number of words before it.

    ``gap`` marks the bytes that part words, white space unless told otherwise.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    space = gap[data]
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    before[0], before[1:] = True, space[:-1]
    after[-1], after[:-1] = True, space[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts], after[cuts - 1] = True, True
    starts = np.flatnonzero(~space & before)
    return starts, np.flatnonzero(~space & after) + 1, np.searchsorted(starts, offsets)


_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``data[start:end]`` for spans in ascending order, all at once.

    A polynomial over the bytes modulo 2**64: differences of running sums, scaled back by the
    inverse power of where the span begins. Works through the bytes in bounded chunks.
    """
    out = np.zeros(len(starts), np.uint64)
    inverse = pow(_BASE, -1, 1 << 64)
    powers, backs = worker_state("powers", lambda: (_powers(_BASE, CHUNK_BYTES + 1), _powers(inverse, CHUNK_BYTES + 1)))
    at = 0
    while at < len(starts):
        low = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, low + CHUNK_BYTES, "right")))
        high = int(ends[at:stop].max())
        part = data[low:high].astype(np.uint64) + np.uint64(1)
        part *= powers[: len(part)] if len(part) <= CHUNK_BYTES else _powers(_BASE, len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part, out=sums[1:])
        s, e = starts[at:stop] - low, ends[at:stop] - low
        out[at:stop] = (sums[e] - sums[s]) * (backs[s] if s[-1] <= CHUNK_BYTES else _powers(inverse, int(s[-1]) + 1)[s])
        at = stop
    return mix(out)


def training_sample(labels: DataFrame, label: str, per_class: tuple[int, int]) -> DataFrame:
    """At most so many rows of ``labels`` with ``label`` 0 and with 1, the first by hash of ``doc_id``.

    Rows without id or label, and all but one row of a repeated id, are left aside.
    """
    known = labels.filter(F.col("doc_id").isNotNull()).withColumn("_k", F.md5(F.col("doc_id").cast("string")))
    part = lambda v: known.filter(F.col(label) == v).dropDuplicates(["doc_id"]).orderBy("_k").limit(per_class[v])
    return part(0).unionByName(part(1)).dropDuplicates(["doc_id"]).drop("_k")


def running_before(
    df: DataFrame, group: Sequence[str], key: str, amount: str, name: str, ties: Sequence[str] = (), digits: int = 3
) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over the rows of the group that come before this one.

    The ``group`` columns are never null. ``key`` is a hexadecimal hash, which orders the rows; its first ``digits`` cut a group into
    ranges of about equal size, however large the group is. Each range is sorted and summed in its
    own task, and only the sums of the ranges are added up across them. Rows with one key share a
    range and are ordered by ``ties``; rows alike in those too may swap places.
    """
    cut = df.withColumn("_range", F.substring(key, 1, digits))
    place = [*group, "_range"]
    across = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut.groupBy(*place).agg(F.sum(amount).alias("_sum"))
    bases = bases.select(*place, F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_base"))
    within = Window.partitionBy(*place).orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    # The join is on what the window is partitioned by, so the rows are shuffled once.
    inside = cut.withColumn("_inside", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    return inside.join(bases, place).withColumn(name, F.col("_base") + F.col("_inside")).drop("_range", "_inside", "_base")
