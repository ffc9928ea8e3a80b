"""Zipped tick logs: one archive per file id, the log is its first .csv or .txt member."""

from __future__ import annotations

import io
import re
import sys
import time
import zipfile
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tickloom.paths import open_input
from tickloom.sources import rows
from tickloom.sources.rows import (
    READ_SECONDS,
    UNREADABLE_ARCHIVE,
    header_columns,
    missing_columns,
    positions_of,
    type_ticks,
)

# The task-side functions travel inside the plan, with what they call, so executors need not have this package.
register_pickle_by_value(sys.modules[__name__])
register_pickle_by_value(rows)

MEMBER_SUFFIXES = (".csv", ".txt")
BLOCK_CHARS = 1 << 20
SOURCE_PATTERN = r"(\d+)\.(?:zip|csv|txt)(?:/part-[^/]*)?$"

#: What a ``binaryFile`` scan yields; a stream over archives needs it spelled out.
ZIP_SCHEMA = StructType([
    StructField("path", StringType()), StructField("modificationTime", TimestampType()),
    StructField("length", LongType()), StructField("content", BinaryType()),
])

# A block is a run of whole lines of one member; ``start`` is the number of its first line.
# ``positions`` and ``width`` describe the member's header. A row without block but with a
# ``note`` says what became of the archive: ``value`` is the error, or the seconds it took.
_BLOCKS = {
    "path": ("string", pa.string()), "start": ("bigint", pa.int64()), "block": ("string", pa.string()),
    "positions": ("array<int>", pa.list_(pa.int32())), "width": ("int", pa.int32()),
    "note": ("string", pa.string()), "value": ("string", pa.string()),
}


def tick_paths(template: str, ids: Iterable[int]) -> list[str]:
    """Landing paths of a set of file ids, e.g. ``tick_paths("/landing/{id}.zip", [7, 8])``."""
    return [template.format(id=i) for i in ids]


def pattern_of(template: str) -> str:
    """The pattern that finds a file id in the paths of a template."""
    return re.escape(template.split("/", 3)[-1] if "://" in template else template.lstrip("/")).replace(r"\{id\}", r"(\d+)", 1).replace(r"\{id\}", r"\d+") + "$"


def source_id_of(path: Column, pattern: str = SOURCE_PATTERN) -> Column:
    """The file id in a path; a path that gives none, or none that is an INT, is an error."""
    found = F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")).try_cast("int")
    return F.coalesce(found, F.raise_error(F.concat(F.lit("no file id in "), path)).cast("int"))


def _line_blocks(text: io.TextIOBase) -> Iterator[str]:
    """The rest of a text, cut into blocks of whole lines."""
    pending: list[str] = []
    while chunk := text.read(BLOCK_CHARS):
        cut = chunk.rfind("\n")
        if cut < 0:
            pending.append(chunk)
            continue
        yield "".join([*pending, chunk[:cut]])
        pending = [chunk[cut + 1:]]
    if any(pending):
        yield "".join(pending)


def _blocks_of(path: str, columns: list[str] | None) -> Iterator[tuple]:
    """The blocks of one archive; only the part of it that is being read is held."""
    with open_input(path) as source, zipfile.ZipFile(source) as archive:
        member = next((name for name in archive.namelist() if name.endswith(MEMBER_SUFFIXES)), None)
        if member is None:
            raise FileNotFoundError("no .csv or .txt member")
        with archive.open(member) as raw:
            text = io.TextIOWrapper(raw, encoding="utf-8-sig", errors="replace")
            while (header := text.readline()) and not header.strip():
                pass
            header = header.rstrip("\r\n")
            if not header:
                raise EOFError(f"{member} is empty")
            known = columns is None or header_columns(header) == columns
            positions, width = positions_of(header) if known else None, len(header_columns(header))
            if positions is None and columns is None:
                yield path, 0, None, None, None, LACKING, f"tick file header lacks {missing_columns(header)}: {path}"
            start = 1
            for block in _line_blocks(text):
                yield path, start, block, positions, width, None, None
                start += block.count("\n") + 1


LACKING = "header lacks"


def _all_blocks(path: str, columns: list[str] | None) -> Iterator[tuple]:
    """The blocks of an archive, an error if it turns out to be damaged, and the seconds it took."""
    started = time.perf_counter()
    try:
        yield from _blocks_of(path, columns)
    except (zipfile.BadZipFile, zlib.error, EOFError, OSError, RuntimeError, pa.ArrowException) as error:
        yield path, 0, None, None, None, UNREADABLE_ARCHIVE, f"{error or type(error).__name__}: {path}"
    yield path, 0, None, None, None, READ_SECONDS, f"{time.perf_counter() - started:.3f}"


def _block_reader(columns: list[str] | None):
    """A ``mapInArrow`` function that opens archives by path and unzips them block by block.

    Python only inflates and cuts at line ends; lines are split and parsed in the JVM.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for row in _all_blocks(path, columns):
                    arrays = [pa.array([value], kind) for value, (_, kind) in zip(row, _BLOCKS.values(), strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, [*_BLOCKS])

    return read


def unzip_ticks(
    archives: DataFrame, columns: list[str] | None = None, on_error: str = "raise",
    pattern: str = SOURCE_PATTERN, timings: bool = False,
) -> DataFrame:
    """Parse the archives at the paths of a frame, batch or streaming; see :func:`read_tick_zips`."""
    schema = ", ".join(f"{name} {kind}" for name, (kind, _) in _BLOCKS.items())
    blocks = archives.select("path").mapInArrow(_block_reader(columns), schema)
    fault = F.col("note").isin(UNREADABLE_ARCHIVE, LACKING)
    value = F.when(fault, F.raise_error(F.col("value"))).otherwise(F.col("value")) if on_error == "raise" else F.col("value")
    # An unreadable archive becomes one quarantined line that says why; the lines below an
    # unusable header say so themselves.
    shown = F.col("note").isNull() | (F.col("note") == UNREADABLE_ARCHIVE)
    if on_error == "raise":
        shown = shown | (F.col("note") == LACKING)
    if timings:
        shown = shown | (F.col("note") == READ_SECONDS)
    # File-level columns are worked out per block, before it becomes lines.
    blocks = blocks.filter(shown).select(
        source_id_of(F.col("path"), pattern).alias("source_id"), "positions", "width", "note", "start",
        F.coalesce(value, F.col("block")).alias("block"),
    )
    if not archives.isStreaming:
        # An archive is inflated by one task, but its blocks are dealt out to all for parsing, by bytes.
        blocks = blocks.hint("rebalance", "source_id", "start")
    each = F.posexplode(F.split("block", "\n", -1)).alias("_offset", "line")
    lines = blocks.select("source_id", "positions", "width", "note", "start", each)
    return type_ticks(lines.withColumn("seq", F.col("start") + F.col("_offset")))


def read_tick_zips(
    spark: SparkSession, paths, columns: list[str] | None = None, on_error: str = "raise",
    pattern: str = SOURCE_PATTERN, timings: bool = False,
) -> DataFrame:
    """Parsed lines of zipped logs with ``source_id`` from the path; feed to
    :func:`tickloom.sources.rows.split_bad_rows`.

    An archive cannot be split. Its task opens it by path in the shared file system and streams the
    member in blocks, so its size does not matter, and each archive is opened once. The blocks are
    then dealt out by size, so that all tasks parse the lines of an archive that holds most of them. ``seq`` is the line number. The order of columns comes from each
    file's own header; with ``columns``, a file with another header is kept aside.
    ``on_error="quarantine"`` keeps one unreadable archive, or one without the tick columns,
    from failing the others. A damaged archive may have given some lines before the damage
    showed; leave its source out as a whole, as :mod:`tickloom.plans.load` does.
    ``pattern`` finds the file id by its first group. ``timings`` adds a row per archive with the
    seconds it took, under the reason ``READ_SECONDS``.
    """
    archives = spark.read.format("binaryFile").load(paths)
    return unzip_ticks(archives, columns, on_error, pattern, timings)
