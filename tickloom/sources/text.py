"""Plain text tick logs, read by byte ranges."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.paths import open_input
from tickloom.session import materialise
from tickloom.sources.rows import header_columns, missing_columns, positions_of, type_ticks
from tickloom.sources.zips import SOURCE_PATTERN, source_id_of

register_pickle_by_value(sys.modules[__name__])

RANGE_BYTES = 64 << 20
BLOCK_BYTES = 1 << 20
_HEADS = "file string, length bigint, header string, positions array<int>, width int"
_RANGE = "source_id int, before bigint, header string, positions array<int>, width int"


def _first_line(path: str) -> str:
    """The first line of a file that is not blank."""
    with open_input(path) as source:
        taken = b""
        while True:
            more = source.read(1 << 16)
            taken += more
            head = taken.lstrip(b"\xef\xbb\xbf \t\r\n")
            if not more or b"\n" in head:
                return head.split(b"\n", 1)[0].rstrip(b"\r").decode("utf-8", "replace")


def _heads(spark: SparkSession, paths, columns: list[str] | None) -> DataFrame:
    """One row per file: its length, and the place of the columns by its own header, or by
    ``columns`` if it has none. Tasks read the beginnings of the files only."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column("path").to_pylist()
            found = [(line, positions_of(line), len(header_columns(line or " "))) for line in map(_first_line, files)]
            given = (None, positions_of(",".join(columns)), len(columns)) if columns else (None, None, None)
            header, positions, width = zip(*[row if row[1] else given for row in found], strict=True) if files else ((), (), ())
            yield pa.RecordBatch.from_arrays([
                pa.array(files), batch.column("length"), pa.array(header, pa.string()),
                pa.array(positions, pa.list_(pa.int32())), pa.array(width, pa.int32()),
            ], ["file", "length", "header", "positions", "width"])

    files = spark.read.format("binaryFile").load(paths).select("path", "length")
    return files.mapInArrow(look, _HEADS)


def _whole_lines(path: str, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """Blocks of the lines that begin in a byte range, each with the place of its first byte; blocks end at line ends.

    The last line may go beyond the range. A line that began before it belongs to the range before.
    """
    with open_input(path) as source:
        at, pending = start, b""
        if start:
            source.seek(start - 1)
            at -= 1
            while (more := source.read(BLOCK_BYTES)) and (cut := more.find(b"\n")) < 0:
                at += len(more)
            if not more:
                return
            at, pending = at + cut + 1, more[cut + 1 :]
        while at < stop:
            # What is held begins with a line, at ``at``.
            if at + len(pending) >= stop and (cut := pending.find(b"\n", max(stop - 1 - at, 0))) >= 0:
                yield at, pending[:cut]
                return
            cut = pending.rfind(b"\n")
            if 0 <= cut and at + cut + 1 < stop and len(pending) >= BLOCK_BYTES:
                yield at, pending[:cut]
                at, pending = at + cut + 1, pending[cut + 1 :]
                continue
            more = source.read(BLOCK_BYTES)
            if not more:
                if pending:
                    yield at, pending
                return
            pending += more


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, (path, start, stop) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("file", "start", "stop")), strict=True)):
            for at, block in _whole_lines(path, start, stop):
                text = block.replace(b"\r\n", b"\n").replace(b"\r", b"\n").decode("utf-8", "replace")
                rest = [batch.column(c).slice(i, 1) for c in ("source_id", "before", "header", "positions", "width")]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array([at], pa.int64()), pa.array([text])],
                    ["source_id", "before", "header", "positions", "width", "at", "block"])


def read_tick_csv(
    spark: SparkSession, paths, columns: list[str] | None = None, source_pattern: str = SOURCE_PATTERN
) -> DataFrame:
    """Parsed lines of plain logs; feed to :func:`tickloom.sources.rows.split_bad_rows`.

    Each file is read by its own header. A file without one, such as a later part of a folder,
    has the given ``columns``; without these it is an error.
    ``source_pattern`` names the file id in the path by its first group. ``seq`` follows the order
    of the files of a source by path, and of the lines in them.

    One row per byte range carries what is known of its file. These rows are dealt out; a task reads its
    range, so lines are never shuffled, and a file of any size is read by many tasks.
    """
    if columns and missing_columns(",".join(columns)):
        raise ValueError(f"tick file header lacks {missing_columns(','.join(columns))}")
    heads = materialise(_heads(spark, paths, columns), "heads")
    range_bytes = min(RANGE_BYTES, int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b")))
    count = F.greatest(F.ceil(F.col("length") / range_bytes), F.lit(1))
    n, example, ranges = heads.agg(F.count_if(F.col("positions").isNull()), F.min(F.when(F.col("positions").isNull(), F.col("file"))), F.sum(count)).first()
    if n and not columns:
        raise ValueError(f"{n} files without a header line, e.g. {example}")
    # The lengths of a source's earlier files come before the places in a file.
    earlier = Window.partitionBy("source_id").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("source_id", source_id_of(F.col("file"), source_pattern))
    heads = heads.withColumn("before", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), (count - 1).cast("bigint"))).alias("_part")
    dealt = heads.select("*", part).withColumns({
        "start": F.col("_part") * range_bytes, "stop": F.least((F.col("_part") + 1) * range_bytes, F.col("length"))})
    dealt = dealt.select("file", "start", "stop", "source_id", "before", "header", "positions", "width")
    blocks = dealt.repartition(max(1, int(ranges or 1))).mapInArrow(_read_ranges, f"{_RANGE}, at bigint, block string")
    # A block has no more lines than bytes, so numbers within it stay below the place of the next.
    each = F.posexplode(F.split("block", "\n", -1)).alias("_offset", "line")
    lines = blocks.select("source_id", "before", "header", "positions", "width", "at", each)
    is_header = F.coalesce(F.ltrim(F.regexp_replace("line", "^\ufeff", "")) == F.col("header"), F.lit(False))
    return type_ticks(lines.filter(~is_header).withColumn("seq", F.col("before") + F.col("at") + F.col("_offset")))
