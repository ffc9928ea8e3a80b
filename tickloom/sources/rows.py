"""From raw log lines to typed ticks and a quarantine.

A line frame has ``source_id, seq, line, positions, width``: the line as it stands in the file,
where the tick columns stand in the file's header, and how many columns that has. Lines
are cut into cells one by one and cast afterwards, so whether a line counts as bad never
depends on which columns a query happens to read.

A usable line has a date, a volume of zero or more, a price that is a number or missing, and a
time of day: ``HHMMSS`` with hours below 24, minutes and seconds below 60.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import TICK, TICK_COLUMNS

# Cell contents that mean "missing" (the default list of pandas.read_csv).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Reasons that concern a whole file; every other reason concerns one line.
UNREADABLE_ARCHIVE = "unreadable archive"
UNKNOWN_HEADER = "unknown header"
# Not a fault: the row of an archive that says how many seconds its task took to read it.
READ_SECONDS = "seconds to read"

_TYPES = {field.name: field.dataType.simpleString() for field in TICK.fields}


def header_columns(header: str) -> list[str]:
    """Column names of a header line."""
    return next(csv.reader([header.lstrip("﻿")]))


def missing_columns(header: str) -> list[str]:
    """Tick columns that a header line does not name."""
    names = header_columns(header) if header.strip() else []
    return [name for name in TICK_COLUMNS if name not in names]


def positions_of(header: str) -> list[int] | None:
    """Where the tick columns stand in a header line; None if it lacks one."""
    names = header_columns(header) if header.strip() else []
    return [names.index(name) for name in TICK_COLUMNS] if not missing_columns(header) else None


def _cells(line: Column) -> Column:
    """The cells of a line, in order; quoted cells may hold commas and doubled quotes.

    Quotes that do not pair up have no meaning.
    """
    outside = F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)
    bare = F.transform(outside, lambda cell: F.when(
        cell.rlike('^".*"$'), F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
    ).otherwise(cell))
    paired = line.contains('"') & (F.regexp_count(line, F.lit('"')) % 2 == 0)
    return F.when(paired, bare).otherwise(F.split(line, ",", -1))


def type_ticks(lines: DataFrame) -> DataFrame:
    """Parse a line frame.

    Gives the typed tick columns, and ``reason`` and ``line`` for a row that is not usable.
    Lines of a file with an unusable header (null ``positions``) are not guessed at: all are bad.
    A ``note``, if that column is there, is the reason of a row that is no line of a file.
    """
    # Both generators are there to keep Catalyst from copying the parse and the casts into
    # every filter and projection above them, where they would run many times per line.
    split = F.explode(F.array(_cells(F.col("line")))).alias("_cells")
    rows = lines.filter(F.trim("line") != "").select("*", split)
    text = {
        name: F.get("_cells", F.get("positions", F.lit(i))) for i, name in enumerate(TICK_COLUMNS)
    }
    typed = {
        name: F.when(~cell.isin(*NA_TOKENS), cell) if _TYPES[name] == "string" else cell.try_cast(_TYPES[name])
        for name, cell in text.items()
    }
    rows = rows.select("*", F.inline(F.array(F.struct(*[v.alias(k) for k, v in typed.items()]))))

    time = F.col("Log_Time")
    time_of_day = (time >= 0) & (time < 240000) & (time % 10000 < 6000) & (time % 100 < 60)
    reason = (
        F.when(F.col("positions").isNull(), UNKNOWN_HEADER)
        .when(F.col("line").contains("\ufffd"), "undecodable bytes")
        .when(F.size("_cells") > F.col("width"), "too many fields")
        .when(
            F.col("Trade_Date").isNull() | time.isNull() | F.col("Volume").isNull(),
            "missing or non-numeric integer",
        )
        .when(F.col("Price").isNull() & ~text["Price"].isin(*NA_TOKENS), "non-numeric price")
        .when(F.col("Trade_Date") < 0, "not a date")
        .when(~time_of_day, "not a time of day")
        .when(F.col("Volume") < 0, "negative volume")
        .when(F.col("Comm").isNull(), "missing code")
    )
    if "note" in rows.columns:
        reason = F.when(F.col("note").isNotNull(), F.col("note")).otherwise(reason)
    # Only bad rows keep their text, or a stored copy would hold every tick twice.
    return rows.withColumn("reason", reason).select(
        *TICK_COLUMNS, "source_id", "seq", "reason", F.when(F.col("reason").isNotNull(), F.col("line")).alias("line")
    )


def split_bad_rows(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable ticks, and the quarantine with reason and raw text of every other line."""
    good = parsed.filter(F.col("reason").isNull()).select(*TICK.names)
    bad = parsed.filter(F.col("reason").isNotNull()).select("source_id", "seq", "reason", "line")
    return good, bad
