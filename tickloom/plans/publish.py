"""Facts as readers see them, and the upkeep of their folders.

A load puts its facts into a *segment*, a folder per fact that no other attempt writes to. The ledger's SUCCESS
row names the segment, and only that makes it visible: what an attempt that died has left is never seen, also
not after the same load is run again. A source is read from the segment of its last success.

:func:`compact_facts` gathers the visible rows of many segments in one, by ranges of sources, and a
*manifest* says from then on where a source's segment is stored. A new manifest version counts once it is
written in full, so readers see the rows in one place or in the other. :func:`vacuum` removes segments that no
source is read from any more, a grace period after they were first found so.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.ledger import STATUSES
from tickloom.plans.warehouse import Warehouse
from tickloom.schemas import FACT_MANIFEST, TABLES
from tickloom.session import materialise

FACTS = ("fact_session_summary", "fact_hourly_stats", "fact_trade_distribution")


def new_segment(load_id: int) -> str:
    """The segment of one attempt of a load."""
    return f"{load_id}-{uuid.uuid4().hex[:12]}"


def write_facts(wh: Warehouse, name: str, df: DataFrame, segment: str, by_range: bool = False) -> None:
    """Write a fact's rows as a segment, in place of one of that name that is there.

    Rows of a source are gathered in few files; ``by_range`` sorts all by source, so that a reader of some sources
    can skip files and row groups.
    """
    schema, (_, *inner) = TABLES[name]
    rows = df.select(*[c for c in schema.names if c != "segment"])
    if by_range:
        rows = rows.repartitionByRange(*inner, "source_id").sortWithinPartitions(*inner, "source_id")
    else:
        rows = rows.hint("rebalance", *inner, "source_id")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*inner).parquet(wh.path(f"{name}/segment={segment}"))


def manifest(wh: Warehouse) -> DataFrame:
    """Where compacted sources are stored: the last complete version."""
    versions = wh.complete("fact_manifest")
    return wh.read(f"fact_manifest/version={max(versions, default=0)}", FACT_MANIFEST)


def current_segments(wh: Warehouse) -> DataFrame:
    """``source_id, segment, stored``: the segment of each source's last success, and where its rows are."""
    named = wh.ledger_state().filter("segment IS NOT NULL").select(F.col("file_id").alias("source_id"), "segment")
    return named.join(manifest(wh), ["source_id", "segment"], "left").withColumn("stored", F.coalesce("stored", "segment"))


def visible_fact(wh: Warehouse, name: str) -> DataFrame:
    """A fact as readers should see it: of every source the rows of its last success.

    The fact is partitioned by segment, so the join also prunes folders.
    """
    where = current_segments(wh).select("source_id", F.col("stored").alias("segment"))
    return wh.table(name).join(where, ["source_id", "segment"], "left_semi").drop("segment")


def compact_facts(wh: Warehouse) -> str | None:
    """Move what readers see of small segments into a new one; returns its name, or None if there is nothing to gather.

    Taken are the segments of all loads, and compacted ones from the smallest on as long as one is no larger than all
    before it together. So there are about as many segments as the number of sources has doubled, and a row is moved that
    often, not each time. Superseded and unfinished rows are left behind.
    """
    where = materialise(current_segments(wh), "segments")
    # One row per segment that is read from; compaction keeps them few.
    sizes = sorted((r["stored"].startswith("c"), r["n"], r["stored"]) for r in where.groupBy("stored").agg(F.count("*").alias("n")).collect())
    chosen, held = [], 0
    for compacted, n, stored in sizes:
        if compacted and n > held:
            break
        chosen.append(stored)
        held += n
    if len(chosen) < 2:
        return None
    target = f"c{max(wh.complete('fact_manifest'), default=0) + 1}-{uuid.uuid4().hex[:12]}"
    moving = where.filter(F.col("stored").isin(chosen))
    for name in FACTS:
        rows = wh.table(name).filter(F.col("segment").isin(chosen))
        keys = moving.select("source_id", F.col("stored").alias("segment"))
        write_facts(wh, name, rows.join(keys, ["source_id", "segment"], "left_semi"), target, by_range=True)
    moved = where.withColumn("stored", F.when(F.col("stored").isin(chosen), target).otherwise(F.col("stored")))
    version = max(wh.complete("fact_manifest"), default=0) + 1
    moved.filter("stored <> segment").select(*FACT_MANIFEST.names).write.mode("overwrite").parquet(wh.path(f"fact_manifest/version={version}"))
    return target


def vacuum(wh: Warehouse, now: datetime, grace: timedelta = timedelta(days=1)) -> list[str]:
    """Remove segments that have been without readers for the grace period; returns their names.

    A segment is without readers if no source is stored there and no file that is being loaded names it. The
    first run that finds it so only notes the time, as a query that was planned before may still read it.
    """
    state = wh.ledger_state()
    processing = STATUSES.index("PROCESSING") + 1
    loading = state.filter((F.col("code") == processing) & F.col("open_segment").isNotNull()).select(F.col("open_segment").alias("stored"))
    used = {r["stored"] for r in current_segments(wh).select("stored").union(loading).distinct().collect()}
    there = {segment for name in FACTS for segment in wh.partitions(name)}
    noted = {r["segment"]: r["retired_at"] for r in wh.table("retired_segments").groupBy("segment").agg(F.min("retired_at").alias("retired_at")).collect()}
    unused = there - used
    new = sorted(unused - set(noted))
    if new:
        wh.append("retired_segments", wh.spark.createDataFrame([(s, now) for s in new], TABLES["retired_segments"][0]))
    gone = sorted(s for s in unused if s in noted and noted[s] + grace <= now)
    for name in FACTS:
        for segment in gone:
            wh.remove(f"{name}/segment={segment}")
    versions = wh.complete("fact_manifest")
    for old in versions[:-2]:
        wh.remove(f"fact_manifest/version={old}")
    return gone
