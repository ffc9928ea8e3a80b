"""Pack documents into windows of tokens by deficit round-robin over source queues.

Each source is a queue of documents in hash order. A round is a window's worth of tokens: every
queue's deficit counter grows by its quantum, its share of the round by weight, and the queue is
served in bursts for as long as its deficit lasts; what is left of the deficit is carried on. A
queue that runs out gives its share to the others. The bursts served, round after round and
queue after queue, form one stream, which is cut every ``window`` tokens.

What a queue has been granted after a round is a piecewise linear function of the round, so a
task can tell the deficits at any round without the rounds before it: they carry across windows
and partitions without passing from task to task.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import bound_batches, running_before
from tickloom.llm.tokens import WordEncoder, tokenize

WINDOW = 2048
BURST = 128
MOST_QUEUES = 4096


class Rounds:
    """The schedule for queues of ``totals`` tokens served by ``weights``."""

    def __init__(self, totals: np.ndarray, weights: np.ndarray, window: int, burst: int):
        self.totals, self.weights = totals.astype(np.int64), weights.astype(float)
        self.window, self.burst, self.all = window, burst, int(totals.sum())
        # Time runs so that a queue is granted ``weight`` tokens per unit until it has none left.
        ends = np.unique(np.append(0.0, self.totals / self.weights))
        self.times = ends
        self.granted_by = np.array([np.minimum(self.totals, self.weights * t).sum() for t in ends])
        self.granted_by[-1] = self.all

    def granted(self, rounds: np.ndarray, queue: np.ndarray | slice) -> np.ndarray:
        """Tokens granted to queues by the end of rounds (broadcast against each other)."""
        time = np.interp(rounds * float(self.window), self.granted_by, self.times)
        return np.where(rounds * self.window >= self.all, self.totals[queue],
                        np.minimum(self.totals[queue], self.weights[queue] * time))

    def served(self, rounds: np.ndarray, queue: np.ndarray | slice) -> np.ndarray:
        """Tokens served: whole bursts of what is granted, and all once the queue has run out."""
        grant = self.granted(rounds, queue)
        whole = np.floor(grant / self.burst).astype(np.int64) * self.burst
        return np.where((rounds > 0) & (grant >= self.totals[queue]), self.totals[queue], np.minimum(whole, self.totals[queue]))

    def place(self, queue: np.ndarray, bursts: np.ndarray) -> np.ndarray:
        """Where in the stream bursts of queues begin."""
        upto = np.minimum((bursts + 1) * self.burst, self.totals[queue])
        time = upto / self.weights[queue]
        guess = np.ceil(np.interp(time, self.times, self.granted_by) / self.window).astype(np.int64)
        rounds = np.clip(guess, 1, None)
        while (late := self.served(rounds, queue) < upto).any():
            rounds = rounds + late
        while (early := (rounds > 1) & (self.served(rounds - 1, queue) >= upto)).any():
            rounds = rounds - early
        distinct, back = np.unique(rounds, return_inverse=True)
        order = np.argsort(back, kind="stable")
        cuts = np.searchsorted(back[order], np.arange(len(distinct) + 1))
        base = np.empty(len(rounds), np.int64)
        step = max(1, (1 << 19) // len(self.totals))
        for at in range(0, len(distinct), step):
            part = distinct[at : at + step, None]
            before, after = self.served(part - 1, slice(None)), self.served(part, slice(None))
            turn = np.cumsum(after - before, 1) - (after - before) + before.sum(1)[:, None]
            which = order[cuts[at] : cuts[min(at + step, len(distinct))]]
            base[which] = turn[back[which] - at, queue[which]]
        return base + bursts * self.burst - self.served(rounds - 1, queue)


def ranges(begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``begin, begin + 1, ...``, ``count`` of them, for every pair, and the pair each belongs to."""
    which = np.repeat(np.arange(len(count)), count)
    ends = np.cumsum(count)
    return np.arange(len(which)) + np.repeat(begin - (ends - count), count), which


def pieces_of(schedule: Rounds, queue: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, begin in it, length and place in the stream of the pieces of documents.

    A document is ``length`` tokens of its queue from ``start`` on, one at least. No piece crosses
    a window; neighbours in both document and stream are one piece.
    """
    burst, window = schedule.burst, schedule.window
    bursts, doc = ranges(start // burst, (start + length - 1) // burst - start // burst + 1)
    place = schedule.place(queue[doc], bursts)
    begin = np.maximum(bursts * burst, start[doc])
    end = np.minimum((bursts + 1) * burst, (start + length)[doc])
    place = place + begin - bursts * burst
    joins = np.append(False, (place[1:] == place[:-1] + (end - begin)[:-1]) & (doc[1:] == doc[:-1]))
    heads = np.flatnonzero(~joins)
    size = np.add.reduceat(end - begin, heads)
    begin, place, doc = begin[heads], place[heads], doc[heads]
    turn, which = ranges(place // window, (place + size - 1) // window - place // window + 1)
    low = np.maximum(place[which], turn * window)
    high = np.minimum((place + size)[which], (turn + 1) * window)
    return doc[which], begin[which] + low - place[which] - start[doc[which]], high - low, low


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(tokens: DataFrame, columns: list[str], weights: dict | None = None, window: int = WINDOW, burst: int = BURST,
         with_ids: bool = False) -> DataFrame:
    """One row per piece of ``tokens`` (``columns``, source, row, ids, n_tokens): ``columns`` and ``PIECES``.

    ``weights`` gives targets by source; without it the target is the source's share of all
    tokens, so that no queue runs out before the end. The ``MOST_QUEUES - 1`` largest sources
    have queues of their own, all others share one. All windows are full but the last.
    ``with_ids`` adds the ids of the piece as 16-bit integers.
    """
    spark = tokens.sparkSession
    bound_batches(spark)
    sums = tokens.groupBy("source").agg(F.sum("n_tokens").alias("n"))
    largest = sums.orderBy(F.desc("n"), "source").limit(MOST_QUEUES - 1).collect()
    everything = sums.agg(F.sum("n")).first()[0] or 0
    totals = [r["n"] for r in largest]
    shares = [float(weights.get(r["source"], 1.0)) if weights else float(r["n"]) for r in largest]
    if everything > sum(totals):
        totals.append(everything - sum(totals))
        shares.append(1.0 if weights else float(totals[-1]))
    schedule = Rounds(np.array(totals, np.int64), np.array(shares), window, burst) if totals else None
    rows = [(r["source"], i) for i, r in enumerate(largest)]
    queues = spark.createDataFrame(rows, "_source string, _queue int")
    rest = F.lit(len(largest))
    # At most MOST_QUEUES rows.
    narrow = tokens.select("row", "source", "n_tokens").join(F.broadcast(queues), F.col("source").eqNullSafe(F.col("_source")), "left")
    narrow = narrow.select("row", "n_tokens", F.coalesce("_queue", rest).alias("_queue"), F.md5(F.col("row").cast("string")).alias("_key"))
    starts = running_before(narrow, ["_queue"], "_key", "n_tokens", "_start", ["row"]).select(F.col("row").alias("_row"), "_queue", "_start")
    placed = tokens.join(starts, F.col("row") == F.col("_row")).select(*columns, "ids", "n_tokens", F.col("_queue").cast("long"), "_start")

    def cut(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = b"".join(batch.column("ids").to_pylist())
            ids = np.frombuffer(raw, "<u2")
            n = batch.column("n_tokens").to_numpy()
            starts, queues_ = batch.column("_start").to_numpy(), batch.column("_queue").to_numpy()
            doc, begin, length, place = pieces_of(schedule, queues_, starts, n)
            wide = memoryview(ids.astype("<u4").tobytes())
            first = (np.cumsum(n) - n)[doc] + begin
            spans = list(zip(first.tolist(), (first + length).tolist(), strict=True))
            crcs = pa.array([zlib.crc32(wide[4 * a : 4 * b]) for a, b in spans], pa.int64())
            taken = batch.select(columns).take(pa.array(doc))
            numbers = (pa.array(c.astype(np.int64)) for c in (n[doc], place // window, place % window))
            arrays = [*taken.columns, pa.array(begin), pa.array(length), crcs, *numbers]
            names = [*columns, *[c.split()[0] for c in PIECES.split(", ")]]
            if with_ids:
                arrays.append(pa.array([raw[2 * a : 2 * b] for a, b in spans], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.select(*columns).schema.fields)
    return placed.mapInArrow(cut, f"{kinds}, {PIECES}" + ", ids binary" * with_ids)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, **options) -> DataFrame:
    """Tokenize ``docs (doc_id, text, source)`` and pack them: ``doc_id`` and ``PIECES``.

    Null and empty texts are documents of one id, the end id. Every row is packed, also where
    ids repeat; a null source is a queue of its own. An empty table gives no pieces.
    """
    tokens = tokenize(docs.select("doc_id", F.col("source").cast("string"), "text"), tokenizer, WordEncoder, end_id, ["doc_id", "source"])
    return pack(tokens, ["doc_id"], **options)
