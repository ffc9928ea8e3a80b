"""Token-id files: a static range asymmetric numeral system over interleaved lanes.

One table of token frequencies, counted over the whole corpus, serves all files. A file is a row
of blocks that know nothing of each other; a block holds whole documents. Its tokens are dealt to
``LANES`` coders that work in step and share one stream of 32-bit words. Every ``STRIDE`` steps a
checkpoint keeps the states of the lanes and the place in the stream, so that decoding may begin
there, and every block and every part between two checkpoints carries a checksum.

Layout of a file, all integers little-endian:

    "TLRANS01"                     magic
    block, block, ...              see ``encode_block``
    table of documents             doc_id int64, is_null uint8, n_tokens int64; zlib-compressed
    uint64 size of that table, uint32 its crc32, uint32 crc32 of the frequency table

The manifest, a Parquet table beside the files, has one row per block.
"""

from __future__ import annotations

import json
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import bound_batches
from tickloom.llm.tokens import ByteEncoder, tokenize
from tickloom.paths import arrow_path
from tickloom.session import scratch_path

MAGIC = b"TLRANS01"
LANES = 1024
STRIDE = 128
BLOCK_TOKENS = 1 << 19
SCALE = 20
LOW = np.uint64(1 << 31)
_32 = np.uint64(32)
_WORD = np.uint64(0xFFFFFFFF)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to ``2**SCALE``, at least 1 for every token that occurs."""
    total = int(counts.sum())
    if total == 0:
        return counts.astype(np.int64)
    room = (1 << SCALE) - int((counts > 0).sum())
    out = np.where(counts > 0, 1 + counts.astype(object) * room // total, 0).astype(np.int64)
    out[np.argmax(counts)] += (1 << SCALE) - int(out.sum())
    return out


class Table:
    """Frequencies and their running sums."""

    def __init__(self, counts: np.ndarray):
        self.freq = scaled(counts).astype(np.uint64)
        self.ends = np.cumsum(self.freq)
        self.begins = self.ends - self.freq
        self.spare = np.uint64(1 << SCALE) - self.freq
        self.token_at = None
        self.crc = zlib.crc32(self.freq.astype("<u4").tobytes())


    def tokens(self, slots: np.ndarray) -> np.ndarray:
        if self.token_at is None:
            self.token_at = np.repeat(np.arange(len(self.freq), dtype=np.uint16), self.freq.astype(np.int64))
        return self.token_at[slots]


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    """One block: uint32 tokens, uint32 parts; per part uint32 word offset, uint32 crc32 of its ids and
    the lane states (uint64); uint32 words; the words; uint32 crc32 of all of it.

    Token ``i`` goes to lane ``i % LANES`` in step ``i // LANES``. Encoding runs backwards, so that
    decoding runs forwards; the state noted at a checkpoint is the one that decoding has there.
    """
    steps = -(-len(ids) // LANES)
    freq, begins, spare = table.freq[ids], table.begins[ids], table.spare[ids]
    states = np.full(LANES, LOW, np.uint64)
    words, counts, marks = [], np.zeros(steps, np.int64), {}
    limit = np.uint64(63 - SCALE)
    for step in range(steps - 1, -1, -1):
        low = step * LANES
        f, b = freq[low : low + LANES], begins[low : low + LANES]
        x = states[: len(f)]
        full = x >= (f << limit)
        out = x[full]
        words.append((out & _WORD).astype("<u4"))
        counts[step] = len(out)
        x = np.where(full, x >> _32, x)
        # (x // f << SCALE) + x % f + b, with one division
        states[: len(f)] = x + (x // f) * spare[low : low + LANES] + b
        if step % STRIDE == 0:
            marks[step] = states.copy()
    before = np.cumsum(counts) - counts
    head = [np.array([len(ids), len(marks)], "<u4").tobytes()]
    for step in sorted(marks):
        part = ids[step * LANES : (step + STRIDE) * LANES]
        head.append(np.array([before[step], zlib.crc32(part.astype("<u4").tobytes())], "<u4").tobytes())
        head.append(marks[step].astype("<u8").tobytes())
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
    body = b"".join([*head, np.array([len(stream)], "<u4").tobytes(), stream.tobytes()])
    return body + np.array([zlib.crc32(body)], "<u4").tobytes()


def decode_block(block: bytes, table: Table, parts: range | None = None) -> np.ndarray:
    """The ids of a block, or of some of its parts; a checksum that fails is an error."""
    if zlib.crc32(block[:-4]) != int.from_bytes(block[-4:], "little"):
        raise ValueError("checksum of a block fails")
    n, n_parts = np.frombuffer(block, "<u4", 2).tolist()
    size = 8 + 8 * LANES
    at = 8 + n_parts * size
    n_words = int.from_bytes(block[at : at + 4], "little")
    words = np.frombuffer(block, "<u4", n_words, at + 4).astype(np.uint64)
    mask, shift = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    out = []
    for part in parts if parts is not None else range(n_parts):
        place, check = np.frombuffer(block, "<u4", 2, 8 + part * size).tolist()
        states = np.frombuffer(block, "<u8", LANES, 16 + part * size).astype(np.uint64)
        low, high = part * STRIDE * LANES, min(n, (part + 1) * STRIDE * LANES)
        ids = np.empty(high - low, np.uint16)
        for begin in range(0, high - low, LANES):
            x = states[: min(LANES, high - low - begin)]
            slot = x & mask
            token = table.tokens(slot)
            x = table.freq[token] * (x >> shift) + slot - table.begins[token]
            need = np.flatnonzero(x < LOW)
            x[need] = (x[need] << _32) | words[place : place + len(need)]
            place += len(need)
            states[: len(x)] = x
            ids[begin : begin + len(x)] = token
        if zlib.crc32(ids.astype("<u4").tobytes()) != check:
            raise ValueError("checksum of a part fails")
        out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, np.uint16)


def token_counts(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs in all rows; 65,536 numbers, whatever the corpus."""

    def count(batches):
        total = np.zeros(65536, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), "<u2")
            total += np.bincount(ids, minlength=65536)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(65536, np.int64)
    for row in rows:
        counts[row["id"]] = row["n"]
    return counts


MANIFEST = "file string, first_id long, first_null boolean, block int, offset long, size long, docs long, tokens long"


def write(tokens: DataFrame, folder: str, counts: np.ndarray) -> DataFrame:
    """Write ``(doc_id, ids)`` as files in ascending ``doc_id`` order; returns the manifest.

    Null ids come last; equal ids follow each other by their stored row number. Each task sorts
    its range of ids and writes one file: under a name of its own first, so that a second attempt
    or an attempt that is lost half-way leaves no file that the manifest names. The manifest is a
    Parquet table, which Spark commits as a whole.
    """
    table = Table(counts)

    def store(batches):
        system, root = arrow_path(folder)
        name = f"{uuid.uuid4().hex}.rans"
        stream, rows, at = None, [], len(MAGIC)
        held, held_ids, docs, lengths = [], 0, [], []
        block_docs = 0

        def flush():
            nonlocal held, held_ids, at, block_docs
            block = encode_block(np.concatenate(held).astype(np.int64), table)
            stream.write(block)
            first = docs[-block_docs]
            rows.append((name, first or 0, first is None, len(rows), at, len(block), block_docs, held_ids))
            at += len(block)
            held, held_ids, block_docs = [], 0, 0

        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                if stream is None:
                    system.create_dir(root, recursive=True)
                    stream = system.open_output_stream(f"{root}/{name}")
                    stream.write(MAGIC)
                part = np.frombuffer(ids.as_buffer(), "<u2")
                docs.append(doc)
                lengths.append(len(part))
                held.append(part)
                held_ids += len(part)
                block_docs += 1
                if held_ids >= BLOCK_TOKENS:
                    flush()
        if stream is None:
            return
        if block_docs:
            flush()
        known = np.array([d or 0 for d in docs], "<i8").tobytes() + np.array([d is None for d in docs], "u1").tobytes()
        index = zlib.compress(known + np.array(lengths, "<i8").tobytes(), 6)
        stream.write(index)
        stream.write(np.array([len(index)], "<u8").tobytes() + np.array([zlib.crc32(index), table.crc], "<u4").tobytes())
        stream.close()
        columns = [pa.array(c) for c in zip(*rows, strict=True)]
        columns[3] = columns[3].cast(pa.int32())
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in MANIFEST.split(", ")])

    order = [F.col("doc_id").isNull(), "doc_id", "row"]
    ranged = tokens.select("doc_id", "row", "ids").repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.drop("row").mapInArrow(store, MANIFEST).write.parquet(f"{folder}/manifest")
    spark = tokens.sparkSession
    frequencies = json.dumps([[int(i), int(n)] for i, n in enumerate(counts) if n])
    spark.createDataFrame([(frequencies,)], "frequencies string").coalesce(1).write.parquet(f"{folder}/table")
    return spark.read.parquet(f"{folder}/manifest")


def read_index(raw: bytes) -> tuple[list, np.ndarray]:
    """Document ids and token counts out of a decompressed table of documents."""
    raw = zlib.decompress(raw)
    n = len(raw) // 17
    known, null = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "u1", n, 8 * n)
    return [None if z else d for d, z in zip(known.tolist(), null.tolist(), strict=True)], np.frombuffer(raw, "<i8", n, 9 * n)


READ = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """``READ`` of every document, out of the files; ``ids`` (16 bits each) is null unless asked for.

    Blocks are read and decoded by as many tasks as there are blocks to go round. ``start``
    counts the ids before a document: those of the files and blocks before, added up over the
    manifest, and those before it in its block.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    pairs = json.loads(spark.read.parquet(f"{folder}/table").first()["frequencies"])
    counts = np.zeros(65536, np.int64)
    for number, n in pairs:
        counts[number] = n
    table = Table(counts)
    files = manifest.groupBy("file").agg(
        F.min(F.struct("first_null", "first_id")).alias("first"), F.sum("tokens").alias("file_tokens"),
        F.max(F.col("offset") + F.col("size")).alias("index_at"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # One row per file; equal first ids only occur where a file holds nothing but one id's rows.
    files = files.withColumn("base", F.coalesce(F.sum("file_tokens").over(before.orderBy("first", "file")), F.lit(0)))
    inside = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = manifest.withColumns({
        "tokens_before": F.coalesce(F.sum("tokens").over(inside), F.lit(0)),
        "docs_before": F.coalesce(F.sum("docs").over(inside), F.lit(0)),
    }).join(files.drop("first", "file_tokens"), "file")
    n = max(1, spark.sparkContext.defaultParallelism)
    blocks = blocks.select("file", "index_at", "offset", "size", "docs", "docs_before",
                           (F.col("base") + F.col("tokens_before")).alias("start"))
    blocks = blocks.repartition(max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file", "offset")

    def decode(batches):
        system, root = arrow_path(folder)
        last, index = None, None
        for batch in batches:
            for row in sorted(batch.to_pylist(), key=lambda r: (r["file"], r["offset"])):
                with system.open_input_file(f"{root}/{row['file']}") as source:
                    if row["file"] != last:
                        source.seek(0)
                        if source.read(8) != MAGIC:
                            raise ValueError(f"{row['file']} is no token file")
                        tail = source.read_at(16, source.size() - 16)
                        raw = source.read_at(int.from_bytes(tail[:8], "little"), row["index_at"])
                        if zlib.crc32(raw) != int.from_bytes(tail[8:12], "little"):
                            raise ValueError(f"checksum of the documents of {row['file']} fails")
                        if table.crc != int.from_bytes(tail[12:], "little"):
                            raise ValueError(f"{row['file']} was written with another table")
                        last, index = row["file"], read_index(raw)
                    block = source.read_at(row["size"], row["offset"])
                ids = decode_block(block, table)
                docs = index[0][row["docs_before"] : row["docs_before"] + row["docs"]]
                sizes = index[1][row["docs_before"] : row["docs_before"] + row["docs"]]
                ends = np.cumsum(sizes)
                wide = ids.astype("<u4")
                cuts = list(zip((ends - sizes).tolist(), ends.tolist(), strict=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64()), pa.array(row["start"] + ends - sizes), pa.array(sizes),
                    pa.array([zlib.crc32(wide[a:b].tobytes()) for a, b in cuts], pa.int64()),
                    pa.array([ids[a:b].astype("<u2").tobytes() if with_ids else None for a, b in cuts], pa.binary()),
                ], [c.split()[0] for c in READ.split(", ")])

    return blocks.mapInArrow(decode, READ)


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None) -> str:
    """Encode ``docs (doc_id, text)`` and write them as token files; returns their folder.

    Null and empty texts are documents of one id, the end id. Rows of one ``doc_id`` are all kept.
    An empty table writes no file.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    folder = folder or scratch_path(spark, "token-files")
    tokens = tokenize(docs.select(F.col("doc_id").cast("long"), "text"), tokenizer, ByteEncoder, end_id, ["doc_id"])
    write(tokens, folder, token_counts(tokens))
    return folder


