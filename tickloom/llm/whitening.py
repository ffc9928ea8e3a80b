"""Whitening of embeddings by spectral divide and conquer of their covariance.

Entries become whole numbers, ``floor(64 * c)``. Spark lists the distinct vectors, sums them, and
sums their centred products. What comes to the driver is one matrix, as large as the dimension
squared and independent of the number of rows. There QDWH iterations give the polar factor of the shifted
covariance; it is the sign function, so half of it plus the identity projects on the subspace
above the shift. Both subspaces are split again until single components are left. The components
are broadcast, and every task whitens its own rows.

Left out are rows whose vector is null, or has an entry that is null, not finite, or beyond
2**52 after scaling. If lengths differ, the length that most distinct vectors have counts (of equally
frequent ones the smallest), and rows of other lengths are left out; a vector of length 0 is no vector.
Repeated rows are whitened each, but count once in the covariance. A component
without variance (at most 1e-10 of the largest) cannot be whitened and has no rows; so a table
with a single distinct vector, or none, gives none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import bound_batches
from tickloom.session import materialise

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
NO_VARIANCE = 1e-10
_EXACT = float(1 << 52)
_WIDTHS = ("<i2", "<i4", "<i8")


# -- linear algebra of one small matrix ------------------------------------------------------


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by dynamically weighted Halley iterations.

    ``low`` bounds the smallest singular value from below and steers the weights; at most six or
    seven iterations bring it to 1 from 1e-16.
    """
    d = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(1.0, max(low, 1e-16)) if np.isfinite(low) else 1e-16
    for _ in range(30):
        e = np.cbrt(4 * (1 - low**2) / low**4)
        root = np.sqrt(1 + e)
        wa = root + 0.5 * np.sqrt(max(8 - 4 * e + 8 * (2 - low**2) / (low**2 * root), 0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(d)]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:d] @ q[d:].T
        else:
            z = np.eye(d) + wc * x.T @ x
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(z, x.T).T
        new = (new + new.T) / 2
        low = min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
        moved = np.linalg.norm(new - x)
        x = new
        if 1 - low < 1e-15 and moved < 1e-8:  # cubic convergence: the next step moves by rounding only
            break
    return x


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Shifts to try: between diagonal entries, the middle ones first, then random ones."""
    diagonal = np.sort(np.diag(a))
    middle = (len(a) - 1) / 2
    gaps = sorted(range(len(a) - 1), key=lambda i: abs(i + 0.5 - middle))
    yield from (float(diagonal[i] + diagonal[i + 1]) / 2 for i in gaps[:4])
    spread = np.linalg.norm(a - np.eye(len(a)) * diagonal.mean()) / np.sqrt(len(a))
    yield from (float(diagonal.mean() + t * spread) for t in np.random.default_rng(len(a)).uniform(-0.7, 0.7, 12))


def split(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of two invariant subspaces: eigenvalues above a shift, and below.

    A shift on an eigenvalue shows as a block between the subspaces that is not rounding; then another is tried.
    """
    d, best = len(a), None
    random = np.random.default_rng(d)
    for shift in _shifts(a):
        projector = (polar_factor(a - shift * np.eye(d)) + np.eye(d)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < d:
            continue
        basis = random.standard_normal((d, k))
        for _ in range(2):
            basis, _ = np.linalg.qr(projector @ basis)
        whole, _ = np.linalg.qr(np.hstack([projector @ basis, (np.eye(d) - projector) @ random.standard_normal((d, d - k))]))
        upper, lower = whole[:, :k], whole[:, k:]
        left = np.linalg.norm(lower.T @ a @ upper)
        if best is None or left < best[0]:
            best = left, upper, lower
        if left <= 8 * d * np.finfo(float).eps * scale:
            break
    if best is None:
        raise ArithmeticError("no shift splits the matrix")
    return best[1], best[2]


def spectrum(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``wanted`` eigenvalues of a symmetric matrix, falling, and their vectors as columns."""
    scale = np.linalg.norm(a)
    values, vectors = [], []

    def descend(block: np.ndarray, basis: np.ndarray) -> None:
        if len(values) >= wanted:
            return
        d = len(block)
        rest = block - np.eye(d) * np.trace(block) / d
        if np.linalg.norm(rest) <= d * np.finfo(float).eps * scale:  # one value, any basis will do
            values.extend([np.trace(block) / d] * d)
            vectors.extend(basis.T)
            return
        for part in split(block, scale):
            inner = part.T @ block @ part
            descend((inner + inner.T) / 2, basis @ part)

    descend((a + a.T) / 2, np.eye(len(a)))
    found = np.array(vectors[:wanted]).reshape(-1, len(a)).T
    energy = np.einsum("ij,ij->j", found, a @ found)
    order = np.argsort(-energy, kind="stable")
    found, energy = found[:, order], energy[order]
    if found.size:
        found = found * np.sign(found[np.abs(found).argmax(0), np.arange(found.shape[1])])
    return energy, found


# -- vectors as whole numbers ------------------------------------------------------------------


def _whole(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``floor(64 * c)`` of all entries, where each row begins, and which rows are usable."""
    if pa.types.is_fixed_size_list(column.type):
        column = column.cast(pa.list_(column.type.value_type))
    null_rows = np.asarray(column.is_null())
    offsets = np.asarray(column.offsets).astype(np.int64)
    entries = column.values[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    numbers = np.asarray(entries.cast(pa.float64()).fill_null(np.nan), dtype=float)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(SCALE * numbers)
        bad = ~(np.abs(scaled) <= _EXACT)
    before = np.concatenate([[0], np.cumsum(bad)])
    usable = ~null_rows & (before[offsets[1:]] == before[offsets[:-1]]) & (offsets[1:] > offsets[:-1])
    scaled[bad] = 0
    return scaled.astype(np.int64), offsets, usable


def _matrix(column: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the given length as a matrix, and where in the column they are."""
    entries, offsets, usable = _whole(column)
    rows = np.flatnonzero(usable & (np.diff(offsets) == dimension))
    return entries[offsets[rows][:, None] + np.arange(dimension)], rows


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as bytes, in the narrowest width that holds all entries: equal vectors, equal bytes."""
    for batch in batches:
        entries, offsets, usable = _whole(batch.column(0))
        rows = np.flatnonzero(usable)
        sizes, packed = np.diff(offsets)[rows], []
        for i in rows.tolist():
            row = entries[offsets[i] : offsets[i + 1]]
            widest = max(-int(row.min()) - 1, int(row.max()))
            width = _WIDTHS[(widest >= 1 << 15) + (widest >= 1 << 31)]
            packed.append(row.astype(width).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())], ["dim", "packed"])


def _unpack(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    rows = batch.column(0).to_pylist()
    out = np.zeros((len(rows), dimension), np.int64)
    for i, row in enumerate(rows):
        out[i] = np.frombuffer(row, f"<i{len(row) // dimension}")
    return out


# -- the fit -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """What tasks need: sums of the fit list, components as columns, their variance and its share."""

    n: int
    sums: tuple[int, ...]  # of floor(64 * c)
    vectors: np.ndarray
    variance: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def dimension(self) -> int:
        return len(self.sums)


def _products(fit: DataFrame, dimension: int, image) -> np.ndarray:
    """Sums of ``image(rows).T @ image(rows)`` over the fit list; tasks give one cell per row."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            rows = image(_unpack(batch, dimension))
            total = rows.T @ rows if total is None else total + rows.T @ rows
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "v"])

    cells = fit.select("packed").mapInArrow(multiply, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    found = cells.toPandas()
    d = int(found["j"].max()) + 1 if len(found) else 0
    out = np.zeros((d, d))
    out[found["i"], found["j"]] = out[found["j"], found["i"]] = found["v"]
    return out


def fit(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Components of the distinct usable vectors; None if there is no usable vector."""
    bound_batches(rows.sparkSession)
    listed = rows.select(column).mapInArrow(_pack, "dim int, packed binary").distinct()
    listed = materialise(listed, "vectors")
    lengths = listed.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    if not lengths:
        return None
    dimension, n = lengths[0]["dim"], lengths[0]["n"]
    listed = listed.filter(F.col("dim") == dimension)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # High and low parts, so that a batch cannot overflow whatever the entries are.
            x = _unpack(batch, dimension)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dimension)), pa.array((x >> 20).sum(0)), pa.array((x & 0xFFFFF).sum(0))], ["i", "high", "low"])

    parts = listed.select("packed").mapInArrow(add, "i bigint, high bigint, low bigint").groupBy("i").agg(
        F.sum(F.col("high").cast("decimal(30,0)")).alias("high"), F.sum(F.col("low").cast("decimal(30,0)")).alias("low"))
    sums = tuple((int(r["high"]) << 20) + int(r["low"]) for r in sorted(parts.collect(), key=lambda r: r["i"]))
    mean = _mean(sums, n)
    covariance = _products(listed, dimension, lambda x: _centred(x, mean)) / n
    total = float(np.trace(covariance))
    if total <= 0:
        return Whitening(n, sums, np.zeros((dimension, 0)), np.zeros(0), np.zeros(0), 0.0)
    variance, vectors = spectrum(covariance, min(components, dimension))
    there = variance > NO_VARIANCE * variance[0]
    variance, vectors = variance[there], vectors[:, there]
    scaled = vectors / np.sqrt(variance)
    # A column of ones beside the whitened rows gives their sums, and so their mean, in the same pass.
    seen = _products(listed, dimension, lambda x: np.hstack([_centred(x, mean) @ scaled, np.ones((len(x), 1))])) / n
    left = seen[:-1, :-1] - np.outer(seen[-1, :-1], seen[-1, :-1]) - np.eye(len(variance))
    return Whitening(n, sums, vectors, variance, variance / total, float(np.abs(left).max()))


def _mean(sums: Sequence[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole part and fraction of the mean of each dimension."""
    return np.array([s // n for s in sums], np.int64), np.array([(s % n) / n for s in sums])


def _centred(x: np.ndarray, mean: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return (x - mean[0]).astype(float) - mean[1]


def _deviation(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum of ``(n * x - S) ** 2``, exact; null where it does not fit 64 bits."""
    n, whole = model.n, np.array([s // model.n for s in model.sums], np.int64)
    part = np.array([s % model.n for s in model.sums], np.int64)
    size = np.abs(x - whole).max(initial=0) + 1.0
    if (n * size) ** 2 * model.dimension < 2.0**62:
        return ((n * (x - whole) - part) ** 2).sum(1).tolist()
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, model.sums, strict=True)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def whiten(rows: DataFrame, model: Whitening | None, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """A row per usable row and component: the ``key``, and the columns of the docstring's contract.

    Only ``key`` and ``column`` are read, so other columns cannot clash.
    """
    kind = rows.schema[key].dataType.simpleString()
    schema = (f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    spark = rows.sparkSession
    bound_batches(spark)
    if model is None:
        return rows.select(key).filter(F.lit(False)).mapInArrow(lambda batches: iter(()), schema)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k, mean = len(m.variance), _mean(m.sums, m.n)
        for batch in batches:
            x, at = _matrix(batch.column(1), m.dimension)
            if not len(at) or not k:
                continue
            # Blocks bound what a batch of short keys and many components becomes.
            for low in range(0, len(at), 4096):
                part = x[low : low + 4096]
                m_rows = len(part)
                values = (_centred(part, mean) @ m.vectors) / np.sqrt(m.variance)
                keys = batch.column(0).take(pa.array(np.repeat(at[low : low + 4096], k)))
                yield pa.RecordBatch.from_arrays([
                    keys, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m_rows)), pa.array(np.full(m_rows * k, m.n)),
                    pa.array(_deviation(part, m), pa.int64()).take(pa.array(np.repeat(np.arange(m_rows), k))),
                    pa.array(values.ravel()), pa.array(np.tile(m.explained, m_rows)), pa.array(np.full(m_rows * k, m.identity_error)),
                ], [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(key, column).mapInArrow(run, schema)
