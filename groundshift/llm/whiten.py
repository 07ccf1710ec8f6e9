"""Whitening of embeddings from an exact, bit-sliced scatter matrix.

Entries become whole numbers ``x = floor(scale * c)``. The fit list holds every
distinct x vector once. Each dimension, less its smallest x, is cut into bit
planes: word ``w`` of plane ``b`` holds bit ``b`` of 64 rows. The cross-product of
two dimensions is then the sum of ``2^(a+b)`` times the bits set in the AND of
plane ``a`` of one and plane ``b`` of the other, exactly. Spark adds the products
of all tasks as limbs of 32 bits; they are centred as whole numbers,
``n * sum(xy) - sum(x) * sum(y)``, and only then divided and handed to ``eigh``.
The driver holds numbers by pair of dimensions, whatever the rows.

Rows whose vector is null, or holds a null or a non-finite entry, are left out, as
are rows whose vector has another length than most rows have (of equally many,
the longer length counts). Null ids are kept, repeated rows give repeated
results; equal x vectors count once in the fit. An x outside 64 bits becomes the
nearest long. A deviation beyond a long is NULL. A component whose eigenvalue is
zero up to rounding has no whitened value (NULL) and no part in the identity
error; without any spread ``explained`` is NULL. No rows give no rows; columns
other than id and vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from groundshift.llm.scratch import stored

#: Rows whose planes are built and multiplied at once.
BLOCK = 1 << 15
#: 32-bit limbs of a sum of products: two 64-bit factors and 2^31 terms fit.
LIMBS = 5
LONG = np.iinfo(np.int64)


def whole(flat: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * c)`` as longs, the nearest one where it lies outside."""
    with np.errstate(over="ignore"):
        x = np.floor(flat.astype(np.float64) * scale)
    out = np.clip(x, -(2.0**63), 2.0**62).astype(np.int64)
    big = x >= 2.0**62
    out[big] = [min(int(v), LONG.max) if v < np.inf else LONG.max for v in x[big]]
    return out


def vectors_of(batch: pa.RecordBatch, at: int, dims: int) -> np.ndarray:
    return batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def shifted(x: np.ndarray, low: np.ndarray) -> np.ndarray:
    """``x - low`` as unsigned numbers; the difference of two longs always fits."""
    return x.view(np.uint64) - low.view(np.uint64)


def planes(y: np.ndarray, bits: int) -> np.ndarray:
    """Words ``[dimension * bits + bit, word]`` of the rows of ``y``, 64 rows a word."""
    rows, dims = y.shape
    padded = np.zeros((-(-rows // 64) * 64, dims), np.uint64)
    padded[:rows] = y
    out = np.empty((dims, bits, len(padded) // 64), np.uint64)
    for b in range(bits):
        one = (padded >> np.uint64(b) & np.uint64(1)).astype(np.uint8)
        out[:, b] = np.packbits(one, axis=0, bitorder="little").T.copy().view("<u8")
    return out.reshape(dims * bits, -1)


def cross_products(y: np.ndarray, bits: int) -> list[list[int]]:
    """Sums of products of every two dimensions (upper triangle), by AND and popcount of bit planes."""
    dims = y.shape[1]
    words = planes(y, bits)
    total = [[0] * dims for _ in range(dims)]
    for i in range(dims):
        by_weight = np.zeros((2 * bits - 1, dims - i), np.int64)
        for a in range(bits):
            one = words[i * bits + a]
            if not one.any():
                continue
            both = np.bitwise_count(words[i * bits :] & one).sum(axis=1, dtype=np.int64).reshape(dims - i, bits)
            by_weight[a : a + bits] += both.T
        for s, counts in enumerate(by_weight.tolist()):
            for j, count in enumerate(counts):
                total[i][i + j] += count << s
    return total


def plane_sums(y: np.ndarray, bits: int) -> list[int]:
    """Sum of every dimension."""
    ones = np.bitwise_count(planes(y, bits)).sum(axis=1, dtype=np.int64).reshape(y.shape[1], bits)
    return [sum(int(c) << b for b, c in enumerate(row)) for row in ones]


def limbs(value: int) -> list[int]:
    return [value >> (32 * k) & 0xFFFFFFFF for k in range(LIMBS)]


@dataclass
class Whitening:
    """``n`` vectors with sums ``sums``; ``axes[:, k]`` is component ``k + 1`` with eigenvalue ``values[k]``."""

    n: int
    sums: list[int]
    low: np.ndarray
    high: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def live(self) -> np.ndarray:
        """Components whose eigenvalue is more than rounding."""
        return self.values > self.trace * len(self.sums) * 2.0**-52

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, in longs where no entry can leave them, else in Python numbers."""
        reach = max(
            [max(abs(self.n * int(a) - s), abs(self.n * int(b) - s), self.n * max(abs(int(a)), abs(int(b))), abs(s)) for a, b, s in zip(self.low, self.high, self.sums)],
            default=0,
        )
        if reach <= LONG.max:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def deviations(self, moved: np.ndarray) -> list[int | None]:
        """Sum of squares of each row, exact; None beyond a long."""
        if moved.dtype != object and moved.size and len(self.sums) * int(np.abs(moved).max()) ** 2 <= LONG.max:
            return (moved * moved).sum(axis=1).tolist()
        sums = [sum(int(v) ** 2 for v in row) for row in moved]
        return [s if s <= LONG.max else None for s in sums]

    def project(self, moved: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows of ``n * x - S``; NaN where a component has none."""
        scale = np.where(self.live, np.sqrt(np.where(self.live, self.values, 1.0)), np.nan)
        return (moved.astype(np.float64) / self.n) @ self.axes / scale


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """``vec_id, v``: rows with a whole, finite vector, as doubles."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.where(F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))


def fit_list(rows: DataFrame, dims: int, scale: float) -> DataFrame:
    """``x``: every distinct x vector once, as the octets of its longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(vectors_of(batch, 0, dims), scale)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary())], ["x"])

    # copies meet in the partial aggregate of their task first
    return stored(rows.select("v").mapInArrow(run, "x binary").distinct(), "fit-list")


def _x(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8").reshape(-1, dims)


def fit(rows: DataFrame, dims: int, scale: float, components: int) -> tuple[Whitening | None, DataFrame]:
    """The whitening of the fit list of ``rows(v)``, and that list."""
    listed = fit_list(rows, dims, scale)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _x(batch, dims)
                out = [np.arange(dims), x.min(axis=0), x.max(axis=0), np.full(dims, len(x))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["d", "low", "high", "n"])

    found = listed.mapInArrow(edges, "d long, low long, high long, n long").groupBy("d")
    found = sorted(found.agg(F.min("low"), F.max("high"), F.sum("n")).collect())  # one row per dimension
    if not found:
        return None, listed
    low, high = (np.array([r[k] for r in found], np.int64) for k in (1, 2))
    n, bits = found[0][3], max(1, int(shifted(high, low).max()).bit_length())

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = [[0] * dims for _ in range(dims)], [0] * dims
        for batch in batches:
            y = shifted(_x(batch, dims), low)
            for at in range(0, len(y), BLOCK):
                part = cross_products(y[at : at + BLOCK], bits)
                total = [[a + b for a, b in zip(r, s)] for r, s in zip(total, part)]
                sums = [a + b for a, b in zip(sums, plane_sums(y[at : at + BLOCK], bits))]
        out = [(i, j, *limbs(total[i][j])) for i in range(dims) for j in range(i, dims)]
        out += [(-1, j, *limbs(sums[j])) for j in range(dims)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["i", "j", *names])

    names = [f"l{k}" for k in range(LIMBS)]
    parts = listed.mapInArrow(scatter, "i long, j long, " + ", ".join(f"{m} long" for m in names))
    sums, product = [0] * dims, [[0] * dims for _ in range(dims)]
    for r in parts.groupBy("i", "j").agg(*[F.sum(m).alias(m) for m in names]).collect():  # dims * (dims + 3) / 2 rows
        value = sum(r[m] << (32 * k) for k, m in enumerate(names))
        if r.i < 0:
            sums[r.j] = value
        else:
            product[r.i][r.j] = product[r.j][r.i] = value
    # whole numbers over n^2: Python divides them with one rounding
    cov = np.array([[(n * product[i][j] - sums[i] * sums[j]) / n**2 for j in range(dims)] for i in range(dims)])
    values, axes = np.linalg.eigh(cov)
    keep = np.argsort(-values, kind="stable")[:components]
    trace = sum(n * product[i][i] - sums[i] ** 2 for i in range(dims)) / n**2
    sums = [s + n * int(m) for s, m in zip(sums, low)]
    return Whitening(n, sums, low, high, axes[:, keep], np.maximum(values[keep], 0.0), trace), listed


def identity_error(listed: DataFrame, model: Whitening) -> float | None:
    """Largest difference from the identity of the covariance of the whitened fit list."""
    live, dims = np.flatnonzero(model.live), len(model.sums)
    if not len(live):
        return None
    names = [f"w{k}" for k in live]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = model.project(model.centred(_x(batch, dims)))
            yield pa.RecordBatch.from_arrays([pa.array(w[:, k]) for k in live], names)

    rows = listed.mapInArrow(run, ", ".join(f"{m} double" for m in names))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    found = rows.agg(*[F.covar_pop(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]).first()
    return float(max(abs(c - (a == b)) for c, (a, b) in zip(found, pairs)))


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, vector: str = "embedding", scale: float = 256.0, components: int = 4) -> DataFrame:
    """Every usable row of ``vectors(vec_id, <vector>)`` on the first components of the fit list."""
    spark = vectors.sparkSession
    rows = usable(vectors, vector)
    length = rows.where(F.size("v") > 0).groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if length is None:
        return spark.createDataFrame([], SCHEMA)
    dims = length.dims
    rows = rows.where(F.size("v") == dims)
    model, listed = fit(rows, dims, scale, components)
    error = identity_error(listed, model)
    share = [float(v / model.trace) if model.trace > 0 else None for v in model.values]
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            moved = model.centred(whole(vectors_of(batch, 1, dims), scale))
            far, w, k = pa.array(model.deviations(moved), pa.int64()), model.project(moved), len(share)
            each = pa.array(np.repeat(np.arange(batch.num_rows), k))
            count, values = batch.num_rows * k, w.reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(count, model.n)),
                    far.take(each),
                    pa.array(values, mask=np.isnan(values)),
                    pa.array(share * batch.num_rows, pa.float64()),
                    pa.array([error] * count, pa.float64()),
                ],
                names,
            )

    return rows.mapInArrow(run, SCHEMA)
