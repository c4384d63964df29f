"""Embedding whitening from exact integer covariances.

Entries become fixed-point integers x = floor(256 * c).  The fit list is each
distinct x vector once (a hash aggregate over packed vectors).

1. Sums, least and largest values of each dimension over the fit list.
2. Bit-sliced scatter: a dimension's values, shifted to start at 0, are cut into bit
   planes and each plane is packed across rows into 64-bit words.  The sum of u * v
   over rows is the sum over planes a of u and b of v of 2**(a+b) * popcount(a & b):
   exact integers, whatever the order in which tasks are added.
3. The driver gets one number for each pair of dimensions, centres them as integers
   (n * sum(u*v) - sum(u) * sum(v)) and takes eigenvectors of the covariance.
4. Each row is centred as an integer vector (n*x - S), projected and scaled.

What the driver and the tasks hold is dimensions squared, whatever the rows.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StructField, StructType

from .common import prepare, stored

SCALE = 256
#: Rows and entries that a task unpacks at once.
BLOCK_ROWS, BLOCK_ENTRIES = 1 << 14, 1 << 22
#: Bit planes of other dimensions that a plane is met with at once.
PLANES_AT_ONCE = 4096
MOST_DIMENSIONS = 1 << 12
LONG = np.iinfo(np.int64)
BIG = "decimal(38,0)"


def usable(vector: str) -> Column:
    """A vector without null, NaN or infinite entries."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(F.forall(F.col(vector), lambda c: F.coalesce(finite(c.cast("double")), F.lit(False))), F.lit(False))


def fixed_point(column: pa.Array, width: int) -> np.ndarray:
    """x of each vector (rows x width); entries that a shorter vector lacks are 0,
    values beyond a long become its least or largest."""
    n = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) * SCALE)
    inside = np.abs(flat) < 2.0**63
    whole = np.where(inside, flat, 0).astype(np.int64)
    whole[~inside] = np.where(flat[~inside] > 0, LONG.max, LONG.min)
    if (n == width).all():
        return whole.reshape(len(n), width)
    out = np.zeros((len(n), width), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = whole
    return out


def pack(x: np.ndarray) -> list[bytes]:
    """Bytes of each row, equal for equal rows: entries in the fewest of 1, 2, 4 or 8 bytes that hold the row."""
    low, high = (x.min(1), x.max(1)) if x.shape[1] else (np.zeros(len(x), np.int64),) * 2
    out = [b""] * len(x)
    left = np.ones(len(x), bool)
    for kind in ("<i1", "<i2", "<i4", "<i8"):
        fits = left & (low >= np.iinfo(kind).min) & (high <= np.iinfo(kind).max)
        data = x[fits].astype(kind)
        for k, row in zip(np.flatnonzero(fits).tolist(), data):
            out[k] = row.tobytes()
        left &= ~fits
    return out


def unpack(packed: pa.Array, width: int) -> np.ndarray:
    """The rows that ``pack`` has packed."""
    rows = packed.to_pylist()
    out = np.zeros((len(rows), width), np.int64)
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    for n in (1, 2, 4, 8):
        some = np.flatnonzero(size == n * width) if width else []
        if len(some):
            out[some] = np.frombuffer(b"".join(rows[k] for k in some.tolist()), f"<i{n}").reshape(len(some), width)
    return out


def plane_products(u: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Exact sums of u[:, i] * u[:, j] over the rows for i <= j (else 0), as Python
    integers; ``u`` is unsigned and column i has ``bits[i]`` bits."""
    d = u.shape[1]
    total = np.zeros((d, d), object)
    used = np.flatnonzero(bits)
    if not len(used) or not len(u):
        return total
    words = -(-len(u) // 64)
    planes = np.zeros((int(bits.sum()), words * 8), np.uint8)
    first = np.zeros(d + 1, np.int64)
    first[1:] = np.cumsum(bits)
    for i in used.tolist():
        for b in range(int(bits[i])):
            packed = np.packbits((u[:, i] >> np.uint64(b) & np.uint64(1)).astype(bool))
            planes[first[i] + b, :len(packed)] = packed
    planes = planes.view(np.uint64)
    power = np.arange(first[-1]) - np.repeat(first[:-1], bits)
    # counts are at most the block's rows: shifted by two powers they stay inside a long
    exact = np.int64 if 2 * int(bits.max()) + int(len(u) * 64).bit_length() < 62 else object
    weight = np.array([1 << int(p) for p in power], exact)
    runs, lo = [], 0
    while lo < len(used):
        hi = max(lo + 1, int(np.searchsorted(first[used + 1], first[used[lo]] + PLANES_AT_ONCE, "right")))
        runs.append(used[lo:hi])
        lo = hi
    for some in runs:
        a, b = int(first[some[0]]), int(first[some[-1] + 1])
        starts = first[some] - a
        part = np.zeros((d, len(some)), exact)
        for i in used[used <= some[-1]].tolist():
            for p in range(int(first[i]), int(first[i + 1])):
                counts = np.bitwise_count(planes[p] & planes[a:b]).sum(1, dtype=np.int64)
                part[i] += np.add.reduceat(counts * weight[a:b], starts) * weight[p]
        total[:, some] = part
    return np.triu(total)


@dataclass(frozen=True)
class Fit:
    """n vectors, their sums and ranges by dimension, and the components."""

    n: int
    sums: list[int]
    low: list[int]
    high: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        exact = self.n * self.largest() + max(map(abs, self.sums), default=0) < 1 << 62
        return x * np.int64(self.n) - np.array(self.sums, np.int64) if exact else x.astype(object) * self.n - np.array(self.sums, object)

    def largest(self) -> int:
        return max(map(abs, [*self.low, *self.high]), default=0)

    def most_deviation(self) -> int:
        return len(self.sums) * (self.n * self.largest() + max(map(abs, self.sums), default=0)) ** 2

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """The components of each row that has been centred; NaN where a component has no spread."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.values > 0, 1 / np.sqrt(self.values), np.nan)
        return (centred / self.n).astype(np.float64) @ self.vectors * scale


def fit_list(rows: DataFrame, vector: str, width: int) -> DataFrame:
    """``packed``: each distinct x vector of ``rows`` once."""

    def packed(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(pack(fixed_point(b.column(0), width)), pa.binary())], names=["packed"])

    return stored(rows.select(vector).mapInArrow(packed, "packed binary").distinct(), "fit-list")


def _slices(batches, width: int) -> Iterator[pa.RecordBatch]:
    rows = max(64, min(BLOCK_ROWS, BLOCK_ENTRIES // width))
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _blocks(batches, width: int) -> Iterator[np.ndarray]:
    for part in _slices(batches, width):
        yield unpack(part.column("packed"), width)


def _ranges(listed: DataFrame, width: int) -> tuple[int, list[int], list[int], list[int]]:
    """n and, by dimension, the sum, least and largest value."""

    def partial(batches):
        n, sums, low, high = 0, np.zeros(width, object), np.full(width, LONG.max), np.full(width, LONG.min)
        for x in _blocks(batches, width):
            n += len(x)
            # two halves, as a column's sum may pass a long
            sums = sums + (x >> np.int64(32)).sum(0).astype(object) * (1 << 32) + (x & np.int64(0xFFFFFFFF)).sum(0).astype(object)
            low, high = np.minimum(low, x.min(0, initial=LONG.max)), np.maximum(high, x.max(0, initial=LONG.min))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(np.full(width, n), pa.int64()), pa.array(list(map(Decimal, sums)), pa.decimal128(38)), pa.array(low, pa.int64()), pa.array(high, pa.int64())],
                                             names=["i", "n", "s", "low", "high"])

    got = listed.mapInArrow(partial, f"i int, n long, s {BIG}, low long, high long").groupBy("i").agg(F.sum("n"), F.sum("s"), F.min("low"), F.max("high")).orderBy("i").collect()
    return (got[0][1] if got else 0, [int(r[2]) for r in got], [r[3] for r in got], [r[4] for r in got])


def _scatter(listed: DataFrame, low: list[int], high: list[int]) -> np.ndarray:
    """Sums of u_i * u_j (i <= j) over the fit list, u = x - low: Python integers."""
    width = len(low)
    bits = np.array([(h - x).bit_length() for x, h in zip(low, high)], np.int64)

    def partial(batches):
        total = np.zeros((width, width), object)
        for x in _blocks(batches, width):
            # the difference of two longs fits 64 unsigned bits
            total = total + plane_products(x.view(np.uint64) - np.array(low, np.int64).view(np.uint64), bits)
        i, j = np.nonzero(total)
        if len(i):
            of = total[i, j].tolist()
            # two parts, as a sum may pass 38 digits
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array([Decimal(v) for v in part], pa.decimal128(38)) for part in ([v >> 64 for v in of], [v & (1 << 64) - 1 for v in of]))],
                                             names=["i", "j", "upper", "lower"])

    total = np.zeros((width, width), object)
    for i, j, upper, lower in listed.mapInArrow(partial, f"i int, j int, upper {BIG}, lower {BIG}").groupBy("i", "j").agg(F.sum("upper"), F.sum("lower")).toLocalIterator():
        total[i, j] = (int(upper) << 64) + int(lower)
    return total


def covariance(n: int, sums: list[int], low: list[int], products: np.ndarray) -> np.ndarray:
    """The covariance (divisor n) from integer sums; each entry is rounded once."""
    d = len(sums)
    shifted = [s - n * x for s, x in zip(sums, low)]
    out = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            out[i, j] = out[j, i] = (n * products[i, j] - shifted[i] * shifted[j]) / (n * n)
    return out


def components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first eigenvalues, their unit vectors as columns and their shares of the
    trace; a value that is only rounding is 0."""
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    values = np.where(values > len(v) * np.finfo(float).eps * max(values[0], 0), values, 0.0) if len(values) else values
    trace = float(np.trace(v))
    return values, vectors, values / trace if trace > 0 else np.full(len(values), np.nan)


def _identity_error(listed: DataFrame, fit: Fit) -> float | None:
    """The largest absolute entry of the whitened covariance less the identity, over the fit list."""
    width, some = len(fit.sums), np.flatnonzero(fit.values > 0)
    if not len(some):
        return None

    def partial(batches):
        sums, products = np.zeros(len(some)), np.zeros((len(some), len(some)))
        for x in _blocks(batches, width):
            w = fit.whitened(fit.centred(x))[:, some]
            sums, products = sums + w.sum(0), products + w.T @ w
        a, b = np.indices(products.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.full(len(some), -1), a]), pa.int32()), pa.array(np.concatenate([np.arange(len(some)), b]), pa.int32()), pa.array(np.concatenate([sums, products.reshape(-1)]))], names=["a", "b", "s"])

    mean, second = np.zeros(len(some)), np.zeros((len(some), len(some)))
    for a, b, s in listed.mapInArrow(partial, "a int, b int, s double").groupBy("a", "b").agg(F.sum("s")).collect():
        (mean if a < 0 else second[a])[b] = s / fit.n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(len(some))).max())


def fit_whitening(vectors: DataFrame, vector: str = "embedding", most: int = 4) -> Fit | None:
    """The components of the usable vectors; None if there are none or they have no entries."""
    prepare(vectors.sparkSession)
    rows = vectors.where(usable(vector)).select(vector)
    width = rows.agg(F.max(F.size(vector))).first()[0] or 0
    if not width:
        return None
    if width > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {width} entries: covariances of up to {MOST_DIMENSIONS} dimensions are taken")
    listed = fit_list(rows, vector, width)
    n, sums, low, high = _ranges(listed, width)
    values, axes, explained = components(covariance(n, sums, low, _scatter(listed, low, high)), most)
    fit = Fit(n, sums, low, high, values, axes, explained)
    return replace(fit, identity_error=_identity_error(listed, fit))


def whiten(vectors: DataFrame, vector: str = "embedding", name: str = "vec_id", most: int = 4) -> DataFrame:
    """(name, component, n, deviation, whitened, explained, identity_error) for each
    usable row of ``vectors`` and each of its first ``most`` components.

    Rows whose vector is null or has a null, NaN or infinite entry are left out; so
    are all rows if no vector has an entry.  A vector shorter than the longest has 0
    in the places it lacks; entries whose x is beyond a long are its least or
    largest.  Repeated rows are each returned, but count once in the fit, as do rows
    with equal x.  A component without spread (fewer distinct vectors than
    components, constant dimensions) has a null ``whitened`` and explains 0; with no
    spread at all ``explained`` and ``identity_error`` are null.  ``deviation`` is a
    long, or decimal(38,0) if it may pass one (null beyond 38 digits).  Names may be
    null; other columns are not read.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[name].dataType
    fit = fit_whitening(vectors, vector, most)
    big = fit is not None and fit.most_deviation() > LONG.max
    schema = StructType([StructField("name", kind), StructField("component", IntegerType()), StructField("n", LongType()), StructField("deviation", DecimalType(38, 0) if big else LongType()),
                         *(StructField(c, DoubleType()) for c in ("whitened", "explained", "identity_error"))])
    if fit is None:
        return spark.createDataFrame([], schema).withColumnRenamed("name", name)
    width, many = len(fit.sums), len(fit.values)
    explained = pa.array(fit.explained, pa.float64(), from_pandas=True)
    name_type = to_arrow_type(kind)

    def project(batches):
        for part in _slices(batches, width):
            centred = fit.centred(fixed_point(part.column(1), width))
            deviation = ((centred.astype(object) if big else centred) ** 2).sum(1)
            deviation = pa.array([Decimal(v) if v < 10**38 else None for v in deviation.tolist()], pa.decimal128(38)) if big else pa.array(deviation.astype(np.int64))
            row, component = pa.array(np.repeat(np.arange(part.num_rows), many)), np.tile(np.arange(many), part.num_rows)
            yield pa.RecordBatch.from_arrays([
                part.column(0).cast(name_type).take(row), pa.array(component + 1, pa.int32()), pa.array(np.full(len(row), fit.n), pa.int64()), deviation.take(row),
                pa.array(fit.whitened(centred).reshape(-1), pa.float64(), from_pandas=True), explained.take(pa.array(component)), pa.array([fit.identity_error] * len(row), pa.float64())], names=schema.names)

    out = vectors.where(usable(vector)).select(F.col(name).alias("name"), F.col(vector).alias("vector")).mapInArrow(project, schema)
    return out.withColumnRenamed("name", name)
