"""Whitening of embeddings by eigenvectors refined in higher precision.

Entries become whole numbers, so that the distributed sums are exact: each task
sums the products of its distinct vectors, taken from a whole number next to the
mean, and Spark adds the tasks' sums per entry of the matrix. What the centre lacks
to the mean is corrected in whole numbers, too, and the covariance rounded once.

Its eigenvectors begin as those of the matrix in float32. Each step of the iteration
by Ogita and Aishima is made of matrix products in extended precision: from what the
vectors lack to being orthonormal (R) and to diagonal form (S) it forms the correction
(S + lambda R) / (gap of the eigenvalues), and the error squares with each step. Where
gaps are no larger than the error that is left, only orthogonality is corrected, and
the cluster is solved as a small problem of its own, with its mean eigenvalue taken off.

The driver holds matrices of the size of a vector squared, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import spare, stored

#: An entry c counts as the whole number floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries from here on, whose multiples doubles do not hold to the unit, count as not finite.
LARGEST = 2.0**46
COMPONENTS = 16
#: The widest vectors; the driver holds some matrices of this many rows and columns.
MAX_WIDTH = 4096
#: Steps of the refinement at most; it takes three or four, and some more for clusters.
STEPS = 40
#: Whole numbers up to here are exact in doubles.
EXACT = 2**53
#: Sums of a task are sent on before they could leave 64 bits.
SENT_FROM = 2**61

#: Bits of a digit in which larger sums are sent.
DIGIT = 40

SUMS = T.StructType([
    T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()),
    T.StructField("digit", T.IntegerType()), T.StructField("total", T.LongType()),
])
MOMENTS = T.StructType([
    T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("total", T.DoubleType()),
])


class Whitening(NamedTuple):
    """What is fitted: whole-number sums, and components by falling eigenvalue."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray


def usable(vector: Column) -> Column:
    """Vectors that take part: not NULL, and no entry NULL, not finite or beyond ``LARGEST``."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def whole(vector: Column) -> Column:
    """A vector's entries as whole numbers."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("bigint"))


def extended(rows: np.ndarray) -> np.ndarray:
    """Whole numbers as Python's, which have no bound."""
    return rows.astype(object)


def products(rows: np.ndarray) -> np.ndarray:
    """The sum of all rows' products of entry with entry, exactly."""
    width = rows.shape[1]
    top = int(np.abs(rows).max(initial=0))
    if top * top > EXACT:
        return extended(rows).T @ extended(rows)
    block = max(1, EXACT // max(1, top * top))
    total = np.zeros((width, width), object if top * top * len(rows) >= SENT_FROM else np.int64)
    for start in range(0, len(rows), block):
        part = rows[start : start + block].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


def _matrices(stream: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in stream:
        yield np.asarray(batch.column(0).flatten(), np.int64).reshape(-1, width)


def _sent(total: np.ndarray, schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """A matrix's entries as rows; Python's whole numbers by their digits to the base 2^DIGIT."""
    i, j = (pa.array(k) for k in np.indices(total.shape, np.int32).reshape(2, -1))
    if total.dtype != object:
        kind = pa.int64() if total.dtype == np.int64 else pa.float64()
        digit = [pa.array(np.zeros(total.size, np.int32))] if "digit" in schema.names else []
        yield pa.RecordBatch.from_arrays([i, j, *digit, pa.array(total.ravel(), kind)], schema.names)
        return
    rest, place = total.ravel(), 0
    while rest.any():
        low = [v & (2**DIGIT - 1) if abs(v) >= 2**DIGIT else v for v in rest]
        digit = pa.array(np.full(total.size, place, np.int32))
        yield pa.RecordBatch.from_arrays([i, j, digit, pa.array(low, pa.int64())], schema.names)
        rest, place = np.array([(v - w) >> DIGIT for v, w in zip(rest, low)], object), place + 1


def _added(fit: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all vectors of whole-number matrices, as Python's whole numbers."""

    def tasks(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.int64)
        for rows in _matrices(stream, width):
            part = of(rows)
            if part.dtype == object or int(np.abs(part).max(initial=0)) >= SENT_FROM:
                yield from _sent(part.astype(object), SUMS)
                continue
            if int(np.abs(total).max(initial=0)) >= SENT_FROM:
                yield from _sent(total, SUMS)
                total = np.zeros(shape, np.int64)
            total = total + part
        yield from _sent(total, SUMS)

    sums = fit.select("x").mapInArrow(tasks, SUMS)
    out = np.zeros(shape, object)
    for r in sums.groupBy("i", "j", "digit").agg(F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")).collect():
        out[r["i"], r["j"]] += int(r["total"]) << (DIGIT * r["digit"])
    return out


def refined(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, in extended precision."""
    kind = np.longdouble
    width = len(matrix)
    size = np.trace(matrix)
    if width == 0 or not size > 0:
        return np.zeros(width, kind), np.eye(width, dtype=kind)
    a = (matrix / size).astype(kind)
    unit = np.eye(width, dtype=kind)
    vectors = np.linalg.eigh(a.astype(np.float32))[1].astype(kind)
    norm = np.sqrt((a * a).sum())
    floor = 64 * width * np.finfo(kind).eps * norm
    for _ in range(STEPS):
        r = unit - vectors.T @ vectors
        s = vectors.T @ (a @ vectors)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # symmetric to the last bit, so that corrections do not shear
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        vectors, values, r, s = vectors[:, order], values[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
        off = s - np.diag(np.diag(s))
        left = max(2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum())), floor)
        gaps = values[None, :] - values[:, None]
        close = np.abs(gaps) <= left
        change = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, gaps))
        vectors = vectors + vectors @ change
        ends = np.flatnonzero(np.append(values[:-1] - values[1:] > left, True)) + 1
        clusters = [(a0, a1) for a0, a1 in zip(np.append(0, ends[:-1]), ends) if a1 - a0 > 1]
        for start, stop in clusters:
            own = vectors[:, start:stop]
            inner = own.T @ (a @ own) - values[start:stop].mean() * (own.T @ own)
            scale = np.abs(inner).max()
            if scale > 0:
                vectors[:, start:stop] = own @ np.linalg.eigh((inner / scale).astype(np.float64))[1][:, ::-1].astype(kind)
        if left <= floor and np.abs(change).max() < np.finfo(np.float64).eps / 16:
            break
    vectors = vectors + vectors @ ((unit - vectors.T @ vectors) / 2)
    values = np.einsum("ij,ij->j", vectors, a @ vectors) * size
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def fit_vectors(fit: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """Fits distinct whole-number vectors in a column ``x``, all ``width`` wide; None without any.

    Components whose variance is 0, as far as doubles can tell, are left out.
    """
    n = fit.count()
    if n == 0 or width == 0:
        return None
    sums = _added(fit, width, lambda rows: _plain_sums(rows), (1, width))[0].tolist()
    centre = [(2 * s + n) // (2 * n) for s in sums]
    by = np.array(centre, np.int64)
    gram = _added(fit, width, lambda rows: products(rows - by), (width, width))
    rest = [s - n * c for s, c in zip(sums, centre)]
    exact = [[n * int(gram[i, j]) - rest[i] * rest[j] for j in range(width)] for i in range(width)]
    square = n * n
    matrix = np.array([[_rounded(v, square) for v in row] for row in exact])
    trace = Fraction(sum(exact[i][i] for i in range(width)), square)
    values, vectors = refined(matrix)
    kept = int((values[:components] > width * np.finfo(np.float64).eps * max(values[0], 0)).sum())
    values, vectors = values[:kept].astype(np.float64), vectors[:, :kept].astype(np.float64)
    return Whitening(n, sums, vectors, values, values / float(trace) if trace else values)


def _plain_sums(rows: np.ndarray) -> np.ndarray:
    if int(np.abs(rows).max(initial=0)) * max(1, len(rows)) >= SENT_FROM:
        return extended(rows).sum(axis=0)[None, :] if len(rows) else np.zeros((1, rows.shape[1]), np.int64)
    return rows.sum(axis=0)[None, :]


def _rounded(over: int, under: int) -> np.longdouble:
    """A ratio of whole numbers in extended precision: the double next to it and what is left."""
    first = over / under
    rest = Fraction(over, under) - Fraction(first)
    return np.longdouble(first) + np.longdouble(float(rest))


def centred(rows: np.ndarray, fitted: Whitening) -> np.ndarray:
    """Whole-number vectors minus the mean, in double precision."""
    centre = np.array([(2 * s + fitted.n) // (2 * fitted.n) for s in fitted.sums], np.int64)
    rest = np.array([(s - fitted.n * int(c)) / fitted.n for s, c in zip(fitted.sums, centre)])
    return (rows - centre).astype(np.float64) - rest


def projected(rows: np.ndarray, fitted: Whitening) -> np.ndarray:
    """Whitened vectors, a column per component."""
    return centred(rows, fitted) @ fitted.vectors / np.sqrt(fitted.values)


def deviations(rows: np.ndarray, fitted: Whitening) -> list[int | None]:
    """The sum over dimensions of (n x - S)^2, exactly; None beyond 64 bits."""
    n, width = fitted.n, rows.shape[1]
    centre = np.array([(2 * s + n) // (2 * n) for s in fitted.sums], np.int64)
    rest = [s - n * int(c) for s, c in zip(fitted.sums, centre)]
    apart = rows - centre
    top = n * (int(np.abs(apart).max(initial=0)) + 1)
    if top * top * width < 2**63:
        far = n * apart - np.array(rest, np.int64)
        return (far * far).sum(axis=1).tolist()
    far = n * extended(apart) - np.array(rest, object)
    return [int(v) if v < 2**63 else None for v in (far * far).sum(axis=1)] if len(far) else []


def identity_error(fit: DataFrame, width: int, fitted: Whitening) -> float:
    """The largest entry, without sign, of the whitened fit list's covariance minus the identity."""
    size = len(fitted.values)
    if size == 0:
        return 0.0

    def tasks(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for rows in _matrices(stream, width):
            found = projected(rows, fitted)
            total[:size] += found.T @ found
            total[size] += found.sum(axis=0)
        yield from _sent(total, MOMENTS)

    out = np.zeros((size + 1, size))
    for r in fit.select("x").mapInArrow(tasks, MOMENTS).groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        out[r["i"], r["j"]] = r["total"] / fitted.n
    # The vectors were centred before; what is left of their mean is rounding.
    return float(np.abs(out[:size] - np.outer(out[size], out[size]) - np.eye(size)).max())


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Rows whose vector is usable, with ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    ``whitened`` and ``explained`` are arrays, an entry per component from the largest
    variance on; ``n`` counts distinct vectors, and ``identity_error`` measures the
    whitened ones over the whole fit list. ``deviation`` is NULL if it exceeds 64 bits.
    Rows with a NULL vector, or with a NULL or not finite entry, are left out. Repeated
    rows stay, and weigh once in the fit. Vectors of several widths are fitted by width;
    beyond ``MAX_WIDTH`` is a ValueError. Where no variance is left, as with a single
    distinct vector or none, ``whitened`` is empty or has fewer components. Columns of
    the new names are replaced, all others kept.
    """
    new = {"n": "bigint", "deviation": "bigint", "whitened": "array<double>", "explained": "array<double>", "identity_error": "double"}
    x = spare([*rows.columns, *new], "_x")
    found = rows.where(usable(F.col(vector))).withColumn(x, whole(F.col(vector)))
    own = [c for c in rows.columns if c.lower() not in new]
    fit = stored(found.select(F.col(x).alias("x")).distinct(), "whitening-fit")
    widths = sorted(r["width"] for r in fit.select(F.size("x").alias("width")).distinct().collect())
    if widths and widths[-1] > MAX_WIDTH:
        raise ValueError(f"vectors of {widths[-1]} entries; at most {MAX_WIDTH}")
    schema = T.StructType([*rows.select(*own).schema.fields, *T._parse_datatype_string(", ".join(f"{k} {t}" for k, t in new.items())).fields])
    parts = []
    for width in widths or [0]:
        part = fit.where(F.size("x") == width)
        fitted = fit_vectors(part, width, components)
        of_width = found.where(F.size(x) == width).select(*own, x)
        if fitted is None:
            count = part.count()
            parts.append(of_width.drop(x).select(
                *own, F.lit(count).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("deviation"),
                F.array().cast("array<double>").alias("whitened"), F.array().cast("array<double>").alias("explained"),
                F.lit(0.0).alias("identity_error"),
            ))
        else:
            parts.append(of_width.mapInArrow(_whitened(x, own, width, fitted, identity_error(part, width, fitted)), schema))
    whole_result = parts[0]
    for part in parts[1:]:
        whole_result = whole_result.unionByName(part)
    return whole_result


def _whitened(x: str, own: list[str], width: int, fitted: Whitening, error: float):
    names = [*own, "n", "deviation", "whitened", "explained", "identity_error"]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            at = batch.schema.names.index(x)
            rows = np.asarray(batch.column(at).flatten(), np.int64).reshape(-1, width)
            found = projected(rows, fitted)
            count, size = found.shape
            ends = pa.array(np.arange(count + 1, dtype=np.int32) * size)
            yield pa.RecordBatch.from_arrays(
                [
                    *[c for k, c in enumerate(batch.columns) if k != at],
                    pa.array(np.full(count, fitted.n), pa.int64()),
                    pa.array(deviations(rows, fitted), pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(found.ravel(), pa.float64())),
                    pa.ListArray.from_arrays(ends, pa.array(np.tile(fitted.explained, count), pa.float64())),
                    pa.array(np.full(count, error), pa.float64()),
                ],
                names,
            )

    return batches
