"""Operator 13, embedding whitening from a bit-sliced scatter matrix.

Components become integers, and the covariance is that of the different vectors, each taken
once. Its cross-products come from bits: in a block of vectors every dimension is shifted by
its least value and cut into bit planes, each plane is packed across the rows into 64-bit
words, and the bits that two planes have in common are counted by AND and popcount. Weighted by
the planes' powers of two these counts are the exact sum of products, from which the shift is
taken out again. Blocks and tasks add up as integers, and n * sum(x y) - sum(x) * sum(y) centres
them as integers, so nothing is lost before the eigenvectors are worked out in doubles.

The shuffles carry each different vector once (equal ones are combined before it) and the sums,
one row for each pair of dimensions and task. Only sums reach the driver; vectors are projected
where they are.

Defined cases: which vectors count is said in `embeddings`; a component whose eigenvalue is not
above EMPTY times the largest has no direction of its own and no rows (a single vector has
none at all); of its two signs a component takes the one whose largest entry is positive;
deviations beyond a long become the largest long; repeated rows count once for the covariance
and are all returned; null ids stay; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import map_batches, save
from tillsight.llm.embeddings import LIMIT, exact, scaled, usable

SCALE = 256
COMPONENTS = 4
EMPTY = 1e-12
ROWS = 8192  # vectors of a block
LONGEST_LONG = (1 << 63) - 1


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the columns of an integer matrix and of their products, as Python integers."""
    n, width = x.shape
    least = x.min(0)
    shifted = (x - least).astype(np.uint64)
    planes = [int(m).bit_length() for m in shifted.max(0)]
    axis = np.repeat(np.arange(width), planes)
    bit = np.concatenate([np.arange(p) for p in planes])
    shifted = shifted.astype(np.uint16) if max(planes) <= 16 else shifted
    bits = (shifted[:, axis] >> bit.astype(shifted.dtype) & shifted.dtype.type(1)).astype(bool)
    packed = np.packbits(np.pad(bits, ((0, -n % 64), (0, 0))), axis=0)
    words = np.ascontiguousarray(packed.T).view(np.uint64)
    common = np.zeros((len(axis), len(axis)))
    for row in range(len(axis)):
        common[row, row:] = np.bitwise_count(words[row] & words[row:]).sum(1, dtype=np.uint16 if n < 1 << 16 else np.int64)
    common = np.triu(common) + np.triu(common, 1).T
    # Doubles hold these whole numbers exactly as long as no sum needs more than 53 bits.
    kind = np.float64 if 2 * max(planes) + n.bit_length() < 53 else object
    weights = np.zeros((len(axis), width), kind)
    weights[np.arange(len(axis)), axis] = [1 << int(b) for b in bit]
    whole = lambda a: (a if kind is object else a.astype(np.int64)).astype(object)
    counts = common if kind is np.float64 else common.astype(np.int64).astype(object)
    products, sums, shift = whole(weights.T @ counts @ weights), whole(np.diagonal(counts) @ weights), least.astype(object)
    products = products + np.outer(shift, sums) + np.outer(sums, shift) + n * np.outer(shift, shift)
    return sums + n * shift, products


@dataclass(frozen=True)
class Moments:
    """n different vectors, the sums of their components and of the products."""

    n: int
    sums: list[int]
    products: list[list[int]]

    def centred(self) -> np.ndarray:
        """n * n times the covariance, in Python integers."""
        sums = np.array(self.sums, object)
        return self.n * np.array(self.products, object).reshape(len(sums), -1) - np.outer(sums, sums)


@dataclass(frozen=True)
class Whitening:
    """The mean as sums over n vectors; directions (a column a component), their eigenvalues and shares of all variance."""

    n: int
    sums: list[int]
    directions: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    @staticmethod
    def of(moments: Moments, most: int | None = None) -> Whitening:
        around = moments.centred()
        covariance = np.array([[x / (moments.n * moments.n) for x in row] for row in around])
        values, directions = np.linalg.eigh(covariance)
        values, directions = values[::-1], directions[:, ::-1]
        many = int((values > EMPTY * max(values[0], 0.0)).sum())
        many = many if most is None else min(many, most)
        values, directions = values[:many], directions[:, :many]
        highest = directions[np.abs(directions).argmax(0), np.arange(many)]
        trace = sum(around.diagonal()) / (moments.n * moments.n)
        return Whitening(moments.n, moments.sums, directions * np.where(highest < 0, -1.0, 1.0), values, values / (trace or 1.0))

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact."""
        largest = 2 * self.n * max(int(np.abs(x).max(initial=0)), max(map(abs, self.sums), default=0) // self.n + 1)
        return exact(x, largest) * self.n - np.array(self.sums, np.int64 if largest < 1 << 63 else object)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.apart(x).astype(np.float64) / self.n @ (self.directions / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> list[int]:
        """The squared length of n * x - sums, exact."""
        away = self.apart(x)
        away = exact(away, int(np.abs(away).max(initial=0)) ** 2 * x.shape[1])
        return [min(LONGEST_LONG, int(d)) for d in (away * away).sum(1)]


def integers(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """rows as (x), the different integer vectors, written."""
    part = lambda c: F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-float(LIMIT))), F.lit(float(LIMIT))))
    return save(rows.select(F.transform(vector, part).cast("array<bigint>").alias("x")).groupBy("x").agg(F.lit(1).alias("one")).select("x"))


def moments(vectors: DataFrame, length: int) -> Moments:
    """The moments of integer vectors (column x)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(length, object), np.zeros((length, length), object)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                x = batch.column(0).slice(start, ROWS).flatten().to_numpy().reshape(-1, length)
                found = scatter(x)
                n, sums, products = n + len(x), sums + found[0], products + found[1]
        if n:
            upper = np.triu_indices(length)
            first = np.concatenate([[-1], np.full(length, -1), upper[0]])
            second = np.concatenate([[-1], np.arange(length), upper[1]])
            total = pa.array(map(Decimal, [n, *sums, *products[upper]]), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second), total], names=["i", "j", "total"])

    added = map_batches(vectors.select("x"), task, "i long, j long, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total"))
    n, sums, products = 0, [0] * length, [[0] * length for _ in range(length)]
    for i, j, total in added.collect():
        if j < 0:
            n = int(total)
        elif i < 0:
            sums[j] = int(total)
        else:
            products[i][j] = products[j][i] = int(total)
    return Moments(n, sums, products)


def identity_error(vectors: DataFrame, length: int, fitted: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance less the identity, from two passes: mean, then centred products."""
    many = len(fitted.values)

    def added(of) -> np.ndarray:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(many * many)
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS):
                    x = batch.column(0).slice(start, ROWS).flatten().to_numpy().reshape(-1, length)
                    part = of(fitted.project(x)).reshape(-1)
                    total[: len(part)] += part
            yield pa.RecordBatch.from_arrays([pa.array(range(many * many), pa.int64()), pa.array(total)], names=["i", "total"])

        summed = map_batches(vectors.select("x"), task, "i long, total double").groupBy("i").agg(F.sum("total").alias("total"))
        return np.array([t for _, t in sorted(map(tuple, summed.collect()))]) / fitted.n

    mean = added(lambda w: w.sum(0))[:many]
    covariance = added(lambda w: (w - mean).T @ (w - mean)).reshape(many, many)
    return float(np.abs(covariance - np.eye(many)).max())


def fit(rows: DataFrame, length: int, vector: str = "embedding", most: int | None = None) -> tuple[Whitening, float]:
    """The whitening of usable rows and its identity error; `most` components at most."""
    vectors = integers(rows, vector)
    fitted = Whitening.of(moments(vectors, length), most)
    return fitted, identity_error(vectors, length, fitted) if len(fitted.values) else 0.0


def whiten(rows: DataFrame, length: int, fitted: Whitening, vector: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """The columns to keep of usable rows, once for each component: component, n, deviation, whitened, explained."""
    new = ("component", "n", "deviation", "whitened", "explained")
    kept = [c for c in rows.columns if c not in (vector, *new)] if keep is None else keep
    types = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    many = len(fitted.values)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                piece = batch.slice(start, ROWS)
                x = scaled(piece.column(len(kept)), length, SCALE)
                each = pa.array(np.repeat(np.arange(len(x)), many))
                made = [
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * many, fitted.n)),
                    pa.array(fitted.deviation(x), pa.int64()).take(each), pa.array(fitted.project(x).reshape(-1)), pa.array(np.tile(fitted.explained, len(x))),
                ]
                yield pa.RecordBatch.from_arrays([*[c.take(each) for c in piece.columns[: len(kept)]], *made], names=[*kept, *new])

    schema = [*[types] * bool(types), "component int, n long, deviation long, whitened double, explained double"]
    return map_batches(rows.select(*kept, vector), task, ", ".join(schema))


def whitened_vectors(rows: DataFrame) -> DataFrame:
    """One row per usable row and component up to 4: vec_id, component, n, deviation, whitened, explained, identity_error."""
    kept, length = usable(rows.select("vec_id", "embedding"))
    if not length:
        return rows.sparkSession.createDataFrame([], f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    fitted, error = fit(kept, length, most=COMPONENTS)
    return whiten(kept, length, fitted).withColumn("identity_error", F.lit(error))
