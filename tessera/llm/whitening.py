"""PCA whitening of embeddings from upper-triangle column aggregates.

Components become integers x = floor(scale * c). The fit list holds each distinct x vector once. One aggregation over it
gives its size n and every dimension's sum S, exactly. A second one is generated: a sum of centred products for every pair of
dimensions i <= j, tile by tile of the upper triangle. `assemble` makes the symmetric covariance V of those sums, LAPACK (`numpy.linalg.eigh`) decomposes it
on the driver, and rows are projected in Arrow batches.

Products are of whole numbers: a dimension is centred on the whole number m nearest to its mean, and
(S/n - m)(S'/n - m') goes from the mean product. So a sum of products is exact, and the same in any order, as long as it stays below 2**53, and
nothing cancels, as m is within a half of the mean. Beyond 2**53 sums round like any double.

What goes to the driver is bounded by the dimensions D: D sums, about D (D + 1) / 2 products. Copies of a vector are folded before they are shuffled, so a
vector that holds a third of all rows is one row a task.

Defined results: vectors that are null or hold null, NaN or infinite entries, or one whose x doesn't fit 64 bits, take no part and give no rows; repeated
rows and rows without an id each give rows; shorter vectors have zeros behind; `deviation` is null where it doesn't fit 64 bits; a component whose
eigenvalue is zero (to double precision) has a null `whitened`; `explained` is null where no dimension varies, `identity_error` where no component is whitened; vectors
of fewer dimensions than components asked for have as many components as dimensions; extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

#: Dimensions of a tile's side.
TILE = 8
_FITS = float(1 << 63)


def quantised(rows: DataFrame, vector: str = "embedding", scale: float = 256.0, keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """The columns `keep` and x, long numbers floor(scale * c), of every usable vector."""
    usable = F.forall(F.col("x"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(_FITS)))
    scaled = F.transform(F.col(f"`{vector}`").cast("array<double>"), lambda c: c * F.lit(float(scale)))
    rows = rows.select(*(F.col(f"`{c}`") for c in keep), scaled.alias("x")).where(F.col("x").isNotNull() & usable)
    return rows.select(*(F.col(f"`{c}`") for c in keep), F.transform("x", lambda c: F.floor(c).cast("long")).alias("x"))


def fit_list(vectors: DataFrame, dims: int) -> DataFrame:
    """Every distinct vector once, with zeros behind the shorter ones."""
    return vectors.select(_padded(dims).alias("x")).distinct()


def _padded(dims: int) -> Column:
    x = F.col("x")
    return F.when(F.size(x) == dims, x).otherwise(F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size(x))))


def sums(fit: DataFrame, dims: int) -> tuple[int, list[int], list[tuple[int, int]]]:
    """The list's size, and each dimension's exact sum, least and greatest number."""
    blocks, each = -(-dims // TILE), range(TILE)
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), blocks * TILE - dims))
    rows = fit.select(filled.alias("x"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("i")).select("i", *(F.expr(f"x[{TILE} * i + {u}] AS a{u}") for u in each))
    found = rows.groupBy("i").agg(F.count(F.lit(1)), *(f(F.col(f"a{u}")) for u in each for f in (lambda c: F.sum(c.cast("decimal(19,0)")), F.min, F.max))).collect()
    flat = [v for r in sorted(found, key=lambda r: r[0]) for v in r[2:]]
    return found[0][1], [int(v) for v in flat[: 3 * dims : 3]], list(zip(flat[1 : 3 * dims : 3], flat[2 : 3 * dims : 3], strict=True))


def cross_products(rows: DataFrame, dims: int) -> np.ndarray:
    """The symmetric matrix of sums of products over the array column y: one aggregation with a generated sum for every pair of dimensions.

    The upper triangle is cut into tiles of TILE x TILE pairs, which are its groups: 2,080 sums in one row took 7 times as long as
    36 groups of 64 (16.2 and 2.3 s for 51,282 vectors on local[8]).
    """
    blocks = -(-dims // TILE)
    tiles = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(blocks) for j in range(i, blocks)))
    rows, each = rows.select("y", F.explode(tiles).alias("tile")).select("y", "tile.*"), range(TILE)
    rows = rows.select("i", "j", *(F.expr(f"coalesce(get(y, {TILE} * {i} + {u}), 0D) AS {c}{u}") for i, c in ("ia", "jb") for u in each))
    out = np.zeros((blocks * TILE, blocks * TILE))
    for r in rows.groupBy("i", "j").agg(*(F.expr(f"sum(a{u} * b{v}) AS p{u}_{v}") for u in each for v in each)).toLocalIterator():
        part = np.array(r[2:]).reshape(TILE, TILE)
        at, to = slice(TILE * r["i"], TILE * r["i"] + TILE), slice(TILE * r["j"], TILE * r["j"] + TILE)
        out[at, to], out[to, at] = part, part.T
    return out[:dims, :dims]


def assemble(products: np.ndarray, n: int, rest: np.ndarray) -> np.ndarray:
    """The covariance, divisor n, of products about points that lie `rest` below the means."""
    return products / n - np.outer(rest, rest)


def decompose(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as rows; each one's largest entry is positive."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors.T[::-1]
    largest = vectors[np.arange(len(vectors)), np.abs(vectors).argmax(1)]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)[:, None]


@dataclass(frozen=True)
class Whitening:
    """A fitted transform; `whiten[k]` is component k over the root of its eigenvalue, None where that is zero."""

    n: int
    sums: list[int]
    ranges: list[tuple[int, int]]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def means(self) -> list[float]:
        return [s / self.n for s in self.sums]

    def whiten(self, k: int) -> np.ndarray | None:
        noise = len(self.sums) * np.finfo(float).eps * self.eigenvalues[0]
        return self.components[k] / np.sqrt(self.eigenvalues[k]) if self.eigenvalues[k] > noise else None

    def projected(self, x: np.ndarray, k: int) -> np.ndarray | None:
        """x - S/n for the rows of x, on component k, over the root of its eigenvalue."""
        return None if (weights := self.whiten(k)) is None else (x - np.array(self.means)) @ weights

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sums over dimensions of (n*x - S)**2: in 64 bits where the numbers' ranges prove that they fit, else in Python's integers."""
        most = [max(abs(self.n * low), abs(self.n * high)) + abs(s) for s, (low, high) in zip(self.sums, self.ranges, strict=True)]
        if sum(m * m for m in most) < 1 << 63:
            return ((self.n * x - np.array(self.sums)) ** 2).sum(1).tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist())
        return [d if d < 1 << 63 else None for d in exact]


def fit(embeddings: DataFrame, components: int = 4, vector: str = "embedding", scale: float = 256.0) -> Whitening | None:
    """The whitening transform of a table; None where it has no usable vector of a dimension or more.

    The fit list is written once, read by four aggregations and deleted.
    """
    vectors = quantised(embeddings, vector, scale, ())
    dims = vectors.agg(F.max(F.size("x"))).first()[0] or 0
    if not dims:
        return None
    fit = common.staged(fit_list(vectors, dims), "whitening_fit")
    try:
        n, totals, ranges = sums(fit, dims)
        centres = [(2 * s + n) // (2 * n) for s in totals]
        wide = "a - c" if all(max(-low, high, abs(c)) < 1 << 62 for (low, high), c in zip(ranges, centres, strict=True)) else "CAST(a AS DECIMAL(20,0)) - c"
        y = F.expr(f"zip_with(x, array({', '.join(f'{c}L' for c in centres)}), (a, c) -> CAST({wide} AS DOUBLE))")
        rest = np.array([(s - n * c) / n for s, c in zip(totals, centres, strict=True)])
        covariance = assemble(cross_products(fit.select(y.alias("y")), dims), n, rest)
        values, axes = decompose(covariance)
        model = Whitening(n, totals, ranges, values, axes, float(np.trace(covariance)))
        usable = [k for k in range(min(components, dims)) if model.whiten(k) is not None]
        return Whitening(n, totals, ranges, values, axes, model.trace, _identity_error(fit, model, usable))
    finally:
        common.drop_staged(fit)


def _identity_error(fit: DataFrame, model: Whitening, usable: list[int]) -> float | None:
    """The largest absolute entry of the covariance of the whitened fit list, as measured on its rows, minus the identity."""
    if not usable:
        return None
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["x"], len(model.sums))
            yield pa.RecordBatch.from_arrays([pa.array(model.projected(x, k)) for k in usable], names)

    names = [f"w{k}" for k in usable]
    rows = fit.mapInArrow(project, ", ".join(f"{w} double" for w in names))
    means = rows.agg(*(F.avg(c) for c in rows.columns)).first()
    centred = rows.select(F.array(*(F.col(c) - F.lit(m) for c, m in zip(rows.columns, means, strict=True))).alias("y"))
    found = cross_products(centred, len(usable)) / model.n
    return float(np.abs(found - np.eye(len(usable))).max())


def _matrix(x: pa.Array, dims: int) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), dims)


_SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def transform(embeddings: DataFrame, model: Whitening, components: int = 4, vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """A row for each usable vector and component."""
    dims = len(model.sums)
    count = min(components, dims)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        explained = [float(e / model.trace) if model.trace > 0 else None for e in model.eigenvalues[:count]]
        for batch in batches:
            x, rows = _matrix(batch["x"], dims), batch.num_rows
            whitened = np.full((rows, count), np.nan)
            for k in range(count):
                if (y := model.projected(x, k)) is not None:
                    whitened[:, k] = y
            each = pa.array(np.repeat(np.arange(rows), count))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"].take(each),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, model.n)),
                    pa.array(model.deviations(x), pa.int64()).take(each),
                    pa.array(whitened.ravel(), from_pandas=True),
                    pa.array(explained * rows, pa.float64()),
                    pa.array([model.identity_error] * (rows * count), pa.float64()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    rows = quantised(embeddings, vector, scale).select(F.col("vec_id").cast("long").alias("vec_id"), _padded(dims).alias("x"))
    return rows.mapInArrow(project, _SCHEMA)


def whiten(embeddings: DataFrame, components: int = 4, vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """Fit on a table and transform it."""
    model = fit(embeddings, components, vector, scale)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], _SCHEMA)
    return transform(embeddings, model, components, vector, scale)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every usable vector of `embeddings`."""
    return whiten(common.table(spark, sf_dir, "embeddings"))


QUERIES = {"op11_whitening": op11_whitening}
#: SQL has no eigenvectors; tests hold the query against numpy.
SQL: dict[str, str] = {}
