"""Centroid clustering in integers with a PCA-rotated filter.

Vectors are scaled to integers and written once with their leading coordinates in the
rotation of the principal components, the norm of what these leave out, and the integers.
For any rotation, the squared distance to a centroid is at least that of the leading
coordinates plus the squared difference of the two residual norms. This bound, one small
matrix product a batch, leaves few centroids a vector; those are compared in integers, so
every assignment is exact, ties going to the smaller number.

A round sends back sums of the clusters only: 16 centroids of 64 components, in digits
of 30 bits, so that sums are exact for any number of vectors and any size of component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, spread
from .common import slices

# Integers up to here have distances within 64 bits; vectors beyond are compared in Python's integers.
NARROW = 1 << 27
_DIGIT = 30
_LONGEST = 2**63 - 1


@dataclass(frozen=True)
class Settings:
    clusters: int = 16
    dims: int = 64
    scale: int = 64
    rounds: int = 3
    leading: int = 12  # rotated coordinates in the filter
    seed: int = 1


def whole(value: float, scale: int) -> int:
    """floor(scale * value), exact for any finite double."""
    numerator, denominator = float(value).as_integer_ratio()
    return scale * numerator // denominator


def kept(embeddings: DataFrame, settings: Settings) -> DataFrame:
    """vec_id and values of the vectors with the right number of components, none of them null or non-finite."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("values"))
    # With a null component exists() is null, and so is false here; NaN is greater than any number.
    finite = F.coalesce(~F.exists("values", lambda x: x.isNull() | (F.abs(x) > 1.7976931348623157e308)), F.lit(False))
    return rows.where((F.size("values") == settings.dims) & finite)


def _integers(values: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Scaled integers (vector, component), and which vectors are too wide for them."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    wide = ~(np.abs(scaled) <= NARROW).all(1)
    scaled[wide] = 0
    return scaled.astype(np.int64), wide


def _matrix(column: pa.Array, dims: int, kind=np.float64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dims)


def rotation(vectors: DataFrame, settings: Settings) -> np.ndarray:
    """The leading principal directions (direction, component) of all vectors of narrow integers.

    One pass sums products; each task sends its sums, which are added up by component pair.
    Any rotation gives right results, so what is summed in doubles need not be exact.
    """
    dims = settings.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            x, wide = _integers(_matrix(batch.column(0), dims), settings.scale)
            x = np.hstack([x[~wide], np.ones(((~wide).sum(), 1))]).astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["at", "value"])

    sums = vectors.select("values").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((dims + 1) ** 2)
    for r in sums:
        total[r["at"]] = r["value"]
    total = total.reshape(dims + 1, dims + 1)
    n = max(total[-1, -1], 1.0)
    mean = total[-1, :-1] / n
    spread_of = total[:-1, :-1] / n - np.outer(mean, mean)
    _, directions = np.linalg.eigh(spread_of)
    return directions[:, ::-1][:, : settings.leading].T.copy()


def _turn(x: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates, and the norm of what they leave out."""
    lead = x @ directions.T
    rest = x - lead @ directions
    return lead, np.sqrt((rest**2).sum(1))


def prepare(vectors: DataFrame, directions: np.ndarray, settings: Settings) -> DataFrame:
    """vec_id, integers, leading coordinates and residual norm; a wide vector has its ``values`` instead of them."""
    dims = settings.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column(1), dims)
            x, wide = _integers(values, settings.scale)
            lead, rest = _turn(x.astype(float), directions)
            some = lambda rows, mask, kind: pa.array([None if m else r for r, m in zip(rows, mask, strict=True)], pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), some(x.astype(np.int32), wide, pa.int32()), some(lead, wide, pa.float64()), pa.array(rest), some(values, ~wide, pa.float64())],
                ["vec_id", "x", "lead", "rest", "values"],
            )

    return vectors.mapInArrow(run, "vec_id long, x array<int>, lead array<double>, rest double, values array<double>")


class Centroids:
    """The centroids as Python integers, with their form for the filter."""

    def __init__(self, rows: list[tuple[int, ...]], directions: np.ndarray):
        self.rows = rows
        self.wide = [any(abs(v) > NARROW for v in r) for r in rows]
        self.x = np.array([[0] * len(r) if w else r for r, w in zip(rows, self.wide, strict=True)], np.int64).reshape(len(rows), directions.shape[1])
        self.lead, self.rest = _turn(self.x.astype(float), directions)

    def nearest(self, x: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, list[int] | np.ndarray]:
        """The nearest centroid of each vector and its squared distance, exact.

        The centroid of the least bound gives a distance no greater than which the answer
        is; only centroids whose bound does not exceed it are compared.
        """
        n, rows = len(x), np.arange(len(x))
        bound = (lead**2).sum(1)[:, None] - 2 * lead @ self.lead.T + (self.lead**2).sum(1)[None, :] + (rest[:, None] - self.rest[None, :]) ** 2
        # The rounding of sums of terms up to the squared norms, many times over.
        norms = (lead**2).sum(1) + rest**2
        slack = 1e-9 * (norms[:, None] + ((self.lead**2).sum(1) + self.rest**2)[None, :]) + 1e-6
        bound -= slack
        narrow = [j for j, w in enumerate(self.wide) if not w]
        if not narrow:
            return self.nearest_wide([[int(v) for v in r] for r in x])
        best = np.array(narrow)[bound[:, narrow].argmin(1)]
        distance = ((x - self.x[best]) ** 2).sum(1)
        for j in narrow:
            pick = rows[(bound[:, j] <= distance) & (best != j)]
            if len(pick):
                d = ((x[pick] - self.x[j]) ** 2).sum(1)
                closer = (d < distance[pick]) | ((d == distance[pick]) & (j < best[pick]))
                best[pick[closer]], distance[pick[closer]] = j, d[closer]
        for j in (j for j, w in enumerate(self.wide) if w):
            # A wide centroid may still be nearest to a narrow vector.
            for i in range(n):
                d = sum((int(a) - b) ** 2 for a, b in zip(x[i], self.rows[j], strict=True))
                if (d, j) < (int(distance[i]), int(best[i])):
                    best[i], distance[i] = j, d
        return best, distance

    def nearest_wide(self, rows: list[list[int]]) -> tuple[np.ndarray, list[int]]:
        found = [min((sum((a - b) ** 2 for a, b in zip(row, c, strict=True)), j) for j, c in enumerate(self.rows)) for row in rows]
        return np.array([j for _, j in found], np.int64), [d for d, _ in found]


def _assigned(batch: pa.RecordBatch, centroids: Centroids, settings: Settings) -> tuple[np.ndarray, list[int], list]:
    """Cluster and distance of each vector of a batch of ``prepare``, and the integers."""
    dims, n = settings.dims, batch.num_rows
    x_column = batch.column(batch.schema.get_field_index("x"))
    wide = x_column.is_null().to_numpy(zero_copy_only=False)
    cluster, distance, integers = np.zeros(n, np.int64), [0] * n, [None] * n
    narrow = np.flatnonzero(~wide)
    if len(narrow):
        part = batch.filter(pa.array(~wide))
        pick = lambda name: part.column(part.schema.get_field_index(name))
        x = _matrix(pick("x"), dims, np.int64)
        cluster[narrow], d = centroids.nearest(x, _matrix(pick("lead"), settings.leading), pick("rest").to_numpy())
        for i, value, row in zip(narrow.tolist(), [int(v) for v in d], x, strict=True):
            distance[i], integers[i] = value, row
    values = batch.column(batch.schema.get_field_index("values"))
    for i in np.flatnonzero(wide).tolist():
        row = [whole(v, settings.scale) for v in values[i].as_py()]
        (cluster[i],), (distance[i],) = centroids.nearest_wide([row])
        integers[i] = row
    return cluster, distance, integers


def _digits(value: int) -> Iterator[tuple[int, int]]:
    """(position, digit) of a number in signed digits of 30 bits."""
    sign, value, at = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield at, sign * (value & ((1 << _DIGIT) - 1))
        value, at = value >> _DIGIT, at + 1


def _sums(prepared: DataFrame, centroids: Centroids, settings: Settings) -> tuple[list[int], list[list[int]]]:
    """Vectors and component sums of every cluster, exact."""
    k, dims = len(centroids.rows), settings.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = [0] * k, [[0] * dims for _ in range(k)]
        for whole_batch in batches:
            for batch in slices([whole_batch], 4096):
                cluster, _, integers = _assigned(batch, centroids, settings)
                for j in np.unique(cluster).tolist():
                    mine = [integers[i] for i in np.flatnonzero(cluster == j).tolist()]
                    counts[j] += len(mine)
                    narrow = [r for r in mine if isinstance(r, np.ndarray)]
                    # 4096 narrow vectors sum within 64 bits.
                    part = np.sum(narrow, axis=0).tolist() if narrow else [0] * dims
                    for r in (r for r in mine if not isinstance(r, np.ndarray)):
                        part = [a + b for a, b in zip(part, r, strict=True)]
                    sums[j] = [a + b for a, b in zip(sums[j], part, strict=True)]
        out = [(j, -1, 0, counts[j]) for j in range(k) if counts[j]]
        out += [(j, c, at, digit) for j in range(k) for c in range(dims) for at, digit in _digits(sums[j][c])]
        columns = list(zip(*out)) or [()] * 4
        types = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["cluster", "component", "position", "digit"])

    # At most clusters * dims * (digits of a number) rows, however many the vectors.
    found = prepared.mapInArrow(run, "cluster int, component int, position int, digit long").groupBy("cluster", "component", "position").agg(F.sum("digit").alias("digit"))
    counts, sums = [0] * k, [[0] * dims for _ in range(k)]
    for r in found.collect():
        if r["component"] < 0:
            counts[r["cluster"]] = r["digit"]
        else:
            sums[r["cluster"]][r["component"]] += r["digit"] << (_DIGIT * r["position"])
    return counts, sums


def first_centroids(vectors: DataFrame, settings: Settings) -> list[tuple[int, ...]]:
    """The integers of the vectors with the least hash of seed and id, in its order; those without an id come last."""
    key = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(key.asc_nulls_last(), "values").limit(settings.clusters).collect()
    return [tuple(whole(v, settings.scale) for v in r["values"]) for r in rows]


@dataclass(frozen=True)
class Model:
    centroids: list[tuple[int, ...]]
    directions: np.ndarray


def fit(vectors: DataFrame, prepared: DataFrame, directions: np.ndarray, settings: Settings) -> Model:
    """Rounds of assignment and exact floored means; an empty cluster keeps its centroid."""
    rows = first_centroids(vectors, settings)
    for _ in range(settings.rounds if rows else 0):
        counts, sums = _sums(prepared, Centroids(rows, directions), settings)
        rows = [tuple(s // n for s in total) if n else old for n, total, old in zip(counts, sums, rows, strict=True)]
    return Model(rows, directions)


def assign(prepared: DataFrame, model: Model, settings: Settings) -> DataFrame:
    """vec_id, cluster and squared distance of every prepared vector; a distance beyond a long is the largest long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(model.centroids, model.directions)
        for batch in slices(batches, 4096):
            cluster, distance, _ = _assigned(batch, centroids, settings)
            far = pa.array([min(d, _LONGEST) for d in distance], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster.astype(np.int32)), far], ["vec_id", "cluster", "distance"])

    return prepared.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(embeddings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept row of ``embeddings``.

    Rows of another length, or with null or non-finite components, are left out. Repeated
    rows are vectors of their own, and may both be first centroids. With fewer vectors than
    clusters every vector starts one. Rows without a vec_id take part and are the last to
    start one. Sums beyond a long are the largest long.
    """
    vectors = spread(kept(embeddings, settings))
    directions = rotation(vectors, settings)
    prepared = cut_lineage(prepare(vectors, directions, settings), "rotated")
    model = fit(kept(embeddings, settings), prepared, directions, settings)
    rows = cut_lineage(assign(prepared, model, settings), "assigned")
    sums = {r["cluster"]: int(r["inertia"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    shas = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in model.centroids]
    # One constant a cluster: a bounded number, whatever the vectors.
    per = lambda values, kind: F.get(F.array(*[F.lit(v).cast(kind) for v in values]) if values else F.array().cast(f"array<{kind}>"), F.col("cluster"))
    inertia = [min(sums.get(j, 0), _LONGEST) for j in range(len(shas))]
    return rows.select(
        "vec_id", "cluster", "distance", per(inertia, "long").alias("cluster_inertia"),
        F.lit(min(sum(sums.values()), _LONGEST)).cast("long").alias("inertia"), per(shas, "string").alias("centroid_sha256"),
    )
