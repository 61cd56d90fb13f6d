"""Centroid clustering with the threshold algorithm, in whole numbers.

Vectors of ``dims`` finite components become integers, floor(``scale`` * x).
Each round gives every vector its nearest centroid (squared Euclidean
distance, ties to the smaller number) and moves each non-empty centroid to
the exact floor of its vectors' componentwise mean.

The nearest centroid is found from sorted lists: for each dimension the
centroids are sorted by that component, and a vector walks outward from its
own value in all lists at once, one entry of each list a step.  A centroid met for the first
time gets its exact distance.  The squares of the next gaps add up to a bound
below which no centroid still unmet can be; the walk stops as soon as it
strictly exceeds the best exact distance (an equal one may be a tie with a
smaller number).

A round is one scan of the staged integers: tasks add up their vectors per
centroid and only ``k * dims`` sums a task are shuffled, so a centroid that
attracts a third of all rows is no hot key.  The centroids (``k * dims``
numbers, fixed by the parameters) go through the driver; no vectors do.

Edge cases: vectors that are null, of another size, or with a null or
non-finite component are left out; a null id is kept, but is the last choice
for a start; repeated rows count each; fewer than ``k`` vectors give as many
centroids; an empty table gives an empty result.  All input columns are kept,
one whose name is that of an added column is replaced.  A component beyond
2**27 after scaling raises, since distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import extended, map_batches, stage, without

DIMS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SALT = "3"
WIDEST = 1 << 27
ADDED = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
_FAR = 1 << 62
_ROWS = 1 << 12


def nearest(vectors: np.ndarray, centroids: np.ndarray, walked: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each vector and its squared
    distance, by the threshold algorithm.  ``walked`` collects how many
    exact distances and steps each vector took."""
    k, dims = centroids.shape
    order = np.argsort(centroids, axis=0, kind="stable")
    lists, across = np.take_along_axis(centroids, order, axis=0), np.arange(dims)
    best, who = np.full(len(vectors), _FAR), np.full(len(vectors), k)
    met = np.zeros((len(vectors), k), bool)
    up = np.stack([np.searchsorted(lists[:, j], vectors[:, j]) for j in across], axis=1)
    down = up - 1
    live, steps = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
    while len(live):
        own, lo, hi = vectors[live], down[live], up[live]
        below = np.where(lo >= 0, own - lists[np.maximum(lo, 0), across], 2 * WIDEST + 1)
        above = np.where(hi < k, lists[np.minimum(hi, k - 1), across] - own, 2 * WIDEST + 1)
        gap = np.minimum(below, above)
        on = (gap * gap).sum(axis=1) <= best[live]
        live, lo, hi, lower = live[on], lo[on], hi[on], (below <= above)[on]
        steps[live] += 1
        new = np.zeros((len(live), k), bool)
        new[np.arange(len(live))[:, None], order[np.where(lower, lo, hi), across]] = True
        new &= ~met[live]
        row, number = np.nonzero(new)
        away = vectors[live[row]] - centroids[number]
        exact = np.full((len(live), k), _FAR)
        exact[row, number] = (away * away).sum(axis=1)
        first = exact.argmin(axis=1)
        least = exact[np.arange(len(live)), first]
        better = (least < best[live]) | ((least == best[live]) & (first < who[live]))
        best[live[better]], who[live[better]] = least[better], first[better]
        met[live] |= new
        down[live] = lo - lower
        up[live] = hi + ~lower
        live = live[~met[live].all(axis=1)]
    if walked is not None:
        walked.append((met.sum(axis=1), steps))
    return who, best


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def whole_vectors(vectors: DataFrame, vec_col: str, dims: int, scale: int, name: str) -> DataFrame:
    """The rows with ``dims`` finite components, and these as integers."""
    v = F.col(f"`{vec_col}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    kept = vectors.where((F.size(v) == dims) & finite)
    scaled = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    fits = F.forall(scaled, lambda x: (x <= WIDEST) & (x >= -WIDEST))
    return kept.withColumn(name, F.when(fits, F.transform(scaled, lambda x: x.cast("int"))).otherwise(F.raise_error(F.lit(f"a component is beyond {WIDEST} after scaling"))))


def _sums(vectors: DataFrame, centroids: np.ndarray) -> list:
    """Per centroid and dimension: the sum and the number of its vectors."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS):
                x = _matrix(batch.column(0).slice(i, _ROWS), dims).astype(np.int64)
                own, _ = nearest(x, centroids)
                count += np.bincount(own, minlength=k)
                np.add.at(total, own, x)
        number, dim = np.divmod(np.arange(k * dims), dims)
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (number, dim, total.ravel(), np.repeat(count, dims))], names=["number", "dim", "total", "n"])

    sums = map_batches(vectors, run, "number bigint, dim bigint, total bigint, n bigint")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("total", "n")]
    return sums.groupBy("number", "dim").agg(*exact).collect()


def _assigned(rows: DataFrame, name: str, centroids: np.ndarray) -> DataFrame:
    at, dims = rows.columns.index(name), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS):
                part = batch.slice(i, _ROWS)
                own, away = nearest(_matrix(part.column(at), dims).astype(np.int64), centroids)
                columns = [c for j, c in enumerate(part.columns) if j != at]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(own.astype(np.int32)), pa.array(away)], names=out.names)

    out = extended(rows.drop(name).schema, "cluster int, distance bigint")
    return map_batches(rows, run, out)


def _long(value: int) -> int:
    if value >= 1 << 63:
        raise OverflowError(f"an inertia of {value} does not fit a long")
    return value


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = DIMS, k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, salt: str = SALT) -> DataFrame:
    """The kept rows of ``vectors`` with their cluster, squared distance, the
    inertia of the cluster and of all, and a hash of the final centroid.

    The first centroids are the ``k`` vectors whose SHA-256 of
    ``<salt>:<id>`` is smallest, in that order (equal ids: by components).
    """
    base = without(vectors, *[c.strip().split(" ")[0] for c in ADDED.split(",")])
    taken = {c.lower() for c in base.columns}
    name = next(n for n in ("whole", *(f"whole_{i}" for i in range(len(taken) + 1))) if n not in taken)
    rows = stage(whole_vectors(base, vec_col, dims, scale, name), "whole-vectors")
    drawn = F.sha2(F.concat(F.lit(f"{salt}:"), F.col(f"`{id_col}`").cast("string")), 256)
    starts = rows.select(name).orderBy(drawn.asc_nulls_last(), F.col(name)).limit(k).collect()
    if not starts:
        return rows.drop(name).selectExpr("*", *[f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in ADDED.split(", ")])
    centroids = np.array([r[0] for r in starts], np.int64)
    for _ in range(rounds):
        for r in _sums(rows.select(name), centroids):
            if r["n"]:
                centroids[r["number"], r["dim"]] = int(r["total"]) // int(r["n"])
    done = stage(_assigned(rows, name, centroids), "clusters")
    inertia = {r["cluster"]: int(r["s"]) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of = F.array(*[F.lit(_long(inertia.get(i, 0))).cast("bigint") for i in range(len(centroids))])
    return done.select(
        "*",
        F.get(of, F.col("cluster")).alias("cluster_inertia"),
        F.lit(_long(sum(inertia.values()))).cast("bigint").alias("inertia"),
        F.get(F.array(*map(F.lit, digest)), F.col("cluster")).alias("centroid_sha256"),
    )
