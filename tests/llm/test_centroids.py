"""Centroid clustering with the threshold algorithm."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import centroids
from tidewater.llm.queries import op12_centroids


@pytest.mark.parametrize("seed", range(60))
def test_nearest_is_exact_and_ties_go_to_the_smaller_number(seed):
    rng = np.random.default_rng(seed)
    k, dims, width = rng.integers(1, 9), rng.integers(1, 9), rng.choice([1, 3, 5000])
    points, x = rng.integers(-width, width + 1, (k, dims)), rng.integers(-width, width + 1, (40, dims))
    own, away = centroids.nearest(x, points)
    distances = ((x[:, None] - points[None]) ** 2).sum(axis=2)
    assert (own == distances.argmin(axis=1)).all() and (away == distances.min(axis=1)).all()


def test_the_walk_stops_before_all_centroids_are_met():
    points = np.array([[0, 0], [1000, 1000], [2000, 2000], [3000, 3000]])
    walked: list = []
    own, away = centroids.nearest(np.array([[1, 1], [2999, 3001]]), points, walked)
    assert own.tolist() == [0, 3] and away.tolist() == [2, 2]
    assert walked[0][0].max() == 1 and walked[0][1].max() == 1


def lloyd(rows, dims: int, k: int, rounds: int):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    points = [list(v) for _, v in first]

    def own(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(points))

    for _ in range(rounds):
        of = [own(v)[1] for _, v in kept]
        for j in range(len(points)):
            mine = [v for (_, v), o in zip(kept, of, strict=True) if o == j]
            if mine:
                points[j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    found = [(i, *own(v)) for i, v in kept]
    total = Counter()
    for _, d, j in found:
        total[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in points]
    return Counter((i, j, d, total[j], sum(total.values()), digest[j]) for i, d, j in found)


def test_rounds_match_plain_loops(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4) + 3 * (i % 3)]) for i in range(200)]
    rows += [(5, rows[5][1]), (None, rows[9][1]), (300, None), (301, [1.0, None, 2.0, 3.0]), (302, [1.0, float("nan"), 0.0, 0.0]), (303, [float("inf"), 0.0, 0.0, 0.0]), (304, [1.0]), (305, [])]
    table = spark.createDataFrame([(i, v, 1, {"a": 1}) for i, v in rows], "vec_id long, embedding array<float>, cluster int, extra map<string,int>").repartition(3)
    got = centroids.cluster(table, dims=4, k=5, rounds=4)
    assert got.columns == ["vec_id", "embedding", "extra", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(tuple(r)[:1] + tuple(r)[3:] for r in got.collect()) == lloyd(rows, 4, 5, 4)


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    two = centroids.cluster(spark.createDataFrame([(1, [0.5, 0.5]), (2, [1.5, 0.25])], schema), dims=2, k=8).collect()
    assert sorted((r["vec_id"], r["distance"], r["inertia"]) for r in two) == [(1, 0, 0), (2, 0, 0)]
    none = centroids.cluster(spark.createDataFrame([(1, [0.5])], schema), dims=2)
    assert none.collect() == [] and none.columns[2:] == ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_too_wide_a_component_raises(spark):
    rows = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="after scaling"):
        centroids.cluster(rows, dims=2).collect()


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert Counter(map(tuple, op12_centroids(spark, sf).collect())) == lloyd(rows, 64, 8, 10)
