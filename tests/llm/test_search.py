"""Exact top-k search against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, query_id int"


def brute(rows, is_query, k=10, scale=1024):
    ok = []
    for n, (i, v, *_) in enumerate(rows):
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ok.append((n, i, [math.floor(scale * float(np.float32(x))) for x in v]))
    out = []
    for n, i, v in ok:
        if is_query(i):
            clip = lambda s: max(-(2**63) + 1, min(2**63 - 1, s))
            scored = sorted((-clip(sum(a * b for a, b in zip(v, w))), j) for m, j, w in ok if m != n and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def found(frame):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in frame.collect())


def vectors(n, size, seed=1):
    draw = random.Random(seed)
    return [(i, [draw.uniform(-0.5, 0.5) for _ in range(size)], 7) for i in range(n)]


def test_random_vectors_over_blocks_and_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_ROWS", 5)
    rows = vectors(700, 12)
    frame = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, lambda i: i % 50 == 0)
    assert found(topk.top_k(frame, F.col("vec_id") % 50 == 0, block=128)) == want
    assert found(topk.top_k(frame, F.col("vec_id") % 50 == 0, query_bytes=500)) == want


def test_ties_go_to_smaller_ids_and_common_vectors_are_whole(spark):
    rows = [(i, [0.25, -0.5, 0.125], 0) for i in range(400)] + [(1000, [0.5, 0.5, 0.5], 0)]
    got = found(topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 200 == 0, block=64))
    assert got == brute(rows, lambda i: i % 200 == 0)


def test_nulls_odd_lengths_repeats_and_large_numbers(spark):
    rows = [
        (0, [1.0, 2.0], 0), (0, [1.0, 2.0], 0), (1, None, 0), (2, [None, 1.0], 0), (3, [math.nan, 1.0], 0), (4, [math.inf, 1.0], 0), (None, [9.0, 9.0], 0),
        (100, [], 0), (5, [], 0), (6, [3.0], 0), (200, [1e9, 2.0], 0), (7, [1e12, -4.0], 0), (8, [0.5, 0.5], 0),
    ]
    got = found(topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0))
    assert got == brute(rows, lambda i: i % 100 == 0)


def test_empty_table(spark):
    assert found(topk.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0)) == []


@pytest.mark.parametrize("seed", range(4))
def test_bounds_discard_only_what_cannot_qualify(seed):
    draw = np.random.default_rng(seed)
    x = np.floor(draw.normal(0, 200, (600, 6)))
    best = topk.Best(5, 10)
    topk.search_block(best, np.arange(5), x[:5], np.arange(5), x, np.arange(600), np.arange(600))
    for q in range(5):
        scores = x @ x[q]
        order = [i for i in np.lexsort((np.arange(600), -scores)) if i != q][:10]
        assert best.ids[q].tolist() == order


def test_reading_goes_on_until_few_can_qualify():
    """Blocks smaller than k, ties, own rows, earlier blocks' scores."""
    draw = np.random.default_rng(0)
    for _ in range(120):
        n, dims, k = (int(draw.integers(1, high)) for high in (200, 7, 12))
        x = draw.integers(-draw.choice([1, 3, 1000]), 4, (n, dims)).astype(float)
        ids, rows, queries = draw.permutation(n), np.arange(n), np.arange(0, n, 3)
        best = topk.Best(len(queries), k)
        for a in range(0, n, 70):
            topk.search_block(best, np.arange(len(queries)), x[queries], rows[queries], x[a : a + 70], rows[a : a + 70], ids[a : a + 70])
        for j, i in enumerate(queries):
            scores = x @ x[i]
            assert best.ids[j].tolist() == [ids[c] for c in np.lexsort((ids, -scores)) if c != i][:k]
    steps = topk.depths(4096, 10)
    assert steps[:4] == [512, 2048, 3072, 3584] and steps[-1] == 4096 and steps == sorted(set(steps))
    assert topk.depths(5, 10) == [5]
