"""Exact top-k inner product search by no-random-access aggregation.

Every task reads its vectors in blocks.  In a block each component is a list
sorted by value; for a query the lists are read in step, from the top where
the query's component is positive and from the bottom where it is negative.
After a depth, a candidate's score lies between a lower bound (unread
components at the far end of their list) and an upper bound (unread
components at the list's frontier).  Candidates whose upper bound is under
the k-th best lower bound (or the k-th score of earlier blocks) cannot
qualify; reading stops for a query once few are left, and their final scores
are resolved.  Else reading goes on, each time through half of what is unread
(or of the first depths), to the lists' ends if need be, where both bounds
are the score.  Up to ``QUERY_ROWS`` queries are bounded together, as matrix
products over the clipped lists.

Queries are broadcast in blocks of at most ``query_bytes`` each, however
many there are, each against all vectors.  Tasks return at most k rows a
query; the last choice is a rank per query with a partial limit.

Components are scaled to whole numbers (``floor(scale * x)``), so scores are
exact; ties go to the smaller id.

Edge cases: a vector that is null or holds a null or non-finite component,
and a row without an id, take no part; vectors meet only those of their own
length (an empty one meets empty ones, with score zero); a repeated id makes
a query of each of its rows, and only a query's own row is no candidate;
whole numbers too large for exact floating point are scored with exact
integers and clipped to a long; an empty table gives an empty result.  Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches, stage

K = 10
SCALE = 1024
BLOCK = 4096
QUERY_BYTES = 16 << 20
QUERY_ROWS = 512
FEW = 64
#: Least share of the lists that is read at last in a step of its own.
LAST = 1 / 64
_EXACT = 2.0**52


def usable(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """Staged ``(row_no, vec_id, v)`` with whole-number components."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.lit(float(scale)) * x.cast("double"))
    rows = vectors.where(F.col(id_col).isNotNull() & v.isNotNull()).where(~F.coalesce(bad, F.lit(True)))
    return stage(rows.select(F.monotonically_increasing_id().alias("row_no"), F.col(id_col).cast("bigint").alias("vec_id"), whole.alias("v")), "vectors")


class Best:
    """The k best candidates of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = [np.empty(0, np.int64) for _ in range(queries)]
        self.ids = [np.empty(0, np.int64) for _ in range(queries)]

    def floor(self) -> np.ndarray:
        """Score that a newcomer must reach, by query."""
        return np.array([s[-1] if len(s) == self.k else -np.inf for s in self.scores], float)

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate((self.scores[query], scores)), np.concatenate((self.ids[query], ids))
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[query], self.ids[query] = scores[order], ids[order]


def search_block(best: Best, at: np.ndarray, q: np.ndarray, q_rows: np.ndarray, x: np.ndarray, x_rows: np.ndarray, x_ids: np.ndarray) -> None:
    """Add the block ``x`` to ``best`` for the queries ``q`` (numbers ``at``)."""
    n, k = len(x), best.k
    ranked = np.sort(x, axis=0)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    own = {int(r): i for i, r in enumerate(x_rows)}
    mine = [own.get(int(r), -1) for r in q_rows]
    floor = best.floor()[at]
    live = np.arange(len(q))
    for depth in depths(n, k):
        top, bottom = ranked[n - depth], ranked[depth - 1]
        upper = up[live] @ np.maximum(x, top).T + down[live] @ np.minimum(x, bottom).T
        lower = up[live] @ np.where(x >= top, x, ranked[0]).T + down[live] @ np.where(x <= bottom, x, ranked[-1]).T
        for i, query in enumerate(live):
            if mine[query] >= 0:
                upper[i, mine[query]] = lower[i, mine[query]] = -np.inf
        bar = floor[live]
        if n >= k:
            bar = np.maximum(bar, np.partition(lower, n - k, axis=1)[:, n - k])
        in_play = (upper >= bar[:, None]) & (upper > -np.inf)
        done = (in_play.sum(axis=1) <= FEW) | (depth == n)
        for i in np.flatnonzero(done):
            rest = np.flatnonzero(in_play[i])
            if len(rest):
                best.add(at[live[i]], (x[rest] @ q[live[i]]).astype(np.int64), x_ids[rest])
        live = live[~done]
        if not len(live):
            return


def depths(n: int, k: int) -> list[int]:
    """How far the lists of a block of ``n`` are read, step by step."""
    out, unread = [n // 8], n // 2
    while unread > max(2 * k, LAST * n):
        out.append(n - unread)
        unread //= 2
    return [d for d in out if d >= 2 * k] + [n]


def _exact_block(best: Best, at: np.ndarray, q: np.ndarray, q_rows: np.ndarray, x: np.ndarray, x_rows: np.ndarray, x_ids: np.ndarray) -> None:
    """The same for numbers that floating point cannot hold exactly."""
    whole = np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)
    for i, row in enumerate(q):
        scores = whole @ np.array([int(v) for v in row], object) if x.shape[1] else np.zeros(len(x), object)
        scores = np.array([max(-(2**63) + 1, min(2**63 - 1, int(s))) for s in scores], np.int64)
        other = x_rows != q_rows[i]
        best.add(at[i], scores[other], x_ids[other])


def _searcher(held, k: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_rows, q_ids, by_size = held.value
        best = Best(len(q_rows), k)
        for batch in batches:
            rows, ids, sizes, flat = _arrays(batch)
            ends = np.cumsum(sizes)
            for size in np.unique(sizes):
                if int(size) not in by_size:
                    continue
                at, q = by_size[int(size)]
                some = np.flatnonzero(sizes == size)
                for i in range(0, len(some), block):
                    pick = some[i : i + block]
                    x = flat[(ends[pick] - size)[:, None] + np.arange(size)].reshape(len(pick), size)
                    most = max(1, size) * np.abs(x).max(initial=0) * np.abs(q).max(initial=0)
                    search = search_block if size and most < _EXACT else _exact_block
                    for j in range(0, len(at), QUERY_ROWS):
                        part = at[j : j + QUERY_ROWS]
                        search(best, part, q[j : j + QUERY_ROWS], q_rows[part], x, rows[pick], ids[pick])
        count = [len(s) for s in best.scores]
        if sum(count):
            query = np.repeat(np.arange(len(count)), count)
            columns = [q_rows[query], q_ids[query], np.concatenate(best.ids), np.concatenate(best.scores)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_row", "query_id", "vec_id", "score"])

    return run


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids, lengths and all whole components of a batch."""
    lists = batch.column("v")
    rows, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row_no", "vec_id"))
    return rows, ids, lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), np.floor(lists.flatten().to_numpy(zero_copy_only=False))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE, block: int = BLOCK, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best other rows of every
    row that ``is_query`` (a condition on ``vec_id``) holds for."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col, scale)
    queries = rows.where(is_query)
    total = queries.agg(F.sum(F.size("v") * 8 + 64)).first()[0] or 0
    blocks = max(1, -(-int(total) // query_bytes))
    numbered = queries.withColumn("block", F.pmod(F.xxhash64("row_no"), F.lit(blocks)))
    found = None
    for number in range(blocks):
        # One block of queries: its bytes were measured above.
        got = numbered.where(F.col("block") == number).select("row_no", "vec_id", "v").collect()
        by_size: dict[int, list[int]] = {}
        for i, r in enumerate(got):
            by_size.setdefault(len(r["v"]), []).append(i)
        matrices = {s: (np.array(at), np.floor(np.array([got[i]["v"] for i in at], float).reshape(len(at), s))) for s, at in by_size.items()}
        held = spark.sparkContext.broadcast((np.array([r["row_no"] for r in got], np.int64), np.array([r["vec_id"] for r in got], np.int64), matrices))
        part = map_batches(rows, _searcher(held, k, block), "query_row bigint, query_id bigint, vec_id bigint, score bigint")
        part = stage(part, "top-k-block") if blocks > 1 else part
        found = part if found is None else found.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
