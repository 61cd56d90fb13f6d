"""Periodic runs of words."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tidewater.llm import periodic
from tidewater.llm.queries import op13_periodic


def all_runs(words: list[bytes], least_words: int, least_periods: int) -> list[tuple[int, int, int]]:
    seen: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            start = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(least_words, least_periods * q):
                seen.setdefault((start, i + q), q)
            i += 1
    return sorted((a, b - a, q) for (a, b), q in seen.items())


@pytest.mark.parametrize("seed", range(150))
def test_runs_match_brute_force(seed):
    rng = random.Random(seed)
    letters, least_words, least_periods = rng.choice([1, 2, 3, 8]), rng.choice([1, 4, 24]), rng.choice([2, 3])
    texts = []
    for _ in range(rng.randint(1, 6)):
        words = [b"%d" % rng.randrange(letters) for _ in range(rng.randint(0, 40))]
        if words and rng.random() < 0.6:
            a, p = rng.randrange(len(words)), rng.randint(1, 7)
            words = words[:a] + words[a : a + p] * 9 + [b"x"] * rng.randint(0, 1)
        texts.append(words)
    found = periodic.find_runs(texts, least_words, least_periods)
    assert found == [all_runs(w, least_words, least_periods) for w in texts]


def test_many_portions_and_blocks_give_the_same(monkeypatch):
    rng = random.Random(2)
    texts = [[b"%d" % rng.randrange(3) for _ in range(300)] for _ in range(8)]
    want = [all_runs(w, 4, 2) for w in texts]
    monkeypatch.setattr(periodic, "_PORTION", 50)
    assert periodic.find_runs(texts, 4, 2) == want
    monkeypatch.setattr(periodic, "BLOCK", 400)
    blocks = list(periodic._blocks([b" ".join(w) for w in texts] + [None, b" \t\n"]))
    assert len(blocks) > 3 and [w for b in blocks for w in b] == [*texts, [], []]


def test_strongest_and_collapse():
    runs = [(0, 30, 10), (40, 24, 8), (70, 60, 20)]
    assert periodic.strongest(runs) == (0, 30, 10) and periodic.strongest([]) is None
    words = [b"%d" % (i % 5) for i in range(30)] + [b"end"]
    found = periodic.find_runs([words])[0]
    assert found == [(0, 30, 5)] and periodic.collapse(words, found) == b"0 1 2 3 4 end"


def test_every_column_and_odd_text(spark):
    texts = [None, "", " \n\t ", "a " * 40, "é b " * 30 + "c", "one two"] + ["a " * 40]
    rows = [(None if i == 2 else i, t, "old", {"k": i}) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, Runs string, raw map<string,int>")
    got = periodic.collapse_runs(docs)
    assert got.columns == ["doc_id", "text", "raw", "n_words", "runs", "strongest", "collapsed"]
    made = [(r["n_words"], len(r["runs"]), r["strongest"] and tuple(r["strongest"]), r["collapsed"]) for r in got.collect()]
    assert made == [(0, 0, None, ""), (0, 0, None, ""), (0, 0, None, ""), (40, 1, (0, 40, 1), "a"), (31, 1, (0, 30, 1), "é b c"), (2, 0, None, "one two"), (40, 1, (0, 40, 1), "a")]
    assert periodic.collapse_runs(docs.where("doc_id > 99")).collect() == []


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    want = {}
    for doc_id, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = all_runs(words, 24, 3) if n < 3000 else periodic.find_runs([words])[0]
        best = periodic.strongest(runs) or (None, None, None)
        lines = "".join("%d,%d,%d\n" % r for r in runs)
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        want[doc_id] = (len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(periodic.collapse(words, runs)).hexdigest())
    assert {r["doc_id"]: tuple(r)[1:] for r in op13_periodic(spark, sf).collect()} == want
    assert any(v[0] for v in want.values())
