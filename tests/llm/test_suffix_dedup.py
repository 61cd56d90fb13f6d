"""Two-stage suffix sorting and removal of repeated byte strings."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import suffix_dedup
from tidewater.llm.queries import op11_suffix_dedup


def window_counts(texts: list[bytes], length: int) -> Counter:
    return Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))


def left_of(text: bytes, counts: Counter, length: int) -> tuple[int, int, int, str]:
    gone = bytearray(len(text))
    for i in range(len(text) - length + 1):
        if counts[text[i : i + length]] > 1:
            gone[i : i + length] = b"\1" * length
    kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
    spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
    return len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()


def some_strings(seed: int, least: int) -> list[bytes]:
    rng = random.Random(seed)
    alphabet = rng.choice([b"a", b"ab", b"\x00a\xff", bytes(range(256))])
    out = [bytes(rng.choice(alphabet) for _ in range(rng.randint(least, 70))) for _ in range(rng.randint(1, 10))]
    return out + [out[0][2:] + b"z" * least, out[0]]


@pytest.mark.parametrize("seed", range(40))
def test_suffix_array_and_common_prefixes(seed):
    strings = some_strings(seed, 3)
    array = suffix_dedup.SuffixArray(strings)
    suffixes = sorted((s[i:], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1))
    assert array.order.tolist() == [int(array.begin[k]) + i for _, k, i in suffixes]
    for (a, _, _), (b, _, _), n in zip(suffixes, suffixes[1:], array.common()[1:], strict=False):
        assert n == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("seed", range(20))
def test_repeated_windows_and_their_keys(seed):
    strings = some_strings(seed, 8)
    counts = window_counts(strings, 8)
    found = suffix_dedup.repeated(strings, np.ones(len(strings)), 8)
    for text, spans in zip(strings, found, strict=True):
        starts = {i for low, high in spans for i in range(low, high)}
        assert starts == {i for i in range(len(text) - 7) if counts[text[i : i + 8]] > 1}
    for gram in (1, 3, 8):
        text, first, n, key, twice = suffix_dedup.segments(strings, 8, gram)
        held = Counter(key.tolist())
        assert sum(n) == sum(len(s) - 7 for s in strings)
        for t, a, size, k, inner in zip(text.tolist(), first.tolist(), n.tolist(), key.tolist(), twice.tolist(), strict=True):
            if held[k] == 1 and not inner:
                assert all(counts[strings[t][i : i + 8]] == 1 for i in range(a, a + size))


def test_counts_stand_for_copies():
    assert suffix_dedup.repeated([b"abcdefgh"], np.array([2]), 4) == [[(0, 5)]]
    assert suffix_dedup.repeated([b"abcdefgh"], np.array([1]), 4) == [[]]


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_removal_matches_brute_force(spark, monkeypatch):
    """Small blocks and parts, so that runs are cut and hot keys dealt again."""
    rng = random.Random(5)
    shared, hot = prose(rng, 30), prose(rng, 12)
    texts = [prose(rng, 40) + shared + prose(rng, 20), shared, None, "", "short", "ab" * 700, "x" * 900, prose(rng, 3000)]
    texts += [prose(rng, rng.randint(0, 30)) + hot + prose(rng, 25) for _ in range(60)]
    texts += [texts[-1]] * 5 + [texts[7][:4000] + "end"]
    rows = [(i if i % 9 else None, t, "s", {"k": "v"}, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string, extra map<string,string>, Spans string")
    for name, value in (("BLOCK", 2000), ("PART", 1500), ("RUN", 64)):
        monkeypatch.setattr(suffix_dedup, name, value)
    got = suffix_dedup.remove_repeats(docs, length=50).collect()
    assert set(got[0].asDict()) == {"doc_id", "text", "id", "extra", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"}
    raw = [(t or "").encode() for t in texts]
    counts = window_counts(raw, 50)
    want = Counter((t, *left_of((t or "").encode(), counts, 50)) for t in texts)
    assert Counter((r["text"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want
    for r in got:
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
        assert sum(s["high"] - s["low"] for s in r["spans"]) == r["n_removed"] == r["n_bytes"] - len(r["kept"])


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    raw = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    counts = window_counts(list(raw.values()), 400)
    got = {r["doc_id"]: tuple(r)[1:] for r in op11_suffix_dedup(spark, sf).collect()}
    assert got == {k: left_of(t, counts, 400) for k, t in raw.items()}
