"""Tokenizing, cutting and packing: exact round trips and fill."""

from __future__ import annotations

import gc
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import packing as P
from tidewater.llm.common import drop_kept, kept, map_batches

ODD = [
    None, "", " \t\n", "Hello, world!! It's we'll 'tis don't 3rd 2024.", "ÀÉÎ õü ß ÿ Ÿ Œuvre ÷ × µ ª º",
    "é café İstanbul ΣΣ ẞ", "a\x0bb\x0cc\x1cd\x85e\xa0f g　h", "<|endoftext|> x<|startoftext|>y <|x|>", "日本語 مرحبا \U0001f600\U0001f600!!",
    "x" * 5000, "word " * 3000, "''s'S 'RE 'Ll ''ve", "ﬁ Å Ω ̀́", "#$%&***|||", "1234567890" * 50,
]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.default_vocabulary())
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def by_chunk():
    tokenizer = P.ChunkTokenizer(P.default_vocabulary(), cache=200)
    return lambda t: np.frombuffer(tokenizer.encode(None if t is None else t.encode()), "<u4").tolist()


def test_chunks_encode_as_whole_texts(whole, by_chunk):
    for text in [*ODD, " ".join(t or "" for t in ODD)]:
        assert by_chunk(text) == whole(text), text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=60))
def test_any_text_encodes_as_a_whole(whole, by_chunk, text):
    assert by_chunk(text) == whole(text)


def test_full_cache_is_emptied_within_a_text(by_chunk, whole):
    text = " ".join(f"word{i}x{i}" for i in range(900)) + " word1x1"
    assert by_chunk(text) == whole(text)


@pytest.mark.parametrize("portion", [P.TEXTS, 700, 1])
def test_many_texts_encode_as_each_does(monkeypatch, whole, portion):
    """In groups, and a text too long for one by portions."""
    monkeypatch.setattr(P, "TEXTS", portion)
    monkeypatch.setattr(P, "PORTION", 64)
    tokenizer = P.ChunkTokenizer(P.default_vocabulary(), cache=150)
    texts = [*ODD, *ODD[::-1], None, "", "y " * 400, "x" * 300 + " <|x|> " + "z" * 300]
    got = tokenizer.encode_all([None if t is None else t.encode() for t in texts])
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [whole(t) for t in texts]
    with pytest.raises(ValueError):
        list(tokenizer.encode_all([b"a \xff b", b"c"]))


def test_words_met_before_the_cache_was_full_are_not_encoded_again(monkeypatch):
    tokenizer = P.ChunkTokenizer(P.default_vocabulary(), cache=200)
    first, second = (" ".join(f"{a}{b}c" for b in "abcdefghijklmnopqrstuvwxyz" for a in part).encode() for part in ("abcd", "efghij"))
    met = []
    encode = tokenizer._encode_words
    monkeypatch.setattr(tokenizer, "_encode_words", lambda words: (met.extend(words), encode(words)))
    ids = [tokenizer.encode(t) for t in (first, second, first)]
    assert ids[0] == ids[2] and len(met) == len(set(met)) == 260


def check(rows, docs, encode, sequence):
    """Pieces cover the documents, places are gapless, no sequence overflows."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    texts = defaultdict(list)
    for d, t in docs:
        texts[d].append([*encode(t), 0])
    for d, all_ids in texts.items():
        want = sorted((k, s, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for ids in all_ids for k, s in enumerate(range(0, len(ids), sequence)) for p in [ids[s : s + sequence]])
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc.pop(d)) == want
    assert not by_doc
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= sequence
    return len(by_sequence), sum(r["length"] for r in rows)


def test_documents_round_trip_and_fill(spark, whole):
    draw = random.Random(1)
    words = [f"token{i}" for i in range(50)]
    docs = [(i, " ".join(draw.choices(words, k=draw.randint(0, 120)))) for i in range(400)] + list(enumerate(ODD, 1000)) + [(7, "same id"), (7, "same id"), (None, "no id"), (None, None)]
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, bin string")
    rows = P.pack_documents(frame, sequence=256, nearly_full=4).collect()
    sequences, tokens = check(rows, docs, whole, 256)
    assert sequences <= 1.01 * -(-tokens // 256) + 1


def test_levels_and_small_tasks(spark):
    draw = random.Random(8)
    items = spark.createDataFrame([(i, draw.randint(1, 2048)) for i in range(4000)], "doc_id bigint, length bigint")
    rows = P.pack(items, task_items=800, nearly_full=8).collect()
    fill = defaultdict(int)
    for r in rows:
        fill[r["sequence_id"]] += r["length"]
    assert len(rows) == 4000 and max(fill.values()) <= 2048
    assert len(fill) <= 1.03 * sum(fill.values()) / 2048 + 1


def test_items_that_cannot_be_joined_end_the_levels(spark):
    items = spark.range(3000).selectExpr("id AS doc_id", "1500L AS length")
    rows = P.pack(items, task_items=200).collect()
    assert len({r["sequence_id"] for r in rows}) == 3000 and {r["offset"] for r in rows} == {0}


def test_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@given(st.lists(st.integers(1, 64), max_size=200))
def test_best_fit_never_overfills(sizes):
    sizes = sorted(sizes, reverse=True)
    fill = defaultdict(int)
    for size, bin_ in zip(sizes, P.best_fit(sizes, 64), strict=True):
        # The bin taken is the fullest that had room.
        assert all(f + size > 64 or f <= fill[bin_] for b, f in fill.items()) or not fill[bin_]
        fill[bin_] += size
    assert all(f <= 64 for f in fill.values())


def test_what_one_step_keeps_is_dropped_by_the_next():
    made = []
    for _ in range(2):
        assert kept("one", lambda: made.append(1) or [1]) == [1]
        drop_kept(("one", "two"))
    assert made == [1]
    drop_kept()
    assert kept("one", lambda: [2]) == [2]
    drop_kept()


def test_tokenizers_do_not_outlive_their_step(spark):
    """Workers go on with other steps, which need the memory."""
    assert P.pieces(spark.range(40).selectExpr("id AS doc_id", "'some words' AS text")).count() == 40

    def held(batches):
        for _ in batches:
            gc.collect()
            yield pa.RecordBatch.from_arrays([pa.array([sum(type(x).__name__ == "ChunkTokenizer" for x in gc.get_objects())])], names=["n"])

    assert {r["n"] for r in map_batches(spark.range(0, 16, 1, 16), held, "n bigint").collect()} == {0}
