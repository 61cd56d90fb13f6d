"""Benchmark decontamination: a broadcast set of benchmark n-grams, scanned
over the token windows of every document.

Words are runs of ASCII letters, digits and non-ASCII characters, with A-Z
lower-cased.  A window is ``n`` consecutive words of an item; an item of
fewer words (but not none) is one window.  Document words are mapped to the
benchmark's vocabulary, windows whose rolling hash is in the hash set are
verified word by word, and every word inside an occurrence is hit.

The windows are broadcast in blocks of at most ``block_bytes`` each (measured
before anything is sent); a benchmark of more than one block is scanned in as
many passes, each staged, so neither the driver nor a task ever holds more
than one block.

Edge cases: a null or wordless text has no words and no hits; a null or
wordless item has no windows; items may repeat (ids are counted once); an
item whose id is null still marks words but is not listed; an empty
benchmark or an empty table of documents gives no hits.  Other columns pass
through; ones named like an added column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import extended, map_batches, stage, without

NGRAM = 10
BLOCK_BYTES = 32 << 20
HITS = "n_words bigint, hit_spans array<struct<start:int,end:int>>, hit_items array<string>"

_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_RAW_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def words_of(text: bytes | None) -> list[bytes]:
    """Normalised words of UTF-8 ``text``."""
    return text.translate(_WORD_BYTES).split() if text else []


def benchmark_windows(benchmark: DataFrame, n: int = NGRAM, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct ``(gram, item)`` rows: space-joined windows and item ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, items = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                for i in range(max(1, len(words) - n + 1) if words else 0):
                    grams.append(b" ".join(words[i : i + n]))
                    items.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.binary()), pa.array(items, pa.string())], names=["gram", "item"])

    source = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text"))
    return map_batches(source, run, "gram binary, item string").distinct()


class GramSet:
    """Hash set of one block of windows, with the words to verify hits."""

    def __init__(self, rows: list[tuple[bytes, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[str] = []
        self.grams: dict[int, dict[bytes, list[int]]] = {}
        numbers: dict[str, int] = {}
        for gram, item in rows:
            words = bytes(gram).split(b" ")
            key = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.uint32).tobytes()
            found = self.grams.setdefault(len(words), {}).setdefault(key, [])
            if item is not None:
                if item not in numbers:
                    numbers[item] = len(self.items)
                    self.items.append(item)
                found.append(numbers[item])
        self.hashes = {}
        for length, grams in self.grams.items():
            ids = np.frombuffer(b"".join(grams), np.uint32).reshape(-1, length)
            self.hashes[length] = np.sort(_hash(ids))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Occurrences as merged word spans, and the items they come from."""
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in words], np.uint32)
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        spans, items = [], set()
        for length, grams in self.grams.items():
            if len(words) < length:
                continue
            starts = np.flatnonzero(known[length:] - known[:-length] == length)
            if not len(starts):
                continue
            windows = ids[starts[:, None] + np.arange(length)]
            hashes = _hash(windows)
            table = self.hashes[length]
            at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
            for i in np.flatnonzero(table[at] == hashes):
                found = grams.get(windows[i].tobytes())
                if found is not None:
                    spans.append((int(starts[i]), int(starts[i]) + length))
                    items.update(found)
        return merge_spans(spans), items


def _hash(ids: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of word numbers, modulo 2^64."""
    powers = np.array([pow(_BASE, k, 1 << 64) & _MASK for k in range(ids.shape[1])], np.uint64)
    return (ids.astype(np.uint64) * powers).sum(axis=1, dtype=np.uint64)


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, disjoint union of half-open spans."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``n_words``, ``hit_spans``
    (merged word spans, end excluded) and ``hit_items`` (ids of the items
    found, as strings)."""
    spark = docs.sparkSession
    grams = stage(benchmark_windows(benchmark, n, item_id_col, item_text_col), "benchmark-windows")
    total = grams.agg(F.sum(F.length("gram") + 64 + F.coalesce(F.length("item"), F.lit(0)))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    numbered = grams.withColumn("block", F.pmod(F.xxhash64("gram"), F.lit(blocks)))
    out = without(docs, "n_words", "hit_spans", "hit_items")
    names = out.columns
    for block in range(blocks):
        rows = [(bytes(r["gram"]), r["item"]) for r in numbered.where(F.col("block") == block).collect()]
        # At most one block: ``block_bytes`` was measured above.
        held = spark.sparkContext.broadcast(GramSet(rows))
        kept = names if block + 1 < blocks or keep is None else keep
        schema = extended(out.select(kept).schema, HITS)
        out = map_batches(out, _scanner(held, kept, text_col, first=block == 0), schema)
        if block + 1 < blocks:
            out = stage(out, "benchmark-pass")
    return out


def _scanner(held, names: list[str], text_col: str, first: bool):
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: GramSet = held.value
        for batch in batches:
            count, spans, items = [], [], []
            before = [] if first else zip(batch.column("hit_spans").to_pylist(), batch.column("hit_items").to_pylist(), strict=True)
            for text in batch.column(text_col).cast(pa.binary()):
                words = words_of(text.as_py())
                found, ids = grams.scan(words) if words else ([], set())
                listed = {grams.items[i] for i in ids}
                if not first:
                    old_spans, old_items = next(before)
                    found = merge_spans(found + [(s["start"], s["end"]) for s in old_spans])
                    listed |= set(old_items)
                count.append(len(words))
                spans.append([{"start": s, "end": e} for s, e in found])
                items.append(sorted(listed))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(count, pa.int64()), pa.array(spans, spans_type), pa.array(items, pa.list_(pa.string()))],
                names=[*names, "n_words", "hit_spans", "hit_items"],
            )

    return run


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the words of the spans and what stands between them."""
    at = [m.span() for m in _RAW_WORD.finditer(text)]
    out, last = [], 0
    for start, end in spans:
        out.append(text[last : at[start][0]])
        last = at[end - 1][1]
    out.append(text[last:])
    return b"".join(out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM, remove: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without contamination, with the columns of ``docs``.

    ``remove="documents"`` drops every document with a hit word;
    ``remove="spans"`` cuts the hit words out of the text and keeps the rest.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    hits = find_hits(docs, benchmark, n, text_col, **options)
    if remove == "documents":
        return hits.where(F.size("hit_spans") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(text_col).cast(pa.binary()).to_pylist(), batch.column("hit_spans").to_pylist(), strict=True):
                texts.append(cut_words(text, [(s["start"], s["end"]) for s in spans]).decode() if spans else None if text is None else text.decode())
            columns = [batch.column(c) for c in names]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(hits, run, docs.schema)
