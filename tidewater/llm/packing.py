"""Best-fit packing of tokenized documents into sequences, by hierarchical
residual packing.

A document is its token ids and one closing id.  Documents longer than a
sequence are cut into full pieces and a rest.  Every partition packs its
pieces best-fit, largest first, and emits the sequences that are full or
nearly full.  Those left are items for the next level: they are dealt to
fewer partitions, packed best-fit again, and so on, until a level joins
hardly any.  A level's partitions hold about ``task_items`` items each, so
no task grows with the input; if large items can no longer be joined at all,
the levels end early and the items become sequences as they are.

Only ids, positions, lengths and checksums are shuffled, never texts or
tokens, and every level is staged in the shared folder.

Tokenizing: text is cut at ASCII white space, which the vocabulary's own
rules drop, and each distinct chunk is encoded once per worker and kept in a
bounded cache, which goes when the worker gets a task of another step; the
new chunks of some megabytes of text are encoded in one call.  Chunks of
plain Latin-1 letters, digits and punctuation are split by the vocabulary's
pattern before they are encoded; anything else (other scripts, combining
marks, special tokens) goes through the whole tokenizer.

Edge cases: a null text is an empty one; an empty document is its closing id
alone; repeated rows are packed each; a null id is kept; an empty table
gives an empty result; very long texts are cut into as many pieces as they
need.  Other input columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain, compress
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import kept, map_batches, stage

SEQUENCE = 2048
END_ID = 0
NEARLY_FULL = 32
TASK_ITEMS = 100_000
FAN_IN = 8
LEAST_GAIN = 0.002
CACHE = 400_000
LONG = 256
PORTION = 1 << 16
TEXTS = 1 << 21

# All but plain Latin-1 letters, digits and punctuation, and special tokens.
_ODD = re.compile(r"[^!-~\xc0-\xd6\xd8-\xf6\xf8-\xff\n]|<\|")
# The vocabulary's own split pattern, for the plain characters above (fixed);
# a line is a chunk, its end a word of its own.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z\xdf-\xf6\xf8-\xff0-9\n]+|\n")
# Stands for the end of a line or a text among ids; no id has these bytes.
_LINE = b"\xff\xff\xff\xff"
# Stands for the end of a text among chunks; no text has this byte.
_TEXT = b"\xff"

PIECES = "doc_id {id}, piece int, start bigint, length bigint, ids_crc32 bigint"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class ChunkTokenizer:
    """Token ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, vocabulary: str, cache: int = CACHE):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(vocabulary)
        self.bare = Tokenizer(self.whole.model)  # the same model, not a copy
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.whole.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for token, number in vocab.items():
            self.ends[number] = token.endswith("</w>")
        # What was met since a cache was last full, and before that.
        self.chunks: dict[bytes, bytes] = {_TEXT: _LINE}
        self.old_chunks: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {"\n": _LINE}
        self.old_words: dict[str, bytes] = {}
        self.cache = cache

    def _encode_words(self, words: list[str]) -> None:
        """Encode split words in one go; each ends at an end-of-word token."""
        ids = np.array(self.bare.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            raise ValueError("the vocabulary does not mark the ends of words")
        raw, stops = ids.tobytes(), (4 * stops).tolist()
        self.words.update(zip(words, map(raw.__getitem__, map(slice, [0, *stops], stops)), strict=False))

    def _learn(self, chunks: str) -> list[bytes]:
        """Encode plain chunks, one a line, all of them in one go."""
        words = _SPLIT.findall(chunks.lower())
        new = set(words).difference(self.words)
        if len(self.words) + len(new) > self.cache:
            self.old_words, self.words = self.words, {"\n": _LINE}
            new = set(words).difference(self.words)
        held = list(filter(self.old_words.__contains__, new))
        self.words.update(zip(held, map(self.old_words.__getitem__, held), strict=True))
        if len(held) < len(new):
            self._encode_words(list(new.difference(held)))
        return b"".join(map(self.words.__getitem__, words)).split(_LINE)

    def _find(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        """Ids of chunks that are not in ``self.chunks``, which takes all up
        to ``LONG`` bytes, so it stays small."""
        held = list(filter(self.old_chunks.__contains__, chunks))
        found = dict(zip(held, map(self.old_chunks.__getitem__, held), strict=True))
        rest = list(chunks.difference(held)) if len(held) < len(chunks) else []
        text, longest = b"\n".join(rest).decode(), len(max(rest, key=len, default=b""))
        if longest > LONG or _ODD.search(text):
            odd = {c for c in rest if len(c) > LONG or _ODD.search(c.decode())}
            found.update((c, np.array(self.whole.encode(c.decode(), add_special_tokens=False).ids, "<u4").tobytes()) for c in odd)
            rest = [c for c in rest if c not in odd]
            text = b"\n".join(rest).decode()
        if rest:
            found.update(zip(rest, self._learn(text), strict=True))
        if len(self.chunks) + len(found) > self.cache:
            self.old_chunks, self.chunks = self.chunks, {_TEXT: _LINE}
        if len(found) <= self.cache:
            self.chunks.update(found if longest <= LONG else {c: ids for c, ids in found.items() if len(c) <= LONG})
        return found

    def _ids(self, chunks: list[bytes]) -> list[bytes]:
        got = list(map(self.chunks.get, chunks))
        missing = list(compress(range(len(got)), map(not_, got)))
        if missing:
            found = self._find({chunks[i] for i in missing})
            for i in missing:
                got[i] = found[chunks[i]]
        return got

    def encode(self, text: bytes | None) -> bytes:
        chunks = text.split() if text else []
        ids = b"".join([b"".join(self._ids(chunks[i : i + PORTION])) for i in range(0, len(chunks), PORTION)])
        if _LINE in ids:
            raise ValueError("a text is not UTF-8")
        return ids

    def encode_all(self, texts: list[bytes | None]) -> Iterator[bytes]:
        """The ids of each text; what is new in texts of ``TEXTS`` bytes
        together is learnt in one go, a longer text in portions."""
        at = 0
        while at < len(texts):
            size, first = 0, at
            while at < len(texts) and (at == first or size < TEXTS):
                size += len(texts[at] or b"")
                at += 1
            if size > 2 * TEXTS:
                yield from map(self.encode, texts[first:at])
                continue
            chunks = b" \xff ".join([t or b"" for t in texts[first:at]]).split()
            ids = b"".join(self._ids(chunks)).split(_LINE)
            if len(ids) != at - first:
                raise ValueError("a text is not UTF-8")
            yield from ids


def _tokenizer(name: str, vocabulary: str) -> ChunkTokenizer:
    return kept(name, lambda: ChunkTokenizer(vocabulary))


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document."""
    vocabulary = vocabulary or default_vocabulary()
    end, name = int(end_id).to_bytes(4, "little"), f"tokenizer {vocabulary}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(name, vocabulary)
        for batch in batches:
            row, number, start, length, crc = [], [], [], [], []
            for at, ids in enumerate(tokenizer.encode_all(batch.column(1).to_pylist())):
                ids = memoryview(ids + end)
                total = len(ids) // 4
                for k, first in enumerate(range(0, total, sequence)):
                    size = min(sequence, total - first)
                    row.append(at)
                    number.append(k)
                    start.append(first)
                    length.append(size)
                    crc.append(zlib.crc32(ids[4 * first : 4 * (first + size)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return map_batches(source, run, PIECES.format(id=source.schema["doc_id"].dataType.simpleString()), keeps=(name,))


def best_fit(sizes: list[int], sequence: int) -> list[int]:
    """Bin number of each size, given largest first: each goes to the fullest
    bin that has room for it, the latest of those."""
    room: list[list[int]] = [[] for _ in range(sequence + 1)]
    open_, bins, out = 0, 0, []
    for size in sizes:
        fits = open_ >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            number = room[left].pop()
            if not room[left]:
                open_ ^= 1 << left
        else:
            number, left = bins, sequence
            bins += 1
        left -= size
        if left:
            if not room[left]:
                open_ |= 1 << left
            room[left].append(number)
        out.append(number)
    return out


def _level(sequence: int, level: int, nearly_full: int):
    """Pack the items of one partition; rows of an item share ``bin``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        length, bins, offset = (table.column(c).to_numpy() for c in ("length", "bin", "offset"))
        if level == 0:
            number = np.arange(len(length))
            fill = length
        else:
            _, number = np.unique(bins, return_inverse=True)
            fill = np.bincount(number, weights=length).astype(np.int64)
        order = np.argsort(-fill, kind="stable")
        packed = np.empty(len(fill), np.int64)
        packed[order] = best_fit(fill[order].tolist(), sequence)
        # Items stand in a bin in the order they were put there.
        by_bin = order[np.argsort(packed[order], kind="stable")]
        before = np.cumsum(fill[by_bin]) - fill[by_bin]
        first = np.concatenate(([True], packed[by_bin][1:] != packed[by_bin][:-1]))
        shift = np.empty(len(fill), np.int64)
        shift[by_bin] = before - np.maximum.accumulate(np.where(first, before, 0))
        total = np.bincount(packed, weights=fill).astype(np.int64)
        own = (level << 56) | (TaskContext.get().partitionId() << 32)
        made = {"bin": own + packed[number], "offset": offset + shift[number], "done": total[packed[number]] >= sequence - nearly_full}
        for name, values in made.items():
            table = table.set_column(table.column_names.index(name), name, pa.array(values))
        yield from table.to_batches(max_chunksize=1 << 16)

    return run


def pack(items: DataFrame, sequence: int = SEQUENCE, nearly_full: int = NEARLY_FULL, task_items: int = TASK_ITEMS, fan_in: int = FAN_IN, least_gain: float = LEAST_GAIN) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of at
    most ``sequence``."""
    rows = items.withColumns({"bin": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint"), "done": F.lit(False)})
    schema, level, emitted = rows.schema, 0, []
    whole = rows.where(F.col("length") >= sequence)
    emitted.append(whole.withColumn("bin", -F.monotonically_increasing_id() - 1))
    left = rows.where(F.col("length") < sequence)
    count = left.count()
    parts = max(1, -(-count // task_items))
    while count:
        # Rows are dealt evenly; later the rows of a bin go together.
        dealt = left.repartition(parts, F.xxhash64("bin", F.lit(level))) if level else left.repartition(parts)
        packed = stage(map_batches(dealt, _level(sequence, level, nearly_full), schema), f"packing-level-{level}")
        emitted.append(packed.where("done"))
        left = packed.where("not done")
        bins = left.select("bin").distinct().count()
        if parts == 1 or (level and bins > (1 - least_gain) * before):
            emitted.append(left)
            break
        before, level, count = bins, level + 1, bins
        parts = max(-(-parts // fan_in), -(-count // task_items))
    out = emitted[0]
    for more in emitted[1:]:
        out = out.unionByName(more)
    return out.withColumnRenamed("bin", "sequence_id").drop("done")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, vocabulary: str | None = None, end_id: int = END_ID, **options) -> DataFrame:
    """Tokenize, cut and pack: one row per piece with its place."""
    return pack(stage(pieces(docs, id_col, text_col, sequence, vocabulary, end_id), "pieces"), sequence, **options)
