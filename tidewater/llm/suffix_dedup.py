"""Removal of long repeated byte strings with two-stage suffix sorting.

A *window* is a run of ``length`` bytes of one text.  Every byte under a
window whose bytes also start anywhere else (another text or the same one)
is removed; windows are judged on the input.

1. **Dealing.**  A window's key is the least hash of its ``gram``-byte
   strings, so equal windows have equal keys.  A *segment* is a maximal
   stretch of neighbouring windows with one key (at most ``RUN`` windows, the
   rest follows in the next one).  Only segments with a key that another
   segment has too, or that two of its own grams have, go on.  Equal segments are one row with a count.
2. **Sorting.**  The segments of a key meet in one task, in blocks of about
   ``BLOCK`` bytes: a suffix array is built in two stages (suffixes smaller
   than their successors are sorted directly, the rest is induced by scanning
   the buckets), adjacent common prefixes are computed, and neighbours that
   share ``length`` bytes are one class.  A window is repeated if its class
   counts two or more.  The others are *single*: they lie in segments that
   are there once, whose place travels with them, so no result is joined
   back to the many places of a segment that very many texts share.
3. **Hot keys.**  A key with more than ``BLOCK`` bytes of different segments
   is dealt again by longer grams, up to whole windows, where a key holds one
   string only.  So no task holds more than two blocks, whatever the data.
4. **Cutting.**  The windows of each text's segments without the single
   ones are merged into spans.

Equal texts are one text with a count (partial aggregation before the
shuffle), so copies cost nothing beyond the first.  Results go by a 128-bit
hash of the text, never by an id.

Edge cases: null text is empty; a text shorter than ``length`` keeps all its
bytes; repeated rows are occurrences of each other; null and repeated ids are
not looked at; an empty table gives an empty result.  Very long texts are
hashed in blocks of ``PART`` bytes.  All input columns are kept; one whose
name is that of an added column is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches, stage, without

LENGTH = 400
RUN = 1 << 12
BLOCK = 1 << 19
PART = 1 << 17
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)


def grams(length: int) -> list[int]:
    """Gram sizes of the dealing rounds; the last is the whole window."""
    return sorted({max(1, length * share // 100) for share in (24, 50, 75, 90, 100)})


# --- dealing --------------------------------------------------------------


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = (np.full(n, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def window_keys(data: np.ndarray, length: int, gram: int, powers: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every gram of ``data`` (bytes), and the key of every window:
    the least hash of its grams."""
    up, down = powers
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    least = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
    least ^= least >> np.uint64(32)
    least *= _MIX
    least ^= least >> np.uint64(29)
    least *= _MIX
    least ^= least >> np.uint64(32)
    hashes, wide, span = least, length - gram + 1, 1
    while 2 * span <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    return hashes, np.minimum(least[: len(least) - (wide - span)], least[wide - span :]) if wide > span else least


def _twice(hashes: np.ndarray, key: np.ndarray, first: np.ndarray, last: np.ndarray, wide: int) -> np.ndarray:
    """Whether the key of each run of windows is the hash of two grams under
    it: the leftmost in its first window is not the rightmost in its last."""
    grams_of = np.lib.stride_tricks.sliding_window_view(hashes, wide)
    out = np.empty(len(first), bool)
    for i in range(0, len(first), 1 << 8):
        f, z, k = first[i : i + (1 << 8)], last[i : i + (1 << 8)], key[first[i : i + (1 << 8)], None]
        out[i : i + (1 << 8)] = f + (grams_of[f] == k).argmax(axis=1) != z + wide - 1 - (grams_of[z] == k)[:, ::-1].argmax(axis=1)
    return out


def segments(texts: list[bytes], length: int, gram: int, inner: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All segments of ``texts``: number of the text, first window, number of
    windows, key and, if ``inner``, whether a window may repeat within the
    segment."""
    found = []
    powers = _powers(PART + length)
    long = [i for i, t in enumerate(texts) if len(t) >= length]
    at = 0
    while at < len(long):
        # Texts are strung together up to PART bytes; a longer one comes in parts.
        group, size = [], 0
        while at < len(long) and (not group or size + len(texts[long[at]]) <= PART):
            group.append(long[at])
            size += len(texts[long[at]])
            at += 1
        data = np.frombuffer(texts[group[0]] if len(group) == 1 else b"".join([texts[i] for i in group]), np.uint8)
        ends = np.cumsum([len(texts[i]) for i in group])
        for low in range(0, size - length + 1, PART):
            part = data[low : low + PART + length - 1]
            hashes, key = window_keys(part, length, gram, powers)
            start = np.arange(low, low + len(key))
            text = np.searchsorted(ends, start, side="right")
            whole = start + length <= ends[text]
            fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]))
            first = np.flatnonzero(fresh & whole)
            if not len(first):
                continue
            run = np.cumsum(fresh & whole) - 1
            count = np.bincount(run[whole], minlength=len(first))
            twice = _twice(hashes, key, first, first + count - 1, length - gram + 1) if inner else np.zeros(len(first), bool)
            pieces = -(-count // RUN)
            row = np.repeat(np.arange(len(first)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first_at = start[first][row] + nth * RUN
            t = text[first][row]
            begins = np.concatenate(([0], ends[:-1]))
            found.append((np.array(group)[t], first_at - begins[t], np.minimum(count[row] - nth * RUN, RUN), key[first][row], twice[row]))
    if not found:
        return tuple(np.empty(0, d) for d in (np.int64, np.int64, np.int64, np.uint64, bool))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# --- two-stage suffix sorting ----------------------------------------------


class SuffixArray:
    """Suffix array and adjacent common prefixes of many strings at once.

    Symbols are bytes plus one; every string ends with its own end mark,
    smaller than all bytes and ordered as the strings are.
    """

    def __init__(self, strings: list[bytes]):
        raw = b"".join(strings)
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.raw, self.n = raw, len(raw) + len(strings)
        self.begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])).astype(np.int64)
        self.end = self.begin + sizes
        self.owner = np.repeat(np.arange(len(strings)), sizes + 1)
        self.symbols = np.zeros(self.n + 8, np.int64)
        inside = np.ones(self.n, bool)
        inside[self.end] = False
        self.symbols[np.flatnonzero(inside)] = np.frombuffer(raw, np.uint8).astype(np.int64) + 1
        self.words = self._words()
        self.smaller = self._types()
        self.order = self._induced(self._sorted())

    def _words(self) -> np.ndarray:
        """Seven symbols from every place on as one number; after an end
        mark only zeros."""
        t, n = self.symbols, self.n
        word, live = t[:n].copy(), t[:n] > 0
        for j in range(1, 7):
            word <<= 9
            word |= np.where(live, t[j : n + j], 0)
            live &= t[j : n + j] > 0
        return word

    def _types(self) -> np.ndarray:
        """Whether each suffix is smaller than its successor."""
        t = self.symbols[: self.n]
        last = np.concatenate((t[1:] != t[:-1], [True]))
        up = np.concatenate((t[:-1] < t[1:], [True]))
        run = np.cumsum(last) - last
        return up[np.flatnonzero(last)][run]

    def _sorted(self) -> np.ndarray:
        """Suffixes smaller than their successors (end marks left out),
        sorted directly: by seven symbols, ties by the bytes that follow."""
        at = np.flatnonzero(self.smaller & (self.symbols[: self.n] > 0))
        at = at[np.argsort(self.words[at], kind="stable")]
        word = self.words[at]
        edge = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1], [True])))
        size = np.diff(edge)
        # Byte positions in the raw strings, which have no end marks.
        owner = self.owner[at]
        low, high = (at - owner + 7).tolist(), (self.end[owner] - owner).tolist()
        raw, places = self.raw, at.tolist()
        for a, b in zip(edge[:-1][size > 1].tolist(), edge[1:][size > 1].tolist(), strict=True):
            rest = [raw[x:y] for x, y in zip(low[a:b], high[a:b], strict=True)]
            if b - a == 2:
                if rest[1] < rest[0]:
                    places[a], places[a + 1] = places[a + 1], places[a]
            else:
                places[a:b] = [places[a + i] for i in sorted(range(b - a), key=rest.__getitem__)]
        return np.array(places, np.int64)

    def _induced(self, direct: np.ndarray) -> np.ndarray:
        """The whole order: buckets are scanned upwards, and the predecessor
        of a suffix is put at the head of its bucket if it is the larger."""
        t, n = self.symbols, self.n
        count = np.bincount(t[:n], minlength=258)
        begin = np.cumsum(count) - count
        order = np.empty(n, np.int64)
        order[: count[0]] = self.end
        bucket = t[direct]
        tails = np.bincount(bucket, minlength=258)
        tail = begin + count - tails
        order[tail[bucket] + np.arange(len(direct)) - (np.cumsum(tails) - tails)[bucket]] = direct
        head = begin.copy()
        for c in np.flatnonzero(count).tolist():
            if c:
                some = order[begin[c] : head[c]]
                while len(some):
                    some = some[some > 0] - 1
                    some = some[t[some] == c]
                    order[head[c] : head[c] + len(some)] = some
                    head[c] += len(some)
            before = order[begin[c] : begin[c] + count[c]]
            before = before[before > 0] - 1
            symbol = t[before]
            before, symbol = before[symbol > c], symbol[symbol > c]
            if len(before):
                by = np.argsort(symbol, kind="stable")
                before, symbol = before[by], symbol[by]
                pushed = np.bincount(symbol, minlength=258)
                order[head[symbol] + np.arange(len(before)) - (np.cumsum(pushed) - pushed)[symbol]] = before
                head += pushed
        return order

    def common(self) -> np.ndarray:
        """Common prefix of each suffix and the one before it, in order.

        If both are preceded by the same symbol, it is one less than that of
        the suffix before in the text; only the others are compared."""
        t, n, words = self.symbols, self.n, self.words
        ahead = np.full(n, -1, np.int64)
        ahead[self.order[1:]] = self.order[:-1]
        here = np.arange(n)
        same = (here > 0) & (ahead > 0)
        same[same] = (t[here[same] - 1] == t[ahead[same] - 1]) & (t[here[same] - 1] > 0)
        known = np.flatnonzero(~same)
        size = np.zeros(len(known), np.int64)
        live = np.flatnonzero((ahead[known] >= 0) & (t[known] > 0))
        while len(live):
            a, b = known[live] + size[live], ahead[known[live]] + size[live]
            full = (words[a] == words[b]) & (words[a] & 511 > 0)
            size[live[full]] += 7
            rest, live = live[~full], live[full]
            while len(rest):
                a, b = known[rest] + size[rest], ahead[known[rest]] + size[rest]
                rest = rest[(t[a] == t[b]) & (t[a] > 0)]
                size[rest] += 1
        shared = np.zeros(n, np.int64)
        shared[known] = size
        source = np.maximum.accumulate(np.where(same, 0, here))
        shared = shared[source] - (here - source)
        return shared[self.order]


def repeated(strings: list[bytes], counts: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """For each string the ranges of places where a repeated window starts;
    string ``i`` stands for ``counts[i]`` equal ones."""
    array = SuffixArray(strings)
    order, owner = array.order, array.owner
    group = np.cumsum(array.common() < length) - 1
    whole = order + length <= array.end[owner[order]]
    weight = np.bincount(group, weights=np.where(whole, counts[owner[order]], 0))
    again = np.zeros(array.n + 1, bool)
    again[order[whole & (weight[group] > 1)]] = True
    edge = np.flatnonzero(np.diff(np.concatenate(([False], again)).astype(np.int8)))
    spans: list[list[tuple[int, int]]] = [[] for _ in strings]
    for low, high in edge.reshape(-1, 2).tolist():
        own = int(owner[low])
        spans[own].append((low - int(array.begin[own]), high - int(array.begin[own])))
    return spans


# --- Spark ------------------------------------------------------------------

_SPANS = "array<struct<low:bigint,high:bigint>>"
_SPANS_ARROW = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))


def _span_array(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"low": a, "high": b} for a, b in s] for s in spans], _SPANS_ARROW)


def _portions(batches: Iterator[pa.RecordBatch], size: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose binary columns hold at most about ``size``
    bytes, or one row."""
    for batch in batches:
        step = max(1, int(batch.num_rows * size / max(1, batch.nbytes)))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


def _keys(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``(id, key, n)``: how often each text of ``texts(id, text, n)`` has
    each key (a segment in which a window may repeat counts twice)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            text, _, _, key, twice = segments(batch.column(1).to_pylist(), length, gram)
            order = np.lexsort((key, text))
            text, key, twice = text[order], key[order], twice[order]
            edge = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (key[1:] != key[:-1])))) if len(text) else np.empty(0, np.int64)
            n = (np.add.reduceat(1 + twice, edge) if len(edge) else edge) * batch.column(2).to_numpy(zero_copy_only=False)[text[edge]]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text[edge])), pa.array(key[edge].view(np.int64)), pa.array(n.astype(np.int64))], names=["id", "key", "n"])

    return map_batches(texts, run, "id binary, key bigint, n bigint")


def _cut(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """The segments of ``texts(id, text, n, keys)`` with a key in ``keys``.

    A row for each text, with ``held``: the windows of all of these; and rows
    for the segments themselves, equal ones of a portion counted as one (with
    the place of one of them)."""
    names = ["id", "held", "first", "key", "segment", "bytes", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches, 1 << 22):
            ids, texts, weights = (batch.column(i).to_pylist() for i in (0, 1, 2))
            text, first, count, key, _ = segments(texts, length, gram, inner=False)
            wanted = batch.column(3)
            number = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
            pairs = np.unique(np.stack([number, wanted.flatten().to_numpy(zero_copy_only=False)]), axis=1)
            # Both sides are sorted by text; keys are looked up text by text.
            keep = np.zeros(len(text), bool)
            low, high = (np.searchsorted(pairs[0], np.arange(batch.num_rows), s) for s in ("left", "right"))
            begin, stop = (np.searchsorted(text, np.arange(batch.num_rows), s) for s in ("left", "right"))
            for a, b, c, d in zip(low.tolist(), high.tolist(), begin.tolist(), stop.tolist(), strict=True):
                if b > a:
                    keep[c:d] = np.isin(key[c:d].view(np.int64), pairs[1, a:b])
            rows = zip(text[keep].tolist(), first[keep].tolist(), count[keep].tolist(), key[keep].view(np.int64).tolist(), strict=True)
            held: list[list[tuple[int, int]]] = [[] for _ in ids]
            made: dict[bytes, list] = {}
            for t, a, n, k in rows:
                if held[t] and held[t][-1][1] == a:
                    held[t][-1] = (held[t][-1][0], a + n)
                else:
                    held[t].append((a, a + n))
                piece = texts[t][a : a + n + length - 1]
                name = hashlib.blake2b(piece, digest_size=16).digest()
                if name in made:
                    made[name][-1] += weights[t]
                else:
                    made[name] = [ids[t], a, k, name, piece, weights[t]]
            some = [i for i, spans in enumerate(held) if spans]
            none = [None] * len(some)
            columns = list(zip(*made.values(), strict=True)) or [()] * 6
            lists = [
                pa.array([*(ids[i] for i in some), *columns[0]], pa.binary()),
                pa.concat_arrays([_span_array([held[i] for i in some]), pa.nulls(len(made), _SPANS_ARROW)]),
                *[pa.array([*none, *c], t) for c, t in zip(columns[1:], (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()), strict=True)],
            ]
            yield pa.RecordBatch.from_arrays(lists, names=names)

    return map_batches(texts, run, f"id binary, held {_SPANS}, first bigint, key bigint, segment binary, bytes binary, n bigint")


def _outside(spans: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """What ranges (in order, apart) leave of ``n`` places."""
    edges = [0, *[x for span in spans for x in span], n]
    return [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if a < b]


def _singles(parts: DataFrame, length: int) -> DataFrame:
    """``(id, spans)`` of the windows that no other window equals, at their
    places in the texts; ``parts(key, bytes, n, id, first)``."""

    def found(held: list[tuple[bytes, int, bytes, int]]) -> pa.RecordBatch:
        spans = repeated([h[0] for h in held], np.array([h[1] for h in held], np.float64), length)
        ids, made = [], []
        for (text, n, name, first), own in zip(held, spans, strict=True):
            alone = _outside(own, len(text) - length + 1) if n == 1 else []
            if alone:
                ids.append(name)
                made.append([(a + first, b + first) for a, b in alone])
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), _span_array(made)], names=["id", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= BLOCK and key != last:
                    yield found(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[0])
                last = key
        if held:
            yield found(held)

    dealt = parts.select("key", "bytes", "n", "id", "first").repartition("key").sortWithinPartitions("key")
    return map_batches(dealt, run, f"id binary, spans {_SPANS}")


def _hot_singles(hot: DataFrame, length: int, longer: list[int]) -> DataFrame:
    """:func:`_singles` of segments with hot keys, dealt again."""
    texts = stage(hot.select(F.col("segment").alias("id"), F.col("bytes").alias("text"), "n"), "hot-segments")
    below = _repeated_windows(texts, texts, length, longer).withColumnRenamed("id", "segment")
    once = hot.where("n = 1").select("segment", "id", "first", (F.length("bytes") - length + 1).alias("windows")).join(below, "segment", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, made = [], []
            for name, first, n, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                alone = _outside([(s["low"], s["high"]) for s in spans or ()], n)
                if alone:
                    ids.append(name)
                    made.append([(a + first, b + first) for a, b in alone])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), _span_array(made)], names=["id", "spans"])

    return map_batches(once.select("id", "first", "windows", "spans"), run, f"id binary, spans {_SPANS}")


def _repeated_windows(texts: DataFrame, whole: DataFrame, length: int, sizes: list[int]) -> DataFrame:
    """``(id, spans)``: where repeated windows start in each text, in order.

    ``texts(id, text, n)`` may hold a text several times, ``whole`` holds
    each once, with its count."""
    gram, *longer = sizes
    keys = stage(_keys(texts, length, gram), "window-keys")
    shared = keys.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")
    wanted = keys.select("id", "key").join(shared, "key", "left_semi").groupBy("id").agg(F.collect_set("key").alias("keys"))
    cut = stage(_cut(whole.join(wanted, "id").select("id", "text", "n", "keys"), length, gram), "segments")
    # The place is that of the only one if the count is one.
    one = [F.first("bytes").alias("bytes"), F.sum("n").alias("n"), F.min("id").alias("id"), F.min("first").alias("first")]
    parts = stage(cut.where("key is not null").groupBy("key", "segment").agg(*one), "distinct-segments")
    hot = None
    if longer:
        hot = stage(parts.groupBy("key").agg(F.sum(F.length("bytes")).alias("size")).where(F.col("size") > BLOCK).select("key"), "hot-keys")
    if hot is None or hot.isEmpty():
        singles = _singles(parts, length)
    else:
        singles = _singles(parts.join(hot, "key", "left_anti"), length).unionByName(_hot_singles(parts.join(hot, "key", "left_semi"), length, longer))
    none = F.lit(None).cast(_SPANS)
    rows = cut.where("key is null").select("id", "held", none.alias("alone")).unionByName(singles.select("id", none.alias("held"), F.col("spans").alias("alone")))
    per_text = rows.groupBy("id").agg(F.flatten(F.collect_list("held")).alias("held"), F.flatten(F.collect_list("alone")).alias("alone"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, made = [], []
            for name, held, alone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                spans = _without(_merged(held), _merged(alone))
                if spans:
                    ids.append(name)
                    made.append(spans)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), _span_array(made)], names=["id", "spans"])

    return map_batches(per_text, run, f"id binary, spans {_SPANS}")


def _merged(spans: list[dict], more: int = 0) -> list[tuple[int, int]]:
    """Ranges in order, each ``more`` longer, joined where they meet."""
    out: list[tuple[int, int]] = []
    for low, high in sorted((s["low"], s["high"] + more) for s in spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _without(spans: list[tuple[int, int]], holes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``spans`` without ``holes``, which lie within them."""
    out, at = [], 0
    for low, high in spans:
        while at < len(holes) and holes[at][0] < high:
            if low < holes[at][0]:
                out.append((low, holes[at][0]))
            low = holes[at][1]
            at += 1
        if low < high:
            out.append((low, high))
    return out


def _results(whole: DataFrame, length: int, text: bool) -> DataFrame:
    """What is left of every text of ``whole(id, text, spans)``."""
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"] + ["kept"] * text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            rows = []
            for own, given in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                spans = _merged(given or [], length - 1)
                kept = b"".join([own[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(own)], strict=True)])
                rows.append((len(own), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest(), spans, kept))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            arrays = [batch.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string()), _span_array(cols[4])]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(cols[5], pa.binary())] * text, names=names)

    return map_batches(whole, run, f"id binary, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans {_SPANS}" + ", kept binary" * text)


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, text: bool = True) -> DataFrame:
    """``docs`` with what repeated windows leave of each text.

    Added columns: ``n_bytes``, ``n_removed``, ``n_spans`` (long),
    ``kept_sha256``, ``spans`` (removed byte ranges, ``high`` excluded) and,
    with ``text``, ``kept`` (the bytes left; binary, since a cut may fall
    inside a character).
    """
    own = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    name = F.substring(F.unhex(F.sha2(own, 256)), 1, 16)
    each = docs.select(name.alias("id"), own.alias("text"))
    whole = each.groupBy("id").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n"))
    spans = _repeated_windows(each.withColumn("n", F.lit(1).cast("bigint")), whole, length, grams(length))
    left = _results(whole.join(spans, "id", "left").select("id", "text", "spans"), length, text)
    added = [c for c in left.columns if c != "id"]
    base = without(docs, *[c for c in added if c.lower() != text_col.lower()])
    taken = {c.lower() for c in base.columns}
    key = next(k for k in ("text_id", *(f"text_id_{i}" for i in range(len(taken) + 1))) if k not in taken)
    keyed = base.withColumn(key, name)
    if text_col.lower() in added:
        keyed = without(keyed, text_col)
    return keyed.join(left.withColumnRenamed("id", key), key).drop(key)
