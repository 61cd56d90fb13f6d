"""Toxicity scores by a factorization machine over hashed terms.

Terms of a word (a run of letters, lower-cased) are the word and its
prefixes of 4 to 6 letters, hashed into ``2 ** HASH_BITS`` buckets.  Every
bucket in ``LEAST_DOCS`` documents is weighed by its evidence: by how many
standard deviations its presence differs between the labels, in full from
``FULL_APART`` and falling with the cube below it (under ``LEAST_APART``, a
weight below 1/64, it is left out), or in full if it tells the labels apart
together with another bucket.  A text has for each bucket a value for its
presence and one for its share of the words.  The machine adds to the linear
weights an inner product of learned factors for every pair of features in
full weight that meet in a text (no pair of the others has shown anything), so an insult beside a group mention can weigh more than both
alone, also where neither tells anything alone.

A pair counts if the documents with both differ from those with the first
alone and from those with the second alone, by a likelihood ratio of
``LEAST_PAIR`` in each case, or of twice the logarithm of the number of
pairs if that is more, which by chance hardly any pair reaches; equal
documents count once.  All pairs that meet
in ``PAIR_DOCS`` documents are counted exactly, bucket by bucket in Spark
tasks (buckets of the same documents are one); the work is the sum of the
squares of the terms of the sample's documents, the memory of a task the
sample's terms.

Learning: bucket counts are summed in Spark over a sample of labelled rows
of about ``SAMPLE_ROWS`` at most, the counts (``2 ** HASH_BITS`` at most)
come to the driver, the sample's buckets go from there to the tasks that
count pairs, then its sparse features (bounded by the same number of rows)
come to the driver, and the weights are fitted there.  The model has at most
18 numbers a bucket whatever the input.  Scoring reads every whole text once.

All words of many texts are hashed at once by a rolling hash over their
bytes; there is no loop over words.

Edge cases: a null or wordless text has the score of no features; without
labels of both kinds every score is the share of label 1 (0.5 without any);
repeated rows score alike; an empty table gives an empty result; columns
named like an added column are replaced, others pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import add_columns, map_batches, ship
from tidewater.llm.labelled import sample

SAMPLE_ROWS = 20_000
HASH_BITS = 18
FEATURES = 1 << HASH_BITS
LEAST_DOCS = 3
LEAST_APART = 1.0
FULL_APART = 4.0
PAIR_DOCS = 8
LEAST_PAIR = 24.0
PAIR_TASKS = 48
PREFIXES = (4, 5, 6)
FACTORS = 8
EPOCHS = 40
BATCH = 256
RATE = 0.1
DECAY = 1e-5
CLEAR = 4.0
SHARE_SCALE = 25.0
THRESHOLD = 0.7
_PART = 1 << 19
_PORTION = 1 << 20

_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _up_and_down(n: int) -> list[np.ndarray]:
    """Powers of the base of the rolling hash and of its inverse."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32)) ^ np.uint64(salt)) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return (h >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def _terms(letters: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the words of ``letters`` (words apart by spaces), and for
    every term the number of its word and its bucket."""
    data = np.frombuffer(letters, np.uint8)
    inside = np.concatenate(([False], data != 32, [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    up, down = _up_and_down(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    words, buckets = [np.arange(len(start))], [_mixed((sums[end] - sums[start]) * down[start], 0)]
    # A prefix of k letters ends where the letter k after the first begins.
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    at = np.searchsorted(begins, start)
    size = np.searchsorted(begins, end) - at
    for k in PREFIXES:
        long = np.flatnonzero(size > k)
        words.append(long)
        first = start[long]
        buckets.append(_mixed((sums[begins[at[long] + k]] - sums[first]) * down[first], k))
    return start, np.concatenate(words), np.concatenate(buckets)


def buckets_of(word: bytes) -> list[int]:
    """Buckets of a word's terms."""
    return _terms(word)[2].tolist()


def _portions(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``_PART`` characters, or one text."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > first and size + n > _PART:
            yield first, i
            first, size = i, 0
        size += n
    if len(texts) > first:
        yield first, len(texts)


def term_counts(texts: list[str | None], number: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every bucket that a text holds: the text, the bucket, and how
    often; and the words of each text.  With ``number`` (one for each bucket)
    buckets are renamed by it and those numbered -1 left out.

    All words of many texts are hashed at once, in parts that end between
    words, so that memory does not grow with a text."""
    n_words = np.zeros(len(texts), np.int64)
    keys: list[np.ndarray] = []
    times: list[np.ndarray] = []
    for low, high in _portions(texts):
        some = [(t or "").lower().encode("utf-8", "replace") for t in texts[low:high]]
        letters = b" ".join(some).translate(_LETTERS)
        ends = np.cumsum([len(t) + 1 for t in some])
        at = 0
        while at < len(letters):
            stop = len(letters)
            if stop - at > _PART:
                stop = letters.rfind(b" ", at, at + _PART) + 1 or letters.find(b" ", at + _PART) + 1 or stop
            start, word, bucket = _terms(letters[at:stop])
            text = low + np.searchsorted(ends, start + at, side="right")
            n_words += np.bincount(text, minlength=len(texts))
            if number is not None:
                bucket = number[bucket]
                word, bucket = word[bucket >= 0], bucket[bucket >= 0]
            key = np.sort((text[word] << HASH_BITS) | bucket)
            edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
            keys.append(key[edge])
            times.append(np.diff(edge, append=len(key)))
            at = stop
    key, count = (np.concatenate([*x, np.empty(0, np.int64)]) for x in (keys, times))
    # A text that came in parts has a bucket several times.
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    if len(edge):
        key, count = key[edge], np.add.reduceat(count, edge)
    return key >> HASH_BITS, key & (FEATURES - 1), count, n_words


class Features:
    """Chosen features of texts: a bucket's presence, and its share of the
    words."""

    def __init__(self, buckets: np.ndarray):
        self.size = len(buckets)
        self.number = np.full(FEATURES, -1, np.int64)
        self.number[buckets] = np.arange(self.size)

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers and values of one text: presence, then share."""
        _, number, share = self.of_texts([text])
        return np.concatenate((number, number + self.size)), np.concatenate((np.ones(len(number)), share))

    def of_texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, feature number (of the presence; the share's is ``size``
        more) and share, by text and number."""
        text, number, count, words = term_counts(texts, self.number)
        return text, number, np.minimum(1.0, SHARE_SCALE * count / np.maximum(words[text], 1))


def _by(owner: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of ``values`` that have the same owner."""
    return np.stack([np.bincount(owner, weights=values[:, f], minlength=size) for f in range(values.shape[1])], axis=1)


class FactorizationMachine:
    """Second-order factorization machine with a logistic output.  Features
    that ``paired`` leaves out have no factors."""

    def __init__(self, size: int, prior: float, factors: int = FACTORS, seed: int = 7, paired: np.ndarray | None = None):
        draw = np.random.default_rng(seed)
        self.bias = float(np.log(prior / (1 - prior)))
        self.weight = np.zeros(size)
        self.slot = np.arange(size) if paired is None else np.where(paired, np.cumsum(paired) - 1, -1)
        self.factor = draw.normal(0, 0.02, (int((self.slot >= 0).sum()), factors))

    def margins(self, at: np.ndarray, value: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Margin of each of ``rows`` rows and the sums of its factors; entry
        ``i`` is the value of feature ``at[i]`` in row ``owner[i]``."""
        has = np.flatnonzero(self.slot[at] >= 0)
        scaled, mine = self.factor[self.slot[at[has]]] * value[has, None], owner[has]
        sums = _by(mine, scaled, rows)
        pairs = 0.5 * (sums**2 - _by(mine, scaled**2, rows)).sum(axis=1)
        return self.bias + np.bincount(owner, weights=self.weight[at] * value, minlength=rows) + pairs, sums

    def score(self, at: np.ndarray, value: np.ndarray) -> float:
        return float(self.scores(at, value, np.zeros(len(at), np.int64), 1)[0])

    def scores(self, at: np.ndarray, value: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(at, value, owner, rows)[0], -40, 40)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> None:
        """AdaGrad over mini-batches of the sparse rows; ends early once every
        row is on its side by a margin of ``CLEAR``.

        The gradient of a factor, sum of e x (S - V x) over the rows, is taken
        as sum of e x S less V times sum of e x x."""
        draw, size = np.random.default_rng(seed), len(self.weight)
        number, slots_seen = np.zeros(size, np.int64), np.zeros(len(self.factor), np.int64)
        seen_w, seen_v, seen_b = np.full(size, 1e-8), np.full(self.factor.shape, 1e-8), 1e-8
        # The entries that have factors, found once.
        slot = self.slot.astype(np.int32)
        paired = [(slot[at[h]], value[h]) for at, value in rows for h in [slot[at] >= 0]]
        side = np.where(labels > 0, 1.0, -1.0)
        for _ in range(epochs):
            order, least = draw.permutation(len(rows)), np.inf
            for i in range(0, len(order), BATCH):
                some = order[i : i + BATCH]
                at, value = (np.concatenate([rows[r][k] for r in some]) for k in (0, 1))
                mine, x = (np.concatenate([paired[r][k] for r in some]) for k in (0, 1))
                owner = np.repeat(np.arange(len(some)), [len(rows[r][0]) for r in some])
                count = np.array([len(paired[r][0]) for r in some])
                row = np.repeat(np.arange(len(some)), count)
                scaled = self.factor[mine] * x[:, None]
                sums, squares = _by_run(scaled, count), _by_run(scaled**2, count)
                margin = self.bias + np.bincount(owner, weights=self.weight[at] * value, minlength=len(some)) + 0.5 * (sums**2 - squares).sum(axis=1)
                least = min(least, float((margin * side[some]).min()))
                error = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels[some]
                number[at] = 1
                met = np.flatnonzero(number)
                number[met] = np.arange(len(met))
                g_w = np.bincount(number[at], weights=error[owner] * value, minlength=len(met)) / len(some) + DECAY * self.weight[met]
                number[met] = 0
                slots_seen[mine] = 1
                slots = np.flatnonzero(slots_seen)
                slots_seen[slots] = np.arange(len(slots))
                place, push = slots_seen[mine], error[row] * x
                slots_seen[slots] = 0
                g_v = np.stack([np.bincount(place, weights=push * sums[row, f], minlength=len(slots)) for f in range(self.factor.shape[1])], axis=1)
                g_v = g_v - self.factor[slots] * np.bincount(place, weights=push * x, minlength=len(slots))[:, None]
                g_v = g_v / len(some) + DECAY * self.factor[slots]
                seen_w[met] += g_w**2
                seen_v[slots] += g_v**2
                self.weight[met] -= RATE * g_w / np.sqrt(seen_w[met])
                self.factor[slots] -= 0.2 * RATE * g_v / np.sqrt(seen_v[slots])
                g_b = error.sum() / len(some)
                seen_b += g_b**2
                self.bias -= RATE * g_b / np.sqrt(seen_b)
            if least >= CLEAR:
                break


def _by_run(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of ``count`` rows of ``values`` after each other."""
    total = np.zeros((len(values) + 1, values.shape[1]))
    np.cumsum(values, axis=0, out=total[1:])
    ends = np.cumsum(count)
    return total[ends] - total[ends - count]


def _likelihood_ratio(ones: np.ndarray, docs: np.ndarray, other_ones: np.ndarray, other_docs: np.ndarray) -> np.ndarray:
    """Twice the log likelihood ratio of two label shares against one."""

    def fits(k: np.ndarray, n: np.ndarray) -> np.ndarray:
        share = k / np.maximum(n, 1)
        return k * np.log(np.maximum(share, 1e-300)) + (n - k) * np.log(np.maximum(1 - share, 1e-300))

    return 2 * (fits(ones, docs) + fits(other_ones, other_docs) - fits(ones + other_ones, docs + other_docs))


class Pairs:
    """Documents as lists of buckets, which are numbered anew from the rarest
    on, each set of buckets that are in the same documents as one."""

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray, size: int):
        draw = np.random.default_rng(3).integers(0, 1 << 63, (len(rows), 2), dtype=np.uint64)
        # Row by row, since the sample's terms are many.
        marks = np.zeros((size, 3), np.uint64)
        for row, mark in zip(rows, draw, strict=True):
            marks[row] += np.array([1, *mark], np.uint64)
        kinds, one, number = np.unique(marks, axis=0, return_index=True, return_inverse=True)
        self.number = number.reshape(-1)  # of each bucket; the rarest have the smallest
        self.n = kinds[:, 0].astype(np.int64)
        del marks, kinds
        lead = np.zeros(size, bool)
        lead[one] = True
        self.size, self.labels = len(one), labels > 0
        self.length = np.array([int(lead[r].sum()) for r in rows], np.int64)
        self.at, end = np.empty(int(self.length.sum()), np.uint16 if self.size <= 1 << 16 else np.int32), 0
        self.ones = np.zeros(self.size, np.int64)
        for row, n, label in zip(rows, self.length.tolist(), self.labels.tolist(), strict=True):
            self.at[end : end + n] = held = np.sort(self.number[row[lead[row]]])
            self.ones[held] += label
            end += n
        self.ends = np.cumsum(self.length)

    def take(self, first: int, step: int = 1) -> None:
        """Make the index of the buckets ``first``, ``first + step`` and so
        on: where in the documents they are.  There is no index of all, which
        would be larger than the documents, in any task."""
        self.first, self.step, found = first, step, []
        for i in range(0, len(self.at), _PORTION):
            found.append(i + np.flatnonzero(self.at[i : i + _PORTION] % self.at.dtype.type(step) == first))
        place = np.concatenate([*found, np.empty(0, np.int64)])
        self.place = place[np.argsort(self.at[place], kind="stable")]
        self.stops = np.cumsum(self.n[first::step])

    def __getstate__(self) -> tuple:
        # Steps between a document's buckets are small and pack well; they
        # are packed and unpacked in portions, so that no second copy of all
        # is made.
        packed = [zlib.compress(np.diff(part, prepend=part.dtype.type(0)).tobytes(), 1) for i in range(0, len(self.at), _PORTION) for part in [self.at[i : i + _PORTION]]]
        return self.size, self.n, self.ones, self.length, self.labels, self.at.dtype.str, packed

    def __setstate__(self, state: tuple) -> None:
        self.size, self.n, self.ones, self.length, self.labels, kind, packed = state
        self.ends = np.cumsum(self.length)
        self.at, end = np.empty(int(self.length.sum()), kind), 0
        for part in packed:
            steps = np.frombuffer(zlib.decompress(part), kind)
            np.cumsum(steps, dtype=kind, out=self.at[end : end + len(steps)])
            end += len(steps)

    def found(self, k: int) -> np.ndarray:
        """Buckets that tell the labels apart together with bucket ``k``, of
        those numbered after it."""
        if not hasattr(self, "place") or k % self.step != self.first:
            self.take(0)
        stop = self.stops[(k - self.first) // self.step]
        first = self.place[stop - self.n[k] : stop] + 1
        owner = np.searchsorted(self.ends, first)
        last, label = self.ends[owner], self.labels[owner]
        both = [self._met(k, first[label == kind], last[label == kind]) for kind in (False, True)]
        met = both[0] + both[1]
        others = np.flatnonzero(met >= PAIR_DOCS)
        met, ones = met[others], both[1][others]
        least = self.least()
        good = _likelihood_ratio(ones, met, self.ones[k] - ones, self.n[k] - met) >= least
        others, met, ones = others[good] + k, met[good], ones[good]
        return others[_likelihood_ratio(ones, met, self.ones[others] - ones, self.n[others] - met) >= least]

    def least(self) -> float:
        """Likelihood ratio that hardly any of all pairs reaches by chance."""
        return max(LEAST_PAIR, 2 * np.log(max(1, self.size * (self.size - 1) // 2)))

    def _met(self, k: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """How often each bucket from ``k`` on is in the places given."""
        total, length = np.zeros(self.size - k, np.int64), last - first
        portion = np.cumsum(length) // _PORTION
        for some in np.split(np.arange(len(first)), np.flatnonzero(np.diff(portion)) + 1):
            size = length[some]
            shift = first[some] - (np.cumsum(size) - size)
            total += np.bincount(self.at[np.repeat(shift, size) + np.arange(size.sum())] - k, minlength=self.size - k)
        return total


def _rows(values: np.ndarray, owner: np.ndarray, n: int) -> list[np.ndarray]:
    """``values``, sorted by owner, as one array for each of ``n`` owners."""
    return np.split(values, np.searchsorted(owner, np.arange(1, n))) if n else []


def _arrays(column: pa.ChunkedArray, kind: str) -> list[np.ndarray]:
    """Binary values as arrays over the buffers they came in."""
    out: list[np.ndarray] = []
    for chunk in column.chunks:
        data = np.frombuffer(chunk.buffers()[2] or b"", np.uint8)
        ends = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1].tolist() if len(chunk) else []
        out += [data[a:b].view(kind) for a, b in zip(ends, ends[1:], strict=False)]
    return out


def _paired(rows: DataFrame, buckets: np.ndarray) -> np.ndarray:
    """Which of ``buckets`` tell the labels apart together with another."""
    spark = rows.sparkSession

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Features(buckets)
        for batch in batches:
            text, number, _ = found.of_texts(batch.column(1).to_pylist())
            held = [r.tobytes() for r in _rows(number.astype("<i4"), text, batch.num_rows)]
            kinds = pa.array([int(x > 0) for x in batch.column(0).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([kinds, pa.array(held, pa.binary())], names=["label", "at"])

    got = map_batches(rows, present, "label int, at binary").distinct().toArrow()
    pairs = Pairs(_arrays(got.column("at"), "<i4"), got.column("label").to_numpy(), len(buckets))
    del got
    number, held = pairs.number, spark.sparkContext.broadcast(pairs)
    del pairs

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.column(0).to_pylist():
                pairs, good = held.value, set()
                pairs.take(task, PAIR_TASKS)
                for k in range(task, pairs.size, PAIR_TASKS):
                    if len(others := pairs.found(k)):
                        good.update((k, *others.tolist()))
                yield pa.RecordBatch.from_arrays([pa.array(sorted(good), pa.int64())], names=["number"])

    good = map_batches(spark.range(0, PAIR_TASKS, 1, PAIR_TASKS), look, "number bigint").toArrow().column(0).to_numpy()
    held.destroy()
    return buckets[np.isin(number, good)]


def _choose(rows: DataFrame, features: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Buckets that tell the labels apart, alone or in pairs, their weights by
    evidence, and the label counts."""
    size = 1 << HASH_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_bucket, docs = np.zeros((2, size), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            kind = (batch.column(0).to_numpy(zero_copy_only=False) > 0).astype(np.int64)
            text, bucket, _, _ = term_counts(batch.column(1).to_pylist())
            for k in (0, 1):
                with_bucket[k] += np.bincount(bucket[kind[text] == k], minlength=size)
            docs += np.bincount(kind, minlength=2)
        at = np.flatnonzero(with_bucket.any(axis=0))
        # Bucket -1 carries the number of documents.
        columns = [np.concatenate(([-1], at)), np.concatenate((docs[:1], with_bucket[0, at])), np.concatenate((docs[1:], with_bucket[1, at]))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "zeros", "ones"])

    sums = map_batches(rows, count, "bucket bigint, zeros bigint, ones bigint").groupBy("bucket").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    # At most a row for each bucket and one for all documents.
    got = sums.where((F.col("bucket") < 0) | (F.col("zeros") + F.col("ones") >= LEAST_DOCS)).toArrow().sort_by("bucket")
    bucket, with_zeros, with_ones = (got.column(c).to_numpy() for c in ("bucket", "zeros", "ones"))
    zeros, ones = (int(with_zeros[0]), int(with_ones[0])) if len(bucket) else (0, 0)
    if not zeros or not ones:
        return np.empty(0, np.int64), np.empty(0), zeros, ones
    bucket, with_zeros, with_ones = bucket[1:], with_zeros[1:], with_ones[1:]
    docs = with_zeros + with_ones
    share = docs / (zeros + ones)
    # Difference of the two shares, in standard deviations.
    apart = np.abs(with_ones / ones - with_zeros / zeros) / np.sqrt(share * (1 - share) * (1 / ones + 1 / zeros) + 1e-12)
    apart[np.isin(bucket, _paired(rows, bucket[docs >= PAIR_DOCS]))] = np.inf
    best = np.lexsort((bucket, -apart))[:features]
    best = np.sort(best[apart[best] >= LEAST_APART])
    return bucket[best], np.minimum(1.0, apart[best] / FULL_APART) ** 3, zeros, ones


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS, features: int = FEATURES) -> tuple[np.ndarray, FactorizationMachine]:
    """Chosen buckets and the machine fitted on a bounded labelled sample."""
    known = sample(docs, labels, label_col, F.lit(True) if learn is None else learn, rows, id_col, text_col)
    ship(docs.sparkSession)
    buckets, evidence, zeros, ones = _choose(known, features)
    prior = (ones + 0.5) / (zeros + ones + 1)
    weigh = np.concatenate((evidence, evidence))
    machine = FactorizationMachine(2 * len(buckets), prior, paired=weigh >= 1)
    if not len(buckets):
        return buckets, machine

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Features(buckets)
        for batch in batches:
            text, number, share = found.of_texts(batch.column(1).to_pylist())
            at, value = (_rows(x.astype(t), text, batch.num_rows) for x, t in ((number, "<i4"), (share, "<f4")))
            # Rows are put in the order of their content, so a fit does not
            # depend on the partitions.
            place = [zlib.crc32(v.tobytes(), zlib.crc32(a.tobytes())) for a, v in zip(at, value, strict=True)]
            arrays = [pa.array([r.tobytes() for r in x], pa.binary()) for x in (at, value)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(place, pa.int64()), *arrays], names=["label", "place", "at", "value"])

    # About ``rows`` sparse rows of at most ``features`` entries each.
    got = map_batches(known, encode, "label int, place bigint, at binary, value binary").toArrow()
    at, share = _arrays(got.column("at"), "<i4"), _arrays(got.column("value"), "<f4")
    kinds = got.column("label").to_numpy()
    order = np.lexsort((kinds, [len(a) for a in at], got.column("place").to_numpy()))
    light = evidence.astype(np.float32)
    sparse = [(np.concatenate((at[i], at[i] + np.int32(len(buckets)))), np.concatenate((light[at[i]], light[at[i]] * share[i]))) for i in order]
    del got, at, share
    machine.fit(sparse, (kinds[order] > 0).astype(float))
    # Scoring has the plain values.
    machine.weight *= weigh
    return buckets, machine


def score(docs: DataFrame, model: tuple[np.ndarray, FactorizationMachine], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    state: dict[str, tuple] = {}

    def run(texts: list[str | None]) -> list[list]:
        if "model" not in state:
            buckets, machine = held.value
            state["model"] = Features(buckets), machine
        found, machine = state["model"]
        scores = np.empty(len(texts))
        for low, high in _portions(texts):
            text, number, share = found.of_texts(texts[low:high])
            at, value = np.concatenate((number, number + found.size)), np.concatenate((np.ones(len(share)), share))
            scores[low:high] = machine.scores(at, value, np.concatenate((text, text)), high - low)
        return [scores, (scores >= threshold).astype(np.int32)]

    return add_columns(docs, "score double, predicted int", run, text_col)


def keep_clean(docs: DataFrame, labels: DataFrame, learn: Column | None = None, text_col: str = "text", **options) -> DataFrame:
    """The documents that are not predicted toxic, columns unchanged."""
    scored = score(docs, train(docs, labels, learn, text_col=text_col, **options), text_col)
    return scored.where("predicted = 0").select(*[F.col(f"`{c}`") for c in docs.columns])
