"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words, all of them, however
long it is.  A passage is described by the shapes of its words (letters,
capitals, digits and signs, runs collapsed; hashed into ``SHAPES`` shares)
and by counts: repeated and neighbouring equal words, word lengths, signs,
capitals, digits, non-ASCII bytes.  An encoder turns each description into a
hidden vector; gated attention weighs the passages of a document, and the
weighted sum is scored.  Encoder, gates and output are learnt together from
document labels alone.

Learning: the descriptions of a sample of labelled rows of about
``SAMPLE_ROWS`` at most come to the driver and the weights (a few thousand
numbers) are fitted there.  Scoring reads every whole text once, passages in
portions, with running attention sums, so memory does not grow with a text.

Edge cases: a null or wordless text is one empty passage; without labels of
both kinds every score is the share of label 1 (0.5 without any); repeated
rows score alike; an empty table gives an empty result; columns named like
an added column are replaced, others pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import add_columns, map_batches
from tidewater.llm.labelled import sample

SAMPLE_ROWS = 8_000
PASSAGE = 64
SHAPES = 64
COUNTS = 12
HIDDEN = 16
GATES = 8
EPOCHS = 25
BATCH = 64
RATE = 0.01
DECAY = 1e-5
THRESHOLD = 0.3
PORTION = 1 << 16
LONG = 256
_CACHE = 300_000

_RUN = re.compile(r"(.)\1+")
#: Characters of a word by kind: a letter, A capital, 0 digit; others stay.
_KIND = bytes(97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))


class Descriptions:
    """Descriptions of the passages of texts; remembers word shapes."""

    size = SHAPES + COUNTS

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.kinds: dict[bytes, int] = {}
        self.rows: list[tuple[float, ...]] = []
        self.row_of: dict[tuple[float, ...], int] = {}
        self.table = np.empty((0, 10))
        self.age = 0

    def _learn(self, word: bytes) -> int:
        """Row of a word, which its kinds of characters decide alone."""
        kinds = word.translate(_KIND)
        at = self.kinds.get(kinds)
        if at is None:
            at = self._describe(kinds)
            if len(self.kinds) >= _CACHE:
                self.kinds.clear()
            self.kinds[kinds] = at
        if len(word) > LONG:  # not worth remembering
            del self.kinds[kinds]
            return at
        if len(self.known) >= _CACHE:
            self.known.clear()
        self.known[word] = at
        return at

    def _describe(self, kinds: bytes) -> int:
        shape = _RUN.sub(r"\1", kinds[:64].decode("latin-1"))
        n = len(kinds)
        letters, capitals, digits = kinds.count(b"a"), kinds.count(b"A"), kinds.count(b"0")
        signs = n - letters - capitals - digits
        row = (
            xxhash.xxh32_intdigest(shape.encode("latin-1")) % SHAPES, min(n, 40) / 10, float(signs == n), float(signs >= 2), signs / n,
            float(capitals >= 2), capitals / n, digits / n, float(n > 25), float(kinds[-1:] == b"." and signs == 1),
        )
        if row not in self.row_of:
            if len(self.rows) >= _CACHE:
                self._forget()
            self.row_of[row] = len(self.rows)
            self.rows.append(row)
        return self.row_of[row]

    def _rows_of(self, codes: np.ndarray) -> np.ndarray:
        """Shape rows of word codes; the table grows with the shapes met."""
        if len(self.table) < len(self.rows):
            self.table = np.concatenate((self.table, np.array(self.rows[len(self.table) :])))
        return self.table[codes]

    def _forget(self) -> None:
        self.age += 1
        self.table = self.table[:0]
        self.known.clear()
        self.kinds.clear()
        self.rows.clear()
        self.row_of.clear()

    def of(self, text: bytes | None) -> Iterator[np.ndarray]:
        """Portions of the text's passages, one row a passage."""
        words = text.split() if text else []
        for i in range(0, max(1, len(words)), PORTION):
            yield self._portion(words[i : i + PORTION])

    def _portion(self, words: list[bytes]) -> np.ndarray:
        n = len(words)
        if not n:
            return np.zeros((1, self.size), np.float32)
        get, learn, age = self.known.get, self._learn, self.age
        codes = np.array([get(w, -1) for w in words], np.int64)
        if (missing := np.flatnonzero(codes < 0)).size:
            for at in missing.tolist():
                codes[at] = learn(words[at])
            if self.age != age:  # the rows of known words were forgotten
                return self._portion(words)
        same = np.array([hash(w) for w in words], np.int64)
        passage = np.arange(n) // PASSAGE
        count = passage[-1] + 1
        if count > 1 and n - (count - 1) * PASSAGE < PASSAGE // 4:  # a short rest joins the passage before
            passage[passage == count - 1] -= 1
            count -= 1
        size = np.bincount(passage).astype(float)
        table = self._rows_of(codes)
        shapes = np.bincount(passage * SHAPES + table[:, 0].astype(np.int64), minlength=count * SHAPES).reshape(count, SHAPES) / size[:, None]
        means = np.stack([np.bincount(passage, weights=table[:, k]) for k in range(1, table.shape[1])], axis=1) / size[:, None]
        beside = np.concatenate(([False], (same[1:] == same[:-1]) & (passage[1:] == passage[:-1])))
        order = np.lexsort((same, passage))
        new = np.concatenate(([True], (same[order][1:] != same[order][:-1]) | (passage[order][1:] != passage[order][:-1])))
        distinct = np.bincount(passage[order], weights=new) / size
        extra = [np.bincount(passage, weights=beside) / size, distinct, np.log1p(size) / 5]
        return np.concatenate([shapes, means, np.stack(extra, axis=1)], axis=1).astype(np.float32)


class AttentionScorer:
    """Gated-attention multiple-instance network with a logistic output."""

    def __init__(self, prior: float, size: int = Descriptions.size, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.mean, self.spread, self.trained = np.zeros(size), np.ones(size), False
        normal = lambda *shape: draw.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.p = {
            "encode": normal(size, HIDDEN), "encode_b": np.zeros(HIDDEN), "value": normal(HIDDEN, GATES), "gate": normal(HIDDEN, GATES),
            "weigh": np.zeros(GATES), "out": normal(HIDDEN), "out_b": np.array([np.log(prior / (1 - prior))]),
        }

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Encoded passages, both sides of the gate, and attention logits."""
        h = np.tanh((x - self.mean) / self.spread @ self.p["encode"] + self.p["encode_b"])
        v, g = np.tanh(h @ self.p["value"]), 1 / (1 + np.exp(-(h @ self.p["gate"])))
        return h, v, g, (v * g) @ self.p["weigh"]

    def score(self, portions: Iterator[np.ndarray]) -> float:
        if not self.trained:
            return float(1 / (1 + np.exp(-self.p["out_b"][0])))
        top, total, mixed = -np.inf, 0.0, np.zeros(HIDDEN)
        for x in portions:
            h, _, _, a = self.hidden(x)
            new = max(top, float(a.max()))
            keep, e = np.exp(top - new), np.exp(a - new)
            top, total, mixed = new, total * keep + float(e.sum()), mixed * keep + e @ h
        margin = float(mixed / total @ self.p["out"] + self.p["out_b"][0])
        return 1 / (1 + float(np.exp(-np.clip(margin, -40, 40))))

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> None:
        """Adam over mini-batches of bags."""
        draw, p = np.random.default_rng(seed), self.p
        every = np.concatenate(bags)
        self.mean, self.spread, self.trained = every.mean(axis=0), every.std(axis=0) + 0.02, True
        m, s, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
        for _ in range(epochs):
            order = draw.permutation(len(bags))
            for i in range(0, len(order), BATCH):
                some = order[i : i + BATCH]
                x = np.concatenate([bags[b] for b in some])
                count = np.array([len(bags[b]) for b in some])
                starts, owner = np.cumsum(count) - count, np.repeat(np.arange(len(some)), count)
                z = (x - self.mean) / self.spread
                h, v, g, a = self.hidden(x)
                e = np.exp(a - np.maximum.reduceat(a, starts)[owner])
                share = e / np.add.reduceat(e, starts)[owner]
                mixed = np.add.reduceat(share[:, None] * h, starts)
                margin = mixed @ p["out"] + p["out_b"][0]
                error = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels[some]) / len(some)
                d_mixed = error[:, None] * p["out"]
                d_share = (d_mixed[owner] * h).sum(axis=1)
                d_a = share * (d_share - np.add.reduceat(share * d_share, starts)[owner])
                d_v, d_g = d_a[:, None] * p["weigh"] * g * (1 - v**2), d_a[:, None] * p["weigh"] * v * g * (1 - g)
                d_h = (share[:, None] * d_mixed[owner] + d_v @ p["value"].T + d_g @ p["gate"].T) * (1 - h**2)
                grad = {
                    "encode": z.T @ d_h, "encode_b": d_h.sum(axis=0), "value": h.T @ d_v, "gate": h.T @ d_g,
                    "weigh": (v * g).T @ d_a, "out": mixed.T @ error, "out_b": np.array([error.sum()]),
                }
                step += 1
                for k, d in grad.items():
                    d = d + DECAY * p[k]
                    m[k], s[k] = 0.9 * m[k] + 0.1 * d, 0.999 * s[k] + 0.001 * d * d
                    p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> AttentionScorer:
    """The scorer fitted on a bounded sample of labelled documents."""
    known = sample(docs, labels, label_col, F.lit(True) if learn is None else learn, rows, id_col, text_col)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Descriptions()
        for batch in batches:
            bags = [b"".join(x.tobytes() for x in found.of(t)) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bags, pa.binary())], names=["label", "bag"])

    # About ``rows`` bags; a passage of 64 words is 300 bytes.
    got = map_batches(known, describe, "label int, bag binary").toArrow().sort_by([("bag", "ascending"), ("label", "ascending")])
    labels_ = (got.column("label").to_numpy() > 0).astype(float)
    scorer = AttentionScorer((labels_.sum() + 0.5) / (len(labels_) + 1))
    if 0 < labels_.sum() < len(labels_):
        scorer.fit([np.frombuffer(b, np.float32).reshape(-1, Descriptions.size).astype(float) for b in got.column("bag").to_pylist()], labels_)
    return scorer


def score(docs: DataFrame, scorer: AttentionScorer, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    held = docs.sparkSession.sparkContext.broadcast(scorer)
    state: dict[str, Descriptions] = {}

    def run(texts: list) -> list[list]:
        found = state.setdefault("found", Descriptions())
        scores = [held.value.score(found.of(t.encode("utf-8", "replace") if isinstance(t, str) else t)) for t in texts]
        return [scores, [int(s >= threshold) for s in scores]]

    return add_columns(docs, "score double, predicted int", run, text_col)


def keep_good(docs: DataFrame, labels: DataFrame, learn: Column | None = None, text_col: str = "text", **options) -> DataFrame:
    """The documents that are not predicted to be of low quality."""
    scored = score(docs, train(docs, labels, learn, text_col=text_col, **options), text_col)
    return scored.where("predicted = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
