"""Decontamination and license scans against brute force."""

from __future__ import annotations

import random
import re

import pytest

from tidewater.llm import decontaminate as D
from tidewater.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n=10):
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            size = min(n, len(v))
            for i in range(max(0, len(v) - size + 1) if v else 0):
                for p in range(len(w) - size + 1):
                    if w[p : p + size] == v[i : i + size]:
                        hit.update(range(p, p + size))
                        found.add(str(item)) if item is not None else None
        out.append((doc, len(w), len(hit), ",".join(sorted(found))))
    return sorted(out, key=str)


def scanned(frame):
    return sorted(((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["hit_spans"]), ",".join(sorted(r["hit_items"]))) for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def mixed():
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(25)] + ["é", "Öl", "x9"]
    items = [(i, " ".join(draw.choices(vocabulary, k=k))) for i, k in enumerate([30, 12, 10, 9, 3, 1, 0, 25])]
    items += [(1, items[0][1]), (None, "only null item marks these words here as hit now ok"), (9, None)]
    docs = []
    for i in range(60):
        text = " ".join(draw.choices(vocabulary, k=draw.randint(0, 80)))
        if i % 3 == 0:
            text += ". " + items[draw.randrange(len(items) - 1)][1].upper().replace(" ", ", ")
        docs.append((i, text))
    docs += [(0, docs[0][1]), (61, None), (62, ""), (None, "Only null ITEM marks these words here as hit now ok"), (63, "!!! ???"), (64, items[1][1] + " x " + items[1][1])]
    return docs, items


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 700])
def test_hits_match_brute_force(spark, mixed, block_bytes):
    docs, items = mixed
    got = D.find_hits(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), block_bytes=block_bytes)
    assert scanned(got) == brute(docs, items)


def test_documents_or_spans_are_removed(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id bigint, text string")
    rows = [(1, "Clean text.", 5), (2, "Before it: One two, three four five six SEVEN eight nine ten! After.", 6), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, hit_spans int")
    kept = D.decontaminate(docs.drop("hit_spans"), items)
    assert kept.columns == ["doc_id", "text"] and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "None"]
    cut = {r["doc_id"]: r["text"] for r in D.decontaminate(docs.drop("hit_spans"), items, remove="spans").collect()}
    assert cut == {1: "Clean text.", 2: "Before it: ! After.", None: None}
    with pytest.raises(ValueError):
        D.decontaminate(docs, items, remove="words")


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", "x")], "doc_id bigint, text string, n_words string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    got = D.find_hits(docs, none)
    assert got.columns == ["doc_id", "text", "n_words", "hit_spans", "hit_items"] and got.first()["n_words"] == 3
    assert D.find_hits(docs.limit(0), none).count() == 0


def license_brute(docs, templates):
    tokens = lambda t: [w for w in re.sub(r"[\W_]+", " ", (t or "").lower()).split(" ") if w]
    best = {}
    for doc, text in docs:
        w = tokens(text)
        s = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        for name, t in templates:
            v = tokens(t)
            want = {tuple(v[i : i + 5]) for i in range(len(v) - 4)}
            if not want:
                continue
            m = 1
            while m < len(v) - 4:
                m *= 2
            for k in range(0, len(s), m):
                share = len(want & set(s[k : k + 2 * m - 1])) / len(want)
                if share >= L.LEAST:
                    best[doc, name] = max(best.get((doc, name), 0), share)
    return best


@pytest.mark.parametrize("block", [L.BLOCK_SHINGLES, 20])
def test_licenses_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(L, "BLOCK_SHINGLES", block)
    draw = random.Random(3)
    noise = lambda k: " ".join(draw.choices([f"w{i}" for i in range(40)] + ["license", "the", "under"], k=k))
    docs = []
    for i in range(80):
        words_ = draw.choice(L.NOTICES)[1].split()
        for _ in range(draw.randint(0, 2)):
            words_[draw.randrange(len(words_))] = "changed"
        docs.append((i, f"{noise(draw.randint(0, 60))} {' '.join(words_)} {noise(draw.randint(0, 60))}"))
    docs += [(81, None), (82, ""), (83, "MIT License."), (0, docs[0][1]), (84, " ".join(t for _, t in L.NOTICES) * 3)]
    got = L.scan(spark.createDataFrame(docs, "doc_id bigint, text string"), L.notices(spark))
    assert {(r["doc_id"], r["license"]): r["containment"] for r in got.collect()} == license_brute(docs, L.NOTICES)


def test_license_edges(spark):
    docs = spark.createDataFrame([(None, "released under the mit license", 1)], "doc_id bigint, text string, words int")
    assert [(r["doc_id"], r["license"]) for r in L.scan(docs, L.notices(spark)).collect()] == [(None, "mit")]
    assert L.scan(docs.limit(0), L.notices(spark)).count() == 0
    assert L.scan(docs, spark.createDataFrame([("x", None), ("y", "too short")], "license string, text string")).count() == 0


def test_the_closest_notice_of_a_family_has_the_largest_containment(spark):
    named = {"agpl-3.0", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "cc0-1.0", "isc", "unlicense", "cc-by-nd-4.0", "cc-by-nc-sa-4.0", "cc-by-nc-nd-4.0"}
    docs = [(i, t, k) for i, (k, t) in enumerate(L.NOTICES) if k in named]
    rows = L.scan(spark.createDataFrame([d[:2] for d in docs], "doc_id bigint, text string"), L.notices(spark)).collect()
    for i, _, name in docs:
        assert {r["license"] for r in rows if r["doc_id"] == i and r["containment"] == 1} == {name}
    assert {d[2] for d in docs} == named
