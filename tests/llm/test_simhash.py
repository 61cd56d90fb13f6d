"""SimHash components against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from tidewater.llm import simhash as S
from tidewater.llm.components import components


def slow_fingerprint(text, shingle=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, radius=2):
    fps = [slow_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                label[root(i)] = root(j)
    name = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            name[root(i)] = min(name.get(root(i), d), d)
    return sorted(((d, fps[i], name.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def texts():
    draw = random.Random(2)
    words = [f"Wort{i}é" for i in range(300)]
    rows = []
    for g in range(40):
        base = draw.choices(words, k=draw.randint(3, 400))
        for c in range(draw.randint(1, 6)):
            copy = list(base)
            for _ in range(draw.randint(0, 2)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append((len(rows) * 7 % 1009, " \t".join(copy) + "\n" * (c % 2)))
    return rows + [(5000, None), (5001, ""), (5002, " \n\v\f\r"), (5003, "one"), (5004, "ONE"), (5005, "two words"), (5005, "two words"), (5005, "other\xa0words"), (None, "no id here"), (None, "two words")]


@pytest.mark.parametrize("tree_nodes", [S.TREE_NODES, 2])
def test_components_match_brute_force(spark, tree_nodes):
    rows = texts()
    got = S.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), tree_nodes=tree_nodes)
    assert sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got.collect()), key=str) == slow_components(rows)


def test_long_text_and_shingle_parameter():
    text = " ".join(f"w{i % 997}" for i in range(50_000))
    assert S.fingerprint(text.encode()) == slow_fingerprint(text)
    assert S.fingerprint(b"a b c d e f", 5) == slow_fingerprint("a b c d e f", 5)


def test_dense_clusters_are_linked_whole(spark):
    draw = random.Random(4)
    centre = draw.getrandbits(64)
    fps = {centre}
    while len(fps) < 3000:  # a few bits off one another: chains through the cluster
        fps.add(draw.choice(list(fps)[-50:]) ^ (1 << draw.randrange(64)))
    fps = sorted(fps)
    signed = [(S._signed(f),) for f in fps]
    found = components(S.links(spark.createDataFrame(signed, "fp bigint").distinct(), 2, tree_nodes=200))
    assert {r["root"] for r in found.collect()} == {min(signed)[0]} and found.count() == len(fps)


@pytest.mark.parametrize("radius", [0, 1, 2, 4])
def test_forest_links_equal_all_pairs(radius):
    draw = random.Random(radius)
    centres = [draw.getrandbits(64) for _ in range(6)]
    fps = sorted({c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))) for c in centres for _ in range(60)})
    fps, tree = np.array(fps, np.uint64), np.array([i % 3 for i in range(len(fps))])
    order = np.lexsort((fps, tree))
    fps, tree = fps[order], tree[order]
    got = {(int(max(p)), int(min(p))) for a, b in S.BKForest(fps, tree).links(radius) for p in zip(a, b)}
    want = {(i, j) for i in range(len(fps)) for j in range(i) if tree[i] == tree[j] and int(fps[i] ^ fps[j]).bit_count() <= radius}
    assert got == want


def test_any_two_close_fingerprints_share_a_shard():
    draw = random.Random(9)
    for radius in (1, 2, 3):
        masks = S.block_masks(radius)
        for _ in range(300):
            a = draw.getrandbits(64)
            b = a ^ sum(1 << k for k in draw.sample(range(64), radius))
            assert any(a & m == b & m for m in masks)


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(1, 200)]
    star = [(1000, k) for k in range(1001, 1300)]
    edges = spark.createDataFrame([*chain, *star, (5000, 5000), (7000, None), (3, 2), (3, 2), (-5, 6000)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 201)}, **{k: 1000 for k in range(1000, 1300)}, -5: -5, 6000: -5}
    assert components(edges.limit(0)).count() == 0


def test_dedup_keeps_one_of_each_component(spark):
    rows = texts()
    docs = spark.createDataFrame([(d, t, "x", d) for d, t in rows], "doc_id bigint, text string, fp string, component_id bigint")
    kept = S.dedup(docs)
    assert kept.columns == docs.columns
    classes = {}
    for (d, t) in rows:
        classes.setdefault(slow_fingerprint(t), set()).add(d)
    got = sorted(((r["doc_id"], slow_fingerprint(r["text"])) for r in kept.collect()), key=str)
    parts = slow_components(rows)
    # One row a component: every component has exactly one kept fingerprint.
    fps = sorted({f for _, f, _ in parts})
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                label[root(a)] = root(b)
    assert sorted(root(f) for _, f in got) == sorted({root(f) for f in fps})
    named = {root(f): c for _, f, c in parts}
    assert all(d == named[root(f)] for d, f in got)
    assert S.dedup(docs.limit(0)).count() == 0
    unique = docs.where("doc_id < 400").dropDuplicates(["doc_id"])
    assert S.dedup(unique).count() == S.near_duplicates(unique).select("component_id").distinct().count()


def test_dedup_keeps_columns_of_any_name_and_type(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "a", "b", "c", "d", {"k": 1}, [1]), (1, text, "a", "b", "c", "d", {"k": 1}, [1]), (2, "other words stand here alone", "a", "b", "c", "d", None, None), (None, text, "x", "b", "c", "d", {}, [])]
    schema = "doc_id bigint, text string, _id string, stays_id string, rank string, own_fp string, extra map<string,int>, list array<int>"
    docs = spark.createDataFrame(rows, schema)
    got = S.dedup(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"], r["rank"], r["extra"]) for r in got.collect()) == [(1, "c", {"k": 1}), (2, "c", None)]
