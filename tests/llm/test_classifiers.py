"""Toxicity and quality: learning, held-out rows, gradients, odd inputs."""

from __future__ import annotations

import pickle
import tracemalloc

import numpy as np
import pytest

from tidewater.llm import quality as Q
from tidewater.llm import queries, toxicity as T
from tidewater.llm.labelled import sample

SF = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones + 1) / 2) / ones / (len(label) - ones)


@pytest.mark.parametrize(("query", "label", "least"), [("op8_toxicity", "toxic", 0.75), ("op10_quality", "quality", 0.95)])
def test_held_out_rows_are_ranked_well(spark, query, label, least):
    got = queries.QUERIES[query](spark, SF)
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").select("score", "predicted", label).toPandas()
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert auc(rows["score"].to_numpy(), rows[label].to_numpy()) >= least
    assert rows["score"].between(0, 1).all()


def test_pairs_are_learnt_that_no_linear_weights_can_show():
    draw = np.random.default_rng(0)
    rows, labels = [], []
    for _ in range(3000):  # label 1 only if the features 0 and 1 agree
        a, b = draw.integers(0, 2, 2)
        rows.append((np.array([0 + a, 2 + b, 4 + draw.integers(0, 6)]), np.ones(3)))
        labels.append(float(a == b))
    machine = T.FactorizationMachine(10, 0.5)
    machine.fit(rows, np.array(labels), epochs=60)
    scores = np.array([machine.score(*r) for r in rows])
    assert auc(scores, np.array(labels)) > 0.99


def test_a_pair_of_neutral_words_is_learnt_from_texts(spark):
    draw = np.random.default_rng(4)
    noise = [f"{a}{b}{c}" for a in "bcdfgh" for b in "aeiou" for c in "klmnpr"]
    rows = []
    for i in range(1600):  # toxic only if both words or neither are there
        a, b = draw.integers(0, 2, 2)
        words = [*draw.choice(noise, 12), *["zork"] * a, *["quum"] * b]
        rows.append((i, " ".join(draw.permutation(words)), int(a == b)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    model = T.train(docs, labels, labels["doc_id"] < 1200)
    got = T.score(docs.where("doc_id >= 1200"), model).join(labels, "doc_id").toPandas()
    assert auc(got["score"].to_numpy(), got["toxic"].to_numpy()) > 0.95


def test_a_pair_of_ten_training_documents_is_learnt(spark):
    """Both words are common in clean texts; only together they are toxic."""
    draw = np.random.default_rng(8)
    noise = [f"{a}{b}{c}" for a in "bcdfgh" for b in "aeiou" for c in "klmnpr"]
    rows = []
    for i in range(640):
        own = ["zork", "quum"] if i < 20 else [[], ["zork"], ["quum"]][i % 3] if i < 260 else []
        rows.append((i, " ".join(draw.permutation([*draw.choice(noise, 12), *own])), int(i < 20 or i >= 600)))
    rows = [(i, t if i < 600 else t + " vile", k) for i, t, k in rows]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    model = T.train(docs, labels, labels["doc_id"] % 2 == 0)
    assert set(T.buckets_of(b"zork") + T.buckets_of(b"quum")) <= set(model[0].tolist())
    got = {r["doc_id"]: r["score"] for r in T.score(docs, model).collect()}
    assert min(got[i] for i in range(1, 20, 2)) > max(got[i] for i in range(21, 260, 2))


def plain_words(text):
    out, word = [], ""
    for c in (text or "").lower():
        if "a" <= c <= "z" or ord(c) >= 128:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out + [word] * bool(word)


def test_scores_are_those_of_a_plain_machine(spark, monkeypatch):
    """Term by term, pair by pair, whatever the parts the texts come in."""
    draw = np.random.default_rng(11)
    texts = [None, "", " .,! ", "Éclair naïve ÉCLAIR", "a" * 700 + " " + "b" * 3, "die" * 50, "\x00zero \ud800"[:6]]
    texts += [" ".join(draw.choice(["one", "Two", "threefold", "Ünïcode", "fivefold", "x9y", "sixfold,", "七八九十百"], draw.integers(1, 60))) for _ in range(40)]
    every = sorted({b for t in texts for w in plain_words(t) for b in T.buckets_of(w.encode())})
    buckets = np.array(every[::2])
    machine = T.FactorizationMachine(2 * len(buckets), 0.3, paired=draw.random(2 * len(buckets)) < 0.6)
    machine.weight[:] = draw.normal(0, 0.2, len(machine.weight))
    machine.factor[:] = draw.normal(0, 0.3, machine.factor.shape)
    number = {int(b): i for i, b in enumerate(buckets)}
    want = []
    for text in texts:
        words, count = plain_words(text), {}
        for w in words:
            for b in T.buckets_of(w.encode()):
                if b in number:
                    count[number[b]] = count.get(number[b], 0) + 1
        value = {n: 1.0 for n in count} | {n + len(buckets): min(1.0, T.SHARE_SCALE * c / len(words)) for n, c in count.items()}
        margin, names = machine.bias + sum(machine.weight[n] * v for n, v in value.items()), [n for n in value if machine.slot[n] >= 0]
        for i, a in enumerate(names):
            for b in names[:i]:
                margin += value[a] * value[b] * float(machine.factor[machine.slot[a]] @ machine.factor[machine.slot[b]])
        want.append(1 / (1 + np.exp(-np.clip(margin, -40, 40))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for part in (T._PART, 64):
        monkeypatch.setattr(T, "_PART", part)
        got = T.score(docs, (buckets, machine)).orderBy("doc_id").collect() if part > 64 else None
        found = T.Features(buckets)
        alone = [machine.score(*found.of(t)) for t in texts]
        assert np.allclose(alone, want, atol=1e-9)
        if got:
            assert np.allclose([r["score"] for r in got], want, atol=1e-9)
            assert [r["predicted"] for r in got] == [int(s >= T.THRESHOLD) for s in want]


def test_terms_are_words_and_prefixes_of_letters():
    assert len(T.buckets_of(b"abc")) == 1 and len(T.buckets_of(b"abcdefg")) == 4
    assert T.buckets_of("ünïcö".encode())[1] == T.buckets_of("ünïcxyz".encode())[1] and len(T.buckets_of("ünïcö".encode())) == 2
    text, bucket, count, words = T.term_counts(["Bad bad, good", None, "bad"])
    assert words.tolist() == [3, 0, 1] and count[bucket == T.buckets_of(b"bad")[0]].tolist() == [2, 1] and set(text.tolist()) == {0, 2}


def test_pairs_are_counted_as_by_brute_force(monkeypatch):
    monkeypatch.setattr(T, "LEAST_PAIR", 4.0)
    monkeypatch.setattr(T, "_PORTION", 50)
    draw = np.random.default_rng(9)
    held = draw.random((120, 14)) < draw.uniform(0.1, 0.7, 14)
    held[:, 13] = held[:, 2]  # of the same documents
    labels = (held[:, 0] ^ held[:, 1]).astype(int)
    made = T.Pairs([np.flatnonzero(h).astype(np.int32) for h in held], labels, 14)
    pairs = pickle.loads(pickle.dumps(made))
    pairs.number = made.number
    got = {(k, int(o)) for k in range(pairs.size) for o in pairs.found(k)}
    want = set()
    for a in range(13):
        for b in range(a):
            both, one, other = held[:, a] & held[:, b], held[:, a] & ~held[:, b], held[:, b] & ~held[:, a]
            ratio = [T._likelihood_ratio(*(np.array([f(m)]) for m in (both, x) for f in (lambda m: labels[m].sum(), np.sum)))[0] for x in (one, other)]
            if both.sum() >= T.PAIR_DOCS and min(ratio) >= made.least():
                want.add(tuple(sorted((int(pairs.number[a]), int(pairs.number[b])))))
    assert got == want and tuple(sorted(pairs.number[:2].tolist())) in got and pairs.number[13] == pairs.number[2]


def test_a_task_indexes_only_its_own_buckets(monkeypatch):
    monkeypatch.setattr(T, "LEAST_PAIR", 4.0)
    monkeypatch.setattr(T, "_PORTION", 1 << 12)
    draw = np.random.default_rng(4)
    held = [np.sort(draw.choice(3000, n, False)).astype(np.int32) for n in draw.integers(0, 600, 300)]
    held[7] = held[8] = held[7][:0]
    made = T.Pairs(held, draw.integers(0, 2, 300), 3000)
    packed, size = pickle.dumps(made), len(made.at)
    made.take(0)
    want = [made.found(k).tolist() for k in range(made.size)]
    got, places = {}, 0
    for task in range(8):
        tracemalloc.start()
        pairs = pickle.loads(packed)
        pairs.take(task, 8)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        # The documents' buckets, packed and not, and an eighth of the places.
        assert most < 12 * size
        places += len(pairs.place)
        got |= {k: pairs.found(k).tolist() for k in range(task, pairs.size, 8)}
    assert places == size and [got[k] for k in range(made.size)] == want
    assert made.n.tolist() == np.bincount(made.at, minlength=made.size).tolist()
    wide = T.Pairs(held, made.labels, 70_000)
    wide.at, wide.size = wide.at.astype(np.int32) + 66_000, 70_000  # numbers over 65,535
    assert (pickle.loads(pickle.dumps(wide)).at == wide.at).all()


def test_rare_cues_of_a_small_balanced_sample_are_features(spark):
    rows = [(i, f"common words here {'vileness' if i in (1, 3, 5) else 'other'}", i % 2) for i in range(24)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    buckets, machine = T.train(docs, labels)
    assert set(T.buckets_of(b"vileness")) <= set(buckets.tolist())
    found = T.Features(buckets)
    assert machine.score(*found.of("vileness common")) > machine.score(*found.of("other common"))


def test_attention_finds_the_one_bad_passage():
    draw = np.random.default_rng(1)
    bags, labels = [], []
    for i in range(400):
        bag = draw.normal(0, 1, (draw.integers(3, 20), Q.Descriptions.size))
        if i % 2:
            bag[draw.integers(0, len(bag)), :3] += 6
        bags.append(bag)
        labels.append(float(i % 2 == 0))
    scorer = Q.AttentionScorer(0.5)
    scorer.fit(bags, np.array(labels), epochs=40)
    scores = np.array([scorer.score(iter([b])) for b in bags])
    assert auc(scores, np.array(labels)) > 0.97
    # Passages in portions give the same attention as all at once.
    assert scorer.score(iter([bags[0][:2], bags[0][2:]])) == pytest.approx(scorer.score(iter([bags[0]])))


def test_descriptions_cover_whole_texts_and_survive_a_full_memory(monkeypatch):
    text = (" ".join(f"W{i}x%{'!' * (i % 7)}" for i in range(5000))).encode()
    whole = np.concatenate(list(Q.Descriptions().of(text)))
    assert len(whole) == round(5000 / Q.PASSAGE)
    monkeypatch.setattr(Q, "_CACHE", 40)
    small = Q.Descriptions()
    monkeypatch.setattr(Q, "PORTION", 64)
    assert np.concatenate(list(small.of(b"a b c"))).shape == (1, Q.Descriptions.size)
    assert np.concatenate(list(Q.Descriptions().of(None))).shape == (1, Q.Descriptions.size)


@pytest.mark.parametrize(("module", "label"), [(T, "toxic"), (Q, "quality")])
def test_odd_inputs(spark, module, label):
    docs = spark.createDataFrame([(1, "fine words here", "x"), (1, "fine words here", "x"), (2, None, "y"), (None, "", "z"), (3, "idiot " * 40_000, "w")], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], f"doc_id bigint, {label} int")
    model = module.train(docs, labels)  # label 1 only: every score is its share
    rows = module.score(docs, model).collect()
    assert len(rows) == 5 and len({r["score"] for r in rows}) == 1 and rows[0]["score"] > 0.5
    none = module.train(docs.limit(0), labels.limit(0))
    assert {r["score"] for r in module.score(docs, none).collect()} == {0.5}
    assert module.score(docs.limit(0), none).count() == 0
    keep = module.keep_clean if module is T else module.keep_good
    assert keep(docs, labels.where("false")).columns == docs.columns


def test_the_sample_is_bounded_and_keeps_out_rows(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    labels = spark.range(5000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    got = sample(docs, labels, "toxic", labels["doc_id"] % 5 != 0, 500)
    texts = [r["text"] for r in got.collect()]
    assert 380 <= len(texts) <= 620 and all(int(t[1:]) % 5 for t in texts)


def test_a_repeated_labelled_id_is_one_row_of_the_sample(spark):
    docs = spark.range(900).selectExpr("if(id < 600, 7, id) AS doc_id", "concat('t', id) AS text")
    labels = spark.range(900).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    got = sample(docs, labels, "toxic", labels["doc_id"] >= 0, 1000).collect()
    assert len(got) == 301 and sum(int(r["text"][1:]) < 600 for r in got) == 1
