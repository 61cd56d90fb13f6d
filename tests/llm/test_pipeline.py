"""The pipeline and the queries on the driver tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tidewater.llm import decontaminate, quality, simhash, toxicity
from tidewater.llm.oracle import ORACLE
from tidewater.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = db.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))


def test_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names


def test_pipeline_matches_its_stages_by_brute_force(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r["doc_id"]: r for r in documents.collect()}
    buckets, machine = toxicity.train(documents, labels)
    found = toxicity.Features(buckets)
    clean = {d: r for d, r in rows.items() if machine.score(*found.of(r["text"])) < 0.7}
    scorer, described = quality.train(documents.where(documents.doc_id.isin(list(clean))), labels), quality.Descriptions()
    good = {d: r for d, r in clean.items() if scorer.score(described.of((r["text"] or "").encode())) >= 0.3}
    fps = {d: simhash.fingerprint((r["text"] or "").encode()) for d, r in good.items()}
    label = {d: d for d in fps}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    for a in fps:
        for b in fps:
            if b < a and (fps[a] ^ fps[b]).bit_count() <= 2:
                label[max(root(a), root(b))] = min(root(a), root(b))
    single = {d for d in fps if root(d) == d}
    grams = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = decontaminate.words_of(r["text"].encode())
        grams |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(g) for g in grams}
    kept = set()
    for d in single:
        w = decontaminate.words_of((rows[d]["text"] or "").encode())
        if not any(tuple(w[i : i + n]) in grams for n in sizes for i in range(len(w) - n + 1)):
            kept.add(d)
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} == kept and kept
    used = {}
    for r in out:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= 2048


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, SF).columns == docs.columns
        assert step(spark, docs.limit(0), SF).columns == docs.columns
