"""Dense ids, measured JDBC splits, batches written once, increments by new
files."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewater.operators.ids import dense_ids, next_id
from tidewater.plans import messages
from tidewater.sinks import increments, tables
from tidewater.sinks.tables import jdbc_options, write_jdbc
from tidewater.sources.jdbc import quantile_queries, read_jdbc_split, split_predicates, sql_literal
from tidewater.streaming.batches import Output, drain_batches, ledger, write_batch
from tidewater.streaming.drain import file_stream

DERBY = "org.apache.derby.jdbc.EmbeddedDriver"


@pytest.fixture()
def db(spark, tmp_dir):
    name = f"increments_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_dir}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


# ------------------------------- dense ids ---------------------------------


def test_ids_are_gapless_ordered_and_go_on(spark, db):
    rows = spark.range(1000).selectExpr("id * 7919 % 1000 AS k", "if(id % 3 = 0, null, id) AS place").repartition(7)
    got = dense_ids(rows, "id", ["k"])
    assert got.columns == ["id", "k", "place"]
    assert [(r["id"], r["k"]) for r in got.orderBy("id").collect()] == [(i + 1, i) for i in range(1000)]
    assert got.collect() == got.collect()  # fixed by the written rows, not by the tasks
    tables.append_table(got, f"{db}.t")
    assert next_id(spark, f"{db}.t") == 1001 and next_id(spark, f"{db}.none") == 1
    tables.append_table(dense_ids(rows.where("k < 50"), "id", start=next_id(spark, f"{db}.t")), f"{db}.t")
    assert sorted(r["id"] for r in spark.table(f"{db}.t").collect()) == list(range(1, 1051))


def test_ids_of_empty_partitions_a_hot_key_and_no_rows(spark):
    lone = spark.range(0, 300, 1, 10).where("id < 30 or id >= 270").withColumn("k", F.lit(1))
    assert sorted(r["id_"] for r in dense_ids(lone, "id_").collect()) == list(range(1, 61))
    ordered = dense_ids(lone, "id_", ["k", F.col("id").desc()], start=0)
    assert [r["id"] for r in ordered.orderBy("id_").collect()][:3] == [299, 298, 297]
    assert dense_ids(lone.where("id < 0"), "id_").collect() == []
    with pytest.raises(ValueError, match="have a column"):
        dense_ids(lone, "ID")


# --------------------------------- JDBC ------------------------------------


@pytest.fixture()
def derby():
    return {"url": f"jdbc:derby:memory:split{uuid.uuid4().hex[:8]};create=true", "driver": DERBY}


def parts_of(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()]


def load(df, derby, name, types=None):
    options = {**jdbc_options(derby["url"], name), "driver": DERBY}
    if types:
        options["createTableColumnTypes"] = types
    write_jdbc(df, options, mode="overwrite")


def test_a_skewed_key_is_read_in_equal_parts(spark, derby):
    skewed = spark.range(1000).selectExpr("CAST(pow(id, 3) AS BIGINT) AS k", "id AS v").unionByName(spark.range(20).selectExpr("CAST(NULL AS BIGINT) AS k", "id + 1000 AS v"))
    load(skewed, derby, "SRC")
    got = read_jdbc_split(spark, {**derby, "dbtable": "SRC"}, "k", 8)
    sizes = parts_of(got)
    assert len(sizes) == 8 and max(sizes) <= 2 * min(sizes)
    assert sorted(r["v"] for r in got.collect()) == list(range(1020))
    query = read_jdbc_split(spark, {**derby, "query": 'SELECT * FROM SRC WHERE "v" >= 500'}, "k", 4)
    assert sorted(r["v"] for r in query.collect()) == list(range(500, 1020)) and len(parts_of(query)) == 4


def test_texts_times_hot_values_and_empty_tables(spark, derby):
    rows = spark.range(400).selectExpr("concat('o''', lpad(id, 4, '0')) AS s", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, id) AS t", "if(id < 300, 7, id) AS hot", "date'2024-01-01' AS same", "id AS v")
    load(rows, derby, "TEXTS", "s VARCHAR(20)")
    for column, least in (("s", 4), ("t", 4), ("hot", 2), ("same", 1)):
        got = read_jdbc_split(spark, {**derby, "dbtable": "TEXTS"}, column, 4)
        assert sorted(r["v"] for r in got.collect()) == list(range(400))
        sizes = parts_of(got)
        assert len(sizes) >= least and sum(sizes) == 400
    load(rows.limit(0), derby, "EMPTY_ROWS", "s VARCHAR(20)")
    assert read_jdbc_split(spark, {**derby, "dbtable": "EMPTY_ROWS"}, "s", 4).collect() == []


def test_split_conditions_and_queries():
    assert split_predicates("k", []) == ["1 = 1"]
    assert split_predicates("k", [3, 3, 9]) == ["k < 3 OR k IS NULL", "k >= 3 AND k < 9", "k >= 9"]
    assert [sql_literal(x) for x in (Decimal("1.50"), "o'x", dt.date(2024, 1, 2), 1.5)] == ["1.50", "'o''x'", "'2024-01-02'", "1.5"]
    with pytest.raises(TypeError):
        sql_literal(None)
    (one,) = quantile_queries("jdbc:postgresql://h/d", "t", "k", 100, 4)
    assert "percentile_disc(ARRAY[0.25, 0.5, 0.75])" in one
    assert len(quantile_queries("jdbc:derby:x", "t", "k", 100, 4)) == 3


# ------------------------------ batch ledger -------------------------------


def put(spark, folder, name, values):
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def stream(spark, folder):
    return file_stream(spark, f"{folder}/*", "value string", max_files=1)


def test_a_replayed_batch_adds_nothing_and_a_rerun_only_what_is_new(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/src", Output(f"{tmp_dir}/out"), f"{tmp_dir}/ckpt"
    for i in range(3):
        put(spark, src, f"f{i}", [f"{i}{c}" for c in "abc"])
    assert drain_batches(stream(spark, src), [out], ckpt) == [0, 1, 2]
    held = sorted(os.listdir(out.path))
    assert drain_batches(stream(spark, src), [out], ckpt) == [] and sorted(os.listdir(out.path)) == held
    # The commit of the last batch is lost: it comes again, and adds nothing.
    for name in os.listdir(f"{ckpt}/commits"):
        if name.strip(".").startswith("2"):
            os.remove(f"{ckpt}/commits/{name}")
    assert drain_batches(stream(spark, src), [out], ckpt) == []
    put(spark, src, "f9", ["9a"])
    assert drain_batches(stream(spark, src), [out], ckpt) == [3]
    rows = sorted(r["value"] for r in spark.read.parquet(out.path).collect())
    assert rows == sorted([f"{i}{c}" for i in range(3) for c in "abc"] + ["9a"])
    assert [(r["batch"], r["rows"]) for r in ledger(spark, out.path).orderBy("batch").collect()] == [(0, 3), (1, 3), (2, 3), (3, 1)]


def test_a_batch_without_its_ledger_entry_replaces_its_own_files(spark, tmp_dir):
    out = Output(f"{tmp_dir}/out", fmt="csv", options={"header": "true"})
    one, two = spark.createDataFrame([("a",), ("b",)], "v string"), spark.createDataFrame([("c",)], "v string")
    assert write_batch(one.repartition(2), "q", 0, out) and write_batch(two, "q", 1, out)
    os.remove(f"{out.path}/_ledger/q-000000000")
    assert write_batch(one.coalesce(1), "q", 0, out) and not write_batch(one, "q", 0, out)
    assert write_batch(two, "other", 0, out)  # another query's batch of the same number
    assert sorted(r["v"] for r in spark.read.option("header", "true").csv(out.path).collect()) == ["a", "b", "c", "c"]
    assert ledger(spark, f"{tmp_dir}/none").count() == 0


def test_the_stream_job_adds_only_new_rows_to_the_csv(spark, tmp_dir):
    src, paths = f"{tmp_dir}/src", (("a", "$.a"), ("b", "$.b.c"))
    put(spark, src, "f0", ['{"a": 1, "b": {"c": "x"}}', None])

    def job():
        view = f"v_{uuid.uuid4().hex[:6]}"
        flat = messages.run_stream_to_csv(spark, stream(spark, src), f"{tmp_dir}/csv", f"{tmp_dir}/drained", f"{tmp_dir}/ckpt", paths=paths, view=view)
        return sorted(tuple(r) for r in flat.collect()), sorted(tuple(r) for r in spark.read.option("header", "true").csv(f"{tmp_dir}/csv").collect())

    first, csv = job()
    assert first == csv == [("1", "x")]
    before = {f: os.path.getmtime(f"{tmp_dir}/csv/{f}") for f in os.listdir(f"{tmp_dir}/csv") if f.endswith(".csv")}
    put(spark, src, "f1", ['{"a": 2, "b": {"c": "y"}}'])
    second, csv = job()
    assert second == csv == [("1", "x"), ("2", "y")]
    assert all(os.path.getmtime(f"{tmp_dir}/csv/{f}") == t for f, t in before.items())


def test_a_failing_stream_raises(spark, tmp_dir):
    put(spark, f"{tmp_dir}/src", "f0", ["x"])
    fails = Output(f"{tmp_dir}/out", lambda df: df.select(F.raise_error(F.lit("spoilt")).alias("v")))
    with pytest.raises(RuntimeError, match="stream failed"):
        drain_batches(stream(spark, f"{tmp_dir}/src"), [fails], f"{tmp_dir}/ckpt")


# ------------------------- increments by new files -------------------------


def deliver(spark, folder, name, rows):
    spark.createDataFrame(rows, "k int, day date, v string").coalesce(1).write.parquet(f"{folder}/{name}")


def test_only_new_files_and_the_tail_are_read(spark, db, tmp_dir):
    src, table = f"{tmp_dir}/in", f"{db}.t"

    def day(n):
        return dt.date(2024, 1, 1) + dt.timedelta(days=n)

    seen = []

    def read(paths):
        seen.append(len([p for p in paths if p.endswith(".parquet")]))
        return spark.read.parquet(*[p for p in paths if p.endswith(".parquet")])

    def go():
        return increments.load_new_files(spark, src, read, table, ["k", "day", "v"], ["k"], "day")

    deliver(spark, src, "d0", [(i, day(i), "a") for i in range(10)] + [(0, day(0), "again"), (None, None, "n")])
    assert go() == 11 and go() == 0 and seen == [1]
    # Known keys, new keys, late new keys and one without a mark.
    deliver(spark, src, "d1", [(8, day(8), "b"), (9, day(9), "b"), (10, day(10), "b"), (77, day(3), "late"), (None, None, "m")])
    assert go() == 2 and seen == [1, 1]
    deliver(spark, src, "d2", [(77, day(3), "late again"), (11, day(11), "c")])
    assert go() == 1 and go() == 0
    assert sorted((r["k"] for r in spark.table(table).where("k is not null").collect())) == [*range(12), 77]
    assert spark.table(table).where("k is null").count() == 1
    held = spark.table(increments.ledger_name(table))
    assert {r["rows_of_load"] for r in held.collect()} == {11, 2, 1}
    # A run that failed before its ledger entry reads the files again and adds nothing.
    keep = held.where("rows_of_load <> 1")
    tables.replace_table(keep, increments.ledger_name(table))
    assert go() == 0 and seen[-1] == 1


def test_the_lowest_mark_reaches_the_scan(spark, db):
    tables.append_table(spark.range(100).selectExpr("id AS k", "id AS mark"), f"{db}.t")
    tail = increments.tail_of(spark.table(f"{db}.t"), "mark", 90)
    plan = tail._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(mark,90)" in plan and tail.count() == 10
