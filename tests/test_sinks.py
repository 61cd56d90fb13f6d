"""Sinks and load modes: idempotence, partition pruning, key checks
(K3, K6-K15, K18, M5)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.operators import quality
from tidewater.sinks import files as fsink
from tidewater.sinks import tables as tsink


def test_text_sink_fails_when_present(spark, tmp_dir):
    df = spark.createDataFrame([("a",)], "value string")
    fsink.write_text(df, f"{tmp_dir}/t")
    with pytest.raises(Exception):
        fsink.write_text(df, f"{tmp_dir}/t")
    fsink.write_text(df, f"{tmp_dir}/t", mode="overwrite")


def test_table_modes(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS tw_sinks")
    a = spark.range(3).toDF("id")
    assert tsink.create_if_absent(a, "tw_sinks.once") is True
    assert tsink.create_if_absent(a.union(a), "tw_sinks.once") is False
    assert spark.table("tw_sinks.once").count() == 3
    tsink.replace_table(a.union(a), "tw_sinks.rep")
    tsink.replace_table(a, "tw_sinks.rep")
    assert spark.table("tw_sinks.rep").count() == 3
    tsink.save_external(a, "tw_sinks.ext", f"{tmp_dir}/ext")
    assert spark.sql("DESCRIBE TABLE EXTENDED tw_sinks.ext").where("col_name = 'Type'").first().data_type == "EXTERNAL"


def test_load_modes_are_idempotent_with_keys(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS tw_loads")
    t = "tw_loads.target"
    df = spark.range(10).toDF("k").withColumn("v", F.col("k") * 2)
    assert tsink.load(df.where("k < 5"), t, ["k", "v"]) == "full"
    assert tsink.load(df.where("k < 5"), t, ["k", "v"], mode="full") == "full"  # K10 twice: same table
    assert spark.table(t).count() == 5
    assert tsink.load(df, t, ["k", "v"], keys=["k"]) == "incremental"
    assert tsink.load(df, t, ["k", "v"], keys=["k"]) == "incremental"  # K11 rerun adds nothing
    assert spark.table(t).count() == 10
    tsink.append_incremental(df.where("k = 0"), t, ["k", "v"])  # no keys: plain append
    assert spark.table(t).count() == 11


def test_write_by_year_prunes_partitions(spark, tmp_dir):
    rows = [(i, dt.datetime(y, 6, 1)) for i, y in enumerate([2023, 2024, 2024, 2026, 2027])] + [(9, None)]
    df = spark.createDataFrame(rows, "id int, order_time timestamp_ntz")
    path = f"{tmp_dir}/by_year"
    fsink.write_by_year(df, "order_time", [2024, 2025, 2026], path)
    back = spark.read.parquet(path)
    got = {r.order_year: r["count"] for r in back.groupBy("order_year").count().collect()}
    assert got == {"2024": 2, "2026": 1, "default": 3}
    pruned = back.where(F.col("order_year") == "2024")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan and pruned.count() == 2
    # dynamic overwrite: rewriting 2024 keeps the other years
    fsink.write_by_year(df.where("id = 1"), "order_time", [2024, 2025, 2026], path)
    got = {r.order_year: r["count"] for r in spark.read.parquet(path).groupBy("order_year").count().collect()}
    assert got == {"2024": 1, "2026": 1, "default": 3}


def test_create_tables_and_skip_if_empty(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS tw_ddl")
    tsink.create_tables(spark, {"tw_ddl.a": "id BIGINT, name STRING"}, location=f"{tmp_dir}/ddl")
    assert spark.table("tw_ddl.a").columns == ["id", "name"]
    assert tsink.skip_if_empty(spark.table("tw_ddl.a")) is True


def test_key_checks(spark):
    orders = spark.createDataFrame([(1, 10), (1, 11), (2, 99), (None, 10)], "o_orderkey int, o_custkey int")
    cust = spark.createDataFrame([(10,), (11,)], "c_custkey int")
    assert quality.check_keys(orders, ["o_orderkey"]) == 3  # two repeats + one NULL key
    assert quality.check_fk(orders, cust, "o_custkey", "c_custkey") == 1


def test_fk_counts_agree_with_rows_on_a_hot_key(spark):
    # key 7 is dangling and holds most child rows; NULL keys are not orphans
    child = spark.range(0, 500).selectExpr("CASE WHEN id % 10 < 7 THEN 7 WHEN id % 10 = 7 THEN NULL ELSE id % 3 END AS k")
    parent = spark.createDataFrame([(0,), (1,)], "k bigint")
    keys = [7 if i % 10 < 7 else None if i % 10 == 7 else i % 3 for i in range(500)]
    expected: dict[int, int] = {}
    for k in keys:
        if k is not None and k not in (0, 1):
            expected[k] = expected.get(k, 0) + 1
    counts = {r.k: r.n for r in quality.fk_orphan_counts(child, parent, "k").collect()}
    assert counts == expected and expected[7] == 350
    assert quality.check_fk(child, parent, "k") == quality.fk_orphans(child, parent, "k").count() == sum(expected.values())


def test_jdbc_options():
    opts = tsink.jdbc_options("jdbc:postgresql://db/x", "orders", user="u", password="p", truncate=True, cascade=True)
    assert opts["truncate"] == "true" and opts["cascadeTruncate"] == "true" and opts["dbtable"] == "orders"


def test_bucketed_target_is_not_shuffled_by_incremental_loads(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tw_bucketed")
    t = "tw_bucketed.target"
    df = spark.range(200).toDF("k").withColumn("v", F.col("k") * 2)
    assert tsink.load(df.where("k < 100"), t, ["k", "v"], keys=["k"], buckets=4) == "full"
    assert tsink.load(df, t, ["k", "v"], keys=["k"], buckets=4) == "incremental"
    assert tsink.load(df, t, ["k", "v"], keys=["k"], buckets=4) == "incremental"
    assert sorted(r.k for r in spark.table(t).collect()) == list(range(200))
    with _no_broadcast(spark):  # the plan must not depend on a broadcast
        plan = tsink.new_rows(df, spark.table(t), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the incoming rows only


class _no_broadcast:
    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.old = self.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        self.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", self.old)
