"""Whole replacements of tables: new versions beside the old one."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap
import uuid

import pytest
from pyspark.sql import functions as F

from tidewater.sinks import publish as pub
from tidewater.sinks import tables


@pytest.fixture()
def db(spark, tmp_dir):
    name = f"publish_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_dir}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def ids(spark, table):
    return sorted(r["id"] for r in spark.table(table).select("id").collect())


def spoilt(spark, n=50):
    """Fails in its last rows, after others were written."""
    return spark.range(0, n, 1, 3).select(F.when(F.col("id") >= n - 1, F.raise_error(F.lit("spoilt")).cast("bigint")).otherwise(F.col("id")).alias("id"))


REBUILDS = {
    "replace": lambda df, t, path: tables.replace_table(df, t, path),
    "external": lambda df, t, path: tables.save_external(df, t, path or f"/nowhere/{t}"),
    "refresh": lambda df, t, path: tables.full_refresh(df, t, ["id"], path),
    "bucketed": lambda df, t, path: tables.full_refresh(df, t, ["id"], path, 4, ["id"]),
    "replicate": lambda df, t, path: tables.replicate(df, t, path=path),
}


@pytest.mark.parametrize("mode", sorted(REBUILDS))
@pytest.mark.parametrize("external", [False, True])
def test_a_failed_rebuild_leaves_the_old_rows(spark, db, tmp_dir, mode, external):
    if mode == "external" and not external:
        pytest.skip("always has a path")
    rebuild, table = REBUILDS[mode], f"{db}.t"
    path = f"{tmp_dir}/{mode}" if external else None
    with pytest.raises(Exception, match="spoilt"):
        rebuild(spoilt(spark), table, path)
    assert not pub.table_exists(spark, table)
    assert rebuild(spark.range(10), table, path) == 10
    with pytest.raises(Exception, match="spoilt"):
        rebuild(spoilt(spark), table, path)
    assert ids(spark, table) == list(range(10))
    assert rebuild(spark.range(20), table, path) == 20
    with pytest.raises(Exception, match="spoilt"):
        rebuild(spoilt(spark), table, path)
    assert ids(spark, table) == list(range(20))
    assert [t.name for t in spark.catalog.listTables(db)] == ["t"]
    assert (spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Type'").first().data_type == "EXTERNAL") == external


def test_old_versions_go_one_publication_later(spark, db, tmp_dir):
    path = f"{tmp_dir}/versions"
    held = []
    for n in (3, 4, 5, 6):
        tables.save_external(spark.range(n), f"{db}.t", path)
        held.append(sorted(os.listdir(path)))
    assert [len(h) for h in held] == [1, 2, 2, 2] and not set(held[0]) & set(held[3])
    # A reader that began before the switch still finds its files.
    reader = spark.table(f"{db}.t").select("id")
    reader.count()
    tables.save_external(spark.range(9), f"{db}.t", path)
    assert reader.count() in (6, 9) and ids(spark, f"{db}.t") == list(range(9))


def test_a_table_may_be_rebuilt_from_itself(spark, db):
    tables.replace_table(spark.range(10), f"{db}.t")
    assert tables.replace_table(spark.table(f"{db}.t").where("id < 4"), f"{db}.t") == 4
    assert ids(spark, f"{db}.t") == [0, 1, 2, 3]


@pytest.mark.parametrize("external", [False, True])
def test_other_columns_and_buckets(spark, db, tmp_dir, external):
    path = f"{tmp_dir}/other" if external else None
    tables.replace_table(spark.range(5), f"{db}.t", path)
    tables.replace_table(spark.range(6).selectExpr("id", "id * 2 AS twice"), f"{db}.t", path)
    assert spark.table(f"{db}.t").columns == ["id", "twice"] and ids(spark, f"{db}.t") == list(range(6))
    tables.full_refresh(spark.range(7), f"{db}.t", ["id"], path, 2, ["id"])
    assert pub.layout(spark, f"{db}.t").buckets == "2" and ids(spark, f"{db}.t") == list(range(7))
    tables.replicate(spark.range(8), f"{db}.t", path=path)  # the buckets stay
    assert pub.layout(spark, f"{db}.t").buckets == "2" and ids(spark, f"{db}.t") == list(range(8))
    with pytest.raises(ValueError, match="odd"):
        pub.publish(spark.range(3), f"{db}.t", path, check=lambda rows: (_ for _ in ()).throw(ValueError("odd")))
    assert ids(spark, f"{db}.t") == list(range(8))


def test_an_empty_source_makes_an_empty_table(spark, db):
    assert tables.replace_table(spark.range(5), f"{db}.t") == 5
    assert tables.replace_table(spark.range(5).where("id > 9"), f"{db}.t") == 0
    assert ids(spark, f"{db}.t") == []


def test_only_changed_partitions_are_rewritten(spark, db):
    tables.create_tables(spark, {f"{db}.o": "id BIGINT, note STRING, order_year STRING"}, partitions={f"{db}.o": "order_year"})
    rows = spark.createDataFrame([(1, "a", "2023"), (2, "b", "2024"), (3, "c", "default"), (4, "d", None)], "id long, note string, order_year string")
    assert tables.replicate(rows, f"{db}.o") == 4

    def files(year):
        return {f for f in spark.table(f"{db}.o").inputFiles() if f"order_year={year}" in f}

    before = {y: files(y) for y in ("2023", "2024", "default")}
    batch = spark.createDataFrame([("2024", 5, "e"), ("2025", 6, "f")], "order_year string, id long, note string")
    assert pub.replace_partitions(batch, f"{db}.o") == 2
    assert ids(spark, f"{db}.o") == [1, 3, 4, 5, 6]
    assert files("2023") == before["2023"] and files("default") == before["default"] and files("2024") != before["2024"]
    bad = batch.withColumn("id", F.raise_error(F.lit("spoilt")).cast("bigint"))
    with pytest.raises(Exception, match="spoilt"):
        pub.replace_partitions(bad, f"{db}.o")
    with pytest.raises(Exception, match="spoilt"):
        tables.replicate(bad, f"{db}.o")
    assert ids(spark, f"{db}.o") == [1, 3, 4, 5, 6]
    # A whole replication drops what the source no longer has.
    assert tables.replicate(batch, f"{db}.o") == 2 and ids(spark, f"{db}.o") == [5, 6]
    with pytest.raises(ValueError, match="no partitions"):
        tables.replace_table(spark.range(1), f"{db}.plain")
        pub.replace_partitions(spark.range(1), f"{db}.plain")


def test_a_second_process_sees_the_old_rows_until_the_switch(tmp_dir):
    """One process rebuilds and fails, the next one reads and rebuilds."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": repo, "SPARK_LOCAL_DIRS": f"{tmp_dir}/local", "PYSPARK_SUBMIT_ARGS": "--master local[2] --driver-memory 1g pyspark-shell"}

    def run(body):
        head = f"""
            from pyspark.sql import functions as F
            from tidewater.session import session
            from tidewater.sinks import tables
            s = session("publish", hive=True, conf={{"spark.sql.warehouse.dir": "{tmp_dir}/warehouse"}})
            def seen(t):
                print("SEEN", t, s.table(t).count(), s.sql("DESCRIBE TABLE EXTENDED " + t).where("col_name = 'Type'").first().data_type)
            def fails(make):
                try:
                    make(s.range(40).select(F.when(F.col("id") == 39, F.raise_error(F.lit("spoilt")).cast("bigint")).otherwise(F.col("id")).alias("id")))
                except Exception as e:
                    assert "spoilt" in str(e)
                else:
                    raise SystemExit("did not fail")
        """
        code = textwrap.dedent(head) + textwrap.dedent(body)
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-3000:]
        return [line.split()[1:] for line in done.stdout.splitlines() if line.startswith("SEEN")]

    first = run(f"""
        for t, path in (("ext", "{tmp_dir}/ext"), ("own", None)):
            tables.replace_table(s.range(10), t, path)
            fails(lambda df: tables.replace_table(df, t, path))
            seen(t)
    """)
    second = run(f"""
        for t, path in (("ext", "{tmp_dir}/ext"), ("own", None)):
            seen(t)
            fails(lambda df: tables.full_refresh(df, t, ["id"], path))
            seen(t)
            tables.replace_table(s.range(25), t, path)
            tables.replace_table(s.range(30).selectExpr("id", "id AS more"), t, path)
            seen(t)
    """)
    assert first == [["ext", "10", "EXTERNAL"], ["own", "10", "MANAGED"]]
    assert [r[:2] for r in second] == [["ext", "10"], ["ext", "10"], ["ext", "30"], ["own", "10"], ["own", "10"], ["own", "30"]]
    assert [r[:2] for r in run("seen('ext'); seen('own')")] == [["ext", "30"], ["own", "30"]]
