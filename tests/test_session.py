"""Session flags (S14, S5), in-memory rows and SQL (S12, S13), previews
(S11, K16, O4) and the JDBC sink on an in-process Derby database (K9, K10)."""

from __future__ import annotations

import uuid

import pytest

from tidewater import session as tw_session
from tidewater.session import LEGACY_PARQUET_CONF, legacy_parquet_conf, scratch_path, scratch_root
from tidewater.sinks.files import peek
from tidewater.sinks.tables import jdbc_options, replace_table, write_jdbc
from tidewater.sources.files import preview, register, rows, sql

DERBY = "org.apache.derby.jdbc.EmbeddedDriver"


def test_session_flags(spark):
    s = tw_session(conf={"spark.sql.shuffle.partitions": "4"})
    assert s is spark
    assert s.conf.get("spark.sql.adaptive.enabled") == "true"
    assert s.conf.get("spark.sql.session.timeZone") == "UTC"


def test_legacy_parquet_conf(spark):
    before = {k: spark.conf.get(k, None) for k in LEGACY_PARQUET_CONF}
    try:
        legacy_parquet_conf(spark)
        for key, value in LEGACY_PARQUET_CONF.items():
            assert spark.conf.get(key) == value
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_scratch_under_checkpoint_dir(spark):
    root = scratch_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert root == configured.rstrip("/")
    else:
        assert root == spark.sparkContext.getCheckpointDir().rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root)


def test_rows_view_and_sql(spark):
    df = rows(spark, [(1, "a"), (2, "b"), (3, None)], "id INT, name STRING")
    view = f"v_{uuid.uuid4().hex[:8]}"
    assert register(df, view) is df
    out = sql(spark, f"SELECT id FROM {view} WHERE name IS NOT NULL ORDER BY id").collect()
    assert [r.id for r in out] == [1, 2]


def test_preview_reports_missing_table_and_goes_on(spark):
    db = f"pv_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    replace_table(spark.range(30).selectExpr("id * 7 % 30 AS k"), f"{db}.t")
    shown = preview(spark, [f"{db}.missing", f"{db}.t"], n=10, order_by={f"{db}.t": ["k"]})
    assert isinstance(shown[f"{db}.missing"], Exception)
    assert [r.k for r in shown[f"{db}.t"].collect()] == list(range(10))


def test_peek_prints_schema_and_rows(spark, capsys):
    df = rows(spark, [(i, f"name{i}") for i in range(8)], "id INT, name STRING")
    peek(df, 3)
    out = capsys.readouterr().out
    assert "|-- id: integer" in out and "|-- name: string" in out
    assert "name2" in out and "name3" not in out
    assert "only showing top 3 rows" in out


@pytest.fixture()
def derby_url():
    # In-memory embedded Derby: lives inside this JVM only, no server, no port.
    return f"jdbc:derby:memory:tw{uuid.uuid4().hex[:8]};create=true"


def _read(spark, url, table):
    return spark.read.format("jdbc").options(url=url, dbtable=table, driver=DERBY).load()


def test_jdbc_append_then_truncating_refresh(spark, derby_url):
    df = spark.range(5).selectExpr("id", "CAST(id * 2 AS STRING) AS v")
    opts = {**jdbc_options(derby_url, "LOADS"), "driver": DERBY}
    write_jdbc(df, opts, mode="overwrite")
    write_jdbc(df, opts, mode="append")
    assert _read(spark, derby_url, "LOADS").count() == 10
    refresh = {**jdbc_options(derby_url, "LOADS", truncate=True), "driver": DERBY}
    write_jdbc(df.where("id < 2"), refresh, mode="overwrite")
    back = _read(spark, derby_url, "LOADS")
    assert sorted((r[0], r[1]) for r in back.select("id", "v").collect()) == [(0, "0"), (1, "2")]


def test_jdbc_partitioned_read_gets_every_row(spark, derby_url):
    from tidewater.sources import read_jdbc

    df = spark.range(0, 1000).selectExpr("id", "CAST(id % 7 AS STRING) AS v")
    write_jdbc(df, {**jdbc_options(derby_url, "SRC"), "driver": DERBY}, mode="overwrite")
    opts = {"url": derby_url, "dbtable": "SRC", "driver": DERBY}
    # bounds narrower than the data: rows outside still land in the end ranges
    back = read_jdbc(spark, opts, partition_column="id", lower=100, upper=900, num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert sorted(r[0] for r in back.select("id").collect()) == list(range(1000))
    # a pushed-down filter (Derby stores strings as CLOB, so filter on a number)
    assert read_jdbc(spark, opts).where("id >= 990").count() == 10


def test_hive_catalog_session_in_its_own_process(tmp_dir):
    # A catalog cannot be switched inside a running session, so S14 runs in
    # a fresh process; its embedded metastore lives in tmp_dir (no server).
    import os
    import subprocess
    import sys
    import textwrap

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = textwrap.dedent(f"""
        from tidewater.session import session
        from tidewater.sinks.tables import save_external
        s = session("hive-check", master="local[1]", hive=True,
                    conf={{"spark.sql.warehouse.dir": "{tmp_dir}/wh"}})
        assert s.conf.get("spark.sql.catalogImplementation") == "hive"
        save_external(s.range(3).toDF("id"), "default.hive_ext", "{tmp_dir}/ext")
        kind = s.sql("DESCRIBE TABLE EXTENDED default.hive_ext").where("col_name = 'Type'").first().data_type
        print("RESULT", kind, s.table("default.hive_ext").count())
        s.stop()
    """)
    env = {**os.environ, "PYTHONPATH": repo}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_dir, env=env, capture_output=True, text=True, timeout=300)
    assert "RESULT EXTERNAL 3" in done.stdout, done.stderr[-2000:]


def test_legacy_parquet_rules_read_old_writers_files(spark, tmp_dir):
    import datetime as dt

    import pyarrow as pa
    import pyarrow.parquet as pq

    old = pa.table({"ts": pa.array([dt.datetime(1500, 3, 1, 12, 0)], pa.timestamp("us"))})
    pq.write_table(old, f"{tmp_dir}/int96.parquet", use_deprecated_int96_timestamps=True)
    nanos = pa.table({"ts": pa.array([1_700_000_000_123_456_789], pa.timestamp("ns"))})
    pq.write_table(nanos, f"{tmp_dir}/nanos.parquet", coerce_timestamps=None, version="2.6")

    before = {k: spark.conf.get(k, None) for k in LEGACY_PARQUET_CONF}
    try:
        for key in LEGACY_PARQUET_CONF:
            spark.conf.unset(key)
        with pytest.raises(Exception):  # nanosecond timestamps are refused by default
            spark.read.parquet(f"{tmp_dir}/nanos.parquet").collect()
        # older defaults refused pre-1900 INT96 from other writers; the job
        # pins the mode instead of relying on the version's default
        spark.conf.set("spark.sql.parquet.int96RebaseModeInRead", "EXCEPTION")
        with pytest.raises(Exception):
            spark.read.parquet(f"{tmp_dir}/int96.parquet").collect()
        legacy_parquet_conf(spark)
        assert spark.read.parquet(f"{tmp_dir}/int96.parquet").first().ts.year == 1500
        assert spark.read.parquet(f"{tmp_dir}/nanos.parquet").first().ts == 1_700_000_000_123_456_789
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_jdbc_replicate_keeps_the_table_definition(spark, derby_url):
    from tidewater.sinks.tables import replicate_jdbc

    # The database owns the definition (a key and a VARCHAR size Spark would not pick).
    jvm = spark.sparkContext._jvm
    conn = jvm.java.sql.DriverManager.getConnection(derby_url)
    conn.createStatement().execute("CREATE TABLE REVIEWS (REVIEW_ID VARCHAR(20) PRIMARY KEY, RATING INT)")
    conn.close()
    opts = {"url": derby_url, "dbtable": "REVIEWS", "driver": DERBY}
    first = spark.createDataFrame([("a", "5"), ("b", "3")], "review_id string, rating string")
    replicate_jdbc(first, opts, types={"rating": "int"})
    replicate_jdbc(first.where("review_id = 'b'"), opts, types={"rating": "int"})
    back = read_jdbc_rows(spark, opts)
    assert back == [("b", 3)]
    conn = jvm.java.sql.DriverManager.getConnection(derby_url)
    meta = conn.getMetaData().getPrimaryKeys(None, None, "REVIEWS")
    assert meta.next() and meta.getString("COLUMN_NAME") == "REVIEW_ID"
    conn.close()


def read_jdbc_rows(spark, opts):
    from tidewater.sources import read_jdbc

    return sorted((r[0], r[1]) for r in read_jdbc(spark, opts).collect())


def test_scratch_needs_a_shared_folder_off_local(monkeypatch, spark):
    import importlib

    S = importlib.import_module("tidewater.session")  # the module, not the re-exported function

    monkeypatch.setattr(S, "_configured_checkpoint_dir", lambda s: None)
    monkeypatch.setattr(S, "_is_local", lambda s: False)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.scratch_root(spark)
