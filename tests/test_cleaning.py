"""Cleaning operators and the collection clean-up (P*, M6, M7) on the
edge rows of the delivery documents."""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import functions as F

from tidewater.operators import cleaning as C
from tidewater.plans import delivery


def test_clean_collection_edge_rows(spark):
    rows = [
        ("o1", "c1", "r1", "10.50", "Доставлен"),
        ("o2", "c2", "r1", "0", "x"),
        ("o3", "c3", "r1", "-1", "x"),
        ("o4", "c4", "r1", None, "x"),
        ("o5", "c5", "r1", "NaN", "x"),
        ("o6", "c6", "r1", "abc", "x"),
        ("o7", None, "r1", "5", "x"),
        ("o8", "", "r1", "5", "x"),
        ("o9", "Unknown", "r1", "5", "x"),
        ("o10", "NULL", "r1", "5", "x"),
        ("o11", "none", "r1", "5", "x"),
        ("o12", "nan", "r1", "5", "x"),
        ("o13", " unknown ", "r1", "5", None),
    ]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, restaurant_id string, order_amount string, status string")
    out = {r["order_id"]: r for r in C.clean_collection(df, key="order_id").collect()}
    assert set(out) == {"o1", "o13"}
    assert out["o1"]["order_amount"] == decimal.Decimal("10.50")
    assert out["o13"]["status"] == "unknown"  # text fill
    assert out["o13"]["customer_id"] == " unknown "  # no trim


def test_nan_double_amount_dropped(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0), (3, None)], "id int, order_amount double")
    assert [r.id for r in C.keep_positive_if_present(df, "order_amount").collect()] == [2]
    # absent column: step skipped
    assert C.keep_positive_if_present(df.drop("order_amount"), "order_amount").count() == 3


def test_fill_text_leaves_numbers_null(spark):
    df = spark.createDataFrame([(None, None)], "name string, rating decimal(18,2)")
    r = C.fill_text(df).first()
    assert r.name == "unknown" and r.rating is None


def test_dedup_keep_first_is_ordered(spark):
    df = spark.createDataFrame([("k", 2, "late"), ("k", 1, "early"), ("j", 5, "only")], "k string, v int, s string")
    out = {r.k: r.s for r in C.dedup_keep_first(df, ["k"], ["v"]).collect()}
    assert out == {"k": "early", "j": "only"}


def test_dedup_ties_pick_the_same_row_in_any_order(spark):
    rows = [("k", 1, "b"), ("k", 1, "a"), ("k", 1, "c"), ("j", 2, "z")]
    picks = set()
    for parts in (1, 3):
        for perm in (rows, rows[::-1]):
            df = spark.createDataFrame(perm, "k string, v int, s string").repartition(parts)
            picks.add(tuple(sorted((r.k, r.s) for r in C.dedup_keep_first(df, ["k"], ["v"]).collect())))
    assert len(picks) == 1 and {k for k, _ in next(iter(picks))} == {"j", "k"}
    # a map column cannot be hashed: still one row per key
    m = spark.createDataFrame([("k", {"a": 1}), ("k", {"b": 2})], "k string, m map<string,int>")
    assert C.dedup_keep_first(m, ["k"], ["k"]).count() == 1


def test_full_row_dedup_and_drop_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, y string")
    assert C.dedup_rows(df).count() == 2
    assert C.drop_nulls(df, ["y", "absent"]).count() == 2


def test_drop_array_columns_by_schema(spark):
    df = spark.createDataFrame([(1, [1, 2], None)], "a int, b array<int>, c array<string>")
    assert C.drop_array_columns(df).columns == ["a"]


def test_present_rename_drop(spark):
    df = spark.createDataFrame([(1, "In")], "`noted_date` int, `out/in` string")
    assert C.present(df, ["OUT/IN", "zzz"]) == ["out/in"]
    assert C.rename(df, {"out/in": "out_in"}).columns == ["noted_date", "out_in"]
    assert C.drop_if_present(df, ["zzz", "noted_date"]).columns == ["out/in"]


def test_since_window(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2018, 1, 1),), (dt.datetime(2024, 1, 9),)], "ts timestamp_ntz"
    )
    as_of = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    assert C.since(df, "ts", 3, as_of).count() == 1


def test_type_by_name_and_ids(spark):
    df = spark.createDataFrame(
        [(("0123456789abcdef01234567",), "c1", "2024-01-02 03:04:05", "bad", "12.5", "4")],
        "_id struct<`$oid`: string>, customer_id string, created_at string, registered_at string, order_amount string, rating string",
    )
    out = delivery.prepare_collection(df, key="customer_id", types={"rating": "int"})
    r = out.first()
    assert "_id" not in out.columns
    assert r.created_at == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert r.registered_at is None  # '_at' suffix typed, bad text -> NULL
    assert r.order_amount == decimal.Decimal("12.50")
    assert r.rating == 4
