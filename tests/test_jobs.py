"""Composed jobs on hand-made inputs: passengers (M11, golden rows),
engine profile (M12), marts (M9, M10), loads (M18)."""

from __future__ import annotations

import decimal

from pyspark.sql import functions as F

from tidewater.catalog import inputs
from tidewater.plans import delivery, engines, passengers
from tidewater.sinks import files as fsink
from tidewater.sources import files as fsrc

PASSENGER_SCHEMA = (
    "PassengerId INT, Survived INT, Pclass INT, Name STRING, Sex STRING, Age DOUBLE, SibSp INT, "
    "Parch INT, Ticket STRING, Fare DOUBLE, Cabin STRING, Embarked STRING"
)

# Golden output rows (PassengerId, Survived, Age, Fare, Embarked, labels).
GOLDEN = [
    (82, 1, 29.0, 9.5, "S", "Выжил", "Дешёвый"),
    (679, 0, 43.0, 46.9, "S", "Погиб", "Дешёвый"),
    (785, 0, 25.0, 7.05, "S", "Погиб", "Дешёвый"),
    (456, 1, 29.0, 7.8958, "C", "Выжил", "Дешёвый"),
    (546, 0, 64.0, 26.0, "S", "Погиб", "Дешёвый"),
    (818, 0, 31.0, 37.0042, "C", "Погиб", "Дешёвый"),
    (837, 0, 21.0, 8.6625, "S", "Погиб", "Дешёвый"),
    (517, 1, 34.0, 10.5, "S", "Выжил", "Дешёвый"),
    (817, 0, 23.0, 7.925, "S", "Погиб", "Дешёвый"),
    (195, 1, 44.0, 27.7208, "C", "Выжил", "Дешёвый"),
]


def passenger(pid, survived, age, fare, port, name="Someone, Mr. X"):
    return (pid, survived, 3, name, "male", age, 0, 0, "T1", fare, None, port)


def test_adults_golden_and_edges(spark, tmp_dir):
    rows = [passenger(p, s, a, f, e) for p, s, a, f, e, _, _ in GOLDEN]
    rows += [
        passenger(1, 1, 18.0, 10.0, "S"),  # age 18: dropped
        passenger(2, 1, None, 10.0, "S"),  # age NULL: dropped
        passenger(3, 1, 40.0, 50.0, "S"),  # fare 50: low
        passenger(4, 0, 40.0, 50.01, "S"),  # fare 50.01: high
        passenger(5, 0, 40.0, None, "S"),  # fare NULL: low
        passenger(6, 0, 40.0, 10.0, None),  # port NULL: dropped
        passenger(82, 1, 29.0, 9.5, "S"),  # exact repeat: one row
    ]
    # CSV in (header, inferred types), Parquet out, read back.
    csv_path = f"{tmp_dir}/passengers"
    fsink.write_csv(spark.createDataFrame(rows, PASSENGER_SCHEMA), csv_path)
    src = fsrc.read_csv(spark, csv_path)
    assert dict(src.dtypes)["PassengerId"] == "int" and dict(src.dtypes)["Fare"] == "double"
    fsink.write_parquet(passengers.adults(src), f"{tmp_dir}/out")
    out = {r.PassengerId: r for r in fsrc.read_parquet(spark, f"{tmp_dir}/out").collect()}
    assert set(out) == {p for p, *_ in GOLDEN} | {3, 4, 5}
    for pid, survived, age, fare, port, s_label, f_label in GOLDEN:
        r = out[pid]
        assert (r.Survived, r.Age, r.Fare, r.Embarked, r.Survived_Label, r.Fare_Category) == (survived, age, fare, port, s_label, f_label)
        assert r.Name_Upper == r.Name.upper()
    assert [out[i].Fare_Category for i in (3, 4, 5)] == ["Дешёвый", "Дорогой", "Дешёвый"]


ENGINE_COLS = [
    "EngineType", "Generalized_Weight", "Engine_RPM_RPM", "Vehicle_Speed_km_per_h", "MAF_g_per_sec", "log_MAF",
    "Absolute_Load_pct", "OAT_DegC", "Short_Term_Fuel_Trim_Bank_1_pct", "Long_Term_Fuel_Trim_Bank_1_pct",
]


def test_driving_modes(spark):
    cases = [
        (101.0, 61.0, "aggressive"),
        (100.0, 61.0, "mixed"),
        (60.0, 20.0, "cruising"),
        (100.0, 60.0, "cruising"),
        (29.9, None, "urban"),
        (30.0, 10.0, "mixed"),
        (120.0, None, "mixed"),
    ]
    df = spark.createDataFrame([(s, l) for s, l, _ in cases], "Vehicle_Speed_km_per_h double, Absolute_Load_pct double")
    got = [r[0] for r in df.select(engines.driving_mode()).collect()]
    assert got == [m for _, _, m in cases]


def test_engine_profile_merged_schema(spark, tmp_dir):
    # Two Parquet sets; the second has no bank 2 columns (S4 -> NULL).
    a = [("E1", 1.0, 1000.0, 50.0, 10.0, 2.3, 30.0, 20.0, 10.0, 1.0, 2.0, 3.0)]
    b = [("E1", 1.0, 3000.0, 50.0, 20.0, 3.0, 30.0, 20.0, -10.1, 1.0), ("E1", 1.0, 0.0, 50.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
         ("E1", 1.0, 10.0, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)]
    cols_a = ", ".join(f"{c} {'string' if c == 'EngineType' else 'double'}" for c in ENGINE_COLS + ["Short_Term_Fuel_Trim_Bank_2_pct", "Long_Term_Fuel_Trim_Bank_2_pct"])
    cols_b = ", ".join(f"{c} {'string' if c == 'EngineType' else 'double'}" for c in ENGINE_COLS)
    fsink.write_parquet(spark.createDataFrame(a, cols_a), f"{tmp_dir}/engine/p=1")
    fsink.write_parquet(spark.createDataFrame(b, cols_b), f"{tmp_dir}/engine/p=2")
    df = fsrc.read_parquet(spark, f"{tmp_dir}/engine", merge_schema=True)
    out = engines.engine_profile(df).collect()
    assert len(out) == 1
    r = out[0]
    # 50 km/h is neither urban (< 30) nor cruising (60-100): mixed
    assert (r.driving_mode, r.record_count, r.avg_rpm, r.max_rpm) == ("mixed", 2, 2000.0, 3000.0)
    assert r.avg_stft_b2 == 2.0 and r.fuel_trim_anomaly_count == 1
    assert r.avg_fuel_consumption_proxy == 30.0


def orders(spark, rows):
    return spark.createDataFrame(
        [(f"o{i}", c, r, decimal.Decimal(a) if a is not None else None, s) for i, (c, r, a, s) in enumerate(rows)],
        "order_id string, customer_id string, restaurant_id string, order_amount decimal(18,2), status string",
    ).withColumn("order_time", F.lit("2024-05-01 00:00:00").cast("timestamp_ntz"))


def test_marts(spark):
    df = orders(spark, [
        ("c1", "r1", "10.00", "Доставлен"),
        ("c1", "r1", "20.00", "Доставлен"),
        ("c2", "r1", "5.00", "Отменен"),
        ("c2", "r2", "0", "Доставлен"),
    ])
    perf = {r.restaurant_id: r for r in delivery.restaurant_performance(df).collect()}
    assert (perf["r1"].total_orders, perf["r1"].successful_orders, perf["r1"].total_revenue) == (3, 2, decimal.Decimal("35.00"))
    assert "r2" not in perf
    act = {r.customer_id: r for r in delivery.customer_activity(df).collect()}
    assert (act["c1"].total_orders, act["c1"].total_spent, act["c1"].avg_check) == (2, decimal.Decimal("30.00"), 15.0)


def test_marts_of_totals_beyond_the_amounts_digits(spark):
    """All orders without a customer share one key, so its total outgrows
    the 20 digits that an amount has before the point."""
    big, odd = "99999999999999999999.500000000000000001", "0.000000004"
    df = orders(spark, [("unknown", "r1", None, "x")]).drop("order_amount").crossJoin(spark.range(3000))
    df = df.withColumn("order_amount", F.when(F.col("id") < 2000, F.lit(big)).otherwise(F.lit(odd)).cast("decimal(38,18)"))
    with decimal.localcontext(prec=60):
        total = 2000 * decimal.Decimal(big) + 1000 * decimal.Decimal(odd)
        spent, mean = total.quantize(decimal.Decimal("1e-8")), (total / 3000).quantize(decimal.Decimal("1e-6"))
    (act,), (perf,) = delivery.customer_activity(df).collect(), delivery.restaurant_performance(df).collect()
    assert (act.total_orders, act.total_spent, act.avg_check) == (3000, spent, mean)
    assert (perf.total_orders, perf.total_revenue) == (3000, spent)


def test_restaurant_documents_of_any_key(spark, tmp_dir):
    """A rating between two hundredths goes up, as in the SQL; keys may be
    greater than an int."""
    rows = [(561, "a", 1, 1430.0), (10**10, "b", 2, 1000.0), (None, "c", 3, None)]
    spark.createDataFrame(rows, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_dir}/supplier.parquet")
    got = {r.restaurant_id: r for r in inputs.restaurant_docs(spark, tmp_dir).collect()}
    assert {k: r.rating for k, r in got.items()} == {"561": "3.22", str(10**10): "3.00", None: None}
    assert got["561"].created_at == "2024-01-01 09:21:00" and got[str(10**10)].created_at is not None


def test_load_all_and_empty_collection(spark, tmp_dir):
    db = "tw_test_loads"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    o = spark.createDataFrame(
        [("o1", "c1", "r1", "d1", "12.5", "Доставлен", "2024-02-01 10:00:00"), ("o2", "Unknown", "r1", "d1", "3", "x", "2024-02-01 10:00:00")],
        "order_id string, customer_id string, restaurant_id string, driver_id string, order_amount string, status string, order_time string",
    )
    c = spark.createDataFrame(
        [("c1", "Ann", [("login", "2024-01-01 00:00:00")])],
        "customer_id string, name string, actions array<struct<action: string, timestamp: string>>",
    )
    empty = spark.createDataFrame([], "restaurant_id string, name string")
    tables = {f"{db}.{k}": v for k, v in delivery.TARGET_TABLES.items()}
    counts = delivery.load_all(
        spark,
        [
            delivery.Collection(empty, f"{db}.restaurants", key="restaurant_id"),
            delivery.Collection(c, f"{db}.customers", key="customer_id"),
            delivery.Collection(o, f"{db}.orders", key="order_id"),
        ],
        customers_table=f"{db}.customers",
        actions_table=f"{db}.customer_actions",
        orders_table=f"{db}.orders",
        marts=(f"{db}.mart_a", f"{db}.mart_b"),
        location=f"{tmp_dir}/dwh",
        tables=tables,
    )
    got = {r.table_name.split(".")[-1]: r.row_count for r in counts.collect()}
    assert got == {"restaurants": 0, "customers": 1, "customer_actions": 1, "orders": 1, "mart_a": 1, "mart_b": 1}


def test_load_all_raises_a_failed_load_after_the_others_finish(spark, tmp_dir):
    import pytest

    db = "tw_test_failing_loads"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    good = spark.createDataFrame([("r1", "Cafe")], "restaurant_id string, name string")
    bad = spark.range(3).select(F.raise_error(F.lit("broken source")).cast("string").alias("driver_id"))
    tables = {f"{db}.{k}": v for k, v in delivery.TARGET_TABLES.items()}
    with pytest.raises(Exception, match="broken source"):
        delivery.load_all(
            spark,
            [delivery.Collection(bad, f"{db}.delivery_drivers"), delivery.Collection(good, f"{db}.restaurants", key="restaurant_id")],
            customers_table=None,
            actions_table=f"{db}.customer_actions",
            orders_table=f"{db}.orders",
            marts=(f"{db}.mart_a", f"{db}.mart_b"),
            location=f"{tmp_dir}/dwh",
            tables=tables,
        )
    assert [r.name for r in spark.table(f"{db}.restaurants").collect()] == ["Cafe"]
