"""End-to-end jobs (read -> transform -> write) and the command line."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewater import submit
from tidewater.catalog import inputs as I
from tidewater.catalog.queries import QUERIES
from tidewater.plans import delivery, documents, engines, messages, passengers, weather
from tidewater.sinks import files as fsink
from tidewater.sources import files as fsrc
from tidewater.streaming import drain


def _db(spark) -> str:
    db = f"runs_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    return db


def _readings(spark, path):
    """Readings over 12 days, 'In' and 'Out', as the job's CSV layout."""
    start = dt.datetime(2024, 3, 1, 8, 0)
    rows = []
    for i in range(240):
        t = start + dt.timedelta(hours=i * 1.2)
        rows.append((f"r{i}", "Room Admin", t.strftime("%d-%m-%Y %H:%M"), float(20 + (i * 7) % 23), "In" if i % 4 else "Out"))
    df = spark.createDataFrame(rows, "id string, `room_id/id` string, noted_date string, temp double, `out/in` string")
    fsink.write_csv(df, path)
    return df


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_daily_extremes_job_appends(spark, tmp_dir):
    _readings(spark, f"{tmp_dir}/readings")
    table = f"{_db(spark)}.temperature_data"
    out = weather.run_daily_extremes(spark, f"{tmp_dir}/readings", table)
    weather.run_daily_extremes(spark, f"{tmp_dir}/readings", table)
    once = _rows(out.select(*weather.TARGET_COLUMNS))
    assert once and _rows(spark.table(table)) == sorted(once + once)


def test_full_then_incremental(spark, tmp_dir):
    src = _readings(spark, f"{tmp_dir}/readings")
    db = _db(spark)
    full, incr = f"{db}.temperature_data", f"{db}.temperature_data_incremental"
    as_of = F.lit("2024-03-12 00:00:00").cast("timestamp_ntz")
    assert weather.run_full_or_incremental(spark, f"{tmp_dir}/readings", full, incr, as_of=as_of) == "full"
    assert weather.run_full_or_incremental(spark, f"{tmp_dir}/readings", full, incr, as_of=as_of) == "incremental"
    assert _rows(spark.table(full)) == _rows(weather.daily_extremes(src))
    recent = weather.daily_extremes(src, days=3, as_of=as_of)
    assert _rows(spark.table(incr)) == _rows(recent) and recent.count() > 0


def test_engine_job_writes_external_table(spark, tmp_dir):
    readings = I.engine_readings(spark, SF_SMALL)
    fsink.write_parquet(readings.where("EngineType = 'R'").drop("Short_Term_Fuel_Trim_Bank_2_pct"), f"{tmp_dir}/engine/part=a")
    fsink.write_parquet(readings.where("EngineType != 'R'"), f"{tmp_dir}/engine/part=b")
    table = f"{_db(spark)}.engine_aggregated"
    out = engines.run_engine_profile(spark, f"{tmp_dir}/engine", table, f"{tmp_dir}/engine_processed")
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    assert detail["Type"] == "EXTERNAL"
    merged = fsrc.read_parquet(spark, f"{tmp_dir}/engine", merge_schema=True)
    assert _rows(out) == _rows(engines.engine_profile(merged))


def test_passenger_job_infers_types(spark, tmp_dir):
    rows = [(1, 1, 3, "A, Mr. B", "male", 30.0, 0, 0, "T", 60.0, None, "S"), (2, 0, 1, "C, Ms. D", "female", 12.0, 0, 0, "T", 10.0, None, "C")]
    schema = "PassengerId INT, Survived INT, Pclass INT, Name STRING, Sex STRING, Age DOUBLE, SibSp INT, Parch INT, Ticket STRING, Fare DOUBLE, Cabin STRING, Embarked STRING"
    fsink.write_csv(spark.createDataFrame(rows, schema), f"{tmp_dir}/titanic")
    out = passengers.run_passengers(spark, f"{tmp_dir}/titanic", f"{tmp_dir}/adults").collect()
    assert [(r.PassengerId, r.Name_Upper, r.Fare_Category) for r in out] == [(1, "A, MR. B", passengers.FARE_HIGH)]


def test_document_tables_created_once(spark):
    db = _db(spark)
    I.pet_documents(spark, SF_SMALL).write.saveAsTable(f"{db}.pets_src")
    I.food_documents(spark, SF_SMALL).write.saveAsTable(f"{db}.foods_src")
    assert documents.run_pets_table(spark, f"{db}.pets_src", f"{db}.pets") is True
    assert documents.run_pets_table(spark, f"{db}.pets_src", f"{db}.pets") is False
    assert documents.run_foods_table(spark, f"{db}.foods_src", f"{db}.foods") is True
    assert spark.table(f"{db}.pets").count() == documents.flatten_pets(spark.table(f"{db}.pets_src")).count()
    assert spark.table(f"{db}.foods").count() == documents.flatten_foods(spark.table(f"{db}.foods_src")).count()


def test_replication_from_json_matches_catalogue(spark, tmp_dir):
    shaped = {
        "Restaurants": I.restaurant_docs,
        "Customers": I.customer_docs,
        "DeliveryDrivers": I.driver_docs,
        "Orders": I.order_docs,
        "OrderReviews": I.review_docs,
    }
    for name, fn in shaped.items():
        fn(spark, SF_SMALL).write.json(f"{tmp_dir}/docs/{name}")
    got = delivery.run_replication(spark, f"{tmp_dir}/docs", database=_db(spark), location=f"{tmp_dir}/dwh")
    got = {r.table_name.split(".")[-1]: r.row_count for r in got.collect()}
    want = {r.table_name: r.row_count for r in QUERIES["all_loads"](spark, SF_SMALL).collect()}
    assert got == want and got["customer_actions"] > 0


def test_message_jobs_to_csv(spark, tmp_dir):
    ev = I.table(spark, SF_SMALL, "events")
    raw = ev.select(F.encode(I.event_message(ev), "UTF-8").alias("value"))
    flat = messages.run_messages_to_csv(spark, raw, f"{tmp_dir}/batch_csv", paths=I.EVENT_PATHS)
    back = fsrc.read_csv(spark, f"{tmp_dir}/batch_csv", schema=", ".join(f"`{n}` STRING" for n, _ in I.EVENT_PATHS))
    assert back.count() == ev.count() == flat.count()

    sdf = drain.file_stream(spark, SF_SMALL, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING", glob="events.parquet")
    values = sdf.select(I.event_message(sdf).alias("value"))
    messages.run_stream_to_csv(spark, values, f"{tmp_dir}/stream_csv", f"{tmp_dir}/drained", f"{tmp_dir}/ckpt", paths=I.EVENT_PATHS, view=f"m_{uuid.uuid4().hex[:6]}")
    streamed = fsrc.read_csv(spark, f"{tmp_dir}/stream_csv", schema=", ".join(f"`{n}` STRING" for n, _ in I.EVENT_PATHS))
    assert _rows(streamed) == _rows(back)


def test_command_line_runs_a_job(spark, tmp_dir, capsys):
    rows = [(1, 1, 3, "A, Mr. B", "male", 30.0, 0, 0, "T", 60.0, None, "S")]
    schema = "PassengerId INT, Survived INT, Pclass INT, Name STRING, Sex STRING, Age DOUBLE, SibSp INT, Parch INT, Ticket STRING, Fare DOUBLE, Cabin STRING, Embarked STRING"
    fsink.write_csv(spark.createDataFrame(rows, schema), f"{tmp_dir}/titanic")
    assert submit.main(["passengers", "--csv", f"{tmp_dir}/titanic", "--output", f"{tmp_dir}/adults"]) == 0
    assert '"job": "passengers"' in capsys.readouterr().out
    assert spark.read.parquet(f"{tmp_dir}/adults").count() == 1


def test_options_file_keeps_secrets_out_of_arguments(tmp_dir):
    path = f"{tmp_dir}/topic.properties"
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("# security\nkafka.security.protocol=SASL_SSL\nkafka.sasl.mechanism = SCRAM-SHA-512\n")
    assert submit._options_file(path) == {"kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "SCRAM-SHA-512"}


def test_command_line_temperature_load_full_then_incremental(spark, tmp_dir, capsys):
    src = _readings(spark, f"{tmp_dir}/readings")
    db = _db(spark)
    args = ["temperature-load", "--csv", f"{tmp_dir}/readings", "--full-table", f"{db}.full", "--incremental-table", f"{db}.incr"]
    submit.main(args)
    submit.main(args)
    out = capsys.readouterr().out
    assert '"result": "full"' in out and '"result": "incremental"' in out
    assert _rows(spark.table(f"{db}.full")) == _rows(weather.daily_extremes(src))
    # the window ends now and the readings are from 2024: nothing appended
    assert spark.table(f"{db}.incr").count() == 0
