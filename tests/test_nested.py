"""JSON, XML, arrays and structs (J1-J11, M1, M2, M8, M14 flatten)."""

from __future__ import annotations

import datetime as dt
import decimal
import json

import pytest
from pyspark.sql import functions as F

from tidewater.operators import nested as N
from tidewater.plans import delivery, documents, messages


def test_flatten_pets_edge_rows(spark):
    docs = [
        (1, json.dumps({"pets": [
            {"name": "Rex", "species": "dog", "favFoods": ["x", "y"], "birthYear": 2015, "photo": None},
            {"name": "Tom", "species": "cat"},
        ]})),
        (2, '{"pets": []}'),
        (3, "{}"),
        (4, None),
    ]
    # An object where the list should be stops the job, as it does in the job
    # this one follows; it once gave no rows.
    odd = spark.createDataFrame([(5, '{"pets": {"name": "not an array"}}')], "id int, json_data string")
    with pytest.raises(Exception, match="no array at"):
        documents.flatten_pets(odd, keep=["id"]).collect()
    df = spark.createDataFrame(docs, "id int, json_data string")
    out = documents.flatten_pets(df, keep=["id"]).orderBy("name").collect()
    assert [r.id for r in out] == [1, 1]
    rex, tom = out
    assert rex.favFoods == '["x","y"]' and rex.birthYear == "2015" and rex.photo is None
    assert tom.favFoods is None and tom.species == "cat"


FOOD_XML = (
    "<nutrition>"
    "<food><name>Avocado Dip</name><name>Second</name><mfr>Sunnydale</mfr>"
    '<serving units="g">29</serving><calories total="110" fat="100"/>'
    "<total-fat>11</total-fat><saturated-fat>3</saturated-fat><cholesterol>5</cholesterol>"
    "<sodium>210</sodium><carb>2</carb><fiber>0</fiber><protein>1</protein>"
    "<vitamins><a>0</a><c>0</c></vitamins><minerals><ca>0</ca><fe>0</fe></minerals></food>"
    '<food><name>Bagels &amp; Co</name><calories total="300"/></food>'
    "</nutrition>"
)


def test_flatten_foods(spark):
    df = spark.createDataFrame([(FOOD_XML,)], "xml_content string")
    rows = {r.name: r for r in documents.flatten_foods(df).collect()}
    a = rows["Avocado Dip"]  # first <name> wins
    assert a.serving_value == decimal.Decimal("29.0000") and a.serving_units == "g"
    assert (a.calories_total, a.calories_fat, a.sodium, a.vitamin_c) == (110, 100, 210, 0)
    b = rows["Bagels & Co"]
    assert b.calories_total == 300 and b.calories_fat is None and b.manufacturer is None


def test_flatten_foods_bad_number_raises(spark):
    bad = FOOD_XML.replace("<sodium>210</sodium>", "<sodium>lots</sodium>")
    with pytest.raises(Exception):
        documents.flatten_foods(spark.createDataFrame([(bad,)], "xml_content string")).collect()


LOAN = {
    "application_id": "loan_0000001",
    "customer": {"customer_id": "cust_1", "region": "DE-HE", "age": 30, "income": 1000.5, "employment": "employed"},
    "loan": {"amount": 5000, "term_months": 12, "purpose": "auto", "currency": "EUR"},
    "scoring": {"score": 700, "risk_level": "low", "pd": 0.01, "lgd": 0.5},
    "documents": [{"type": "passport", "status": "verified"}],
    "decision_status": "approved",
    "submitted_at": "2026-01-01T00:00:00Z",
    "notes": "n",
}


def test_loan_flatten_edge_rows(spark):
    no_loan = dict(LOAN)
    no_loan.pop("loan")
    rows = [(json.dumps(LOAN),), (None,), ("not json",), (json.dumps(no_loan),)]
    df = spark.createDataFrame(rows, "value string")
    vals = messages.message_values(df)
    flat = messages.flat_messages(spark, vals, view="loan_messages")
    assert flat.columns == [name for name, _ in messages.LOAN_PATHS]
    out = flat.collect()
    assert len(out) == 3  # NULL payload dropped
    full = [r for r in out if r.application_id == "loan_0000001" and r.loan_amount][0]
    assert (full.income, full.loan_amount, full.pd, full.submitted_at) == ("1000.5", "5000", "0.01", "2026-01-01T00:00:00Z")
    junk = [r for r in out if r.application_id is None][0]
    assert all(v is None for v in junk)
    missing = [r for r in out if r.application_id == "loan_0000001" and r.loan_amount is None][0]
    assert [missing.loan_amount, missing.term_months, missing.loan_purpose, missing.currency] == [None] * 4


def test_flatten_parse_once_equals_per_path(spark):
    docs = [(json.dumps(LOAN),), ('{"customer": "flat", "loan": {"amount": 1.50}}',), ("[1,2]",)]
    df = spark.createDataFrame(docs, "value string")
    paths = dict(messages.LOAN_PATHS)
    once = N.flatten_json(df, "value", paths).collect()
    each = df.select(*[F.get_json_object("value", p).alias(n) for n, p in paths.items()]).collect()
    assert [tuple(r) for r in once] == [tuple(r) for r in each]


def test_flat_sql_parse_once_equals_per_path(spark):
    docs = [
        (json.dumps(LOAN),),
        ('{"customer": "flat", "loan": {"amount": 1.50, "term_months": null}}',),
        ('{"application_id": {"nested": [1, 2.50]}, "scoring": {"pd": 1e-3, "lgd": "0.20"}}',),
        ("[1,2]",),
        ("not json",),
        ("{}",),
    ]
    view = "flat_sql_docs"
    spark.createDataFrame(docs, "value string").createOrReplaceTempView(view)
    once = spark.sql(messages.flat_sql(view)).collect()
    each = spark.sql(f"SELECT {', '.join(f"get_json_object(value, '{p}') AS `{n}`" for n, p in messages.LOAN_PATHS)} FROM {view}").collect()
    assert [tuple(r) for r in once] == [tuple(r) for r in each]
    assert "from_json" in messages.flat_sql(view) and "get_json_object" in messages.flat_sql(view, [("x", "$.a[0]")])


def test_explode_json_parses_each_element_once_with_the_same_text(spark):
    docs = [
        ('{"pets":[{"name":"a","favFoods":["x", "y"],"birthYear":2001,"photo":null},"just text",7,{"name":{"n":1.50}},{}]}',),
        ('{"pets":[{"name":"first","name":"last"}]}',),
    ]
    df = spark.createDataFrame(docs, "json_data string")
    once = N.explode_json(df, "json_data", "$.pets", ["name", "favFoods", "birthYear", "photo"]).collect()
    elems = df.select(F.explode(F.from_json(F.get_json_object("json_data", "$.pets"), "array<string>")).alias("e"))
    each = elems.select(*[F.get_json_object("e", f"$.{k}").alias(k) for k in ["name", "favFoods", "birthYear", "photo"]]).collect()
    assert [tuple(r) for r in once[:5]] == [tuple(r) for r in each[:5]]
    assert tuple(once[0]) == ("a", '["x","y"]', "2001", None)
    # a repeated key keeps its last value, as a jsonb column does
    assert once[5].name == "last"


def test_json_get_and_text(spark):
    df = spark.createDataFrame([('{"a": {"b": [1, 2]}, "c": null}',)], "j string")
    r = df.select(N.json_get("j", "$.a"), N.json_text("j", "c"), N.json_text("j", "zz")).first()
    assert tuple(r) == ('{"b":[1,2]}', None, None)


def test_to_value_round_trip_keeps_microseconds(spark):
    ts = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(1, ts, "é\n\"x\"")], "id bigint, ts timestamp_ntz, s string")
    v = N.to_value(df)
    back = v.select(F.from_json("value", "id bigint, ts timestamp_ntz, s string", N.JSON_OPTIONS).alias("d")).select("d.*").first()
    assert tuple(back) == (1, ts, "é\n\"x\"")


def test_golden_text_messages(spark):
    rows = [("Test message #1 from dataproc-cluster",), ("Test message #2 from dataproc-cluster",)]
    got = sorted(r.value for r in N.to_value(spark.createDataFrame(rows, "msg string")).collect())
    assert got == [
        '{"msg":"Test message #1 from dataproc-cluster"}',
        '{"msg":"Test message #2 from dataproc-cluster"}',
    ]


def test_customer_actions(spark):
    df = spark.createDataFrame(
        [
            ("c1", [("login", "2024-01-01 10:00:00"), (None, "2024-01-02 10:00:00")]),
            ("c2", []),
            ("c3", None),
        ],
        "customer_id string, actions array<struct<action: string, timestamp: string>>",
    )
    out = delivery.customer_actions(df).orderBy("action_timestamp").collect()
    assert [(r.customer_id, r.action_type) for r in out] == [("c1", "login"), ("c1", "unknown")]
    assert out[0].action_timestamp == dt.datetime(2024, 1, 1, 10, 0) and out[0].action_id is not None


def test_pack_rows_bounds_each_document(spark):
    df = spark.createDataFrame([(1, i, f"t{i}") for i in range(10)], "k int, seq int, v string")
    packed = N.pack_rows(df, ["k"], "seq", ["v"], "items", chunk=4).orderBy("part").collect()
    assert [len(r["items"]) for r in packed] == [4, 4, 2]
    assert [x["v"] for x in packed[0]["items"]] == ["t0", "t1", "t2", "t3"]


def test_text_schema_rules():
    assert N.text_schema(["$.a", "$.b.c"]).simpleString() == "struct<a:string,b:struct<c:string>>"
    assert N.text_schema(["$.a", "$.a.b"]) is None
    assert N.text_schema(["$.a[0]"]) is None
