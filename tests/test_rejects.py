"""Input that cannot be read as declared: it raises, or is listed with its
reason; it never turns into NULLs and no row goes missing."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest

from tidewater.operators import nested
from tidewater.plans import delivery, weather
from tidewater.sources import files

HEADER = "id,temp,when,note\n"
LAYOUT = "note STRING, temp DOUBLE, when DATE, id INT"


def write(folder, name, text):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as out:
        out.write(text)
    return folder


@pytest.mark.parametrize(
    ("line", "reason"),
    [
        ("2,abc,2024-01-02,x", "temp is not double: abc"),
        ("x,1,2024-01-02,x", "id is not int: x"),
        ("5,,2024-13-02,x", "when is not date: 2024-13-02"),
        ("3,1.0,2024-01-02,x,extra", "more cells than the header"),
        ("8,3,2024-01-02,x,", "more cells than the header"),
        ('9,3,2024-01-02,"a, b",c', "more cells than the header"),
        ("11,q", "temp is not double: q"),
    ],
)
def test_a_bad_csv_row_raises_or_is_rejected(spark, tmp_dir, line, reason):
    write(tmp_dir, "a.csv", HEADER + "1,2.5,2024-01-02,ok\n" + line + "\n7,,,\n")
    with pytest.raises(Exception, match=r"bad row \("):
        files.read_csv_by_name(spark, tmp_dir, LAYOUT).select("note").collect()
    with pytest.raises(Exception, match=r"bad row \("):
        files.read_csv_by_name(spark, tmp_dir, LAYOUT).count()
    good = files.read_csv_by_name(spark, tmp_dir, LAYOUT, bad="reject")
    assert good.columns == ["note", "temp", "when", "id"]
    assert sorted(r["id"] for r in good.collect()) == [1, 7] and good.count() == 2
    (rejected,) = files.rejected_csv(spark, tmp_dir, LAYOUT).collect()
    assert (rejected["line"], rejected["reason"]) == (line, reason) and rejected["file"].endswith("a.csv")


def test_good_csv_rows_of_all_kinds_stay(spark, tmp_dir):
    rows = '1,2.5,2024-01-02,"a, ""b"", c"\n4,1.0\n9,"1.5","2024-01-03",\n10\n\n12,,,"two ""words"""\n'
    write(tmp_dir, "a.csv", HEADER + rows)
    got = {r["id"]: (r["temp"], r["when"], r["note"]) for r in files.read_csv_by_name(spark, tmp_dir, LAYOUT).collect()}
    assert got == {
        1: (2.5, dt.date(2024, 1, 2), 'a, "b", c'), 4: (1.0, None, None), 9: (1.5, dt.date(2024, 1, 3), None),
        10: (None, None, None), 12: (None, None, 'two "words"'),
    }
    assert files.rejected_csv(spark, tmp_dir, LAYOUT).isEmpty()


def test_other_separators_and_a_clashing_name(spark, tmp_dir):
    write(tmp_dir, "a.csv", "raw_line;n\na;1\nb;x\nc;2;3\n'd;e';4\n")
    options = {"sep": ";", "quote": "'", "escape": "\\"}
    good = files.read_csv_by_name(spark, tmp_dir, "n INT, raw_line STRING", bad="reject", **options)
    assert sorted(map(tuple, good.collect())) == [(1, "a"), (4, "d;e")]
    why = files.rejected_csv(spark, tmp_dir, "n INT, raw_line STRING", **options)
    assert sorted(r["reason"] for r in why.collect()) == ["more cells than the header", "n is not int: x"]
    with pytest.raises(ValueError, match="must be"):
        files.read_csv_by_name(spark, tmp_dir, "n INT", bad="drop", **options)


def test_broken_documents_raise_or_are_rejected(spark, tmp_dir):
    lines = ['{"a":1,"b":{"c":"x"}}', '{"a":2,"b":{"c', "", '{"a":"q"}', "[1]", '{"a":3,"z":9}', '{"b":{"c":5}}']
    write(tmp_dir, "a.json", "\n".join(lines))
    layout = "a INT, b STRUCT<c: STRING>"
    with pytest.raises(Exception, match="bad row"):
        files.read_collection(spark, tmp_dir, layout).count()
    good = files.read_collection(spark, tmp_dir, layout, bad="reject")
    assert good.columns == ["a", "b"] and good.count() == 3
    assert sorted(((r["a"], r["b"] and r["b"]["c"]) for r in good.collect()), key=str) == [(1, "x"), (3, None), (None, "5")]
    why = {r["line"]: r["reason"] for r in files.rejected_documents(spark, tmp_dir, layout).collect()}
    assert why == {lines[1]: "not a JSON document", lines[3]: "does not fit the schema", lines[4]: "does not fit the schema"}


def test_bad_readings_stop_the_job_or_go_to_a_table(spark, tmp_dir):
    rows = [f"{i},R,{1 + i % 28:02d}-0{1 + i % 9}-2024 10:00,{20 + i % 10},In" for i in range(100)]
    write(tmp_dir, "r.csv", "id,room_id/id,noted_date,temp,out/in\n" + "\n".join([*rows, "x,R,01-01-2024 10:00,hot,In", "y,R,01-01-2024 10:00,1,In,more"]))
    name = uuid.uuid4().hex[:8]
    with pytest.raises(Exception, match="temp is not double: hot"):
        weather.run_daily_extremes(spark, f"{tmp_dir}/r.csv", f"t_{name}")
    assert not spark.catalog.tableExists(f"t_{name}")
    out = weather.run_daily_extremes(spark, f"{tmp_dir}/r.csv", f"t_{name}", rejects=f"bad_{name}")
    assert spark.table(f"t_{name}").count() == out.count() == 10
    assert sorted(r["line"].split(",")[0] for r in spark.table(f"bad_{name}").collect()) == ["x", "y"]
    assert weather.read_readings(spark, f"{tmp_dir}/r.csv", rejects=f"bad_{name}").count() + spark.table(f"bad_{name}").count() == 102


def test_a_cut_off_document_stops_the_replication_or_is_listed(spark, tmp_dir):
    db = f"rejects_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_dir}/{db}'")
    for name, _, key in delivery.COLLECTIONS:
        folder = f"{tmp_dir}/in/{name}"
        ids = ", ".join(f"'{k}', 'k' || id" for k in dict.fromkeys([key, "order_id", "customer_id", "restaurant_id", "driver_id"]))
        spark.range(3).selectExpr(f"to_json(named_struct({ids}, 'order_amount', '5')) AS value").write.text(folder)
    with pytest.raises(Exception):
        delivery.read_collections(spark, f"{tmp_dir}/nowhere")
    write(f"{tmp_dir}/in/Orders", "cut.txt", '{"order_id": "k9", "customer_id": "k')
    with pytest.raises(Exception, match="not a JSON document"):
        delivery.run_replication(spark, f"{tmp_dir}/in", db)
    counts = {r["table_name"].split(".")[1]: r["row_count"] for r in delivery.run_replication(spark, f"{tmp_dir}/in", db, rejects="rejects").collect()}
    assert counts["orders"] == 3 and counts["customers"] == 3 and counts["mart_customer_activity"] == 3
    assert {n: spark.table(f"{db}.{n}").count() for n in counts} == counts
    assert [(r["collection"], r["reason"]) for r in spark.table(f"{db}.rejects").collect()] == [("Orders", "not a JSON document")]


def test_json_lists_are_parsed_once_and_other_values_raise(spark):
    whole = '{"a": {"pets": [{"x": 1, "y": [1, {"z": 2.5}]}, null, 7]}, "other": {"deep": [1, 2]}}'
    docs = [(1, whole), (2, None), (3, "null"), (4, "[1]"), (5, '{"a": null}'), (6, '{"a": {"pets": []}}'), (7, '{"a": 5}')]
    df = spark.createDataFrame(docs, "id int, doc string")
    rows = nested.explode_json(df, "doc", "$.a.pets", ["x", "y"], keep=["id"])
    assert [tuple(r) for r in rows.collect()] == [(1, "1", '[1,{"z":2.5}]'), (1, None, None), (1, None, None)]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # One parse of every document; the other two are for marked ones.
    assert plan.count("from_json(") <= 3 and plan.index("CASE WHEN isnull(_doc") < plan.index("get_json_object")
    for text in ('{"a": {"pets": {"x": 1}}}', '{"a": {"pets": "none"}}', '{"a": {"pets": 3}}'):
        odd = spark.createDataFrame([(1, whole), (2, text)], "id int, doc string")
        with pytest.raises(Exception, match="no array at"):
            nested.explode_json(odd, "doc", "$.a.pets", ["x"]).collect()
        assert nested.explode_json(odd, "doc", "$.a.pets", ["x"], bad="skip").count() == 3
    by_name = spark.createDataFrame([(1, '{"a": [{"x": 1}]}'), (2, '{"a": {"x": 1}}')], "id int, doc string")
    with pytest.raises(Exception, match="no array at"):
        nested.explode_json(by_name, "doc", "$['a']", ["x"]).collect()
    assert [r["x"] for r in nested.explode_json(by_name.where("id = 1"), "doc", "$['a']", ["x"]).collect()] == ["1"]


def test_xml_texts_keep_escaped_signs_and_cdata(spark):
    texts = {
        "salt &lt;b&gt;fine": "salt <b>fine", "Q &lt;co&gt;": "Q <co>", "<![CDATA[a <tag> b]]>": "a <tag> b", "M<i>x</i>": "M",
        "a<i>x</i>b": "a", "12<!-- c -->34": "12", " pad ": " pad ", "": None, "<i>z</i>": None, "&amp;amp;": "&amp;",
    }
    df = spark.createDataFrame([(i, f"<r><f><n/><n>{t}</n><v u='1'>{t}</v><w><z>{t}</z></w></f></r>") for i, t in enumerate(texts)], "id int, doc string")
    schema = "f ARRAY<STRUCT<n: ARRAY<STRING>, v: ARRAY<STRUCT<_VALUE: STRING, _u: STRING>>, w: STRUCT<z: ARRAY<STRING>>>>"
    rows = nested.explode_xml(df, "doc", "f", schema, keep=["id"], name="f")
    got = rows.select("id", nested.xml_text("f", "n"), nested.xml_node_text("f", "v"), nested.xml_text("f", "w/z"), nested.xml_attr("f", "v", "u")).collect()
    assert {r[0]: r[1:] for r in map(tuple, got)} == {i: (t, t, t, "1") for i, t in enumerate(texts.values())}
