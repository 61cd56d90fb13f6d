"""JSON and XML document tables flattened to rows (M1, M2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidewater.operators.nested import explode_json, explode_xml, xml_attr, xml_node_text, xml_text
from tidewater.sinks.tables import create_if_absent
from tidewater.sources.files import read_table

# Pet fields taken from each element of "$.pets".
PET_FIELDS = ("name", "species", "favFoods", "birthYear", "photo")

# The food document layout; every element that may repeat is
# an array so that the first occurrence can be taken.
FOOD_SCHEMA = (
    "food ARRAY<STRUCT<"
    "name: ARRAY<STRING>, mfr: ARRAY<STRING>, "
    "serving: ARRAY<STRUCT<_VALUE: STRING, _units: STRING>>, "
    "calories: ARRAY<STRUCT<_total: STRING, _fat: STRING>>, "
    "`total-fat`: ARRAY<STRING>, `saturated-fat`: ARRAY<STRING>, cholesterol: ARRAY<STRING>, "
    "sodium: ARRAY<STRING>, carb: ARRAY<STRING>, fiber: ARRAY<STRING>, protein: ARRAY<STRING>, "
    "vitamins: STRUCT<a: ARRAY<STRING>, c: ARRAY<STRING>>, "
    "minerals: STRUCT<ca: ARRAY<STRING>, fe: ARRAY<STRING>>>>"
)

# Output column, source (path, or (path, attribute)), type.
FOOD_COLUMNS = (
    ("name", "name", "string"),
    ("manufacturer", "mfr", "string"),
    ("serving_value", "serving", "decimal(18,4)"),
    ("serving_units", ("serving", "units"), "string"),
    ("calories_total", ("calories", "total"), "int"),
    ("calories_fat", ("calories", "fat"), "int"),
    ("total_fat", "total-fat", "decimal(18,4)"),
    ("saturated_fat", "saturated-fat", "decimal(18,4)"),
    ("cholesterol", "cholesterol", "int"),
    ("sodium", "sodium", "int"),
    ("carbs", "carb", "decimal(18,4)"),
    ("fiber", "fiber", "decimal(18,4)"),
    ("protein", "protein", "decimal(18,4)"),
    ("vitamin_a", "vitamins/a", "int"),
    ("vitamin_c", "vitamins/c", "int"),
    ("calcium", "minerals/ca", "int"),
    ("iron", "minerals/fe", "int"),
)

# Elements that carry attributes keep their text under _VALUE.
_WITH_ATTRIBUTES = {"serving"}


def flatten_pets(df: DataFrame, col: str = "json_data", keep: Sequence[str] = ()) -> DataFrame:
    """M1: one row per pet of each document, five text columns; a nested
    value (the food list) keeps its JSON text."""
    return explode_json(df, col, "$.pets", PET_FIELDS, keep=keep)


def flatten_foods(df: DataFrame, col: str = "xml_content", keep: Sequence[str] = ()) -> DataFrame:
    """M2: one row per food element, 17 typed columns.  Text in a number
    field raises (ANSI cast); an absent element or attribute gives NULL."""
    nodes = explode_xml(df, col, "food", FOOD_SCHEMA, keep=keep, name="food")
    out = []
    for name, src, dtype in FOOD_COLUMNS:
        if isinstance(src, tuple):
            value = xml_attr("food", src[0], src[1])
        elif src in _WITH_ATTRIBUTES:
            value = xml_node_text("food", src)
        else:
            value = xml_text("food", src)
        out.append(value.cast(dtype).alias(name))
    return nodes.select(*keep, *out)


def run_pets_table(spark: SparkSession, source_table: str, target_table: str, col: str = "json_data", path: str | None = None) -> bool:
    """M1 end to end: the JSON column of ``source_table`` flattened into
    ``target_table``, created only if absent and never refreshed (K7, D15).
    Returns True when the table was created."""
    return create_if_absent(flatten_pets(read_table(spark, source_table), col), target_table, path)


def run_foods_table(spark: SparkSession, source_table: str, target_table: str, col: str = "xml_content", path: str | None = None) -> bool:
    """M2 end to end: the XML column of ``source_table`` flattened into
    ``target_table``, created only if absent (K7).  Returns True when the
    table was created."""
    return create_if_absent(flatten_foods(read_table(spark, source_table), col), target_table, path)
