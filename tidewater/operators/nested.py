"""JSON, XML, array and struct operators.

Parsing stays in Spark's built-in JSON/XML expressions; no Python code sees
the documents.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

# Timestamp layouts used when rows go to JSON text and back.
# The default layout keeps milliseconds only; these keep microseconds.
JSON_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


# JSON text has no NaN or Infinity; a document that writes them bare is bad.
STRICT_NUMBERS = {"allowNonNumericNumbers": "false"}


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ------------------------------- JSON ------------------------------------


def json_get(col: Column | str, path: str) -> Column:
    """Sub-document (or scalar) at a JSON path, as JSON text.
    Absent keys and JSON null give NULL."""
    return F.get_json_object(_c(col), path)


def json_text(col: Column | str, key: str) -> Column:
    """A field as text; a nested array/object gives its JSON text."""
    return F.get_json_object(_c(col), f"$.{key}")


def explode_json(
    df: DataFrame,
    col: str,
    path: str,
    fields: Mapping[str, str] | Sequence[str],
    keep: Sequence[str] = (),
    element: str = "_elem",
    bad: str = "fail",
) -> DataFrame:
    """One row per element of the JSON array at ``path``, with the
    element's ``fields`` as text (lateral join of a row with its own array).

    An empty, absent or NULL array gives no rows.  ``fields`` maps output
    name -> key in the element (a list uses the keys as names).  A document
    that is not JSON, or holds something other than an array at ``path``,
    raises; ``bad="skip"`` leaves it out instead (list documents that are
    not JSON with :func:`bad_json`).

    Under a plain dotted path a document is parsed once, down to the fields:
    Spark marks the documents that do not fit, and only those are looked at
    again.
    """
    if not isinstance(fields, Mapping):
        fields = {f: f for f in fields}
    keys = list(dict.fromkeys(fields.values()))
    # The text each field gets is the one get_json_object gives; a repeated
    # key keeps its last value; an element that is not an object has NULLs.
    layout = StructType([StructField(k, StringType()) for k in keys]) if all(_KEY.match(k) for k in keys) else None
    source = df.select(*keep, F.col(col).alias("_text"))
    checked = _list_or_fail("_text", path, bad)
    if layout is not None:
        checked = F.transform(checked, lambda e: F.from_json(e, layout))
    if _SIMPLE_PATH.match(path):
        steps = path[2:].split(".")
        whole = StructType([_list_at(steps, layout or StringType()), StructField(_MARK, StringType())])
        source = source.withColumn("_doc", F.from_json("_text", whole, {"columnNameOfCorruptRecord": _MARK}))
        found = F.col("_doc")
        for step in steps:
            found = found[step]
        checked = F.when(F.col("_doc")[_MARK].isNull(), found).otherwise(checked)
    rows = source.select(*keep, F.explode(checked).alias(element))
    field = (lambda key: F.col(element)[key]) if layout is not None else (lambda key: json_text(element, key))
    return rows.select(*keep, *[field(key).alias(name) for name, key in fields.items()])


# Column that holds the text of a document that does not fit its layout.
_MARK = "_unread"


def _list_at(steps: Sequence[str], element: DataType) -> StructField:
    """The layout of a document with a list under some keys."""
    kind: ArrayType | StructType = ArrayType(element)
    for step in reversed(steps[1:]):
        kind = StructType([StructField(step, kind)])
    return StructField(steps[0], kind)


def _list_or_fail(col: str, path: str, bad: str) -> Column:
    """The array at ``path``, with the reason raised if there is something
    else."""
    found = F.get_json_object(F.col(col), path)
    arr = F.from_json(found, "array<string>")
    other = found.isNotNull() & ~F.startswith(F.ltrim(found), F.lit("["))
    if bad == "skip":
        return F.when(~other, arr)
    fault = F.when(is_bad_json(col), F.lit("not a JSON document: ")).when(other, F.lit(f"no array at {path}: "))
    start = F.substring(F.col(col), 1, 80)
    return F.when(fault.isNotNull(), F.raise_error(F.concat(fault, start)).cast("array<string>")).otherwise(arr)


def is_bad_json(col: Column | str) -> Column:
    """Whether a text is there but is not a JSON document."""
    c = _c(col)
    return c.isNotNull() & F.get_json_object(c, "$").isNull() & (F.trim(c) != "null")


def bad_json(df: DataFrame, col: str) -> DataFrame:
    """The rows whose ``col`` is not a JSON document."""
    return df.where(is_bad_json(col))


_SIMPLE_PATH = re.compile(r"^\$(\.[A-Za-z_][A-Za-z0-9_]*)+$")
_KEY = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def text_schema(paths: Sequence[str]) -> StructType | None:
    """A nested all-text schema holding every path (``$.a.b`` -> a.b STRING),
    or None when a path is not a plain dotted path or is both a leaf and a
    parent of another path."""
    tree: dict = {}
    for p in paths:
        if not _SIMPLE_PATH.match(p):
            return None
        node = tree
        steps = p[2:].split(".")
        for step in steps[:-1]:
            child = node.setdefault(step, {})
            if child is None:
                return None
            node = child
        if steps[-1] in node:
            return None
        node[steps[-1]] = None

    def build(node: dict) -> StructType:
        return StructType(
            [StructField(k, StringType() if v is None else build(v)) for k, v in node.items()]
        )

    return build(tree)


def flatten_json(
    df: DataFrame,
    col: str,
    paths: Mapping[str, str],
    keep: Sequence[str] = (),
    schema: StructType | str | None = None,
) -> DataFrame:
    """Flat columns from JSON paths.

    Default: every column is text, with the same values ``get_json_object``
    gives per path (a nested value keeps its JSON text, a missing key or a
    document that is not JSON gives NULL).  Plain dotted paths are read with
    one ``from_json`` parse per document against an all-text schema, instead
    of one parse per path; other paths fall back to ``get_json_object``.
    Bare ``NaN`` is not JSON and gives NULL, as ``get_json_object`` does.  A
    key that a document repeats keeps its last value, as JSON parsers do
    (``get_json_object`` takes the first); a document that needs the first
    is read with a path of another form, such as ``$['a']``.

    With a ``schema`` the columns are typed by it (D3: parsed once).
    """
    if schema is None:
        schema = text_schema(list(paths.values()))
        if schema is None:
            return df.select(*keep, *[F.get_json_object(F.col(col), p).alias(n) for n, p in paths.items()])
    parsed = F.from_json(F.col(col), schema, {**JSON_OPTIONS, **STRICT_NUMBERS})
    staged = df.select(*keep, parsed.alias("_doc"))
    out = []
    for name, path in paths.items():
        field = F.col("_doc")
        for step in path[2:].split("."):
            field = field[step]
        out.append(field.alias(name))
    return staged.select(*keep, *out)


def to_value(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as one JSON document in column ``value``."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS).alias(name))


def nest(layout: Mapping[str, object]) -> Column:
    """J6 helper: a struct from a layout of name -> Column | str | layout."""
    parts = []
    for name, spec in layout.items():
        if isinstance(spec, Mapping):
            parts.append(nest(spec).alias(name))
        else:
            parts.append(_c(spec).alias(name))
    return F.struct(*parts)


def to_nested_value(df: DataFrame, layout: Mapping[str, object], keep: Sequence[str] = (), name: str = "value") -> DataFrame:
    """Structs (and arrays of structs already in ``df``) to one JSON
    document per row, shaped by ``layout``."""
    return df.select(*keep, F.to_json(nest(layout), JSON_OPTIONS).alias(name))


def pack_rows(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    fields: Sequence[str],
    name: str,
    chunk: int = 256,
) -> DataFrame:
    """Gather child rows into an array per parent, as documents hold them.

    Each document holds the children of one parent whose ``seq`` (a unique
    ordinal such as a line or turn number) falls in the same block of
    ``chunk`` values, so no array - and no group - is larger than ``chunk``
    rows however many children one parent has.  The array is sorted by
    ``seq``; the block number is returned as ``part``.
    """
    part = F.floor(F.col(seq) / F.lit(chunk)).alias("part")
    grouped = df.groupBy(*keys, part).agg(
        F.array_sort(F.collect_list(F.struct(F.col(seq).alias("_seq"), *[F.col(f) for f in fields]))).alias("_items")
    )
    items = F.transform(F.col("_items"), lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    return grouped.select(*keys, "part", items.alias(name))


# -------------------------------- XML ------------------------------------

# Fixed value: white space around a text is part of it.
XML_OPTIONS = {"ignoreSurroundingSpaces": "false"}


def explode_xml(df: DataFrame, col: str, row: str, schema: StructType | str, keep: Sequence[str] = (), name: str = "node", bad: str = "fail") -> DataFrame:
    """One row per ``row`` element of each XML document.

    ``schema`` describes the document's children; declare every element that
    may repeat as an array (a scalar field keeps the last repeat).  A text
    (an ``ARRAY<STRING>`` element, or ``_VALUE`` beside attributes) is the
    element's first one: it ends where a child element or a comment begins;
    escaped signs and CDATA are part of it, and it is NULL if there is none.
    A document that is not XML raises; ``bad="skip"`` leaves it out instead.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    doc = F.from_xml(F.col(col), _texts_apart(declared), {**XML_OPTIONS, "mode": "FAILFAST" if bad == "fail" else "PERMISSIVE"})
    rows = df.select(*keep, F.explode(doc[row]).alias(name))
    return rows.select(*keep, _first_texts(F.col(name), declared[row].dataType.elementType).alias(name))


# Spark reads an element with children into a text as its whole markup,
# indistinguishable from escaped signs.  Read into a struct with an array
# under ``_VALUE``, its texts are apart from its children.
_TEXTS = StructType([StructField("_VALUE", ArrayType(StringType()))])


def _texts_apart(kind: DataType) -> DataType:
    """The layout in which every element's texts are an array."""
    if isinstance(kind, ArrayType):
        return ArrayType(_TEXTS if isinstance(kind.elementType, StringType) else _texts_apart(kind.elementType))
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, ArrayType(StringType()) if f.name == "_VALUE" else _texts_apart(f.dataType)) for f in kind])
    return kind


def _first_texts(c: Column, kind: DataType) -> Column:
    """A value read with :func:`_texts_apart` as ``kind`` declares it."""
    if isinstance(kind, StringType):
        return F.get(c["_VALUE"], 0)
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda e: _first_texts(e, kind.elementType))
    if not isinstance(kind, StructType):
        return c
    fields = []
    for f in kind:
        field = c[f.name]
        if f.name == "_VALUE":
            field = F.get(field, 0)
        elif isinstance(f.dataType, (ArrayType, StructType)):
            field = _first_texts(field, f.dataType)
        fields.append(field.alias(f.name))
    return F.when(c.isNotNull(), F.struct(*fields))


def xml_text(node: Column | str, path: str) -> Column:
    """First text under a child path ("a/b" = child a, then b); the
    leaf must be declared as an array in the schema.  Elements without text
    are passed over."""
    steps = path.split("/")
    c = _c(node)
    for step in steps[:-1]:
        c = c[step]
    return F.get(F.filter(c[steps[-1]], lambda t: t.isNotNull()), 0)


def xml_node_text(node: Column | str, path: str) -> Column:
    """J8 for an element that also has attributes: its text is ``_VALUE``."""
    return F.get(F.filter(_c(node)[path], lambda e: e["_VALUE"].isNotNull()), 0)["_VALUE"]


def xml_attr(node: Column | str, path: str, attr: str) -> Column:
    """First value of attribute ``attr`` on child ``path``; absent -> NULL."""
    return F.get(_c(node)[path], 0)["_" + attr]


def xml_escape(col: Column | str) -> Column:
    """Text made safe for an XML element or attribute."""
    c = _c(col).cast("string")
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


# ----------------------------- structs -----------------------------------


def explode_structs(df: DataFrame, key: str | Sequence[str], arr: str, cols: Mapping[str, Column | str] | None = None, name: str = "_item") -> DataFrame:
    """One row per array element, with the parent key.  Empty or NULL
    arrays give no rows (plain ``explode``).  ``cols`` maps output names to
    element fields (str) or expressions over ``F.col(name)``."""
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.select(*keys, F.explode(F.col(arr)).alias(name))
    if not cols:
        return rows.select(*keys, f"{name}.*")
    out = []
    for out_name, spec in cols.items():
        out.append((F.col(name)[spec] if isinstance(spec, str) else spec).alias(out_name))
    return rows.select(*keys, *out)
