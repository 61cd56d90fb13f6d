"""File, table, in-memory and SQL sources.

Input that cannot be read as declared raises, or is left out and listed with
its reason; it never turns into NULLs.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    **options: str,
) -> DataFrame:
    """CSV scan with a header.

    With a schema the scan is one pass and the schema's types are used.
    Without one, types are inferred (``inferSchema``), which costs an extra
    pass over the files: fine for exploration, avoid it on large inputs.
    """
    reader = spark.read.option("header", str(header).lower())
    for key, value in options.items():
        reader = reader.option(key, value)
    if schema is not None:
        return reader.schema(schema).csv(path)
    if "inferSchema" not in options:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def csv_layout(spark: SparkSession, path: str, schema: StructType | str, **options: str) -> tuple[StructType, list[str]]:
    """The file's columns in the header's order, with the declared types
    (others are text), and the declared names.  A declared column that the
    header lacks raises."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = read_csv(spark, path, schema=None, inferSchema="false", **options).columns
    missing = [f.name for f in declared if f.name not in header]
    if missing:
        raise ValueError(f"columns not in the header of {path}: {missing}")
    types = {f.name: f.dataType for f in declared}
    found = StructType([StructField(name, types.get(name, StringType())) for name in header])
    return found, [f.name for f in declared]


def read_csv_by_name(spark: SparkSession, path: str, schema: StructType | str, bad: str = "fail", **options: str) -> DataFrame:
    """A CSV scan whose declared columns are found by the header's names,
    in any order.  Undeclared columns are left out; a declared column that
    the header lacks raises, and so does a file whose header differs from
    the first one's.

    A cell that is not of its column's type and a row with more cells than
    the header raise; ``bad="reject"`` leaves such rows out (list them with
    :func:`rejected_csv`).  A short row's missing cells are NULL.  Quotes
    inside quotes are doubled, unless an ``escape`` is given."""
    options = {"escape": '"', **options}
    found, names = csv_layout(spark, path, schema, **options)
    marked, raw = _marked_csv(spark, path, found, options)
    return _only_good(marked, raw, _csv_fault(found, raw, options), bad).select(*[f"`{n}`" for n in names])


def rejected_csv(spark: SparkSession, path: str, schema: StructType | str, **options: str) -> DataFrame:
    """The rows that :func:`read_csv_by_name` rejects: ``file``, the ``line``
    as it stands there, and the ``reason``."""
    options = {"escape": '"', **options}
    found, _ = csv_layout(spark, path, schema, **options)
    marked, raw = _marked_csv(spark, path, found, options)
    return _rejects(marked, raw, _csv_fault(found, raw, options))


def _spare_name(taken: Iterable[str], name: str) -> str:
    known = {t.lower() for t in taken}
    return next(n for n in (name, *(f"{name}_{i}" for i in range(len(known) + 1))) if n.lower() not in known)


def _marked_csv(spark: SparkSession, path: str, found: StructType, options: dict[str, str]) -> tuple[DataFrame, str]:
    """The typed scan with the text of every line Spark could not read as
    declared in one more column."""
    raw = _spare_name(found.names, "raw_line")
    schema = StructType([*found.fields, StructField(raw, StringType())])
    return read_csv(spark, path, schema=schema, enforceSchema="false", columnNameOfCorruptRecord=raw, **options), raw


def _csv_fault(found: StructType, raw: str, options: dict[str, str]) -> Column:
    """Why a marked line is bad; NULL for a good one.

    Spark also marks short rows, whose missing cells are NULL.  Only marked
    lines are looked at again: their cells as text, and how many there are
    (separators outside quotes)."""
    line = F.col(raw)
    names = [f"c{i}" for i in range(len(found))]
    text = F.from_csv(line, ", ".join(f"{n} STRING" for n in names), {k: v for k, v in options.items() if k.lower() != "header"})
    given = {"quote": '"', "sep": ",", **{k.lower(): v for k, v in options.items()}}
    quote, escape, sep = _literal(given["quote"]), _literal(given["escape"]), _literal(given.get("delimiter", given["sep"]))
    bare = F.regexp_replace(line, f"{quote}([^{quote}{escape}]|{escape}.)*{quote}", "") if quote else line
    cells = F.regexp_count(bare, F.lit(sep)) + 1
    fault = F.when(cells > len(found), F.lit("more cells than the header"))
    for name, field in zip(names, found, strict=True):
        if not isinstance(field.dataType, StringType):
            wrong = text[name].isNotNull() & F.col(f"`{field.name}`").isNull()
            fault = fault.when(wrong, F.concat(F.lit(f"{field.name} is not {field.dataType.simpleString()}: "), text[name]))
    fault = fault.when(cells == len(found), F.lit("not read as declared"))
    return F.when(_marked(found.names, raw), fault)


def _marked(names: Sequence[str], raw: str) -> Column:
    """Whether a line is marked.  All declared columns are looked at, so that
    none is pruned: Spark checks only what it parses."""
    present = F.lit(0)
    for n in names:
        present = present + F.col(f"`{n}`").isNotNull().cast("int")
    return F.col(raw).isNotNull() & (present >= 0)


def _literal(text: str) -> str:
    """A regular expression for the text itself."""
    return "".join(f"\\x{{{ord(c):x}}}" for c in text)


def _only_good(marked: DataFrame, raw: str, fault: Column, bad: str) -> DataFrame:
    if bad == "reject":
        good = fault.isNull()
    elif bad == "fail":
        message = F.concat(F.lit("bad row ("), fault, F.lit("): "), F.substring(F.col(raw), 1, 200))
        good = F.when(fault.isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        # A condition that depends on the task keeps its place: the caller's
        # filters cannot be moved before it and take a bad row out unseen.
        good = (F.spark_partition_id() >= 0) & good
    else:
        raise ValueError(f"bad must be 'fail' or 'reject', not {bad!r}")
    return marked.where(good).drop(raw)


def _rejects(marked: DataFrame, raw: str, fault: Column) -> DataFrame:
    file = F.col("_metadata.file_path").alias("file")
    return marked.where(fault.isNotNull()).select(file, F.col(raw).alias("line"), fault.alias("reason"))


def read_parquet(spark: SparkSession, path: str | Sequence[str], merge_schema: bool = False) -> DataFrame:
    """Parquet scan; ``merge_schema`` unions the footers' columns
    (a column missing from some files reads as NULL there)."""
    reader = spark.read
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def read_collection(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "json",
    bad: str = "fail",
    **options: str,
) -> DataFrame:
    """A document collection (JSON lines by default) read with an
    explicit nested schema, so no inference pass is needed.

    A line that is not a whole document, or does not fit the schema, raises;
    ``bad="reject"`` leaves it out (list such lines with
    :func:`rejected_documents`)."""
    if fmt != "json":
        reader = spark.read.format(fmt).schema(schema)
        for key, value in options.items():
            reader = reader.option(key, value)
        return reader.load(path)
    marked, raw = _marked_json(spark, path, schema, options)
    return _only_good(marked, raw, _json_fault(marked, raw), bad)


def rejected_documents(spark: SparkSession, path: str, schema: StructType | str, **options: str) -> DataFrame:
    """The lines that :func:`read_collection` rejects: ``file``, ``line``,
    ``reason``."""
    marked, raw = _marked_json(spark, path, schema, options)
    return _rejects(marked, raw, _json_fault(marked, raw))


def _marked_json(spark: SparkSession, path: str, schema: StructType | str, options: dict[str, str]) -> tuple[DataFrame, str]:
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = _spare_name(declared.names, "raw_line")
    reader = spark.read.schema(StructType([*declared.fields, StructField(raw, StringType())])).option("columnNameOfCorruptRecord", raw)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.json(path), raw


def _json_fault(marked: DataFrame, raw: str) -> Column:
    line = F.col(raw)
    broken = F.get_json_object(line, "$").isNull() & (F.trim(line) != "null")
    reason = F.when(broken, F.lit("not a JSON document")).otherwise(F.lit("does not fit the schema"))
    return F.when(_marked([c for c in marked.columns if c != raw], raw), reason)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table."""
    return spark.table(name)


def rows(spark: SparkSession, data: Iterable, schema: StructType | str | Sequence[str] | None = None) -> DataFrame:
    """Rows built in the driver (small inputs only)."""
    return spark.createDataFrame(list(data), schema)


def register(df: DataFrame, name: str) -> DataFrame:
    """Name a DataFrame for SQL; returns it unchanged."""
    df.createOrReplaceTempView(name)
    return df


def sql(spark: SparkSession, query: str) -> DataFrame:
    """Run SQL text against registered names."""
    return spark.sql(query)


def preview(spark: SparkSession, tables: Sequence[str], n: int = 10, order_by: dict[str, Sequence[str]] | None = None) -> dict[str, DataFrame | Exception]:
    """The first ``n`` rows of each table.

    The at most ``n`` rows are fetched here, so a table that is missing or
    whose files cannot be read is reported as its exception and the loop
    goes on with the next one.  With ``order_by`` the rows are the first by
    that key (a top-k, not a full sort) rather than whatever comes first.
    """
    out: dict[str, DataFrame | Exception] = {}
    for name in tables:
        try:
            df = spark.table(name)
            keys = (order_by or {}).get(name)
            if keys:
                df = df.orderBy(*keys)
            out[name] = spark.createDataFrame(df.limit(n).collect(), df.schema)
        except Exception as exc:  # noqa: BLE001 - reported per table
            out[name] = exc
    return out
