"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import json
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One whole driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage at files that outlive any executor, so a lost executor
    costs only the tasks it was running.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    _staged.add(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_staged(spark: SparkSession, before: set[str], keep: str | None = None) -> None:
    """Remove what :func:`stage` wrote since ``before`` (see :func:`staged`),
    but for the folder ``keep``."""
    for path in sorted(_staged - before - {keep}):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        _staged.discard(path)


def staged() -> set[str]:
    """Folders that :func:`stage` has written and nobody removed."""
    return set(_staged)


_staged: set[str] = set()
_shipped: set[str] = set()
_kept: dict[str, object] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        top = Path(__file__).resolve().parents[1]
        path = Path(tempfile.mkdtemp(prefix="tidewater-ship-")) / f"{top.name}.zip"
        with zipfile.ZipFile(path, "w") as out:
            for file in sorted(top.rglob("*.py")):
                out.write(file, f"{top.name}/{file.relative_to(top)}")
        context.addPyFile(str(path))
        _shipped.add(context.applicationId)


def kept(name: str, make: Callable[[], object]) -> object:
    """What the tasks of a step share in a Python worker, made by the first;
    it stays until the worker gets a task of a step that does not keep it."""
    if name not in _kept:
        _kept[name] = make()
    return _kept[name]


def drop_kept(keeps: tuple[str, ...] = ()) -> None:
    """Drop what :func:`kept` holds in this worker, but for ``keeps``."""
    for name in set(_kept).difference(keeps):
        del _kept[name]


def map_batches(df: DataFrame, fn: Callable, schema, keeps: tuple[str, ...] = ()) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors.  Workers
    are used by one step after the other; a task first drops what other steps
    left there (see :func:`kept`), but for the names in ``keeps``."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept(keeps)
        return fn(batches)

    return df.mapInArrow(run, schema)


def extended(schema: T.StructType, columns: str) -> T.StructType:
    """``schema`` and the columns of a DDL string."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(columns).fields])


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns that would clash with the ones about to be added."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def spare_names(taken: list[str], *names: str) -> list[str]:
    """Each of ``names``, with a number if a column has it already."""
    known = {t.lower() for t in taken}
    return [next(n for n in (name, *(f"{name}_{i}" for i in range(len(known) + 1))) if n.lower() not in known) for name in names]


def add_columns(df: DataFrame, columns: str, fn: Callable[[list], list[list]], source: str) -> DataFrame:
    """Add ``columns`` (a DDL string) computed batch by batch from ``source``.

    ``fn`` gets the values of the binary or string column ``source`` as a
    list and returns one list per new column.  All other columns pass
    through untouched; columns of the same name are replaced.
    """
    extra = T.StructType.fromDDL(columns)
    base = without(df, *extra.names)
    names = base.columns
    at = [n.lower() for n in names].index(source.lower())
    types = _arrow_types(extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = fn(batch.column(at).to_pylist())
            arrays = [pa.array(values, type=t) for values, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*names, *extra.names])

    return map_batches(base, run, extended(base.schema, columns))


def _arrow_types(schema) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in schema]


def json_literal(values: list[int]) -> str:
    """Compact JSON of a bounded list of numbers (for a literal in a plan)."""
    return json.dumps(values, separators=(",", ":"))
