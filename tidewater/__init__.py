"""tidewater: batch and stream ETL operators and jobs, expressed as Spark plans.

Every operator takes and returns a ``pyspark.sql.DataFrame`` (or a ``Column``)
and is built from Spark's own DataFrame / SQL primitives, so Catalyst keeps
predicate pushdown, column pruning and whole-stage codegen.
"""

from tidewater.session import scratch_path, scratch_root, session

__all__ = ["session", "scratch_root", "scratch_path"]
