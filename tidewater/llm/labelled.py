"""Bounded samples of labelled rows, and the folds that hold rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import stage


def remainder(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id: of no text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Staged ``(label, text)`` of about ``rows`` labelled documents at most.

    ``learn`` says which label rows may be learnt from.  Rows without an id
    or a label are not; an id labelled twice has its larger label.  The rows
    are drawn by a hash of the id, at the rate that makes their expected
    number ``rows`` (all of them if there are fewer), so the labels that are
    broadcast are bounded by ``rows``; of a repeated id the text with the
    smallest hash counts, found before the shuffle as far as it can be.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & learn)
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    known = stage(known, "labels")
    count = known.count()
    if count > rows:
        known = known.where(F.pmod(F.xxhash64("_id", F.lit("draw")), F.lit(1 << 30)) < int(rows / count * (1 << 30)))
    texts = docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    drawn = texts.join(F.broadcast(known), F.col("_doc") == F.col("_id"))
    once = drawn.groupBy("_id").agg(F.max("label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text"))
    return stage(once.select("label", "text"), "labelled-sample")
