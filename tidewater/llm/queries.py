"""The registered queries: one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import centroids, chat, decontaminate, html_text, licenses, packing, periodic, quality, sharding, simhash, suffix_dedup, topk, toxicity
from tidewater.llm.common import table
from tidewater.llm.labelled import remainder


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best other vectors of every vector whose id divides by 100."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices that every document holds."""
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.notices(spark))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document against the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontaminate.find_hits(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("hit_items")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex64().alias("fingerprint"), "component_id")


def op6_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document, shard sizes near equal."""
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt without the held-out third."""
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    held_out = remainder("doc_id", 3) == 1
    model = toxicity.train(docs, labels, ~held_out)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document's pieces in the packed sequences."""
    placed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt without the held-out fifth."""
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    held_out = remainder("doc_id", 5) == 0
    scorer = quality.train(docs, labels, ~held_out)
    scored = quality.score(docs.select("doc_id", "text"), scorer)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated 400-byte strings."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = suffix_dedup.remove_repeats(docs, text=False)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every whole vector after ten rounds."""
    found = centroids.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _tiled(docs: DataFrame) -> DataFrame:
    """The contract's input: the words of a tenth of the documents go on in
    copies of a few of them from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size("words")
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    a = (F.col("g") % F.col("n")).cast("int")
    p = (1 + F.floor((F.col("n") - a) / (3 + F.col("g") % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((F.col("n") - a) / p).cast("int")))
    tiled = F.array_join(F.concat(F.slice("words", 1, a), F.slice(tail, 1, F.col("n") - a)), " ")
    some = docs.withColumn("words", F.when(h % 10 == 0, words)).withColumns({"g": g, "n": n})
    return some.select("doc_id", F.when(F.col("n") > 0, tiled).otherwise(F.col("text")).alias("text"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document."""
    docs = _tiled(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.collapse_runs(docs)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"strongest.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(line, lambda r: F.concat(r, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html": op1_html,
    "op2_topk": op2_topk,
    "op3_licenses": op3_licenses,
    "op4_decontamination": op4_decontamination,
    "op5_simhash": op5_simhash,
    "op6_chats": op6_chats,
    "op7_sharding": op7_sharding,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_quality": op10_quality,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_centroids": op12_centroids,
    "op13_periodic": op13_periodic,
}
