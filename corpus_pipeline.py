"""The training-corpus pipeline: quality rules, near-duplicates, benchmark leaks,
personal data, packing. Every stage but the last returns the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landsales.llm import decontaminate, near_dup, packing, pii, quality
from landsales.llm.common import stored, table, unused


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. The likelihood ratio is counted on the stage's own input."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class one document stays: that of the least doc_id. Where rows repeat that id,
    each of their different texts stays once (of equal ones the row least as JSON). Rows with a
    null doc_id are in no class and stay."""
    classes = near_dup.classes(docs)
    copies = stored(classes.where("doc_id <> class_id").select(F.col("doc_id").alias("_copy")), "pipeline-copies")
    kept = docs.join(copies, F.col("doc_id") == F.col("_copy"), "left_anti")
    repeated = stored(kept.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
                      .select(F.col("doc_id").alias("_again")), "pipeline-repeats")
    once = kept.join(repeated, F.col("doc_id") == F.col("_again"), "left_anti")
    again = kept.join(repeated, F.col("doc_id") == F.col("_again"), "left_semi")
    row = F.struct(*[again[c] for c in docs.columns])
    least = again.groupBy("doc_id", "text").agg(F.min_by(row, F.to_json(row)).alias("_row"))
    return once.unionByName(least.select(*[F.col("_row")[c].alias(c) for c in docs.columns]))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    hits = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    leaking = stored(hits.select(F.col("doc_id").alias("_leak")).distinct(), "pipeline-leaks")
    return docs.join(leaking, F.col("doc_id") == F.col("_leak"), "left_anti")


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    count = unused("n_entities", docs)
    rewritten = pii.pseudonymise(docs, count=count)
    counted = F.when(F.col(count) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return rewritten.withColumn("n_chars", counted).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_leaks", drop_leaks),
    ("personal_data", replace_personal_data),
    ("packing", pack),
]

#: SQL cannot express the stages; tests run them on planted rows and check the documents and texts that remain.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
