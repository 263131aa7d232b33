"""A corpus in four stages: toxicity filter, near-duplicate removal, mixing, packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evallens.llm import mixing, ngram_join, packing, toxicity
from evallens.llm.common import rows_with_ids, rows_without_ids, stored
from evallens.session import scratch_path


def _whole(docs: DataFrame) -> Column:
    """A row's columns in one, so that none clashes with those a stage adds."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(docs.select("doc_id", "text", _whole(docs)), labels).where(~F.col("rejected")).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five-word shingles, similarity 0.8
    or more): the one with the least doc_id, NULL last.

    A row's key is its doc_id.  If any is NULL or repeats, each distinct (doc_id, text)
    is numbered instead, told apart by the text's SHA-256, so that each text is
    compared for itself; equal rows have a key in common.
    """
    doc = F.col("doc_id").cast("long")
    odd = docs.groupBy("doc_id").count().where(F.col("doc_id").isNull() | (F.col("count") > 1))
    if odd.isEmpty():
        keyed = docs.select(doc.alias("key"), _whole(docs))
    else:
        said = F.coalesce(F.sha2("text", 256), F.lit(""))
        names = docs.select(doc.alias("id"), said.alias("said")).distinct()
        names = stored(names.withColumn("key", F.monotonically_increasing_id()), "pipeline-numbers")
        rows = docs.select(doc.alias("at"), said.alias("text_said"), _whole(docs))
        keyed = rows.join(names, F.col("at").eqNullSafe(F.col("id")) & (F.col("text_said") == F.col("said"))).select("key", "doc")
        keyed = stored(keyed, "pipeline-keyed")
    groups = ngram_join.ngram_join(keyed.select(F.col("key").alias("doc_id"), "doc.text"), n=5, num=80, den=100)
    linked = groups.where(F.col("n_links") > 0).groupBy(F.col("doc_id").alias("key"), "component_id").agg(F.count(F.lit(1)).alias("rows"))
    linked = stored(linked, "pipeline-linked")
    named = rows_with_ids(keyed.select("key", "doc.doc_id"), "key", linked.select("key")).distinct()
    named = stored(linked.join(named, "key"), "pipeline-named")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"))
    gone = named.join(first, "component_id").where(F.col("key") != F.col("first.key")).select("key")
    kept = rows_without_ids(keyed, "key", stored(gone, "pipeline-gone"))
    equal = linked.where(F.col("rows") > 1).select("key")  # rows with the same id and text: one stays
    if not equal.isEmpty():
        kept = rows_without_ids(kept, "key", equal).unionByName(rows_with_ids(kept, "key", equal).dropDuplicates(["key"]))
    return kept.select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of sequences of like length."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


# The toxicity model is fitted to labels, which SQL cannot express; tests/llm holds a brute-force version.
ORACLE_SQL = None
