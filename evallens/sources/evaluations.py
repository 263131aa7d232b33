"""Evaluations table: scan (S5), id assignment and append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evallens.schemas import EVALUATIONS

EVAL_COLUMNS = [f.name for f in EVALUATIONS.fields]


def as_bool(c) -> F.Column:
    """`bool(x)` on a stored flag: 0/1, true/false, and NULL -> False."""
    return F.coalesce(c.cast("boolean"), F.lit(False))


def normalize_evaluations(df: DataFrame) -> DataFrame:
    """Shape any evaluation rows to the EVALUATIONS schema (P8 on `is_correct`)."""
    return df.select(
        F.col("evaluation_id").cast("long").alias("evaluation_id"),
        F.col("task_id").cast("string").alias("task_id"),
        as_bool(F.col("is_correct")).alias("is_correct"),
        F.col("user_feedback").cast("string").alias("user_feedback"),
        F.col("evaluation_timestamp").cast("timestamp_ntz").alias("evaluation_timestamp"),
    )


def read_evaluations(spark: SparkSession, path: str | None, fmt: str = "parquet",
                     options: dict | None = None) -> DataFrame:
    """Scan stored evaluations with the fixed schema (no inference pass).

    With `fmt="jdbc"` pass `path=None` and the JDBC options; the database gives
    the schema (`partitionColumn` and its bounds let many tasks read).
    """
    r = spark.read.format(fmt).options(**(options or {}))
    if fmt != "jdbc":
        r = r.schema(EVALUATIONS)
    return normalize_evaluations(r.load(path) if path is not None else r.load())


def with_evaluation_id(df: DataFrame) -> DataFrame:
    """Give rows without an `evaluation_id` a new one.

    Equal verdicts are different rows, so an id is random and never a hash of the
    content.  Write the result once and read it back: only one attempt of each
    task is committed, so a retried task does not store a row twice.
    """
    h = F.xxhash64(F.uuid())
    if "evaluation_id" not in df.columns:
        return df.withColumn("evaluation_id", h)
    return df.withColumn("evaluation_id", F.coalesce(F.col("evaluation_id").cast("long"), h))


def stamp(df: DataFrame) -> DataFrame:
    """Give verdicts without a time the query's local time (`datetime.now()`)."""
    if "evaluation_timestamp" not in df.columns:
        return df.withColumn("evaluation_timestamp", F.localtimestamp())
    return df.withColumn("evaluation_timestamp",
                         F.coalesce(F.col("evaluation_timestamp").cast("timestamp_ntz"), F.localtimestamp()))


def append_evaluations(valid: DataFrame, path: str | None, fmt: str = "parquet",
                       options: dict | None = None) -> None:
    """Append validated verdicts (see operators.verdicts.validate_verdicts).

    One job commit for the whole batch, like the single transaction per insert.
    """
    rows = normalize_evaluations(with_evaluation_id(stamp(valid)))
    w = rows.write.mode("append").format(fmt).options(**(options or {}))
    w.save(path) if path is not None else w.save()
