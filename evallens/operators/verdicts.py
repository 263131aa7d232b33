"""Verdict validation (P9): which human verdicts may be stored, and how."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evallens.functions.text import py_strip
from evallens.sources.evaluations import as_bool


def check_verdicts(verdicts: DataFrame) -> DataFrame:
    """Add `reason` (NULL when the verdict is valid) and the feedback to store.

    * correct: feedback must be absent; stored as NULL;
    * incorrect: feedback must be non-blank after `strip()`; stored stripped.
    """
    ok = as_bool(F.col("is_correct"))
    fb = F.col("user_feedback")
    stripped = py_strip(fb)
    reason = (F.when(ok & fb.isNotNull(), F.lit("feedback_on_correct"))
               .when(~ok & (fb.isNull() | (stripped == "")), F.lit("empty_feedback")))
    return (verdicts.withColumn("reason", reason)
                    .withColumn("is_correct", ok)
                    .withColumn("user_feedback", F.when(ok, F.lit(None).cast("string")).otherwise(stripped)))


def valid_verdicts(verdicts: DataFrame) -> DataFrame:
    return check_verdicts(verdicts).where(F.col("reason").isNull()).drop("reason")


def rejected_verdicts(verdicts: DataFrame) -> DataFrame:
    """Rejected rows keep their feedback as submitted."""
    checked = check_verdicts(verdicts.withColumn("_raw", F.col("user_feedback")))
    return (checked.where(F.col("reason").isNotNull())
                   .withColumn("user_feedback", F.col("_raw")).drop("_raw"))
