"""The report (job D) from daily states that merge, so that a new day costs that day only.

A folder of states holds, per day of the evaluations' times:

    counts/day=D/   rows, correct ones, rows with a time, first and last time
    words/day=D/    per feedback word its frequency and first row (id and place)
    gaps/day=D/     how often each gap between neighbouring times occurs inside the day

Sums, least and greatest values merge as they are; the gap from a day's last time to
the next day's first is found from the counts, one row per day.  Rows without a
time are a day of their own (NULL), which has no gaps.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evallens.operators import gaps, report
from evallens.schemas import STOPWORDS, TOP_WORDS_K

COUNTS = "total_evaluations long, correct_answers long, n_times long, first timestamp_ntz, last timestamp_ntz, day date"
WORDS = "word string, frequency long, first struct<none:boolean,id:long,pos:int>, day date"
GAPS = "gap_minutes double, n long, day date"


def _day(ts: str) -> F.Column:
    return F.to_date(F.col(ts).cast("timestamp_ntz")).alias("day")


def update_states(evals: DataFrame, path: str, days: Iterable[str] | None = None, stopwords=STOPWORDS) -> None:
    """Writes the states of `days` (dates as text, None for rows without a time) anew, or of all
    days that `evals` has.  Other days' states stay as they are."""
    ts = "evaluation_timestamp"
    if days is not None:
        days = list(days)
        known = F.to_date(F.col(ts)).cast("string").isin([d for d in days if d is not None])
        evals = evals.where(F.coalesce(known, F.lit(False)) | (F.col(ts).isNull() if None in days else F.lit(False)))

    def put(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{path}/{name}")

    put(report.counts(evals.withColumn("day", _day(ts)), "day").join(
        evals.groupBy(_day(ts).alias("_d")).agg(F.count(ts).alias("n_times"), F.min(ts).alias("first"), F.max(ts).alias("last")),
        F.col("day").eqNullSafe(F.col("_d"))).drop("_d"), "counts")
    put(report.placed_words(evals, "user_feedback", "evaluation_id", stopwords, _day(ts)), "words")
    instants = gaps.instant_gaps(evals, ts).withColumn("day", _day("_ts"))
    inside = F.when(F.to_date(F.col("_prev")) == F.col("day"), F.col("_gap"))
    each = instants.select("day", F.expr("_n - 1").alias("zeros"), inside.alias("gap"))
    counted = each.select("day", F.expr("stack(2, gap, 1L, 0.0D, zeros) AS (gap_minutes, n)")).where("gap_minutes IS NOT NULL AND n > 0")
    put(counted.groupBy("day", "gap_minutes").agg(F.sum("n").alias("n")), "gaps")


def report_from_states(spark: SparkSession, path: str, k: int = TOP_WORDS_K, max_bins: int = 30) -> dict[str, DataFrame]:
    """The blocks of `report.evaluation_report` but the detail rows, from the states of all days."""
    counts = spark.read.schema(COUNTS).parquet(f"{path}/counts")
    words = spark.read.schema(WORDS).parquet(f"{path}/words")
    inside = spark.read.schema(GAPS).parquet(f"{path}/gaps")
    summary = report.summary_of(report.merged_counts(counts))
    merged = words.groupBy("word").agg(F.sum("frequency").alias("frequency"), F.min("first").alias("first"))
    order = [F.desc("frequency"), F.asc("first"), F.asc("word")]
    top = merged.orderBy(*order).limit(k)  # k rows: a global window over them is free
    times = counts.agg(F.coalesce(F.sum("n_times"), F.lit(0)).alias("n"), F.min("first").alias("lo"), F.max("last").alias("hi"))
    mean = F.when(F.col("n") > 1, (gaps.micros(F.col("hi")) - gaps.micros(F.col("lo"))).cast("double") / (F.col("n") - 1) / F.lit(gaps.MICROS_PER_MINUTE))
    before = F.lag("last").over(Window.orderBy("day"))  # one row per day
    between = counts.where("n_times > 0").select(gaps.minutes_between(before, F.col("first")).alias("gap_minutes"), F.lit(1).cast("long").alias("n"))
    every = inside.select("gap_minutes", "n").unionByName(between).groupBy("gap_minutes").agg(F.sum("n").alias("n"))
    return {
        "summary": summary,
        "distribution": report.distribution_of(summary),
        "top_words": top.select(F.row_number().over(Window.orderBy(*order)).alias("rank"), "word", "frequency"),
        "mean_gap": times.select(F.col("n").alias("n_times"), mean.alias("mean_gap_minutes")),
        "histogram": gaps.histogram(every, max_bins=max_bins, weight="n"),
    }
