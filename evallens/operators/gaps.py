"""Gaps between consecutive events (W1), their mean (A7) and histogram.

The reference sorts all rows on one machine and takes `diff()`.  A plain
`lag().over(Window.orderBy(ts))` does the same in Spark by moving every row
into one task, so it is avoided.  Instead:

Gaps of rows (`time_gaps`):

1. Rows are dealt into buckets by a range shuffle on (time, key, a random number), as
   many as the data needs, so that a burst at one time, or of one repeated row, is
   split like any other rows.  Before that they are written once, so the input is
   scanned once.
2. Each bucket is sorted, and a row's previous time is that of the row before it.
   A bucket's first row takes the last time of the bucket before, from a table with
   one row per bucket; if that is its own time, the instant has begun there
   and its gap is 0.

Counts of gaps (`gap_histogram`) need no rows: equal times collapse to one counted
row before any shuffle, and `lag` runs over the distinct times of each bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evallens.session import scratch_path

MICROS_PER_MINUTE = 60_000_000.0
_MICROS_PER_DAY = 86_400_000_000


def micros(ts) -> F.Column:
    """Microseconds since 1970-01-01 00:00 of a zone-less timestamp.

    Built from the calendar fields, so no session time zone is applied (a cast
    to TIMESTAMP would shift wall-clock times around daylight-saving changes).
    """
    t = ts.cast("timestamp_ntz")
    days = F.unix_date(F.to_date(t)).cast("long")
    secs = (F.hour(t) * 3600 + F.minute(t) * 60).cast("long")
    frac = (F.date_part(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("long")
    return days * F.lit(_MICROS_PER_DAY) + secs * F.lit(1_000_000) + frac


def minutes_between(earlier, later) -> F.Column:
    return (micros(later) - micros(earlier)).cast("double") / F.lit(MICROS_PER_MINUTE)


ROWS_PER_BUCKET = 1 << 20


def _counted(df: DataFrame, ts: str) -> DataFrame:
    """Known times as (_ts, _n, _b), stored: the number of rows at each, bucket _b in time order."""
    times = _stored(df.where(F.col(ts).isNotNull()).groupBy(F.col(ts).alias("_ts")).agg(F.count(F.lit(1)).alias("_n")), "gap-counts")
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-times.count() // ROWS_PER_BUCKET))
    return _stored(times.repartitionByRange(n, "_ts").withColumn("_b", F.spark_partition_id()), "gap-buckets")


def instant_gaps(df: DataFrame, ts: str) -> DataFrame:
    """One row per distinct time: (_ts, _n, _prev, _gap), its rows, the time before and the
    minutes since (NULL for the first time)."""
    counted = _counted(df, ts)
    instants = counted.withColumn("_prev", F.lag("_ts").over(Window.partitionBy("_b").orderBy("_ts")))
    # One row per non-empty bucket.
    edges = counted.groupBy("_b").agg(F.max("_ts").alias("_last"))
    edges = edges.select("_b", F.lag("_last").over(Window.orderBy("_b")).alias("_before"))
    instants = instants.join(edges, "_b").withColumn("_prev", F.coalesce("_prev", "_before"))
    return instants.select("_ts", "_n", "_prev", minutes_between(F.col("_prev"), F.col("_ts")).alias("_gap"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _in_order(df: DataFrame, ts: str, key: str) -> DataFrame:
    """Rows with a known time as (_key, _ts, _prev, _b), stored: bucket _b in the order of
    (time, key), the time of the row before (NULL for the first of a bucket)."""
    rows = _stored(df.where(F.col(ts).isNotNull()).select(F.col(key).alias("_key"), F.col(ts).alias("_ts")), "gap-rows")
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_PER_BUCKET))
    order = ["_ts", F.col("_key").asc_nulls_last()]
    spread = rows.withColumn("_any", F.xxhash64(F.monotonically_increasing_id()))  # equal rows may lie in any order
    dealt = spread.repartitionByRange(n, *order, "_any").sortWithinPartitions(*order).drop("_any")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        last, bucket = None, TaskContext.get().partitionId()
        for b in batches:
            if not b.num_rows:
                continue
            now = b.column("_ts")
            prev = pa.concat_arrays([pa.array([None], now.type) if last is None else last, now.slice(0, len(now) - 1)])
            last = now.slice(len(now) - 1)
            yield pa.RecordBatch.from_arrays([b.column("_key"), now, prev, pa.array([bucket] * len(now), pa.int32())], names=["_key", "_ts", "_prev", "_b"])

    schema = T.StructType([*rows.schema.fields, T.StructField("_prev", rows.schema["_ts"].dataType), T.StructField("_b", T.IntegerType())])
    return _stored(dealt.mapInArrow(run, schema), "gap-order")


def time_gaps(df: DataFrame, ts: str = "evaluation_timestamp", key: str = "evaluation_id") -> DataFrame:
    """Rows of `df` as (key, ts, gap_minutes); gap to the previous row in time order.

    The first row and rows with a NULL time get a NULL gap.  Tied times are
    ordered by `key`, NULL keys last; of rows that repeat a time and key, one is
    the first.  The ordered rows are written to the shared folder when this is called.
    """
    rows = _in_order(df, ts, key)
    # One row per non-empty bucket.
    edges = rows.groupBy("_b").agg(F.max("_ts").alias("_last"))
    edges = edges.select("_b", F.lag("_last").over(Window.orderBy("_b")).alias("_before"))
    first = F.col("_prev").isNull()
    starts = rows.where(first).join(edges, "_b").select("_key", "_ts", F.col("_before").alias("_prev"))
    each = rows.where(~first).select("_key", "_ts", "_prev").unionByName(starts)
    gaps = each.select(F.col("_key").alias(key), F.col("_ts").alias(ts), minutes_between(F.col("_prev"), F.col("_ts")).alias("gap_minutes"))
    unknown = df.where(F.col(ts).isNull()).select(key, ts, F.lit(None).cast("double").alias("gap_minutes"))
    return gaps.unionByName(unknown)


def gap_histogram(df: DataFrame, ts: str = "evaluation_timestamp", max_bins: int = 30,
                  width: float | None = None) -> DataFrame:
    """A8 over W1 without the rows: `histogram(time_gaps(df))` from one row per time.

    At each time the first row has the instant's gap and the other rows 0, so
    the gaps are counted as weights on the instants: a time holding many rows is
    one weighted row.
    """
    instants = instant_gaps(df, ts)
    # per time: its gap once, and 0 for each further row (one pass, two values)
    weighted = (instants.select(F.expr("stack(2, _gap, 1L, 0.0D, _n - 1) AS (_v, _c)"))
                        .where(F.col("_v").isNotNull() & (F.col("_c") > 0)))
    return histogram(weighted, value="_v", max_bins=max_bins, width=width, weight="_c")


def mean_gap(df: DataFrame, ts: str = "evaluation_timestamp") -> DataFrame:
    """Mean of the gaps in minutes, without computing the gaps.

    The gaps of a sorted sequence telescope: their sum is max - min, so the
    mean is (max - min) / (n - 1) over non-NULL times.  One aggregate, no sort,
    no window, exact integer microseconds until the final division.  Fewer than
    two times -> NULL ("not enough data").
    """
    t = F.col(ts)
    agg = df.where(t.isNotNull()).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(micros(t)).alias("_lo"),
        F.max(micros(t)).alias("_hi"),
    )
    mean = F.when(F.col("_n") > 1,
                  (F.col("_hi") - F.col("_lo")).cast("double") / (F.col("_n") - 1) / F.lit(MICROS_PER_MINUTE))
    return agg.select(F.col("_n").alias("n_times"), mean.alias("mean_gap_minutes"))


def _bins(width: F.Column, lo: F.Column, hi: F.Column) -> F.Column:
    return F.floor(hi / width) - F.floor(lo / width) + 1


def nice_width(lo: F.Column, hi: F.Column, max_bins: int) -> F.Column:
    """Smallest {1, 2, 5} x 10^k for which [lo, hi] touches at most `max_bins` bins; 1 for a single value."""
    raw = (hi - lo) / F.lit(float(max_bins))
    some = F.when(raw > 0, raw).otherwise(F.lit(1.0))
    p = F.pow(F.lit(10.0), F.floor(F.log10(some)))
    steps = [p, p * 2, p * 5, p * 10, p * 20]
    fits = F.coalesce(*[F.when((w >= some) & (_bins(w, lo, hi) <= max_bins), w) for w in steps])
    return F.when(raw > 0, fits).otherwise(F.lit(1.0))


def histogram(gaps: DataFrame, value: str = "gap_minutes", max_bins: int = 30,
              width: float | None = None, weight: str | None = None) -> DataFrame:
    """Counts per bin of width `width`, edges at multiples of it.

    Bin edges are not fixed by the reference (a chart library picks them); here
    the width is a round number giving at most `max_bins` bins, and a bin
    without values has count 0.  The bounds come from a one-row global aggregate;
    the broadcast sides are that row and the bins.  With a given `width` only bins
    with values are returned.  With `weight`, each row counts that many times
    (rows of weight 0 still widen the bounds, so give none).
    """
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    v = gaps.where(F.col(value).isNotNull()).select(F.col(value).alias("_v"), w.alias("_c"), F.lit(0).alias("_k"))
    bins = None
    if width is None:
        bounds = v.groupBy("_k").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        bounds = bounds.withColumn("_w", nice_width(F.col("_lo"), F.col("_hi"), max_bins))
        v = v.join(F.broadcast(bounds.select("_k", "_w")), "_k")
        bins = bounds.select("_w", F.explode(F.sequence(F.floor(F.col("_lo") / F.col("_w")), F.floor(F.col("_hi") / F.col("_w")))).alias("bin"))
    else:
        v = v.withColumn("_w", F.lit(float(width)))
    counts = v.select(F.floor(F.col("_v") / F.col("_w")).alias("bin"), "_w", "_c").groupBy("bin", "_w").agg(F.sum("_c").alias("n"))
    if bins is not None:
        counts = bins.join(counts.drop("_w"), "bin", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    return counts.select(
        "bin",
        (F.col("bin") * F.col("_w")).alias("bin_start"),
        ((F.col("bin") + 1) * F.col("_w")).alias("bin_end"),
        "n",
    )
