import datetime as dt
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

from evallens.operators import gaps, report
from evallens.schemas import EVALUATIONS


def evals(spark, rows):
    return spark.createDataFrame(rows, EVALUATIONS)


T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def test_summary_null_counts_as_incorrect(spark):
    df = evals(spark, [(1, "a", True, None, T0), (2, "b", None, None, T0), (3, "c", False, "x", T0)])
    r = report.summary(df).collect()[0]
    assert (r.total_evaluations, r.correct_answers, r.incorrect_answers) == (3, 1, 2)
    assert r.correct_pct == (1 / 3) * 100 and r.incorrect_pct == (2 / 3) * 100


def test_summary_empty_has_no_row(spark):
    assert report.summary(evals(spark, [])).count() == 0


def test_distribution_keeps_zero_class(spark):
    df = evals(spark, [(1, "a", True, None, T0), (2, "b", True, None, T0)])
    got = {r.outcome: r.n for r in report.distribution(df).collect()}
    assert got == {"Correct": 2, "Incorrect": 0}


def test_top_words_first_seen_tie_break(spark):
    df = evals(spark, [(1, "a", False, "b a c a b c", T0)])
    got = [(r.word, r.frequency) for r in report.top_words(df, k=2, stopwords=()).collect()]
    assert got == [("b", 2), ("a", 2)]
    assert got == Counter("b a c a b c".split()).most_common(2)


def test_top_words_stopwords_and_python_counter(spark):
    fb = ["The answer is wrong, the units are missing", None, "Missing units; wrong table", "too vague: missing"]
    df = evals(spark, [(i, str(i), False, f, T0) for i, f in enumerate(fb)])
    got = [(r.word, r.frequency) for r in report.top_words(df).orderBy("rank").collect()]
    import re
    from evallens.schemas import STOPWORDS
    words = [w for w in re.findall(r"\b\w+\b", " ".join(f for f in fb if f).lower()) if w not in set(STOPWORDS)]
    assert got == Counter(words).most_common(5)


def test_top_words_all_null(spark):
    df = evals(spark, [(1, "a", True, None, T0)])
    assert report.top_words(df).count() == 0


def test_top_words_plan_is_take_ordered(spark):
    df = evals(spark, [(1, "a", False, "x y", T0)])
    plan = report.top_words(df)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def _pandas_gaps(rows):
    pdf = pd.DataFrame(rows, columns=["evaluation_id", "evaluation_timestamp"])
    pdf = pdf.sort_values(["evaluation_timestamp", "evaluation_id"], na_position="last")
    pdf["gap"] = pdf["evaluation_timestamp"].diff().dt.total_seconds() / 60
    return {r.evaluation_id: (None if pd.isna(r.gap) else round(r.gap, 9)) for r in pdf.itertuples()}


GAP_ROWS = [
    (1, T0), (2, T0), (3, T0 + dt.timedelta(minutes=5)), (4, None),
    (5, T0 + dt.timedelta(days=3, seconds=1)), (6, T0 + dt.timedelta(days=3, seconds=1, microseconds=7)),
    (7, T0 - dt.timedelta(hours=13)), (8, T0 + dt.timedelta(days=40)),
]


def _spark_gaps(df):
    return {r.evaluation_id: (None if r.gap_minutes is None else round(r.gap_minutes, 9)) for r in df.collect()}


def test_gaps_edge_rows_all_grains(spark):
    df = evals(spark, [(i, str(i), True, None, t) for i, t in GAP_ROWS])
    want = _pandas_gaps(GAP_ROWS)
    assert want[2] == 0.0 and want[4] is None
    assert _spark_gaps(gaps.time_gaps(df)) == want


def test_gaps_of_repeated_and_null_keys(spark):
    T1 = T0 + dt.timedelta(minutes=4)
    rows = [(1, T0), (2, T1), (2, T1), (None, T1), (None, T1 + dt.timedelta(minutes=11)), (None, None)]
    df = evals(spark, [(i, "a", True, None, t) for i, t in rows])
    got = sorted(str((r.evaluation_id, r.gap_minutes)) for r in gaps.time_gaps(df).collect())
    assert got == sorted(map(str, [(1, None), (2, 4.0), (2, 0.0), (None, 0.0), (None, 11.0), (None, None)]))


def test_gaps_single_row_and_mean(spark):
    df = evals(spark, [(1, "a", True, None, T0)])
    assert _spark_gaps(gaps.time_gaps(df)) == {1: None}
    assert gaps.mean_gap(df).collect()[0].mean_gap_minutes is None


def test_mean_gap_equals_mean_of_gaps(spark):
    df = evals(spark, [(i, str(i), True, None, t) for i, t in GAP_ROWS])
    want = [g for g in _pandas_gaps(GAP_ROWS).values() if g is not None]
    got = gaps.mean_gap(df).collect()[0].mean_gap_minutes
    assert abs(got - sum(want) / len(want)) < 1e-9


def test_gaps_on_events_equal_naive_lag(spark):
    from pyspark.sql import Window
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id", "ts")
    naive = ev.select("event_id", (F.timestamp_diff("MICROSECOND", F.lag("ts").over(Window.orderBy("ts", "event_id")), F.col("ts")) / 60e6).alias("gap_minutes"))
    mine = gaps.time_gaps(ev, ts="ts", key="event_id").select("event_id", "gap_minutes")
    assert naive.exceptAll(mine).count() == 0 and mine.exceptAll(naive).count() == 0


def test_gaps_scan_the_input_once_and_window_per_bucket(spark, monkeypatch):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id", "ts")
    monkeypatch.setattr(gaps, "ROWS_PER_BUCKET", 100)
    out = gaps.gap_histogram(ev, ts="ts")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # times are windowed per bucket (hash exchange on the bucket), never as one partition
    assert "hashpartitioning(_b" in plan and plan.count("lag(_ts") >= 1
    assert "events.parquet" not in plan
    counted = gaps._counted(ev, "ts")
    assert counted.select("_b").distinct().count() > 60  # buckets follow the rows, not a fixed number


def test_bursts_are_split(spark, monkeypatch):
    """Half of all rows at one time, a third of them the same row: no bucket is much larger than the rest."""
    monkeypatch.setattr(gaps, "ROWS_PER_BUCKET", 200)
    at = F.expr("timestamp_ntz'2024-01-15 12:00:00'")
    df = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(F.lit(7)).alias("id"),
                                  F.when(F.col("id") % 2 == 0, at).otherwise(at + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int") - 3000)).alias("ts"))
    order = gaps._in_order(df, "ts", "id")
    sizes = [r["count"] for r in order.groupBy("_b").count().collect()]
    assert len(sizes) >= 25 and max(sizes) < 600
    from pyspark.sql import Window
    naive = df.select("id", "ts", (F.timestamp_diff("MICROSECOND", F.lag("ts").over(Window.orderBy("ts", "id")), F.col("ts")) / 60e6).alias("gap_minutes"))
    mine = gaps.time_gaps(df, ts="ts", key="id")
    assert naive.exceptAll(mine).count() == 0 and mine.exceptAll(naive).count() == 0


def test_histogram_equal_values_one_bin(spark):
    df = spark.createDataFrame([(1.5,), (1.5,), (None,)], "gap_minutes double")
    rows = gaps.histogram(df).collect()
    assert len(rows) == 1 and rows[0].n == 2 and rows[0].bin_end - rows[0].bin_start == 1.0


def test_histogram_counts_sum_and_width(spark):
    vals = [0.0, 0.1, 3.3, 7.0, 29.9, 61.0]
    df = spark.createDataFrame([(v,) for v in vals], "gap_minutes double")
    rows = gaps.histogram(df).collect()
    assert sum(r.n for r in rows) == len(vals)
    assert {r.bin_end - r.bin_start for r in rows} == {5.0}  # 61/30 -> 2.03 -> 5
    assert sorted(r.bin for r in rows) == list(range(13))  # empty bins too
    many = gaps.histogram(spark.createDataFrame([(i + 0.5,) for i in range(31)], "gap_minutes double")).collect()
    assert len(many) <= 30 and sum(r.n for r in many) == 31


def test_evaluation_report_bundle(spark):
    df = evals(spark, [(i, str(i), i % 3 != 0, None if i % 3 else "bad units", T0 + dt.timedelta(minutes=7 * i))
                       for i in range(12)])
    rep = report.evaluation_report(df)
    assert set(rep) == {"summary", "distribution", "top_words", "mean_gap", "histogram", "detail"}
    assert rep["summary"].collect()[0].total_evaluations == 12
    assert abs(rep["mean_gap"].collect()[0].mean_gap_minutes - 7.0) < 1e-12
    assert sum(r.n for r in rep["histogram"].collect()) == 11
    assert report.summary_display(df).collect()[0].correct_rate == "66.67%"


def test_top_words_of_rows_without_an_id(spark):
    df = evals(spark, [(None, "t", False, "zebra zebra zebra apple", T0), (1, "t", False, "apple pear", T0)])
    assert [(r["rank"], r.word, r.frequency) for r in report.top_words(df).collect()] == [(1, "zebra", 3), (2, "apple", 2), (3, "pear", 1)]
    only = evals(spark, [(None, "t", False, "b q b", T0), (None, "t", False, "c", T0)])
    assert [r.word for r in report.top_words(only).collect()] == ["b", "c", "q"]


def test_states_of_one_day_leave_others_alone(spark, tmp_dir):
    from evallens.operators import daily

    def rows(day, n, word="bad"):
        return [(day * 100 + i, "t", i % 2 == 0, f"{word} w{i} {day}", T0 + dt.timedelta(days=day, minutes=i * i % 37)) for i in range(n)]

    path = f"{tmp_dir}/states"
    all_rows = rows(0, 9) + rows(1, 12, "late") + rows(3, 7) + [(5000, "t", True, None, None), (None, "t", False, "bad unnamed", None)]
    days = lambda n: str((T0 + dt.timedelta(days=n)).date())
    daily.update_states(evals(spark, rows(0, 9) + rows(1, 4, "late")), path)
    # a broken day that is not asked for is never looked at
    daily.update_states(evals(spark, [r for r in all_rows if r[0] is None or r[0] >= 100] + rows(0, 1, "never")), path, [days(1), days(3), None])
    df = evals(spark, all_rows)
    got, want = daily.report_from_states(spark, path), report.evaluation_report(df)
    for block in got:
        assert sorted(map(tuple, got[block].collect())) == sorted(map(tuple, want[block].collect())), block
    empty = f"{tmp_dir}/none"
    daily.update_states(df.limit(0), empty)
    assert {k: v.count() for k, v in daily.report_from_states(spark, empty).items()} == {"summary": 0, "distribution": 0, "top_words": 0, "mean_gap": 1, "histogram": 0}


def test_gaps_ignore_session_time_zone(spark):
    """Zone-less times differ by wall-clock time, also across a daylight-saving change."""
    rows = [(1, dt.datetime(2024, 3, 10, 1, 30)), (2, dt.datetime(2024, 3, 10, 3, 30)),
            (3, dt.datetime(2024, 11, 3, 0, 59, 59, 500)), (4, dt.datetime(2024, 11, 3, 2, 0))]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = evals(spark, [(i, str(i), True, None, t) for i, t in rows])
        got = _spark_gaps(gaps.time_gaps(df))
        mean = gaps.mean_gap(df).collect()[0].mean_gap_minutes
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == _pandas_gaps(rows)
    assert got[2] == 120.0
    assert abs(mean - (rows[-1][1] - rows[0][1]).total_seconds() / 60 / 3) < 1e-9


def test_gap_histogram_equals_histogram_of_row_gaps(spark):
    """Weighted instants give the same bins as the per-row gaps, ties and NULL times included."""
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id", "ts")
    tied = ev.where(F.col("event_id") % 50 == 0).select((F.col("event_id") + 10_000_000).alias("event_id"), "ts")
    nulls = ev.limit(3).select((F.col("event_id") + 20_000_000).alias("event_id"), F.lit(None).cast("timestamp_ntz").alias("ts"))
    df = ev.unionByName(tied).unionByName(nulls)
    rows = gaps.histogram(gaps.time_gaps(df, ts="ts", key="event_id"))
    inst = gaps.gap_histogram(df, ts="ts")
    assert sorted(rows.collect()) == sorted(inst.collect())
    one = evals(spark, [(1, "a", True, None, T0), (2, "b", True, None, T0), (3, "c", True, None, None)])
    assert [(r.bin, r.n) for r in gaps.gap_histogram(one).collect()] == [(0, 1)]  # the tie's 0; the first is NULL


def test_rates_round_like_python(spark):
    vals = [c / n * 100.0 for n in range(1, 130) for c in range(n + 1)] + [3.125, 2.675, 0.005, 0.015, 0.0625, 100.0, 0.0, 1e-9, 66.665]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r.t for r in df.select(report.format_pct(F.col("v")).alias("t")).collect()]
    assert got == [f"{v:.2f}%" for v in vals]


def test_detail_shows_a_missing_flag_as_false(spark):
    assert report.detail(evals(spark, [(1, "a", None, None, T0)])).collect()[0].is_correct is False
