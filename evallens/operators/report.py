"""Evaluation report (job D): counts, rates, distribution, feedback words, detail.

All outputs are DataFrames; charts are drawn by whatever tool reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evallens.functions.text import tokens
from evallens.schemas import STOPWORDS, TOP_WORDS_K
from evallens.sources.evaluations import as_bool


def counts(evals: DataFrame, *by: str) -> DataFrame:
    """The mergeable part of the summary: all rows and the correct ones, optionally by some columns."""
    aggs = (F.count(F.lit(1)).alias("total_evaluations"), F.count_if(as_bool(F.col("is_correct"))).alias("correct_answers"))
    return evals.groupBy(*by).agg(*aggs) if by else evals.agg(*aggs)


def merged_counts(parts: DataFrame) -> DataFrame:
    """One row of counts from those of several parts; none from no parts."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return parts.agg(total("total_evaluations"), total("correct_answers"))


def summary_of(merged: DataFrame) -> DataFrame:
    """A1-A4 from a row of counts; no row if nothing was counted."""
    total = F.col("total_evaluations")
    correct = F.col("correct_answers")
    incorrect = (total - correct).alias("incorrect_answers")
    return merged.where(total > 0).select(
        total, correct, incorrect,
        (correct.cast("double") / total * F.lit(100.0)).alias("correct_pct"),
        ((total - correct).cast("double") / total * F.lit(100.0)).alias("incorrect_pct"),
    )


def summary(evals: DataFrame) -> DataFrame:
    """A1-A4: total, correct, incorrect and their shares in percent.

    One global aggregate (partial counts per task, one tiny final merge).  An
    empty table yields no row, as the reference shows no block then.
    """
    return summary_of(counts(evals))


def format_pct(pct) -> F.Column:
    """Display form `f"{x:.2f}%"`: the double's exact binary value, half to even.

    A percentage scaled by a power of two is a whole number exactly, so the
    hundredths and the remainder are exact integers (below 1/16 a larger scale is
    needed for that).
    """
    def hundredths(bits: int) -> F.Column:
        one = F.lit(1 << bits).cast("decimal(20,0)")
        v = (pct * F.lit(float(1 << bits))).cast("long").cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
        q = ((v - v % one) / one).cast("long")
        twice = (v % one) * F.lit(2).cast("decimal(1,0)")
        return q + F.when((twice > one) | ((twice == one) & (q % 2 == 1)), 1).otherwise(0)

    h = F.when(pct >= 0.0625, hundredths(56)).otherwise(hundredths(60))
    return F.concat(F.floor(h / 100).cast("string"), F.lit("."), F.lpad((h % 100).cast("string"), 2, "0"), F.lit("%"))


def summary_display(evals: DataFrame) -> DataFrame:
    """The three metric tiles: counts with their rates as text."""
    return summary(evals).select(
        "total_evaluations", "correct_answers", "incorrect_answers",
        format_pct(F.col("correct_pct")).alias("correct_rate"),
        format_pct(F.col("incorrect_pct")).alias("incorrect_rate"))


def distribution_of(summary: DataFrame) -> DataFrame:
    """A5 from a summary: always both classes, zero included (a plain groupBy would drop one)."""
    return summary.select(F.expr("stack(2, 'Correct', correct_answers, 'Incorrect', incorrect_answers) AS (outcome, n)"))


def distribution(evals: DataFrame) -> DataFrame:
    return distribution_of(summary(evals))


def _tokens(df: DataFrame, text_col: str, id_col: str, stopwords) -> DataFrame:
    toks = (df.where(F.col(text_col).isNotNull())
              .select(F.col(id_col).alias("_id"), F.posexplode(tokens(text_col)).alias("_pos", "word")))
    return toks.where(~F.col("word").isin(list(stopwords))) if stopwords else toks


def word_counts(df: DataFrame, text_col: str = "user_feedback", id_col: str = "evaluation_id",
                stopwords=STOPWORDS) -> DataFrame:
    """Frequency of each non-stop-word, and the id of the first row that holds it.

    Tokenising row by row equals tokenising the space-joined text, since a
    space never belongs to a token.  Both are hash aggregates combined
    map-side, so a very frequent word is one row per task before the shuffle.
    """
    return _tokens(df, text_col, id_col, stopwords).groupBy("word").agg(
        F.count(F.lit(1)).alias("frequency"), F.min("_id").alias("first_id"))


def placed_words(df: DataFrame, text_col: str, id_col: str, stopwords, *by: F.Column) -> DataFrame:
    """A6 with each word's first row and place in it, by some more columns: counts that merge.

    `first` is (none, id, pos); rows without an id come after all others.
    """
    toks = df.where(F.col(text_col).isNotNull()).select(*by, F.col(id_col).cast("long").alias("_id"), F.posexplode(tokens(text_col)).alias("_pos", "word"))
    toks = toks.where(~F.col("word").isin(list(stopwords))) if stopwords else toks
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_pos").alias("pos")))
    names = [c for c in toks.columns if c not in ("_id", "_pos")]
    return toks.groupBy(*names).agg(F.count(F.lit(1)).alias("frequency"), first.alias("first"))


def top_words(df: DataFrame, k: int = TOP_WORDS_K, text_col: str = "user_feedback",
              id_col: str = "evaluation_id", stopwords=STOPWORDS) -> DataFrame:
    """A6 + O2: `Counter(words).most_common(k)`; ties keep first-seen order.

    Rows are seen by id, those without one after all others.  Words are counted by
    (frequency, first row); `orderBy(...).limit(k)` plans as
    TakeOrderedAndProject.  Only words that tie in both at the cut are told apart
    by their place in the row, so positions are looked up in the rows the top
    words first occur in (at most k, and the rows without an id if a top word is in
    no other), never kept per token.
    """
    counts = word_counts(df, text_col, id_col, stopwords)
    top = counts.orderBy(F.desc("frequency"), F.asc_nulls_last("first_id")).limit(k)
    # every word of a (frequency, first row) pair among the top k
    pairs = F.broadcast(top.select(F.col("frequency").alias("_f"), F.col("first_id").alias("_first")).distinct())
    tied = counts.join(pairs, (F.col("frequency") == F.col("_f")) & F.col("first_id").eqNullSafe(F.col("_first")), "left_semi")
    ids = F.broadcast(top.select(F.col("first_id").alias("_first")).distinct())
    rows = df.join(ids, F.col(id_col).eqNullSafe(F.col("_first")), "left_semi")
    place = _tokens(rows, text_col, id_col, stopwords).groupBy("_id", F.col("word").alias("_word")).agg(F.min("_pos").alias("_pos"))
    order = [F.desc("frequency"), F.asc_nulls_last("first_id"), F.asc("_pos"), F.asc("word")]
    final = tied.join(place, F.col("first_id").eqNullSafe(F.col("_id")) & (F.col("word") == F.col("_word"))).orderBy(*order).limit(k)
    # k rows only: a global window over them is free.
    return final.select(F.row_number().over(Window.orderBy(*order)).alias("rank"), "word", "frequency")


def detail(evals: DataFrame) -> DataFrame:
    """P13 + O1: the five columns in time order (NULL times last).

    Sorting is a range shuffle; page through it with `limit`, never collect.
    """
    return (evals.select("evaluation_id", "task_id", as_bool(F.col("is_correct")).alias("is_correct"), "user_feedback",
                         "evaluation_timestamp")
                 .orderBy(F.col("evaluation_timestamp").asc_nulls_last(), F.col("evaluation_id")))


def evaluation_report(evals: DataFrame, k: int = TOP_WORDS_K, max_bins: int = 30) -> dict[str, DataFrame]:
    """Job D in one call: every block of the report as a DataFrame.

    All are lazy but the histogram, whose counted times are written to the
    shared folder when the report is built.
    """
    from evallens.operators import gaps

    return {
        "summary": summary(evals),
        "distribution": distribution(evals),
        "top_words": top_words(evals, k=k),
        "mean_gap": gaps.mean_gap(evals),
        "histogram": gaps.gap_histogram(evals, max_bins=max_bins),
        "detail": detail(evals),
    }


def first_row(df: DataFrame, order_by: str) -> DataFrame:
    """S12 `SELECT TOP 1 *`, made deterministic by an order key."""
    return df.orderBy(F.col(order_by).asc_nulls_last()).limit(1)
