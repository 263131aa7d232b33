"""Mixing sources to target weights.

Every document gets a hash-random key; within each source the documents are
ordered by key, distributed prefix sums of their token counts give each one's
place, and the mix is cut at the source's exact budget.  A budget above the
source's size repeats whole epochs first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evallens.llm.common import WORD, random_key, stored, with_position, word_count


def source_targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2),
                   cap: int = 2) -> DataFrame:
    """Targets of the sources in `sizes` (_null, _src, source_size).

    Sources in code point order, NULL last, weigh `weights` in turn and share
    `share` (a fraction) of all sizes; no target is above `cap` times its
    source's size: what is beyond goes to the others by weight, until none is
    above.  Sums are exact integers, so reruns agree to the last bit.  The
    table has one row per source; its running number is the only global order.
    """
    order = Window.orderBy("_null", "_src")
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = stored(sizes.withColumn("_weight", w), "mix-sources")
    big = lambda c: F.col(c).cast("decimal(38,0)")
    total = int(s.agg(F.sum(big("source_size"))).first()[0] or 0)
    num, den, held = 0, 1, -1
    while True:
        above = (big("source_size") * F.lit(cap * den).cast("decimal(38,0)") < F.lit(num).cast("decimal(38,0)") * F.col("_weight")) if held >= 0 else F.lit(False)
        n, capped, free = s.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, big("source_size"))), F.lit(0)),
                                F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0))).first()
        if n == held or not free:
            break
        held = n
        num, den = share[0] * total - share[1] * cap * int(capped), share[1] * int(free)
    fair = F.col("_weight") * F.lit(float(num)) / F.lit(float(den))
    return s.withColumn("target", F.least(F.col("source_size") * F.lit(float(cap)), fair)).drop("_weight")


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2), cap: int = 2,
        seed: str = "mix") -> DataFrame:
    """What the mix takes of each document: (doc_id, source, size, source_size, target, epochs, taken).

    size: words of the text (NULL: 0).  taken: words taken, repeats counted;
    a source's `taken` add up to its target, rounded to a whole word.  The one
    document at the cut gives the words up to it.  Rows without words are
    returned and give none; a NULL source is a source; repeated rows are rows of
    their own (equal keys: by id, then size, and equal rows are interchangeable).
    Only (id, source, size, key) is shuffled, in blocks of bounded size, so a
    source with a third of all rows is cut like any other.  Empty input: empty
    output.  Other columns of `docs` are not read.
    """
    return _taken(docs, weights, share, cap, seed, [])


def _taken(docs: DataFrame, weights: Sequence[int], share: tuple[int, int], cap: int, seed: str, ties: Sequence[str]) -> DataFrame:
    """`mix`, with the columns `ties` of `docs`, which order rows of equal key, id and size."""
    src = F.col("source").cast("string")
    base = stored(docs.select("doc_id", *ties, src.isNull().alias("_null"), F.coalesce(src, F.lit("")).alias("_src"),
                              word_count(F.col("text")).alias("size"), random_key(F.col("doc_id"), seed=seed).alias("_key")), "mix-docs")
    sizes = base.groupBy("_null", "_src").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, cap)
    budget = F.floor(F.col("target") + 0.5)
    targets = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)))
    targets = targets.withColumn("_rest", budget - F.col("epochs") * F.col("source_size"))
    rows = with_position(base, ["_null", "_src"], "_key", ["doc_id", "size", *ties], weight="size", extra=targets)
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_before")))
    return rows.select("doc_id", F.when(~F.col("_null"), F.col("_src")).alias("source"), "size", "source_size", "target",
                       "epochs", (F.col("epochs") * F.col("size") + part).alias("taken"), *ties)


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2), cap: int = 2,
                    seed: str = "mix") -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as it is taken.

    A document at the cut appears once more with its first words up to the
    budget, joined by single spaces.  Documents that give no word are left out.
    `docs` is stored once with a number for each row, so rows that repeat an id
    or have none are each taken for themselves (equal keys: by id, size and a
    hash of the text).  Rows without an id share one key: a source's rows of
    that kind are ordered by one task, without their texts.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # names inside cannot clash with those beside it
    rows = stored(docs.select(whole.alias("doc"), F.monotonically_increasing_id().alias("row")), "mix-rows")
    texts = rows.select("doc.doc_id", "doc.source", "doc.text", F.xxhash64("doc.text").alias("_text"), F.col("row").alias("_row"))
    plan = _taken(texts, weights, share, cap, seed, ["_text", "_row"]).where(F.col("taken") > 0)
    full = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") % F.col("size")).cast("int")
    times = F.concat(F.array_repeat(F.lit(0), full), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    out = rows.join(plan.select(F.col("_row").alias("row"), times.alias("cuts")), "row").select("doc", F.explode("cuts").alias("cut"))
    head = F.array_join(F.slice(F.regexp_extract_all(F.col("doc.text"), F.lit(f"({WORD})")), 1, F.col("cut")), " ")
    new = {"text": head, "n_chars": F.length(head)}
    value = lambda c: F.col(f"doc.`{c}`")
    return out.select(*[F.when(F.col("cut") == 0, value(c)).otherwise(new[c]).cast(docs.schema[c].dataType).alias(c) if c in new else value(c).alias(c)
                        for c in docs.columns])
