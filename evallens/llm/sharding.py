"""Sharding by balanced label propagation.

Documents with equal texts are linked through their text.  Linked documents
start evenly dealt; in each round every text counts its documents per shard,
its documents elsewhere ask to move to the shard that holds most of them, and
as many moves are granted, largest gain first, as keep every shard within its
capacity: swaps between two shards as far as both ask, the rest by free places.
Documents without links fill up what is left, so the law holds exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evallens.llm.common import random_key, stored, with_position


def _quotas(demand: dict[tuple[int, int], int], load: list[int], capacity: list[int]) -> list[tuple[int, int, int]]:
    """(from, to, moves granted): both ways alike, plus the free places of `to` in proportion to what else is asked."""
    out = []
    for to in range(len(capacity)):
        asked = {i: n for (i, j), n in demand.items() if j == to}
        swap = {i: min(n, demand.get((to, i), 0)) for i, n in asked.items()}
        free, rest = max(0, capacity[to] - load[to]), sum(asked.values()) - sum(swap.values())
        for i in sorted(asked):
            more = asked[i] - swap[i]
            if rest and more:
                give = min(more, -(-free * more // rest))
                free, rest, swap[i] = free - give, rest - more, swap[i] + give
            if swap[i]:
                out.append((i, to, swap[i]))
    return out


def shard(docs: DataFrame, shards: int = 40, rounds: int | None = None, seed: str = "shard") -> DataFrame:
    """Every row of `docs` (doc_id, text) with its shard: row counts at most one apart (law `rows`).

    Returns doc_id, size (UTF-8 bytes of the text, NULL: none, plus 16),
    text_crc32 (NULL for a NULL text), law, shard, slot (from 0 without gaps in
    each shard), grown_shard (NULL: the law is not `key`).  Equal texts are
    linked, NULL texts with nothing.  A text with more than half a shard's rows
    is cut into groups of about that size, linked within themselves.  Rounds of moves
    go on until none is granted or the rows apart from most of their group are no
    longer fewer than before (then the round before counts); `rounds` ends them
    earlier.  The choice
    depends on ids and texts only; rows that repeat an id and text are rows of
    their own.  Only hashes and counts are shuffled; the driver sees sums per
    shard and pair of shards.  Empty input: no rows.  Other columns are not read.
    """
    text = F.col("text").cast("string")
    base = stored(docs.select("doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
                              F.crc32(text).alias("text_crc32"), F.md5(text).alias("g"),
                              random_key(F.col("doc_id"), seed=seed).alias("key")), "shard-docs")
    total = base.count()
    capacity = [total // shards + (j < total % shards) for j in range(shards)]
    half = max(1, total // (2 * shards))
    groups = base.where(F.col("g").isNotNull()).groupBy("g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    groups = stored(groups, "shard-texts")
    parts = F.ceil(F.col("n") / F.lit(half))
    linked = stored(base.join(groups, "g").withColumn("part", F.pmod(F.xxhash64("key"), parts)).drop("n"), "shard-linked")
    state = stored(with_position(linked, [], "key", ["doc_id", "g"]).withColumn("shard", (F.col("_pos") % shards).cast("int")).drop("_pos"), "shard-0")

    def loads(s: DataFrame) -> list[int]:
        got = dict(s.groupBy("shard").count().collect())
        return [got.get(j, 0) for j in range(shards)]

    r, cut, before = 0, None, state
    while rounds is None or r < rounds:
        held = stored(state.groupBy("g", "part", "shard").agg(F.count(F.lit(1)).alias("c")), f"shard-held-{r}")
        # links cut: rows apart from where most of their group is
        apart = held.groupBy("g", "part").agg((F.sum("c") - F.max("c")).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        if cut is not None and apart >= cut:
            state = before
            break
        cut, before = apart, state
        best = held.groupBy("g", "part").agg(F.max(F.struct("c", F.xxhash64("g", "part", "shard").alias("h"), "shard")).alias("b"))
        asks = held.join(best, ["g", "part"]).where(F.col("b.shard") != F.col("shard")).select(
            "g", "part", "shard", F.col("b.shard").alias("to"), (F.col("b.c") - F.col("c")).alias("gain"), "c")
        asks = stored(asks, f"shard-asks-{r}")
        demand = {(i, j): n for i, j, n in asks.groupBy("shard", "to").agg(F.sum("c")).collect()}
        grants = _quotas(demand, loads(state), capacity)
        if not grants:
            break
        # Larger gains sort first, then by the random key.
        rank = F.concat(F.hex(F.greatest(F.lit(0), 15 - F.floor(F.log2(F.col("gain") + 1))).cast("long")), "key")
        movers = stored(state.join(asks.drop("c"), ["g", "part", "shard"]).withColumn("rank", rank).drop("gain"), f"shard-movers-{r}")
        quota = state.sparkSession.createDataFrame(grants, "shard int, to int, granted long")
        moved = with_position(movers, ["shard", "to"], "rank", ["doc_id", "g"], extra=quota)
        moved = moved.withColumn("shard", F.when(F.col("_pos") < F.col("granted"), F.col("to")).otherwise(F.col("shard")))
        # Rows that did not ask, and those whose pair of shards has no grant, stay.
        granted_asks = asks.join(quota, ["shard", "to"], "left_semi").select("g", "part", "shard")
        stay = state.join(granted_asks, ["g", "part", "shard"], "left_anti")
        state = stored(stay.unionByName(moved.select(stay.columns)), f"shard-{r + 1}")
        r += 1

    load = loads(state)
    ends, n = [], 0
    for j in range(shards):
        n += capacity[j] - load[j]
        ends.append(n)
    single = stored(base.join(groups, "g", "left_anti"), "shard-single")
    place = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e <= F.col("_pos"))).cast("int")
    filled = with_position(single, [], "key", ["doc_id", "g"]).withColumn("shard", place)
    out = stored(filled.drop("_pos").unionByName(state.drop("part").select(filled.drop("_pos").columns)), "shard-all")
    slots = with_position(out, ["shard"], "key", ["doc_id", "g"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                        F.col("_pos").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
