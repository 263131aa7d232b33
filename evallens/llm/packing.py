"""Packing by optimal length buckets.

A histogram of sequence lengths is pre-aggregated over all data; dynamic
programming on it picks the bucket boundaries with the least padding; within a
bucket, sequences in random order form batches of a fixed token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evallens.llm.common import random_key, stored, with_position, word_count


def best_boundaries(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """Upper boundaries of at most `buckets` buckets with the least padding.

    `histogram`: (length, sequences).  Exact, by dynamic programming over the
    distinct lengths; of equally good cuts the one with the shorter lower buckets.
    """
    h = sorted((int(n), int(c)) for n, c in histogram if c > 0)
    if not h:
        return []
    length, count = (np.array(x, dtype=np.int64) for x in zip(*h))
    seqs, tokens = (np.concatenate([[0], np.cumsum(x)]) for x in (count, length * count))
    u = len(h)

    def padding(j: int) -> np.ndarray:
        """Of lengths i..j in one bucket, for i from 0 to j."""
        return length[j] * (seqs[j + 1] - seqs[:j + 1]) - (tokens[j + 1] - tokens[:j + 1])

    best, cuts = np.array([padding(j)[0] for j in range(u)]), []
    for _ in range(min(buckets, u) - 1):  # memory: one number per length and bucket
        cut, new = np.zeros(u, dtype=np.int64), np.zeros(u, dtype=np.int64)
        for j in range(u):
            total = padding(j)
            total[1:] += best[:j]
            cut[j] = total.argmin()
            new[j] = total[cut[j]]
        cuts.append(cut)
        best = new
    out, j = [], u
    for cut in [*reversed(cuts), np.zeros(u, dtype=np.int64)]:
        out.append(int(length[j - 1]))
        j = int(cut[j - 1])
        if j == 0:
            break
    return out[::-1]


def pack(docs: DataFrame, max_tokens: int = 2048, buckets: int = 8, batch_tokens: int = 1 << 14, seed: str = "pack",
         length=None) -> DataFrame:
    """Batches of sequences of like length: one row per sequence.

    A document is cut into sequences of `max_tokens` tokens and a shorter last
    one.  Returns doc_id, piece (from 0), n_tokens, bucket (from 0), bucket_len
    (its boundary, to which its sequences are padded), batch (from 0 in each
    bucket), place (from 0 in each batch).  A batch holds as many sequences as
    fit `batch_tokens` padded tokens, one at least.  `length`: a column of token counts
    (default: words).  Documents without tokens give one row without a bucket.
    The histogram has at most `max_tokens` rows, which bounds what the driver
    sees.  NULL text: no tokens; rows that repeat an id are packed each on their own;
    empty input: no rows.  Other columns are not read.
    """
    n = word_count(F.col("text")) if length is None else F.coalesce(length.cast("long"), F.lit(0).cast("long"))
    full = F.lit(max_tokens).cast("long")
    rows = docs.select("doc_id", n.alias("_n"))
    pieces = rows.select("doc_id", "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / full)))).alias("piece"))
    pieces = pieces.select("doc_id", "piece", F.least(full, F.col("_n") - F.col("piece") * full).alias("n_tokens"))
    pieces = stored(pieces.withColumn("_key", random_key(F.col("doc_id"), F.col("piece"), seed=seed)), "pack-pieces")
    some = pieces.where(F.col("n_tokens") > 0)
    ends = best_boundaries([tuple(r) for r in some.groupBy("n_tokens").count().collect()], buckets)
    below = F.array(*[F.lit(e).cast("long") for e in ends]) if ends else F.array().cast("array<bigint>")
    bucket = F.size(F.filter(below, lambda e: e < F.col("n_tokens"))).cast("int")
    some = some.withColumn("bucket", bucket).withColumn("bucket_len", F.try_element_at(below, F.col("bucket") + 1))
    per = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(batch_tokens) / F.col("bucket_len")))
    placed = with_position(some, ["bucket"], "_key", ["doc_id", "piece", "n_tokens"]).select(
        "doc_id", "piece", "n_tokens", "bucket", "bucket_len", F.floor(F.col("_pos") / per).alias("batch"), (F.col("_pos") % per).alias("place"))
    none = pieces.where(F.col("n_tokens") == 0).select(
        "doc_id", "piece", "n_tokens", *[F.lit(None).cast(placed.schema[c].dataType).alias(c) for c in ("bucket", "bucket_len", "batch", "place")])
    return placed.unionByName(none)
