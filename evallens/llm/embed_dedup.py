"""Near-duplicate vectors by random-hyperplane signs in several tables, exact cosines and connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evallens.llm.common import stored
from evallens.llm.components import connected_components
from evallens.llm.ngram_join import local_roots
from evallens.llm.vectors import matrix, usable

BLOCK_ROWS, PACK_ROWS = 1024, 8192


def plan_tables(rows: int, cosine: float, miss: float) -> tuple[int, int]:
    """(bits per table, tables): bits grow with the logarithm of the rows, so that
    unrelated vectors seldom share a bucket; tables grow until a pair at the
    threshold shares no bucket with a chance below `miss`."""
    bits = min(48, max(8, math.ceil(math.log2(max(rows, 2))) + 2))
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - agree))


def _signatures(reps: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        power = (1 << np.arange(bits)).astype(np.int64)
        for b in batches:
            lists = b.column("embedding")
            dims = np.diff(np.asarray(lists.offsets))
            sig = np.zeros((b.num_rows, tables), dtype=np.int64)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                if int(d) not in planes:
                    planes[int(d)] = np.random.default_rng([seed, int(d)]).standard_normal((int(d), tables * bits))
                for lo in range(0, len(at), 1024):
                    own = at[lo:lo + 1024]
                    side = (matrix(lists.take(pa.array(own))) @ planes[int(d)] > 0).reshape(len(own), tables, bits)
                    sig[own] = side @ power
            flat = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * tables, pa.int32()), pa.array(sig.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("label"), b.column("copies"), lists, flat],
                                             names=["rep", "label", "copies", "embedding", "sigs"])

    cols = reps.select("rep", "label", "copies", "embedding")
    return cols.mapInArrow(run, T.StructType([*cols.schema.fields, T.StructField("sigs", T.ArrayType(T.LongType()))]))


def near_links(bucket: np.ndarray, table: np.ndarray, side: np.ndarray, rep: np.ndarray, copies: np.ndarray,
               x: np.ndarray, sigs: np.ndarray, cosine: float):
    """(rep, n_links, root) of the links inside each bucket whose first common table is the bucket's."""
    unit = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    order = np.argsort(bucket, kind="stable")
    out = []
    for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        a, b = own[side[own] < 2], own[side[own] != 1]  # side 0: both
        cos = unit[a] @ unit[b].T
        ok = (cos >= cosine) & (rep[a][:, None] != rep[b][None, :])
        for t in range(int(table[own[0]])):  # met before in an earlier table
            if not ok.any():
                break
            ok &= sigs[a, t][:, None] != sigs[b, t][None, :]
        if not ok.any():
            continue
        place = {int(v): i for i, v in enumerate(own)}
        linked = np.zeros((len(own), len(own)), dtype=bool)
        linked[np.ix_([place[int(v)] for v in a], [place[int(v)] for v in b])] = ok
        linked |= linked.T
        keep = linked.any(axis=1)
        own, linked = own[keep], linked[np.ix_(keep, keep)]
        out.append((rep[own], linked.astype(np.int64) @ copies[own], local_roots(linked, rep[own])))
    if not out:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    return tuple(np.concatenate(z) for z in zip(*out))


def embedding_dedup(vectors: DataFrame, cosine: float = 0.98, miss: float = 1e-5, seed: int = 11) -> DataFrame:
    """Vectors (vec_id, embedding, label) of one label with a cosine of `cosine` or more, linked and grouped.

    Returns one row per row: vec_id, n_links (other rows linked directly, copies
    included), component_id (least vec_id reachable, itself included), kept
    (vec_id = component_id).  A pair at the threshold is missed with a chance of
    at most `miss`; no pair below it is linked.  Equal vectors of a label are
    hashed once and counted as copies; a bucket is cut into blocks and compared
    block by block, and a task returns degrees and a spanning forest, not pairs.
    NULL label, or vectors that are NULL, zero or hold NULL or non-finite components:
    no links.  A NULL vec_id links with nothing and has no component (kept:
    false).  Rows that repeat a vec_id are one vector.  Other columns are not read.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding"))
    live = rows.where(ok)
    reps = stored(live.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "near-reps")
    bits, tables = plan_tables(reps.count(), cosine, miss)
    signed = stored(_signatures(reps, bits, tables, seed), "near-signatures")
    # Buckets with two vectors or more, found on ids and hashes alone.
    dim = F.size("embedding").alias("dim")
    entry = signed.select("rep", "label", dim, F.posexplode("sigs").alias("t", "s"))
    entry = entry.withColumn("bucket", F.xxhash64("label", "dim", "t", "s")).select("rep", "label", "t", "bucket")
    sizes = entry.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1)
    met = stored(entry.join(sizes, "bucket"), "near-buckets")
    packs = max(1, -(-met.count() // PACK_ROWS))
    met = met.withColumn("blocks", F.ceil(F.col("c") / BLOCK_ROWS).cast("int"))
    blk = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("blocks")).cast("int")
    task = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    tasks = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.when(j == blk, task(blk, blk, 0)).when(
        j > blk, task(blk, j, 1)).otherwise(task(j, blk, 2)))
    pack = F.when(F.col("blocks") == 1, F.pmod(F.col("bucket"), F.lit(packs))).otherwise(F.col("bucket"))
    met = met.select("rep", "label", "t", "bucket", (F.col("blocks") > 1).alias("big"), pack.alias("pack"), F.explode(tasks).alias("k"))
    met = met.select("rep", "label", "t", "bucket", "big", "pack", "k.*")

    def run(t: pa.Table) -> pa.Table:
        dims = t.column("dim").to_numpy()
        parts = []
        for d in np.unique(dims):
            own = t.filter(pa.array(dims == d))
            get = lambda c, own=own: own.column(c).to_numpy()
            sigs = np.asarray(own.column("sigs").combine_chunks().flatten()).reshape(own.num_rows, -1)
            parts.append(near_links(get("bucket"), get("t"), get("side"), get("rep"), get("copies"),
                                    matrix(own.column("embedding")), sigs, cosine))
        r, n, root = (np.concatenate(z) for z in zip(*parts))
        return pa.table({"rep": r, "n_links": n, "root": root})

    full = signed.select("rep", "label", "copies", "embedding", "sigs", dim)
    links = met.join(full, ["rep", "label"]).groupBy("big", "pack", "i", "j").applyInArrow(run, "rep long, n_links long, root long")
    links = stored(links, "near-links")
    member = stored(live.join(reps, ["label", "embedding"]).select("vec_id", "rep", "copies"), "near-members")
    same = member.groupBy("vec_id").agg(F.min("rep").alias("b"), F.max("rep").alias("a")).where(F.col("a") != F.col("b")).select("a", "b")
    found = links.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(same)
    comp = connected_components(found).withColumnRenamed("node", "rep")
    degree = links.groupBy("rep").agg(F.sum("n_links").alias("links"))
    placed = (member.join(comp, "rep", "left").join(degree, "rep", "left")
              .groupBy("vec_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"),
                                     F.max(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = rows.select("vec_id").join(placed, "vec_id", "left")
    comp_id = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"),
                      F.coalesce(F.col("vec_id") == comp_id, F.lit(False)).alias("kept"))
