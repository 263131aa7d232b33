"""N-gram Jaccard join by vertical partitioning.

The global order of n-grams is by 64-bit hash alone.  It is cut into fragments,
and a document's set falls into one segment per fragment; frequent n-grams are
left out of the segments, not put last.

1. Fragments propose groups.  Sets of a size class are cut into k fragments with
   k above the number of n-grams in which two linked sets of the class can
   differ, so two linked sets agree on whole segments; segments are joined on
   (class, fragment, segment hash).
2. The sets that share a segment with one set form its star.  Each star is cut
   into blocks; a task takes two blocks and counts the overlap of every pair from
   their whole sets.  Fragments of FRAGMENT_GRAMS n-grams only bound that task's
   arrays, and a task with fewer has one: no partial counts are emitted per pair
   and fragment, and no Spark aggregation sums them.
   Exact counts decide; of the links a task reports the degrees and a spanning
   forest, never all pairs.
3. Links become components.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evallens.llm.common import mix64, ngram_sets, rows_with_ids, stored
from evallens.llm.components import connected_components

_U = np.uint64
CLASS_RATIO = 1.5          # largest to smallest set of a size class
SLACK = 0.3                # extra fragments, so that nearly empty segments can be left out
CELLS = 1 << 18            # cells of the n-gram count sketch (tasks get its hot cells: 256 KB)
HOT = 4                    # a cell is hot above so many times the mean
FRAGMENT_GRAMS = 1 << 15   # n-grams compared at a time when overlaps are counted
BLOCK_SETS, BLOCK_GRAMS = 512, 1 << 19


class Classes:
    """Size classes for the threshold num/den, and how their sets are cut.

    `differ`: n-grams in which two linked sets of the class can differ at most;
    `k`: fragments, `slack` more than needed; `least`: n-grams of a segment worth joining.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.low, self.k, self.slack, self.differ, self.least = [], [], [], [], []

    def _add(self) -> None:
        lo = max(self.low[-1] + 1, math.floor(self.low[-1] * CLASS_RATIO)) if self.low else 1
        hi = max(lo + 1, math.floor(lo * CLASS_RATIO))
        a, b = hi - 1, (hi - 1) * self.den // self.num
        d = (a + b) * (self.den - self.num) // (self.den + self.num)
        s = math.ceil(SLACK * (d + 1))
        mean, least = 0.9 * lo / (d + 1 + s), 1
        while sum(math.exp(-mean) * mean ** i / math.factorial(i) for i in range(least + 1)) <= 0.7 * s / (d + 1 + s):
            least += 1
        self.low.append(lo)
        self.differ.append(d)
        self.slack.append(s)
        self.k.append(d + 1 + s)
        self.least.append(least)

    def of(self, n: int) -> list[int]:
        """The classes in which a set of n n-grams is cut: that of its own size, and
        those below if a linked set may be the smaller one there."""
        if n == 0:
            return []
        while not self.low or self.low[-1] <= n:
            self._add()
        own = next(i for i in range(len(self.low) - 1, -1, -1) if self.low[i] <= n)
        out = [own]
        i = own - 1
        while i >= 0 and (self.low[i + 1] - 1) * self.den >= n * self.num:
            out.append(i)
            i -= 1
        return [i for i in out if self.differ[i] > 0]


def _cells(grams: np.ndarray) -> np.ndarray:
    return (mix64(grams ^ _U(0xA0761D6478BD642F)) % _U(CELLS)).astype(np.int64)


def _cut(grams: np.ndarray, k: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(join key, n-grams) of each of the k segments of a sorted set."""
    total = np.concatenate([np.zeros(1, _U), np.cumsum(mix64(grams ^ _U(0x5851F42D4C957F2D)), dtype=_U)])
    at = np.searchsorted((grams >> _U(32)) * _U(k) >> _U(32), np.arange(k + 1, dtype=_U))
    count = np.diff(at)
    key = mix64(total[at[1:]] - total[at[:-1]] + count.astype(_U) * _U(0xD6E8FEB86659FD93))
    return mix64(key ^ mix64(_U(salt << 32) + np.arange(k, dtype=_U))), count


def segments(grams: np.ndarray, classes: Classes, hot: np.ndarray) -> np.ndarray:
    """Join keys of a set (sorted hashes): one per class, fragment and segment content.

    Two linked sets agree on more than `slack` segments of a common class, also
    if hot n-grams are left out of both.  A segment with fewer than `least`
    n-grams is weak.  If one of the two sets has at most `slack` weak segments,
    they agree on one that is not, and both sets join on it.  A set with more
    weak ones is also cut with its hot n-grams, and there, if it still has more
    weak ones than `slack`, joins on these too; two such sets meet there.
    """
    out, rare = [], grams[~hot[_cells(grams)]]
    for i in classes.of(len(grams)):
        key, count = _cut(rare, classes.k[i], 2 * i)
        strong = count >= classes.least[i]
        out.append(key[strong])
        if (~strong).sum() > classes.slack[i]:
            key, count = _cut(grams, classes.k[i], 2 * i + 1)
            strong = count >= classes.least[i]
            out.append(key if (~strong).sum() > classes.slack[i] else key[strong])
    return np.concatenate(out) if out else np.zeros(0, _U)


def hot_cells(docs: DataFrame, n: int) -> np.ndarray:
    """Cells of a hash of all documents' n-grams that are hit more than HOT times the mean.

    The counts are exact sums over all documents; which cells are hot changes only
    how fast pairs are found, never which.  Tasks give one block of counts for each
    part of the sketch, summed in two steps, so the driver sees the sketch once.
    """
    width = 4096

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(CELLS, dtype=np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                grams = list(ngram_sets(b.slice(lo, 512).column("text"), n))
                total += np.bincount(_cells(np.concatenate(grams)), minlength=CELLS)
        blocks = CELLS // width
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(blocks), pa.int32()), pa.array([TaskContext.get().partitionId() // 64] * blocks, pa.int32()),
             pa.ListArray.from_arrays(pa.array(np.arange(blocks + 1) * width, pa.int32()), pa.array(total))],
            names=["block", "part", "counts"])

    def add(t: pa.Table) -> pa.Table:
        c = t.column("counts").combine_chunks()
        total = np.asarray(c.flatten()).reshape(len(c), width).sum(axis=0)
        return pa.table({"block": t.column("block")[:1], "part": t.column("part")[:1], "counts": pa.array([total], pa.list_(pa.int64()))})

    schema = "block int, part int, counts array<long>"
    parts = docs.select("text").mapInArrow(count, schema).groupBy("block", "part").applyInArrow(add, schema)
    rows = parts.groupBy("block").applyInArrow(add, schema).collect()
    total = np.zeros((CELLS // width, width), dtype=np.int64)
    for r in rows:
        total[r.block] = r.counts
    return total.ravel() > HOT * max(1.0, total.mean())


def _digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def shingle_table(docs: DataFrame, n: int, num: int, den: int, hot: np.ndarray) -> DataFrame:
    """(doc_id, n_shingles, digest, keys): the size and 128-bit digest of each row's set, and its segments' join keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes(num, den)
        for b in batches:
            step = 512
            for lo in range(0, b.num_rows, step):
                part = b.slice(lo, step)
                size, digest, keys, ends = [], [], [], [0]
                for g in ngram_sets(part.column("text"), n):
                    size.append(len(g))
                    digest.append(_digest(g))
                    keys.append(segments(g, classes, hot))
                    ends.append(ends[-1] + len(keys[-1]))
                flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(digest, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                    names=["doc_id", "n_shingles", "digest", "keys"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, digest binary, keys array<long>")


def _stars(keys: DataFrame) -> DataFrame:
    """(star, rep): sets with a common key, from (rep, keys), around the least of them.

    Rows (key, set) are shuffled once and sorted; a task streams over them, so a
    key held by very many sets takes no memory.  Two sets that share a key are
    in one star at least.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = first = None
        for batch in batches:
            k, rep = batch.column("k").to_numpy(), batch.column("rep").to_numpy()
            if not len(k):
                continue
            new = np.concatenate([[last is None or k[0] != last], k[1:] != k[:-1]])
            start = np.maximum.accumulate(np.where(new, np.arange(len(k)), -1))
            lead = np.where(start < 0, 0 if first is None else first, rep[start])
            pairs = np.unique(np.column_stack([lead, rep])[lead != rep], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["star", "rep"])
            last, first = int(k[-1]), int(lead[-1])

    dealt = keys.select(F.explode("keys").alias("k"), "rep").repartition("k").sortWithinPartitions("k", "rep")
    found = stored(dealt.mapInArrow(run, "star long, rep long").distinct(), "ngram-stars")
    return found.unionByName(found.select("star", F.col("star").alias("rep")).distinct())


def _size_class(n, num: int, den: int):
    """Sets whose sizes differ by no more than the threshold are in equal or neighbouring classes."""
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(den / num))).cast("int")


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Overlap of every pair of sets of two lists, counted in this task, FRAGMENT_GRAMS n-grams or so at a time."""
    total = np.zeros((len(a), len(b)), dtype=np.int64)
    if not a or not b:  # a block without sets
        return total
    fragments = 1 + sum(map(len, a + b)) // FRAGMENT_GRAMS
    cuts = np.arange(1, fragments, dtype=_U) * _U(((1 << 64) - 1) // fragments)
    at_a = [np.concatenate([[0], np.searchsorted(x, cuts), [len(x)]]) for x in a]
    at_b = [np.concatenate([[0], np.searchsorted(x, cuts), [len(x)]]) for x in b]
    for f in range(fragments):
        sa = [x[p[f]:p[f + 1]] for x, p in zip(a, at_a)]
        sb = [x[p[f]:p[f + 1]] for x, p in zip(b, at_b)]
        ta, tb = np.concatenate(sa), np.concatenate(sb)
        common = np.intersect1d(ta, tb)
        if not len(common):
            continue
        ra, rb = np.repeat(np.arange(len(a)), [len(x) for x in sa]), np.repeat(np.arange(len(b)), [len(x) for x in sb])
        ka, kb = np.searchsorted(common, ta), np.searchsorted(common, tb)
        ia, ib = ka < len(common), kb < len(common)
        ia[ia] = common[ka[ia]] == ta[ia]
        ib[ib] = common[kb[ib]] == tb[ib]
        width = 4096  # columns of the 0/1 matrices at a time
        ka, ra, kb, rb = ka[ia], ra[ia], kb[ib], rb[ib]
        for lo in range(0, len(common), width):
            w = min(width, len(common) - lo)
            pa_, pb_ = (ka >= lo) & (ka < lo + w), (kb >= lo) & (kb < lo + w)
            ma, mb = np.zeros((len(a), w), np.float32), np.zeros((len(b), w), np.float32)
            ma[ra[pa_], ka[pa_] - lo] = 1
            mb[rb[pb_], kb[pb_] - lo] = 1
            total += (ma @ mb.T).astype(np.int64)
    return total


def local_roots(linked: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Least value of `first` reachable by the symmetric boolean matrix `linked`, per row."""
    root = first.copy()
    while len(root):
        new = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == root).all():
            break
        root = new
    return root


def _links(blocks: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Per pair of blocks: (rep, n_links, root), links counted with the copies of each set."""

    def run(t: pa.Table) -> pa.Table:
        sets, rows, seen = [], [], set()
        marks = zip(t.column("side").to_pylist(), t.column("rep").to_pylist(), t.column("digest").to_pylist())
        for i, (g, mark) in enumerate(zip(ngram_sets(t.column("text"), n), marks)):
            if mark not in seen and _digest(g) == mark[2]:  # rows that repeat an id
                seen.add(mark)
                sets.append(g)
                rows.append(i)
        side, rep, copies = (t.column(c).to_numpy()[rows] for c in ("side", "rep", "copies"))
        size = np.array([len(s) for s in sets], dtype=np.int64)
        x, y = np.flatnonzero(side < 2), np.flatnonzero(side != 1)  # side 0: both
        m = _overlaps([sets[i] for i in x], [sets[i] for i in y])
        ok = (den * m >= num * (size[x][:, None] + size[y][None, :] - m)) & (rep[x][:, None] != rep[y][None, :])
        linked = np.zeros((len(rep), len(rep)), dtype=bool)
        linked[np.ix_(x, y)] = ok
        linked |= linked.T
        keep = linked.any(axis=1)
        rep, linked, copies = rep[keep], linked[np.ix_(keep, keep)], copies[keep]
        # A pair is counted in the first star that holds both.
        star, earlier = t.column("star")[0].as_py(), {}
        stars = t.column("stars").to_pylist()
        for at, i in enumerate(np.array(rows)[keep]):
            for s in stars[i]:
                if s < star:
                    earlier.setdefault(s, []).append(at)
        counted = linked.copy()
        for at in earlier.values():
            counted[np.ix_(at, at)] = False
        return pa.table({"rep": rep, "n_links": counted.astype(np.int64) @ copies, "root": local_roots(linked, rep)})

    return blocks.groupBy("star", "ca", "ba", "cb", "bb").applyInArrow(run, "rep long, n_links long, root long")


def ngram_join(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """Documents whose sets of n-word shingles have a Jaccard similarity of num/den or more.

    Returns one row per row of `docs` (doc_id, text): doc_id, n_shingles,
    component_id (the least doc_id reachable by links, itself included), n_links
    (other rows linked directly, copies included).  Texts are lower-cased (A-Z)
    and cut at white space; fewer than n words are one shingle; NULL text or no
    words: no shingles, no links.  A NULL doc_id links with nothing and has no
    component.  Rows that repeat a doc_id are one document.  Equal sets are
    joined once and counted as copies.  Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = stored(shingle_table(docs, n, num, den, hot_cells(docs, n)), "ngram-sets")
    usable = table.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    groups = stored(usable.groupBy("n_shingles", "digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "ngram-groups")
    member = stored(usable.select("doc_id", "n_shingles", "digest").join(groups, ["n_shingles", "digest"])
                    .select("doc_id", "digest", "rep", "copies"), "ngram-members")
    # One set per digest is joined.  The copies' ids are broadcast if Spark finds their table small.
    copies = stored(member.groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("rep")).alias("first")).where(~F.col("first")).select("doc_id"), "ngram-copies")
    keys = usable.select("doc_id", "keys").join(copies, "doc_id", "left_anti").withColumnRenamed("doc_id", "rep")
    stars = _stars(keys)
    centres = stars.groupBy("rep").agg(F.sort_array(F.collect_list("star")).alias("stars"))  # at most one per key of the set
    # The stars' sets, in blocks of bounded size by size class.
    one = stored(groups.join(stars, "rep").join(centres, "rep"), "ngram-star-sets")
    # A star that fits one block is one task; in others only neighbouring size classes are compared.
    whole = one.groupBy("star").agg(((F.count(F.lit(1)) <= BLOCK_SETS) & (F.sum("n_shingles") <= BLOCK_GRAMS)).alias("fits"))
    one = one.join(whole, "star").withColumn("c", F.when(F.col("fits"), 0).otherwise(_size_class(F.col("n_shingles"), num, den))).drop("fits")
    load = one.groupBy("star", "c").agg(F.count(F.lit(1)).alias("sets"), F.sum("n_shingles").alias("grams"))
    cut = load.select("star", "c", "sets", F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    below = cut.select("star", (F.col("c") + 1).alias("c"), F.col("blocks").alias("blocks_below"))
    above = cut.select("star", (F.col("c") - 1).alias("c"), F.col("blocks").alias("blocks_above"))
    plan = (one.join(cut, ["star", "c"]).join(below, ["star", "c"], "left").join(above, ["star", "c"], "left")
            .withColumns({"block": F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"), "nobody": F.lit(0)}))
    span = lambda c: F.when(F.coalesce(F.col(c), F.lit(0)) > 0, F.sequence(F.lit(0), F.col(c) - 1)).otherwise(F.array().cast("array<int>"))
    task = lambda ca, ba, cb, bb, side: F.struct(ca.alias("ca"), ba.alias("ba"), cb.alias("cb"), bb.alias("bb"), side.alias("side"))
    c, blk, zero, one_, two = F.col("c"), F.col("block"), F.lit(0), F.lit(1), F.lit(2)
    # A set alone in its class has nobody there to be compared with.
    own = F.transform(F.when(F.col("sets") > 1, span("blocks")).otherwise(span("nobody")), lambda j: F.when(j == blk, task(c, blk, c, blk, zero))
                      .when(j > blk, task(c, blk, c, j, one_)).otherwise(task(c, j, c, blk, two)))
    up = F.transform(span("blocks_above"), lambda j: task(c, blk, c + 1, j, one_))
    down = F.transform(span("blocks_below"), lambda j: task(c - 1, j, c, blk, two))
    plan = plan.select("rep", "digest", "copies", "stars", "star", F.explode(F.concat(own, up, down)).alias("t"))
    plan = plan.select("rep", "digest", "copies", "stars", "star", "t.*")
    texts = rows_with_ids(docs.withColumnRenamed("doc_id", "rep"), "rep", one.select("rep").distinct())
    blocks = plan.join(texts, "rep").select("star", "ca", "ba", "cb", "bb", "side", "rep", "digest", "copies", "stars", "text")
    links = stored(_links(blocks, n, num, den), "ngram-links")
    same = member.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("a")).where(F.col("a") != F.col("b")).select("a", "b")
    found = links.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(same)
    comp = connected_components(found)
    degree = links.groupBy("rep").agg(F.sum("n_links").alias("links"))
    by_rep = groups.select("rep").distinct().join(comp.withColumnRenamed("node", "rep"), "rep", "left").join(degree, "rep", "left")
    placed = member.join(by_rep, "rep").select(
        "doc_id", "digest", F.coalesce("component", "rep").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    placed = placed.dropDuplicates(["doc_id", "digest"])
    out = table.drop("keys").join(placed, ["doc_id", "digest"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
