"""Prefix trie of conversations, built from z-fast tries.

1. A conversation is the sequence of its turns' hashes; each prefix has a digest
   that chains them (`prefixes`).  Conversations are cut into pieces of at most
   PIECE turns, each rooted at the digest of what comes before, so no task ever
   holds a whole long conversation.
2. Pieces are range-partitioned by their prefixes at depths 1, 2, 4, 8, 16, then by
   id: those that share much lie together, and a prefix shared by very many is
   split all the same.
3. Each task keeps a z-fast trie (`ZFastTrie`): its compacted nodes are hashed
   under the prefix at their two-fattest depth.  Pieces come in batches: fat binary
   search finds each one's exit node, then the batch is inserted there.  A
   trie of NODES turns is expanded, edge by edge, into one row per depth.
4. Rows of one node from several tries are merged by digest, as sums and least ids.
5. A node belongs to its least conversation, which then also owns all deeper nodes
   of its path.  Sums over subtrees are running sums along what a conversation
   owns, plus the totals of the conversations that branch off below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evallens.llm.common import stored

PIECE = 1024       # turns of a piece
BATCH = 2048       # pieces inserted at a time
NODES = 1 << 17    # turns a trie takes before it is expanded
WIDTH = 16         # bytes of a digest
TOP = bytes(WIDTH)  # digest of no turns
KEYS = (1, 2, 4, 8, 16)
RUN = 1 << 12      # ids written as one string
PIECES_PER_TASK = 1 << 17


def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] that the highest power of two divides."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


class _Path:
    """A piece: the digests of its prefixes at depths start + 1 to `end`, and the bytes of each one's last turn."""

    __slots__ = ("conv", "start", "root", "blob", "bytes", "end")

    def __init__(self, conv: int, start: int, root: bytes, blob: bytes, sizes):
        self.conv, self.start, self.root, self.blob, self.bytes = conv, start, root, blob, sizes
        self.end = start + len(blob) // WIDTH

    def at(self, depth: int) -> bytes:
        """Digest of the first `depth` turns."""
        i = depth - self.start
        return self.blob[WIDTH * (i - 1):WIDTH * i] if i else self.root

    def below(self, depth: int) -> _Path:
        """The part from `depth` on, so that a node keeps no more than that."""
        i = depth - self.start
        return _Path(self.conv, depth, self.at(depth), self.blob[WIDTH * i:], self.bytes[i:])


class _Node:
    """A compacted node: the depths (low, high] of `path`, where all that pass stay together."""

    __slots__ = ("low", "high", "path", "up", "count", "least")

    def __init__(self, low: int, high: int, path: _Path, up):
        self.low, self.high, self.path, self.up, self.count, self.least = low, high, path, up, 0, None


class ZFastTrie:
    def __init__(self):
        self.roots, self.handles, self.first, self.nodes, self.size = {}, {}, {}, [], 0

    def _root(self, p: _Path) -> _Node:
        if p.root not in self.roots:
            self.roots[p.root] = _Node(p.start, p.start, p, None)
        return self.roots[p.root]

    def locate(self, p: _Path, known: _Node | None = None) -> tuple[_Node, _Node | None]:
        """(the deepest node whose whole extent the path passes, the exit node below it or None).

        `known`: a node that the path is known to pass.
        """
        passed = known or self._root(p)
        a, b, last = passed.high, p.end, passed
        while a < b:
            f = two_fattest(a, b)
            hit = self.handles.get(p.at(f))
            if hit is None:
                b = f - 1
            else:
                last, a = hit, hit.high
        if last is passed or (last.high <= p.end and p.at(last.high) == last.path.at(last.high)):
            passed = last
            return passed, self.first.get(p.at(passed.high + 1)) if passed.high < p.end else None
        return last.up, last

    def insert(self, batch: list[_Path]) -> None:
        """Locates all paths in the trie as it is, then inserts them where they leave it."""
        found = [self.locate(p)[0] for p in batch]
        for p, known in zip(batch, found):
            passed, out = self.locate(p, known)
            node = passed
            if out is not None:
                node = self._split(out, self._common(p, out))
            if node.high < p.end:
                node = self._add(_Node(node.high, p.end, p.below(node.high), node))
                self.size += p.end - node.low
            node.count += 1
            node.least = p.conv if node.least is None else min(node.least, p.conv)

    @staticmethod
    def _common(p: _Path, node: _Node) -> int:
        """Depth to which a path follows a node's edge."""
        lo, hi = node.low + 1, min(node.high, p.end)  # the first depth matches
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if p.at(mid) == node.path.at(mid):
                lo = mid
            else:
                hi = mid - 1
        return lo

    def _add(self, n: _Node) -> _Node:
        self.nodes.append(n)
        self.handles[n.path.at(two_fattest(n.low, n.high))] = n
        self.first[n.path.at(n.low + 1)] = n
        return n

    def _split(self, n: _Node, depth: int) -> _Node:
        """The node that ends at `depth` on an edge."""
        if depth == n.high:
            return n
        del self.handles[n.path.at(two_fattest(n.low, n.high))]
        upper = self._add(_Node(n.low, depth, n.path, n.up))
        n.low, n.up = depth, upper
        self.handles[n.path.at(two_fattest(n.low, n.high))] = n
        self.first[n.path.at(n.low + 1)] = n
        return upper

    def expand(self):
        """(depth, digest, digest above, bytes, members, least member) of every depth of every edge."""
        for n in sorted(self.nodes, key=lambda n: -n.high):
            n.up.count += n.count
            if n.least is not None:
                n.up.least = n.least if n.up.least is None else min(n.up.least, n.least)
        for r in self.roots.values():
            if r.high == 0:
                yield 0, r.path.root, None, 0, r.count, r.least
        for n in self.nodes:
            p, above = n.path, n.path.at(n.low)
            for d in range(n.low + 1, n.high + 1):
                here = p.at(d)
                yield d, here, above, p.bytes[d - p.start - 1], n.count, n.least
                above = here


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, said, bytes): each turn's place (from 1), hash of role and text, and the text's UTF-8 bytes.

    Rows go by turn, NULL first; equal turns by role, then by the text's hash, so
    that no text is shuffled.  NULL role and text are empty; rows without conv_id
    belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, WIDTH)
    c = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), said.alias("said"),
        F.octet_length(text).cast("long").alias("bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "said")
    return c.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "said", "bytes")


def _parts(df: DataFrame, rows: int) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // PIECES_PER_TASK)


KEY_COLUMNS = [f"k{k}" for k in KEYS]
PIECES = ("conv_id long, start long, root binary, " + ", ".join(f"{k} binary" for k in KEY_COLUMNS)
          + ", digests binary, bytes array<long>, last boolean")


def prefixes(convs: DataFrame, path: DataFrame) -> DataFrame:
    """Pieces of the conversations `convs` (conv_id) with turns `path` (conv_id, depth from 1, said, bytes).

    A task streams over conversations, one turn at a time.
    """
    start = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("said"), F.lit(0).cast("long").alias("bytes"))
    both = start.unionByName(path.select("conv_id", "depth", "said", "bytes"))
    parts = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, depth, begin, root, now, blob, sizes = [], None, 0, 0, TOP, TOP, [], []

        def piece(last):
            keys = [blob[k - 1] if k <= len(blob) else b"" for k in KEYS]
            out.append((conv, begin, root, *keys, b"".join(blob), sizes, last))

        def table():
            kinds = (pa.int64(), pa.int64(), *[pa.binary()] * (len(KEYS) + 2), pa.list_(pa.int64()), pa.bool_())
            cols, out[:] = list(zip(*out)) or [[]] * len(kinds), []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                              names=["conv_id", "start", "root", *KEY_COLUMNS, "digests", "bytes", "last"])

        for b in batches:
            for c, d, said, size in zip(*(b.column(x).to_pylist() for x in ("conv_id", "depth", "said", "bytes"))):
                if not d:
                    if conv is not None:
                        piece(True)
                    conv, depth, begin, root, now, blob, sizes = c, 0, 0, TOP, TOP, [], []
                    continue
                if len(blob) == PIECE:
                    piece(False)
                    begin, root, blob, sizes = depth, now, [], []
                now = hashlib.blake2b(now + said, digest_size=WIDTH).digest()
                depth += 1
                blob.append(now)
                sizes.append(size)
            yield table()
        if conv is not None:
            piece(True)
            yield table()

    return both.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "depth").mapInArrow(run, PIECES)


def _tries(pieces: DataFrame) -> DataFrame:
    """(depth, node, parent, bytes, n_convs, conv_id) per node and trie."""
    order = ["start", "root", *KEY_COLUMNS, "conv_id"]
    dealt = pieces.repartitionByRange(_parts(pieces, pieces.count()), *order).sortWithinPartitions(*order)

    def table(trie: ZFastTrie) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        cols = list(zip(*trie.expand())) or [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=["depth", "node", "parent", "bytes", "n_convs", "conv_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ZFastTrie()
        for b in batches:
            for lo in range(0, b.num_rows, BATCH):
                part = b.slice(lo, BATCH)
                trie.insert([_Path(*row) for row in zip(*(part.column(x).to_pylist() for x in ("conv_id", "start", "root", "digests", "bytes")))])
                if trie.size > NODES:
                    yield table(trie)
                    trie = ZFastTrie()
        yield table(trie)

    return dealt.mapInArrow(run, "depth long, node binary, parent binary, bytes long, n_convs long, conv_id long")


def _above(pieces: DataFrame, totals: DataFrame) -> DataFrame:
    """(node, saved, leaves): an owner's totals for each node of its path above what it owns."""
    due = pieces.select("conv_id", "start", "root", "digests").join(totals, "conv_id").where(F.col("start") < F.col("from"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, saved, leaves = [], [], []
            for start, root, blob, upto, s, n in zip(*(b.column(x).to_pylist() for x in ("start", "root", "digests", "from", "saved", "leaves"))):
                path = ([root] if start == 0 else []) + [blob[i:i + WIDTH] for i in range(0, min(len(blob), WIDTH * (upto - 1 - start)), WIDTH)]
                nodes += path
                saved += [s] * len(path)
                leaves += [n] * len(path)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(saved, pa.int64()), pa.array(leaves, pa.int64())],
                                             names=["node", "saved", "leaves"])

    return due.mapInArrow(run, "node binary, saved long, leaves long").groupBy("node").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))


def _ends(pieces: DataFrame) -> DataFrame:
    """(node, ends_sha256): the ids of the conversations that end at a node, ascending, joined by commas, as a hash.

    Ids are sorted by range, so a node at which very many end is dealt to many tasks,
    and written in runs of up to RUN ids; one task per node then hashes its runs
    in order, as the hash demands, and holds one at a time.
    """
    end = F.when(F.length("digests") > 0, F.expr(f"substring(digests, length(digests) - {WIDTH - 1}, {WIDTH})")).otherwise(F.col("root"))
    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = pieces.where("last").select(end.alias("node"), "conv_id")
    dealt = ends.repartitionByRange(parts, "node", "conv_id").sortWithinPartitions("node", "conv_id")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for node, conv in zip(b.column("node").to_pylist(), b.column("conv_id").to_pylist()):
                if not out or out[-1][0] != node or len(out[-1][2]) == RUN:
                    out.append((node, conv, []))
                out[-1][2].append(str(conv))
            cols = [[o[0] for o in out], [o[1] for o in out], [",".join(o[2]) for o in out]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.string()))], names=["node", "least", "ids"])

    dealt = dealt.mapInArrow(runs, "node binary, least long, ids string").repartition(parts, "node").sortWithinPartitions("node", "least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, sha = None, None
        for b in batches:
            out = []
            for node, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()):
                if node != here:
                    if here is not None:
                        out.append((here, sha.hexdigest()))
                    here, sha = node, hashlib.sha256(ids.encode())
                else:
                    sha.update(f",{ids}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.string())], names=["node", "ends_sha256"])
        if here is not None:
            yield pa.RecordBatch.from_arrays([pa.array([here], pa.binary()), pa.array([sha.hexdigest()], pa.string())], names=["node", "ends_sha256"])

    return dealt.mapInArrow(run, "node binary, ends_sha256 string")


def prefix_trie(convs: DataFrame, path: DataFrame) -> DataFrame:
    """The prefix trie of conversations: one row per distinct prefix.

    `convs` (conv_id, distinct, not NULL) names the conversations, `path` (conv_id,
    depth from 1 without gaps, said, bytes) their turns, of which a conversation
    may have none.  Returns node (the prefix's digest), conv_id (its least member),
    depth, parent_conv_id (NULL at the root), n_convs, n_children, n_leaves (nodes without
    children in its subtree), saved_tokens (over its subtree, (n_convs - 1) times
    the bytes of a node's last turn), ends_sha256 (of the sorted ids of members
    that end here).  Equal conversations share all nodes.  No conversations: no
    rows.  Other columns are not read.
    """
    pieces = stored(prefixes(convs, path), "trie-pieces")
    nodes = _tries(pieces).groupBy("node").agg(F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("bytes").alias("bytes"),
                                               F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    nodes = stored(nodes, "trie-merged")
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = stored(nodes.withColumns({"saved": (F.col("n_convs") - 1) * F.col("bytes"), "leaf": (F.col("n_children") == 0).cast("long")}), "trie-nodes")
    # Along what each conversation owns, from the end up.
    below = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    own = nodes.withColumns({"own_saved": F.sum("saved").over(below), "own_leaves": F.sum("leaf").over(below)})
    totals = nodes.groupBy("conv_id").agg(F.min("depth").alias("from"), F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves")).where(
        (F.col("from") > 0) & ((F.col("saved") > 0) | (F.col("leaves") > 0)))
    pushed = _above(pieces, totals).select("node", F.col("saved").alias("more_saved"), F.col("leaves").alias("more_leaves"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = own.join(pushed, "node", "left").join(_ends(pieces), "node", "left").join(parents, "parent", "left")
    zero = F.lit(0)
    return out.select("node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                      (F.col("own_leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
                      (F.col("own_saved") + F.coalesce("more_saved", zero)).alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(convs, path) of conversations that begin with turns of another one.

    Conversation c takes the first h turns of conversation c - c % 5 (all, if it has
    fewer; none, if there is no such one), then its own after its first h, with
    h = crc32(c in decimal) % 9.
    """
    t = stored(turns(conversations), "trie-turns")
    c = t.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    c = stored(c.withColumns({"donor": F.col("conv_id") - F.col("conv_id") % 5, "h": F.crc32(F.col("conv_id").cast("string")) % 9}), "trie-conversations")
    donors = c.select(F.col("conv_id").alias("donor"), F.col("n").alias("given"))
    c = c.join(donors, "donor", "left").withColumn("lead", F.least("h", F.coalesce("given", F.lit(0).cast("long"))))
    heads = t.where("pos <= 8 AND conv_id % 5 = 0").withColumnRenamed("conv_id", "donor").join(c.select("donor", "conv_id", "h"), "donor").where("pos <= h")
    tails = t.join(c.select("conv_id", "h", "lead"), "conv_id").where("pos > h")
    path = heads.select("conv_id", F.col("pos").alias("depth"), "said", "bytes").unionByName(
        tails.select("conv_id", (F.col("pos") - F.col("h") + F.col("lead")).alias("depth"), "said", "bytes"))
    return c.select("conv_id"), path
