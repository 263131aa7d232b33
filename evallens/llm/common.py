"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evallens.session import scratch_path

# A word: a maximal run of characters other than space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"

ROWS_PER_BLOCK = 1 << 16


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: lineage is cut, and
    a lost executor costs only a read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(*cols: Column, seed: str) -> Column:
    """16 hex digits that depend on the seed and the values only (MD5)."""
    parts = [F.coalesce(c.cast("string"), F.lit("\0")) for c in cols]
    return F.substring(F.md5(F.concat_ws("|", F.lit(seed), *parts)), 1, 16)


def hex_digits(rows: int, per_block: int = ROWS_PER_BLOCK) -> int:
    """Leading hex digits of a random key that cut `rows` into blocks of at most about `per_block` rows."""
    d = 1
    while rows > per_block * 16 ** d:
        d += 1
    return d


def with_position(df: DataFrame, groups: Sequence[str], key: str, ties: Sequence[str] = (), weight: str | None = None,
                  rows: int | None = None, extra: DataFrame | None = None) -> DataFrame:
    """Rows with their place in each group's order by (`key`, `ties`).

    Adds `_pos` (from 0) and, with `weight`, `_before` (the sum of the weights of
    earlier rows).  `key` is a random hex key, so its leading digits cut every
    group into blocks of bounded size, however large the group: block totals
    are pre-aggregated, their prefix sums give each block's offset, and only one
    block at a time is sorted.  `extra` holds one row per group; its columns are
    added to the rows by way of the (small) block table.  Group columns must not
    be NULL.  `df` is read twice, so it should be a stored table.
    """
    n = df.count() if rows is None else rows
    groups = list(groups)
    df = df.withColumn("_blk", F.substring(key, 1, hex_digits(n)))
    aggs = [F.count(F.lit(1)).alias("_n")] + ([F.sum(weight).alias("_w")] if weight else [])
    totals = df.groupBy(*groups, "_blk").agg(*aggs)
    earlier = Window.partitionBy(*groups).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_n0", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    if weight:
        totals = totals.withColumn("_w0", F.coalesce(F.sum("_w").over(earlier), F.lit(0))).drop("_w")
    if extra is not None:
        totals = totals.join(extra, groups)
    within = Window.partitionBy(*groups, "_blk").orderBy(key, *ties)
    out = df.join(totals.drop("_n"), [*groups, "_blk"])
    out = out.withColumn("_pos", F.col("_n0") + F.row_number().over(within) - 1)
    if weight:
        run = within.rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn("_before", F.col("_w0") + F.sum(weight).over(run) - F.col(weight)).drop("_w0")
    return out.drop("_blk", "_n0")


# Bits of the id map that is sent to all tasks (1 MB).
ID_BITS = 1 << 23


def _marked(df: DataFrame, col: str, ids: DataFrame) -> DataFrame:
    """(row, maybe): the rows of `df`, whole, and whether `col` may be among `ids` (modulo ID_BITS); nothing is shuffled."""
    cell = lambda c: F.pmod(c, F.lit(ID_BITS).cast("long"))
    i = F.col(ids.columns[0])
    maps = ids.where(i.isNotNull()).groupBy(F.bitmap_bucket_number(cell(i)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(cell(i))).alias("bits"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])  # names inside cannot clash with those beside it
    cells = df.select(row.alias("row"), cell(F.col(col)).alias("cell")).withColumn("bucket", F.bitmap_bucket_number("cell"))
    at = F.bitmap_bit_position("cell")
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return cells.join(F.broadcast(maps), "bucket", "left").select("row", maybe.alias("maybe"))


def rows_near_ids(df: DataFrame, col: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of `df` that may have an id of `ids` (those that have one, and some more), and the others, NULL included.

    A bitmap of the ids modulo ID_BITS, built by Spark and never larger than
    that, is broadcast and parts the rows as they are scanned; none is
    shuffled.  Join the first table with what belongs to the ids.
    """
    marked = _marked(df, col, ids)
    return marked.where("maybe").select("row.*"), marked.where("not maybe").select("row.*")


def rows_with_ids(df: DataFrame, col: str, ids: DataFrame) -> DataFrame:
    """Rows of `df` whose `col` (long) is in the one column of `ids`, without shuffling most of the others."""
    near, _ = rows_near_ids(df, col, ids)
    return near.join(ids.select(F.col(ids.columns[0]).alias(col)), col, "left_semi").select(df.columns)


def rows_without_ids(df: DataFrame, col: str, ids: DataFrame) -> DataFrame:
    """The other rows, NULL included: those the bitmap clears are kept as they are
    scanned, and an anti join decides on the rest."""
    near, far = rows_near_ids(df, col, ids)
    rest = near.join(ids.select(F.col(ids.columns[0]).alias(col)), col, "left_anti")
    return far.unionByName(rest.select(df.columns))


# --- hashes of words and n-grams, over many texts at a time ------------------------

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
# Bytes of text hashed at once; the arrays for them take about 40 times as much.
CHUNK = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = np.arange(16)


def _digests(words: list[bytes]) -> np.ndarray:
    found = b"".join(hashlib.blake2b(w, digest_size=16).digest() for w in words)
    return np.frombuffer(found, dtype="<u8").reshape(-1, 2).astype(_U)


def word_hashes(raw: np.ndarray, bounds: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text number) of each word of the texts raw[bounds[i]:bounds[i+1]].

    A word's hash is two 64-bit numbers (one row of `hashes`): its bytes and its
    length as they are, mixed, for words of up to 16 bytes, and a BLAKE2b digest of
    longer ones.  `lower`: A-Z are lower-cased.
    """
    n = len(raw)
    solid = ~_SPACE[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:n]
    last[:-1] &= ~solid[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    size = ends - starts
    letters = np.concatenate([_LOWER[raw] if lower else raw, np.zeros(16, np.uint8)])
    packed = letters[starts[:, None] + _BYTES]
    packed[_BYTES >= size[:, None]] = 0
    packed = np.ascontiguousarray(packed).view("<u8").astype(_U)
    x, y = mix64(packed[:, 0] + size.astype(_U)), mix64(packed[:, 1] ^ _U(0x9E3779B97F4A7C15))
    hashes = np.column_stack([mix64(x + y * _U(0x9FB21C651E98DF25)), mix64(y + x * _U(0xD6E8FEB86659FD93))])
    for i in np.flatnonzero(size > 16).tolist():
        hashes[i] = _digests([letters[starts[i]:ends[i]].tobytes()])[0]
    return hashes, np.searchsorted(bounds, starts, side="right") - 1


def _long_text(raw: np.ndarray, lower: bool) -> np.ndarray:
    """Word hashes of one text longer than CHUNK, in pieces that end at white space."""
    out, at = [], 0
    while at < len(raw):
        stop = min(at + CHUNK, len(raw))
        if stop < len(raw):
            space = np.flatnonzero(_SPACE[raw[at:stop]])
            if len(space):
                stop = at + int(space[-1]) + 1
            else:  # a word longer than a piece
                while stop < len(raw) and not _SPACE[raw[stop]]:
                    nxt = np.flatnonzero(_SPACE[raw[stop:stop + CHUNK]])
                    stop = stop + int(nxt[0]) if len(nxt) else min(stop + CHUNK, len(raw))
        out.append(word_hashes(raw[at:stop], np.array([0, stop - at]), lower)[0])
        at = stop
    return np.concatenate(out) if out else np.zeros((0, 2), dtype=_U)


def text_words(texts, lower: bool = True):
    """Per block of a pyarrow string array: (number of its first text, the word hashes of
    its texts one after the other, where each text's words begin and end).

    Texts are read whole (NULL: no words); memory is bounded by CHUNK and by the
    longest text's words.
    """
    import pyarrow as pa

    texts = texts.cast(pa.large_binary())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        lo = int(offsets[i])
        if offsets[i + 1] - lo > CHUNK:
            words = _long_text(raw[lo:int(offsets[i + 1])], lower)
            yield i, words, np.array([0, len(words)])
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(offsets, lo + CHUNK, side="right")) - 1)
        j = min(j, len(texts))
        words, which = word_hashes(raw[lo:int(offsets[j])], (offsets[i:j + 1] - lo).astype(np.int64), lower)
        # empty texts share a bound with their neighbour; the last of equal bounds owns the words
        yield i, words, np.searchsorted(which, np.arange(j - i + 1))
        i = j


def _ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words."""
    m = len(words) - n + 1
    h = np.zeros(m, dtype=_U)
    for j in range(n):
        h = mix64(h * _U(0x9FB21C651E98DF25) + words[j:j + m] + _U(j + 1))
    return h


def ngram_sets(texts, n: int):
    """Per text of a pyarrow string array: sorted distinct 64-bit hashes of its n-word shingles.

    A text with fewer words is one shingle, its whole sequence; NULL or without
    words: empty.
    """
    def one(words: np.ndarray) -> np.ndarray:
        if len(words) == 0:
            return np.zeros(0, dtype=_U)
        k = min(n, len(words))
        h = _ngram_hashes(words, k)
        return np.unique(h if k == n else mix64(h + _U(k)))

    for _, hashes, cut in text_words(texts):
        words = hashes[:, 0]
        grams = _ngram_hashes(words, n) if len(words) >= n else np.zeros(0, dtype=_U)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            yield np.unique(grams[a:b - n + 1]) if b - a >= n else one(words[a:b])
