"""Removal of passages that documents share, by level-wise doubling of repeated windows.

1. A passage of `window` words repeats only if its shorter windows do.  Of the
   windows of `base` words, each passage offers those whose hash is least
   among all that lie inside it: equal passages offer equal ones, and a text
   offers few.
2. Windows found in two documents or more survive.  Only passages that hold a
   survivor are hashed again, at twice the length, and so on, until the length
   is that of the passage or no candidates survive.  Longer repeats are unions
   of passages, so the doubling stops there.
3. A passage that starts in several documents stays in the one with the least
   id; in the others its words go.

Hashes of windows are 128 bits wide, built from the two halves' hashes.  Per
window length there is one aggregation (combined before it is shuffled) and one
join back, whose many-rows side Spark may split; no window's documents are
gathered.  Documents with equal words take part once.  Texts of documents
without survivors are not shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evallens.llm.common import CHUNK, mix64, rows_near_ids, stored, text_words

_U = np.uint64
ROWS = 256  # texts of a batch handled at a time


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes (two columns) of concatenations, given those of both parts."""
    a, b = left[:, 0], left[:, 1]
    c, d = right[:, 0], right[:, 1]
    return np.column_stack([mix64(a * _U(0x9FB21C651E98DF25) + mix64(c + _U(1))), mix64(b * _U(0xD6E8FEB86659FD93) + mix64(d ^ a))])


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """128-bit hashes of all windows of `length` words, from those of half the length."""
    if len(words) < length:
        return np.zeros((0, 2), _U)
    if length == 1:
        return words
    half = window_hashes(words, length // 2)
    m = len(words) - length + 1
    both = _join(half[:len(words) - 2 * (length // 2) + 1], half[length // 2:])
    return both[:m] if length % 2 == 0 else _join(both[:m], words[length - 1:])


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """`best` (np.minimum or np.maximum) over each run of `width` values."""
    done, out = 1, x
    while done < width:
        step = min(done, width - done)
        out = best(out[:len(out) - step], out[step:])
        done += step
    return out


class _Block:
    """Some texts' words, one after the other, with what their passages of `window` words offer."""

    def __init__(self, words: np.ndarray, cut: np.ndarray, window: int):
        self.words, self.window = words, window
        self.text = np.repeat(np.arange(len(cut) - 1), np.diff(cut))  # of each word
        passages = max(0, len(words) - window + 1)
        self.alive = self.text[:passages] == self.text[window - 1:] if passages else np.zeros(0, bool)

    def keep(self, length: int, survivors: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Only passages stay alive that offer, at `length` words, a survivor of their text."""
        if self.alive.any():
            least = _sliding(window_hashes(self.words, length)[:, 0], self.window - length + 1, np.minimum)
            named = lambda h, text: mix64(h + mix64(text.astype(_U)))
            self.alive &= np.isin(named(least, self.text[:len(least)]), named(survivors, owner))
        return self.alive

    def offers(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) that the living passages offer at `length` words, each once."""
        if not self.alive.any():
            return np.zeros(0, np.int64), np.zeros((0, 2), _U)
        h = window_hashes(self.words, length)
        v, width = h[:, 0], self.window - length + 1
        edge = np.zeros(width - 1, _U)  # the window at p lies in passages p - width + 1 to p
        least = np.where(self.alive, _sliding(v, width, np.minimum), _U(0))
        best = _sliding(np.concatenate([edge, least, edge]), width, np.maximum)
        held = _sliding(np.concatenate([edge, self.alive.astype(_U), edge]), width, np.maximum)
        at = np.flatnonzero((best == v) & (held > 0))
        text, h = self.text[at], h[at]
        order = np.lexsort((h[:, 1], h[:, 0], text))
        text, h = text[order], h[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1]).any(axis=1)
        return text[new], h[new]


def _blocks(batch: pa.RecordBatch):
    """(first row, word hashes, ends of texts) of the texts of a batch, some at a time."""
    for lo in range(0, batch.num_rows, ROWS):
        for first, words, cut in text_words(batch.column("text").slice(lo, ROWS), lower=False):
            yield lo + first, words, cut


def _lists(column, rows: range) -> tuple[np.ndarray, np.ndarray]:
    """The values of some rows' lists of numbers, and the number of the row of each, from 0."""
    part = column.slice(rows.start, len(rows))
    n = np.array([len(x) if x.is_valid else 0 for x in part], dtype=np.int64)
    return np.asarray(part.flatten()).astype(np.int64).view(_U), np.repeat(np.arange(len(rows)), n)


def _row(docs: DataFrame) -> DataFrame:
    """(doc_id, row, text): `row` tells rows that share an id apart; equal rows have an equal one."""
    doc, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(doc.alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))


def _sequences(rows: DataFrame) -> DataFrame:
    """(doc_id, row, n_words, x, y): each text's number of words and the hash of all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, x = np.zeros(b.num_rows, np.int64), np.zeros((b.num_rows, 2), _U)
            for first, words, cut in _blocks(b):
                size = np.diff(cut)
                place = mix64((np.arange(len(words)) - np.repeat(cut[:-1], size) + 1).astype(_U))
                some = np.flatnonzero(size)
                n[first:first + len(size)] = size
                for lane, h in enumerate((mix64(words[:, 0] ^ place), mix64(words[:, 1] + place))):
                    if len(some):
                        x[first + some, lane] = np.add.reduceat(h, cut[some])
            x = x.view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n), pa.array(x[:, 0]), pa.array(x[:, 1])],
                                             names=["doc_id", "row", "n_words", "x", "y"])

    return rows.mapInArrow(run, "doc_id long, row long, n_words long, x long, y long")


def _level(rows: DataFrame, length: int, before: int | None, window: int) -> DataFrame:
    """(doc_id, row, a, b): offers at `length` words; with `before`, of passages that offer one of `survivors` there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, words, cut in _blocks(b):
                block = _Block(words, cut, window)
                if before:
                    block.keep(before, *_lists(b.column("survivors"), range(first, first + len(cut) - 1)))
                text, h = block.offers(length)
                take, h = pa.array(text + first), h.view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(take), b.column("row").take(take), pa.array(h[:, 0]), pa.array(h[:, 1])],
                                                 names=["doc_id", "row", "a", "b"])

    return rows.mapInArrow(run, "doc_id long, row long, a long, b long")


SPANS = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))
OUT = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "spans": SPANS, "text": pa.string()}
OUT_SCHEMA = "doc_id long, n_words long, n_removed long, spans array<struct<first:long,after:long>>, text string"


def _cut(rows: DataFrame, window: int) -> DataFrame:
    """Texts without the words of passages among `survivors`, or of all if `whole`."""

    def removed(n: int, words: np.ndarray, gone: np.ndarray) -> np.ndarray:
        if n < window:
            return np.zeros(n, bool)
        hit = np.isin(window_hashes(words, window)[:, 0], gone)
        edge = np.zeros(window - 1, bool)
        return _sliding(np.concatenate([edge, hit, edge]), window, np.maximum)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(r"[^\x20\x09-\x0D]+")
        rows_of = lambda out: pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate(OUT.values())], names=list(OUT))
        for b in batches:
            out, size = [], 0
            for doc, text, gone, whole in zip(b.column("doc_id").to_pylist(), b.column("text"), b.column("survivors"), b.column("whole").to_pylist()):
                kept = word.findall(text.as_py() or "")
                n, spans = len(kept), []
                if whole:
                    kept, spans = [], [{"first": 0, "after": n}]
                elif gone.is_valid:
                    words = next(text_words(pa.array([text.as_py()], pa.large_string()), lower=False))[1]
                    drop = removed(n, words, np.asarray(gone.values).astype(np.int64).view(_U))
                    kept = [w for w, d in zip(kept, drop.tolist()) if not d]
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], drop.astype(np.int8), [0]])))
                    spans = [{"first": x, "after": y} for x, y in edges.reshape(-1, 2).tolist()]
                out.append((doc, n, n - len(kept), spans, " ".join(kept)))
                size += len(out[-1][-1])
                if size > 8 * CHUNK:
                    yield rows_of(out)
                    out, size = [], 0
            yield rows_of(out)

    return rows.select("doc_id", "text", "survivors", "whole").mapInArrow(run, OUT_SCHEMA)


def lengths(window: int, base: int) -> list[int]:
    """base, 2 * base, ... up to window, the last one."""
    out = [min(base, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def remove_repeats(docs: DataFrame, window: int = 50, base: int = 25) -> DataFrame:
    """Documents without the passages of `window` words that a document with a smaller id holds too.

    Returns one row per row of `docs` (doc_id, text): doc_id, n_words, n_removed,
    spans (word numbers [first, after) that go), text (the words kept, a space
    between).  Words are runs of characters other than space and \\t to \\r,
    compared as they are.  All passages are judged on the input, so a removed one
    still counts against later documents.  NULL text: no words.  A NULL doc_id
    comes before or after no other: its row keeps all words and removes none.
    Rows that share an id are told apart by their text, and neither's passages
    count against the other.  A passage that repeats inside one document only is
    kept.  Other columns are not read.  No rows: no rows.
    """
    rows = _row(docs)
    seqs = stored(_sequences(rows).where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window)), "repeats-sequences")
    # Documents with the words of an earlier one go whole; the first of them takes part.
    firsts = stored(seqs.groupBy("n_words", "x", "y").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi"), "repeats-firsts")
    copies = seqs.join(firsts, ["n_words", "x", "y"]).where("doc_id > lo").select("doc_id", "row").distinct()
    copies = stored(copies, "repeats-copies")
    part, before = rows.where(F.col("doc_id").isNotNull()), None
    survivors = None
    for length in lengths(window, base):
        if survivors is None:
            grams = stored(_level(part, length, None, window), f"repeats-{length}").join(copies, ["doc_id", "row"], "left_anti")
        else:
            near = rows_near_ids(part, "doc_id", survivors.select("doc_id").distinct())[0].join(survivors, ["doc_id", "row"])
            grams = stored(_level(near, length, before, window), f"repeats-{length}")
        repeated = grams.groupBy("a", "b").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("a", "b", "lo")
        found = grams.join(stored(repeated, f"repeats-{length}-found"), ["a", "b"])
        if length == window:
            found = found.where("doc_id > lo")
        # at most as many as the text has words
        survivors = stored(found.groupBy("doc_id", "row").agg(F.collect_set("a").alias("survivors")), f"repeats-{length}-texts")
        before = length
        if survivors.isEmpty():
            break
    marked = survivors.withColumn("whole", F.lit(False)).unionByName(
        copies.select("doc_id", "row", F.lit(None).cast("array<long>").alias("survivors"), F.lit(True).alias("whole")))
    marked = stored(marked, "repeats-marked")
    near, rest = rows_near_ids(rows, "doc_id", marked.select("doc_id").distinct())
    touched = near.join(marked, ["doc_id", "row"], "left").withColumn("whole", F.coalesce("whole", F.lit(False)))
    rest = rest.withColumns({"survivors": F.lit(None).cast("array<long>"), "whole": F.lit(False)})
    return _cut(touched.unionByName(rest), window)
