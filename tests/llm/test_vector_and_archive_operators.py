"""Vector operators against brute force; archives against an exact round trip."""

import gzip
import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from evallens.llm import ann, embed_dedup, warc

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if e is None else [None if x is None else float(x) for x in e], y, 0.0, 0) for i, e, y in rows], SCHEMA)


BROKEN = [(9001, None, 1), (9002, [0.0] * 8, 1), (9003, [NAN] + [1.0] * 7, 1), (9004, [None] + [1.0] * 7, 1), (9005, [INF] + [1.0] * 7, 1), (9006, [], 1), (9007, [1.0] * 5, 1), (None, [1.0] * 8, 1)]


def test_nearest_recall_ties_and_broken_vectors(spark):
    r = np.random.default_rng(1)
    x = np.float32(r.standard_normal((3000, 8)) * r.uniform(0.5, 2, (3000, 1)))
    x[100:160] = x[100]  # more equal vectors than k
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + BROKEN
    df = table(spark, rows)
    got = ann.nearest(df, df.where("vec_id % 20 = 0"), k=20, block_rows=700).collect()
    by = {}
    for g in got:
        by.setdefault(g.query_id, []).append(g)
    assert set(by) == set(range(0, 3000, 20))
    d, hits = np.float64(x), 0
    for q, found in by.items():
        found.sort(key=lambda g: g["rank"])
        assert [g["rank"] for g in found] == list(range(1, 21))
        s = d @ d[q]
        for g in found:
            assert abs(g.score - s[g.vec_id]) < 1e-9 and g.vec_id != q
        assert [(-g.score, g.vec_id) for g in found] == sorted((-g.score, g.vec_id) for g in found)
        s[q] = -np.inf
        hits += len({g.vec_id for g in found} & set(np.lexsort((np.arange(3000), -s))[:20].tolist()))
    assert hits / (20 * len(by)) >= 0.9


def test_nearest_with_few_rows(spark):
    df = table(spark, [(i, [1.0, float(i)], 0) for i in range(5)] + [(20, [1.0, 1.0, 1.0], 0)])
    got = ann.nearest(df, df.where("vec_id % 20 = 0"), k=20).orderBy("query_id", "rank").collect()
    assert [(g.query_id, g.vec_id) for g in got] == [(0, i) for i in (1, 2, 3, 4)]
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_queries_that_repeat_an_id(spark, monkeypatch):
    """Each of them has a ranking, and every block is indexed once, however many batches of queries pass."""
    r = np.random.default_rng(2)
    df = table(spark, [(i, v, 0) for i, v in enumerate(r.standard_normal((400, 6)).tolist())])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        asked = table(spark, [(3, [1.0] * 6, 0), (3, [-1.0] * 6, 0), (3, [-1.0] * 6, 0), (9, [2.0] * 6, 0)])
        got = ann.nearest(df, asked, k=5, block_rows=100).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((g.query_id, g["rank"]) for g in got) == sorted([(3, i) for i in range(1, 6)] * 2 + [(9, i) for i in range(1, 6)])
    x = np.array([row.embedding for row in df.orderBy("vec_id").collect()])
    s = x @ np.ones(6)
    s[9] = -np.inf
    assert [g.vec_id for g in sorted(got, key=lambda g: g["rank"]) if g.query_id == 9] == np.argsort(-s)[:5].tolist()


def test_chi_square_quantile():
    assert abs(ann.chi2_quantile(0.95, 2) - 5.991465) < 1e-5 and abs(ann.chi2_quantile(0.9, 8) - 13.361566) < 1e-5


def test_embedding_dedup_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK_ROWS", 16)
    monkeypatch.setattr(embed_dedup, "PACK_ROWS", 64)
    r = np.random.default_rng(2)
    rows = []
    for g in range(25):
        base = r.standard_normal(8)
        for _ in range(r.choice([1, 2, 4])):
            rows.append((len(rows), (base + r.standard_normal(8) * 0.08 * r.random()).tolist(), int(g % 3)))
    base = r.standard_normal(8)
    rows += [(len(rows) + i, (base + r.standard_normal(8) * 0.06).tolist(), 1) for i in range(80)]  # a large group of near copies
    rows += [(1000 + i, rows[-1][1], 1) for i in range(30)] + [(2000, rows[-1][1], 2), (2001, rows[-1][1], None), (2002, [2 * v for v in rows[0][1]], rows[0][2])]
    rows += BROKEN
    got = {g.vec_id: (g.n_links, g.component_id, g.kept) for g in embed_dedup.embedding_dedup(table(spark, rows)).collect()}
    assert len(got) == len(rows)
    ok = [(i, np.float64(np.float32(e)), y) for i, e, y in rows if i is not None and y is not None and e is not None and len(e) == 8 and not any(v is None or not np.isfinite(v) for v in e) and any(e)]
    links = {(i, j) for i, a, y in ok for j, b, z in ok if i != j and y == z and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98}
    root = {i: i for i, _, _ in rows}
    for _ in range(200):
        for a, b in links:
            root[a] = min(root[a], root[b])
    for i, _, _ in rows:
        if i is not None:
            assert got[i] == (sum(a == i for a, _ in links), root[i], root[i] == i), i
    assert got[None] == (0, None, False)
    assert embed_dedup.embedding_dedup(table(spark, [])).count() == 0


def test_tables_follow_the_rows():
    for rows in (10, 10 ** 5, 10 ** 9):
        bits, tables = embed_dedup.plan_tables(rows, 0.98, 1e-5)
        agree = (1 - np.arccos(0.98) / np.pi) ** bits
        assert (1 - agree) ** tables <= 1e-5 and (2 ** bits >= 2 * rows)


PAGES = "page_id long, url string, html string, payload string, record_type int"


@pytest.mark.parametrize("split", [97, 1 << 12, 1 << 25])
def test_archives_come_back(spark, split):
    r = random.Random(4)
    long = "".join(r.choice("abcdefghij <>\né") for _ in range(30000))
    rows = [(i, f"http://x/{i}?q=a b\r\nEvil: 1", "p" * (i * 40)) for i in range(40)]
    rows += [(100, None, long), (101, "http://é", long), (99, "u", long), (102, "u", "short"), (103, "u", "short"), (104, "u", None), (105, "u", ""),
             (106, "u", "x" * 1000), (107, "u", "x" * 1000), (107, "u", "x" * 1000), (None, "u", "x" * 1000), (108, "u", "WARC/1.1\r\n\r\n" * 100)]
    df = spark.createDataFrame([(*x, "?", 1) for x in rows], PAGES).repartition(3)
    archives = warc.write_warc(df, file_bytes=4000)
    recs = warc.read_warc(archives, split_bytes=split)
    got = sorted(map(tuple, warc.page_records(recs).collect()), key=str)
    assert archives.count() > 3 and archives.agg({"records": "sum"}).first()[0] == len(rows)

    def want(i, html):
        b = (html or "").encode()
        mates = [j for j, _, h in rows if j is not None and (h or "").encode() == b] if len(b) >= 1000 else []
        rev = i is not None and mates and i < max(mates)
        return (i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if rev else "response", max(mates) if rev else None)

    assert got == sorted((want(i, h) for i, _, h in rows), key=str)
    body = {x.record_id: bytes(x.payload) for x in recs.collect() if x.record_type == "response"}
    assert body["urn:x-page:101"] == long.encode() and body["urn:x-page:104"] == b""
    if split == 97:
        return
    for path, in archives.select("path").collect():  # plain gzip files, record after record
        data = gzip.open(path.removeprefix("file:").replace("//", "/"), "rb").read()
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    assert warc.page_records(warc.read_warc(warc.write_warc(df.limit(0)))).count() == 0


@pytest.mark.parametrize("split,least", [(4000, 8), (400, 60)])
def test_ranges_are_read_by_many_tasks(spark, tmp_path, split, least):
    """As many tasks as ranges, and paths without a file system belong to the session's."""
    rows = [(i, f"http://h/{i}", os.urandom(300).hex()) for i in range(60)]
    archives = warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
    assert [r.path.startswith("file:/") for r in archives.collect()] == [True]
    bare = archives.withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    recs = warc.read_warc(bare, split_bytes=split, payloads=False)
    assert recs.rdd.getNumPartitions() >= least and recs.count() == 60
    assert {r.page_id for r in warc.page_records(recs).collect()} == set(range(60))


def test_a_broken_payload_is_an_error(spark, tmp_path):
    lines = ["WARC-Type: response", "WARC-Record-ID: <urn:x-page:1>", "WARC-Payload-Digest: sha1:" + "0" * 40]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"\x1f\x8b\x08 not a member" + warc._member(lines, b"HTTP/1.1 200 OK\r\n\r\nbody", 6))
    files = spark.createDataFrame([(str(path), path.stat().st_size)], "path string, bytes long")
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_warc(files).collect()
