"""Registered queries against DuckDB where SQL expresses them, and the pipeline against its stages in plain Python."""

import re

import pytest

import corpus_pipeline as P
from compare import compare, duck, type_problems
from evallens.llm import toxicity
from evallens.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duck(SF)
    df = QUERIES[name](spark, SF)
    assert not type_problems(df, con, ORACLE[name])
    problems, rows = compare(df, con, ORACLE[name])
    assert not problems and rows, problems


def test_each_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_returns_its_rows(spark, name):
    con = duck(SF)
    n = QUERIES[name](spark, SF).count()
    docs, = con.execute("SELECT count(*) FROM documents").fetchall()[0]
    asked, = con.execute("SELECT count(*) FROM embeddings WHERE vec_id % 20 = 0").fetchall()[0]
    assert n == (20 * asked if name.startswith("op3") else docs)


def shingles(text):
    w = WORD.findall(text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, sizes = docs, []
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        before, kept = kept, spark.read.parquet(str(tmp_path / name))
        sizes.append((before.toPandas(), kept.toPandas()))
    # toxicity: exactly the rejected rows go
    bad = {r.doc_id for r in toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("rejected").collect()}
    assert bad and set(sizes[0][1].doc_id) == set(sizes[0][0].doc_id) - bad
    # near duplicates: the least id of each group by brute force
    before, after = sizes[1]
    sets = {i: shingles(t) for i, t in zip(before.doc_id, before.text)}
    root = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in range(len(links) + 1):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert links and set(after.doc_id) == {i for i in sets if root[i] == i}
    # mixing: each document at most twice, one and a half times all words
    before, after = sizes[2]
    count = lambda x: x.text.map(lambda t: len(WORD.findall(t)))
    assert abs(count(after).sum() - 1.5 * count(before).sum()) <= 20 and after.doc_id.value_counts().max() <= 2
    size = dict(zip(before.doc_id, count(before)))
    taken = count(after).groupby(after.doc_id).sum().to_dict()
    assert all(n <= 2 * size[i] for i, n in taken.items())
    # packing: every word of the mix
    packed = P.STAGES[-1][1](spark, kept, SF).toPandas()
    assert packed.n_tokens.sum() == count(after).sum()
    assert P.run(spark, SF).count() == len(packed)


@pytest.mark.parametrize("rows,want", [
    # an id with two texts: the one that is no copy stays
    ([(5, "A"), (5, "B"), (3, "A")], [(3, "A"), (5, "B")]),
    # equal rows, and copies without an id
    ([(1, "A"), (1, "A"), (2, "B"), (None, "C"), (None, "C"), (None, "C"), (None, "B")], [(1, "A"), (2, "B"), (None, "C")]),
    ([(1, "A"), (None, "C"), (None, "C"), (None, "D"), (4, "D"), (6, "C2")], [(1, "A"), (4, "D"), (6, "C2")]),
    # rows without words are copies of nothing
    ([(1, None), (1, None), (None, ""), (None, ""), (2, "A")], [(1, None), (1, None), (None, ""), (None, ""), (2, "A")]),
])
def test_near_duplicates_by_row(spark, rows, want):
    text = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "ABCD"} | {None: None, "": ""}
    text["C2"] = text["C"] + " more"
    df = spark.createDataFrame([(i, text[c], "x") for i, c in rows], "doc_id long, text string, source string").repartition(2)
    got = P.drop_near_duplicates(spark, df, SF)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(((i, text[c]) for i, c in want), key=str)
