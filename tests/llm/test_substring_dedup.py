"""Passages that documents share, against brute force."""

import random
import re

import numpy as np
import pytest

from evallens.llm import substring_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window):
    """(doc_id, n_words, n_removed, kept) per row, straight from the rule."""
    words = [WORD.findall(t or "") for _, t in docs]
    first = {}
    for (i, _), w in zip(docs, words):
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for (i, _), w in zip(docs, words):
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p:p + window])] < i:
                gone |= set(range(p, p + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def run(spark, docs, **kw):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in S.remove_repeats(df, **kw).collect()), key=repr)


def corpus(seed, n=60):
    r = random.Random(seed)
    text = lambda k: " ".join(r.choice("abcdefghijklmnop") for _ in range(k))
    shared = [text(k) for k in (7, 8, 9, 20, 31)]
    docs = []
    for i in range(n):
        parts = [text(r.randrange(0, 12)) for _ in range(3)]
        if r.random() < 0.6:
            parts.insert(1, r.choice(shared))
        docs.append((i * 3 - 20, r.choice([" ", "\n", " \t "]).join(parts)))
    return docs + [(1000 + k, docs[4][1]) for k in range(5)]


@pytest.mark.parametrize("seed,window,base", [(1, 8, 4), (2, 9, 2), (3, 5, 5), (4, 8, 1)])
def test_matches_brute_force(spark, seed, window, base):
    docs = corpus(seed)
    want = brute(docs, window)
    assert run(spark, docs, window=window, base=base) == want
    assert any(w[2] for w in want) and any(not w[2] for w in want)


def test_edges(spark):
    long = " ".join(f"w{i % 97}" for i in range(3000))
    docs = [(5, long), (5, long), (5, "x " + long), (9, long + " tail"), (None, long), (None, None), (7, ""), (8, None),
            (3, "a" * 5000), (11, "a " * 400), (12, "a " * 300), (2, "é ü ñ " * 30), (13, "é ü ñ " * 20)]
    assert run(spark, docs, window=50, base=25) == brute(docs, 50)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.remove_repeats(empty).collect() == []


def test_spans_and_clashing_names(spark):
    shared = " ".join(f"s{i}" for i in range(10))
    docs = [(1, shared, "k", 1), (2, f"x {shared} y", "k", 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string, row string, survivors int")
    got = {r.doc_id: r for r in S.remove_repeats(df, window=8, base=4).collect()}
    assert [tuple(s) for s in got[2].spans] == [(1, 11)] and got[2].text == "x y" and got[1].spans == []


@pytest.mark.parametrize("n", [1, 2, 3, 7, 25, 50])
def test_equal_windows_have_equal_hashes(n):
    words = np.array([[i % 5, i % 5] for i in range(200)], dtype=np.uint64)
    h = S.window_hashes(words, n)
    assert len(h) == 200 - n + 1 and len(np.unique(h, axis=0)) == 5
    assert (h[:5] == h[5:10]).all()
