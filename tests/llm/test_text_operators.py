"""Operators on texts against brute force, with the rows that break things: NULLs,
empty and long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evallens.llm import chat, common, components, license_scan, mixing, ngram_join, packing, sharding, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbÉ \t\n\x0b.", max_size=40)), max_size=8), st.integers(1, 4), st.integers(3, 60))
def test_ngram_sets_are_sets_of_words(texts, n, chunk):
    old, common.CHUNK = common.CHUNK, chunk  # cut texts into pieces at every place
    try:
        got = list(common.ngram_sets(pa.array(texts, pa.string()), n))
    finally:
        common.CHUNK = old
    want = [shingles(t, n) for t in texts]
    assert [len(g) for g in got] == [len(s) for s in want]
    for a, x in zip(got, want):
        for b, y in zip(got, want):
            assert len(np.intersect1d(a, b)) == len(x & y)


def brute_components(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_long_alternating_words_differ():
    """The word of Thue and Morse and its complement, on which polynomial hashes modulo powers of two collide."""
    w = "a"
    for _ in range(11):
        w += w.translate(str.maketrans("ab", "ba"))
    sets = list(common.ngram_sets(pa.array([w, w.translate(str.maketrans("ab", "ba")), w.upper()]), 3))
    assert len(w) == 2048 and sets[0] != sets[1] and sets[0] == sets[2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abAB é\x0b\u2003", max_size=40), min_size=1, max_size=6), st.booleans())
def test_word_hashes_tell_words_apart(texts, lower):
    seen = {}
    for first, words, cut in common.text_words(pa.array(texts), lower):
        for i, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
            text = texts[first + i]
            text = "".join(c.lower() if c.isascii() else c for c in text) if lower else text
            found = re.findall(r"[^\x20\x09-\x0D]+", text)
            assert len(found) == b - a
            for w, h in zip(found, words[a:b].tolist()):
                assert seen.setdefault(w, tuple(h)) == tuple(h)
    assert len(set(seen.values())) == len(seen)


def test_components_match_union_find(spark):
    r = random.Random(3)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    got = {x.node: x.component for x in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == brute_components([x for x in links if x[0] != x[1]], nodes)
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies(seed):
    r, rows = random.Random(seed), []
    vocab = [f"w{i}" for i in range(400)]
    for g in range(12):
        base = [r.choice(vocab) for _ in range(r.choice([4, 9, 12, 30, 80, 200]))]
        for c in range(r.choice([1, 2, 5, 9])):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                w[r.randrange(len(w))] = r.choice(vocab)
            rows.append(" ".join(w) if c % 2 else "\n".join(w).upper())
    return rows + ["", None, "   ", "one", "ONE", "one two", "One  Two"]


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (5, 80, 100), (1, 50, 100)])
def test_ngram_join_matches_brute_force(spark, n, num, den):
    texts = near_copies(n)
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[3])]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, rep string, cluster int").repartition(3)
    got = sorted(tuple(x) for x in ngram_join.ngram_join(df, n, num, den).where("doc_id is not null").distinct().collect())
    sets = {i: shingles(t, n) for i, t in rows if i is not None}
    links = {(a, b) for a in sets for b in sets if a != b and sets[a] and sets[b]
             and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])}
    comp = brute_components(links, sets)
    copies = {0: 2}
    # document 0 stands there twice: it and its partners count both rows
    degree = {a: sum(copies.get(b, 1) for x, b in links if x == a) + copies.get(a, 1) - 1 for a in sets}
    assert got == sorted((i, len(s), comp[i], degree[i]) for i, s in sets.items())
    assert ngram_join.ngram_join(df.limit(0), n, num, den).count() == 0
    assert ngram_join.ngram_join(df, n, num, den).where("doc_id is null").collect()[0].component_id is None


@pytest.mark.parametrize("hot", [0.0, 0.3, 1.0])
def test_any_choice_of_hot_ngrams_finds_all_links(hot):
    """Two sets that link share a join key, whichever n-grams are left out."""
    r = np.random.default_rng(int(hot * 10))
    cells = r.random(ngram_join.CELLS) < hot
    for num, den in ((90, 100), (80, 100), (50, 100)):
        c = ngram_join.Classes(num, den)
        for _ in range(400):
            n = int(r.integers(2, 300))
            a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            b = np.unique(np.concatenate([a[r.random(len(a)) < 1 - r.random() * 0.3], r.integers(0, 1 << 63, int(r.integers(0, n // 6 + 2)), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if len(b) and not np.array_equal(a, b) and den * both >= num * (len(a) + len(b) - both):
                assert len(np.intersect1d(ngram_join.segments(a, c, cells), ngram_join.segments(b, c, cells)))


def test_sets_that_share_a_key_share_a_star(spark):
    rows = [(i, [7] if i % 3 else [7, -5 - i // 100]) for i in range(1500)] + [(5000 + i, [100 + i // 2]) for i in range(40)] + [(9000, [])]
    got = {(r.star, r.rep) for r in ngram_join._stars(spark.createDataFrame(rows, "rep long, keys array<long>").repartition(5)).collect()}
    assert {(0, i) for i in range(1500)} <= got and {(5000 + i // 2 * 2, 5000 + i) for i in range(40)} <= got
    assert all(s <= r for s, r in got) and not any(r == 9000 for _, r in got)


def test_ngram_join_blocks_and_fragments(spark, monkeypatch):
    """Tiny blocks and fragments: many tasks a cluster, same links."""
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 3)
    monkeypatch.setattr(ngram_join, "FRAGMENT_GRAMS", 50)
    r = random.Random(1)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(40):
        w = list(base)
        w[r.randrange(60)] = f"x{r.randrange(9)}"
        texts.append(" ".join(w[: r.choice([60, 60, 58, 54])]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: (x.component_id, x.n_links) for x in ngram_join.ngram_join(df, 3, 80, 100).collect()}
    sets = {i: shingles(t, 3) for i, t in enumerate(texts)}
    links = {(a, b) for a in sets for b in sets if a != b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    comp = brute_components(links, sets)
    assert got == {i: (comp[i], sum(a == i for a, _ in links)) for i in sets}


def test_size_classes_leave_no_pair_out():
    """Two sets that may link are cut alike somewhere, into more segments than they can differ in."""
    for num, den in ((90, 100), (80, 100), (50, 100)):
        c = ngram_join.Classes(num, den)
        for a in range(1, 300):
            for b in range(a, a * den // num + 1):
                differ = (a + b) * (den - num) // (den + num)
                differ -= (differ - (b - a)) % 2  # the sizes fix its parity
                if differ >= max(1, b - a):
                    assert any(c.k[i] > differ + c.slack[i] for i in set(c.of(a)) & set(c.of(b))), (a, b)


def test_mix_budgets(spark):
    rows = [(i, " ".join(["w"] * (i % 7)), f"s{i % 4}" if i % 5 else None, "z") for i in range(200)] + [(3, "a b c", "s3", "z")] * 2 + [(500, None, "only", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    total = sum(len((t or "").split()) for _, t, _, _ in rows)
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 2 * r.size
    assert abs(sum(g[0].target for g in by.values()) - 1.5 * total) < 1e-6
    for g in by.values():
        assert g[0].source_size == sum(r.size for r in g)
        assert abs(sum(r.taken for r in g) - g[0].target) <= 0.5 and g[0].target <= 2 * g[0].source_size
    assert sorted(map(tuple, mixing.mix(df.repartition(5)).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert mixing.mix(df.limit(0)).count() == 0
    unique = df.where("doc_id != 3")
    plan = {r.doc_id: r.taken for r in mixing.mix(unique).collect()}
    words = {}
    for r in mixing.mixed_documents(unique).collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {k: v for k, v in plan.items() if v}


def test_equal_keys_and_hot_source_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(common, "ROWS_PER_BLOCK", 4)
    df = spark.range(300).selectExpr("id as doc_id", "'a b' as text", "if(id < 290, 'hot', 'cold') as source")
    got = common.with_position(common.stored(df.selectExpr("doc_id", "source", "substring(md5(string(doc_id)),1,16) as k", "2L as w"), "t"), ["source"], "k", ["doc_id"], weight="w", rows=10 ** 6).collect()
    for s in ("hot", "cold"):
        rows = sorted((r for r in got if r.source == s), key=lambda r: r.k)
        assert [r._pos for r in rows] == list(range(len(rows))) and [r._before for r in rows] == [2 * i for i in range(len(rows))]


T = chat.Template()
PIECES = ["</s>", "[INST]", "[/INST]", "<s>", "<<SYS>>", "<</SYS>>", "[ROLE=", "[/ROLE]", "\\", "<", "[", "]", " ", "\n", "a", "é", "\U0001f600", "</s", "s>"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "a]b\\", "</s>"]),
                          st.lists(st.sampled_from(PIECES), max_size=6).map("".join)), max_size=5))
def test_chat_texts_come_back(turns):
    for _, text in turns:
        e = T.escape(text)
        assert T.unescape(e) == text and not any(c in e for c in T.control)
    r = chat._Reader(T)
    for i, (role, text) in enumerate(turns):
        pre, post, loss = T.around(role)
        r.feed(T.begin + pre if i == 0 else pre, False)
        r.feed(T.escape(text), loss)
        r.feed(post, False)
    while r.buf and r.turn():
        pass
    assert not r.buf and r.n == len(turns)
    assert r.turns.hexdigest() == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    learnt = "".join(b for a, b in turns if a == "assistant")
    assert r.loss_chars == len(learnt) and r.loss.hexdigest() == hashlib.sha256(learnt.encode()).hexdigest()


def test_templates_of_other_shapes(spark):
    """A suffix may be empty or end in plain text, if the next prefix has a control string."""
    marks = {"user": ("<|user|>", "", False), "assistant": ("<|bot|>", " .", True)}
    t = chat.Template(begin="", turns=marks, other=("<|role={role}]", "<|end|>", False), control=("<|user|>", "<|bot|>", "<|role=", "<|end|>"))
    rows = [(1, 0, "user", "hi <|bot|> ."), (1, 1, "assistant", " . <|user|>\\"), (1, 2, "user", ""), (2, 0, "tool]x", "a"), (2, 1, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_chat(chat.format_chat(df, t), t).collect()}
    for conv in (1, 2):
        turns = [(role, text) for c, _, role, text in rows if c == conv]
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256("".join(x for r, x in turns if r == "assistant").encode()).hexdigest()


@pytest.mark.parametrize("change", [
    {"turns": {"user": ("", "", False)}}, {"turns": {"user": (" ", " [/INST]", False), "assistant": (" ", " </s>", True)}},
    {"control": ("",)}, {"control": ("a\\b",)}, {"other": ("[ROLE=] ", " [/ROLE]", False)}, {"other": ("x{role}", " [/ROLE]", False)}])
def test_impossible_templates_are_rejected(change):
    with pytest.raises(ValueError):
        chat.Template(**change)


def test_chat_states_nulls_and_ties(spark):
    rows = [(1, 0, "user", "q", 9), (1, 1, "assistant", "a", 9), (2, 0, "assistant", "a", 9), (2, None, "user", None, 9), (None, 0, None, "x", 9),
            (3, 1, "assistant", "b", 9), (3, 1, "assistant", "b", 9), (3, 0, "user", "", 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss int")
    seg = chat.format_chat(df)
    got = {r.conv_id: r for r in chat.read_chat(seg).collect()}
    assert {k: (r.n_turns, r.valid) for k, r in got.items()} == {1: (2, True), 2: (2, False), None: (1, False), 3: (3, False)}
    assert got[3].loss_chars == 2 and got[2].turns_sha256 == hashlib.sha256(b"assistant\na\nuser\n\n").hexdigest()
    text = "".join(r.text for r in sorted(seg.where("conv_id = 1").collect(), key=lambda r: r.seg_no))
    assert text == "<s>[INST] q [/INST] a </s>" and got[1].formatted_chars == len(text)
    assert chat.read_chat(chat.format_chat(df.limit(0))).count() == 0


def brute_padding(hist, k):
    from itertools import combinations

    lens = sorted(n for n, _ in hist)
    best = None
    for r in range(0, min(k, len(lens))):
        for cut in combinations(lens[:-1], r):
            ends = [*cut, lens[-1]]
            pad = sum(c * (min(e for e in ends if e >= n) - n) for n, c in hist)
            best = pad if best is None else min(best, pad)
    return best


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 5))
def test_boundaries_are_optimal(hist, k):
    hist = list(hist.items())
    ends = packing.best_boundaries(hist, k)
    assert len(ends) <= k and ends == sorted(set(ends)) and ends[-1] == max(n for n, _ in hist)
    assert sum(c * (min(e for e in ends if e >= n) - n) for n, c in hist) == brute_padding(hist, k)
    assert packing.best_boundaries([], k) == []


def test_boundaries_of_many_lengths_take_little_memory():
    import tracemalloc

    tracemalloc.start()
    got = packing.best_boundaries([(i, 1 + i % 5) for i in range(1, 4097)], 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[-1] == 4096 and len(got) == 4 and peak < 4 << 20


def test_batches_hold_their_budget(spark):
    rows = [(i, " ".join(["w"] * ((i * 37) % 90)), 1) for i in range(300)] + [(7, "a b", 1)] * 3 + [(900, None, 1), (901, "x " * 450, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket int")
    got = packing.pack(df, max_tokens=200, buckets=4, batch_tokens=500).collect()
    full = [r for r in got if r.n_tokens]
    assert sum(r.n_tokens for r in got) == sum(len((t or "").split()) for _, t, _ in rows)
    assert sorted(r.n_tokens for r in full if r.doc_id == 901) == [50, 200, 200]
    seen = {}
    for r in full:
        assert r.n_tokens <= r.bucket_len
        seen.setdefault((r.bucket, r.batch), []).append(r)
    for (b, _), x in seen.items():
        assert len(x) * x[0].bucket_len <= 500 and sorted(r.place for r in x) == list(range(len(x)))
    assert all(r.bucket is None for r in got if not r.n_tokens)
    assert packing.pack(df.limit(0)).count() == 0


def test_shards_are_even_and_keep_copies_together(spark):
    rows = [(i, f"text {i}") for i in range(150)] + [(200 + i, f"copy {i % 20}") for i in range(100)] + [(400 + i, "hot") for i in range(120)] + [(600, None), (601, None), (5, "text 5")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, shard int")
    got = sharding.shard(df, shards=8).collect()
    assert len(got) == len(rows)
    by, copies = {}, {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        if 200 <= r.doc_id < 300:
            copies.setdefault((r.doc_id - 200) % 20, set()).add(r.shard)
    sizes = [len(x) for x in by.values()]
    assert len(by) == 8 and max(sizes) - min(sizes) <= 1 and all(sorted(x) == list(range(len(x))) for x in by.values())
    assert sum(len(x) == 1 for x in copies.values()) >= 18  # cut edges: a random deal leaves almost none whole
    assert len({r.shard for r in got if 400 <= r.doc_id < 520}) <= 6
    assert {r.text_crc32 for r in got if r.doc_id >= 600} == {None} and {r.size for r in got if r.doc_id >= 600} == {16}
    assert sharding.shard(df.limit(0), shards=8).count() == 0
    few = sharding.shard(df.limit(3), shards=8).collect()
    assert sorted(r.slot for r in few) == [0, 0, 0]


def test_shard_columns_from_their_definition(spark):
    """Sizes, checksums, even counts and gapless slots, held against plain Python; rounds until the cut settles."""
    rows = [(i, f"text é {i % 90}") for i in range(700)] + [(None, "x"), (3, "text é 3"), (900, None), (901, "")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, key string")
    cut = {}
    for rounds in (0, None):
        got = sharding.shard(df, shards=7, rounds=rounds).collect()
        assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(
            ((i, len((t or "").encode()) + 16, None if t is None else zlib.crc32(t.encode())) for i, t in rows), key=repr)
        slots = {}
        for r in got:
            slots.setdefault(r.shard, []).append(r.slot)
        assert set(slots) == set(range(7)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
        groups = {}
        for r in got:
            if r.text_crc32 is not None:
                groups.setdefault(r.text_crc32, []).append(r.shard)
        cut[rounds] = sum(len(g) - max(map(g.count, g)) for g in groups.values())
    assert cut[None] < cut[0] / 4


def test_swaps_under_full_shards(spark):
    """All documents linked: shards are full from the start, so only swaps can move them."""
    df = spark.range(160).selectExpr("id as doc_id", "concat('t', id % 40) as text")
    got = sharding.shard(df, shards=4, rounds=6).collect()
    per = {}
    for r in got:
        per.setdefault(r.doc_id % 40, []).append(r.shard)
    assert sorted(sum(r.shard == s for r in got) for s in range(4)) == [40] * 4
    kept = sum(sum(x == y for x in v for y in v) - len(v) for v in per.values())
    start = {r.doc_id: r.shard for r in sharding.shard(df, shards=4, rounds=0).collect()}
    old = sum(sum(start[a] == start[b] for a in range(g, 160, 40) for b in range(g, 160, 40)) - 4 for g in range(40))
    assert kept > old


def test_licenses_and_inheritance(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, "/a/LICENSE", mit), (2, "/a/b/c/x.py", "code\nmore"), (3, "/a/b/LICENSE.txt", "words\n" + gpl), (4, "/a/b/c/y.py", "# " + mit.upper() + "\ncode"),
            (5, "/z/x.py", "nothing"), (6, None, gpl), (7, "/a/e.py", None), (8, "/a/f.py", ""), (8, "/a/f.py", ""), (9, "top.py", "a"),
            (10, "/ab/x.py", "not below /a"), (11, "/a/b/c/licensed.py", "the work and the version of this")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "file_id long, path string, text string, license string")
    out = license_scan.scan(df)
    got = sorted(out.collect(), key=lambda r: r.file_id)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString() and "Arrow" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r.file_id, r.own_license, r.license, r.license_dir) for r in got] == [
        (1, "MIT", "MIT", None), (2, None, "GPL-3.0", "/a/b"), (3, "GPL-3.0", "GPL-3.0", None), (4, "MIT", "MIT", None), (5, None, None, None),
        (6, "GPL-3.0", "GPL-3.0", None), (7, None, "MIT", "/a"), (8, None, "MIT", "/a"), (8, None, "MIT", "/a"), (9, None, None, None),
        (10, None, None, None), (11, None, "GPL-3.0", "/a/b")]
    assert license_scan.scan(df.limit(0)).count() == 0


def test_toxicity_held_out(spark):
    r = random.Random(5)
    clean = [f"c{i}" for i in range(150)]
    bad = ["vile", "rotten", "nasty"]

    def text(toxic):
        w = [r.choice(clean) for _ in range(r.randrange(20, 120))]
        for _ in range(max(1, len(w) // 20) if toxic else 0):
            w[r.randrange(len(w))] = r.choice(bad)
        return " ".join(w)

    docs = [(i, text(i % 5 == 0)) for i in range(600)] + [(1000, None), (1001, ""), (1002, "!!"), (1003, " ".join(r.choice(clean) for _ in range(40000)))]
    labels = [(i, int(i % 5 == 0), 1) for i in range(300)] + [(None, 1, 0), (5, None, 0), (77777, 1, 0)]
    d = spark.createDataFrame([(i, t, 0.5) for i, t in docs], "doc_id long, text string, severity double")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, text int")
    got = {x.doc_id: x for x in toxicity.toxicity(d, lab).collect()}
    held = [got[i].rejected == (i % 5 == 0) for i in range(300, 600)]
    assert np.mean(held) >= 0.98
    assert not any(got[i].rejected for i in (1000, 1001, 1002, 1003)) and got[1000].severity == 0
    assert np.mean([got[i].severity for i in range(300, 600, 5)]) > 1 > np.mean([got[i].severity for i in range(301, 600, 5)])
    nothing = toxicity.toxicity(d, lab.where("toxic = 0")).agg({"severity": "max"}).first()[0]
    assert nothing == 0 and toxicity.toxicity(d.limit(0), lab).count() == 0


def plain_severity(model, text):
    """(expected grade, most probable grade, chance of a grade above 0) from the model's numbers, term by term."""
    words = re.findall(r"\w+", (text or "").lower())
    if not words:
        return 0.0, 0, 0.0
    counts = Counter()
    for w in words:
        counts[w] += 1
        for k in (3, 4, 5, 6):
            if len(w) >= k:
                counts["^" + w[:k]] += 1
    score = 0.0
    for term, c in counts.items():
        present, often = model.weights.get(term, (0.0, 0.0))
        score += present + often * math.log(1 + 1000 * c / len(words))
    below = [1 / (1 + math.exp(score - t)) for t in model.thresholds] + [1.0]
    p = [b - a for a, b in zip([0.0, *below], below)]
    return sum(g * x for g, x in enumerate(p)), p.index(max(p)), 1 - p[0]


def test_toxicity_against_plain_scores(spark):
    """Every document's severity, grade and chance, restated from the fitted weights and thresholds."""
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, " .,; "), (-4, "Ä" * 5000), (None, "no id"), (-5, "x " * 9000), (-5, "twice")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(odd)
    model = toxicity.fit(docs, labels)
    assert model.weights and model.thresholds == sorted(model.thresholds) and all(a >= 0 and b >= 0 for a, b in model.weights.values())
    rows = toxicity.toxicity(docs, labels, model=model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        severity, grade, p = plain_severity(model, r.text)
        assert abs(r.severity - severity) < 1e-9 and abs(r.p_toxic - p) < 1e-9 and r.grade == grade and r.rejected == (r.p_toxic >= 0.5)


def test_cumulative_link_shares_weights_and_orders_thresholds():
    r = np.random.default_rng(0)
    x = r.random((800, 3))
    y = np.digitize(x @ [6, 3, 0] + r.logistic(size=800) * 0.5, [3, 5, 7])
    rows, cols = np.nonzero(x)
    w, t = toxicity.fit_cumulative_link(rows, cols, x[rows, cols], y, 3, 4, 1e-4, 2000)
    assert (np.diff(t) > 0).all() and w[0] > w[1] > w[2] >= 0
    p = toxicity.Model({}, list(t)).probabilities(x @ w)
    assert np.allclose(p.sum(axis=1), 1) and np.corrcoef(p @ np.arange(4), y)[0, 1] > 0.85


INTERNAL = ("_text", "_row", "_cut", "_size", "_taken", "_key", "_bucket", "_byte", "_bit", "_maybe", "_tox", "_blk", "_pos", "_before", "_n", "_w",
            "row", "maybe", "bucket", "bits", "cell", "cuts", "cut", "doc", "key", "tox", "rejected", "severity", "keys", "digest", "rep", "star")


def test_user_columns_come_back(spark):
    """Columns named like anything the stages use inside keep their values."""
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")) for c in INTERNAL})
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in INTERNAL), name
    assert P.STAGES[-1][1](spark, docs, sf).count() >= docs.count()


def test_id_maps_keep_exactly_the_ids(spark, monkeypatch):
    monkeypatch.setattr(common, "ID_BITS", 1 << 16)  # ids share bits
    df = spark.sql("select id - 50 as a, id as _x from range(200000) union all select cast(null as bigint), 1L")
    ids = spark.sql("select id * 7 - 49 as i from range(20000) union all select cast(null as bigint) union all select 65539L")
    want = {i * 7 - 49 for i in range(20000)} | {65539}
    assert {r.a for r in common.rows_with_ids(df, "a", ids).collect()} == want & set(range(-50, 199950))
    rest = [r.a for r in common.rows_without_ids(df, "a", ids).collect()]
    assert len(rest) == len(set(rest)) and set(rest) == (set(range(-50, 199950)) - want) | {None}
    assert common.rows_without_ids(df, "a", ids.limit(0)).count() == 200001 and common.rows_with_ids(df, "a", ids.limit(0)).count() == 0


def brute_license_scores(rows, templates):
    """Best TF-IDF cosine of each one-line file, document frequencies of all terms counted."""
    cut = lambda s: re.findall(r"[^\W_]+", s.lower())
    lines = {i: cut(s) for i, s in rows}
    df = Counter(t for w in lines.values() for t in set(w))
    idf = lambda t: math.log((len(lines) + 1) / (df[t] + 1)) + 1
    vector = lambda w: {t: (1 + math.log(c)) * idf(t) for t, c in Counter(w).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    known = [vector(cut(t)) for _, t in templates]
    out = {}
    for i, w in lines.items():
        v = vector(w)
        out[i] = max(sum(x * k.get(t, 0) for t, x in v.items()) / norm(v) / norm(k) for k in known)
    return out


@pytest.mark.parametrize("times", [1, 12])
def test_licenses_inside_longer_lines(spark, times):
    """All terms weigh by their own document frequency, so common words cost little and table size next to nothing."""
    mit = "Released under the MIT License."
    notices = [mit, mit + " en", mit + " en de", mit + " en de for", mit + " xylophone quartz", "en de for " + mit + " en de", "de license of en"]
    texts = notices + ["en de for"] * 150 + ["words en de"] * 40 + [f"for row{i} en" for i in range(60)]
    rows = list(enumerate(texts * times))
    df = spark.createDataFrame([(i, f"/{i}.txt", t) for i, t in rows], "file_id long, path string, text string").repartition(3)
    got = {r.file_id: r.own_score for r in license_scan.scan(df).collect()}
    want = brute_license_scores(rows, license_scan.TEMPLATES)
    assert len(got) == len(rows)
    for i, score in want.items():
        assert abs(score - 0.6) > 1e-4
        assert got[i] is None if score < 0.6 else abs(got[i] - score) < 2e-6, (rows[i], got[i], score)
    assert all(got[i] is not None and got[i] > 0.8 for i in range(4))


def test_mixed_documents_without_or_with_repeated_ids(spark):
    """Every row is emitted as often as its own `taken` says, so each source keeps its budget."""
    rows = [(None if i % 3 == 0 else i // 4, f"r{i} " + " ".join(["w"] * (i % 9)), f"s{i % 3}" if i % 7 else None, i) for i in range(240)]
    rows += [(7, " ".join(["long"] * 100), "s1", 900), (7, "same words", "s1", 901), (7, "same words", "s1", 902), (None, None, "s1", 903), (7, "", "s1", 904)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int").repartition(3)
    target, by_group = {}, {}
    for r in mixing.mix(df).collect():
        target[r.source] = r.target
        by_group[r.doc_id, r.source, r.size] = by_group.get((r.doc_id, r.source, r.size), 0) + r.taken
    text = {i: t for _, t, _, i in rows}
    size = {i: len((t or "").split()) for i, t in text.items()}
    words, got_group, cut = {}, {}, {}
    for r in mixing.mixed_documents(df).collect():
        n = len(r.text.split())
        words[r.source] = words.get(r.source, 0) + n
        k = (r.doc_id, r.source, size[r.size])
        got_group[k] = got_group.get(k, 0) + n
        if r.text != text[r.size]:
            cut[r.source] = cut.get(r.source, 0) + 1
            assert r.text.split() == text[r.size].split()[:n]
    assert all(abs(words.get(s, 0) - t) <= 0.5 for s, t in target.items())
    assert got_group == {k: v for k, v in by_group.items() if v} and all(c == 1 for c in cut.values())
