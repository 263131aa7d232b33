"""The prefix trie against brute force, and the z-fast trie of one task by itself."""

import hashlib
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from evallens.llm import prefix_trie as T


def chained(seq, start=0, root=T.TOP):
    out, now = [], root
    for x in seq:
        now = hashlib.blake2b(now + x, digest_size=T.WIDTH).digest()
        out.append(now)
    return out


def as_path(conv, seq):
    return T._Path(conv, 0, T.TOP, b"".join(chained(seq)), [len(x) for x in seq])


def test_two_fattest():
    for a in range(70):
        for b in range(a + 1, 71):
            best = max(range(a + 1, b + 1), key=lambda x: x & -x)
            assert T.two_fattest(a, b) == best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"x", b"yy"]), max_size=12), min_size=1, max_size=25), st.integers(1, 7))
def test_trie_of_one_task(seqs, batch):
    trie, paths = T.ZFastTrie(), [as_path(i, s) for i, s in enumerate(seqs)]
    for lo in range(0, len(paths), batch):
        trie.insert(paths[lo:lo + batch])
    got = sorted((d, tuple(n), c, m) for d, n, _, _, c, m in trie.expand())
    want = {}
    for i, s in enumerate(seqs):
        for d in range(len(s) + 1):
            want.setdefault((d, tuple(([T.TOP] + chained(s))[d])), []).append(i)
    assert got == sorted((d, n, len(v), min(v)) for (d, n), v in want.items())
    for p in paths:  # a stored path is passed to its end
        node, out = trie.locate(p)
        assert out is None and node.high == p.end
    assert all(h is n for n in trie.nodes for h in [trie.handles[n.path.at(T.two_fattest(n.low, n.high))]])


def brute(convs):
    """Rows of the query from {conv: [(role, text)]}."""
    seqs = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (c % 5 if c >= 0 else -(-c % 5))
        seqs[c] = convs.get(donor, [])[:h] + own[h:]
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    kids = {}
    for n in nodes:
        if n:
            kids.setdefault(n[:-1], []).append(n)
    out = []
    for n, members in nodes.items():
        sub = [m for m in nodes if m[:len(n)] == n]
        ends = ",".join(str(c) for c in sorted(c for c in members if len(seqs[c]) == len(n)))
        out.append((min(members), len(n), min(nodes[n[:-1]]) if n else None, len(members), len(kids.get(n, [])), sum(m not in kids for m in sub),
                    sum((len(nodes[m]) - 1) * len(m[-1][1].encode()) for m in sub if m), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def run(spark, convs, schema="conv_id long, turn long, role string, text string, node int, depth string"):
    rows = [(c, t, role, text, 1, "d") for c, s in convs.items() for t, (role, text) in enumerate(s)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, schema)
    return sorted((tuple(r[x] for x in COLUMNS) for r in T.prefix_trie(*T.rebuilt(df)).collect()), key=repr)


def corpus(seed, n):
    r = random.Random(seed)
    return {c: [(r.choice(["user", "assistant"]), r.choice(["a", "é", ""])) for _ in range(r.choice([1, 2, 5, 9, 12, 30]))] for c in r.sample(range(-40, 400), n)}


def test_matches_brute_force(spark):
    convs = corpus(1, 120)
    convs |= {1000 + i: [("user", "same"), ("assistant", "same too")] * 6 for i in range(30)}
    assert run(spark, convs) == brute(convs)


def test_long_conversations_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(T, "PIECE", 4)
    monkeypatch.setattr(T, "NODES", 20)
    monkeypatch.setattr(T, "BATCH", 3)
    convs = corpus(2, 60)
    convs |= {5000 + i: [("user", "x")] * (3 + i) for i in range(14)}  # each one more turn
    assert run(spark, convs) == brute(convs)


def test_edges(spark):
    df = spark.createDataFrame([(None, 0, "user", "lost"), (0, None, None, None), (0, 1, "user", "b" * 70000), (7, 0, "user", "x"), (7, 0, "user", "x")],
                               "conv_id long, turn long, role string, text string")
    got = sorted((tuple(r[x] for x in COLUMNS) for r in T.prefix_trie(*T.rebuilt(df)).collect()), key=repr)
    assert got == brute({0: [("", ""), ("user", "b" * 70000)], 7: [("user", "x"), ("user", "x")]})
    assert T.prefix_trie(*T.rebuilt(df.limit(0))).collect() == []
