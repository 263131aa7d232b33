"""Conversation structure repair: the cheapest edits that give each conversation legal turns.

A conversation's rows are kept, rewritten to another role or deleted, and empty
turns are inserted, so that the roles read `(s?(ua)+)?`.  A Viterbi search over
the four states of that pattern streams over the rows and holds, per state, one
survivor: the end of a path in a tree of backpointers.

- Nodes count the survivors and nodes that refer to them.  A survivor that is
  dropped frees the branch nobody else refers to.  Once all survivors share an
  ancestor, the edits up to it are emitted, so memory holds what is still open.
- Survivors that cannot win any more (see `_prune`) are dropped, since an open
  path keeps its whole suffix.
- Paths of equal cost are told apart by their whole open suffixes: for each
  pair of survivors the edits from their first difference on are kept, so a
  comparison takes the same time however long the suffix is.

The search sees row numbers, role initials and faults only; texts are joined to
the edits afterwards, by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evallens.llm.common import stored

SOLID = r"[^\x20\x09-\x0D]"
LEGAL_PAIRS = ("su", "ua", "au")
ROWS_PER_TASK = 1 << 18


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with one kind of damage each, chosen by crc32(`conv_id:turn`) % 20.

    0 drops the row, 1 empties its text, 2 takes its `[.!?]` away, 3 repeats it,
    4 makes it a user's; others stay.  NULL is one space, in the key, role and text.
    """
    blank = F.lit(" ")
    name = lambda c: F.coalesce(F.col(c).cast("string"), blank)
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                name("role").alias("role"), name("text").alias("text"), kind.alias("kind")).where("kind != 0")
    copies = F.when(F.col("kind") == 3, F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def numbered(conversations: DataFrame) -> DataFrame:
    """Rows with their number in the conversation (from 1): by turn, NULL first, equal turns by role, then text.

    Adds `initial` (of the role), `illegal` (the pair with the row before is none of
    LEGAL_PAIRS) and `new_turn` (the first row of a turn that is not NULL).
    """
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    c = c.withColumn("initial", F.substring("role", 1, 1))
    return c.withColumns({
        "row_no": F.row_number().over(order).cast("long"),
        "illegal": ~F.concat(F.lag("initial").over(order), F.col("initial")).isin(*LEGAL_PAIRS),
        "new_turn": F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.lag("turn").over(order)),
    }).withColumn("illegal", F.coalesce("illegal", F.lit(False)))


def judged(rows: DataFrame) -> DataFrame:
    """`numbered` rows without texts, with their first fault: blank, duplicate (role and text
    seen earlier in the conversation), truncated (no `[.!?]` at the end), or none ('')."""
    text = F.col("text")
    slim = rows.select("conv_id", "row_no", "turn", "initial", "illegal", "new_turn",
                       (~text.rlike(SOLID)).alias("blank"), (~text.rlike(r"[.!?][\x20\x09-\x0D]*+\z")).alias("open"),
                       F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", text), 256)).alias("said"))
    again = slim.groupBy(F.col("conv_id").alias("_c"), F.col("said").alias("_s")).agg(F.min("row_no").alias("first"), F.count(F.lit(1)).alias("n"))
    again = stored(again.where("n > 1").drop("n"), "repair-repeated")
    # The rows' side of a left join may be split where one conversation or saying is frequent.
    seen = slim.join(again, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("said") == F.col("_s")), "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("row_no") > F.col("first"), "duplicate").when(F.col("open"), "truncated").otherwise("")
    return seen.select("conv_id", "row_no", "turn", "initial", "illegal", "new_turn", fault.alias("fault"))


class _Node:
    __slots__ = ("up", "kids", "held", "edit", "row", "role", "cost")

    def __init__(self, up, edit, row, role, cost):
        self.up, self.kids, self.held = up, [], 0
        self.edit, self.row, self.role, self.cost = edit, row, role, cost
        if up is not None:
            up.kids.append(self)


# States: 0 nothing yet, 1 after s, 2 after u, 3 after a.  What may follow, by role initial.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
WRITES = ((USER, "user"), (USER, "user"), (ASSISTANT, "assistant"), (USER, "user"))  # what a rewritten or new turn is
KEEP, REROLE, DELETE, INSERT = "KRDI"


class Search:
    """One conversation's search.  `step` takes its rows in order, `end` closes it; both
    return the edits that are certain: (edit, row number or None, new role or None, cost)."""

    def __init__(self):
        self.root = _Node(None, "", None, None, 0)
        self.root.held = 1
        self.best = {START: (0, self.root)}  # state: (cost, end of its path)
        self.differ = {}  # (state, state): the edits of both from their first difference on
        self.best, self.differ = self._inserted(self.best, self.differ)

    def _less(self, a, b, differ) -> bool:
        """Whether candidate a (state before, edits since) has the ASCII-least path of the two."""
        if a[0] == b[0]:
            return a[1] < b[1]
        x, y = differ[a[0], b[0]]
        return x + a[1] < y + b[1]

    @staticmethod
    def _pairs(new: dict, differ: dict) -> dict:
        """`differ` for survivors given as state: (state before, edits since)."""
        out = {}
        for q, (p, e) in new.items():
            for r, (o, f) in new.items():
                if q == r:
                    continue
                x, y = (e, f) if p == o else (differ[p, o][0] + e, differ[p, o][1] + f)
                k = 0
                while k < min(len(x), len(y)) and x[k] == y[k]:
                    k += 1
                x, y = x[k:], y[k:]
                out[q, r] = (x[:1], y[:1]) if x and y else (x, y)
        return out

    def _choose(self, offers, differ):
        """The best offer per state: offers are (state, cost, state before, edits, node, edit, row, role, its cost)."""
        win = {}
        for o in offers:
            w = win.get(o[0])
            if w is None or o[1] < w[1] or (o[1] == w[1] and self._less(o[2:4], w[2:4], differ)):
                win[o[0]] = o
        return win

    def _inserted(self, best: dict, differ: dict):
        """Survivors after inserting turns where that is cheaper, or as cheap and less."""
        offers = [(q, c, q, "", n, None, None, None, 0) for q, (c, n) in best.items()]
        for q in (START, SYSTEM, ASSISTANT):
            if q in best:
                offers.append((USER, best[q][0] + 2, q, INSERT, best[q][1], INSERT, None, "user", 2))
        win = self._choose(offers, differ)
        if USER in win:
            o = win[USER]
            two = (ASSISTANT, o[1] + 2, o[2], o[3] + INSERT, o, INSERT, None, "assistant", 2)
            win = self._choose([*win.values(), two], differ)
        return self._settle(win, differ)

    def _settle(self, win: dict, differ: dict):
        """Nodes for the winners; the survivors before them are released."""
        made = {}

        def node(o):
            if o[5] is None:
                return o[4]
            if id(o) not in made:
                up = node(o[4]) if isinstance(o[4], tuple) else o[4]
                made[id(o)] = _Node(up, *o[5:9])
            return made[id(o)]

        best = {q: (o[1], node(o)) for q, o in win.items()}
        for _, n in best.values():
            n.held += 1
        for _, n in self.best.values():
            self._release(n)
        return best, self._pairs({q: (o[2], o[3]) for q, o in win.items()}, differ)

    @staticmethod
    def _release(n: _Node) -> None:
        n.held -= 1
        while not n.held and not n.kids and n.up is not None:
            up = n.up
            up.kids.remove(n)
            n.up, n = None, up

    def _prune(self) -> None:
        """Drops survivors that are dearer for every possible rest.

        What may follow state 1 may follow 0 and 3 at the same cost.  What may follow
        0 costs at most 3 more after 3 (a kept system turn is deleted instead), and at
        most 4 more after 1 (that, or a user and an assistant turn at the end).
        """
        c = {q: v[0] for q, v in self.best.items()}
        far = 1 << 60
        gone = []
        if c.get(SYSTEM, -1) > min(c.get(START, far), c.get(ASSISTANT, far)):
            gone.append(SYSTEM)
        if c.get(START, -1) > min(c.get(ASSISTANT, far) + 3, c.get(SYSTEM, far) + 4):
            gone.append(START)
        for q in gone:
            self._release(self.best.pop(q)[1])

    def _certain(self):
        while not self.root.held and len(self.root.kids) == 1:
            self.root = self.root.kids[0]
            self.root.up = None
            yield self.root.edit, self.root.row, self.root.role, self.root.cost

    def step(self, row: int, initial: str, fault: str):
        offers = []
        late = 1 if fault == "truncated" else 0
        for q, (c, n) in self.best.items():
            offers.append((q, c + 3, q, DELETE, n, DELETE, row, None, 3))
            if fault in ("blank", "duplicate"):
                continue
            if initial in FOLLOWS[q]:
                offers.append((FOLLOWS[q][initial], c + late, q, KEEP, n, KEEP, row, None, late))
            to, role = WRITES[q]
            if FOLLOWS[q].get(initial) != to:
                offers.append((to, c + 2 + late, q, REROLE, n, REROLE, row, role, 2 + late))
        best, differ = self._settle(self._choose(offers, self.differ), self.differ)
        self.best = best
        self.best, self.differ = self._inserted(best, differ)
        self._prune()
        yield from self._certain()

    def end(self):
        ends = [(ASSISTANT, c, q, "", n, None, None, None, 0) for q, (c, n) in self.best.items() if q in (START, ASSISTANT)]
        self.best, self.differ = self._settle(self._choose(ends, self.differ), self.differ)
        yield from self._certain()


EDITS = "conv_id long, edit_no long, edit string, row_no long, new_role string, cost long"


def edits(rows: DataFrame) -> DataFrame:
    """The cheapest edits of each conversation of `judged` rows, in order (edit_no from 1).

    edit: K keep, R rewrite the role, D delete, I insert.  Deleting costs 3, rewriting
    and inserting 2, and a truncated row that stays 1; blank and duplicate rows are
    deleted.  Of equally cheap edits those whose letters are ASCII-least.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // ROWS_PER_TASK)
    dealt = rows.select("conv_id", "row_no", "initial", "fault").repartition(parts, "conv_id").sortWithinPartitions("conv_id", "row_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, search, here, count = [], None, object(), 0

        def take(found):
            nonlocal count
            for e, row, role, cost in found:
                count += 1
                out.append((here, count, e, row, role, cost))

        def table():
            rows, out[:] = list(zip(*out)) or [[]] * 6, []
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)],
                                              names=["conv_id", "edit_no", "edit", "row_no", "new_role", "cost"])

        for b in batches:
            for conv, row, initial, fault in zip(*(b.column(i).to_pylist() for i in range(4))):
                if search is None or conv != here:
                    if search is not None:
                        take(search.end())
                    here, search, count = conv, Search(), 0
                take(search.step(row, initial, fault))
            yield table()
        if search is not None:
            take(search.end())
            yield table()

    return dealt.mapInArrow(run, EDITS)


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(facts, edits) of conversations (conv_id, turn, role, text).

    facts, per conversation: gaps (turn numbers missing between the least and the
    greatest; 0 if all are NULL), blank, duplicate, truncated (rows by first fault),
    illegal (neighbouring rows whose roles may not follow one another).

    edits, per edit: conv_id, edit_no, edit, row_no, cost, role, text; those but D
    in order are the repaired conversation.  Rows are taken by turn (NULL first;
    equal turns by role, then text; repeated rows are rows of their own, and
    duplicates).  NULL role and text are empty; NULL conv_id is a conversation.  An
    empty conversation has no rows here, an empty table none at all.  Other columns
    are not read.  One task streams over a conversation, however long; it holds the
    edits that are still open.
    """
    rows = stored(numbered(conversations), "repair-rows")
    found = stored(judged(rows), "repair-judged")
    count = lambda fault: F.count_if(F.col("fault") == fault).alias(fault)
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_if("new_turn")
    facts = found.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), count("blank"), count("duplicate"),
                                         count("truncated"), F.count_if("illegal").alias("illegal"))
    done = stored(edits(found), "repair-edits")
    texts = rows.select(F.col("conv_id").alias("_c"), F.col("row_no").alias("_r"), "role", "text")
    full = done.join(texts, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("row_no") == F.col("_r")), "left")
    return facts, full.select("conv_id", "edit_no", "edit", "row_no", "cost", F.coalesce("new_role", "role").alias("role"),
                              F.coalesce("text", F.lit("")).alias("text"))


def digests(full: DataFrame) -> DataFrame:
    """(conv_id, cost, audit, repaired_sha256) from `repair`'s edits: the letters in order, and
    the SHA-256 of the repaired turns as `role:text`, a newline between."""
    parts = max(int(full.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = full.select("conv_id", "edit_no", "edit", "cost", "role", "text").repartition(parts, "conv_id").sortWithinPartitions("conv_id", "edit_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, letters, sha, some, cost, out = object(), None, None, False, 0, []

        def table():
            cols, out[:] = list(zip(*out)) or [[]] * 4, []
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                              names=["conv_id", "cost", "audit", "repaired_sha256"])

        for b in batches:
            for conv, edit, c, role, text in zip(*(b.column(x).to_pylist() for x in ("conv_id", "edit", "cost", "role", "text"))):
                if letters is None or conv != here:
                    if letters is not None:
                        out.append((here, cost, letters.decode(), sha.hexdigest()))
                    here, letters, sha, some, cost = conv, bytearray(), hashlib.sha256(), False, 0
                letters += edit.encode()
                cost += c
                if edit != DELETE:
                    sha.update((("\n" if some else "") + f"{role}:{text}").encode("utf-8"))
                    some = True
            yield table()
        if letters is not None:
            out.append((here, cost, letters.decode(), sha.hexdigest()))
            yield table()

    return dealt.mapInArrow(run, "conv_id long, cost long, audit string, repaired_sha256 string")
