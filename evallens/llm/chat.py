"""Chat formatting: a declarative template, a finite-state check of the turn order,
and text segments with per-segment loss flags.

Turns are dealt by conversation and sorted inside the partitions, and both the
formatter and the reader stream over them, so a task holds one turn at a time
however long a conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """What stands around each turn, and which turn may follow which.

    `turns`: role -> (prefix, suffix, loss).  Roles without an entry use
    `other`, whose prefix holds the (escaped) role at `{role}`.  `control`: the
    strings that mark turns; they never occur in an escaped text.  `steps`: the
    allowed next roles by state (the last role, or `start`); a conversation is
    valid if every step is allowed and it stops in one of `final`.
    """

    begin: str = "<s>"
    turns: dict = field(default_factory=lambda: {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n\n", False),
        "user": ("[INST] ", " [/INST]", False),
        "assistant": (" ", " </s>", True),
    })
    other: tuple = ("[ROLE={role}] ", " [/ROLE]\n", False)
    control: tuple = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE=", "[/ROLE]")
    steps: dict = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple = ("assistant",)

    def __post_init__(self):
        """Rejects templates whose texts could not be told from what stands around them."""
        if any(not c or ESCAPE in c for c in self.control):
            raise ValueError("control strings are not empty and do not hold the escape character")
        parts = [*self.turns.values(), (*self.other[:2], False)]
        marked = lambda s: any(c in s for c in self.control)
        if "{role}" not in self.other[0] or not marked(self.other[0].split("{role}")[0]) or not marked(self.other[1]):
            raise ValueError("other roles need a control string before and after")
        if len({p for p, _, _ in self.turns.values()}) < len(self.turns):
            raise ValueError("two roles begin alike")
        for _, post, _ in parts:
            for pre, _, _ in parts:
                if not marked(post) and not marked(post + pre):
                    raise ValueError(f"no control string between a text, {post!r} and {pre!r}")

    def around(self, role: str) -> tuple[str, str, bool]:
        if role in self.turns:
            return self.turns[role]
        pre, post, loss = self.other
        return pre.replace("{role}", self.escape(role).replace("]", ESCAPE + "]")), post, loss

    def _control(self):
        return re.compile("|".join(re.escape(c) for c in sorted(self.control, key=len, reverse=True)))

    def escape(self, text: str) -> str:
        """Doubles the escape character and puts one inside each control string."""
        return self._control().sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text.replace(ESCAPE, ESCAPE * 2))

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)


SEGMENT_SCHEMA = "conv_id long, turn_no long, seg_no long, text string, loss boolean, step_ok boolean"


def _sorted(conversations: DataFrame) -> DataFrame:
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                             F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return c.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")


def format_chat(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """Segments of the formatted conversations: (conv_id, turn_no, seg_no, text, loss, step_ok).

    The concatenation of a conversation's segments, by `seg_no`, is the
    formatted text; `loss` is true on the (escaped) texts that the model learns
    and on nothing else.  `step_ok`: the state machine allows this turn after
    the one before.  Rows are taken by turn (NULL last; equal turns by role,
    then text; repeated rows are turns of their own).  NULL text and NULL role
    are empty; a NULL conv_id is a conversation.  Nothing is left out: turns out of order
    are formatted too, and flagged.  Other columns are not read.
    """
    t = template or Template()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, state, turn, seg = object(), "start", 0, 0
        for pdf in batches:
            out = []
            ids = pdf["conv_id"].astype("Int64")
            for cid, role, text in zip(ids, pdf["role"], pdf["text"]):
                cid = None if pd.isna(cid) else int(cid)
                if cid != here:
                    here, state, turn, seg = cid, "start", 0, 0
                pre, post, loss = t.around(role)
                ok = role in t.steps.get(state, ())
                for part, learn in ((t.begin + pre if turn == 0 else pre, False), (t.escape(text), loss), (post, False)):
                    out.append((cid, turn, seg, part, learn, ok))
                    seg += 1
                turn, state = turn + 1, role
            res = pd.DataFrame(out, columns=["conv_id", "turn_no", "seg_no", "text", "loss", "step_ok"])
            yield res.astype({"conv_id": "Int64"})

    return _sorted(conversations).mapInPandas(run, SEGMENT_SCHEMA)


DIGEST_SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                 "formatted_chars long, valid boolean")


class _Reader:
    """Reads one formatted conversation back from its text alone (fed piece by piece)."""

    def __init__(self, t: Template):
        self.t, self.buf, self.begun, self.state, self.ok, self.last = t, "", False, "start", True, ""
        self.turns, self.n = hashlib.sha256(), 0
        self.loss, self.loss_chars, self.chars = hashlib.sha256(), 0, 0
        self.open = [(pre, role) for role, (pre, _, _) in t.turns.items()]
        self.open.sort(key=lambda x: -len(x[0]))
        self.other = t.other[0].split("{role}")

    def feed(self, piece: str, learn: bool) -> None:
        self.chars += len(piece)
        self.buf += piece
        if learn:
            text = self.t.unescape(piece)
            self.loss.update(text.encode("utf-8"))
            self.loss_chars += len(text)

    def turn(self) -> bool:
        """Takes one whole turn off the buffer, if there is one."""
        b = self.buf
        at = 0 if self.begun else len(self.t.begin)
        if not b.startswith(self.t.begin) and not self.begun:
            return False
        if b.startswith(self.other[0], at):
            stop = re.compile(r"(?:[^\\\]]|\\.)*", re.S).match(b, at + len(self.other[0])).end()
            if not b.startswith(self.other[1], stop):
                return False
            role, start, post = self.t.unescape(b[at + len(self.other[0]):stop]), stop + len(self.other[1]), self.t.other[1]
        else:
            pre, role = next(((p, r) for p, r in self.open if b.startswith(p, at)), (None, None))
            if role is None:
                return False
            start, post = at + len(pre), self.t.turns[role][1]
        # The escaped text holds no control string, so the first one of the suffix ends it;
        # a suffix without one ends what has been fed, whole turns at a time.
        marks = [(post.find(c), c) for c in self.t.control if c in post]
        if marks:
            off, mark = min(marks, key=lambda x: (x[0], -len(x[1])))
            k = b.find(mark, start)
            while k >= 0 and not (k - off >= start and b.startswith(post, k - off)):
                k = b.find(mark, k + 1)
            if k < 0:
                return False
            stop = k - off
        else:
            stop = len(b) - len(post)
            if stop < start or not b.endswith(post):
                return False
        text = self.t.unescape(b[start:stop])
        self.turns.update(f"{role}\n{text}\n".encode("utf-8"))
        self.ok &= role in self.t.steps.get(self.state, ())
        self.n, self.state, self.begun, self.buf = self.n + 1, role, True, b[stop + len(post):]
        return True


def read_chat(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """Reads formatted conversations back: one row per conversation.

    n_turns and turns_sha256 (over role, newline, text, newline of each turn)
    come from parsing the formatted text, loss_chars and loss_sha256 from the
    segments under the loss flag, unescaped; formatted_chars counts the
    formatted text's code points; valid: every step is allowed and the last
    role is final.  Text that is not in the template raises an error.
    """
    t = template or Template()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, r = object(), None

        def row():
            if r.buf:
                raise ValueError(f"conversation {here}: not in the template: {r.buf[:80]!r}")
            return (here, r.n, r.turns.hexdigest(), r.loss_chars, r.loss.hexdigest(), r.chars, r.ok and r.state in t.final)

        def frame(rows):
            res = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"])
            return res.astype({"conv_id": "Int64"})

        for pdf in batches:
            out = []
            for cid, seg, piece, learn in zip(pdf["conv_id"].astype("Int64"), pdf["seg_no"], pdf["text"], pdf["loss"]):
                cid = None if pd.isna(cid) else int(cid)
                if r is None or cid != here:
                    if r is not None:
                        out.append(row())
                    here, r = cid, _Reader(t)
                r.feed(piece, learn)
                if seg % 3 == 2:
                    while r.buf and r.turn():
                        pass
            yield frame(out)
        if r is not None:
            yield frame([row()])

    return (segments.repartition("conv_id").sortWithinPartitions("conv_id", "seg_no")
            .select("conv_id", "seg_no", "text", "loss").mapInPandas(run, DIGEST_SCHEMA))
