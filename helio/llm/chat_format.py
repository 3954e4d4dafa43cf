"""Conversations as training windows of a token budget.

Each turn is formatted with control strings around it; control strings inside texts and roles are escaped, so
that a window can be read back. Prefix sums of the turns' tokens choose spans of whole turns: a window
holds the system turn, if the conversation begins with one, as much of the turns before as the
history budget and the next turn leave room for, and as many new turns as fit. Assistant texts of new turns
are targets; in repeated turns they are masked, so that each is a target once. A turn that does not fit alone
has a window of its own, marked as over the budget; no text is cut.

Conversations are dealt in segments of SEGMENT_TURNS turn numbers, so that a long one is spread over tasks; no
history is repeated across their borders, the system turn is. Rows pass in order, and a task holds a window, its
history and a batch of rows. The query's digests of whole conversations need a conversation's windows in one
task, as digests cannot be joined; they pass one after the other.

Defined cases: a null text or role is empty; null turns come first, in a segment of their own; rows
of equal turn are in the order of role and text, repeated rows are turns of their own; a null conv_id is a
conversation of its own; empty assistant texts are empty targets; other columns are not read; no rows give
no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helio.llm.common import parallel, table
from helio.llm.packing import vocabulary
from helio.llm.token_alignment import First

#: Control strings of the template and of other common ones, and what they begin with.
OPEN, CLOSE = "<|turn|>", "<|end|>"
CONTROLS = (OPEN, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: A control string's first letter, any number of escapes, the rest of it.
_ESCAPED = re.compile(r"([<\[])(\\*)(?=" + "|".join(re.escape(c[1:]) for c in CONTROLS) + ")")
_UNESCAPED = re.compile(r"([<\[])\\(\\*)(?=" + "|".join(re.escape(c[1:]) for c in CONTROLS) + ")")
TURN = re.compile(re.escape(OPEN) + "(.*?)\n(.*?)" + re.escape(CLOSE), re.DOTALL)
#: Tokens of a window and of the repeated history in it; turn numbers of a segment.
BUDGET, HISTORY, SEGMENT_TURNS = 2048, 512, 4096
#: The segment of turns without a number.
NO_TURN = -(1 << 62)
#: The role that opens a conversation, and the one whose texts are targets.
SYSTEM, TARGET = "system", "assistant"

WINDOWS = """conv_id string, segment long, window long, n_repeated long, n_turns long, n_tokens long,
    over_budget boolean, text string, loss_from array<long>, loss_to array<long>"""
RESULT = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    """No control string is left; one more backslash stands behind the first letter of each, escaped before or not."""
    return _ESCAPED.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(r"\1\2", text)


def escape_role(role: str) -> str:
    """As for texts, on one line."""
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


@dataclass
class Turn:
    role: str
    text: str
    tokens: int

    def said(self) -> tuple[str, int]:
        """The formatted turn, and where its text begins."""
        head = f"{OPEN}{escape_role(self.role)}\n"
        return head + escape(self.text) + CLOSE, len(head)


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> First:
    return First(path)


def n_tokens(path: str, role: str, text: str) -> int:
    """Tokens of a turn: two control strings, and what stands between them."""
    return 2 + len(_tokenizer(path).encode(f"{escape_role(role)}\n{escape(text)}"))


class Windows:
    """Cuts one segment of a conversation into windows, as its turns come in."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        #: The system turn, if it opens the conversation; whether this segment has still to say it for the first time.
        self.lead: Turn | None = None
        self.lead_is_new = False
        #: The last turns; those before ``fresh`` stand in a window already.
        self.turns: list[Turn] = []
        self.fresh = self.seen = self.made = 0

    def context(self, first: Turn) -> None:
        """The conversation's first turn, which an earlier segment holds."""
        self.lead = first if first.role == SYSTEM else None
        self.seen = 1

    def add(self, turn: Turn) -> None:
        if not self.seen and turn.role == SYSTEM:
            self.lead, self.lead_is_new = turn, True
        else:
            self.turns.append(turn)
        self.seen += 1

    def cut(self, done: bool) -> Iterator[tuple]:
        """The windows that the turns at hand fill; all of them when ``done``."""
        sums = np.concatenate(([0], np.cumsum([t.tokens for t in self.turns], dtype=np.int64)))
        n = len(self.turns)
        room = self.budget - (self.lead.tokens if self.lead else 0)
        while self.fresh < n:
            at = self.fresh
            spare = max(0, min(self.history, room - self.turns[at].tokens))
            begin = int(np.searchsorted(sums, sums[at] - spare))
            end = max(at + 1, int(np.searchsorted(sums, sums[begin] + room, "right")) - 1)
            if end == n and not done:
                # a later turn may still fit
                break
            yield self._window(begin, at, end)
            self.fresh = end
        if done and self.lead_is_new:
            yield self._window(0, 0, 0)
        keep = int(np.searchsorted(sums, sums[self.fresh] - self.history))
        self.turns, self.fresh = self.turns[keep:], self.fresh - keep

    def _window(self, begin: int, at: int, end: int) -> tuple:
        lead = [self.lead] if self.lead else []
        turns = [*lead, *self.turns[begin:end]]
        repeated = len(lead) - self.lead_is_new + at - begin
        said, starts, stops, size = [], [], [], 0
        for place, turn in enumerate(turns):
            text, head = turn.said()
            if place >= repeated and turn.role == TARGET:
                starts.append(size + head)
                stops.append(size + len(text) - len(CLOSE))
            said.append(text)
            size += len(text)
        total = sum(t.tokens for t in turns)
        self.lead_is_new = False
        self.made += 1
        return self.made - 1, repeated, len(turns), total, total > self.budget, "".join(said), starts, stops


def _cutter(path: str, budget: int, history: int):
    names = [c.split()[0] for c in WINDOWS.split(",")]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, key, out = None, None, []
        for frame in frames:
            for row in frame.itertuples(index=False):
                now = (row.conv_id if isinstance(row.conv_id, str) else None, row.segment)
                if own is None or now != key:
                    if own is not None:
                        out += [(*key, *w) for w in own.cut(True)]
                    own, key = Windows(budget, history), now
                turn = Turn(row.role, row.text, n_tokens(path, row.role, row.text))
                if row.place:
                    own.add(turn)
                else:
                    own.context(turn)
            out += [(*key, *w) for w in own.cut(False)] if own is not None else []
            if out:
                yield pd.DataFrame(out, columns=names)
                out = []
        if own is not None:
            yield pd.DataFrame([(*key, *w) for w in own.cut(True)], columns=names)

    return cut


def windows(rows: DataFrame, path: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """The windows of all conversations of ``rows`` (conv_id, turn, role, text), in each segment numbered from 0."""
    turn = F.col("turn").cast("long")
    turns = rows.select(
        F.col("conv_id").cast("string").alias("conv_id"),
        # a null turn comes before any other
        F.coalesce(F.floor(turn / SEGMENT_TURNS), F.lit(NO_TURN)).alias("segment"),
        turn.alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # the first turn of a conversation of several segments goes before each later one
    segments = turns.groupBy("conv_id", "segment").count().drop("count")
    firsts = segments.groupBy("conv_id").agg(F.min("segment").alias("first"), F.max("segment").alias("last")).where("first < last").drop("last")
    firsts = firsts.withColumnRenamed("conv_id", "of")
    same = F.col("conv_id").eqNullSafe(F.col("of"))
    opening = turns.join(firsts, same & (F.col("segment") == F.col("first"))).groupBy("of", "first").agg(F.min(F.struct("turn", "role", "text")).alias("head"))
    later = segments.join(opening, same).where("segment > first")
    contexts = later.select("conv_id", "segment", F.lit(None).cast("long").alias("turn"), "head.role", "head.text", F.lit(0).alias("place"))
    dealt = turns.withColumn("place", F.lit(1)).unionByName(contexts).repartition(parallel(rows.sparkSession), "conv_id", "segment")
    ordered = dealt.sortWithinPartitions("conv_id", "segment", "place", F.asc_nulls_first("turn"), "role", "text")
    return ordered.select("conv_id", "segment", "role", "text", "place").mapInPandas(_cutter(path, budget, history), WINDOWS)


def parsed(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a window."""
    return [(unescape_role(role), unescape(said)) for role, said in TURN.findall(text)]


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        turns = [parsed(t)[n:] for t, n in zip(frame["text"], frame["n_repeated"], strict=True)]
        loss = ["".join([unescape(t[a:b]) for a, b in zip(lo, hi, strict=True)]) for t, lo, hi in zip(frame["text"], frame["loss_from"], frame["loss_to"], strict=True)]
        yield pd.DataFrame(
            {
                **{c: frame[c] for c in ("conv_id", "segment", "window")},
                "n_turns": [len(t) for t in turns],
                "said": ["".join([f"{r}\n{t}\n" for r, t in own]) for own in turns],
                "loss": loss,
                "chars": frame["text"].str.len(),
            }
        )


def _digested(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in RESULT.split(", ")]
    key, out, n, loss_chars, chars, said, loss = None, [], 0, 0, 0, None, None

    def row() -> tuple:
        return key, n, said.hexdigest(), loss_chars, loss.hexdigest(), chars

    for frame in frames:
        for r in frame.itertuples(index=False):
            now = r.conv_id if isinstance(r.conv_id, str) else None
            if said is None or now != key:
                if said is not None:
                    out.append(row())
                key, n, loss_chars, chars, said, loss = now, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            n, loss_chars, chars = n + r.n_turns, loss_chars + len(r.loss), chars + r.chars
            said.update(r.said.encode("utf-8", "surrogatepass"))
            loss.update(r.loss.encode("utf-8", "surrogatepass"))
        if out:
            yield pd.DataFrame(out, columns=names)
            out = []
    if said is not None:
        yield pd.DataFrame([row()], columns=names)


def digests(made: DataFrame) -> DataFrame:
    """A row for each conversation, read back from its windows: its turns, and what is under the loss mask."""
    read = made.mapInPandas(_read, "conv_id string, segment long, window long, n_turns long, said string, loss string, chars long")
    dealt = read.repartition(parallel(made.sparkSession), "conv_id").sortWithinPartitions("conv_id", "segment", "window")
    return dealt.mapInPandas(_digested, RESULT)


def query(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    found = digests(windows(conversations.unionByName(planted), vocabulary()))
    return found.withColumn("conv_id", F.col("conv_id").cast("long"))
