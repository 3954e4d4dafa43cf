"""Repair of the structure of conversations by the cheapest edits.

A conversation's rows become letters, one for each row: its role's initial and its fault. Signatures are
sorted from their ends, so that those with a common ending lie side by side; the automaton shares endings,
a node being an ending. For each node and each state of the grammar ``(s?(ua)+)?`` the cost still to go and
the first edit of the best audit are computed once, from the end, and stay while the next signature ends
alike. Reading first edits from the whole signature on gives its audit. As each first edit leads to one
node and state, the ASCII-least of equally cheap audits begins with the least first edit.

Long conversations do not gather their texts: letters are found row by row, repeated rows by a window over
conversation, role and digest of the text, signatures from sorted narrow rows as they pass, and the digest of
the repaired conversation is taken while its rows pass in order. One task holds a signature of the longest
conversation, a byte a row, and 36 bytes for each node of its path. Conversations with one
signature are spread by their id.

Defined cases: nulls in any column count as one space, but a null turn sorts first and is left out of gaps, and a
null conv_id is a conversation of its own that keeps a null id; rows of equal turn are in the order of role
and digest of the text, repeated rows being adjacent; a role's initial is its first letter, none if
it is empty; conversations without rows after damage have zeros, an empty audit and the digest of the empty
string; other columns are not read; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helio.llm.common import BATCH_ROWS, parallel, table
from helio.session import materialize

#: White space, ends of sentences, costs of edits.
BLANK, STOPS = " \t\n\x0b\x0c\r", ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States of the grammar: nothing yet, after s, after u, after a. States that can end.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: The state behind an inserted or re-roled row, and behind a kept one.
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
#: Letters of rows: role initials, other roles, upper case if truncated, rows that must go.
OTHER, MUST_GO = "o", "x"
LEGAL = {"su", "ua", "au"}
FAR = 1 << 60

SIGNED = "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, signature string"
COSTED = f"{SIGNED}, cost long, audit string"
ROWS = "conv_id string, place long, role string, text string"
RESULT = "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class EndingAutomaton:
    """Endings of signatures, each a node; the path of the last signature stays, its common ending is kept."""

    def __init__(self) -> None:
        self.path = ""
        #: For each node of the path and each state: cost to go, and the first edit.
        self.costs = array("q")
        self.edits = bytearray()
        self._add([0 if s in ENDS else FAR for s in range(4)], [" "] * 4)

    def _add(self, costs: list[int], edits: list[str]) -> None:
        # an insertion stays at the node; two in a row lead furthest, a third repeats the first
        for _ in range(2):
            for s in range(4):
                cost = INSERT + costs[NEXT[s]]
                if cost < costs[s] or cost == costs[s] < FAR and "I" < edits[s]:
                    costs[s], edits[s] = cost, "I"
        self.costs.extend(costs)
        self.edits += "".join(edits).encode()

    def _extend(self, letter: str) -> None:
        at = len(self.costs) - 4
        after = self.costs[at:]
        kept = KEPT.get(letter.lower())
        more = TRUNCATED if letter.isupper() else 0
        costs, edits = [], []
        for s in range(4):
            options = [(DELETE + after[s], "D")]
            if letter != MUST_GO:
                if kept and kept[s] is not None:
                    options.append((more + after[kept[s]], "K"))
                options.append((REROLE + more + after[NEXT[s]], "R"))
            cost, edit = min(options)
            costs.append(min(cost, FAR))
            edits.append(edit)
        self._add(costs, edits)

    def read(self, signature: str) -> tuple[int, str]:
        """Cost and audit of the cheapest edits."""
        ending = signature[::-1]
        common = len(os.path.commonprefix([self.path, ending]))
        del self.costs[4 * (common + 1) :], self.edits[4 * (common + 1) :]
        for letter in ending[common:]:
            self._extend(letter)
        self.path = ending
        audit, at, state = [], len(ending), START
        while at or state not in ENDS:
            edit = chr(self.edits[4 * at + state])
            audit.append(edit)
            if edit == "K":
                state = KEPT[ending[at - 1].lower()][state]
            elif edit in "IR":
                state = NEXT[state]
            at -= edit != "I"
        return self.costs[4 * len(ending)], "".join(audit)


def damage(rows: DataFrame) -> DataFrame:
    """Rows with the faults that a row's id and turn decide on: dropped ones have no text and no role."""

    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", said("conv_id"), said("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    own = rows.select(
        F.col("conv_id").cast("string").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind != 0, F.when(kind == 4, "user").otherwise(said("role"))).alias("role"),
        F.when(kind != 0, text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("n"),
    )
    return own.withColumn("copy", F.explode(F.sequence(F.lit(1), "n"))).drop("n")


def letters(rows: DataFrame) -> DataFrame:
    """Narrow rows in place of texts: a digest, the row's fault, its role's initial. Dropped rows have no role."""
    stripped = F.rtrim(F.col("text"), F.lit(BLANK))
    own = rows.select(
        "conv_id",
        "turn",
        "role",
        F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"),
        "copy",
        (F.col("role").isNotNull() & (stripped == "")).alias("blank"),
        (~F.substring(stripped, -1, 1).isin(*STOPS)).alias("open"),
    )
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy(F.asc_nulls_first("turn"), "copy"))
    full = own.where("role IS NOT NULL AND NOT blank").withColumn("seen", seen)
    rest = own.where("role IS NULL OR blank").withColumn("seen", F.lit(1))
    fault = F.when(F.col("blank"), "b").when(F.col("seen") > 1, "d").when(F.col("open"), "t").otherwise("k")
    return full.unionByName(rest).select("conv_id", "turn", "role", "digest", F.when(F.col("role").isNotNull(), fault).alias("fault"), F.substring("role", 1, 1).alias("initial"))


def in_order(rows: DataFrame, *more: str) -> DataFrame:
    """The rows of a conversation in one partition, in the order of its turns."""
    order = ["conv_id", *more, F.asc_nulls_first("turn"), "role", "digest"]
    return rows.repartition(parallel(rows.sparkSession), "conv_id").sortWithinPartitions(*order)


class Signer:
    """Figures and signature of one conversation, from its rows as they pass."""

    def __init__(self) -> None:
        self.low = self.high = self.last = None
        self.turns = self.illegal = 0
        self.counts = {"b": 0, "d": 0, "t": 0, "k": 0}
        self.signature = bytearray()
        self.before = ""

    def add(self, turn: int | None, fault: str, initial: str) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.last
            self.last = self.high = turn
        if self.signature and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        self.counts[fault] += 1
        letter = initial if initial in KEPT else OTHER
        self.signature += (MUST_GO if fault in "bd" else letter.upper() if fault == "t" else letter).encode()

    def row(self, conv_id: str | None) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        c = self.counts
        return conv_id, gaps, c["b"], c["d"], c["t"], self.illegal, self.signature.decode()


def _signed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in SIGNED.split(", ")]
    own, conv, out = None, None, []
    for frame in frames:
        for c, turn, fault, initial in zip(frame["conv_id"], frame["turn"], frame["fault"], frame["initial"], strict=True):
            c = c if isinstance(c, str) else None
            if own is None or c != conv:
                if own is not None:
                    out.append(own.row(conv))
                own, conv = Signer(), c
            if isinstance(fault, str):
                own.add(int(turn) if isinstance(turn, str) else None, fault, initial)
        if out:
            yield pd.DataFrame(out, columns=names)
            out = []
    if own is not None:
        yield pd.DataFrame([own.row(conv)], columns=names)


def signatures(rows: DataFrame) -> DataFrame:
    """A row for each conversation: gaps, faults, illegal neighbours, signature."""
    narrow = in_order(letters(rows)).select("conv_id", F.col("turn").cast("string").alias("turn"), "fault", "initial")
    return narrow.mapInPandas(_signed, SIGNED)


def _costed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    own, last, found = EndingAutomaton(), None, (0, "")
    for frame in frames:
        costs, audits = [], []
        for signature in frame["signature"]:
            if signature != last:
                found, last = own.read(signature), signature
            costs.append(found[0])
            audits.append(found[1])
        yield frame.assign(cost=costs, audit=audits)


def costs(signed: DataFrame) -> DataFrame:
    """Each conversation's cost and audit; equal endings lie in one partition, equal signatures are spread by id."""
    ending = F.reverse("signature")
    dealt = signed.repartitionByRange(parallel(signed.sparkSession), ending, "conv_id")
    return dealt.sortWithinPartitions(ending, "conv_id").mapInPandas(_costed, COSTED)


class Rebuilder:
    """Rows of a repaired conversation, from its audit and its rows as they pass."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _made(self, text: str) -> tuple[str, str]:
        self.state = NEXT[self.state]
        return "user" if self.state == USER else "assistant", text

    def inserted(self) -> Iterator[tuple[str, str]]:
        """Rows that come before the next one, or at the end."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._made("")

    def add(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT[role[0]][self.state]
            yield role, text
        elif edit == "R":
            yield self._made(text)


def _rebuilt(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[object, list[tuple[str, str]]]]:
    """The head of each conversation with the rows that come next, as they pass."""
    own = head = None
    for frame in frames:
        for row in frame.itertuples(index=False):
            if isinstance(row.audit, str):
                if own is not None:
                    yield head, [*own.inserted()]
                own, head = Rebuilder(row.audit), row
                yield head, []
            else:
                yield head, [*own.add(row.role, row.text)]
    if own is not None:
        yield head, [*own.inserted()]


def _repaired(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names, out, last, place = [c.split()[0] for c in ROWS.split(", ")], [], None, 0
    for head, rows in _rebuilt(frames):
        last, place = (head, place) if head is last else (head, 0)
        for role, text in rows:
            out.append((head.conv_id, place, role, text))
            place += 1
        if len(out) >= BATCH_ROWS:
            yield pd.DataFrame(out, columns=names)
            out = []
    yield pd.DataFrame(out, columns=names)


def _hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names, out, last, digest, first = [c.split()[0] for c in RESULT.split(", ")], [], None, None, True

    def done() -> tuple:
        return last.conv_id, last.gaps, last.blank, last.duplicate, last.truncated, last.illegal, last.cost, last.audit, digest.hexdigest()

    for head, rows in _rebuilt(frames):
        if head is not last:
            if last is not None:
                out.append(done())
            if len(out) >= BATCH_ROWS:
                yield pd.DataFrame(out, columns=names)
                out = []
            last, digest, first = head, hashlib.sha256(), True
        for role, text in rows:
            digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False
    if last is not None:
        out.append(done())
    yield pd.DataFrame(out, columns=names)


def audits(rows: DataFrame) -> DataFrame:
    """A row for each conversation of ``rows`` (conv_id, turn, role, text, copy): its faults and cheapest edits.

    Rows without a role stand for a conversation's dropped rows.
    """
    costed = costs(materialize(signatures(rows), "repair-signatures"))
    return materialize(costed.drop("signature"), "repair-costs")


def _stream(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order."""
    texts = rows.where("role IS NOT NULL").drop("copy").withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    both = found.withColumn("head", F.lit(0)).unionByName(texts.withColumn("head", F.lit(1)), allowMissingColumns=True)
    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return in_order(both, "head").select("conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in figures], "audit", "role", "text")


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of the repaired conversations, by the audits ``found``."""
    return _stream(rows, found).mapInPandas(_repaired, ROWS)


def repair(rows: DataFrame) -> DataFrame:
    """A row for each conversation: its faults, cheapest edits, and the digest of its repaired rows."""
    return _stream(rows, audits(rows)).mapInPandas(_hashed, RESULT)


def query(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    kind = conversations.schema["conv_id"].dataType
    return repair(damage(conversations)).withColumn("conv_id", F.col("conv_id").cast(kind))
