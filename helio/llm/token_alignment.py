"""Alignment of two tokenizers over the same bytes, and how often their tokens meet.

Interval coalescing: the tokens of both tokenizers are intervals of bytes. Sorted by start, with a running
maximum of their ends, a group begins where a start reaches that maximum, so a group is a shortest range
at whose ends tokens of both end. Each token of the first tokenizer is linked with each of the second of
its group.

Neither tokenizer joins letters across a single space between two other characters (for the second that is
tested on its vocabulary; otherwise texts are not cut). Texts are cut there, each distinct part of a block of
documents is encoded and coalesced once, all new parts in one step, and a document is a list of parts. How many documents
link a pair is counted for each block first and then over the corpus; pair counts come back to the blocks
by a join, which Spark broadcasts only below its own threshold.

Defined cases: a text that is null or empty, or that one of the tokenizers does not give back byte for
byte, has no tokens, and all its figures are 0; repeated rows and ids are documents of their own; null
ids stay; other columns are not read; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helio.llm.bpe import byte_letters
from helio.llm.common import table
from helio.session import materialize

#: Fixed value: the pattern that splits text before the merges of the first tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The second tokenizer's letter for a space.
SPACE_PIECE = "▁"
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Texts without any other white space beside a space can be cut at every space.
UNEVEN = re.compile(r"\s | \s")
#: Runs that the fast form of the first tokenizer is slow on; its library takes them.
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")
#: Characters of the texts of a block, about, and of the new parts that are coalesced in one step.
BLOCK_CHARS, STEP_CHARS = 1 << 23, 1 << 16
#: Distinct parts that a worker keeps from block to block, about.
KEPT_PARTS = 100_000
#: Links that one step expands, about.
STEP_LINKS = 1 << 20
#: A pair of ids as one number.
SHIFT = 32
EMPTY = np.empty(0, dtype=np.int64)

BLOCKS = """block string, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>,
    n_links array<bigint>, groups_sha256 array<string>, parts binary, starts binary, pair_at binary, times binary,
    pair_starts binary, pairs array<bigint>, holders array<bigint>"""
RESULT = """doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint,
    groups_sha256 string"""


@lru_cache(maxsize=2)
def _said(log: int) -> np.ndarray:
    """Each id as text with each of the marks behind it."""
    return np.array([f"{i}{mark}" for i in range(1 << log) for mark in ",|;"], dtype=object)


def lengths(own: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(max(own) + 1, dtype=np.int64)
    out[list(own)] = list(map(len, own.values()))
    return out


class First:
    """A byte-level vocabulary: ids of a text, and each id's bytes."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        back = {letter: b for b, letter in enumerate(byte_letters())}
        ranks = {bytes(map(back.__getitem__, t)): i for t, i in self.library.get_vocab(with_added_tokens=False).items() if t not in special}
        self.fast = tiktoken.Encoding("first", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = {i: b for b, i in ranks.items()}
        self.lengths = lengths(self.bytes)

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids if LONG_RUN.search(text) else self.fast.encode_ordinary(text)


class Second:
    """A vocabulary of pieces, with a byte for each letter that no piece has; it puts a space before a text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        ids = range(self.library.get_piece_size())
        names = [self.library.id_to_piece(i) for i in ids]
        self.bytes = {i: bytes([int(n[3:5], 16)]) if self.library.is_byte(i) else n.replace(SPACE_PIECE, " ").encode() for i, n in zip(ids, names, strict=True)}
        self.lengths = lengths(self.bytes)
        #: Whether no piece has a space behind another letter, so that texts can be cut before spaces.
        self.cuts = not any(SPACE_PIECE in n.lstrip(SPACE_PIECE) for n in names)

    def encode(self, text: str) -> list[int]:
        """Ids of a text that begins with a space; the library puts it there."""
        return self.library.encode(text[1:])


@lru_cache(maxsize=2)
def tokenizers(first: str, second: str) -> tuple[First, Second]:
    return First(first), Second(second)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def coalesce(starts: np.ndarray, ends: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals' order by start (side 0 first on ties), and the group of each in that order."""
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = starts[order][1:] >= reach[:-1]
    return order, np.cumsum(fresh) - 1


class Aligner:
    """Parts of texts by number: their groups as text, and their pairs of ids with the number of links."""

    def __init__(self, first: str, second: str):
        self.a, self.b = tokenizers(first, second)
        self.known: dict[str, int] = {}
        #: Of each part: whether both tokenizers give it back, its groups.
        self.whole: list[bool] = []
        self.groups: list[str] = []
        #: Of the parts of each step: their figures, numbers of pairs, pairs, links of each.
        self.figures: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def cut(self, text: str) -> list[str]:
        """Parts of space + text, each with the space before it."""
        if not self.b.cuts:
            return [" " + text]
        if text[0].isspace() or UNEVEN.search(text) or text.endswith(" "):
            first, *rest = CUT.split(" " + text)
            return [first, *(" " + p for p in rest)]
        return [" " + p for p in text.split(" ")]

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Figures and numbers of pairs of all parts, their pairs, the links of each."""
        for own, none in ((self.figures, np.empty((0, 4), dtype=np.int64)), (self.sizes, EMPTY), (self.pairs, EMPTY), (self.times, EMPTY)):
            own[:] = [np.concatenate([*own, none])]
        return self.figures[0], self.sizes[0], self.pairs[0], self.times[0]

    def number(self, text: str) -> np.ndarray:
        """The numbers of a text's parts; new ones get the next numbers, and are learnt later."""
        known = self.known
        return np.array([known.setdefault(p, len(known)) for p in self.cut(text)] if text else [], dtype=np.int32)

    def learn(self) -> None:
        """Encode and coalesce new parts in their order, some ten thousand letters in one step.

        A part that begins with a single space and ends with a letter is encoded together with others like
        it, one behind the other, as both tokenizers cut between them.
        """
        step, size = [], 0
        for part in islice(self.known, len(self.whole), None):
            if len(part) > STEP_CHARS or len(part) < 2 or part[1].isspace() or part[-1].isspace() or not self.b.cuts:
                if step:
                    self._step(step)
                    step, size = [], 0
                self._step([part])
                continue
            step.append(part)
            size += len(part)
            if size > STEP_CHARS:
                self._step(step)
                step, size = [], 0
        if step:
            self._step(step)

    def _step(self, parts: list[str]) -> None:
        text = "".join(parts)
        raw = text.encode("utf-8", "surrogatepass")
        flat = [np.asarray(self.a.encode(text), dtype=np.int64), np.asarray(self.b.encode(text), dtype=np.int64)]
        whole = all(b"".join(map(own.bytes.__getitem__, ids.tolist())) == raw for own, ids in zip((self.a, self.b), flat, strict=True))
        if not whole and len(parts) > 1:
            self._step(parts[: len(parts) // 2])
            self._step(parts[len(parts) // 2 :])
            return
        if not whole:
            flat = [EMPTY, EMPTY]
        ends = [np.cumsum(own.lengths[ids]) for own, ids in zip((self.a, self.b), flat, strict=True)]
        starts = [np.concatenate(([0], e[:-1])) if len(e) else e for e in ends]
        # a part ends where tokens of both end
        stops = np.cumsum([len(p) if p.isascii() else len(p.encode("utf-8", "surrogatepass")) for p in parts])
        owner = [np.searchsorted(stops, e) for e in ends]
        sizes = [np.bincount(o, minlength=len(parts)) for o in owner]
        side = np.repeat([0, 1], [len(flat[0]), len(flat[1])])
        order, group = coalesce(np.concatenate(starts), np.concatenate(ends), side)
        part = np.concatenate(owner)[order]
        ids, side = np.concatenate(flat)[order], side[order]
        # a group's tokens of the first side, then those of the second
        tidy = np.lexsort((side, group))
        ids, side, group, part = ids[tidy], side[tidy], group[tidy], part[tidy]
        n_groups = int(group[-1]) + 1 if len(group) else 0
        n_a = np.bincount(group[side == 0], minlength=n_groups)
        n_b = np.bincount(group[side == 1], minlength=n_groups)
        of = part[np.searchsorted(group, np.arange(n_groups))] if n_groups else np.empty(0, dtype=np.int64)
        links = n_a * n_b
        totals = [np.bincount(of, weights=x, minlength=len(parts)).astype(np.int64) for x in (np.ones(n_groups), links)]
        pair, times, held = self._pairs(ids, n_a, n_b, of, len(parts))
        self.whole += [whole] * len(parts)
        self.groups += self._texts(ids, side, group, part, len(parts))
        self.figures.append(np.stack([*sizes, *totals], axis=1))
        self.sizes.append(held)
        self.pairs.append(pair)
        self.times.append(times)

    @staticmethod
    def _texts(ids: np.ndarray, side: np.ndarray, group: np.ndarray, part: np.ndarray, n: int) -> list[str]:
        """Each part's groups, ``a1,a2|b1;a3|b2``."""
        marks = np.zeros(len(ids), dtype=np.int64)
        if len(ids):
            marks[:-1] = np.where(group[1:] != group[:-1], 2, np.where(side[1:] != side[:-1], 1, 0))
            marks[-1] = 2
        said = _said(int(ids.max(initial=0)).bit_length())[ids * 3 + marks].tolist()
        bounds = np.searchsorted(part, np.arange(n + 1)).tolist()
        return ["".join(said[lo:hi])[:-1] for lo, hi in zip(bounds, bounds[1:], strict=False)]

    @staticmethod
    def _pairs(ids: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The parts' distinct pairs, the links of each, and the parts' numbers of pairs, in steps of bounded size."""
        begin = np.cumsum(n_a + n_b) - (n_a + n_b)
        # one token of the first side at a time: with all tokens of the second side of its group
        token = spread(begin, n_a)
        group = np.repeat(np.arange(len(n_a)), n_a)
        reach = np.cumsum(n_b[group])
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        lo = 0
        while lo < len(token):
            done = reach[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(reach, done + STEP_LINKS, "right")))
            own = group[lo:hi]
            left = np.repeat(ids[token[lo:hi]], n_b[own])
            right = ids[spread((begin + n_a)[own], n_b[own])]
            kept.append(_summed(np.repeat(of[own], n_b[own]), left << SHIFT | right, np.ones(len(left), dtype=np.int64)))
            lo = hi
            if len(kept) > 16:
                kept = [_summed(*map(np.concatenate, zip(*kept, strict=True)))]
        if not kept:
            return EMPTY, EMPTY, np.zeros(n, dtype=np.int64)
        part, pair, times = _summed(*map(np.concatenate, zip(*kept, strict=True)))
        return pair, times, np.bincount(part, minlength=n)


def _summed(part: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the same part and pair as one, sorted."""
    order = np.lexsort((pair, part))
    part, pair, times = part[order], pair[order], times[order]
    fresh = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (pair[1:] != pair[:-1]))))
    return part[fresh], pair[fresh], np.add.reduceat(times, fresh) if len(fresh) else times


def _holders(parts: list[np.ndarray], pair_at: np.ndarray, pair_starts: np.ndarray, n_pairs: int) -> np.ndarray:
    """How many of the documents, given by their distinct parts, hold each pair."""
    held = np.zeros(n_pairs, dtype=np.int64)
    last = np.full(n_pairs, -1, dtype=np.int64)
    for doc, own in enumerate(parts):
        pairs = pair_at[spread(pair_starts[own], pair_starts[own + 1] - pair_starts[own])]
        fresh = pairs[last[pairs] != doc]
        last[fresh] = doc
        # a pair may come from several parts of the document: it counts once
        held[fresh] += 1
    return held


def _packed(numbers: np.ndarray) -> bytes:
    """Compressed, as blocks are written and shuffled; low bytes first, then the next ones."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(flat.reshape(4, -1).T).view("<i4").ravel()


@lru_cache(maxsize=1)
def _aligner(first: str, second: str) -> Aligner:
    """Parts learnt by a worker, kept from block to block."""
    return Aligner(first, second)


def _block(ids: list[int | None], texts: list[str], first: str, second: str) -> pd.DataFrame:
    if len(_aligner(first, second).known) > KEPT_PARTS:
        _aligner.cache_clear()
    own = _aligner(first, second)
    numbers = [own.number(t) for t in texts]
    own.learn()
    figures, part_sizes, all_pairs, all_times = own.arrays()
    part_ends = np.cumsum(part_sizes)
    whole = np.array(own.whole, dtype=bool)
    rows = []
    for i, mine in enumerate(numbers):
        if not len(mine) or not whole[mine].all():
            numbers[i] = mine[:0]
            rows.append((0, 0, 0, 0, ""))
            continue
        said = ";".join(map(own.groups.__getitem__, mine.tolist()))
        rows.append((*figures[mine].sum(axis=0).tolist(), hashlib.sha256(said.encode()).hexdigest()))
    starts = np.concatenate(([0], np.cumsum([len(n) for n in numbers])))
    # the block's own numbers of the parts and pairs that its documents hold
    used, parts = np.unique(np.concatenate([*numbers, EMPTY]).astype(np.int64), return_inverse=True)
    sizes = part_sizes[used]
    places = spread(part_ends[used] - sizes, sizes)
    pairs, pair_at = np.unique(all_pairs[places], return_inverse=True)
    pair_starts = np.concatenate(([0], np.cumsum(sizes)))
    held = _holders([np.unique(parts[lo:hi]) for lo, hi in zip(starts, starts[1:], strict=False)], pair_at, pair_starts, len(pairs))
    columns = list(zip(*rows, strict=True))
    return pd.DataFrame(
        {
            "block": [uuid.uuid4().hex],
            "doc_id": [ids],
            **{name: [list(c)] for name, c in zip(("n_a", "n_b", "n_groups", "n_links", "groups_sha256"), columns, strict=True)},
            "parts": [_packed(parts.astype("<i4"))],
            "starts": [starts.astype("<i8").tobytes()],
            "pair_at": [_packed(pair_at.astype("<i4"))],
            "times": [_packed(all_times[places].astype("<i4"))],
            "pair_starts": [pair_starts.astype("<i8").tobytes()],
            "pairs": [pairs],
            "holders": [held],
        }
    )


def blocks(docs: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each block of documents: their figures, parts and pairs. Written once, as its ids are random."""

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list[int | None] = []
        texts: list[str] = []
        size = 0
        for frame in frames:
            for i, t in zip(frame["i"], frame["t"], strict=True):
                ids.append(None if pd.isna(i) else int(i))
                texts.append(t if isinstance(t, str) else "")
                size += len(texts[-1])
                if size >= BLOCK_CHARS:
                    yield _block(ids, texts, first, second)
                    ids, texts, size = [], [], 0
        if ids:
            yield _block(ids, texts, first, second)

    # ids as text: pandas would turn whole numbers beside nulls into inexact ones
    own = docs.select(F.col(doc_id).cast("string").alias("i"), F.col(text).alias("t"))
    return materialize(own.mapInPandas(build, BLOCKS), "alignment-blocks")


def pair_counts(built: DataFrame) -> DataFrame:
    """The number of documents that link each pair, and whether it is the highest of the pair's first id."""
    held = built.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.holders").alias("n"))
    counts = held.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = materialize(counts.withColumn("a", F.shiftright("pair", SHIFT)), "alignment-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select(
        "pair", F.col("a").cast("int").alias("a"), F.col("pair").bitwiseAND((1 << SHIFT) - 1).cast("int").alias("b"), "count", (F.col("count") == F.col("most")).alias("best")
    )


def _scored(block: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
    own = block.iloc[0]
    count, best = np.zeros(len(own["pairs"]), dtype=np.int64), np.zeros(len(own["pairs"]), dtype=np.int64)
    place = found["place"].to_numpy(dtype=np.int64)
    count[place], best[place] = found["count"], found["best"]
    parts, starts = _unpacked(own["parts"]), np.frombuffer(own["starts"], "<i8")
    pair_at, times = _unpacked(own["pair_at"]), _unpacked(own["times"]).astype(np.int64)
    bounds = np.frombuffer(own["pair_starts"], "<i8")

    def by_range(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(values)))
        return sums[edges[1:]] - sums[edges[:-1]]

    def of_docs(score: np.ndarray) -> np.ndarray:
        return by_range(by_range(times * score[pair_at], bounds)[parts], starts)

    names = ("n_a", "n_b", "n_groups", "n_links")
    ids = [None if i is None or i != i else int(i) for i in own["doc_id"]]
    return pd.DataFrame(
        {"doc_id": pd.array(ids, dtype="Int64"), **{n: own[n] for n in names}, "n_best": of_docs(best), "count_sum": of_docs(count), "groups_sha256": own["groups_sha256"]}
    )


def align(docs: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document its tokens, groups and links, scored by the corpus-wide counts of their pairs."""
    built = blocks(docs, first, second, doc_id, text)
    rated = pair_counts(built).select("pair", "count", "best")
    places = built.select(F.col("block").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    found = places.join(rated, "pair").select("of", "place", "count", F.col("best").cast("long").alias("best"))
    return built.groupBy("block").cogroup(found.groupBy("of")).applyInPandas(lambda own, rows: _scored(own, rows), RESULT)


def groups(docs: DataFrame, first: str, second: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``token_groups``: the groups of ids, ``a1,a2|b1;a3|b2``, empty without tokens."""

    def say(texts: pd.Series) -> pd.Series:
        own, out = Aligner(first, second), []
        for t in texts:
            mine = own.number(t if isinstance(t, str) else "").tolist()
            own.learn()
            out.append(";".join([own.groups[i] for i in mine]) if all(own.whole[i] for i in mine) else "")
        return pd.Series(out)

    return docs.withColumn("token_groups", F.pandas_udf(say, "string")(F.col(text)))


def query(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
