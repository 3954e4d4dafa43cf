"""Similarity join of documents on word shingles, with signature trees.

Which documents can meet is settled by a pigeonhole over parts of their shingle sets: sets that link
differ in a bounded number of shingles, so of more parts than that the others are equal, which is
several parts of all but short sets. Pairs of documents that share as many are counted, as far as few
documents hold a part. A hot part, which many hold, is left out like a weak one; only documents with more
of these than may be missing meet by hot parts, all that share one. Documents that can meet form clusters,
and no link leaves a cluster. Documents that share a phrase or a passage by chance do not: they would
connect most of a large corpus. Within a cluster a signature tree
holds for each node the OR of its documents' token bitmaps and the range of their sizes; a dual
traversal drops node pairs whose greatest possible overlap is too small, and what is left is
verified exactly unless it is connected already.

A cluster beyond one tile is split first by sketches, a bit or two a shingle: the parities of a set's
shingles by hash. Two sketches differ in no more bits than their sets in shingles, so documents whose
sketches differ in too many do not link, and only those that others leave together go on.

What is still beyond one tile is split into bands of set sizes, as linked sets have like sizes. A band beyond
one tile is joined tile by tile first; then only documents outside its largest component meet all
others, tile against tile.

Defined cases: a null, empty or blank text has no shingle and links with nothing; equal sets always
link; rows that share a doc_id are one document, whose set is that of the longest text (then the
greatest); rows with a null doc_id link with nothing.
"""

from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helio.llm.common import Words, blocks, byte_values, mix, put_back, set_aside, table, utf8, whole_groups
from helio.llm.components import components
from helio.session import WRITTEN, discard, materialize

SHINGLE = 4
#: Sets link if 100 * intersection >= PERCENT * union.
PERCENT = 85
#: A part that more rows hold is hot; of the others all pairs of their documents are counted.
HOT = 32
#: Documents of a tile of a cluster; of sketches a tile holds so many times as much.
TILE, SKETCH_TILES = 2048, 4
FANOUT = 8
#: Counters of shingles over all documents. A shingle is common if its counter is above the mean by
#: ten standard deviations and this many.
LOG_COUNTERS, SEGMENTS, LEAST_COMMON = 20, 16, 30
#: Bits of a bitmap for each shingle of the largest set of a tile, and bits at most.
BITS_A_SHINGLE, MAX_BITS = 8, 1 << 16

_VALUES = byte_values(31)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_TURNS = [np.uint64(2 * x + 1) for x in (0x3C6EF372FE94F82A, 0x1F83D9ABFB41BD6B, 0x2545F4914F6CDD1D, 0x27D4EB2F165667C5)]


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for lo, hi in blocks(texts):
        w = Words(texts[lo:hi], _BLANK, _VALUES)
        h = w.hashes
        rolled = np.zeros(max(0, len(h) - size + 1), dtype=np.uint64)
        for k in range(size):
            rolled += h[k : k + len(rolled)] * _TURNS[k % len(_TURNS)] * np.uint64(2 * (k // len(_TURNS)) + 1)
        rolled = mix(rolled)
        for i in range(hi - lo):
            a, b = w.first[i], w.first[i + 1]
            if b - a >= size:
                yield np.unique(rolled[a : b - size + 1])
            elif b > a:
                few = np.array([b - a], dtype=np.uint64)
                for k in range(a, b):
                    few = mix(few * _TURNS[0] + h[k])
                yield few
            else:
                yield np.zeros(0, dtype=np.uint64)


#: A kind is a number of parts, then a bit that is set if all parts are used, and in its last bits the level.
LEVEL_BITS = 32
#: Bytes of texts whose shingles are held at a time when they are signed.
SIGN_BYTES = 1 << 19


class Parts:
    """Classes of set sizes, and the number of parts of each class' partition."""

    def __init__(self, percent: int):
        self.percent = percent
        self.tops = [1]

    def _grown(self, size: int) -> None:
        while self.tops[-1] < size:
            self.tops.append(max(self.tops[-1] + 1, self.tops[-1] * 100 // self.percent))

    def classes(self, sizes: np.ndarray) -> np.ndarray:
        self._grown(int(sizes.max(initial=1)))
        return np.searchsorted(self.tops, sizes)

    def number(self, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts of a class' partition, and how many of a set's may be weak.

        Linked sets of at most ``top`` shingles differ in at most ``most``. With some parts more
        than that, an equal part is not weak, unless both sets have more weak parts than these.
        """
        self._grown(self.tops[int(level.max(initial=0))] * 2)
        while len(self.tops) <= level.max(initial=0):
            self._grown(self.tops[-1] + 1)
        top = np.array(self.tops)[level]
        most = 2 * top * (100 - self.percent) // (100 + self.percent)
        spare = np.where(most == 0, 0, np.where(most < 19, 1 + (most + 1) // 6, 4 + (most + 1) // 16))
        return most + 1 + spare, spare

    def signatures(self, sets: list[np.ndarray], common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Signatures of parts, which set each is of, and its kind: parts to have in common, whether all are used, level.

        A part without any but common shingles is weak: it would bring together all documents that
        share a passage. Equal parts are weak in both sets, so weak parts are left out unless a set
        has more of them than may be missing. A set has all parts but ``most`` in common with each that
        it links with, less its weak ones if these are left out.
        """
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        some = np.flatnonzero(sizes)
        if not len(some):
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        flat, own = np.concatenate([sets[i] for i in some]), self.classes(sizes[some])
        rare = ~common[_counter(flat)]
        out, owner, kind = [], [], []
        for up in (0, 1):
            level = own + up
            number, spare = self.number(level)
            first = np.concatenate(([0], np.cumsum(number)))
            each = np.repeat(np.arange(len(some)), sizes[some])
            seed = mix(level.astype(np.uint64) + np.uint64(101))
            spread = mix(flat ^ seed[each])
            at = first[each] + ((spread >> np.uint64(33)) % number[each].astype(np.uint64)).astype(np.int64)
            low = np.bincount(at, weights=spread & np.uint64(0xFFFFFFFF), minlength=first[-1])
            high = np.bincount(at, weights=flat >> np.uint64(32), minlength=first[-1])
            del spread
            filled = np.bincount(at, minlength=first[-1])
            telling = np.bincount(at, weights=rare, minlength=first[-1])
            doc = np.repeat(np.arange(len(some)), number)
            place = np.arange(first[-1]) - first[doc]
            label = mix(seed[doc] + place.astype(np.uint64))
            signature = mix(mix(low.astype(np.uint64) + label) + high.astype(np.uint64) * _TURNS[1] + filled.astype(np.uint64))
            weak = np.bincount(doc, weights=telling == 0, minlength=len(some))
            use = (telling > 0) | (weak > spare)[doc]
            out.append(signature[use])
            owner.append(some[doc[use]])
            whole = weak > spare
            least = (1 + spare - np.where(whole, 0, weak)).astype(np.int64)
            kind.append(((2 * least + whole << LEVEL_BITS) + level)[doc[use]])
        return np.concatenate(out), np.concatenate(owner), np.concatenate(kind)


def _counter(sets: np.ndarray) -> np.ndarray:
    """The counter of each shingle in the table of counts."""
    return (sets >> np.uint64(64 - LOG_COUNTERS)).astype(np.int64)


def _stats(size: int):
    """A row for each document, and at a task's end rows with its counts of shingles by counter."""

    def figures(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << LOG_COUNTERS, dtype=np.uint32)
        for frame in frames:
            rows, data = [], utf8(frame["text"])
            for s in shingle_sets(data, size):
                if len(s):
                    rows.append((len(s), int(np.sum(s).view(np.int64)), int(np.bitwise_xor.reduce(mix(s)).view(np.int64))))
                    np.add.at(counts, _counter(s), np.uint32(1))
                else:
                    rows.append((0, 0, 0))
            yield pd.DataFrame(rows, columns=["n_shingles", "d1", "d2"]).assign(
                doc_id=frame["doc_id"].to_numpy(), segment=-1, counts=None
            )
        for k, part in enumerate(counts.reshape(SEGMENTS, -1)):
            if part.any():
                yield pd.DataFrame(
                    {"n_shingles": [0], "d1": [0], "d2": [0], "doc_id": [0], "segment": [k], "counts": [part.tobytes()]}
                )

    return figures


def _added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[int, np.ndarray] = {}
    for frame in frames:
        for k, part in zip(frame["segment"], frame["counts"], strict=True):
            one = np.frombuffer(part, dtype=np.uint32)
            total[k] = total[k] + one if k in total else one.astype(np.uint64)
    for k, part in total.items():
        yield pd.DataFrame({"segment": [k], "counts": [part.tobytes()]})


def common_counters(counts: DataFrame) -> np.ndarray:
    """Which counters hold a shingle of very many documents: far above the mean of all counters.

    The table of counts has a fixed size, and so has what reaches the driver.
    """
    merged = (
        counts.repartition(SEGMENTS, "segment").mapInPandas(_added, "segment int, counts binary").toLocalIterator()
    )
    total = np.zeros((SEGMENTS, (1 << LOG_COUNTERS) // SEGMENTS))
    for row in merged:
        total[row["segment"]] = np.frombuffer(row["counts"], dtype=np.uint64)
    mean = total.mean()
    return (total > mean + 10 * np.sqrt(mean) + LEAST_COMMON).reshape(-1)


def _signed(parts: Parts, common: np.ndarray, size: int):
    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            data, ids = utf8(frame["text"]), frame["doc_id"].to_numpy(dtype=np.int64)
            # small blocks bound the arrays of shingles
            for lo, hi in blocks(data, SIGN_BYTES):
                signature, owner, kind = parts.signatures(list(shingle_sets(data[lo:hi], size)), common)
                yield pd.DataFrame({"signature": signature.view(np.int64), "doc_id": ids[lo + owner], "kind": kind})

    return sign


def _stars(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links every document of a signature with its first; rows come sorted by signature and document."""
    last, head = None, 0
    for frame in frames:
        if not len(frame):
            continue
        signature, docs = frame["signature"].to_numpy(), frame["doc_id"].to_numpy()
        new = np.ones(len(signature), dtype=bool)
        new[1:] = signature[1:] != signature[:-1]
        leader = docs[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))].copy()
        if signature[0] == last:
            leader[: int(np.argmin(np.append(signature == last, False)))] = head
        last, head = signature[-1], leader[-1]
        apart = docs != leader
        pairs = np.unique(np.stack([docs[apart], leader[apart]]), axis=1)
        yield pd.DataFrame({"u": pairs[0], "v": pairs[1]})


def candidates(signed: DataFrame, reps: DataFrame) -> DataFrame:
    """``u, v``: links that connect every two documents of ``reps`` that can link; most cannot.

    Of the ``least`` parts that a document has in common with each that it links with, as many can be hot as it
    has hot ones; it must have the others in common with one document. If that is nothing, the document is
    open: any part brings it together with all open ones, by the first of them. What a ``whole`` document says
    of its parts holds for whole ones only, as others left out weak parts; such a pair goes by the other
    document's number.
    """
    together = Window.partitionBy("signature")
    held = signed.select(
        "*",
        F.count("*").over(together).alias("n"),
        (F.min("doc_id").over(together) < F.max("doc_id").over(together)).alias("several"),
    )
    shared = materialize(held.where("several").select("signature", "doc_id", "kind", (F.col("n") > HOT).alias("hot")), "shared-parts")
    own = Window.partitionBy("doc_id", "kind")
    hot = F.col("hot").cast("int")
    weighed = shared.join(reps, F.col("doc_id") == F.col("rep"), "left_semi").select(
        "signature",
        "doc_id",
        "hot",
        F.col("kind").bitwiseAND(F.lit((1 << LEVEL_BITS) - 1)).cast("int").alias("level"),
        (F.shiftright("kind", LEVEL_BITS).bitwiseAND(F.lit(1)) == 1).alias("whole"),
        (F.shiftright("kind", LEVEL_BITS + 1) - F.sum(hot).over(own)).cast("int").alias("least"),
        F.sum(1 - hot).over(own).alias("others"),
    )
    can = F.col("whole") | (F.col("least") < 1) | (F.col("others") >= F.col("least"))
    parts = materialize(weighed.where(can & (~F.col("hot") | F.col("whole") | (F.col("least") < 1))).drop("others"), "parts")
    few = (
        parts.where("NOT hot")
        .groupBy("signature")
        .agg(F.collect_list(F.struct("doc_id", "level", "whole", "least")).alias("all"))
        .where(F.size("all") > 1)
    )
    number = (
        F.when(F.col("a.whole") == F.col("b.whole"), F.greatest("a.least", "b.least"))
        .when(F.col("a.whole"), F.col("b.least"))
        .otherwise(F.col("a.least"))
    )
    pairs = (
        few.select("all", F.explode("all").alias("a"))
        .select("a", F.explode("all").alias("b"))
        .where("a.doc_id > b.doc_id")
        .select(F.col("a.doc_id").alias("u"), F.col("b.doc_id").alias("v"), F.col("a.level").alias("level"), number.alias("least"))
        .where("least > 0")
    )
    # rows that share a doc_id can have several numbers
    counted = pairs.groupBy("u", "v", "level").agg(F.count("*").alias("n"), F.min("least").alias("least"))
    # a whole document that is not open meets open ones that are not whole; the others meet open ones of their kind
    stars = (
        parts.where("whole OR least < 1")
        .select("signature", "doc_id", "least", F.max(~F.col("whole")).over(together).alias("meets"))
        .where("least < 1 OR meets")
        .select("signature", "doc_id")
        .repartition("signature")
        .sortWithinPartitions("signature", "doc_id")
        .mapInPandas(_stars, "u long, v long")
    )
    return counted.where("n >= least").select("u", "v").unionByName(stars)


class Tree:
    """A signature tree: documents by size, FANOUT to a leaf, FANOUT nodes to a node above."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        least = np.array([s[0] for s in sets], dtype=np.uint64)
        self.order = np.lexsort((least, sizes))
        maps = np.zeros((len(sets), bits // 64), dtype=np.uint64)
        for row, i in enumerate(self.order):
            at = (sets[i] >> np.uint64(13)) & np.uint64(bits - 1)
            np.bitwise_or.at(maps[row], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        size = sizes[self.order]
        excess = size - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        #: From documents up to the root: bitmaps, least and greatest size, greatest excess of
        #: shingles over bits.
        self.levels = [(maps, size, size, excess)]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, excess = self.levels[-1]
            cuts = np.arange(0, len(maps), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, cuts, axis=0),
                    np.minimum.reduceat(low, cuts),
                    np.maximum.reduceat(high, cuts),
                    np.maximum.reduceat(excess, cuts),
                )
            )

    def level(self, k: int):
        return self.levels[min(k, len(self.levels) - 1)]


def _possible(a, b, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether documents below nodes i of a and j of b can overlap enough."""
    least, greatest = a[1][i] + b[1][j], np.minimum(a[2][i], b[2][j])
    # an overlap of x in sizes p and q links if (100 + percent) * x >= percent * (p + q)
    fine = (100 * a[2][i] >= percent * b[1][j]) & (100 * b[2][j] >= percent * a[1][i])
    out = np.zeros(len(i), dtype=bool)
    at = np.flatnonzero(fine)
    for lo in range(0, len(at), 4096):
        k = at[lo : lo + 4096]
        shared = np.bitwise_count(a[0][i[k]] & b[0][j[k]]).sum(axis=1, dtype=np.int64)
        most = np.minimum(shared + np.minimum(a[3][i[k]], b[3][j[k]]), greatest[k])
        out[k] = (100 + percent) * most >= percent * least[k]
    return out


def joined_roots(
    sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, root: np.ndarray, percent: int = PERCENT
) -> np.ndarray:
    """Roots after linking sets of ``left`` with sets of ``right`` (numbers of ``sets``).

    ``root`` has the number of each set's component so far; a root is its smallest member's number.
    Pairs within a component are not looked at.
    """
    root = root.copy()
    bits = 64
    while bits < min(MAX_BITS, BITS_A_SHINGLE * max(len(s) for s in sets)):
        bits *= 2
    a = Tree([sets[i] for i in left], bits)
    b = a if left is right else Tree([sets[i] for i in right], bits)
    top = max(len(a.levels), len(b.levels)) - 1

    def similar_sets(x: int, y: int) -> bool:
        shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        return (100 + percent) * shared >= percent * (len(sets[x]) + len(sets[y]))

    todo = [(top, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while todo:
        k, i, j = todo.pop()
        fine = _possible(a.level(k), b.level(k), i, j, percent)
        i, j = i[fine], j[fine]
        if not len(i):
            continue
        if k:
            i, j = _below(a, k, i, j)
            j, i = _below(b, k, j, i)
            if a is b:
                once = i <= j
                i, j = i[once], j[once]
            step = 1 << 15
            todo += [(k - 1, i[lo : lo + step], j[lo : lo + step]) for lo in range(0, len(i), step)]
            continue
        _linked(root, left[a.order[i]], right[b.order[j]], similar_sets)
    return root


def _linked(root: np.ndarray, p: np.ndarray, q: np.ndarray, fits) -> None:
    """Joins in ``root`` the components of each p and q that fit, unless they are one already."""
    apart = np.flatnonzero(root[p] != root[q])
    while len(apart):
        x, y = p[apart[0]], q[apart[0]]
        if fits(x, y):
            low, high = sorted((root[x], root[y]))
            root[root == high] = low
            apart = apart[1:][root[p[apart[1:]]] != root[q[apart[1:]]]]
        else:
            apart = apart[1:]


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The number of shingles, then the parities of how many have each hash of some bits."""
    bits = 64
    while bits < 2 * len(shingles):
        bits *= 2
    odd = np.bincount((shingles >> np.uint64(11) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.append(np.uint64(len(shingles)), np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8"))


def _folded(words: np.ndarray, n: int) -> np.ndarray:
    """A sketch as it would be with ``n`` words: hashes that differ in their first bits only become equal."""
    return np.bitwise_xor.reduce(words.reshape(-1, n), axis=0)


def sketched_roots(
    sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, root: np.ndarray, percent: int = PERCENT
) -> np.ndarray:
    """As ``joined_roots``, for sketches; links all that may link."""
    root, words = root.copy(), min(len(s) for s in sets) - 1
    size = np.array([s[0] for s in sets], dtype=np.int64)
    maps = np.stack([_folded(s[1:], words) for s in sets])
    left = left[np.argsort(size[left], kind="stable")]
    right = right[np.argsort(size[right], kind="stable")]
    for lo in range(0, len(left), 64):
        some = left[lo : lo + 64]
        first, last = size[some[0]] * percent // 100, -(-size[some[-1]] * 100 // percent)
        a, b = np.searchsorted(size[right], [first, last + 1])
        for at in range(a, b, 4096):
            others = right[at : min(at + 4096, b)]
            apart = np.zeros((len(some), len(others)), dtype=np.uint32)
            for k in range(words):
                apart += np.bitwise_count(maps[some, k][:, None] ^ maps[others, k])
            # sets that link differ in at most (100 - percent) / (100 + percent) of their shingles
            most = (size[some][:, None] + size[others]) * (100 - percent)
            i, j = np.nonzero((100 + percent) * apart.astype(np.int64) <= most)
            _linked(root, some[i], others[j], lambda x, y: True)
    return root


def _below(tree: Tree, k: int, i: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Children of nodes i of level k, each with its partner; a tree that is lower stays."""
    if k >= len(tree.levels):
        return i, other
    n = len(tree.levels[k - 1][0])
    child = (i[:, None] * FANOUT + np.arange(FANOUT)).ravel()
    partner = np.repeat(other, FANOUT)
    return child[child < n], partner[child < n]


def _with_sets(size: int, held=lambda s: s):
    """Rows of the number of a document's shingles and, in place of its text, what is ``held`` of them."""

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = list(shingle_sets(utf8(frame["text"]), size))
            yield frame.drop(columns="text").assign(n=[len(s) for s in sets], shingles=[held(s).tobytes() for s in sets])

    return add


def _tile_links(percent: int, roots):
    """Links that ``roots`` finds within a group of rows of the same ``work``; ``side`` 1 meets all, 0 meets side 1 only."""

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in whole_groups(frames, "work"):
            if len(group) < 2:
                continue
            group = group.sort_values("doc_id", ignore_index=True)
            ids, side = group["doc_id"].to_numpy(), group["side"].to_numpy()
            sets = [np.frombuffer(s, dtype=np.uint64) for s in group["shingles"]]
            _, first, root = np.unique(group["root"].to_numpy(), return_index=True, return_inverse=True)
            before = first[root]
            every, chosen = np.arange(len(ids)), np.flatnonzero(side == 1)
            if len(chosen) == len(ids):
                after = roots(sets, every, every, before, percent)
            elif len(chosen):
                after = roots(sets, chosen, every, before, percent)
            else:
                continue
            moved = after != before
            yield pd.DataFrame({"u": ids[moved], "v": ids[after[moved]]})

    return join


def _members(reached: DataFrame) -> DataFrame:
    """``doc_id, cluster``, and ``c`` documents in it."""
    several = reached.groupBy("component").agg(F.count("*").alias("c"))
    named = reached.join(several, "component").select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"), "c")
    return materialize(named, "clusters")


def _held(rows: DataFrame, members: DataFrame, size: int, held, purpose: str) -> DataFrame:
    chosen = rows.join(members.hint("merge"), "doc_id")
    filled = chosen.mapInPandas(_with_sets(size, held), "doc_id long, cluster long, c long, n long, shingles binary").where("n > 0")
    return materialize(filled, purpose)


def _found(sets: DataFrame, percent: int, roots, tile: int) -> DataFrame:
    """Links that ``roots`` finds within each cluster, those beyond ``TILE`` by bands, in tiles of ``tile``."""
    whole = sets.where(F.col("c") <= TILE).withColumn("tile", F.lit(0))
    banded = materialize(_banded(sets, percent, tile), "bands")
    columns = ["doc_id", "shingles", F.col("doc_id").alias("root"), F.lit(1).alias("side"), _work("cluster", "tile")]
    dealt = banded.join(sets.select("doc_id", "shingles"), "doc_id")
    found = _joined(whole.select(*columns).unionByName(dealt.select(*columns)), percent, roots)
    if banded.where("m > 1").limit(1).count():
        found = materialize(found, "tile-links")
        found = found.unionByName(_across(banded.where("m > 1"), sets.select("doc_id", "shingles"), found, percent, roots, tile))
    return found


def links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT):
    """Sizes of all sets by doc_id, and ``node, component`` of the linked documents."""
    session = docs.sparkSession
    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counted = materialize(
        rows.mapInPandas(_stats(size), "n_shingles long, d1 long, d2 long, doc_id long, segment int, counts binary"),
        "shingle-counts",
    )
    first = len(WRITTEN.paths)
    stats = counted.where("segment < 0").select("doc_id", "n_shingles", "d1", "d2")
    common = common_counters(counted.where("segment >= 0").select("segment", "counts"))
    copies = (
        stats.where("n_shingles > 0")
        .groupBy("n_shingles", "d1", "d2")
        .agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("most"))
    )
    some = copies.where("most > rep").select("n_shingles", "d1", "d2", "rep")
    same = stats.join(some, ["n_shingles", "d1", "d2"]).where("doc_id > rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    signed = rows.mapInPandas(_signed(Parts(percent), common, size), "signature long, doc_id long, kind long")
    members = _members(components(candidates(signed, copies.select("rep"))))
    if members.where(F.col("c") > TILE).limit(1).count():
        large = _held(rows, members.where(F.col("c") > TILE), size, sketch, "sketches")
        split = _members(components(_found(large, percent, sketched_roots, SKETCH_TILES * TILE)))
        members = materialize(members.where(F.col("c") <= TILE).unionByName(split), "clusters")
    discard(session, WRITTEN.paths[first:-1])
    found = _found(_held(rows, members, size, lambda s: s, "shingle-sets"), percent, joined_roots, TILE)
    linked = components(same.unionByName(found))
    # only the sizes and the components are read from now on
    discard(session, WRITTEN.paths[first:-1])
    return stats, linked


def _banded(sets: DataFrame, percent: int, tile: int) -> DataFrame:
    """Documents of clusters beyond one tile by bands of set sizes, each band with its tiles.

    Sizes of linked sets differ by less than a band's width, so a document is in its own band and in the
    next one, where it meets those of that band.
    """
    width = max(log(100 / percent), 1e-6) * (1 + 1e-6)
    own = F.floor(F.log("n") / width).cast("long")
    placed = sets.where(F.col("c") > TILE).select("doc_id", "cluster", F.explode(F.array(own, own + 1)).alias("band"))
    several = placed.groupBy("cluster", "band").agg(F.count("*").alias("n")).where("n > 1")
    m = F.ceil(F.col("n") / tile).cast("int")
    return placed.join(several, ["cluster", "band"]).select(
        "doc_id",
        F.concat_ws("/", F.col("cluster").cast("string"), F.col("band").cast("string")).alias("cluster"),
        m.alias("m"),
        F.pmod(F.xxhash64("doc_id"), m).cast("int").alias("tile"),
    )


def _work(*columns: str):
    return F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias("work")


def _joined(rows: DataFrame, percent: int, roots) -> DataFrame:
    return rows.repartition("work").sortWithinPartitions("work").mapInPandas(_tile_links(percent, roots), "u long, v long")


def _rooted(tiled: DataFrame, found: DataFrame) -> DataFrame:
    joined = tiled.join(components(found), F.col("doc_id") == F.col("node"), "left")
    return materialize(joined.withColumn("root", F.coalesce("component", "doc_id")).drop("node", "component"), "rooted")


def _across(tiled: DataFrame, sets: DataFrame, found: DataFrame, percent: int, roots, tile: int) -> DataFrame:
    """Links between tiles of the clusters that have several; sets are fetched for open cases only."""
    # one document of each component stands for it in a first round, dealt to tiles anew
    heads = _rooted(tiled, found).groupBy("cluster", "root").agg(F.min("doc_id").alias("doc_id"))
    some = heads.groupBy("cluster").agg(F.count("*").alias("heads")).where("heads > 1")
    dealt = heads.join(some, "cluster").withColumn(
        "deal", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.ceil(F.col("heads") / tile)).cast("int")
    )
    work = dealt.select("doc_id", "root", F.lit(1).alias("side"), _work("cluster", "deal")).join(sets, "doc_id")
    first = materialize(_joined(work, percent, roots), "head-links")
    rooted = _rooted(tiled, found.unionByName(first))
    # two documents that are not connected are not both of the largest component
    sizes = rooted.groupBy("cluster", "root").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("cluster").agg(F.max(F.struct("n", "root")).alias("top"))
    few = (
        sizes.join(largest, "cluster")
        .where("root <> top.root")
        .groupBy("cluster")
        .agg(F.sum("n").alias("few"), F.first("top.root").alias("main"))
    )
    still = rooted.join(few, "cluster").withColumn("k", F.ceil(F.col("few") / tile).cast("int"))
    minor = (
        still.where("root <> main")
        .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.col("k")).cast("int"))
        .withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
        .withColumn("side", F.lit(1))
    )
    rest = still.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).withColumn("side", F.lit(0))
    names = ["doc_id", "root", "side", _work("cluster", "part", "tile")]
    second = _joined(minor.select(*names).unionByName(rest.select(*names)).join(sets, "doc_id"), percent, roots)
    return first.unionByName(second)


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """All columns of ``docs`` but those named like the two added: n_shingles and component_id."""
    stats, found = links(docs, doc_id, text, size, percent)
    sizes = stats.groupBy(F.col("doc_id").alias("_doc")).agg(F.max("n_shingles").alias("n_shingles"))
    named = sizes.join(found, F.col("_doc") == F.col("node"), "left").select(
        "_doc", "n_shingles", F.coalesce("component", "_doc").alias("component_id")
    )
    rest = docs.drop("n_shingles", "component_id")
    return (
        rest.join(named, rest[doc_id].cast("long") == named["_doc"], "left")
        .withColumn("n_shingles", F.coalesce("n_shingles", F.lit(0)).cast("long"))
        .drop("_doc")
    )


def clean(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component; a null doc_id stays."""
    done = similar(set_aside(docs), size=size, percent=percent)
    return put_back(done.where(F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))), docs)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return similar(docs).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM docs
), sizes AS (SELECT doc_id, len(s) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
  WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS u, doc_id AS v FROM documents
  UNION
  SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
)
SELECT doc_id, n AS n_shingles, min(v) AS component_id FROM sizes JOIN reach ON u = doc_id GROUP BY doc_id, n
"""
