"""Packing by lexical retrieval.

Full windows of a document's tokens are sequences of their own. What is left over is packed with its
neighbours: an inverted index with BM25 weights returns the unused neighbours of a seed, best first, and
they fill its window greedily; the neighbour that no longer fits is cut, and its rest stays to be used.

The index is sharded by topics. A bounded sample of documents, at most ``LEADERS``, is indexed first, with
BM25 figures of the whole corpus; every document asks it for the leaders it scores highest with, and they
are its path. Documents ordered by path are cut into blocks of bounded size, which share their best
leader, in large corpora several of them, and each block has an index of its own. Each round leads with
another of a document's best leaders and gets only what no round before has used: a seed keeps
its window if neighbours that score at least a share of its own score fill it, else it is handed over to
the next round. The last round takes any neighbour. So work grows with the documents, and a seed sees the
documents of its block, not all of them; README states how often it meets its best neighbour.

Defined cases: null is the empty text, which is its end token alone; rows that share a doc_id are
packed as documents of their own; a block's last sequence of the last round may stay short.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helio.llm.bpe import byte_letters
from helio.llm.common import table
from helio.session import materialize

WINDOW = 2048
END_ID = 1
#: Documents of a block, whose index is in memory at once, and of a task, about.
BLOCK_DOCUMENTS, TASK_DOCUMENTS = 1024, 4096
#: Terms whose posting lists are spread out at once.
BLOCK_TERMS = 4096
#: Documents that stand for topics: at most, for each block of documents, and in a document's path.
LEADERS, BLOCK_LEADERS, PATH_LEADERS = 256, 8, 8
#: Of a seed's own score, what its neighbours must reach, by round; the last round takes all.
SHARES = (0.5, 0.0)
K1, B = 1.2, 0.75
#: Fixed value: how byte-level vocabularies of this kind split text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class Tokens:
    """Ids of whole texts under a byte-level vocabulary, by its fast implementation."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        back = {letter: b for b, letter in enumerate(byte_letters())}
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        ranks = {bytes(map(back.__getitem__, t)): i for t, i in vocabulary.items() if t not in self.special}
        #: How ids are stored between stages.
        self.kind = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers; a text that holds a special token goes to the library."""
        if any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return np.asarray(self.fast.encode_to_numpy(text), dtype="<u4").tobytes()


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def read(data: bytes, n: int) -> np.ndarray:
    """``n`` ids as they are stored."""
    return np.frombuffer(data, dtype=f"<u{len(data) // n}" if n else "<u4").astype(np.int64)


def tokenised(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: its number of tokens, its terms, the digests of its full windows, the ids left."""
    width = 4 * WINDOW

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, end = tokens(path), END_ID.to_bytes(4, "little")
        for frame in frames:
            data = [(own.encode(t) if isinstance(t, str) else b"") + end for t in frame["text"]]
            counts = [np.unique(np.frombuffer(d, dtype="<u4"), return_counts=True) for d in data]
            rest = [np.frombuffer(d, dtype="<u4", offset=len(d) // width * width) for d in data]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].astype("Int64"),
                    "doc_tokens": [len(d) // 4 for d in data],
                    "terms": [t.astype(own.kind).tobytes() for t, _ in counts],
                    "tf": [n.astype("<u4").tobytes() for _, n in counts],
                    "full": [[crc32(d[i : i + width]) for i in range(0, len(d) - width + 1, width)] for d in data],
                    "rest": [x.astype(own.kind).tobytes() for x in rest],
                }
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kinds = "doc_id long, doc_tokens long, terms binary, tf binary, full array<long>, rest binary"
    return rows.mapInPandas(cut, kinds)


@dataclass
class Corpus:
    """What BM25 knows of all documents: the weight of each term, the mean number of tokens."""

    idf: np.ndarray
    mean: float

    def weights(self, terms: np.ndarray, tf: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of terms in documents; a frequent term keeps its low weight."""
        norm = K1 * (1 - B + B * sizes / max(1.0, self.mean))
        return self.idf[terms] * tf * (K1 + 1) / (tf + norm)


def corpus(terms: np.ndarray, df: np.ndarray, n: int, mean: float) -> Corpus:
    idf = np.zeros(int(terms.max()) + 1 if len(terms) else 1)
    idf[terms] = np.log1p((n - df + 0.5) / (df + 0.5))
    return Corpus(idf, mean)


def n_terms() -> Column:
    return (F.octet_length("tf") / 4).cast("long")


def figures(rows: DataFrame) -> Corpus:
    """Counted over all documents; the driver gets a row for each token of the vocabulary at most."""

    def held(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            terms, df = np.unique(read(b"".join(frame["terms"]), frame["n"].sum()), return_counts=True)
            yield pd.DataFrame({"term": terms, "df": df})

    n, mean = rows.agg(F.count("*"), F.avg("doc_tokens")).first()
    counted = rows.select("terms", n_terms().alias("n")).mapInPandas(held, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    counted = counted.toPandas()
    return corpus(counted["term"].to_numpy(dtype=np.int64), counted["df"].to_numpy(dtype=float), n, mean or 1.0)


LEFT = "uid long, doc_tokens long, terms binary, tf binary, start long, left long, path binary"


def leaders(rows: DataFrame, known: Corpus, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The terms of a bounded sample of documents, and the weight of each (rows) in each of them (columns)."""
    number = max(1, min(LEADERS, n * BLOCK_LEADERS // BLOCK_DOCUMENTS))
    some = rows.select("doc_tokens", "terms", "tf").orderBy(F.xxhash64("uid"), "uid").limit(number).toPandas()
    some = some.drop_duplicates(["terms", "tf"])
    tf = np.frombuffer(b"".join(some["tf"]), dtype="<u4")
    owner = np.repeat(np.arange(len(some)), some["tf"].map(len).to_numpy(dtype=np.int64) // 4)
    terms = read(b"".join(some["terms"]), len(tf))
    names, at = np.unique(terms, return_inverse=True)
    weights = np.zeros((len(names), len(some)), dtype=np.float32)
    weights[at, owner] = known.weights(terms, tf, some["doc_tokens"].to_numpy(dtype=np.int64)[owner])
    return names, weights


def routed(rows: DataFrame, known: Corpus, n: int) -> DataFrame:
    """What is left of each document, with the leaders it scores highest with, the best first."""
    names, weights = leaders(rows, known, n)
    spread = rows.sparkSession.sparkContext.broadcast((names, weights))

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, weights = spread.value
        for frame in frames:
            n = frame["tf"].map(len).to_numpy() // 4
            terms, owner = read(b"".join(frame["terms"]), n.sum()), np.repeat(np.arange(len(n)), n)
            at = np.minimum(np.searchsorted(names, terms), len(names) - 1)
            known_to = names[at] == terms
            at, owner = at[known_to], owner[known_to]
            scores = np.zeros((len(n), weights.shape[1]), dtype=np.float32)
            for lo in range(0, len(names), BLOCK_TERMS):
                part = (at >= lo) & (at < lo + BLOCK_TERMS)
                held = np.zeros((len(n), min(BLOCK_TERMS, len(names) - lo)), dtype=np.float32)
                held[owner[part], at[part] - lo] = 1
                scores += held @ weights[lo : lo + BLOCK_TERMS]
            order = np.argsort(-scores, axis=1, kind="stable")[:, :PATH_LEADERS].astype(">u4")
            yield frame.assign(path=[x.tobytes() for x in order])

    width = F.pmod("doc_tokens", F.lit(WINDOW))
    some = rows.where(width > 0).select("uid", "doc_tokens", "terms", "tf", F.lit(0).cast("long").alias("start"), width.alias("left"))
    return some.mapInPandas(best, LEFT)


class Index:
    """The inverted index of a block: for each term the documents that hold it, with its weight there."""

    def __init__(self, terms: np.ndarray, tf: np.ndarray, owner: np.ndarray, sizes: np.ndarray, known: Corpus):
        self.n = len(sizes)
        weights = known.weights(terms, tf, sizes[owner])
        #: The score of each document for its own terms.
        self.own = np.bincount(owner, weights=weights, minlength=self.n)
        short = len(terms) and terms.max() < 1 << 16  # sorted by digits then
        order = np.argsort(terms.astype(np.uint16) if short else terms, kind="stable")
        ends = np.flatnonzero(np.append(np.diff(terms[order]) != 0, len(terms) > 0)) + 1
        df = np.diff(ends, prepend=0)
        order = order[np.repeat(df > 1, df)]
        self.docs, self.weights, df = owner[order], weights[order], df[df > 1]
        #: Where the list of each term that two documents hold begins.
        self.lists = np.cumsum(df) - df

    def scores(self) -> np.ndarray:
        """Of each document (columns) for each seed (rows): its postings under the seed's terms, added up."""
        out = np.zeros((self.n, self.n), dtype=np.float32)
        for lo in range(0, len(self.lists), BLOCK_TERMS):
            ends = np.append(self.lists[lo : lo + BLOCK_TERMS + 1], len(self.docs))[: BLOCK_TERMS + 1]
            postings = np.zeros((len(ends) - 1, self.n), dtype=np.float32)
            term = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            postings[term, self.docs[ends[0] : ends[-1]]] = self.weights[ends[0] : ends[-1]]
            out += (postings > 0).astype(np.float32).T @ postings
        return out


Window = list[tuple[int, int, int]]


def fill(left: np.ndarray, index: Index, share: float) -> tuple[list[Window], np.ndarray, np.ndarray]:
    """Windows of (document, start, length) out of ``left`` tokens; where each document goes on, what is left of it.

    Without a share every token gets into a window.
    """
    left, start = left.copy(), np.zeros(len(left), dtype=np.int64)
    scores, windows = index.scores(), []
    for seed in np.argsort(-left, kind="stable").tolist():
        if not left[seed]:
            continue
        length, row = int(left[seed]), scores[seed]
        unused = left > 0
        unused[seed] = False
        if share:
            unused &= row >= share * index.own[seed]
        found = np.flatnonzero(unused)
        if share and left[found].sum() < WINDOW - length:
            continue
        window, space = [(seed, int(start[seed]), length)], WINDOW - length
        left[seed] = 0
        found = found[np.argsort(-row[found], kind="stable")]
        for d in found[: int(np.searchsorted(np.cumsum(left[found]), space)) + 1].tolist() if space else []:
            take = int(min(space, left[d]))
            window.append((d, int(start[d]), take))
            start[d] += take
            left[d] -= take
            space -= take
        windows.append(window)
    return windows, start, left


PLACED = f"{LEFT}, length long, sequence_id long, offset long"


def in_blocks(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []
    for frame in frames:
        held.append(frame)
        if sum(map(len, held)) >= size:
            rows = pd.concat(held, ignore_index=True)
            whole = len(rows) // size * size
            yield from (rows.iloc[lo : lo + size] for lo in range(0, whole, size))
            held = [rows.iloc[whole:]]
    if sum(map(len, held)):
        yield pd.concat(held, ignore_index=True)


def packed_round(rows: DataFrame, known: Corpus, number: int, n: int) -> DataFrame:
    """Pieces placed in this round, and rows with ``left`` tokens to hand over to the next one."""
    share = SHARES[number]

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sequence = (number + 1 << 60) + (TaskContext.get().partitionId() << 36)
        for block in in_blocks(frames, BLOCK_DOCUMENTS):
            n_terms = block["tf"].map(len).to_numpy() // 4
            tf = np.frombuffer(b"".join(block["tf"]), dtype="<u4")
            terms, owner = read(b"".join(block["terms"]), len(tf)), np.repeat(np.arange(len(block)), n_terms)
            index = Index(terms, tf, owner, block["doc_tokens"].to_numpy(), known)
            windows, start, left = fill(block["left"].to_numpy(), index, share)
            sizes = [len(w) for w in windows]
            pieces = np.array([p for w in windows for p in w], dtype=np.int64).reshape(-1, 3)
            ends = np.cumsum(pieces[:, 2])
            first = np.cumsum([0, *sizes])[:-1]
            before = ends - pieces[:, 2]
            base = block["start"].to_numpy()
            yield pd.DataFrame(
                {
                    "uid": block["uid"].to_numpy()[pieces[:, 0]],
                    "start": base[pieces[:, 0]] + pieces[:, 1],
                    "length": pieces[:, 2],
                    "sequence_id": sequence + np.repeat(np.arange(len(windows)), sizes),
                    "offset": before - np.repeat(before[first], sizes),
                }
            ).astype("Int64").reindex(columns=names)
            sequence += len(windows)
            rest = block.assign(start=base + start, left=left)[left > 0]
            if len(rest):
                yield rest.reindex(columns=names)

    names = [c.split()[0] for c in PLACED.split(", ")]
    lead = 4 * number
    path = F.concat(F.substring("path", lead + 1, 4), F.substring("path", 1, lead), F.substring("path", lead + 5, 4 * PATH_LEADERS))
    ordered = rows.withColumn("by", path).repartitionByRange(max(1, -(-n // TASK_DOCUMENTS)), "by", "uid")
    return ordered.sortWithinPartitions("by", "uid").drop("by").mapInPandas(packed, PLACED)


def digested(pieces: DataFrame) -> DataFrame:
    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out, base = [], frame["doc_tokens"] // WINDOW * WINDOW
            for rest, n, start, length in zip(
                frame["rest"], frame["doc_tokens"] % WINDOW, frame["start"], frame["length"], strict=True
            ):
                out.append(crc32(read(rest, n)[start : start + length].astype("<u4").tobytes()))
            yield frame.assign(start=frame["start"] + base, ids_crc32=out, doc_id=frame["doc_id"].astype("Int64"))[names]

    names = [c.split()[0] for c in PIECES.split(", ")]
    return pieces.mapInPandas(digests, PIECES)


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all documents: where each lies in its document and in its sequence."""
    rows = tokenised(docs, path, doc_id, text).withColumn("uid", F.monotonically_increasing_id())
    rows = materialize(rows, "packing-tokens")
    known = figures(rows)
    n, placed = rows.count(), None
    left = routed(rows, known, n)
    for number in range(len(SHARES)):
        done = materialize(packed_round(left, known, number, n), f"packing-round-{number}")
        some = done.where("sequence_id IS NOT NULL").select("uid", "start", "length", "sequence_id", "offset")
        placed = some if placed is None else placed.unionAll(some)
        left = done.where("sequence_id IS NULL").drop("length", "sequence_id", "offset")
        n = left.count()
    full = rows.select("doc_id", "doc_tokens", F.posexplode("full").alias("k", "ids_crc32"))
    full = full.select(
        "doc_id",
        (F.col("k").cast("long") * WINDOW).alias("start"),
        F.lit(WINDOW).cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return full.unionAll(digested(placed.join(rows.select("uid", "doc_id", "doc_tokens", "rest"), "uid")))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), vocabulary())
