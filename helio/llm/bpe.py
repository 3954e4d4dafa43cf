"""Byte-pair encoding by speculation, and decoding.

Greedy longest matches propose tokens for every new word of a batch. A proposal is right if each
adjacent pair of its tokens is what merging the two tokens' letters gives, as merges that cross a
boundary depend on its two sides only; all pairs of a batch are tested against the known ones in one
step, and only words with a wrong pair are merged exactly. Words are kept in a bounded cache.

Texts are cut at special tokens first, in the spelling of the vocabulary, then at white space. Chunks
beyond ASCII take their normal form and their words from the library's own normaliser and pre-tokenizer, whose
tables of code points are not Python's; merging is done here. Words longer than a grid's row are merged by a heap over
a linked list, so that time grows with their length and a grid with its rows.

Defined cases: null is the empty text; it and blank text have no tokens and decode to the empty
text; special tokens that occur in a text are encoded as such, other spellings of them are text; equal texts encode alike.
"""

import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helio.llm.common import table

#: White space, and the pattern that splits words.
SPACE = regex.compile("[\t-\r \x85\xa0  -     　]+")
_CONTROLS = regex.compile("[\x1c-\x1f]")
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WORD_END = "</w>"
#: Chunks, words and pairs that a worker keeps in each generation of its caches.
CACHE_CHUNKS, CACHE_WORDS, CACHE_PAIRS = 300_000, 200_000, 500_000
#: Code points of texts whose new words are learnt in one step, about.
GROUP_CHARS = 1 << 20
#: Cells of a grid of rows that are merged together, and the longest row in one.
GRID_CELLS, GRID_WIDTH = 1 << 17, 64
NO_RANK = 1 << 40

RESULT = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class Pairs:
    """Ranks and results of merges, found by hash for whole arrays of pairs."""

    LOG = 20

    def __init__(self, codes: np.ndarray, made: np.ndarray):
        self.tables = []
        rank = np.arange(len(codes), dtype=np.int64)
        seed = 1
        while len(codes):
            places = self._place(codes, seed)
            _, first = np.unique(places, return_index=True)
            keys, values = np.full(1 << self.LOG, -1, dtype=np.int64), np.zeros(1 << self.LOG, dtype=np.int64)
            keys[places[first]], values[places[first]] = codes[first], rank[first] << 32 | made[first]
            self.tables.append((seed, keys, values))
            rest = np.setdiff1d(np.arange(len(codes)), first)
            codes, made, rank, seed = codes[rest], made[rest], rank[rest], seed + 1

    def _place(self, codes: np.ndarray, seed: int) -> np.ndarray:
        spread = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * seed * 0x5851F42D4C957F2D & 0xFFFFFFFFFFFFFFFF)
        return (spread >> np.uint64(64 - self.LOG)).astype(np.int64)

    def find(self, codes: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ranks, made = np.full(codes.shape, NO_RANK, dtype=np.int64), np.zeros(codes.shape, dtype=np.int64)
        for seed, keys, values in self.tables:
            places = self._place(codes, seed)
            hit = (keys[places] == codes) & valid
            found = values[places[hit]]
            ranks[hit], made[hit] = found >> 32, found & 0xFFFFFFFF
        return ranks, made


class Codec:
    """Encodes and decodes with one vocabulary file of word-end byte-pair encoding."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        merges = spec["model"]["merges"]
        self.pairs = Pairs(
            np.array([self.ids[a] << 32 | self.ids[b] for a, b in merges], dtype=np.int64),
            np.array([self.ids[a + b] for a, b in merges], dtype=np.int64),
        )
        self.longest = max(map(len, self.ids))
        #: The longest entry that begins with some two letters.
        self.reach: dict[str, int] = {}
        for name in self.ids:
            self.reach[name[:2]] = max(len(name), self.reach.get(name[:2], 1))
        self.plain = dict(enumerate(byte_letters()[:128]))
        self.by_pair = {self.ids[a] << 32 | self.ids[b]: (rank, self.ids[a + b]) for rank, (a, b) in enumerate(merges)}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        # two generations of each cache: what is used again outlives the older one
        self.chunks: dict[str, tuple[bytes, str]] = {}
        self.words: dict[str, list[int]] = {}
        self.old_chunks, self.old_words = self.chunks, self.words
        self.fits: dict[int, bool] = {}

    def _symbols(self, letters: str, ends: bool) -> list[int]:
        ids = [self.ids[c] for c in letters[: -1 if ends else None]]
        return [*ids, self.ids[letters[-1] + WORD_END]] if ends else ids

    def merged(self, rows: list[list[int]]) -> list[list[int]]:
        """Exact merging of many rows of ids: the pair of lowest rank first, leftmost on ties.

        Rows of like length are merged together, one merge of each row a step; long ones each by a heap.
        """
        out: list[list[int]] = [[] for _ in rows]
        order = sorted(range(len(rows)), key=lambda i: len(rows[i]))
        lo = 0
        while lo < len(order) and len(rows[order[lo]]) <= GRID_WIDTH:
            hi = lo + 1
            while hi < len(order) and len(rows[order[hi]]) <= GRID_WIDTH and (hi - lo) * len(rows[order[hi]]) < GRID_CELLS:
                hi += 1
            own = order[lo:hi]
            for i, row in zip(own, self._merged_grid([rows[i] for i in own]), strict=True):
                out[i] = row
            lo = hi
        for i in order[lo:]:
            out[i] = self._merged_long(rows[i])
        return out

    def _merged_grid(self, rows: list[list[int]]) -> list[list[int]]:
        """Rows in order of length, padded to the last one's."""
        width = len(rows[-1])
        grid = np.full((len(rows), width + 1), -1, dtype=np.int64)
        for k, row in enumerate(rows):
            grid[k, : len(row)] = row
        active = np.arange(len(rows))
        while len(active) and width:
            now = grid[active]
            ranks, made = self.pairs.find(now[:, :-1] << 32 | (now[:, 1:] & 0xFFFFFFFF), now[:, 1:] >= 0)
            at = ranks.argmin(axis=1)
            going = ranks[np.arange(len(active)), at] < NO_RANK
            active, now, at, made = active[going], now[going], at[going], made[going]
            if not len(active):
                break
            each, column = np.arange(len(active)), np.arange(width + 1)
            moved = np.take_along_axis(now, np.minimum(column + (column > at[:, None]), width), axis=1)
            moved[each, at] = made[each, at]
            moved[:, width] = -1
            grid[active] = moved
        return [row[row >= 0].tolist() for row in grid]

    def _merged_long(self, row: list[int]) -> list[int]:
        ids, known, none = [*row], self.by_pair, -1
        before, after = list(range(-1, len(ids) - 1)), [*range(1, len(ids)), none]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j != none and (found := known.get(ids[i] << 32 | ids[j])):
                heappush(heap, (found[0], i, found[1], ids[i], ids[j]))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            _, i, made, left, right = heappop(heap)
            j = after[i]
            # an entry is stale if one of its two has been merged since
            if ids[i] != left or j == none or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = made, none, after[j]
            if after[j] != none:
                before[after[j]] = i
            offer(i)
            if before[i] != none:
                offer(before[i])
        return [x for x in ids if x != none]

    def _proposed(self, letters: str) -> list[int] | None:
        """Greedy longest matches over a word's letters, the word end being part of the last."""
        ids, at, end, known, reach = [], 0, len(letters), self.ids, self.reach
        while at < end:
            if end - at <= self.longest:
                found = known.get(letters[at:] + WORD_END)
                if found is not None:
                    ids.append(found)
                    return ids
            for stop in range(min(end - 1, at + reach.get(letters[at : at + 2], 1)), at, -1):
                found = known.get(letters[at:stop])
                if found is not None:
                    break
            else:
                return None
            ids.append(found)
            at = stop
        return None

    def _letters_of(self, token: int) -> list[int]:
        name = self.names[token]
        ends = name.endswith(WORD_END) and name != WORD_END
        return self._symbols(name[: -len(WORD_END)] if ends else name, ends)

    def learn_words(self, words: list[str]) -> None:
        """Encode new words, given by their letters: propose, test all adjacent pairs, merge what fails."""
        if len(self.fits) > CACHE_PAIRS:
            self.fits = {}
        proposals = [self._proposed(w) for w in words]
        sizes = np.array([len(p) if p else 0 for p in proposals], dtype=np.int64)
        flat = np.array([i for p in proposals if p for i in p], dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)
        inside = owner[1:] == owner[:-1]
        pairs, number = np.unique((flat[:-1] << 32 | flat[1:])[inside], return_inverse=True)
        # a token that stands alone is tested as a pair with nothing
        alone = np.flatnonzero(sizes == 1)
        single = np.array([proposals[i][0] for i in alone], dtype=np.int64)
        known = [*pairs.tolist(), *(-1 - np.unique(single)).tolist()]
        fresh = [p for p in known if p not in self.fits]
        parts = [(p >> 32, p & 0xFFFFFFFF) if p >= 0 else (-1 - p,) for p in fresh]
        for p, want, got in zip(fresh, parts, self.merged([[x for t in y for x in self._letters_of(t)] for y in parts]), strict=True):
            self.fits[p] = list(want) == got
        good = np.array([self.fits[p] for p in pairs.tolist()], dtype=bool)
        wrong = np.bincount(owner[1:][inside], weights=~good[number], minlength=len(words)) > 0
        wrong |= sizes == 0
        wrong[alone] = [not self.fits[p] for p in (-1 - single).tolist()]
        failed = np.flatnonzero(wrong).tolist()
        for i, ids in zip(failed, self.merged([self._symbols(words[i], True) for i in failed]), strict=True):
            proposals[i] = ids
        for word, ids in zip(words, proposals, strict=True):
            self.words[word] = ids

    def split(self, text: str) -> list[str]:
        """Chunks between white space, which no word crosses; those in ASCII in lower case."""
        if _CONTROLS.search(text):
            chunks = [c for c in SPACE.split(text) if c]
        elif text.isascii():
            return text.lower().split()
        else:
            chunks = text.split()
        return [c.lower() if c.isascii() else c for c in chunks]

    def words_of(self, chunk: str) -> list[str]:
        """The words of a chunk, each by the letters of its bytes."""
        if not chunk.isascii():
            return [w for w, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(chunk))]
        words = WORD.findall(chunk)
        return words if chunk.isprintable() else [w.translate(self.plain) for w in words]

    def _learn(self, new: list[str]) -> None:
        if len(self.words) > CACHE_WORDS:
            self.words, self.old_words = {}, self.words
        found = [self.words_of(c) for c in new]
        words = {w for ws in found for w in ws}.difference(self.words)
        for w in [w for w in words if w in self.old_words]:
            self.words[w] = self.old_words[w]
            words.remove(w)
        if words:
            self.learn_words(list(words))
        for chunk, ws in zip(new, found, strict=True):
            ids = [i for w in ws for i in self.words[w]]
            self.chunks[chunk] = (array("I", ids).tobytes(), " ".join([self.names[i] for i in ids]))

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """For each text its ids as little-endian 32-bit integers, and the decoded text.

        New parts of some megabyte of texts are learnt together.
        """
        lo, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size > GROUP_CHARS or i == len(texts) - 1:
                yield from self._group(texts[lo : i + 1])
                lo, size = i + 1, 0

    def _group(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        # every second part is a special token; its key cannot be a chunk's, as it holds a space
        cut = [self.cut.split(t) if self.cut and any(s in t for s in self.special) else [t] for t in texts]
        split = [[[" " + p] if k % 2 else self.split(p) for k, p in enumerate(parts)] for parts in cut]
        if len(self.chunks) > CACHE_CHUNKS:
            self.chunks, self.old_chunks = {}, self.chunks
        self.chunks |= {" " + s: (array("I", [i]).tobytes(), s) for s, i in self.special.items()}
        new = {c for parts in split for chunks in parts for c in chunks}.difference(self.chunks)
        for c in [c for c in new if c in self.old_chunks]:
            self.chunks[c] = self.old_chunks[c]
            new.remove(c)
        if new:
            self._learn(list(new))
        known = self.chunks
        for parts in split:
            got = [known[c] for chunks in parts for c in chunks]
            yield b"".join([g[0] for g in got]), " ".join([g[1] for g in got if g[1]])


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encoder(path: str):
    """A pandas function from texts to the number of tokens and the digests of ids and decoded text."""

    def encode(texts: pd.Series) -> pd.DataFrame:
        own, rows = codec(path), []
        for ids, said in own.encode([t if isinstance(t, str) else "" for t in texts]):
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(said.encode("utf-8", "surrogatepass")).hexdigest()))
        return pd.DataFrame(rows, columns=RESULT.names)

    return F.pandas_udf(encode, RESULT)


def ids_of(path: str):
    """A pandas function from texts to arrays of token ids."""

    def encode(texts: pd.Series) -> pd.Series:
        own = codec(path)
        return pd.Series(
            [np.frombuffer(i, dtype="<u4").astype(np.int32) for i, _ in own.encode([t if isinstance(t, str) else "" for t in texts])],
            dtype=object,
        )

    return F.pandas_udf(encode, T.ArrayType(T.IntegerType()))


def texts_of(path: str):
    """A pandas function from arrays of token ids back to text."""

    def decode(ids: pd.Series) -> pd.Series:
        names = codec(path).names
        return pd.Series([" ".join(names[int(i)] for i in x) if x is not None else None for x in ids])

    return F.pandas_udf(decode, T.StringType())


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the struct ``bpe``."""
    return docs.withColumn("bpe", encoder(path)(F.col(text)))


def query(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "bpe.*")
