"""Substring de-duplication by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk begins at each word's start whose hash is the
least of some WINDOW_WORDS word starts in a row. Of every window inside a shared passage the same start
is chosen, and what stands around the passage adds no boundary between the first and the last of them:
all but WINDOW_WORDS - 1 words at either end, and the words of the hash's 16 bytes at its start, is the
same chunks. So a passage of 50 words, however it is written, has a run of at least MIN_RUN_WORDS.
Chunks are compared by digest over all documents; runs of chunks that occurred earlier (in the order of
doc_id and position) and are long enough are taken out.

Defined cases: null stays null and empty stays empty, with no chunk; rows with a null doc_id come
last in order, as one document; rows that share a doc_id are one document, none earlier than the
other; a text without white space is cut at gear hits or, failing these, at fixed lengths.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helio.llm.common import blocks, byte_values, joined, mix, put_back, set_aside, table, utf8, with_length

#: Word starts of a window, whose least hash begins a chunk: one word's start in six, about.
WINDOW_WORDS = 11
#: A chunk longer than this is cut inside words, one byte in DENSE at random, then at MAX_BYTES.
LONG_BYTES, DENSE, MAX_BYTES = 400, 64, 1024
#: A run of earlier chunks is taken out if it has so many words, or bytes where words are long.
MIN_RUN_WORDS, MIN_RUN_BYTES = 20, 400

_GEAR = (byte_values(23) >> np.uint64(48)).astype(np.uint16)
_GEAR[65:91] = (mix(np.arange(900, 926, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(77))
_ODD = np.uint64(0xD6E8FEB86659FD93)
_ODD_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))

def gear(flat: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: 16 bits, so 16 bytes back; built by doubling."""
    h = _GEAR[flat]
    for width in (1, 2, 4, 8):
        h[width:] = h[width:] + (h[:-width] << np.uint16(width))
    return h


def _least(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places in ``h`` that are the first least value of a window inside one text."""
    n = len(h) - WINDOW_WORDS + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    low, width = (h.astype(np.int64) << 32) + np.arange(len(h)), 1
    while 2 * width <= WINDOW_WORDS:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    low = np.minimum(low[:n], low[WINDOW_WORDS - width :])
    return np.unique(low[text[:n] == text[WINDOW_WORDS - 1 :]] & 0xFFFFFFFF)


def _bounds(flat: np.ndarray, lo: int, hi: int, hits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Chunk starts of one text, its end last."""
    edges = np.unique(np.concatenate(([lo], hits, [hi])))
    gaps = np.diff(edges)
    if len(gaps) and gaps.max() > LONG_BYTES:
        more = [edges]
        for a, b in zip(edges[:-1][gaps > LONG_BYTES], edges[1:][gaps > LONG_BYTES], strict=True):
            lead = (flat[a + 1 : b] & 0xC0) != 0x80
            inner = np.flatnonzero((h[a:b - 1] < 65536 // DENSE) & lead) + a + 1
            for c, d in zip(np.append(a, inner), np.append(inner, b), strict=True):
                for at in range(c + MAX_BYTES, d, MAX_BYTES):
                    while (flat[at] & 0xC0) == 0x80:
                        at -= 1
                    more.append([at])
            more.append(inner)
        edges = np.unique(np.concatenate(more))
    return edges


def chunked(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each text the digests, bounds (one more) and numbers of words of its chunks."""
    for lo, hi in blocks(texts):
        flat, offsets = joined(texts[lo:hi])
        blank = _BLANK[flat]
        start = np.zeros(len(flat), dtype=bool)
        start[1:] = blank[:-1] & ~blank[1:]
        h = gear(flat)
        start[offsets[1:-1]] = False
        begins = np.flatnonzero(start)
        hits = begins[_least(h[begins - 1], np.searchsorted(offsets, begins, "right"))]
        start[offsets[:-1]] = ~blank[offsets[:-1]]
        words = np.append(0, np.cumsum(start))
        powers = np.full(len(flat), _ODD)
        powers[0] = 1
        powers = np.cumprod(powers)
        inverse = np.full(len(flat) + 1, _ODD_INVERSE)
        inverse[0] = 1
        inverse = np.cumprod(inverse)
        sums = np.append(np.uint64(0), np.cumsum(_VALUE[flat] * powers))
        first = np.searchsorted(hits, offsets)
        for i in range(hi - lo):
            a, b = offsets[i], offsets[i + 1] - 1
            if a == b:
                yield np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int64)
                continue
            edges = _bounds(flat, a, b, hits[first[i] : first[i + 1]], h)
            raw = (sums[edges[1:]] - sums[edges[:-1]]) * inverse[edges[:-1]]
            digests = mix(raw ^ mix(np.diff(edges).astype(np.uint64)))
            yield digests.view(np.int64), edges - a, words[edges[1:]] - words[edges[:-1]]


def _cut(texts: pd.Series) -> pd.Series:
    """The distinct digests of each text's chunks."""
    return pd.Series([np.unique(digests) for digests, _, _ in chunked(utf8(texts))], dtype=object)


chunk_digests = F.pandas_udf(_cut, T.ArrayType(T.LongType()))

REMOVED = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("n_chunks", T.LongType()),
        T.StructField("n_dropped", T.LongType()),
        T.StructField("dropped_chars", T.LongType()),
    ]
)


def runs(again: np.ndarray, bounds: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Of chunks that occurred earlier, those in a run that is long enough."""
    out = np.zeros(len(again), dtype=bool)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], again.astype(np.int8), [0]))))
    for a, b in zip(edge[0::2], edge[1::2], strict=True):
        if words[a:b].sum() >= MIN_RUN_WORDS or bounds[b] - bounds[a] >= MIN_RUN_BYTES:
            out[a:b] = True
    return out


def _remove(texts: pd.Series, earlier: pd.Series) -> pd.DataFrame:
    """Texts without the long runs of chunks that occurred in them before or are in ``earlier``."""
    rows = []
    data = utf8(texts)
    for text, raw, (digests, bounds, words), known in zip(texts, data, chunked(data), earlier, strict=True):
        again = np.ones(len(digests), dtype=bool)
        again[np.unique(digests, return_index=True)[1]] = False
        if known is not None and len(known):
            again |= np.isin(digests, np.asarray(known, dtype=np.int64))
        gone = runs(again, bounds, words) if again.any() else again
        if gone.any():
            kept = b"".join(raw[bounds[i] : bounds[i + 1]] for i in np.flatnonzero(~gone))
            left = kept.decode("utf-8", "surrogatepass")
            rows.append((left, len(digests), int(gone.sum()), len(text) - len(left)))
        else:
            rows.append((text, len(digests), 0, 0))
    return pd.DataFrame(rows, columns=REMOVED.names)


remove_runs = F.pandas_udf(_remove, REMOVED)
_LAST = (1 << 63) - 1


def earlier_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``_doc, earlier``: for each document the digests of its chunks that an earlier one holds."""
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST))
    chunks = docs.where(F.length(text) > 0).select(
        key.alias("doc"), F.explode(chunk_digests(F.col(text))).alias("digest")
    )
    first = (
        chunks.groupBy("digest")
        .agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        .where("last > first")
        .select("digest", "first")
    )
    return (
        chunks.join(first, "digest")
        .where("doc > first")
        .groupBy(F.col("doc").alias("_doc"))
        .agg(F.collect_list("digest").alias("earlier"))
    )


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the struct ``rest``, in place of a column of that name: the text left and counts of chunks."""
    later = earlier_chunks(docs, doc_id, text).toDF("__doc", "__earlier")
    key = F.coalesce(docs[doc_id].cast("long"), F.lit(_LAST)) == later["__doc"]
    return (
        docs.join(later, key, "left")
        .withColumn("rest", remove_runs(F.col(text), F.col("__earlier")))
        .drop("__doc", "__earlier")
    )


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated passages; a document of which nothing is left goes."""
    done = dedup(set_aside(docs)).withColumn("text", F.col("rest.text"))
    emptied = (F.col("rest.dropped_chars") > 0) & (F.length(F.btrim("text")) == 0)
    return with_length(put_back(done.where(~F.coalesce(emptied, F.lit(False))), docs))


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs).select("doc_id", "rest.*")
