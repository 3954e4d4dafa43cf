"""Line de-duplication with two Bloom filters.

One pass puts the hash of every line's key in a filter of hashes seen once and one of hashes seen
twice; only lines that the second filter suspects are shuffled, to confirm the repeats exactly and
to choose the document that keeps the line. The filters have a fixed greatest size: on more data
more lines are suspected, and the result stays exact.

Defined cases: a null or empty text is one empty line; rows that share a doc_id count as one
document; rows with a null doc_id keep all lines; repeats within a document alone drop nothing.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helio.llm.common import put_back, set_aside, table, with_length
from helio.session import materialize

#: White space that is stripped at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCUMENTS = 3
BITS_PER_LINE = 16
#: 2 ** 29 bits are 64 MB, the most that is ever collected and sent out.
MIN_LOG_BITS, MAX_LOG_BITS = 20, 29
#: A filter is merged in segments of so many bits.
SEGMENT_BITS = 1 << 19
PROBES = 3

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), _UPPER, _UPPER.lower())


def _digest(key: Column) -> Column:
    return F.unhex(F.sha2(key.cast("binary"), 256))


def _hashes(text: str) -> list[tuple[int, int]]:
    """Number and hash of each line of a text whose key has enough bytes."""
    keys = (line.strip(BLANKS.encode()).lower() for line in text.encode("utf-8", "surrogatepass").split(b"\n"))
    return [(i, xxhash.xxh3_64_intdigest(k)) for i, k in enumerate(keys) if len(k) >= MIN_CHARS]


def _probes(hashes: np.ndarray, log_bits: int) -> np.ndarray:
    """Places of each hash in a filter, one row a probe."""
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((low + steps * high) & np.uint64((1 << log_bits) - 1)).astype(np.int64)


def twice_filter(texts: DataFrame, log_bits: int) -> np.ndarray:
    """The filter of hashes seen at least twice, merged from every task's two filters.

    A task sends the places that its hashes hit, with how often (once or more); a place is in the
    merged second filter if it is hit twice in all. A batch sends a place once, however often its
    lines repeat, and a reducer streams over what it gets, holding one segment's places.
    """
    segments = max(1, (1 << log_bits) // SEGMENT_BITS)
    width = (1 << log_bits) // segments

    def hit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            hashes = [h for text in frame["text"] for h in {h for _, h in _hashes(text)}]
            if not hashes:
                continue
            values, counts = np.unique(np.array(hashes, dtype=np.uint64), return_counts=True)
            places = _probes(values, log_bits)
            # the same place twice for one hash must not look like two hashes
            places = np.sort(places, axis=0)
            fresh = np.ones_like(places, dtype=bool)
            fresh[1:] = places[1:] != places[:-1]
            often = np.broadcast_to(counts > 1, places.shape)[fresh]
            place, at = np.unique(places[fresh], return_inverse=True)
            hits = np.minimum(np.bincount(at) + np.bincount(at, weights=often).astype(int), 2)
            for segment in np.unique(place // width):
                own = place // width == segment
                yield pd.DataFrame(
                    {
                        "segment": [segment],
                        "places": [(place[own] % width).astype(np.uint32).tobytes()],
                        "hits": [hits[own].astype(np.uint8).tobytes()],
                    }
                )

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Streams over a partition's rows; its segments are held as one byte a place."""
        seen: dict[int, np.ndarray] = {}
        for frame in frames:
            for segment, places, hits in zip(frame["segment"], frame["places"], frame["hits"], strict=True):
                have = seen.setdefault(segment, np.zeros(width, dtype=np.uint8))
                where = np.frombuffer(places, dtype=np.uint32)
                have[where] = np.minimum(have[where] + np.frombuffer(hits, dtype=np.uint8), 2)
        for segment, have in seen.items():
            yield pd.DataFrame({"segment": [segment], "bits": [np.packbits(have > 1).tobytes()]})

    sent = texts.mapInPandas(hit, "segment long, places binary, hits binary")
    merged = sent.repartition(segments, "segment").mapInPandas(merge, "segment long, bits binary")
    bits = np.zeros((segments, width // 8), dtype=np.uint8)
    for row in merged.toLocalIterator():
        bits[row["segment"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return bits.reshape(-1)


def suspect_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, digest`` of every line whose hash the second filter holds."""
    texts = docs.select(F.col(text).alias("text")).where(F.length("text") >= MIN_CHARS)
    lines = texts.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 1
    log_bits = int(np.clip(int(BITS_PER_LINE * lines - 1).bit_length(), MIN_LOG_BITS, MAX_LOG_BITS))
    session = docs.sparkSession
    bits = session.sparkContext.broadcast(twice_filter(texts, log_bits))

    def suspected(texts: pd.Series) -> pd.Series:
        """Numbers of a text's lines, from 0, that may be repeats."""
        held, out = bits.value, []
        for t in texts:
            found = _hashes(t)
            p = _probes(np.array([h for _, h in found], dtype=np.uint64), log_bits)
            hit = ((held[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1).all(axis=0)
            out.append([i for (i, _), h in zip(found, hit.tolist(), strict=True) if h])
        return pd.Series(out)

    suspect = F.pandas_udf(suspected, T.ArrayType(T.IntegerType()))
    rows = docs.where(F.col(doc_id).isNotNull() & (F.length(text) >= MIN_CHARS)).select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    chosen = rows.withColumn("numbers", suspect("text")).where(F.size("numbers") > 0)
    lines = chosen.select("doc_id", F.split("text", "\n", -1).alias("lines"), "numbers").select(
        "doc_id", F.explode(F.transform("numbers", lambda n: F.get("lines", n))).alias("line")
    )
    keys = lines.select("doc_id", line_key(F.col("line")).alias("key")).where(F.length("key") >= MIN_CHARS)
    return keys.select("doc_id", _digest(F.col("key")).alias("digest"))


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, digests``: for each document the keys whose lines it loses."""
    suspects = materialize(suspect_lines(docs, doc_id, text).distinct(), "suspect-lines")
    repeats = (
        suspects.groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= MIN_DOCUMENTS)
        .select("digest", "keeper")
    )
    return (
        suspects.join(repeats, "digest")
        .where("doc_id <> keeper")
        .groupBy("doc_id")
        .agg(F.collect_list("digest").alias("digests"))
        .withColumnRenamed("doc_id", "_doc")
    )


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs``, with ``_lines`` and ``_kept`` in place of columns of those names: the lines before and after."""
    lost = repeated_lines(docs, doc_id, text).toDF("__doc", "__digests")
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    kept = F.when(F.col("__digests").isNull(), F.col("_lines")).otherwise(
        F.filter("_lines", lambda line: ~F.array_contains("__digests", _digest(line_key(line))))
    )
    return (
        docs.join(lost, docs[doc_id] == lost["__doc"], "left")
        .withColumn("_lines", lines)
        .withColumn("_kept", kept)
        .drop("__doc", "__digests")
    )


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``; a document without lines left goes."""
    done = drop_repeats(set_aside(docs)).where(F.size("_kept") > 0)
    text = F.when(F.size("_kept") == F.size("_lines"), F.col("text")).otherwise(F.array_join("_kept", "\n"))
    return with_length(put_back(done.withColumn("text", text), docs))


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = drop_repeats(docs)
    return done.select(
        "doc_id",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
        F.sha2(F.array_join("_kept", "\n").cast("binary"), 256).alias("kept_sha256"),
    )


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT r, doc_id, u.i AS i, lines[u.i] AS line FROM docs, unnest(range(1, len(lines) + 1)) AS u(i)
), keyed AS (
  SELECT r, doc_id, i, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeats AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT r, k.doc_id, i, line, coalesce(k.doc_id <> keeper, false) AS dropped
  FROM keyed k LEFT JOIN repeats USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""
