"""Helpers shared by the text operators: input columns, session settings, byte blocks of a batch."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step handles; a longer text is a block of its own.
BLOCK_BYTES = 1 << 18


#: Rows that Spark hands to Python at a time, at most: several copies of a batch are in memory at once.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Python workers; results do not depend on it. A lower setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallel(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: The column that holds a caller's other columns while an operator works.
ASIDE = "__aside"


def set_aside(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, and all other columns as one, so that none meets a working column of its name."""
    others = [F.col(f"`{c}`").alias(c) for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others or [F.lit(None).alias("none")]).alias(ASIDE))


def put_back(done: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, with the text that ``done`` has."""

    def column(name: str):
        if name in ("doc_id", "text"):
            return F.col(name)
        return F.col(ASIDE)[name].alias(name)

    return done.select(*[column(c) for c in docs.columns])


def with_length(docs: DataFrame) -> DataFrame:
    """``n_chars``, if there is one, as the length of the text that is there now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def fold(column: str, mod: int):
    """crc32 of the id's text, modulo ``mod``; null ids count as the text "null"."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary")) % mod


def utf8(texts: Iterable[object]) -> list[bytes]:
    """Texts as UTF-8; null counts as empty."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes together."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, a newline after each, and the n + 1 offsets of their starts."""
    flat = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    return flat, offsets


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (two rounds of xor and multiply)."""
    h = np.asarray(h, dtype=np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def byte_values(seed: int) -> np.ndarray:
    """A 64-bit value for each byte, the same for A-Z and a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(2 * seed + 1) + np.uint64(seed))
    values[65:91] = values[97:123]
    return values


class Words:
    """Words of a block of texts, hashed without a loop over them.

    A word's hash is the difference of two prefix sums of byte values times powers of an odd
    number, divided by the power at its start, all modulo 2**64.
    """

    _powers = np.ones(1, dtype=np.uint64)
    _inverses = np.ones(1, dtype=np.uint64)

    @classmethod
    def _grown(cls, n: int) -> None:
        if len(cls._powers) < n:
            powers, inverses = np.full(n, _ODD), np.full(n, _INVERSE)
            powers[0] = inverses[0] = 1
            cls._powers, cls._inverses = np.cumprod(powers), np.cumprod(inverses)

    def __init__(self, texts: list[bytes], separators: np.ndarray, values: np.ndarray):
        """``separators``: for each byte whether it ends a word; the newline must be one."""
        flat, offsets = joined(texts)
        inside = ~separators[flat]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edges = np.concatenate(([0], edges))
        self.flat, self.offsets = flat, offsets
        self.starts, self.ends = edges[0::2], edges[1::2]
        self._grown(len(flat) + 1)
        sums = np.zeros(len(flat) + 1, dtype=np.uint64)
        np.cumsum(values[flat] * self._powers[: len(flat)], out=sums[1:])
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * self._inverses[self.starts])
        #: For each text the index of its first word, and the number of all words at the end.
        self.first = np.searchsorted(self.starts, offsets)


def whole_groups(frames: Iterable[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Runs of rows with the same key, from frames sorted by it."""
    rest: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        keys = frame[key].to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        bounds = [0, *cuts.tolist(), len(frame)]
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            if rest and rest[-1][key].iloc[0] != keys[lo]:
                yield pd.concat(rest, ignore_index=True)
                rest = []
            rest.append(frame.iloc[lo:hi])
    if rest:
        yield pd.concat(rest, ignore_index=True)
