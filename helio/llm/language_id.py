"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of learning texts. A text, in lower case, is
cut into pieces, every piece is compressed against each dictionary, and the language with the fewest bytes
in all wins; a narrow margin is rejected.

Defined cases: a null text or one without a letter is ``und`` with score 0; a tie goes to the
language with the most learning texts; without any learning row every text is ``und``; rows with a null
language are not learnt from; repeated rows are scored alike and learnt from once.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helio.llm.common import table

UNDETERMINED = "und"
#: Learning texts a language at most, chosen by the smallest hashes of all its texts.
SAMPLE_TEXTS = 64
#: Of each of them as many code points at most.
SAMPLE_CHARS = 1200
MAX_LANGUAGES = 500
PIECE_BYTES = 4096
#: Matches of four bytes are worth having in pieces this small.
PARAMETERS = {"min_match": 4, "hash_log": 16, "chain_log": 16, "search_log": 3, "window_log": 18}
#: A margin below this share of the runner-up's bytes is rejected.
MIN_MARGIN = 0.01

RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("margin", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
)


def learn(rows: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Dictionaries by language from a bounded sample of ``rows``, most frequent language first.

    The first pass ranks hashes only; the second fetches the chosen texts. What reaches the
    driver is bounded by the three sample parameters.
    """
    usable = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    hashed = usable.select("lang", F.xxhash64("text").alias("h"))
    counts = {r["lang"]: r["n"] for r in hashed.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # a uniform hash: the smallest of each of 256 slices, then the smallest of these
    salted = hashed.distinct().withColumn("salt", F.pmod("h", F.lit(256)))
    least = (
        salted.groupBy("lang", "salt")
        .agg(F.min("h").alias("h"))
        .groupBy("lang")
        .agg(F.slice(F.sort_array(F.collect_list("h")), 1, SAMPLE_TEXTS).alias("hs"))
        .collect()
    )
    chosen = [h for r in least for h in r["hs"]]
    if not chosen:
        return {}
    texts = (
        usable.withColumn("h", F.xxhash64("text"))
        .where(F.col("h").isin(chosen))
        .groupBy("lang", "h")
        .agg(F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("part"))
        .collect()
    )
    parts: dict[str, list[tuple[int, str]]] = {}
    for r in texts:
        parts.setdefault(r["lang"], []).append((r["h"], r["part"]))
    order = sorted(parts, key=lambda k: (-counts[k], k))
    return {k: "\n".join(p for _, p in sorted(parts[k])[:SAMPLE_TEXTS]).lower().encode() for k in order}


def pieces(data: bytes) -> list[bytes]:
    return [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]


def classifier(dictionaries: dict[str, bytes]):
    """A pandas function from texts to predictions."""
    names = list(dictionaries)

    def compressors() -> list[zstandard.ZstdCompressor]:
        made = []
        for name in names:
            content = zstandard.ZstdCompressionDict(
                dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            how = zstandard.ZstdCompressionParameters(
                strategy=zstandard.STRATEGY_LAZY, write_content_size=False, write_checksum=False, **PARAMETERS
            )
            content.precompute_compress(compression_params=how)
            made.append(zstandard.ZstdCompressor(compression_params=how, dict_data=content))
        return made

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tools = compressors()
        for texts in batches:
            rows = []
            for text in texts:
                if not names or not isinstance(text, str) or not any(map(str.isalpha, text)):
                    rows.append((UNDETERMINED, 0.0, 0.0, True))
                    continue
                cut = pieces(text.lower().encode("utf-8", "surrogatepass"))
                sizes = np.array([sum(len(c.compress(p)) for p in cut) for c in tools])
                best = int(sizes.argmin())
                others = np.delete(sizes, best)
                margin = float((others.min() - sizes[best]) / others.min()) if len(others) else 1.0
                odds = np.exp2(-np.minimum((sizes - sizes[best]) / 4.0, 60.0)).sum()
                rows.append((names[best], float(1.0 / odds), margin, margin < MIN_MARGIN))
            yield pd.DataFrame(rows, columns=RESULT.names)

    return F.pandas_udf(predict, RESULT)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: Column | str = "text") -> DataFrame:
    """All columns of ``docs`` and ``language``: a struct of prediction, score, margin, rejected."""
    return docs.withColumn("language", classifier(dictionaries)(F.col(text) if isinstance(text, str) else text))


def query(spark, sf_dir):
    from helio.llm.common import fold

    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (fold("doc_id", 4) == 2).alias("held_out")
    )
    models = learn(docs.where(~F.col("held_out")))
    return identify(docs.select("doc_id", "held_out", "text"), models).select(
        "doc_id", "held_out", "language.*"
    )
