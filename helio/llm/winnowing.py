"""Document fingerprints by winnowing, with built-in functions only.

Tokens are words, or single characters where a word is long, so that text without spaces has them
too. Every run of K tokens has a hash; of each W consecutive hashes the smallest is selected, the
rightmost on ties, and kept with its position. Two texts that share K + W - 1 tokens in a row
therefore share a selected hash.

Defined cases: null is the empty text, which has no hash; texts of fewer than K tokens have one hash
of all their tokens; fingerprints without a hash are alike (1) among themselves and unlike (0) any
other; rows that share a doc_id follow each other in the order of their texts; rows with a null
doc_id come after all others, ordered by text.
"""

import math

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helio.llm.common import parallel, table

#: Fixed values of the fingerprint: tokens of a hash, hashes of a window.
K, WINDOW = 3, 4
#: A word of at most so many characters is one token.
WORD_CHARS = 24
TOKEN = rf"(?<!\S)\S{{1,{WORD_CHARS}}}(?!\S)|\S"
#: Positions have 24 bits; a hash has 39, so that both fit a positive integer of 64 bits.
POSITION_BITS = 24
#: Rows of a range of ids, about, and ranges at most.
RANGE_ROWS, MAX_RANGES = 20_000, 65_536
_POSITIONS = (1 << POSITION_BITS) - 1


def _shifted(name: str, by: int) -> Column:
    """An array without its first ``by`` elements."""
    return F.slice(name, by + 1, F.greatest(F.size(name) - by, F.lit(0)))


def with_selected(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: selected hashes of ``text`` with their positions, as packed integers.

    The hash is in the upper bits and the complement of the position in the lower ones: the least
    integer is the smallest hash at its rightmost place. Minima of windows come from minima of
    half as long windows.
    """
    t, h, m = f"_{out}_t", f"_{out}_h", f"_{out}_m"
    df = df.withColumn(t, F.transform(F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0)), lambda x: F.xxhash64(x)))

    def run(x: Column, i: Column) -> Column:
        hashed = F.xxhash64(x, *[F.get(F.col(t), i + d) for d in range(1, K)])
        return F.shiftleft(F.shiftrightunsigned(hashed, 64 - 63 + POSITION_BITS), POSITION_BITS) + (F.lit(_POSITIONS) - i)

    df = df.withColumn(h, F.transform(F.slice(t, 1, F.greatest(F.size(t) - (K - 1), F.least(F.size(t), F.lit(1)))), run))
    width, name = 1, h
    while width < WINDOW:
        new = f"{m}{width}"
        df = df.withColumn(
            new,
            F.when(F.size(h) < WINDOW, F.col(name)).otherwise(
                F.zip_with(F.slice(name, 1, F.size(name) - width), _shifted(name, width), lambda a, b: F.least(a, b))
            ),
        )
        width, name = width * 2, new
    few = F.when(F.size(h) > 0, F.array(F.array_min(h))).otherwise(F.slice(h, 1, 0))
    df = df.withColumn(out, F.when(F.size(h) < WINDOW, few).otherwise(F.array_distinct(name)))
    return df.drop(t, *[c for c in df.columns if c == h or c.startswith(m)])


def hashes(selected: str) -> Column:
    return F.array_distinct(F.transform(selected, lambda x: F.shiftright(x, POSITION_BITS)))


def positions(selected: str) -> Column:
    return F.transform(selected, lambda x: F.lit(_POSITIONS) - x.bitwiseAND(F.lit(_POSITIONS)))


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two sets."""
    both = F.size(F.array_intersect(a, b))
    all_ = F.size(a) + F.size(b) - both
    return F.when(all_ == 0, F.lit(1.0)).otherwise(both / all_)


def _bounds(ids: DataFrame, parts: int) -> list[int]:
    """Largest id of each of at most ``parts`` ranges of about as many rows; a few rows reach the driver."""
    rows = (
        ids.repartitionByRange(parts, "i")
        .groupBy(F.spark_partition_id().alias("p"))
        .agg(F.max("i").alias("top"))
        .collect()
    )
    return sorted({r["top"] for r in rows if r["top"] is not None})


def _numbers(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _range_of(column: Column, tops: list[int]) -> tuple[Column, Column]:
    """Number of the range that an id lies in, and whether the id is its largest.

    Ranges are found in two steps, each by counting the tops below the id in a short array.
    """
    size = max(1, math.isqrt(len(tops)))
    groups = [tops[k : k + size] for k in range(0, len(tops), size)]
    outer = F.least(F.size(F.filter(_numbers([g[-1] for g in groups]), lambda top: top < column)), F.lit(len(groups) - 1))
    inner = F.get(F.array(*[_numbers(g) for g in groups]), outer)
    return outer * size + F.size(F.filter(inner, lambda top: top < column)), F.array_contains(inner, column)


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, WindowSpec]:
    """All columns of ``docs``, ``_text`` without nulls, ``_next``, and the window of that order.

    The order runs from the largest id to the smallest, and from there to the largest. Ids are cut
    into ranges of bounded size, each a group of the window; the first row of a range is also a
    guest at the end of the one before it, so no row needs a second shuffle.
    """
    keyed = docs.withColumn("_i", F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))).withColumn(
        "_text", F.coalesce(F.col(text), F.lit(""))
    )
    rows = docs.count()
    parts = min(max(4 * parallel(docs.sparkSession), -(-rows // RANGE_ROWS)), MAX_RANGES)
    tops = _bounds(keyed.select(F.col("_i").alias("i")), parts) or [0]
    number, is_top = _range_of(F.col("_i"), tops)
    own = F.struct(F.col("_r").alias("part"), F.lit(False).alias("guest"))
    visit = F.struct(((F.col("_r") + 1) % len(tops)).alias("part"), F.lit(True).alias("guest"))
    placed = (
        keyed.withColumn("_r", number)
        .withColumn("_place", F.explode(F.when(is_top, F.array(own, visit)).otherwise(F.array(own))))
        .withColumns({"_part": F.col("_place.part"), "_guest": F.col("_place.guest")})
        .drop("_r", "_place")
    )
    order = W.partitionBy("_part").orderBy("_guest", F.desc("_i"), "_text")
    return placed.withColumn("_next", F.coalesce(F.lead("_text").over(order), F.lit(""))), order


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` and: n_chars of the text, the edited text's digest, the selected
    hashes of both, and the likeness of the text's to the edited text's and the next text's."""
    names = [c for c in docs.columns if c != "n_chars"]
    placed, order = with_next(docs.select(*names), doc_id, text)
    n, half = F.length("_text"), F.floor(F.length("_text") / 2).cast("int")
    edited = placed.withColumn("n_chars", n.cast("long")).withColumn(
        "_edited", F.concat(F.left("_text", n - half), F.left("_next", half))
    )
    edited = edited.withColumn("edited_sha256", F.sha2(F.col("_edited").cast("binary"), 256))
    chosen = with_selected(with_selected(edited, "_text", "selected"), "_edited", "edited_selected")
    chosen = chosen.select(*names, "n_chars", "edited_sha256", "selected", "edited_selected", "_part", "_guest", "_i", "_text")
    chosen = chosen.withColumn("_after", F.coalesce(F.lead("selected").over(order), F.lit([]).cast("array<bigint>")))
    return (
        chosen.where(~F.col("_guest"))
        .withColumn("_own", hashes("selected"))
        .withColumn("near_edited", likeness(F.col("_own"), hashes("edited_selected")))
        .withColumn("near_next", likeness(F.col("_own"), hashes("_after")))
        .drop("_part", "_guest", "_i", "_text", "_after", "_own")
    )


def digest(selected: str) -> Column:
    """One string for selected hashes and their positions."""
    return F.sha2(F.array_join(F.transform(selected, lambda x: F.hex(x)), " ").cast("binary"), 256)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprints(docs).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        digest("selected").alias("fingerprint"),
        digest("edited_selected").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.size("selected").cast("long").alias("n_selected"),
    )
