"""Exact percentiles by selection on digits, without a sort and without gathering values anywhere."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import PERCENTILES

#: Bits of a double's image, and of a digit of it. A task holds the counts of one digit, so 2**16 at most.
IMAGE_BITS, DIGIT_BITS = 64, 16
FRACTION = 1 << 52
#: Fixed values of the double format: bias of exponents, smallest normal and smallest positive number.
BIAS, NORMAL, TINY = 1023, 2.0**-1022, 2.0**-1074
INFINITE, NOT_A_NUMBER = 0x7FF << 52, (0x7FF << 52) + 1


def ordered_image(value: Column) -> Column:
    """A double as a signed 64-bit integer with the same order: its bit pattern, negated below zero.

    Both zeros are 0. NaN comes last, as in Spark's own order. Scaling by powers of two is exact, so nothing is lost.
    """
    size = F.abs(value)
    near = F.floor(F.log2(size))
    # the logarithm may be off by one next to a power of two
    exponent = near + F.when(size >= F.pow(F.lit(2.0), near + 1), 1).when(size < F.pow(F.lit(2.0), near), -1).otherwise(0)
    fraction = ((size / F.pow(F.lit(2.0), exponent) - 1) * FRACTION).cast("bigint")
    bits = (
        F.when(F.isnan(value), F.lit(NOT_A_NUMBER))
        .when(size == float("inf"), F.lit(INFINITE))
        .when(size >= NORMAL, F.shiftleft((exponent + BIAS).cast("bigint"), 52) + fraction)
        .otherwise((size / TINY).cast("bigint"))
    )
    return F.when((value < 0) & ~F.isnan(value), -bits).otherwise(bits)


def from_image(image: int) -> float:
    """The double with this image."""
    size = abs(image)
    if size > INFINITE:
        return float("nan")
    if size == INFINITE:
        out = float("inf")
    elif size >= FRACTION:
        out = (1 + size % FRACTION / FRACTION) * 2.0 ** ((size >> 52) - BIAS)
    else:
        out = size * TINY
    return -out if image < 0 else out


def _near(prefixes: Iterable[int], shift: int) -> Column:
    """Speeds whose image may begin with one of the prefixes: ranges that a scan can skip by."""
    ranges = F.lit(False)
    for prefix in prefixes:
        low, high = prefix << shift, ((prefix + 1) << shift) - 1
        inside = F.lit(True)
        if low >= -INFINITE:
            inside = inside & (F.col("speed") >= from_image(low))
        if high <= INFINITE:
            inside = inside & (F.col("speed") <= from_image(high))
        ranges = ranges | inside
    return ranges


def _digit_counts(images: DataFrame, prefixes: Iterable[int] | None, low: int, bits: int) -> DataFrame:
    """For each wanted prefix the counts of the next digit, in order: a row and a task of 2**bits entries at most."""
    prefix = F.lit(0).cast("bigint") if prefixes is None else F.shiftright("image", low + bits)
    # the first digit has the sign
    digit = F.shiftright("image", low) if prefixes is None else F.shiftright("image", low).bitwiseAND((1 << bits) - 1)
    kept = images if prefixes is None else images.where(prefix.isin([*prefixes]))
    counts = kept.groupBy(prefix.alias("prefix"), digit.alias("digit")).agg(F.count("*").alias("n"))
    return counts.groupBy("prefix").agg(F.sort_array(F.collect_list(F.struct("digit", "n"))).alias("digits"), F.sum("n").alias("n"))


def _crossing(rank: Column) -> Column:
    """The digit that the rank falls on, and how many values lie below it."""
    none = F.struct(F.lit(0).cast("bigint").alias("below"), F.lit(None).cast("bigint").alias("digit"))
    return F.reduce(
        "digits",
        none,
        lambda seen, d: F.when(seen["digit"].isNotNull(), seen)
        .when(seen["below"] + d["n"] >= rank, F.struct(seen["below"].alias("below"), d["digit"].alias("digit")))
        .otherwise(F.struct((seen["below"] + d["n"]).alias("below"), F.lit(None).cast("bigint").alias("digit"))),
    )


def exact_percentiles(df: DataFrame, digit_bits: int = DIGIT_BITS) -> DataFrame:
    """Percentiles of speed as order statistics: the ``ceil(p * n)``-th smallest speed.

    A speed is read as a number of 64 / ``digit_bits`` digits. Each pass counts the digits that follow the
    ones already known of a wanted rank, combining before it shuffles, and learns one more from the counts.
    A pass brings a row for each percentile to the driver; how often a speed is repeated does not matter.
    """
    spark = df.sparkSession
    speeds = df.select("speed").where(F.col("speed").isNotNull())
    # name, image known so far, rank among the values that begin with it
    wanted: list[tuple[str, int, int | None]] = [(name, 0, None) for name in PERCENTILES]
    for low in range(IMAGE_BITS - digit_bits, -1, -digit_bits):
        first = low == IMAGE_BITS - digit_bits
        prefixes = None if first else sorted({prefix for _, prefix, _ in wanted})
        near = speeds if first else speeds.where(_near(prefixes, low + digit_bits))
        counts = _digit_counts(near.select(ordered_image(F.col("speed")).alias("image")), prefixes, low, digit_bits)
        # ceil(p * n), with p as a whole number of hundredths
        hundredths = [(name, prefix, rank, round(PERCENTILES[name] * 100)) for name, prefix, rank in wanted]
        asked = spark.createDataFrame(hundredths, "name string, prefix bigint, rank bigint, p bigint")
        rank = F.coalesce(F.col("rank"), F.expr("(p * n + 99) div 100"))
        found = counts.join(F.broadcast(asked), "prefix").select("name", "prefix", rank.alias("rank"), _crossing(rank).alias("at"))
        wanted = [
            (r["name"], r["at"]["digit"] if first else r["prefix"] << digit_bits | r["at"]["digit"], r["rank"] - r["at"]["below"])
            for r in found.collect()
        ]
    answers = {name: from_image(image) for name, image, _ in wanted}
    return spark.range(1).select(*[F.lit(answers.get(name)).cast("double").alias(name) for name in PERCENTILES])
