"""Number parsing and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: texts read as a float. Java would also take suffixes ("1.5d") and hex
# floats, and would refuse digit groups ("1_000"), so the grammar is spelled out.
FLOAT_TEXT = (
    r"(?i)^[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?|inf|infinity|nan)$"
)
WHITESPACE = " \t\n\r\f\v"


def coerce_float(text: Column, default: float = 0.0) -> Column:
    """``text`` as a double; null and anything that is not a number give ``default``."""
    trimmed = F.btrim(text, F.lit(WHITESPACE))
    # most texts have digits only, which both grammars read alike: no pattern is tried on them
    plain = F.translate(trimmed, "0123456789.-", "") == ""
    return F.coalesce(
        F.when(plain, trimmed.try_cast("double")).when(
            trimmed.rlike(FLOAT_TEXT), F.translate(trimmed, "_", "").try_cast("double")
        ),
        F.lit(float(default)),
    )


def rounded(value: Column, digits: int = 3) -> Column:
    """Half-up rounding that does not depend on the order a sum was built in.

    Partial sums arrive in any order, so a mean that is a tie on paper may come out a
    few 1e-13 below it. Rounding to ``digits + 6`` first removes that noise.
    """
    return F.round(F.round(value, digits + 6), digits)
