"""Missing-value rules.

The source data knows a single missing marker (NaN).  Spark has both null and
NaN, and aggregates treat them differently (``avg`` over a NaN is NaN), so the
library maps every missing marker to null as early as possible and keeps
IEEE infinities as values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text tokens a CSV reader of the reference treats as
# missing (pandas ``read_csv`` default ``na_values``).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_value(c) -> Column:
    """NaN -> null for a double column (other values unchanged)."""
    c = _col(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def clean_tag(c) -> Column:
    """Missing-value tokens in a text tag -> null."""
    c = _col(c)
    return F.when(c.isin(NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)


def to_numeric(c) -> Column:
    """Text -> double; anything unparseable (and NaN) becomes null.

    The text is parsed once, by the cast.  The cast accepts a few forms that a
    coercing parse rejects, which are looked at only where it gave a value: a
    type suffix ('1d', '1f'), hexadecimal, and literals too large for a double
    (infinite though no word for infinity).
    """
    text = F.trim(_col(c))
    parsed = text.try_cast("double")
    infinite = F.abs(parsed) == F.lit(float("inf"))
    word = F.lower(text)
    accepted = F.when(infinite, word.rlike(r"^\s*[+-]?inf(inity)?\s*$")).otherwise(
        ~word.rlike(r"[df]\s*$|x"))
    return clean_value(F.when(accepted, parsed))


def ieee_div(numerator, denominator) -> Column:
    """IEEE division without ANSI errors: x/0 -> +-inf, 0/0 -> missing (null)."""
    n, d = _col(numerator), _col(denominator)
    inf = F.lit(float("inf"))
    return (F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
            .when(d != 0, n / d)
            .when(n > 0, inf)
            .when(n < 0, -inf)
            .otherwise(F.lit(None).cast("double")))
