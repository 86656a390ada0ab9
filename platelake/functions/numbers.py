"""Censored and mixed readings to numbers, and rounding to two places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from platelake.functions.identifiers import strip

# Texts a spreadsheet reader takes as "no value".
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Digits may be grouped by single underscores, which Spark's cast refuses; it would also take "1.0d", "1.0f" and
# hexadecimal forms. A text that the cast refuses or that may be one of these is matched against the full form.
_DIGITS = "[0-9](?:_?[0-9])*"
NUMBER_FORM = (
    rf"(?i)^[+-]?(?:(?:{_DIGITS}[.]?(?:{_DIGITS})?|[.]{_DIGITS})(?:e[+-]?{_DIGITS})?|inf(?:inity)?|nan)$"
)


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(*MISSING_TEXTS), text)


def number_core(text: Column) -> Column:
    """What of a text is to be a number: no ``>``, no spaces after it."""
    return F.when(text.contains(">"), F.ltrim(F.replace(text, F.lit(">"), F.lit("")))).otherwise(text)


def number_of_core(core: Column, cast: Column) -> Column:
    """The number of a ``number_core``, given also its cast to double; NULL when it is not a number.

    Nearly all readings are plain decimals, which Spark's cast reads just as Python's ``float`` does. Their first and last
    characters show that nothing had to be stripped and that no type letter follows; all others are stripped and meet the pattern.
    """
    last = F.right(core, F.lit(1))
    plain = cast.isNotNull() & (core >= "+") & (core < ":") & last.between(".", "9") & ~core.contains("x") & ~core.contains("X")
    matched = F.replace(F.regexp_extract(strip(core), NUMBER_FORM, 0), F.lit("_"), F.lit(""))
    return F.when(plain, cast).otherwise(matched.try_cast("double"))


def number_of(text: Column) -> Column:
    """The number a text stands for, any ``>`` left out; NULL when it is not a number."""
    core = number_core(text)
    return number_of_core(core, core.try_cast("double"))


def round2(value: Column) -> Column:
    """Round half-even on the exact binary value, which Spark's ``round`` and ``bround`` do not.

    Away from a tie the nearest whole number of hundredths is certain, and its division by 100 is exact to the last
    bit. Near a tie, and for large values, the decimal print decides. Infinity has no decimal print and stays.
    """
    hundredths = value * F.lit(100.0)
    from_tie = F.abs(hundredths - F.floor(hundredths) - F.lit(0.5))
    certain = (F.abs(hundredths) < F.lit(1e12)) & (from_tie > F.lit(1e-3))
    printed = F.call_function("format_number", value, F.lit("0.00")).try_cast("double")
    return F.when(certain, F.rint(hundredths) / F.lit(100.0)).otherwise(F.coalesce(printed, value)) + F.lit(0.0)


def is_censored(text: Column) -> Column:
    return F.coalesce(text.contains(">"), F.lit(False))
