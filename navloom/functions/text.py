"""Parsing of codes, numbers, rates and dates out of messy source text.

Every function takes and returns a Column and yields null, never an error, on
text that cannot be parsed (ANSI mode is on by default in Spark 4).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounds of a DECIMAL(20,6) column that stay exact as a double, the placeholder text sources
# use for "no value", the width of a code, and the patterns of numbers and dates in source text.
MONEY_LIMIT = 99999999999999.99
BLANK_TEXTS = ("", "---")
CODE_WIDTH = 6
SIGNED_NUMBER = r"[-+]?\d+(?:\.\d+)?"
UNSIGNED_NUMBER = r"\d+(?:\.\d+)?"
COMPACT_DATE = r"^\d{8}$"
TWO_DIGIT_DATE = r"\d{4}[-/]\d{2}[-/]\d{2}"
CHINESE_DATE = r"\d{4}年\d{1,2}月\d{1,2}日"
SPACED_CHINESE_DATE = r"\d{4}年\s*\d{1,2}月\s*\d{1,2}日"
DASHED_DATE = r"\d{4}-\d{1,2}-\d{1,2}"
SLASHED_DATE = r"\d{4}/\d{1,2}/\d{1,2}"

_WHITESPACE = " \t\r\n\f　 "


def stripped(col: Column) -> Column:
    return F.trim(col.cast("string"), F.lit(_WHITESPACE))


def fund_code(col: Column) -> Column:
    """Left-pad to six characters; longer codes are kept (plain lpad would cut them)."""
    text = stripped(col)
    return F.when(F.length(text) >= CODE_WIDTH, text).otherwise(F.lpad(text, CODE_WIDTH, "0"))


def to_number(col: Column) -> Column:
    """Text to double. Java number suffixes ("1.5d") and NaN are not numbers here.

    The cast itself ignores surrounding white space.
    """
    content = col.cast("string")
    suffixed = F.lower(F.right(F.rtrim(content), F.lit(1))).isin("d", "f")
    return F.nanvl(F.when(~suffixed, content.try_cast("double")), F.lit(None).cast("double"))


def to_date(col: Column) -> Column:
    """Text to date: ISO by the fast built-in cast, then slashed and compact forms.

    The patterns are tried only on text of their shape: a failing parse is costly.
    """
    content = col.cast("string")
    return F.coalesce(
        content.try_cast("date"),
        F.when(content.contains("/"), F.try_to_date(stripped(content), "yyyy/M/d")),
        F.when(stripped(content).rlike(COMPACT_DATE), F.try_to_date(stripped(content), "yyyyMMdd")),
    )


def first_number(col: Column) -> Column:
    """First signed decimal found anywhere in the text; thousands separators end it."""
    return F.regexp_substr(col.cast("string"), F.lit(SIGNED_NUMBER)).try_cast("double")


def number_or_blank(col: Column) -> Column:
    """first_number, with the placeholder texts read as null."""
    return F.when(~stripped(col).isin(*BLANK_TEXTS), first_number(col))


def rate_to_ratio(col: Column) -> Column:
    """Percentage text ("1.20%（每年）") to a ratio (0.012)."""
    return number_or_blank(col) / F.lit(100.0)


def clamp_money(col: Column) -> Column:
    """Limit to what DECIMAL(20,6) can hold; NaN and infinities become null."""
    value = col.cast("double")
    finite = F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)
    return F.when(
        finite.isNotNull(), F.greatest(F.least(finite, F.lit(MONEY_LIMIT)), F.lit(-MONEY_LIMIT))
    )


def dividend_amount(col: Column) -> Column:
    """First unsigned decimal of a dividend text ("每份派现金0.1584元" gives 0.1584)."""
    return F.regexp_substr(col.cast("string"), F.lit(UNSIGNED_NUMBER)).try_cast("double")


def split_ratio(col: Column) -> Column:
    """Number after the last colon of a split text ("1:3.9939" gives 3.9939)."""
    return to_number(F.element_at(F.split(stripped(col), ":"), -1))


def _chinese_date(col: Column, spaces_allowed: bool) -> Column:
    found = F.regexp_substr(col, F.lit(SPACED_CHINESE_DATE if spaces_allowed else CHINESE_DATE))
    return F.try_to_date(F.regexp_replace(found, r"\s+", ""), "yyyy年M月d日")


def general_date(col: Column) -> Column:
    """Date inside free text: two-digit ISO or slashed form, then Chinese, then the whole text."""
    text = stripped(col)
    numeric = F.regexp_substr(text, F.lit(TWO_DIGIT_DATE))
    chinese = F.regexp_substr(text, F.lit(CHINESE_DATE))
    return (
        F.when(text.isin(*BLANK_TEXTS), F.lit(None).cast("date"))
        .when(numeric.isNotNull(), F.try_to_date(F.translate(numeric, "/", "-"), "yyyy-MM-dd"))
        .when(chinese.isNotNull(), _chinese_date(text, spaces_allowed=False))
        .otherwise(to_date(text))
    )


def inception_date(col: Column) -> Column:
    """Founding date inside free text: Chinese form first, then ISO, then slashed."""
    text = stripped(col)
    chinese = F.regexp_substr(text, F.lit(SPACED_CHINESE_DATE))
    dashed = F.regexp_substr(text, F.lit(DASHED_DATE))
    slashed = F.regexp_substr(text, F.lit(SLASHED_DATE))
    return (
        F.when(text == "", F.lit(None).cast("date"))
        .when(chinese.isNotNull(), _chinese_date(text, spaces_allowed=True))
        .when(dashed.isNotNull(), F.try_to_date(dashed, "yyyy-M-d"))
        .when(slashed.isNotNull(), F.try_to_date(slashed, "yyyy/M/d"))
        .otherwise(to_date(text))
    )
