"""Rounding, display styles and comparison of displayed values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLITTER = float(2**27 + 1)
_INTEGRAL = float(2**52)


def _scaling_error(value: Column, scale: float, scaled: Column) -> Column:
    """Exact value*scale minus its rounded double.

    The value is split in two halves of at most 26 bits (Veltkamp); a power of ten up
    to 10^11 has at most 26 significant bits, so both partial products are exact.
    """
    shifted = value * F.lit(_SPLITTER)
    high = shifted - (shifted - value)
    return (high * F.lit(scale) - scaled) + (value - high) * F.lit(scale)


def round_exact(col: Column, digits: int) -> Column:
    """Round half-even on the exact binary value, so 2.675 gives 2.67 and 0.125 gives 0.12.

    `bround` rounds the shortest decimal text instead and would give 2.68. Only a
    product that lands exactly on a tie needs the rounding error of that product
    to tell on which side the true value lies.
    """
    value = col.cast("double")
    if digits == 0:
        return F.rint(value)
    if not 0 < digits <= 11:
        raise ValueError("round_exact supports 0 to 11 digits")
    scale = 10.0**digits
    scaled = value * F.lit(scale)
    tie = F.abs(scaled - F.rint(scaled)) == F.lit(0.5)
    side = F.when(tie, F.signum(_scaling_error(value, scale, scaled)) * F.lit(0.25)).otherwise(F.lit(0.0))
    # At 2^52 and beyond (also inf and NaN) there is no fraction left to round.
    return F.when(F.abs(scaled) >= F.lit(_INTEGRAL), value).otherwise(
        F.rint(scaled + side) / F.lit(scale)
    )


def styled(col: Column, style: str) -> Column:
    """Display style of an exported column; nulls (and NaN) stay null."""
    if style == "raw":
        return col
    if style == "date":
        return F.date_format(col.cast("date"), "yyyy-MM-dd")
    value = F.nanvl(col.cast("double"), F.lit(None).cast("double"))
    if style == "int":
        return F.rint(value).cast("long")
    if style == "round2":
        return round_exact(value, 2)
    if style == "percent2":
        return round_exact(value * F.lit(100.0), 2)
    if style == "percent0":
        return F.rint(value * F.lit(100.0)).cast("long")
    raise ValueError(f"unknown display style: {style}")


def displayed_number(col: Column, style: str) -> Column:
    """Read a displayed number back: blank is null, otherwise rounded to the style's precision."""
    value = F.trim(col.cast("string")).try_cast("double")
    return F.rint(value) if style in ("int", "percent0") else round_exact(value, 2)


def fixed_text(col: Column, digits: int, missing: str | None = None) -> Column:
    """Fixed-point text of a number, with an optional text for null."""
    text = F.format_string(f"%.{digits}f", round_exact(col, digits))
    shown = F.when(col.isNotNull(), text)
    return shown if missing is None else F.coalesce(shown, F.lit(missing))


def percent_text(col: Column) -> Column:
    return F.concat(fixed_text(col * F.lit(100.0), 2), F.lit("%"))


# Labels of the deviation buckets, in display order, with their upper bounds.
DEVIATION_BUCKETS = (
    ("<1%", 0.01),
    ("1%～2%", 0.02),
    ("2%～5%", 0.05),
    ("5%～10%", 0.10),
    ("10%以上", None),
)
NO_DEVIATION = "-"


def deviation_bucket(col: Column) -> Column:
    size = F.abs(col)
    bucket = F.when(col.isNull(), F.lit(NO_DEVIATION))
    for label, upper in DEVIATION_BUCKETS:
        bucket = bucket.otherwise(F.lit(label)) if upper is None else bucket.when(size < upper, F.lit(label))
    return bucket


def joined_reasons(reasons: Iterable[tuple[Column, Column]]) -> Column:
    """Texts of the conditions that hold, in the given order; empty text if none."""
    return F.concat_ws("；", *[F.when(holds, text) for holds, text in reasons])


def names_where(flags: Iterable[tuple[str, Column]], separator: str, in_order: bool = True) -> Column:
    """Names of the true flags, in field order or sorted."""
    named = F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in flags]))
    return F.array_join(named if in_order else F.array_sort(named), separator)


def same_displayed(left: Column, right: Column) -> Column:
    """Both null, or both present and equal within 1e-12 (integers are exact in a double)."""
    return (
        F.when(left.isNull() & right.isNull(), F.lit(True))
        .when(left.isNull() | right.isNull(), F.lit(False))
        .otherwise(F.abs(left.cast("double") - right.cast("double")) <= F.lit(1e-12))
    )


def yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit("是")).otherwise(F.lit("否"))
