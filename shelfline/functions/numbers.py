"""Lenient number parsing: every rule is a Column that yields NULL instead of failing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from .text import WS, strip

_DIGITS = r"\d+(?:_\d+)*"
FLOAT_TEXT = rf"^[{WS}]*[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?[{WS}]*$"
INT_TEXT = rf"^[{WS}]*[+-]?{_DIGITS}[{WS}]*$"


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StringType)


def parse_float(c: Column) -> Column:
    """Text to double. The pattern keeps out forms only Spark would take, such as ``1d``."""
    return F.when(c.rlike(FLOAT_TEXT), F.replace(strip(c), F.lit("_"), F.lit("")).try_cast("double"))


def parse_int(c: Column) -> Column:
    return F.when(c.rlike(INT_TEXT), F.replace(strip(c), F.lit("_"), F.lit("")).try_cast("bigint"))


def parse_price_text(c: Column, locale: str = "plain") -> Column:
    """Price in free text: digits and dots only, commas dropped, any sign lost.

    ``locale="vi"`` reads dot-separated groups of three digits as thousands.
    """
    if locale not in ("plain", "vi"):
        raise ValueError(f"unknown price locale: {locale}")
    kept = F.regexp_replace(c, "[^0-9.]", "")
    if locale == "vi":
        grouped = kept.rlike(r"^\d{1,3}(?:\.\d{3})+$")
        kept = F.when(grouped, F.replace(kept, F.lit("."), F.lit(""))).otherwise(kept)
    return F.when(kept.rlike(r"^(?:\d+\.?\d*|\.\d+)$"), kept.try_cast("double"))


def normalize_price(c: Column, text: bool = True, locale: str = "plain") -> Column:
    if text:
        return parse_price_text(c, locale)
    d = c.cast("double")
    return F.when((d >= 0) & ~F.isnan(d), d)


def _in_range(d: Column, low: float, high: float) -> Column:
    return F.when((d >= low) & (d <= high), d)


def normalize_percentage(c: Column, text: bool = True) -> Column:
    d = parse_float(F.replace(c, F.lit("%"), F.lit(""))) if text else c.cast("double")
    return _in_range(d, 0, 100)


def normalize_rating(c: Column, text: bool = True) -> Column:
    return _in_range(parse_float(c) if text else c.cast("double"), 0, 5)


def normalize_integer(c: Column, text: bool = True) -> Column:
    """Whole number towards zero, never negative; anything unreadable is 0."""
    d = parse_float(F.replace(c, F.lit(","), F.lit(""))) if text else c
    return F.greatest(F.lit(0), F.coalesce(d.try_cast("bigint"), F.lit(0))).cast("bigint")


def first_number(c: Column) -> Column:
    """First unsigned decimal number inside a text."""
    return F.nullif(F.regexp_extract(c, r"(\d+\.?\d*)", 1), F.lit("")).try_cast("double")


def first_int(c: Column) -> Column:
    """First run of digits inside a text once thousands commas are gone."""
    found = F.regexp_extract(F.replace(c, F.lit(","), F.lit("")), r"(\d+)", 1)
    return F.nullif(found, F.lit("")).try_cast("bigint")


def discount_pct(price: Column, original: Column) -> Column:
    """Percent off the original price, two decimals, half up; NULL if either side is missing."""
    return F.when(original != 0, F.round((original - price) / original * 100, 2))


def python_float_text(c: Column) -> Column:
    """Shortest plain decimal text of a double, e.g. ``299000.0`` where a cast says ``1.0E7``."""
    plain = F.regexp_replace(c.cast("decimal(38,18)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(F.abs(c).between(1e-4, 1e16) | (c == 0), plain).otherwise(c.cast("string"))
