"""Column expressions that turn raw feed text into typed values.

All of them are built-in Spark expressions, so they stay inside whole-stage code generation. A value
that cannot be converted raises (Spark's ANSI casts), which fails the entity being loaded; nothing is
silently turned into NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# `\z` and not `$`: in Java regular expressions `$` also matches before a final line break.
_DIGITS_ONLY = r"^[0-9]+\z"
# Spark's own cast would accept '2018' or '2018-03' as a date.
_ISO_DATE = r"^\d{4,}-\d{1,2}-\d{1,2}([ T].*)?\z"


def clean_text(c: Column) -> Column:
    """Strip spaces at both ends. Blank text becomes '' and is *not* treated as missing."""
    return F.trim(c)


def blank_to_null(c: Column) -> Column:
    """NULL for text that is empty once trimmed, else the trimmed text."""
    return F.nullif(F.trim(c), F.lit(""))


def with_default(c: Column, default: Any, data_type: str | None = None) -> Column:
    """Replace NULL. The default takes ``data_type`` so that it cannot widen a decimal column."""
    value = F.lit(default)
    return F.coalesce(c, value if data_type is None else value.cast(data_type))


def to_int(c: Column, data_type: str = "int", decimal_comma: bool = False) -> Column:
    """Whole number from text; '2,5' raises, and so does '2,0'."""
    text = blank_to_null(c)
    if decimal_comma:
        text = F.replace(text, F.lit(","), F.lit("."))
    return text.cast(data_type)


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    """DECIMAL from text with a decimal comma or point, rounded half away from zero."""
    text = F.replace(blank_to_null(c), F.lit(","), F.lit("."))
    return text.cast(f"decimal({precision},{scale})")


def to_date_iso(c: Column, formats: Sequence[str] = ()) -> Column:
    """DATE from ISO text, or from the first of ``formats`` that fits when some are given."""
    text = blank_to_null(c)
    if formats:
        parsed = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats])
        understood = parsed.isNotNull()
    else:
        parsed = text.cast("date")
        understood = text.rlike(_ISO_DATE)
    return (
        F.when(text.isNull(), F.lit(None).cast("date"))
        .when(understood, parsed)
        .otherwise(F.raise_error(F.concat(F.lit("not a date: "), text)).cast("date"))
    )


def valid_key(c: Column) -> Column:
    """True for text holding only digits once trimmed; NULL for NULL."""
    return F.trim(c).rlike(_DIGITS_ONLY)


def line_amount(price: Column, quantity: Column) -> Column:
    """price * quantity as money with three decimals."""
    return (price * quantity).cast("decimal(15,3)")
