from stratamart.functions.cleaning import (
    blank_to_null,
    clean_text,
    line_amount,
    to_date_iso,
    to_decimal,
    to_int,
    valid_key,
    with_default,
)

__all__ = [
    "blank_to_null",
    "clean_text",
    "line_amount",
    "to_date_iso",
    "to_decimal",
    "to_int",
    "valid_key",
    "with_default",
]
