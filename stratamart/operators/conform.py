"""Raw text rows -> typed rows, driven by an EntitySpec. One filter and one projection."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions.cleaning import (
    blank_to_null,
    clean_text,
    to_date_iso,
    to_decimal,
    to_int,
    valid_key,
    with_default,
)
from stratamart.specs import AUDIT_DELETED, ColumnRule, EntitySpec

#: Columns of rows that are sorted out: the raw row and the reasons of a rejected one, and whether it is.
RAW_ROW, REASONS, REJECTED = "raw_row", "reasons", "rejected"


def typed_column(rule: ColumnRule) -> Column:
    """The typed value of one rule, default applied."""
    raw = F.col(rule.source)
    if rule.data_type == "string":
        value = clean_text(raw)
    elif rule.data_type in ("int", "bigint"):
        value = to_int(raw, rule.data_type, rule.decimal_comma)
    elif rule.data_type == "date":
        value = to_date_iso(raw, rule.date_formats)
    elif rule.data_type.startswith("decimal("):
        precision, scale = rule.data_type[len("decimal(") : -1].split(",")
        value = to_decimal(raw, int(precision), int(scale))
    else:
        raise ValueError(f"{rule.name}: no conversion from text to {rule.data_type}")
    if rule.default is not None:
        value = with_default(value, rule.default, rule.data_type)
    return value.alias(rule.name)


def key_problems(spec: EntitySpec) -> Column:
    """Why a raw row cannot be loaded: one reason for each numeric key that is missing or no whole number."""
    reasons = []
    for rule in spec.key_rules():
        raw = F.col(rule.source)
        reason = F.when(blank_to_null(raw).isNull(), F.lit(f"{rule.source} missing")).when(
            ~valid_key(raw), F.lit(f"{rule.source} not a whole number")
        )
        reasons.append(reason)
    return F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")


def _key_is_usable(spec: EntitySpec) -> Column:
    usable = [valid_key(F.col(rule.source)) for rule in spec.key_rules()]
    return F.coalesce(reduce(and_, usable, F.lit(True)), F.lit(False))


def conform(raw: DataFrame, spec: EntitySpec) -> DataFrame:
    """Typed and cleaned columns of the rows whose numeric keys are usable.

    Keys get their default here, before anything is matched on them. The cast of a numeric key is
    guarded by the same test as the row filter: Spark may evaluate inferred conditions on the cast
    ahead of the filter, and an unguarded cast would then raise on the rows being left out.
    """
    guarded = {rule.name for rule in spec.key_rules()}
    columns = []
    for rule in spec.columns:
        value = typed_column(rule)
        if rule.name in guarded:
            value = F.when(valid_key(F.col(rule.source)), value).alias(rule.name)
        columns.append(value)
    return raw.where(_key_is_usable(spec)).select(*columns)


def sort_out(raw: DataFrame, spec: EntitySpec) -> DataFrame:
    """Every raw row, once: typed columns if it can be loaded, else the row as it came and why not.

    ``REJECTED`` tells which. A row that is rejected for its key is not converted, so nothing else in it
    can fail the load.
    """
    usable = _key_is_usable(spec)
    typed = [F.when(usable, typed_column(rule)).alias(rule.name) for rule in spec.columns]
    return raw.select(
        *typed,
        F.when(~usable, F.struct(*raw.columns)).alias(RAW_ROW),
        F.when(~usable, key_problems(spec)).alias(REASONS),
        (~usable).alias(REJECTED),
    )


def rejected(raw: DataFrame, spec: EntitySpec) -> DataFrame:
    """The raw rows that ``conform`` leaves out because of their key."""
    return raw.where(~_key_is_usable(spec))


def active(df: DataFrame) -> DataFrame:
    """Rows that are not soft-deleted."""
    return df.where(~F.col(AUDIT_DELETED))
