"""Checks that stand in for the constraints a Spark table does not enforce."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class DuplicateKeyError(ValueError):
    """More than one row has the same key."""


class ConstraintError(ValueError):
    """Rows break NOT NULL or length rules, or a load deletes more than allowed."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once with their number of rows.

    Counts are combined before the shuffle, so a key held by many rows costs no more than another.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "source") -> None:
    """Raise if a key occurs more than once."""
    example = duplicate_keys(df, keys).limit(1).first()
    if example is not None:
        key = ", ".join(f"{k}={example[k]!r}" for k in keys)
        raise DuplicateKeyError(f"{what}: {example['rows']} rows with {key}")


def _rules(schema: StructType, lengths: Mapping[str, int] | None) -> list[tuple[str, str, Column]]:
    rules = [(f.name, "not_null", F.col(f.name).isNull()) for f in schema if not f.nullable]
    for column, limit in (lengths or {}).items():
        # Trailing spaces do not count towards a length.
        rules.append((column, f"max_length_{limit}", F.length(F.rtrim(F.col(column))) > limit))
    return rules


#: At most so many keys of rows that break a rule are named.
EXAMPLES = 3
_KEYS_OF = " keys"


def _examples(broken: Column, keys: Sequence[str]) -> Column:
    """An aggregate that names rows breaking a rule: the least key in each of a few classes of keys.

    The overall least is among them. The classes are by hash, so that several keys are named where there
    are several, and the aggregate is bounded and merged like any minimum.
    """
    key = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    key_class = F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast("int") % EXAMPLES
    least = [F.min(F.when(broken & (key_class == n), key)) for n in range(EXAMPLES)]
    return F.array_sort(F.array_compact(F.array(*least)))


def constraint_measures(
    schema: StructType, lengths: Mapping[str, int] | None = None, keys: Sequence[str] = ()
) -> dict[str, Column]:
    """Aggregates counting the violations of each rule, to be taken while a snapshot is written.

    With ``keys`` some of the rows that break a rule are named as well.
    """
    measures = {}
    for column, rule, broken in _rules(schema, lengths):
        measures[f"{column} {rule}"] = F.count_if(broken)
        if keys:
            measures[f"{column} {rule}{_KEYS_OF}"] = _examples(broken, keys)
    return measures


def assert_measures(measured: Mapping[str, object], measures: Mapping[str, Column], what: str) -> None:
    """Raise if any of ``measures`` counted a violation, naming rows where they were measured."""
    broken = []
    for rule in measures:
        if rule.endswith(_KEYS_OF) or not measured[rule]:
            continue
        named = measured.get(rule + _KEYS_OF)
        broken.append(f"{rule}: {measured[rule]} rows" + (f", such as {'; '.join(named)}" if named else ""))
    if broken:
        raise ConstraintError(f"{what}: {'; '.join(broken)}")


def check_constraints(
    df: DataFrame, schema: StructType, lengths: Mapping[str, int] | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """(column, rule, violations) for every NOT NULL field and text length limit, in one pass.

    With ``keys`` also examples: the keys of some rows that break the rule.
    """
    rules = _rules(schema, lengths)
    if not rules:
        raise ValueError("no constraints to check")
    counts = [F.count_if(broken).alias(f"r{i}") for i, (_, _, broken) in enumerate(rules)]
    if keys:
        counts += [_examples(broken, keys).alias(f"e{i}") for i, (_, _, broken) in enumerate(rules)]
    entries = [
        F.struct(
            F.lit(column).alias("column"),
            F.lit(rule).alias("rule"),
            F.col(f"r{i}").alias("violations"),
            *([F.col(f"e{i}").alias("examples")] if keys else []),
        )
        for i, (column, rule, _) in enumerate(rules)
    ]
    return df.agg(*counts).select(F.inline(F.array(*entries)))
