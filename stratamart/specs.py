"""Declarative descriptions of feeds, entities, dimensions and facts."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql.types import DataType, StringType, StructField, StructType, TimestampNTZType

LANDING, STAGING, TRANSFORMATION, SERVICE = "landing_zone", "staging", "transformation", "service"
LAYERS = (LANDING, STAGING, TRANSFORMATION, SERVICE)

AUDIT_CREATED, AUDIT_UPDATED = "created_at", "updated_at"
AUDIT_DELETED, AUDIT_DELETED_AT = "is_deleted", "deleted_at"


@dataclass(frozen=True)
class FeedSpec:
    """A delimited feed, loaded by position into an all-text landing table."""

    file: str
    table: str
    columns: tuple[str, ...]
    delimiter: str | None = None  # None: sniffed from the header line
    encoding: str = "UTF-8"
    # Quoted fields may hold line breaks. Files stay split, at the price of reading them up to three times;
    # only UTF-16 and other encodings that Spark cannot decode by expression take one task for each file.
    multiline: bool = False
    # Blank lines are skipped. True: they fail the feed, at the price of a second pass over it.
    refuse_blank_lines: bool = False

    def schema(self) -> StructType:
        return StructType([StructField(c, StringType()) for c in self.columns])

    def landed_schema(self) -> StructType:
        return self.schema().add(StructField(AUDIT_CREATED, TimestampNTZType(), False))


@dataclass(frozen=True)
class ColumnRule:
    """How one typed column is obtained from one raw text column."""

    name: str
    source: str
    data_type: str  # Spark DDL type
    default: Any = None
    nullable: bool = True
    max_length: int | None = None
    decimal_comma: bool = False  # for whole numbers written with a decimal comma
    date_formats: tuple[str, ...] = ()


def text(name, max_length, default=None, source=None, nullable=True) -> ColumnRule:
    return ColumnRule(name, source or name, "string", default, nullable, max_length)


def integer(name, default=None, source=None, nullable=True, decimal_comma=False) -> ColumnRule:
    return ColumnRule(name, source or name, "int", default, nullable, None, decimal_comma)


def big_integer(name, default=None, source=None, nullable=True) -> ColumnRule:
    return ColumnRule(name, source or name, "bigint", default, nullable)


def decimal(name, precision, scale, default=None, source=None, nullable=True) -> ColumnRule:
    return ColumnRule(name, source or name, f"decimal({precision},{scale})", default, nullable)


def date(name, source=None, nullable=True, formats=()) -> ColumnRule:
    return ColumnRule(name, source or name, "date", None, nullable, None, False, tuple(formats))


@dataclass(frozen=True)
class SummaryLabels:
    active: str
    deleted: str


@dataclass(frozen=True)
class EntitySpec:
    """Landing table -> typed staging table with audit columns and soft deletes."""

    name: str
    source: str
    table: str
    keys: tuple[str, ...]
    columns: tuple[ColumnRule, ...]
    labels: SummaryLabels | None = None
    amount: str | None = None  # SQL expression summed over active rows in the load summary

    def rule(self, name: str) -> ColumnRule:
        return next(r for r in self.columns if r.name == name)

    @property
    def attributes(self) -> list[str]:
        return [r.name for r in self.columns if r.name not in self.keys]

    def key_rules(self) -> list[ColumnRule]:
        """Numeric keys: rows whose raw key is not all digits are left out of the load."""
        return [r for r in map(self.rule, self.keys) if r.data_type in ("int", "bigint")]

    def schema(self) -> StructType:
        fields = [
            StructField(r.name, DataType.fromDDL(r.data_type), r.nullable and r.name not in self.keys)
            for r in self.columns
        ]
        return StructType(fields + audit_fields(soft_delete=True))


@dataclass(frozen=True)
class DimensionSpec:
    """Staging table -> overwrite-in-place (SCD type 1) dimension with a surrogate key."""

    table: str
    source: str
    surrogate: str
    keys: tuple[str, ...]
    attributes: Mapping[str, str]  # dimension column -> staging column
    types: Mapping[str, str]  # every key and attribute -> Spark DDL type
    lengths: Mapping[str, int] = field(default_factory=dict)

    def schema(self) -> StructType:
        names = [*self.keys, *self.attributes]
        return StructType(
            [StructField(self.surrogate, DataType.fromDDL("bigint"), False)]
            + [StructField(n, DataType.fromDDL(self.types[n]), n not in self.keys) for n in names]
            + audit_fields(soft_delete=False)
        )


@dataclass(frozen=True)
class CalendarSpec:
    table: str
    surrogate: str
    start: str
    end: str


@dataclass(frozen=True)
class DimLookup:
    """Replace natural keys by the surrogate key of ``dimension``.

    ``on`` pairs a column of the incoming rows with a natural key column of the dimension. ``carry``
    brings dimension columns along so that a later lookup can use them.
    """

    dimension: str
    on: tuple[tuple[str, str], ...]
    surrogate: str
    output: str
    how: str = "inner"
    carry: tuple[str, ...] = ()


@dataclass(frozen=True)
class FactSpec:
    """Staging table -> fact table, keyed by the natural id of the transaction."""

    table: str
    source: str
    surrogate: str
    key: str
    lookups: tuple[DimLookup, ...]
    measures: Mapping[str, str]  # measure -> SQL expression over the staging columns
    types: Mapping[str, str]  # key and measures -> Spark DDL type
    total: str = ""  # measure summed in the load summary
    total_label: str = ""
    date_range: str | None = None  # calendar surrogate whose range the load summary shows

    @property
    def columns(self) -> list[str]:
        return [lk.output for lk in self.lookups] + list(self.measures)

    def required(self) -> list[str]:
        optional = {lk.output for lk in self.lookups if lk.how != "inner"}
        return [self.surrogate, self.key] + [c for c in self.columns if c not in optional]

    def schema(self) -> StructType:
        required = set(self.required())
        types = {lk.output: "bigint" for lk in self.lookups} | dict(self.types)
        names = [self.key, *self.columns]
        return StructType(
            [StructField(self.surrogate, DataType.fromDDL("bigint"), False)]
            + [StructField(n, DataType.fromDDL(types[n]), n not in required) for n in names]
            + audit_fields(soft_delete=False)
        )


@dataclass(frozen=True)
class WarehouseModel:
    """Everything a full run needs to know about one warehouse."""

    feeds: tuple[FeedSpec, ...]
    entities: tuple[EntitySpec, ...]
    calendar: CalendarSpec | None
    dimensions: tuple[DimensionSpec, ...]
    facts: tuple[FactSpec, ...]

    def part(self, tables: Collection[str]) -> WarehouseModel:
        """Only what some tables are made from, themselves included."""
        facts = tuple(f for f in self.facts if f.table in tables)
        service = {*tables, *[lookup.dimension for fact in facts for lookup in fact.lookups]}
        dimensions = tuple(d for d in self.dimensions if d.table in service)
        staging = {*tables, *[spec.source for spec in (*dimensions, *facts)]}
        entities = tuple(e for e in self.entities if e.table in staging)
        landing = {*tables, *[e.source for e in entities]}
        calendar = self.calendar if self.calendar is not None and self.calendar.table in service else None
        return WarehouseModel(tuple(f for f in self.feeds if f.table in landing), entities, calendar, dimensions, facts)


def audit_fields(soft_delete: bool) -> list[StructField]:
    kept = [
        StructField(AUDIT_CREATED, TimestampNTZType(), False),
        StructField(AUDIT_UPDATED, TimestampNTZType(), False),
    ]
    if soft_delete:
        kept += [
            StructField(AUDIT_DELETED, DataType.fromDDL("boolean"), False),
            StructField(AUDIT_DELETED_AT, TimestampNTZType(), True),
        ]
    return kept
