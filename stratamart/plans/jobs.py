"""The jobs: land feeds, merge staging, merge the star schema, or all of it in order.

Each table is loaded on its own and published only after its checks pass, so one failing table leaves
the others and its own previous snapshot untouched. Tables that do not depend on each other are
submitted to Spark concurrently.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import time
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce, wraps
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.operators.calendar import date_dimension
from stratamart.operators.checks import (
    ConstraintError,
    assert_measures,
    assert_unique,
    constraint_measures,
)
from stratamart.operators.conform import RAW_ROW, REASONS, REJECTED, active, sort_out
from stratamart.operators.keys import assign_surrogate_keys
from stratamart.operators.merge import (
    WAS_ACTIVE,
    change_measures,
    insert_absent,
    latest_per_key,
    merge_soft_delete,
    merge_upsert,
)
from stratamart.operators.star import fact_rows, shuffles_facts, unmatched_report
from stratamart.operators.summaries import (
    active_deleted_lines,
    active_deleted_measures,
    active_deleted_summary,
    fact_measures,
    fact_totals,
)
from stratamart.session import passing_shuffles, require_ansi, shuffles_for, timestamp_literal
from stratamart.sources.delimited import feed_files, folder_bytes, land, new_files, path_exists, read_feed
from stratamart.sources.shared_folder import delete_folder, fresh_folder, passing_folders
from stratamart.sources.warehouse import ROWS, Snapshot, Warehouse, empty_frame
from stratamart.specs import (
    AUDIT_CREATED,
    AUDIT_DELETED,
    AUDIT_UPDATED,
    LANDING,
    SERVICE,
    STAGING,
    TRANSFORMATION,
    CalendarSpec,
    DimensionSpec,
    EntitySpec,
    FactSpec,
    FeedSpec,
    WarehouseModel,
)

_CONCURRENT_TABLES = 8
# The highest surrogate key of a snapshot, kept with it so that no later load has to look for it.
_NEWEST = "newest key"
_MONEY = "decimal(38,3)"
# Measures that load summaries are made of; rows of a run that were staged, and those that were rejected.
_SUMMARY = "summary "
_STAGED, _REJECTED = _SUMMARY + "live", "rejected rows"


class LoadError(RuntimeError):
    """A job was asked to go on although an earlier layer failed."""


class Step(NamedTuple):
    """One line of a report: what was done, whether it worked, rows written, how long it took, what went wrong.

    ``began`` is when, on the clock that ``seconds`` is measured with.
    """

    step: str
    ok: bool
    rows: int
    seconds: float
    message: str
    began: float = 0.0


class Report(tuple):
    """The steps of a run in their order; reports are joined by ``+``."""

    __slots__ = ()

    def __add__(self, other: tuple) -> Report:
        return Report((*self, *other))

    @property
    def ok(self) -> bool:
        return not self.failures()

    def failures(self) -> dict[str, str]:
        """The message of every step that failed."""
        return {s.step: s.message for s in self if not s.ok}

    def to_df(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [s[:5] for s in self], "step string, ok boolean, rows bigint, seconds double, message string"
        )


class Unchanged(int):
    """The rows of a table that a step left as it was, because nothing it is made from has changed."""


#: The message of a step that had nothing to do.
UNCHANGED = "unchanged"


def _passing(step: Callable[..., int]) -> Callable[..., int]:
    """A step that leaves nothing on the disks but its table: neither shuffles nor what it stores on the way."""

    @wraps(step)
    def run(warehouse: Warehouse, *args, **kwargs) -> int:
        with passing_shuffles(warehouse.spark), passing_folders(warehouse.spark):
            return step(warehouse, *args, **kwargs)

    return run


def _timed(name: str, work: Callable[[], int]) -> Step:
    began, rows, problem = time.perf_counter(), 0, ""
    try:
        rows = work()
    except Exception as error:  # the report carries it; the other tables go on
        problem = f"{type(error).__name__}: {error}"
    message = problem or (UNCHANGED if isinstance(rows, Unchanged) else "")
    return Step(name, not problem, int(rows), time.perf_counter() - began, message, began)


def _run_steps(steps: Iterable[tuple[str, Callable[[], int]]]) -> Report:
    with ThreadPoolExecutor(_CONCURRENT_TABLES) as pool:
        return Report(pool.map(lambda step: _timed(*step), steps))


# -- what a version is made from ------------------------------------------------------------------


def _origin(run_ts: dt.datetime, spec: object, inputs: Mapping[str, object]) -> dict[str, object]:
    """The run, the rules and the state of every input; kept in the commit of what is made from them.

    The commits are the ledger of a run: a step is done when the current version of its table has this
    origin. An input's state is the checksum of its rows, measured when these were written.
    """
    rules = hashlib.sha256(repr(spec).encode()).hexdigest()
    return {"run": run_ts.isoformat(), "rules": rules, "inputs": {k: str(v) for k, v in sorted(inputs.items())}}


def _checksums(warehouse: Warehouse, tables: Iterable[tuple[str, str]]) -> dict[str, str]:
    return {f"{layer}.{table}": warehouse.current(layer, table).checksum for layer, table in tables}


def _done(warehouse: Warehouse, layer: str, table: str, origin: Mapping[str, object]) -> Unchanged | None:
    """The rows of the table if its current version has this origin."""
    if warehouse.exists(layer, table):
        current = warehouse.current(layer, table)
        if current.made_from == origin:
            return Unchanged(current.all_rows)
    return None


# -- creation -----------------------------------------------------------------------------------


@_passing
def load_calendar(warehouse: Warehouse, spec: CalendarSpec, run_ts: dt.datetime) -> int:
    """Add the days of the spec's range that the calendar lacks; existing days keep their keys."""
    days = date_dimension(warehouse.spark, spec.start, spec.end)
    run = timestamp_literal(run_ts)
    audit = {AUDIT_CREATED: run, AUDIT_UPDATED: run}
    if warehouse.exists(SERVICE, spec.table):
        present = warehouse.read(SERVICE, spec.table)
        newest = present.agg(F.coalesce(F.max(spec.surrogate), F.lit(0))).first()[0]
        missing = days.join(present.select("fecha"), on="fecha", how="left_anti")
        added = assign_surrogate_keys(missing, ["fecha"], newest, spec.surrogate)
        rows = insert_absent(present, added.withColumns(audit), ["fecha"])
    else:
        numbered = assign_surrogate_keys(days, ["fecha"], 0, spec.surrogate)
        rows = numbered.select(spec.surrogate, *days.columns).withColumns(audit)
    snapshot = warehouse.write(SERVICE, spec.table, rows)
    assert_unique(warehouse.read_snapshot(snapshot), ["fecha"], spec.table)
    warehouse.publish(snapshot)
    return snapshot.metrics["rows"]


def create_tables(
    warehouse: Warehouse, model: WarehouseModel, run_ts: dt.datetime, missing_only: bool = False
) -> Report:
    """Every table empty, and the calendar filled. With ``missing_only`` tables that exist stay as they are."""

    def made(layer, table, schema):
        def work():
            if missing_only and warehouse.exists(layer, table):
                return Unchanged(warehouse.count(layer, table))
            warehouse.create(layer, table, schema)
            return 0

        return f"create {layer}.{table}", work

    steps = [made(LANDING, f.table, f.landed_schema()) for f in model.feeds]
    steps += [made(STAGING, e.table, e.schema()) for e in model.entities]
    steps += [made(SERVICE, d.table, d.schema()) for d in model.dimensions]
    steps += [made(SERVICE, f.table, f.schema()) for f in model.facts]
    report = _run_steps(steps)
    if model.calendar is not None:
        calendar = model.calendar
        report += _run_steps([(f"fill {calendar.table}", lambda: load_calendar(warehouse, calendar, run_ts))])
    return report


# -- landing ------------------------------------------------------------------------------------


def land_feed(
    warehouse: Warehouse, feed: FeedSpec, path: str, run_ts: dt.datetime, truncate: bool = True, resume: bool = False
) -> int:
    """Land the files at a path; returns the rows written.

    Without ``truncate`` only files that the table does not hold yet are added, so a repeat adds nothing.
    With ``resume`` a table that this run made of the same files is left as it is.
    """
    files = feed_files(warehouse.spark, path)
    if not files:
        raise FileNotFoundError(path)
    origin = _origin(run_ts, feed, {"files": hashlib.sha256(json.dumps(files).encode()).hexdigest()})
    if truncate:
        done = _done(warehouse, LANDING, feed.table, origin) if resume else None
        if done is not None:
            return done
        read = path
    else:
        files = new_files(warehouse, feed.table, files)
        if not files:
            return Unchanged(warehouse.count(LANDING, feed.table))
        read = [f for f, _, _ in files]
    rows = read_feed(warehouse.spark, read, feed)
    return land(warehouse, rows, feed.table, run_ts, truncate, files, origin).metrics[ROWS]


def run_landing(
    warehouse: Warehouse,
    feeds: Iterable[FeedSpec],
    folder: str,
    run_ts: dt.datetime,
    truncate: bool = True,
    resume: bool = False,
) -> Report:
    """Load each feed found in ``folder``. A missing or malformed one fails, the others go on."""

    def loading(feed: FeedSpec):
        path = f"{folder.rstrip('/')}/{feed.file}"
        return f"land {feed.file}", lambda: land_feed(warehouse, feed, path, run_ts, truncate, resume)

    return _run_steps([loading(feed) for feed in feeds])


# -- staging ------------------------------------------------------------------------------------


def _target(
    warehouse: Warehouse, layer: str, spec: EntitySpec | DimensionSpec | FactSpec
) -> tuple[Snapshot | None, DataFrame]:
    """The snapshot to merge into and its rows; none of either before the first load."""
    if not warehouse.exists(layer, spec.table):
        return None, empty_frame(warehouse.spark, spec.schema())
    current = warehouse.current(layer, spec.table)
    return current, warehouse.read_snapshot(current)


def _assert_deletions(measured: Mapping[str, int], max_fraction: float, what: str) -> None:
    before, deleted = measured["active before"], measured["deleted now"]
    if before and deleted > max_fraction * before:
        raise ConstraintError(f"{what}: would soft-delete {deleted} of {before} active rows")


def sort_out_landed(warehouse: Warehouse, spec: EntitySpec) -> Snapshot:
    """Write the landed rows once more, the typed ones apart from the rejected ones, and publish that.

    It is one pass without a shuffle, and everything after it reads converted columns.
    """
    landed = warehouse.current(LANDING, spec.source)
    split = warehouse.write(
        TRANSFORMATION,
        spec.table,
        sort_out(warehouse.read_snapshot(landed), spec),
        measure={_REJECTED: F.count_if(F.col(REJECTED))},
        partition_by=(REJECTED,),
    )
    if split.metrics["rows"] != landed.all_rows:
        raise ConstraintError(f"{spec.source}: {landed.all_rows} rows landed, {split.metrics['rows']} sorted out")
    warehouse.publish(split)
    return split


def _assert_complete(spec: EntitySpec, split: Snapshot, staged: Snapshot, deduped: bool) -> None:
    """What landed is staged or rejected; only where repeated keys are resolved may there be less."""
    accounted = staged.metrics[_STAGED] + split.metrics[_REJECTED]
    if accounted > split.metrics["rows"] or not deduped and accounted != split.metrics["rows"]:
        raise ConstraintError(f"{spec.table}: {accounted} of {split.metrics['rows']} landed rows are staged or rejected")


@_passing
def stage_entity(
    warehouse: Warehouse,
    spec: EntitySpec,
    run_ts: dt.datetime,
    max_delete_fraction: float | None = None,
    dedupe: tuple[str, ...] | None = None,
    resume: bool = False,
) -> int:
    """Conform, merge into the staging snapshot, check what was written, publish.

    Returns the rows in the new snapshot. With ``resume`` a table that this run has already merged from the
    same landed rows is left as it is. ``dedupe`` names the columns that decide which of several
    rows with one key to keep; without it such a source is refused. Rows without a usable key are kept
    in the transformation layer with their reasons, see ``rejected_rows``.
    """
    origin = _origin(run_ts, (spec, dedupe), _checksums(warehouse, [(LANDING, spec.source)]))
    done = _done(warehouse, STAGING, spec.table, origin) if resume else None
    if done is not None:
        return done
    split = sort_out_landed(warehouse, spec)
    source = warehouse.read_snapshot(split).where(~F.col(REJECTED)).select(*[r.name for r in spec.columns])
    # A key that a source repeats is repeated by the merge. In buckets that shows without a shuffle.
    bucketed = bool(warehouse.buckets.get(spec.table))
    if dedupe is not None:
        source = latest_per_key(source, spec.keys, dedupe)
    elif not bucketed:
        assert_unique(source, spec.keys, spec.source)
    current, target = _target(warehouse, STAGING, spec)
    merged = merge_soft_delete(target, source, spec.keys, spec.attributes, run_ts, mark=True)
    lengths = {r.name: r.max_length for r in spec.columns if r.max_length}
    constraints = constraint_measures(spec.schema(), lengths, spec.keys)
    summary = {_SUMMARY + name: c for name, c in active_deleted_measures(spec.amount).items()}
    snapshot = warehouse.write(
        STAGING,
        spec.table,
        merged,
        spec.keys,
        merged_from=current,
        measure=constraints | change_measures() | summary,
        measured_only=(WAS_ACTIVE,),
        made_from=origin,
    )
    assert_measures(snapshot.metrics, constraints, spec.table)
    if bucketed and dedupe is None:
        assert_unique(warehouse.read_snapshot(snapshot), spec.keys, spec.source)
    _assert_complete(spec, split, snapshot, dedupe is not None)
    if max_delete_fraction is not None:
        _assert_deletions(snapshot.metrics, max_delete_fraction, spec.table)
    warehouse.publish(snapshot)
    return snapshot.metrics["rows"]


def rejected_rows(warehouse: Warehouse, spec: EntitySpec) -> DataFrame:
    """The raw rows that the last run could not load, with the reasons; no other file is opened."""
    split = warehouse.read(TRANSFORMATION, spec.table).where(F.col(REJECTED))
    return split.select(f"{RAW_ROW}.*", REASONS)


def reject_report(warehouse: Warehouse, entities: Iterable[EntitySpec]) -> DataFrame:
    """(tabla, motivo, cantidad): rejected rows of the last run by reason; a row counts for each of its reasons."""
    counts = [
        warehouse.read(TRANSFORMATION, spec.table)
        .where(F.col(REJECTED))
        .select(F.lit(spec.table).alias("tabla"), F.explode(REASONS).alias("motivo"))
        for spec in entities
    ]
    return reduce(DataFrame.unionByName, counts).groupBy("tabla", "motivo").agg(F.count(F.lit(1)).alias("cantidad"))


def load_balance(warehouse: Warehouse, entities: Iterable[EntitySpec]) -> DataFrame:
    """(tabla, recibidas, cargadas, rechazadas): rows landed, staged and rejected, as counted when they were written."""
    rows = []
    for spec in entities:
        split, staged = warehouse.current(TRANSFORMATION, spec.table), warehouse.current(STAGING, spec.table)
        landed = warehouse.count(LANDING, spec.source)
        rows.append((spec.table, landed, staged.metrics[_STAGED], split.metrics[_REJECTED]))
    return warehouse.spark.createDataFrame(rows, "tabla string, recibidas bigint, cargadas bigint, rechazadas bigint")


def run_staging(
    warehouse: Warehouse,
    entities: Iterable[EntitySpec],
    run_ts: dt.datetime,
    max_delete_fraction: float | None = None,
    dedupe: Mapping[str, tuple[str, ...]] | None = None,
    resume: bool = False,
) -> Report:
    """Merge every entity; a failing one does not stop the others.

    ``dedupe`` maps entity names to the columns that decide between rows with the same key.
    """
    require_ansi(warehouse.spark)

    def merging(spec: EntitySpec):
        order = (dedupe or {}).get(spec.name)
        return (
            f"merge {spec.table}",
            lambda: stage_entity(warehouse, spec, run_ts, max_delete_fraction, order, resume),
        )

    return _run_steps([merging(spec) for spec in entities])


def _from_commit(
    snapshot: Snapshot, spark: SparkSession, measures: Mapping[str, tuple[str, Callable]]
) -> DataFrame | None:
    """One row of measures (name: type and how those of several folders combine) taken from the commit alone.

    None if the version was written without them.
    """
    if not snapshot.folders or not all(_SUMMARY + n in snapshot.measured[f] for f in snapshot.folders for n in measures):
        return None
    row = [snapshot.over_folders(_SUMMARY + name, combine) for name, (_, combine) in measures.items()]
    return spark.createDataFrame([tuple(row)], ", ".join(f"{name} {kind}" for name, (kind, _) in measures.items()))


def staging_summary(warehouse: Warehouse, spec: EntitySpec) -> DataFrame:
    """Active and deleted rows of one staging table, with its amount where it has one.

    They are in the commit of a version that a merge wrote, so nothing is scanned.
    """
    if spec.labels is None:
        raise LookupError(f"{spec.name} has no load summary")
    snapshot = warehouse.current(STAGING, spec.table)
    counted = {"live": ("bigint", sum), "dead": ("bigint", sum)}
    measured = _from_commit(snapshot, warehouse.spark, counted | ({"total": (_MONEY, sum)} if spec.amount else {}))
    if measured is None:
        return active_deleted_summary(warehouse.read_snapshot(snapshot), spec.labels, spec.amount)
    return active_deleted_lines(measured, spec.labels)


# -- service ------------------------------------------------------------------------------------


def _upsert_and_publish(
    warehouse: Warehouse,
    spec: DimensionSpec | FactSpec,
    source: DataFrame,
    keys: tuple[str, ...],
    columns: list[str],
    lengths: Mapping[str, int],
    run_ts: dt.datetime,
    origin: Mapping[str, object],
) -> int:
    current, target = _target(warehouse, SERVICE, spec)
    newest = current.metrics.get(_NEWEST) if current and current.folders else 0
    merged = merge_upsert(target, source, keys, columns, run_ts, spec.surrogate, newest)
    constraints = constraint_measures(spec.schema(), lengths, keys)
    measures = constraints | {_NEWEST: F.coalesce(F.max(spec.surrogate), F.lit(0))}
    if isinstance(spec, FactSpec) and spec.total:
        measures |= {_SUMMARY + name: c for name, c in fact_measures(spec).items()}
    snapshot = warehouse.write(
        SERVICE, spec.table, merged, keys, merged_from=current, measure=measures, made_from=origin
    )
    assert_measures(snapshot.metrics, constraints, spec.table)
    assert_unique(warehouse.read_snapshot(snapshot), keys, spec.table)
    warehouse.publish(snapshot)
    return snapshot.metrics["rows"]


@_passing
def load_dimension(
    warehouse: Warehouse, spec: DimensionSpec, run_ts: dt.datetime, resume: bool = False
) -> int:
    """Upsert the active staging rows. Returns the rows in the new snapshot."""
    origin = _origin(run_ts, spec, _checksums(warehouse, [(STAGING, spec.source)]))
    done = _done(warehouse, SERVICE, spec.table, origin) if resume else None
    if done is not None:
        return done
    source = active(warehouse.read(STAGING, spec.source)).select(
        *spec.keys, *[F.col(c).alias(name) for name, c in spec.attributes.items()]
    )
    return _upsert_and_publish(
        warehouse, spec, source, spec.keys, list(spec.attributes), spec.lengths, run_ts, origin
    )


def _dimensions_of(warehouse: Warehouse, spec: FactSpec) -> dict[str, DataFrame]:
    """The dimensions of a fact; their buckets are for their own merges and not for the facts to fit in."""
    names = {lookup.dimension for lookup in spec.lookups}
    return {name: warehouse.read(SERVICE, name, bucketed=False) for name in names}


@contextmanager
def _stored(warehouse: Warehouse, rows: DataFrame, spec: FactSpec) -> Iterator[DataFrame]:
    """Rows written once to the shared folder, bucketed like the table they are for; deleted at the end."""
    scratch = Warehouse(warehouse.spark, fresh_folder(warehouse.spark, "resolved"), warehouse.buckets)
    snapshot = scratch.write(SERVICE, spec.table, rows, (spec.key,))
    try:
        yield scratch.read_snapshot(snapshot)
    finally:
        scratch.drop(SERVICE, spec.table)


@_passing
def load_fact(
    warehouse: Warehouse,
    spec: FactSpec,
    run_ts: dt.datetime,
    max_broadcast: int | None = None,
    resume: bool = False,
) -> int:
    """Resolve the active staging rows against the dimensions and upsert them.

    Where a dimension is too large to be broadcast (more than ``max_broadcast`` bytes; by default Spark's
    own limit) the facts move for it, one lookup after the other. They are then stored once, by their key, as
    the merge reads its source twice.
    """
    inputs = [(STAGING, spec.source), *[(SERVICE, name) for name in sorted({lk.dimension for lk in spec.lookups})]]
    origin = _origin(run_ts, spec, _checksums(warehouse, inputs))
    done = _done(warehouse, SERVICE, spec.table, origin) if resume else None
    if done is not None:
        return done
    staged = active(warehouse.read(STAGING, spec.source))
    dims = _dimensions_of(warehouse, spec)
    source = fact_rows(staged, dims, spec, max_broadcast, in_turn=True)
    if not shuffles_facts(dims, spec.lookups, max_broadcast):
        return _upsert_and_publish(warehouse, spec, source, (spec.key,), spec.columns, {}, run_ts, origin)
    with _stored(warehouse, source, spec) as resolved:
        return _upsert_and_publish(warehouse, spec, resolved, (spec.key,), spec.columns, {}, run_ts, origin)


def run_service(
    warehouse: Warehouse,
    dimensions: Iterable[DimensionSpec],
    facts: Iterable[FactSpec],
    run_ts: dt.datetime,
    resume: bool = False,
) -> Report:
    """All dimensions, then all facts; a failing table does not stop the others."""
    require_ansi(warehouse.spark)

    def loading(spec, load):
        return f"merge {spec.table}", lambda: load(warehouse, spec, run_ts, resume=resume)

    report = _run_steps([loading(d, load_dimension) for d in dimensions])
    return report + _run_steps([loading(f, load_fact) for f in facts])


def service_summary(warehouse: Warehouse, spec: DimensionSpec | FactSpec, calendar=None) -> DataFrame:
    """Size of a dimension, or rows and total of a fact. Only the real days that ``calendar`` adds need a scan."""
    snapshot, spark = warehouse.current(SERVICE, spec.table), warehouse.spark
    if isinstance(spec, DimensionSpec):
        return spark.createDataFrame([(spec.table, snapshot.all_rows)], "dimension string, total_registros bigint")
    measured = None
    if calendar is None:
        keys = {"first": ("bigint", min), "last": ("bigint", max)} if spec.date_range else {}
        measured = _from_commit(snapshot, spark, {"total": (_MONEY, sum)} | keys)
    if measured is None:
        return fact_totals(warehouse.read_snapshot(snapshot), spec, calendar)
    columns = [F.lit(spec.table).alias("tabla"), F.lit(snapshot.all_rows).cast("bigint").alias("total_registros")]
    columns.append(F.col("total").alias(spec.total_label))
    if spec.date_range:
        columns += [F.col("first").alias("fecha_min"), F.col("last").alias("fecha_max")]
    return measured.select(*columns)


def unmatched_facts(warehouse: Warehouse, spec: FactSpec) -> DataFrame:
    """Active staging rows that each lookup of a fact cannot resolve."""
    staged = active(warehouse.read(STAGING, spec.source))
    return unmatched_report(staged, _dimensions_of(warehouse, spec), spec.lookups, spec.key)


# -- everything ---------------------------------------------------------------------------------


def run_warehouse(
    warehouse: Warehouse,
    model: WarehouseModel,
    folder: str | None,
    run_ts: dt.datetime,
    create_schema: bool = False,
    create: bool = False,
    only_init: bool = False,
    max_delete_fraction: float | None = None,
    dedupe: Mapping[str, tuple[str, ...]] | None = None,
    landed: Mapping[str, DataFrame] | None = None,
    keep_versions: int | None = None,
    resume: bool = False,
    consume: bool = False,
) -> Report:
    """Optionally reset and create, then land, stage and serve. Stops after the first failed layer.

    ``resume`` repeats a run that failed, given the same ``run_ts``: steps that it has done are left out if
    what they are made from is unchanged, so only failed ones and those after them are done again.

    ``landed`` gives raw rows by landing table instead of feed files. With ``keep_versions`` a run that
    worked deletes all but that many versions of every table; whoever reads older ones loses them. Without
    it all versions are kept. ``consume`` deletes the feed folder as soon as every feed is landed; such a run
    cannot be resumed.
    """
    if resume and create_schema:
        raise ValueError("a run that resets the layers has nothing to resume")
    if consume and (folder is None or resume):
        raise ValueError("only a run that lands a folder of feeds, and is not resumed, can consume it")
    size = 0
    if folder is not None and path_exists(warehouse.spark, folder):
        size = folder_bytes(warehouse.spark, folder)
    with shuffles_for(warehouse.spark, size):
        report = _run_layers(
            warehouse, model, folder, run_ts, create_schema, create, only_init, max_delete_fraction, dedupe, landed, resume, consume
        )
    if report.ok and keep_versions is not None:
        report += _run_steps(
            [
                (f"keep {layer}.{table}", lambda layer=layer, table=table: warehouse.vacuum(layer, table, keep_versions) or 0)
                for layer in warehouse.layers()
                for table in warehouse.tables(layer)
            ]
        )
    return report


def _run_layers(
    warehouse: Warehouse,
    model: WarehouseModel,
    folder: str | None,
    run_ts: dt.datetime,
    create_schema: bool,
    create: bool,
    only_init: bool,
    max_delete_fraction: float | None,
    dedupe: Mapping[str, tuple[str, ...]] | None,
    landed: Mapping[str, DataFrame] | None,
    resume: bool,
    consume: bool,
) -> Report:
    report = Report()
    if create_schema:

        def dropped():
            warehouse.reset()
            return 0

        report += _run_steps([("reset layers", dropped)])
    if create and report.ok:
        report += create_tables(warehouse, model, run_ts, missing_only=resume)
    if only_init or not report.ok:
        return report

    if landed is None:
        if folder is None:
            raise LoadError("neither a feed folder nor landed rows given")
        report += run_landing(warehouse, model.feeds, folder, run_ts, resume=resume)
    else:

        def landing(table: str, rows: DataFrame):
            def work():
                return land(warehouse, rows, table, run_ts).metrics["rows"]

            return f"land {table}", work

        report += _run_steps([landing(t, df) for t, df in landed.items()])
    if not report.ok:
        return report
    if consume:
        delete_folder(warehouse.spark, folder)
    report += run_staging(warehouse, model.entities, run_ts, max_delete_fraction, dedupe, resume)
    if not report.ok:
        return report
    return report + run_service(warehouse, model.dimensions, model.facts, run_ts, resume)
