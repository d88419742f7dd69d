"""Warehouses loaded from the driver's tables."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from stratamart.plans.jobs import LoadError, Report, run_warehouse
from stratamart.plans.queries.registry import table
from stratamart.plans.queries.roles import MODEL, RUN, T0, raw
from stratamart.session import passing_shuffles
from stratamart.sources import Warehouse, bucket_count_for
from stratamart.sources.shared_folder import fresh_folder
from stratamart.specs import SERVICE, STAGING, FeedSpec, WarehouseModel

# Tables large enough to be worth co-partitioning, and the table that tells how large each is.
_BUCKETED = {
    "stg_ventas": "orders",
    "fact_ventas": "orders",
    "stg_compras": "lineitem",
    "fact_compras": "lineitem",
    "stg_clientes": "customer",
    "dim_cliente": "customer",
}
# Every second feed uses semicolons where its spec leaves the delimiter to be sniffed.
_DELIMITERS = (",", ";")

_loads: dict[tuple[str, str, str], tuple[Warehouse, Report]] = {}


def new_warehouse(spark: SparkSession, sf: str) -> Warehouse:
    """A warehouse in a new folder below the shared one, bucketed for the size of the data."""
    counts = {name: bucket_count_for(table(spark, sf, name)) for name in set(_BUCKETED.values())}
    buckets = {name: counts[source] for name, source in _BUCKETED.items()}
    return Warehouse(spark, fresh_folder(spark, "warehouse"), buckets)


def write_feed(df: DataFrame, folder: str, delimiter: str = ";", mode: str = "errorifexists", **options: str) -> None:
    """Rows as delimited files with a header: text quoted where needed, quoted empties kept apart from NULL."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .options(**options)
        .csv(folder)
    )


def write_feed_of(spark: SparkSession, sf: str, place: int, feed: FeedSpec, folder: str, rows: DataFrame | None = None) -> None:
    """One of the model's feeds below a folder, replacing what is there."""
    delimiter = feed.delimiter or _DELIMITERS[place % 2]
    rows = raw(spark, sf, feed.table) if rows is None else rows
    write_feed(rows, f"{folder}/{feed.file}", delimiter, mode="overwrite", encoding=feed.encoding)


def write_feeds(
    spark: SparkSession, sf: str, changed: Mapping[str, DataFrame | None] | None = None, model: WarehouseModel = MODEL
) -> str:
    """A model's feeds as files below a new folder. ``changed`` replaces rows by landing table; None leaves a feed out."""
    folder, rows = fresh_folder(spark, "feeds"), {f.table: raw(spark, sf, f.table) for f in model.feeds} | dict(changed or {})

    def written(place: int, feed: FeedSpec) -> None:
        if rows[feed.table] is not None:
            write_feed_of(spark, sf, place, feed, folder, rows[feed.table])

    with passing_shuffles(spark), ThreadPoolExecutor(len(_DELIMITERS) * 4) as pool:
        list(pool.map(written, range(len(model.feeds)), model.feeds))
    return folder


def _require(report: Report) -> Report:
    if not report.ok:
        raise LoadError("; ".join(f"{step}: {message}" for step, message in report.failures().items()))
    return report


def load(spark: SparkSession, sf: str, model: WarehouseModel = MODEL) -> tuple[Warehouse, Report]:
    """A complete first load from feed files into a new warehouse."""
    warehouse = new_warehouse(spark, sf)
    folder = write_feeds(spark, sf, model=model)
    return warehouse, _require(run_warehouse(warehouse, model, folder, T0, create_schema=True, create=True, consume=True))


def load_twice(spark: SparkSession, sf: str) -> tuple[Warehouse, Report]:
    """A first load, then one in which the sales of channel 2 are no longer delivered."""
    warehouse, _ = load(spark, sf)
    folder = write_feeds(spark, sf, {"raw_ventas": raw(spark, sf, "raw_ventas").where("idcanal <> '2'")})
    return warehouse, _require(run_warehouse(warehouse, MODEL, folder, RUN, keep_versions=2, consume=True))


def _once(spark, sf, what, loader):
    key = (spark.sparkContext.applicationId, sf, what)
    if key not in _loads:
        _loads[key] = loader(spark, sf)
    return _loads[key]


def loaded(spark: SparkSession, sf: str) -> tuple[Warehouse, Report]:
    """The first load, shared by the queries that report on a warehouse which is already there."""
    return _once(spark, sf, "first", load)


def loaded_twice(spark: SparkSession, sf: str) -> tuple[Warehouse, Report]:
    return _once(spark, sf, "second", load_twice)


def staged(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return loaded(spark, sf)[0].read(STAGING, name)


def served(spark: SparkSession, sf: str, *tables: str) -> dict[str, DataFrame]:
    warehouse = loaded(spark, sf)[0]
    return {name: warehouse.read(SERVICE, name) for name in tables}


def loaded_part(spark: SparkSession, sf: str, source: str, *dimensions: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """A staging table and the dimensions its rows are looked up in, from a load of what these are made from.

    Each caller loads its own, so its time does not hang on what ran before it, nor on feeds it does not read.
    """
    warehouse, _ = load(spark, sf, MODEL.part({source, *dimensions}))
    return warehouse.read(STAGING, source), {name: warehouse.read(SERVICE, name, bucketed=False) for name in dimensions}
