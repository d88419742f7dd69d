"""Load summaries: what a table holds after a merge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.sources.shared_folder import fresh_folder
from stratamart.specs import AUDIT_DELETED, FactSpec, SummaryLabels

_MONEY = "decimal(38,3)"


def active_deleted_measures(amount: str | None = None, money: str = _MONEY) -> dict[str, Column]:
    """What a load summary is made of: active and deleted rows and the amount of the active ones.

    All are sums, so those of parts of a table can be added up.
    """
    gone = F.col(AUDIT_DELETED)
    measures = {"live": F.count_if(~gone), "dead": F.count_if(gone)}
    if amount:
        measures["total"] = F.sum(F.when(~gone, F.expr(amount))).cast(money)
    return measures


def active_deleted_lines(measured: DataFrame, labels: SummaryLabels, money: str = _MONEY) -> DataFrame:
    """The one row of ``active_deleted_measures`` as two lines."""
    live = [F.lit(labels.active).alias("descripcion"), F.col("live").alias("cantidad")]
    dead = [F.lit(labels.deleted).alias("descripcion"), F.col("dead").alias("cantidad")]
    if "total" in measured.columns:
        live.append(F.col("total").cast(money).alias("monto_total"))
        dead.append(F.lit(0).cast(money).alias("monto_total"))
    return measured.select(F.inline(F.array(F.struct(*live), F.struct(*dead)))).orderBy(F.desc("descripcion"))


def active_deleted_summary(
    df: DataFrame, labels: SummaryLabels, amount: str | None = None, money: str = _MONEY
) -> DataFrame:
    """One row for the active and one for the soft-deleted rows, also when there are none.

    With ``amount`` the active row also has its sum and the deleted row a constant 0.
    """
    measures = active_deleted_measures(amount, money)
    return active_deleted_lines(df.agg(*[c.alias(n) for n, c in measures.items()]), labels, money)


def dimension_size(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_registros")).select(
        F.lit(name).alias("dimension"), "total_registros"
    )


def fact_measures(spec: FactSpec) -> dict[str, Column]:
    """What the totals of a fact are made of besides its rows: a sum, a least and a greatest key."""
    measures = {"total": F.sum(spec.total).cast(_MONEY)}
    if spec.date_range:
        measures |= {"first": F.min(spec.date_range), "last": F.max(spec.date_range)}
    return measures


def fact_totals(fact: DataFrame, spec: FactSpec, calendar: DataFrame | None = None) -> DataFrame:
    """Rows, total amount and, if the spec has a date role, its first and last calendar key.

    ``fecha_min`` and ``fecha_max`` are surrogate keys. With ``calendar`` the real first and last
    day follow: the fact is then summed per day before it meets the calendar, in the same pass.
    """
    total = F.sum(spec.total)
    columns = [F.count(F.lit(1)).alias("total_registros"), total.cast(_MONEY).alias(spec.total_label)]
    if spec.date_range:
        columns += [F.min(spec.date_range).alias("fecha_min"), F.max(spec.date_range).alias("fecha_max")]
    if spec.date_range and calendar is not None:
        day = F.col(spec.date_range)
        per_day = fact.groupBy(day.alias("sk_tiempo")).agg(
            F.count(F.lit(1)).alias("__rows"), total.alias("__total")
        )
        fact = per_day.join(calendar.select("sk_tiempo", "fecha"), on="sk_tiempo", how="left")
        columns = [
            F.coalesce(F.sum("__rows"), F.lit(0)).alias("total_registros"),
            F.sum("__total").cast(_MONEY).alias(spec.total_label),
            F.min("sk_tiempo").alias("fecha_min"),
            F.max("sk_tiempo").alias("fecha_max"),
            F.min("fecha").alias("primer_dia"),
            F.max("fecha").alias("ultimo_dia"),
        ]
    return fact.agg(*columns).select(F.lit(spec.table).alias("tabla"), "*")


def calendar_coverage(calendar: DataFrame) -> DataFrame:
    return calendar.agg(
        F.min("fecha").alias("fecha_min"),
        F.max("fecha").alias("fecha_max"),
        F.count(F.lit(1)).alias("total_dias"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tabla, registros) for a list of tables."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("registros")).select(F.lit(name).alias("tabla"), "registros")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def find_duplicates(df: DataFrame, keys: Sequence[str], listed: str, list_name: str) -> DataFrame:
    """Keys on more than one row, their row count and their distinct ``listed`` values in order.

    Rows are counted per key, which combines before the shuffle; the keys that occur more than once are
    stored, and only their rows are looked at again. Their values are sorted by key and value over all
    tasks, so the values of one giant key are sorted in several of them; each makes one run of text, and
    only these runs meet. NULL values are not listed; where all are NULL the list is NULL. A NULL key is a key.
    """
    spark = df.sparkSession
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cantidad")).where(F.col("cantidad") > 1)
    folder = fresh_folder(spark, "repeated-keys")
    sizes.write.parquet(folder)
    sizes = spark.read.schema(sizes.schema).parquet(folder)  # its size is known now: few keys are broadcast
    renamed = [F.col(k).alias(f"__{i}") for i, k in enumerate(keys)]
    same = reduce(and_, [F.col(f"__{i}").eqNullSafe(F.col(k)) for i, k in enumerate(keys)])
    repeated = df.select(*keys, listed).where(F.col(listed).isNotNull()).join(sizes.select(*renamed), same, "left_semi")
    sorted_over_tasks = repeated.distinct().repartitionByRange(*keys, listed).withColumn("__run", F.spark_partition_id())
    runs = sorted_over_tasks.groupBy(*keys, "__run").agg(
        F.array_join(F.array_sort(F.collect_list(listed)), ", ").alias("__text")
    )
    texts = F.array_sort(F.collect_list(F.struct("__run", "__text")))
    lists = runs.groupBy(*renamed).agg(F.array_join(F.transform(texts, lambda r: r["__text"]), ", ").alias(list_name))
    return sizes.join(lists, same, "left").select(*keys, "cantidad", list_name).orderBy(F.desc("cantidad"), *keys)


def latest_deleted(df: DataFrame, keys: Sequence[str], columns: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` most recently soft-deleted rows."""
    return (
        df.where(F.col(AUDIT_DELETED))
        .select(*keys, *columns, "is_deleted", "deleted_at", "updated_at")
        .orderBy(F.desc("deleted_at"), *keys)
        .limit(n)
    )
