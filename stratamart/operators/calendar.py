"""The calendar dimension: one row per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SUNDAY, _SATURDAY = 1, 7


def _days(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    day = F.col("fecha")
    return bounds.select(
        F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("fecha")
    ).select(
        day,
        F.year(day).alias("anio"),
        F.month(day).alias("mes"),
        F.dayofmonth(day).alias("dia"),
        F.quarter(day).alias("trimestre"),
        F.weekofyear(day).alias("semana"),  # ISO week
        F.date_format(day, "EEEE").alias("dia_nombre"),  # English names
        F.date_format(day, "MMMM").alias("mes_nombre"),
        F.dayofweek(day).isin(_SUNDAY, _SATURDAY).alias("es_fin_semana"),
    )


def date_dimension(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The days from ``start`` to ``end``, both included (ISO dates)."""
    return _days(spark.range(1), F.lit(start).cast("date"), F.lit(end).cast("date"))


def date_dimension_for(rows: DataFrame, first: Column, last: Column) -> DataFrame:
    """The days from the earliest ``first`` to the latest ``last`` found in ``rows``."""
    bounds = rows.agg(F.min(first).alias("start"), F.max(last).alias("end")).where("start IS NOT NULL")
    return _days(bounds, F.col("start"), F.col("end"))
