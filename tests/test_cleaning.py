"""Cleaning rules on single values."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratamart import functions as fn
from stratamart.operators import conform, rejected
from stratamart.session import timestamp_literal
from stratamart.specs import EntitySpec, date, decimal, integer, text


@pytest.fixture
def apply(spark):
    def applied(value, rule):
        df = spark.createDataFrame([(value,)], "v string")
        return df.select(rule(F.col("v"))).first()[0]

    return applied


@pytest.mark.parametrize(
    ("value", "cleaned"),
    [("  Ana ", "Ana"), ("   ", ""), ("", ""), (None, "Sin Dato"), ("\tx ", "\tx")],
)
def test_text_is_trimmed_and_only_null_gets_the_default(apply, value, cleaned):
    assert apply(value, lambda c: fn.with_default(fn.clean_text(c), "Sin Dato")) == cleaned


@pytest.mark.parametrize(("value", "cleaned"), [(" ", None), ("", None), (None, None), (" a ", "a")])
def test_blank_to_null(apply, value, cleaned):
    assert apply(value, fn.blank_to_null) == cleaned


@pytest.mark.parametrize("value", ["12", " 12 ", "007", "0"])
def test_usable_keys(apply, value):
    assert apply(value, fn.valid_key) is True


@pytest.mark.parametrize("value", ["", " ", "-1", "1.0", "a1", "12\n", "1 2", "+3", "１"])
def test_unusable_keys(apply, value):
    assert apply(value, fn.valid_key) is False
    assert apply(None, fn.valid_key) is None


@pytest.mark.parametrize(
    ("value", "precision", "scale", "number"),
    [
        ("-34,5678060", 13, 10, "-34.5678060000"),
        ("1.2345", 15, 3, "1.235"),
        ("-1.2345", 15, 3, "-1.235"),
        (" 7 ", 15, 3, "7.000"),
        ("1,5", 15, 2, "1.50"),
    ],
)
def test_decimals(apply, value, precision, scale, number):
    assert apply(value, lambda c: fn.to_decimal(c, precision, scale)) == Decimal(number)


def test_blank_numbers_are_null(apply):
    assert apply("  ", lambda c: fn.to_decimal(c, 15, 3)) is None
    assert apply("  ", fn.to_int) is None
    assert apply("", fn.to_date_iso) is None


def test_default_keeps_the_column_type(spark):
    df = spark.createDataFrame([(None,)], "v string")
    c = fn.with_default(fn.to_decimal(F.col("v"), 13, 10), 0, "decimal(13,10)")
    assert df.select(c.alias("c")).schema["c"].dataType.simpleString() == "decimal(13,10)"


@pytest.mark.parametrize(
    ("value", "rule"),
    [
        ("1234.5", lambda c: fn.to_decimal(c, 13, 10)),
        ("abc", lambda c: fn.to_decimal(c, 15, 3)),
        ("2,5", lambda c: fn.to_int(c, decimal_comma=True)),
        ("2,0", lambda c: fn.to_int(c, decimal_comma=True)),
        ("2.5", fn.to_int),
        ("99999999999", fn.to_int),
        ("09/03/2018", fn.to_date_iso),
        ("2018", fn.to_date_iso),
        ("2018-03", fn.to_date_iso),
        ("2018-02-30", fn.to_date_iso),
        ("03-09-2018", lambda c: fn.to_date_iso(c, ["dd/MM/yyyy"])),
    ],
)
def test_bad_values_raise(apply, value, rule):
    with pytest.raises(PySparkException):
        apply(value, rule)


@pytest.mark.parametrize(
    ("value", "formats"),
    [
        ("2018-03-09", ()),
        (" 2018-3-9 ", ()),
        ("2018-03-09 10:11:12", ()),
        ("09/03/2018", ("dd/MM/yyyy",)),
        ("20180309", ("dd/MM/yyyy", "yyyyMMdd")),
    ],
)
def test_dates(apply, value, formats):
    assert apply(value, lambda c: fn.to_date_iso(c, formats)) == dt.date(2018, 3, 9)


def test_line_amount(spark):
    df = spark.sql("SELECT cast('1.125' AS decimal(15,3)) AS p, 3 AS q, cast(NULL AS int) AS n")
    row = df.select(fn.line_amount(F.col("p"), F.col("q")), fn.line_amount(F.col("p"), F.col("n"))).first()
    assert tuple(row) == (Decimal("3.375"), None)


SPEC = EntitySpec(
    "t", "raw_t", "stg_t", ("id", "place"),
    (
        integer("id", source="code"),
        text("place", 10, default="Sin Dato"),
        decimal("lat", 13, 10, default=0, source="y"),
        date("day"),
    ),
)


def test_conform_renames_types_and_filters(spark, rows):
    raw = spark.createDataFrame(
        [("007", None, "1,5", "2018-03-09", "x"), ("-1", "a", "bad", "bad", "x"), (None, "b", "", "", "x")],
        "code string, place string, y string, day string, extra string",
    )
    assert rows(conform(raw, SPEC)) == [(7, "Sin Dato", Decimal("1.5000000000"), dt.date(2018, 3, 9))]
    assert [r.code for r in rejected(raw, SPEC).orderBy("place").collect()] == ["-1", None]


def test_rows_left_out_never_reach_a_cast(spark):
    """An inner join makes Spark infer conditions on the key; they must not run on unusable keys."""
    raw = spark.createDataFrame(
        [("1", "a", "1", "2018-03-09"), ("zz", "a", "1", "2018-03-09")],
        "code string, place string, y string, day string",
    )
    one = conform(raw, SPEC)
    assert one.join(one.select("id"), "id").count() == 1
    assert one.where("id > 0").count() == 1


def test_run_timestamps_have_no_zone(spark):
    plain = dt.datetime(2024, 6, 1, 6, 0, 0, 250)
    zoned = plain.replace(tzinfo=dt.timezone(dt.timedelta(hours=-3)))
    row = spark.range(1).select(timestamp_literal(plain), timestamp_literal(zoned)).first()
    assert tuple(row) == (plain, plain + dt.timedelta(hours=3))
