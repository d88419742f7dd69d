"""Feeds and the warehouse."""

import pytest
from conftest import T0, T1
from pyspark.sql import functions as F

from stratamart.sources import (
    Warehouse,
    bucket_count_for,
    land,
    path_exists,
    read_feed,
    resolve_delimiter,
)
from stratamart.specs import LANDING, STAGING, FeedSpec

SPEC = FeedSpec("f.csv", "raw_f", ("a", "b", "c"))


@pytest.fixture
def feed(tmp_path):
    def written(content, name="f.csv", encoding="utf-8"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True, parents=True)
        path.write_bytes(content.encode(encoding))
        return str(path)

    return written


def test_null_and_quoted_empty_differ(spark, feed):
    path = feed('h\n1,"",x\n2,,"a ""b"", c"\n')
    found = [tuple(r) for r in read_feed(spark, path, FeedSpec("f", "r", ("a", "b", "c"), ",")).collect()]
    assert found == [("1", "", "x"), ("2", None, 'a "b", c')]


@pytest.mark.parametrize("delimiter", [",", ";", "\t", "|"])
def test_delimiter_is_sniffed(spark, feed, delimiter):
    path = feed(delimiter.join("abc") + "\n" + delimiter.join("123") + "\n")
    assert resolve_delimiter(spark, path, SPEC) == delimiter
    assert [tuple(r) for r in read_feed(spark, path, SPEC).collect()] == [("1", "2", "3")]


def test_fixed_delimiter_wins(spark, feed):
    path = feed("a,b,c\n1;2;3\n")
    assert resolve_delimiter(spark, path, FeedSpec("f", "r", SPEC.columns, ";")) == ";"


def test_crlf_bom_and_spaces_are_kept(spark, feed):
    path = feed("﻿a,b,c\r\n 1 ,x ,é\r\n")
    assert [tuple(r) for r in read_feed(spark, path, SPEC).collect()] == [(" 1 ", "x ", "é")]


def test_encoding(spark, feed):
    path = feed("a,b,c\n1,ñ,é\n", encoding="latin-1")
    spec = FeedSpec("f", "r", SPEC.columns, ",", encoding="ISO-8859-1")
    assert [tuple(r) for r in read_feed(spark, path, spec).collect()] == [("1", "ñ", "é")]
    path = feed("a,b,c\n1,ñ,é\n", "g.csv", encoding="utf-16")
    spec = FeedSpec("f", "r", SPEC.columns, ",", encoding="UTF-16", multiline=True)
    assert [tuple(r) for r in read_feed(spark, path, spec).collect()] == [("1", "ñ", "é")]


def test_line_breaks_in_quotes_are_up_to_the_spec(spark, feed):
    path = feed('a,b,c\n1,"x\ny",2\n')
    spec = FeedSpec("f.csv", "raw_f", SPEC.columns, multiline=True)
    assert [tuple(r) for r in read_feed(spark, path, spec).collect()] == [("1", "x\ny", "2")]
    with pytest.raises(Exception, match="multiline=True"):
        read_feed(spark, path, SPEC).collect()
    with pytest.raises(ValueError, match="multiline=True"):
        read_feed(spark, path, FeedSpec("f", "r", SPEC.columns, ",", encoding="UTF-16"))


def test_a_line_break_that_leaves_the_number_of_fields_right(spark, feed):
    path = feed('a,b\n1,"x\ny"\n')
    with pytest.raises(Exception, match="multiline=True"):
        read_feed(spark, path, FeedSpec("f", "r", ("a", "b"), ",")).collect()


@pytest.mark.parametrize("line", ['1,"abc"def,3', '1,5" pipe,3', '1,a "b" c,3', '1,"a"b"c",3', '1,"open,3', '"1,2,3'])
@pytest.mark.parametrize("multiline", [False])
def test_misplaced_quotes_fail(spark, feed, line, multiline):
    path = feed(f"a,b,c\n1,2,3\n{line}\n")
    with pytest.raises(Exception, match="quotes"):
        read_feed(spark, path, FeedSpec("f", "r", SPEC.columns, ",", multiline=multiline)).collect()


def test_quotes_in_their_place(spark, feed):
    path = feed('a,b,c\n"1","x, ""y""",""\n"",,"""" \n'.replace('"""" ', '""""'))
    found = [tuple(r) for r in read_feed(spark, path, SPEC).collect()]
    assert found == [("1", 'x, "y"', ""), ("", None, '"')]


def test_blank_lines(spark, feed):
    path = feed("a,b,c\n1,2,3\n\n4,5,6\n")
    assert read_feed(spark, path, SPEC).count() == 2
    with pytest.raises(ValueError, match="blank lines"):
        read_feed(spark, path, FeedSpec("f", "r", SPEC.columns, ",", refuse_blank_lines=True))


def test_feeds_with_quotes_stay_splittable(spark, feed):
    path = feed("a,b,c\n" + '1,"x, ""y""",2\n' * 20_000)
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 40_000)
    try:
        rows = read_feed(spark, path, SPEC)
        assert rows.rdd.getNumPartitions() > 4
        assert rows.where("b = 'x, \"y\"'").count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)


@pytest.mark.parametrize("bad", ["1,bad", "1,2,3,4"])
@pytest.mark.parametrize("action", ["count", "narrow", "all"])
def test_wrong_number_of_fields_raises(spark, feed, bad, action):
    df = read_feed(spark, feed(f"a,b,c\n1,2,3\n{bad}\n"), SPEC)
    with pytest.raises(Exception, match="MALFORMED"):
        {"count": df.count, "narrow": df.select("a").collect, "all": df.collect}[action]()


def test_header_only_and_undeclared(spark, feed):
    assert read_feed(spark, feed("header\n"), FeedSpec("f", "r", SPEC.columns, ",")).isEmpty()
    with pytest.raises(ValueError, match="no columns declared"):
        read_feed(spark, feed("a,b\n1,2\n"), FeedSpec("f", "r", ()))


def test_folder_of_files(spark, feed, tmp_path):
    feed("a,b,c\n1,2,3\n", "many/p1.csv")
    feed("a,b,c\n4,5,6\n", "many/p2.csv")
    folder = str(tmp_path / "many")
    assert sorted(r.a for r in read_feed(spark, folder, SPEC).collect()) == ["1", "4"]
    assert path_exists(spark, folder) and not path_exists(spark, folder + "/nothing.csv")


def test_land_replaces_or_appends(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    df = spark.createDataFrame([("1",), ("2",)], "a string")
    assert land(wh, df, "raw_f", T0).metrics["rows"] == 2
    land(wh, df, "raw_f", T1, truncate=False)
    assert wh.count(LANDING, "raw_f") == 4
    assert {r.created_at for r in wh.read(LANDING, "raw_f").collect()} == {T0, T1}
    land(wh, df.limit(1), "raw_f", T1)
    assert wh.count(LANDING, "raw_f") == 1


@pytest.mark.parametrize("buckets", [{}, {"t": 4}])
def test_a_version_shows_only_once_published(spark, tmp_path, buckets):
    wh = Warehouse(spark, str(tmp_path / "wh"), buckets)
    one, two = spark.range(10), spark.range(20)
    wh.publish(wh.write(STAGING, "t", one, ("id",)))
    before = wh.read(STAGING, "t")
    snapshot = wh.write(STAGING, "t", two, ("id",), measure={"even": F.count_if(F.col("id") % 2 == 0)})
    assert {name: snapshot.metrics[name] for name in ("rows", "even")} == {"rows": 20, "even": 10}
    assert wh.count(STAGING, "t") == 10
    wh.publish(snapshot)
    assert wh.count(STAGING, "t") == 20
    assert before.count() == 10  # a reader keeps the snapshot it started with
    with pytest.raises(RuntimeError, match="another writer"):
        wh.publish(snapshot)
    # A second session over the same folder sees the same table.
    again = Warehouse(spark.newSession(), str(tmp_path / "wh"), buckets)
    assert again.count(STAGING, "t") == 20


def test_listing_reset_and_vacuum(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), {"stg_b": 2})
    assert wh.layers() == [] and wh.tables(STAGING) == []
    wh.reset()
    schema = spark.range(1).schema
    for name in ("stg_b", "stg_a", "other"):
        wh.create(STAGING, name, schema)
    assert wh.tables(STAGING) == ["other", "stg_a", "stg_b"]
    assert wh.tables(STAGING, like="stg_%") == ["stg_a", "stg_b"]
    assert wh.tables(STAGING, like="stg\\_") == []
    assert wh.count(STAGING, "stg_a") == 0 and wh.read(STAGING, "stg_a").columns == ["id"]
    for n in (1, 2, 3):
        wh.publish(wh.write(STAGING, "stg_b", spark.range(n), ("id",)))
    written = wh.write(STAGING, "stg_b", spark.range(99), ("id",))  # not published yet
    wh.vacuum(STAGING, "stg_b", keep=1)
    folders = [p.name for p in (tmp_path / "wh" / STAGING / "stg_b").iterdir() if p.name[0] == "d"]
    assert len(folders) == 2 and wh.count(STAGING, "stg_b") == 3
    wh.publish(written)
    assert wh.count(STAGING, "stg_b") == 99 == wh.read(STAGING, "stg_b").count()
    wh.vacuum(STAGING, "stg_b", keep=1)
    folders = [p.name for p in (tmp_path / "wh" / STAGING / "stg_b").iterdir() if p.name[0] == "d"]
    assert len(folders) == 1 and wh.read(STAGING, "stg_b").count() == 99
    with pytest.raises(ValueError, match="current version"):
        wh.vacuum(STAGING, "stg_b", keep=0)
    with pytest.raises(LookupError):
        wh.read(STAGING, "nothing")
    wh.reset()
    assert wh.tables(STAGING) == [] and len(wh.layers()) == 4


def test_bucket_counts_follow_the_size(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    df = wh.read_snapshot(wh.write(STAGING, "t", spark.range(100_000)))
    assert bucket_count_for(df) == 1
    assert 1 < bucket_count_for(df, 1000) < 100_000
    assert bucket_count_for(df, 1) == 100_000  # Spark's own limit


def test_buckets_are_counted_by_rows_and_not_by_files(spark, tmp_path):
    """Files that compress a thousandfold hold as many rows to sort as any others."""
    wh = Warehouse(spark, str(tmp_path / "wh"))
    rows = spark.range(3_000_000).selectExpr("1L AS a", "2L AS b", "3L AS c")
    df = wh.read_snapshot(wh.write(STAGING, "t", rows))
    assert bucket_count_for(df) == 3  # 96 MB of rows
    assert bucket_count_for(df, 8 << 20) == 12
