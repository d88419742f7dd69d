"""Records that span lines: the same as one task per file finds, however the files are split."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from stratamart.sources import read_feed
from stratamart.sources.multiline import _lines, split_states
from stratamart.specs import FeedSpec

COLUMNS = ("a", "b", "c")


def spec(**more):
    return FeedSpec("f.csv", "raw_f", COLUMNS, ",", multiline=True, **more)


@pytest.fixture
def split_by(spark):
    """Cut files into splits of so many bytes."""
    names = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": None}
    before = {name: spark.conf.get(name) for name in names}

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)

    yield cut
    for name, value in before.items():
        spark.conf.set(name, value)


def made(seed, n=400, break_rate=0.3, newline="\n"):
    """Rows with breaks, quotes and blank lines inside fields, and the text of their feed."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        wild = "".join(rng.choice(['"', "\n", "\r\n", "x", ",", " ", "ñ", "\n\n"]) for _ in range(rng.randrange(1, 30)))
        rows.append((str(i), wild if rng.random() < break_rate else f"plain {i}", rng.choice(["", "z", "q,q"])))
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=newline, quoting=csv.QUOTE_ALL)
    writer.writerow(COLUMNS)
    writer.writerows(rows)
    return rows, out.getvalue()


def found(df):
    return sorted(((r.a, r.b, r.c) for r in df.collect()), key=lambda r: int(r[0]))


@pytest.mark.parametrize("size", [64, 257, 4_000, 1 << 20])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_any_split_gives_the_records(spark, tmp_path, split_by, size, newline):
    rows, text = made(size + len(newline), newline=newline)
    (tmp_path / "f.csv").write_bytes(text.encode())
    split_by(size)
    df = read_feed(spark, str(tmp_path), spec())
    assert found(df) == rows
    assert df.count() == len(rows) and df.select("c").distinct().count() == 3
    if size == 257:
        assert df.rdd.getNumPartitions() > 8


def test_one_record_over_many_splits_and_many_files(spark, tmp_path, split_by):
    expected = []
    for name in ("p", "q"):
        rows, text = made(name, 30)
        long = ("1000" + str(len(expected)), "deep\n" * 900, "end")
        tail = io.StringIO()
        csv.writer(tail, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows([long, ("2000", "after", "")])
        (tmp_path / f"{name}.csv").write_bytes((text + tail.getvalue()).encode())
        expected += [*rows, long, ("2000", "after", "")]
    split_by(100)
    got = read_feed(spark, str(tmp_path), spec()).collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_a_header_over_several_splits(spark, tmp_path, split_by):
    (tmp_path / "f.csv").write_text('"a\n' + "long\n" * 50 + '",b,c\n1,2,3\n\n \n4,"5\n\n6",7')
    for size in (20, 1 << 20):
        split_by(size)
        assert sorted(map(tuple, read_feed(spark, str(tmp_path), spec()).collect())) == [("1", "2", "3"), ("4", "5\n\n6", "7")]


def test_encodings(spark, tmp_path, split_by):
    rows, text = made(7)
    split_by(300)
    for encoding in ("ISO-8859-1", "UTF-8", "UTF-16"):
        folder = tmp_path / encoding
        folder.mkdir()
        (folder / "f.csv").write_bytes(text.encode(encoding))
        assert found(read_feed(spark, str(folder), spec(encoding=encoding))) == rows


@pytest.mark.parametrize("bad", ['1,"open,3\n4,5,6', '1,a "b" c,3', '1,2', '1,"x\ny",2,3'])
@pytest.mark.parametrize("action", ["count", "narrow"])
def test_malformed_records_fail(spark, tmp_path, split_by, bad, action):
    (tmp_path / "f.csv").write_text(f"a,b,c\n1,2,3\n{bad}\n" + "7,8,9\n" * 50)
    split_by(100)
    df = read_feed(spark, str(tmp_path), spec())
    with pytest.raises(Exception, match="MALFORMED"):
        df.count() if action == "count" else df.select("a").collect()


def test_only_records_across_a_border_move(spark, tmp_path, split_by):
    rows, text = made(3, 2_000, 0.02)
    (tmp_path / "f.csv").write_bytes(text.encode())
    split_by(2_000)
    states = split_states(_lines(spark, str(tmp_path)))
    crossed = states.where(F.col("inside") | F.col("open")).count()
    assert 0 < crossed < states.count() / 2
    plan = read_feed(spark, str(tmp_path), spec())._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    assert found(read_feed(spark, str(tmp_path), spec())) == rows


def test_empty_and_header_only(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b,c\n")
    (tmp_path / "g.csv").write_text("")
    assert read_feed(spark, str(tmp_path), spec()).isEmpty()
