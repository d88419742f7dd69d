"""Archives: round trips, revisits against plain Python, skipping, files of others."""

import datetime as dt
import gzip
import hashlib
import io
import os

import pyarrow.fs as arrow_fs
import pytest
from pyspark.sql import functions as F

from stratamart.llm import warc
from stratamart.llm.common import importable

PAGES = "page_id long, url string, html string, record_type string, payload string, digest string, salt string"
DAY = dt.datetime(2024, 5, 1, 12, 0, 0)


@pytest.fixture
def pages(spark):
    importable(spark)

    def made(rows):
        return spark.createDataFrame([(*r, "t", "p", "d", "s") for r in rows], PAGES)

    return made


def plain(rows):
    """The contract, row by row."""
    payloads = [(i, (html or "").encode()) for i, _, html in rows]
    least = {}
    for i, payload in payloads:
        if len(payload) >= 100 and i is not None:
            least[payload] = min(i, least.get(payload, i))
    out = []
    for i, payload in payloads:
        first = least.get(payload)
        revisit = first is not None and i != first
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "https://a.org/x?y=ü z\r\nWARC-Type: metadata", "<p>" + "long " * 60),
    (2, None, "<p>" + "long " * 60),
    (3, "u", "<p>" + "long " * 60),
    (4, "u", None),
    (5, "u", ""),
    (6, "u", "x" * 99),
    (7, "u", "x" * 99),
    (9, "u", "y" * 100),
    (8, "u", "y" * 100),
    (8, "u", "y" * 100),
    (None, "u", "y" * 100),
    (None, "u", "z" * 100),
    (None, "u", "z" * 100),
    (10, "u", "WARC/1.1\r\n\r\nHTTP/1.1 200 OK\r\n\r\n\r\n\r\n漢字 \U0001f600 " * 20),
    (11, "u", "ab" * 900_000),
    (12, "u", "\x00 nul"),
]


def test_archive_of_odd_pages(pages, rows):
    got = rows(warc.archived(pages(ROWS)))
    assert got == plain(ROWS)


def test_hot_payloads_are_spread(spark, pages, tmp_path, rows):
    many = [(i, f"u{i}", "same " * 50) for i in range(300)] + [(1000 + i, "u", f"own {i} " * 30) for i in range(20)]
    path = str(tmp_path / "archive")
    warc.write_pages(pages(many), path, hot_bytes=5_000)
    assert rows(warc.read_pages(spark, path)) == plain(many)
    records = warc.read_warc(spark, path, ["record_type"]).groupBy("record_type").count()
    assert rows(records) == [("response", 21), ("revisit", 299)]


def test_texts_and_fields_come_back(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_pages(pages(ROWS), path, date=DAY)
    found = {r["record_id"]: r for r in warc.read_warc(spark, path).collect()}
    assert found["urn:page:10"]["payload"].decode() == ROWS[13][2]
    assert bytes(found["urn:page:11"]["payload"]) == b"ab" * 900_000
    first = found["urn:page:1"]
    assert first["target_uri"] == "https://a.org/x?y=ü%20z%0D%0AWARC-Type:%20metadata"
    assert first["record_type"] == "response" and first["date"] == "2024-05-01T12:00:00Z"
    assert first["headers"]["warc-payload-digest"] == first["payload_digest"]
    again = found["urn:page:3"]
    assert again["record_type"] == "revisit" and again["refers_to"] == "urn:page:1" and again["payload"] == b""
    assert again["payload_bytes"] == len(ROWS[0][2]) and found["urn:page:2"]["target_uri"] is None


def test_paths_of_any_form(spark, pages, tmp_path, rows):
    folder = tmp_path / "with space ñ%20"
    for path in (str(folder / "a"), f"file:{folder}/b", f"file://{folder}/c"):
        warc.write_pages(pages(ROWS[:4]), path)
        assert rows(warc.read_pages(spark, path)) == plain(ROWS[:4])
    assert sorted(p.name for p in folder.iterdir()) == ["a", "b", "c"]


def test_empty_table(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_pages(pages([]), path)
    assert warc.read_pages(spark, path).collect() == []


def test_predicates_are_those_of_spark(spark, pages, tmp_path, rows):
    path = str(tmp_path / "archive")
    warc.write_pages(pages(ROWS), path)
    columns = ["record_type", "record_id", "content_length", "target_uri"]
    everything = warc.read_warc(spark, path, columns)
    asked = [
        ([("record_type", "=", "revisit"), ("record_id", "starts with", "urn:page:2")], "record_type = 'revisit' and record_id like 'urn:page:2%'"),
        ([("record_id", "in", ["urn:page:4", "urn:page:9"])], "record_id in ('urn:page:4', 'urn:page:9')"),
        ([("target_uri", "is null", None)], "target_uri is null"),
        ([("target_uri", "!=", "u"), ("target_uri", "is not null", None)], "target_uri <> 'u'"),
        ([("content_length", ">", 100), ("content_length", "<=", 1_000)], "content_length > 100 and content_length <= 1000"),
        ([("content_length", ">=", 1_000), ("content_length", "<", 10**7)], "content_length >= 1000 and content_length < 10000000"),
    ]
    for where, condition in asked:
        got = rows(warc.read_warc(spark, path, columns, where))
        assert got == rows(everything.where(condition)) and 0 < len(got) < len(ROWS)
    for wrong in (("payload", "=", "x"), ("record_type", "like", "x")):
        with pytest.raises(ValueError):
            warc.header_test(wrong)


def test_queries_over_one_frame_do_not_meet(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_pages(pages(ROWS), path)
    df = warc.read_warc(spark, path, ["record_type"])
    revisits, responses = (df.where(F.col("record_type") == kind) for kind in ("revisit", "response"))
    assert revisits.count() + responses.count() == df.count() == revisits.union(responses).count() == len(ROWS)


class Counting(io.BytesIO):
    """Counts the bytes that are read."""

    def __init__(self, data):
        super().__init__(data)
        self.total = 0

    def read(self, size=-1):
        got = super().read(size)
        self.total += len(got)
        return got


def response(page_id, payload, kind="response"):
    return warc.record_bytes(
        {"record_type": kind, "record_id": f"urn:page:{page_id}", "date": "2024", "target_uri": "u", "payload_digest": "sha256:0",
         "refers_to": "urn:page:1", "payload": payload, "payload_bytes": len(payload)}
    )


@pytest.mark.parametrize("packed", [True, False])
def test_unwanted_payloads_are_not_read(packed):
    blobs = [os.urandom(400_000) for _ in range(5)]
    made = [response(i, blob) for i, blob in enumerate(blobs)]
    data = b"".join(warc.member(r) if packed else r for r in made)
    file, inflated = Counting(data), []
    wanted = lambda record: record.fields["warc-record-id"] == "<urn:page:3>"
    for record in warc.records(file, len(data), wanted):
        assert record.payload() == blobs[3]
        inflated.append(getattr(record._source, "inflated", 0))
    assert file.total < len(data) // 3 and len(inflated) == 1
    skipped = Counting(data)
    for record in warc.records(skipped, len(data)):
        assert record.payload_bytes() == 400_000
        assert getattr(record._source, "inflated", 0) < 20_000
    assert skipped.total < 200_000


def test_files_of_others(spark, tmp_path):
    importable(spark)
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:0>\r\nContent-Type: application/warc-fields\r\nContent-Length: 5\r\n\r\na: b\n\r\n\r\n"
    folded = b"WARC/1.0\r\nwarc-type:  resource\r\nWARC-Record-ID: <urn:uuid:9>\r\nX-Long: a\r\n  b\r\nX-Long: c\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n"
    made = [info, response(1, b"one" * 9_000), folded, response(2, b"", "revisit")]
    (tmp_path / "plain.warc").write_bytes(b"".join(made))
    (tmp_path / "packed.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in made))
    (tmp_path / "_hidden.warc").write_bytes(b"no")
    (tmp_path / "notes.txt").write_bytes(b"no")
    both = warc.read_warc(spark, str(tmp_path))
    found = [r for r in both.collect()]
    assert len(found) == 8
    for name in ("plain.warc", "packed.warc.gz"):
        one, two, three, four = warc.read_warc(spark, str(tmp_path / name)).collect()
        assert (one["record_type"], bytes(one["payload"])) == ("warcinfo", b"a: b\n")
        assert bytes(two["payload"]) == b"one" * 9_000 and two["payload_bytes"] == 27_000
        assert three["headers"]["x-long"] == "a b" and bytes(three["payload"]) == b"xyz" and three["date"] is None
        assert four["record_type"] == "revisit" and four["payload_bytes"] == 0
    assert both.where("record_type = 'resource'").count() == 2


@pytest.mark.parametrize(
    "data",
    [b"no archive at all\r\n\r\n", response(1, b"x" * 50)[:40], warc.member(response(1, os.urandom(9_000)))[:3_000],
     gzip.compress(response(1, b"a") + response(2, b"b"))],
)
def test_broken_files_raise(data):
    with pytest.raises(ValueError):
        for record in warc.records(io.BytesIO(data), len(data)):
            record.payload()


def test_partitions_follow_file_sizes(tmp_path):
    for i in range(6):
        (tmp_path / f"{i}.warc").write_bytes(response(i, b"x" * (100_000 if i == 3 else 1_000)))
    schema = warc.StructType.fromDDL("record_id string")
    planned = warc.WarcReader(str(tmp_path), schema, 3_000).partitions()
    assert [len(p.files) for p in planned] == [2, 1, 1, 2]
    assert sorted(f for p in planned for f, _ in p.files) == sorted(str(p) for p in tmp_path.iterdir())


def test_only_committed_files_count(spark, pages, tmp_path, rows):
    path = tmp_path / "archive"
    warc.write_pages(pages(ROWS[:3]), str(path))
    (path / "pages-lost.warc.gz").write_bytes(warc.member(response(77, b"left by a lost task")))
    assert warc.read_warc(spark, str(path), ["record_id"]).count() == 3
    warc.write_pages(pages(ROWS[3:6]), str(path))  # adds to it
    assert warc.read_warc(spark, str(path), ["record_id"]).count() == 6
    assert len([f for f in arrow_fs.LocalFileSystem().get_file_info(arrow_fs.FileSelector(str(path))) if f.base_name.startswith("_records")]) == 1


def test_large_archives_are_cut_into_files(spark, pages, tmp_path):
    rows = pages([(i, "u", f"{i} " + os.urandom(3_000).hex()) for i in range(40)])
    path = tmp_path / "archive"
    spark.dataSource.register(warc.WarcSource)
    records = warc.page_records(rows.coalesce(1))
    records.coalesce(1).write.format("warc").option("fileBytes", 20_000).mode("append").save(str(path))
    files = [p.stat().st_size for p in path.glob("*.warc.gz")]
    assert len(files) > 4 and max(files) < 30_000
    assert warc.read_warc(spark, str(path), ["record_id"]).count() == 40
