"""The WARC data source: round trips, predicates in the reader, skipped payloads, lost tasks."""

import glob
import gzip
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo, IsNull, Not

from clicklake.llm import warc
from helpers import plan_of

ROWS = [
    ("response", f"http://h{k % 3}.example/{k}", k, b"x%d " % k * (k + 1)) for k in range(50)
] + [("metadata", "http://m.example/\r\nX-Injected: 1", 100, b"WARC/1.1\r\n\r\n" * 5), ("revisit", None, 101, None), ("resource", "u", 102, b"")]
FIELDS = "record_type string, target_uri string, x_n long, payload binary"


@pytest.fixture(params=["none", "gzip"])
def archive(request, spark, tmp_path):
    path = f"{tmp_path}/archive"
    warc.write(spark.createDataFrame(ROWS, FIELDS).repartition(3), path, request.param)
    return path


def test_round_trip(spark, archive):
    back = warc.read(spark, archive, FIELDS).where("record_type <> 'warcinfo'").orderBy("x_n").collect()
    want = [(t, u and u.replace("\r", "%0D").replace("\n", "%0A"), n, bytes(p or b"")) for t, u, n, p in ROWS]
    assert [(r[0], r[1], r[2], bytes(r[3])) for r in back] == want
    whole = warc.read(spark, archive)
    assert whole.columns == [f.split()[0] for f in warc.SCHEMA.split(", ")]
    assert whole.where("record_type = 'warcinfo'").count() == len(glob.glob(f"{archive}/*.warc*"))
    assert whole.where("headers['x-n'] = '7'").count() == 1
    assert whole.where("headers['x-injected'] IS NOT NULL").count() == 0


def test_predicates_of_a_relation(spark, archive):
    def ns(*where):
        return sorted(r.x_n for r in warc.read(spark, archive, "x_n long", where).collect())

    assert ns(("record_type", "=", "response"), ("target_uri", "starts", "http://h1"), ("x_n", ">=", 10), ("x_n", "not in", [13, 16])) == [
        k for k in range(50) if k % 3 == 1 and k >= 10 and k not in (13, 16)
    ]
    assert ns(("record_type", "in", ["metadata", "revisit"])) == [100, 101]
    assert ns(("target_uri", "null"), ("x_n", "not null")) == [101]
    assert ns(("target_uri", "contains", "h2"), ("target_uri", "ends", "7"), ("x_n", "<", 40)) == [17]
    rows = warc.read(spark, archive, FIELDS, [("x_n", ">", 3)])
    # One relation under two filters in one query, and under none: each scan must have its own rows.
    assert rows.where("x_n < 6").union(rows.where("x_n > 47")).count() == 2 + 5
    assert rows.count() == 46 + 3 and rows.where("x_n > 48 OR record_type = 'revisit'").count() == 4
    with pytest.raises(ValueError, match="payload"):
        warc.read(spark, archive, FIELDS, [("payload", "=", b"x")])


@pytest.fixture
def pushing(spark):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield spark
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_spark_can_push_filters_where_asked(pushing, archive):
    query = "record_type = 'response' AND target_uri LIKE 'http://h1%' AND x_n >= 10 AND NOT x_n IN (13, 16)"
    want = [k for k in range(50) if k % 3 == 1 and k >= 10 and k not in (13, 16)]
    pushed = warc.read(pushing, archive, FIELDS, pushdown="true").where(query)
    assert "Filter " not in plan_of(pushed).replace("RuntimeFilters", "") and sorted(r.x_n for r in pushed.collect()) == want
    plain = warc.read(pushing, archive, FIELDS).where(query)
    assert "Filter " in plan_of(plain) and sorted(r.x_n for r in plain.collect()) == want
    kept = warc.read(pushing, archive, FIELDS, pushdown="true").where("length(payload) > 3 AND x_n = 100")
    assert "Filter " in plan_of(kept) and kept.count() == 1


def test_unwanted_payloads_are_not_read(spark, archive, monkeypatch):
    read, skipped = [], []
    for kind in (warc._Plain, warc._Gzip):
        block, skip = kind.block, kind.skip
        monkeypatch.setattr(kind, "block", lambda self, f=block: read.append(1) or f(self))
        monkeypatch.setattr(kind, "skip", lambda self, f=skip: skipped.append(1) or f(self))

    def rows(schema, *filters):
        read.clear(), skipped.clear()
        reader = warc.PushingReader(T._parse_datatype_string(schema), {"path": archive})
        assert list(reader.pushFilters(list(filters))) == []
        return sum(b.num_rows for p in reader.partitions() for b in reader.read(p))

    files = len(glob.glob(f"{archive}/*.warc*"))
    assert rows(FIELDS, EqualTo(("record_type",), "metadata")) == 1
    assert (len(read), len(skipped)) == (1, 52 + files)
    assert rows("record_type string") == 53 + files and not read
    assert rows(FIELDS, Not(IsNull(("x_n",)))) == 53 and len(read) == 53
    some = sorted(glob.glob(f"{archive}/*.warc*"))[0]
    reader = warc.PushingReader(T._parse_datatype_string("file string"), {"path": archive, "partition_bytes": "1"})
    assert len(reader.partitions()) == files
    list(reader.pushFilters([EqualTo(("file",), some)]))
    assert [p.paths for p in reader.partitions()] == [(some,)]


def test_what_a_lost_task_left_is_no_part(spark, archive):
    before = warc.read(spark, archive, "x_n long").count()
    some = glob.glob(f"{archive}/*.warc*")[0]
    with open(some, "rb") as file, open(f"{archive}/part-00000-lost{some[some.index('.warc'):]}", "wb") as copy:
        copy.write(file.read())
    assert warc.read(spark, archive, "x_n long").count() == before
    warc.write(spark.createDataFrame(ROWS[:2], FIELDS), archive)
    assert warc.read(spark, archive, "x_n long").where("x_n IS NOT NULL").count() == len(ROWS) + 2
    warc.write(spark.createDataFrame(ROWS[:2], FIELDS), archive, overwrite=True)
    assert warc.read(spark, archive, "x_n long").where("x_n IS NOT NULL").count() == 2


def test_archives_of_others(spark, tmp_path):
    """No manifest, members without a stated length, folded and repeated fields, chunks of one file."""
    def one(k):
        body = f"HTTP/1.1 404 Gone\r\nA: b\r\n\r\nbody {k}".encode()
        return f"WARC/1.0\r\nWARC-Type: response\r\nX-N: {k}\r\nX-N: 9\r\nX-Folded: a\r\n  b\r\ncontent-type: application/http; msgtype=response\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    os.makedirs(f"{tmp_path}/deep/er")
    with open(f"{tmp_path}/deep/er/a.warc.gz", "wb") as file:
        for k in range(3):
            file.write(gzip.compress(one(k)))
    with open(f"{tmp_path}/b.warc", "wb") as file:
        file.write(one(3) + one(4))
    rows = warc.read(spark, str(tmp_path), "x_n int, x_folded string, payload binary").orderBy("x_n").collect()
    assert [(r.x_n, r.x_folded, bytes(r.payload)) for r in rows] == [(k, "a b", b"body %d" % k) for k in range(5)]
    assert warc.read(spark, str(tmp_path), "x_n int", [("x_n", "not =", 1)]).count() == 4


def test_damage_ends_the_read(spark, tmp_path):
    with open(f"{tmp_path}/a.warc", "wb") as file:
        file.write(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 10\r\n\r\nabc")
    with pytest.raises(PySparkException, match="ends before"):
        warc.read(spark, str(tmp_path)).collect()
    with open(f"{tmp_path}/a.warc", "wb") as file:
        file.write(b"no archive at all")
    with pytest.raises(PySparkException, match="broken header"):
        warc.read(spark, str(tmp_path)).collect()
