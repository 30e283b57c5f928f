import base64
import gzip
import hashlib
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from strataframe.llm import queries, warc


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def brute(rows, least=0):
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == body and p is not None]
        first = max(same) if same else None
        whole = page == first or len(body) < least
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "response" if whole else "revisit", None if whole else first))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


ROWS = [
    (1, "http://a/x", "<p>one</p>"), (2, "http://a/y", "<p>one</p>"), (3, None, None), (4, "http://b/\r\nq", ""), (5, "http://é/", "é\r\n\r\nWARC/1.1\r\n"),
    (6, "u", "x" * 300_000), (6, "u", "x" * 300_000), (2, "v", "<p>one</p>"), (None, "w", "<p>one</p>"), (None, "w", "alone"), (7, "u", "x" * 300_000),
]


@pytest.mark.parametrize("least", [0, 100])
def test_round_trip(spark, least):
    assert result(warc.round_trip(pages_of(spark, ROWS), min_revisit_bytes=least)) == brute(ROWS, least)


def test_whole_table_against_sql(spark, tiny):
    got = result(queries.op9(spark, tiny))
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tiny}/pages.parquet'")
    want = con.sql(f"select page_id, payload_bytes, payload_digest, record_type, refers_to from ({queries.ORACLES['op9_warc_round_trip']})").fetchall()
    assert got == sorted(want, key=str)


def test_empty_table_and_clashing_names(spark):
    assert warc.round_trip(pages_of(spark, [])).count() == 0
    clash = pages_of(spark, ROWS[:2]).select("*", *[F.lit("z").alias(n) for n in ("page", "body", "sha", "record_type", "payload", "first_page")])
    assert result(warc.round_trip(clash)) == brute(ROWS[:2])


@pytest.fixture(params=["gzip", "none"])
def archive(spark, tmp_path, request):
    warc.register(spark)
    path = f"{tmp_path}/w"
    warc.records_of(pages_of(spark, ROWS)).repartition(3).write.format("warc").option("fileBytes", 100_000).option("compression", request.param).mode("append").save(path)
    return path


def test_predicates_are_decided_from_headers(spark, archive, monkeypatch):
    read = spark.read.format("warc").load(archive)
    for condition in ("record_type = 'revisit'", "record_type in ('revisit', 'metadata') and target_uri = 'u'", "refers_to is not null", "payload_bytes > 5 and record_type = 'response'"):
        filtered = read.where(condition)
        want = spark.createDataFrame(read.collect(), read.schema).where(condition)
        assert sorted(map(str, filtered.collect())) == sorted(map(str, want.collect()))
    reader = warc.WarcReader({"path": archive})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload_bytes",), 3)]))
    assert [f.attribute for f in left] == [("payload_bytes",)]
    seen = []
    plain = warc._Buffered.read
    monkeypatch.setattr(warc._Buffered, "read", lambda self, n: seen.append(n) or plain(self, n))
    rows = [r for part in reader.partitions() for b in reader.read(part) for r in b.to_pylist()]
    assert {r["record_type"] for r in rows} == {"revisit"} and seen == []


def test_only_files_of_the_manifest_count(spark, archive, tmp_path):
    before = spark.read.format("warc").load(archive).count()
    with open(f"{archive}/part-orphan.warc", "wb") as f:
        f.write(warc.record_bytes("response", "urn:page:99", "u", "d", "x", None, 1, b"z"))
    assert spark.read.format("warc").load(archive).count() == before
    single = spark.read.format("warc").load(f"{archive}/part-orphan.warc").collect()
    assert [(r.record_id, bytes(r.payload)) for r in single] == [("urn:page:99", b"z")]
    with pytest.raises(Exception, match="holds archives"):
        warc.records_of(pages_of(spark, ROWS)).write.format("warc").mode("append").save(archive)


def test_small_files_share_partitions(archive):
    assert len(warc.WarcReader({"path": archive}).partitions()) == 1
    assert len(warc.WarcReader({"path": archive, "partitionBytes": "1"}).partitions()) > 2


def test_damaged_archives_fail_loudly(spark, tmp_path):
    warc.register(spark)
    good = warc.record_bytes("response", "urn:page:1", "u", "d", warc.digest_of(b"body"), None, 4, b"body")
    for name, data, option in (("short", good[:-9], {"payload": "true"}), ("junk", b"hello\r\n" + good, {}), ("digest", good.replace(b"body", b"bodx"), {"verify": "true"})):
        with open(f"{tmp_path}/{name}.warc", "wb") as f:
            f.write(data)
        with pytest.raises(Exception, match="ends inside|was expected|have its digest"):
            spark.read.format("warc").options(**option).load(f"{tmp_path}/{name}.warc").collect()


def test_foreign_records(spark, tmp_path):
    warc.register(spark)
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nX-Folded: a\r\n b\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    with open(f"{tmp_path}/f.warc", "wb") as f:
        f.write(info)
    (r,) = spark.read.format("warc").load(f"{tmp_path}/f.warc").collect()
    assert (r.record_type, r.payload_bytes, bytes(r.payload), r.record_id) == ("warcinfo", 3, b"abc", None)


def bodies(n, size):
    r = random.Random(5)
    return [bytes(r.randrange(256) for _ in range(size)) for _ in range(n)]


def written(path, kinds, pack):
    data = [warc.record_bytes(k, f"urn:page:{i}", "u", "d", warc.digest_of(b), None, len(b), b) for i, (k, b) in enumerate(kinds)]
    with open(path, "wb") as f:
        f.write(pack(data))
    return str(path)


def rows_of(reader):
    return [r for part in reader.partitions() for b in reader.read(part) for r in b.to_pylist()]


PACKS = {
    "said": lambda data: b"".join(map(warc.gzip_member, data)),
    "unsaid": lambda data: b"".join(map(gzip.compress, data)),
    "one": lambda data: gzip.compress(b"".join(data)),
    "plain": b"".join,
}


@pytest.mark.parametrize("pack", PACKS)
def test_archives_of_gzip_members(tmp_path, pack):
    kinds = [("response" if i % 3 else "request", b) for i, b in enumerate(bodies(9, 90_000))] + [("response", b"")]
    reader = warc.WarcReader({"path": written(tmp_path / "a.warc.gz", kinds, PACKS[pack]), "verify": "true"})
    assert [(r["record_type"], r["payload"]) for r in rows_of(reader)] == kinds
    list(reader.pushFilters([warc.EqualTo(("record_type",), "request")]))
    assert [(r["record_id"], r["payload"]) for r in rows_of(reader)] == [(f"urn:page:{i}", kinds[i][1]) for i in (0, 3, 6)]


def test_unwanted_members_are_not_inflated(tmp_path, monkeypatch):
    kinds = [("response" if i else "request", b) for i, b in enumerate(bodies(8, 200_000))]
    members, own = [], warc._Member.__init__
    monkeypatch.setattr(warc._Member, "__init__", lambda self, *a, **k: (own(self, *a, **k), members.append(self))[0])
    for pack, most in (("said", 8 * 40_000), ("unsaid", 8 * 250_000)):
        members.clear()
        reader = warc.WarcReader({"path": written(tmp_path / f"{pack}.warc.gz", kinds, PACKS[pack])})
        list(reader.pushFilters([warc.EqualTo(("record_type",), "none")]))
        assert rows_of(reader) == [] and len(members) == 8
        assert sum(m.inflated for m in members) < most
        list(warc.WarcReader({"path": str(tmp_path / f"{pack}.warc.gz"), "payload": "false"}).partitions())
    members.clear()
    light = warc.WarcReader({"path": str(tmp_path / "said.warc.gz"), "payload": "false"})
    assert [r["payload_bytes"] for r in rows_of(light)] == [200_000] * 8
    assert sum(m.inflated for m in members) < 8 * 40_000


def test_members_are_what_gzip_reads(tmp_path):
    data = [b"", b"a" * 100_000, os.urandom(5000)]
    assert gzip.decompress(b"".join(map(warc.gzip_member, data))) == b"".join(data)


def test_damaged_members_fail_loudly(tmp_path):
    kinds = [("response", b) for b in bodies(2, 50_000)]
    path = written(tmp_path / "x.warc.gz", kinds, PACKS["unsaid"])
    whole = open(path, "rb").read()
    for damage in (whole[:-20], whole[:30_000] + b"zz" + whole[30_002:], whole + b"junk"):
        with open(path, "wb") as f:
            f.write(damage)
        with pytest.raises(Exception, match="ends inside|damaged|was expected|invalid|Error"):
            rows_of(warc.WarcReader({"path": path}))
