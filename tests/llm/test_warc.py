import glob
import gzip
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lexispark.llm import warc

BIG, OTHER = "<p>é" + "x" * 2000, "<p>" + "y" * 5000
SCHEMA = "page_id bigint, url string, html string, _digest string, _first string, _0 string"


def pages(spark, data):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in data], SCHEMA)


def data():
    out = [(1, "http://a", BIG), (7, "http://b\r\nX: y", BIG), (3, None, BIG), (4, "http://d", "small"), (5, "http://e", "small"), (6, "http://f", None), (8, "u", ""), (9, "é", OTHER)]
    return [*out, (9, "again", OTHER), (2, "u", OTHER), (None, "none", OTHER)] + [(i, f"http://h/{i}", BIG) for i in range(20, 60)] + [(i, f"http://i/{i}", f"<p>{i}" * 300) for i in range(100, 160)]


def want(rows):
    top = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 1000 and i is not None:
            top[h] = max(i, top.get(h, i))
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = h in top and top[h] != i
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top[h] if again else None))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in warc.archived_pages(df).collect()), key=str)


@pytest.mark.parametrize("width", [2000, 8 << 20])
def test_round_trip_in_ranges_of_any_width(spark, tmp_path, width):
    folder = f"file:{tmp_path}/w"
    warc.write_archives(pages(spark, data()), folder)
    assert result(warc.read_archives(spark, folder, width)) == want(data())


def test_archives_are_plain_warc(spark, tmp_path):
    warc.write_archives(pages(spark, data()), f"file:{tmp_path}/w")
    whole = b"".join(gzip.decompress(open(f, "rb").read()) for f in glob.glob(f"{tmp_path}/w/data/*.warc.gz"))
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(data()) and whole.count(b"\r\nX: y") == 0


def test_magic_inside_a_member_is_no_record(tmp_path):
    """A payload stored without compression that holds a gzip member, and one that holds a whole record."""
    inner = warc.page_record({"_0": 5, "_1": "u", "_2": "inner", "_digest": "0" * 40, "_bytes": 5, "_first": None})
    fake = gzip.compress(b"no record")
    name = tmp_path / "x.warc.gz"
    outer = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:1>")], b"HTTP/1.1 200 OK\r\n\r\n", fake + warc.MAGIC * 3)
    pack = zlib.compressobj(0, zlib.DEFLATED, 31)
    plain = pack.compress(zlib.decompress(outer, 31)) + pack.flush()
    name.write_bytes(plain + inner)
    with open(name, "rb") as f:
        size = name.stat().st_size
        found = [x for at in range(0, size, 50) for x in warc.records_of(f, size, at, min(at + 50, size))]
    assert [x[1]["warc-record-id"] for x in found] == ["<urn:page:1>", "<urn:page:5>"]
    assert found[0][2] == fake + warc.MAGIC * 3


def test_damage_is_found(spark, tmp_path):
    folder = f"file:{tmp_path}/w"
    warc.write_archives(pages(spark, data()), folder)
    records = warc.read_archives(spark, folder)
    assert warc.incomplete_files(records, folder).count() == 0
    with pytest.raises(Exception, match="payload differs from its digest"):
        warc.archived_pages(records.withColumn("payload", F.lit("other").cast("binary"))).collect()
    name = glob.glob(f"{tmp_path}/w/data/*.warc.gz")[0]
    whole = open(name, "rb").read()
    open(name, "wb").write(whole[: len(whole) - 30])
    records = warc.read_archives(spark, folder)
    assert warc.incomplete_files(records, folder).count() == 1 and records.where("type = 'damaged'").count() == 1
    with pytest.raises(Exception, match="payload differs from its digest"):
        warc.archived_pages(records).collect()
    open(name, "wb").write(b"")
    assert warc.incomplete_files(warc.read_archives(spark, folder), folder).count() == 1


def test_a_record_inside_a_payload_is_no_record_of_the_archive(tmp_path):
    inner = warc.page_record({"_0": 5, "_1": "u", "_2": "inner", "_digest": "0" * 40, "_bytes": 5, "_first": None})
    outer = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:1>")], b"HTTP/1.1 200 OK\r\n\r\n", inner)
    pack = zlib.compressobj(0, zlib.DEFLATED, 31)
    stored = pack.compress(zlib.decompress(outer, 31)) + pack.flush()
    broken = bytearray(inner)
    broken[len(inner) // 2] ^= 255
    name = tmp_path / "x.warc.gz"
    name.write_bytes(stored + inner + bytes(broken) + inner)
    with open(name, "rb") as f:
        found = list(warc.records_of(f, name.stat().st_size, 0, name.stat().st_size))
    assert [x[1] and x[1]["warc-record-id"] for x in found] == ["<urn:page:1>", "<urn:page:5>", None, "<urn:page:5>"]
    assert found[0][2] == inner


def test_empty_table(spark, tmp_path):
    folder = f"file:{tmp_path}/w"
    warc.write_archives(pages(spark, []), folder)
    assert warc.read_archives(spark, folder).count() == 0
