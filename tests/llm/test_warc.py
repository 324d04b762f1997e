"""Archives: round trips, the dictionary, single records, revisits."""

import hashlib
import io
import struct

import pytest
import zstandard

from mailweave.llm import warc
from mailweave.session import scratch_path

BIG = "<html><body>" + "<p>The same page again.</p>" * 20 + "</body></html>"


def pages(spark):
    rows = [
        (5, "http://a/5", BIG, "x"), (2, "http://a/2 b\r\nWARC-Type: fake", BIG, "x"), (9, None, BIG, None), (None, "http://a/n", BIG, "x"),
        (2, "http://a/2", BIG, "x"), (1, "", None, "x"), (3, "é", "", "x"), (7, "u", "short", "x"), (8, "u", "short", "x"),
        (-4, "u", "ü漢" * 40, "x"), (1 << 62, "u", "ü漢" * 40, "x"), (11, "u", "a" * 99, "x"), (12, "u", "a" * 99, "x"),
        (13, "u", "a" * 100, "x"), (14, "u", "a" * 100, "x"), (15, "u", "\r\n\r\nWARC/1.1\r\n" * 20, "x"),
        *[(100 + k, f"http://b/{k}", f"<html><body><p>Page {k} of {k * k}</p><p>{'word ' * k}</p></body></html>", "x") for k in range(300)],
        (1000, "http://c", "long page " * 300_000, "x"),
    ]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string").repartition(3)


def expected(rows):
    out, least = [], {}
    payload = lambda r: (r.html or "").encode()
    for r in rows:
        if r.page_id is not None and len(payload(r)) >= 100:
            least[payload(r)] = min(r.page_id, least.get(payload(r), r.page_id))
    for r in rows:
        first = least.get(payload(r))
        revisit = first is not None and (r.page_id is None or r.page_id > first)
        digest = hashlib.sha256(payload(r)).hexdigest()
        out.append((r.page_id, len(payload(r)), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


@pytest.mark.parametrize("file_bytes", [1 << 26, 20_000])
def test_round_trip(spark, file_bytes):
    df = pages(spark)
    index = warc.write_warc(df, scratch_path(spark, "warc"), file_bytes=file_bytes)
    assert index.count() == df.count()
    back = warc.read_warc(index, payloads=True)
    assert rows_of(back) == expected(df.collect())
    want = sorted(((r.html or "") for r in df.collect()))
    bodies = {r.payload_digest: bytes(r.payload).decode() for r in back.filter("record_type = 'response'").collect()}
    assert sorted(bodies[hashlib.sha256(t.encode()).hexdigest()] for t in want) == want
    assert back.filter("record_type = 'revisit' AND payload IS NOT NULL").count() == 0


def test_shuffled_form(spark, tiny_broadcast):
    df = pages(spark)
    assert rows_of(warc.read_warc(warc.write_warc(df, scratch_path(spark, "warc")))) == expected(df.collect())


def test_each_record_can_be_read_alone(spark):
    index = warc.write_warc(pages(spark), scratch_path(spark, "warc")).collect()
    for r in index[:: 7]:
        record = warc.read_one(r.file, r.place, r.length)
        assert warc.page_row(record)[0] == r.page_id
        with open(r.file, "rb") as source:
            source.seek(r.place)
            assert struct.unpack("<I", source.read(4))[0] == 0xFD2FB528


def test_dictionary_leads_the_archive_and_pays(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    index = warc.write_warc(df, scratch_path(spark, "warc"))
    for r in index.select("file").distinct().collect():
        data = open(r.file, "rb").read()
        magic, length = struct.unpack("<II", data[:8])
        assert magic == 0x184D2A5D
        known = zstandard.ZstdCompressionDict(data[8 : 8 + length])
        assert known.dict_id() > 0
        assert zstandard.get_frame_parameters(data[8 + length :]).dict_id == known.dict_id()
        records = list(warc.read_archive(r.file))
        assert records[0].headers["warc-type"] == "warcinfo"
        plain = sum(len(zstandard.ZstdCompressor(level=3).compress(x.block)) for x in records)
        assert len(data) - length < 0.8 * plain
    assert rows_of(warc.read_warc(index)) == expected(df.collect())


def test_few_records_have_no_dictionary(spark):
    df = pages(spark).filter("page_id = 7").repartition(1)
    index = warc.write_warc(df, scratch_path(spark, "warc"))
    data = open(index.first().file, "rb").read()
    assert struct.unpack("<I", data[:4])[0] == 0xFD2FB528
    assert rows_of(warc.read_warc(index)) == expected(df.collect())


def test_empty_table(spark):
    index = warc.write_warc(pages(spark).filter("1 = 0"), scratch_path(spark, "warc"))
    assert index.count() == 0 and warc.read_warc(index).count() == 0


def test_record_ids_hold_the_page():
    for page in (0, 1, -1, 65_535, 65_536, 1 << 62, -(1 << 63), (1 << 63) - 1, None):
        assert warc.page_of(warc.record_id(page, "ab" * 32)) == page
    assert warc.record_id(5, "ab" * 32) != warc.record_id(5, "cd" * 32)


def test_damage_is_noticed():
    digest = hashlib.sha256(b"body").hexdigest()
    whole = warc.page_record(1, "u", b"body", digest, None, False, "2024-01-01T00:00:00Z")
    assert warc.page_row(warc.next_record(io.BytesIO(whole)))[2:5] == ("response", 4, digest)
    with pytest.raises(ValueError):
        warc.page_row(warc.next_record(io.BytesIO(whole.replace(b"body", b"bode"))))
    with pytest.raises(ValueError):
        warc.next_record(io.BytesIO(whole[:-6]))
