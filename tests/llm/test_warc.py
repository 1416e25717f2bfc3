import base64
import hashlib
import struct

import pytest
from pyspark.sql import types as T

from dwkit.llm import warc

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                      T.StructField("id", T.StringType()), T.StructField("sha", T.StringType()), T.StructField("first", T.LongType())])


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], PAGES)


ROWS = [(i, f"http://h/{i}", f"<p>page {i % 7}</p>") for i in range(40)] + [
    (50, None, None), (51, "http://e/", ""), (52, "a b\r\nc", "é" * 50_000), (None, "http://n/", "only here"), (3, "http://h/3", "<p>page 3</p>"),
    (None, "u", "<p>page 1</p>")]


def want(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        raw, f = (h or "").encode(), first.get(h or "")
        revisit = f is not None and i != f
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response",
                    f if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    got = warc.round_trip(pages(spark, ROWS)).collect()
    assert sorted(map(tuple, got), key=str) == want(ROWS)
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_smaller_payloads_are_all_responses(spark):
    got = warc.round_trip(pages(spark, ROWS), min_bytes=14).collect()
    assert all(r.record_type == "response" for r in got)


def archive(n=500):
    w = warc.ArchiveWriter()
    for i in range(n):
        w.add(warc.make_record(i, f"http://x/{i}", f"<html>payload number {i} of many {i * i}</html>".encode(), None, False))
    return w.close()


def test_archive_starts_with_its_dictionary_and_has_a_frame_per_record():
    data = archive()
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D and data[8 + size:12 + size] == warc.FRAME
    got = list(warc.read_archive(data))
    assert [r.get("id") for r in got] == [None, *range(500)]
    assert len(list(warc.read_archive(archive(0)))) == 1


def test_damage_is_found():
    data = archive(20)
    with pytest.raises(ValueError):
        list(warc.read_archive(data[8:]))
    with pytest.raises(ValueError):
        list(warc.read_archive(data[:-5]))
    good = warc.make_record(1, "http://x/", b"payload", None, False)
    for bad in (good[:-1], good.replace(b"payload", b"pAyload"), good.replace(b"WARC-Date", b"WARC-Dote"), good.replace(b"WARC/1.1", b"WARC/9")):
        with pytest.raises(ValueError):
            warc.parse_record(bad)
