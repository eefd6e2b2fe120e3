"""Seekable bundles: the format, exact round trips, revisits, single records."""

import base64
import glob
import hashlib
import io

import pytest
import zstandard

from stagecheck.llm import warc

LONG = "<p>" + "x" * 1200


class Kept(io.BytesIO):
    def close(self):
        pass


def bundle(records, frame_bytes=100):
    file = Kept()
    writer = warc.BundleWriter(file, frame_bytes)
    places = [writer.add(r) for r in records]
    writer.close()
    return file, places


def test_bundle_is_plain_zstandard_and_seekable():
    records = [bytes([65 + i]) * size for i, size in enumerate((40, 50, 60, 300, 1, 99, 100))]
    file, places = bundle(records)
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(file.getvalue()), read_across_frames=True).read()
    assert whole == b"".join(records)
    frames = warc.seek_table(file)
    assert [f.plain_size for f in frames] == [90, 60, 300, 100, 100]
    for record, (frame, offset) in zip(records, places):
        assert warc.read_frame(file, frames[frame])[offset : offset + len(record)] == record
    assert warc.seek_table(bundle([])[0]) == []


def test_damage_is_noticed():
    file, _ = bundle([b"abc" * 50, b"def" * 50])
    data = bytearray(file.getvalue())
    with pytest.raises(ValueError):
        warc.seek_table(io.BytesIO(bytes(data[:-1])))
    with pytest.raises(ValueError):
        warc.seek_table(io.BytesIO(b"short"))
    frames = warc.seek_table(file)
    wrong = frames[0]._replace(checksum=frames[0].checksum ^ 1)
    with pytest.raises(ValueError):
        warc.read_frame(file, wrong)


def test_record_round_trip():
    digest = hashlib.sha1(b"\r\n\r\nbody\r\n").digest()
    made = warc.build_record("a b\r\n", "http://x/\n?é%20", b"\r\n\r\nbody\r\n", digest, None)
    record, end = warc.parse_record(made)
    assert end == len(made) and record.payload == b"\r\n\r\nbody\r\n"
    assert record.fields["WARC-Target-URI"] == "http://x/%0A?%C3%A9%20"
    assert base64.b32decode(record.fields["WARC-Payload-Digest"][5:]) == digest
    revisit, _ = warc.parse_record(warc.build_record("2", None, b"full text", digest, "1"))
    assert (revisit.fields["WARC-Type"], revisit.payload, revisit.payload_bytes) == ("revisit", b"", 9)
    assert revisit.fields["WARC-Refers-To"] == warc.record_id("1", digest)


def pages(spark):
    rows = [(1, "http://a/", LONG), (2, None, LONG), (3, "u\r\nX: y", LONG), (4, "u", "short"), (5, "u", "short"), (6, "u", None),
            (7, "u", ""), (None, "u", LONG), (8, "u", "é" * 500), (9, "u", "é" * 500), (10, "u", "é" * 499), (11, "u", "é" * 499),
            (12, "u", "z" * 3_000_000)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string")


def expected(rows):
    greatest = {}
    for key, _, html in rows:
        if key is not None:
            greatest[html or ""] = max(key, greatest.get(html or "", key))
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        lead = greatest.get(html or "")
        revisit = len(data) >= 1000 and lead is not None and lead != key
        out.append((key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", lead if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("most_sent", [400_000, 0])
def test_archive(spark, tmp_path, monkeypatch, most_sent):
    monkeypatch.setattr(warc, "MOST_SENT", most_sent)
    rows, df = pages(spark)
    path = str(tmp_path / "archive")
    index = warc.write_archive(df.repartition(3), path, frame_bytes=3000, bundle_bytes=2000)
    assert index.count() == len(rows)
    back = warc.read_archive(spark, path, with_payload=True)
    got = back.select("key", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)
    for r in back.collect():
        assert (r.payload is None) == (r.record_type == "revisit")
    payloads = {r.record_id: bytes(r.payload) for r in warc.fetch_payloads(spark, path, index).collect()}
    digests = {r.record_id: r.payload_digest for r in back.collect()}
    assert payloads.keys() == digests.keys()
    assert all(hashlib.sha1(p).hexdigest() == digests[i] for i, p in payloads.items())
    with pytest.raises(ValueError):
        warc.write_archive(df, path)


def test_files_of_lost_tasks_are_not_read(spark, tmp_path):
    _, df = pages(spark)
    path = str(tmp_path / "archive")
    warc.write_archive(df.coalesce(1), path)
    (tmp_path / "archive" / "bundle-lost.warc.zst").write_bytes(b"cut off")
    assert warc.read_archive(spark, path).count() == 13
    assert warc.drop_strays(spark, path) == 1
    assert len(glob.glob(f"{path}/bundle-*")) == 1


def test_ties_types_and_empty(spark, tmp_path):
    rows = [("k2", LONG), ("k2", LONG), ("k1", LONG), ("k%\r\n", "q" * 1000), (None, "w" * 2000), (None, "w" * 2000)]
    df = spark.createDataFrame(rows, "page_id string, html string").selectExpr("page_id", "CAST(NULL AS string) AS url", "html", "1 AS frame")
    warc.write_archive(df, str(tmp_path / "ties"))
    got = sorted(((r.key, r.record_type, r.refers_to) for r in warc.read_archive(spark, str(tmp_path / "ties")).collect()), key=str)
    assert got == sorted([("k2", "response", None)] * 2 + [("k1", "revisit", "k2"), ("k%\r\n", "response", None)] + [
        (None, "response", None)] * 2, key=str)
    warc.write_archive(df.where("false"), str(tmp_path / "empty"))
    assert warc.read_archive(spark, str(tmp_path / "empty")).count() == 0
