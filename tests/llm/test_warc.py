import base64
import hashlib
import struct

import zstandard

from docpipe.llm import warc

PAGES = "page_id long, url string, html string, digest string, first string, archive string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d", "f", "a") for r in rows], PAGES).repartition(3)


def brute(rows):
    firsts = {}
    for key, _, html in rows:
        if key is not None:
            firsts[html or ""] = min(firsts.get(html or "", key), key)
    out = []
    for key, url, html in rows:
        data = (html or "").encode()
        first = firsts.get(html or "")
        again = first is not None and key != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((key, "revisit" if again else "response", first if again else None, digest, len(data)))
    return sorted(out, key=repr)


def written(spark, rows, tmp_path):
    manifest = warc.write_archives(pages(spark, rows), "page_id", "url", "html", f"file://{tmp_path}/warc")
    return manifest, warc.read_archives(manifest)


def test_round_trip(spark, tmp_path):
    rows = [(i, f"http://h.org/{i}", f"<p>text {i % 40} wörld</p>" * (i % 7)) for i in range(200)]
    rows += [(500, None, None), (501, "http://h.org/a b\r\nX: y", ""), (None, "http://n", "own"), (None, "http://n", "<p>text 1 wörld</p>")]
    rows += [(600, "u", "x" * 9_000_000), (601, "u", "x" * 9_000_000), (3, "again", rows[3][2])]
    manifest, records = written(spark, rows, tmp_path)
    got = records.collect()
    assert sorted(((r["record_key"], r["record_type"], r["refers_to"], r["payload_digest"], r["payload_bytes"]) for r in got), key=repr) == brute(rows)
    text = {(r[0], r[2] or "") for r in rows}
    assert all((r["record_key"], bytes(r["payload"]).decode()) in text for r in got if r["record_type"] == "response")
    assert all(r["payload"] is None for r in got if r["record_type"] == "revisit")
    assert next(r["url"] for r in got if r["record_key"] == 501) == "http://h.org/a%20b%0D%0AX:%20y"
    assert manifest.count() > 1 and sum(r["records"] for r in manifest.collect()) == len(rows)


def test_each_record_is_a_frame_of_its_own(spark, tmp_path):
    manifest, _ = written(spark, [(i, "http://h.org/", f"page {i} " * 50) for i in range(60)], tmp_path)
    with open(manifest.first()["archive"].removeprefix("file://"), "rb") as source:
        data = source.read()
    magic, size = struct.unpack_from("<II", data)
    assert magic == warc.SKIPPABLE and 0x184D2A50 <= magic <= 0x184D2A5F
    dictionary = zstandard.ZstdCompressionDict(data[8:8 + size])
    stream = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
    first = stream.decompress(data[8 + size:])
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    second = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj().decompress(stream.unused_data)
    assert second.count(b"WARC/1.1") == 1 and b"WARC-Type: response" in second


def test_a_lost_attempt_is_not_read(spark, tmp_path):
    manifest, records = written(spark, [(1, "u", "a"), (2, "u", "b")], tmp_path)
    (tmp_path / "warc" / "orphan.warc.zst").write_bytes(b"half")
    assert records.count() == 2


def test_empty_table(spark, tmp_path):
    manifest, records = written(spark, [], tmp_path)
    assert manifest.count() == 0 and records.count() == 0
