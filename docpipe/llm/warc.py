"""Dictionary-compressed WARC archives.

Each archive holds the records of one stretch of input rows. A Zstandard dictionary is built from those
records themselves and written raw into a leading skippable frame; then every record is a frame of its own,
so a record can be read alone with the dictionary at hand. Rows with a payload seen before become revisit
records that name the response record and carry no payload.

Tasks write archives under names of their own attempt and return a row per finished archive; these rows are
a written table (the manifest), and readers open only what it lists. What a lost or repeated attempt leaves
behind is therefore never read.

Defined results: a null payload is empty. Of rows with equal payloads, those with the smallest key are
responses (several rows, if that key is repeated) and the others refer to it; a null key is larger than any
other. A null URL leaves the header out; control characters and blanks in a URL are percent-encoded. An
empty table writes no archive. A payload longer than ``ARCHIVE_BYTES`` has an archive to itself.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpipe.llm.tables import parts_for, stored
from docpipe.llm.words import by_size

ARCHIVE_BYTES = 8 << 20
DICTIONARY_BYTES = 64 << 10
SKIPPABLE = 0x184D2A5D
BROADCAST_GROUPS = 500_000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = ("record_key long, url string, record_type string, refers_to long, payload_digest string, "
           "payload_bytes long, payload binary, archive string")


def _quoted(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _record(kind: str, name: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {DATE}"]
    lines += [f"{key}: {value}" for key, value in headers]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _name(key: int | None) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def page_record(key: int | None, url: str | None, payload: bytes, digest: bytes, first: int | None,
                revisit: bool) -> bytes:
    """A response record, or a revisit of the record with key ``first``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = [] if url is None else [("WARC-Target-URI", _quoted(url))]
    headers.append(("WARC-Payload-Digest", f"sha1:{base64.b32encode(digest).decode()}"))
    if revisit:
        headers += [("WARC-Refers-To", _name(first)), ("WARC-Profile", PROFILE)]
    headers.append(("Content-Type", "application/http; msgtype=response"))
    block = http.encode() + (b"" if revisit else payload)
    return _record("revisit" if revisit else "response", _name(key), headers, block)


def dictionary_of(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on all records; of too little material, their bytes themselves are the dictionary."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, k=512, d=8)
    except zstandard.ZstdError:
        raw = b"".join(records)[:DICTIONARY_BYTES]
        return zstandard.ZstdCompressionDict(raw.ljust(8, b"\r"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def pack(records: list[bytes]) -> bytes:
    """An archive: the dictionary in a skippable frame, then a frame for each record."""
    dictionary = dictionary_of(records)
    raw = dictionary.as_bytes()
    compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=True)
    return b"".join([struct.pack("<II", SKIPPABLE, len(raw)), raw, *map(compressor.compress, records)])


def unpack(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record, in order."""
    magic, size = struct.unpack_from("<II", archive)
    if magic != SKIPPABLE:
        raise ValueError("the archive does not begin with a dictionary frame")
    raw = archive[8:8 + size]
    trained = raw[:4] == b"\x37\xa4\x30\xec"
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind))
    frames = io.BytesIO(memoryview(archive)[8 + size:])
    stream = io.BufferedReader(decompressor.stream_reader(frames, read_across_frames=True), 1 << 20)
    while line := stream.readline():
        if line.rstrip() != b"WARC/1.1":
            raise ValueError(f"a record begins with {line[:40]!r}")
        headers = {}
        while line := stream.readline().rstrip(b"\r\n"):
            key, _, value = line.decode().partition(": ")
            headers[key] = value
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where it says")
        yield headers, block


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)

        def save(records: list[bytes]) -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.zst"
            info = _record("warcinfo", f"<urn:archive:{name}>", [("Content-Type", "application/warc-fields")],
                           b"format: WARC File Format 1.1\r\n")
            data = pack([info, *records])
            with files.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(data)
            return pa.record_batch(
                [[f"{folder}/{name}"], [len(records)], [len(data)]], names=["archive", "records", "bytes"])

        held, size = [], 0
        for whole in batches:
            for batch in by_size(whole, 2):
                for row in batch.to_pylist():
                    payload = row["payload"] or b""
                    if held and size + len(payload) > ARCHIVE_BYTES:
                        yield save(held)
                        held, size = [], 0
                    held.append(page_record(row["key"], row["url"], payload, bytes.fromhex(row["digest"]),
                                            row["first"], row["revisit"]))
                    size += len(held[-1])
        if held:
            yield save(held)

    return run


def write_archives(df: DataFrame, key: str, url: str, payload: str, folder: str) -> DataFrame:
    """Writes a record per row of ``df`` below ``folder`` (any place pyarrow can write to that all
    executors share). Returns the manifest: archive, records, bytes."""
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"),
                     F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    groups = rows.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = stored(groups.where("n > 1").drop("n"), "payload-groups")
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)  # 50 MB at most; beyond that a join that splits hot digests
    known = rows.join(groups, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    known = known.select("key", "url", "payload", "digest", "first", again.alias("revisit"))
    return stored(known.mapInArrow(_write(folder.rstrip("/")), "archive string, records long, bytes long"), "manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def key_of(name: str) -> int | None:
        digits = name.removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    names = [field.split()[0] for field in RECORDS.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[field.split()[1]]) for n, field in zip(names, RECORDS.split(", "), strict=True)])
    for batch in batches:
        for archive in batch.column(0).to_pylist():
            files, path = pyarrow.fs.FileSystem.from_uri(archive)
            with files.open_input_stream(path, compression=None) as source:
                content = source.read()
            rows = []
            for headers, block in unpack(content):
                if headers["WARC-Type"] == "warcinfo":
                    continue
                http, _, payload = block.partition(b"\r\n\r\n")
                length = next(int(line[16:]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length: "))
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                revisit = headers["WARC-Type"] == "revisit"
                if not revisit and (base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != length):
                    raise ValueError(f"the payload of {headers['WARC-Record-ID']} in {archive} is damaged")
                rows.append((key_of(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), headers["WARC-Type"],
                             key_of(headers["WARC-Refers-To"]) if revisit else None, digest, length,
                             None if revisit else payload, archive))
            for i in range(0, len(rows), 1000):
                columns = zip(*rows[i:i + 1000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of all archives in the manifest; payloads of responses are held against their digests."""
    spark = manifest.sparkSession
    count = manifest.count()
    parts = min(max(count, 1), parts_for(spark, count, 16))
    return manifest.select("archive").repartition(parts).mapInArrow(_read, RECORDS)

