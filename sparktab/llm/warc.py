"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing: the text sink of Spark writes each row's bytes and then a line separator.  The separator
used here is an empty skippable frame, which every Zstandard reader passes over; so the files are
valid archives on any file system that Spark can write to, and Spark's commit protocol keeps
half-written files of lost executors out.  One archive per task.

Reading: an archive's dictionary is taken from its leading skippable frame (kept raw, or itself
compressed), then every frame is decoded on its own and must hold exactly one record, whose version
line, named fields, lengths and digests are validated.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.llm.common import bounded, hash_sample

# Fixed values of the two formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
SEPARATOR = "P*M\x18\x00\x00\x00\x00"       # an empty skippable frame, all of it ASCII
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

SAMPLE_RECORDS = 1000
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
MIN_REVISIT_BYTES = 1000


class WarcError(ValueError):
    """An archive or a record that breaks its format."""


# -- one record --------------------------------------------------------------------------------
def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(uri: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(m.group(1)) if m else None


def digest_field(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A ``response`` with its payload, or a ``revisit`` that holds the response headers alone."""
    revisit = refers_to is not None
    digest = digest_field(hashlib.sha1(payload).digest())
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = head if revisit else head + payload
    uri = re.sub(r"[\x00-\x20\x7f<>\"]", lambda m: f"%{ord(m.group()):02X}", url or "urn:none")
    named = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", date),
             ("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest), ("WARC-Block-Digest", digest_field(hashlib.sha1(block).digest()))]
    if revisit:
        named += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    named += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named) + "\r\n").encode() + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name or name.strip() != name:
            raise WarcError(f"malformed named field {line[:60]!r}")
        out[name.decode("utf-8")] = value.strip().decode("utf-8")
    return out


def parse_record(data: bytes) -> dict:
    """Validate one record and return its fields, payload length, payload digest and payload."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise WarcError(f"no WARC record at {data[:40]!r}")
    named = _fields(lines[1:])
    for k in REQUIRED:
        if not named.get(k):
            raise WarcError(f"field {k} is missing")
    if not re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,9})?Z", named["WARC-Date"]):
        raise WarcError(f"bad WARC-Date {named['WARC-Date']!r}")
    if not re.fullmatch(r"\d+", named["Content-Length"]):
        raise WarcError(f"bad Content-Length {named['Content-Length']!r}")
    size = int(named["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"Content-Length {size}, but {max(0, len(rest) - 4)} bytes in the record")
    block = rest[:size]
    if (d := named.get("WARC-Block-Digest")) and d != digest_field(hashlib.sha1(block).digest()):
        raise WarcError("block digest differs")
    out = {"type": named["WARC-Type"], "fields": named, "payload": None, "payload_bytes": size, "payload_digest": None}
    if not named.get("Content-Type", "").startswith("application/http"):
        out["payload"], out["payload_digest"] = block, hashlib.sha1(block).hexdigest()
        return out
    http, gap, payload = block.partition(b"\r\n\r\n")
    http_lines = http.split(b"\r\n")
    if not gap or not http_lines[0].startswith(b"HTTP/"):
        raise WarcError("no HTTP header in the block")
    length = _fields(http_lines[1:]).get("Content-Length", "")
    said = named.get("WARC-Payload-Digest", "")
    if out["type"] == "revisit":
        if payload or not length.isdigit() or not said.startswith("sha1:") or not named.get("WARC-Refers-To"):
            raise WarcError("a revisit needs a digest, a length, the record it refers to, and no payload")
        out["payload_bytes"] = int(length)
        out["payload_digest"] = base64.b32decode(said[5:]).hex()
        return out
    if length and length != str(len(payload)):
        raise WarcError(f"HTTP Content-Length {length}, but {len(payload)} bytes of payload")
    sha1 = hashlib.sha1(payload).digest()
    if said and said != digest_field(sha1):
        raise WarcError("payload digest differs")
    return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": sha1.hex()}


# -- frames ------------------------------------------------------------------------------------
def frame_end(buf: memoryview, at: int) -> int:
    """End of the Zstandard frame at ``at``, from its header and block headers."""
    try:
        descriptor = buf[at + 4]
        single = descriptor >> 5 & 1
        size = (0, 2, 4, 8)[descriptor >> 6] or single
        p = at + 5 + (1 - single) + (0, 1, 2, 4)[descriptor & 3] + size
        while True:
            b = buf[p] | buf[p + 1] << 8 | buf[p + 2] << 16
            kind = b >> 1 & 3
            if kind == 3:
                raise WarcError("reserved block type")
            p += 3 + (1 if kind == 1 else b >> 3)
            if b & 1:
                break
    except IndexError:
        raise WarcError("archive is cut off inside a frame") from None
    p += 4 if descriptor >> 2 & 1 else 0
    if p > len(buf):
        raise WarcError("archive is cut off inside a frame")
    return p


def read_archive(content: bytes) -> Iterator[tuple[int, bytes]]:
    """``(offset, record bytes)`` of an archive; the leading skippable frame holds the dictionary."""
    import zstandard
    buf = memoryview(content)
    if len(buf) < 8:
        raise WarcError("archive is too short")
    magic, size = struct.unpack_from("<II", buf, 0)
    at, dictionary = 0, None
    if magic == DICTIONARY_MAGIC:
        if 8 + size > len(buf):
            raise WarcError("archive is cut off inside the dictionary")
        raw = bytes(buf[8:8 + size])
        if raw[:4] == struct.pack("<I", FRAME_MAGIC):
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=1 << 27)
        dictionary = zstandard.ZstdCompressionDict(raw) if raw else None
        at = 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(buf):
        if at + 8 > len(buf):
            raise WarcError("trailing bytes")
        magic, size = struct.unpack_from("<II", buf, at)
        if magic in SKIPPABLE:
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise WarcError(f"no frame at byte {at}")
        end = frame_end(buf, at)
        try:
            yield at, reader.decompressobj().decompress(bytes(buf[at:end]))
        except zstandard.ZstdError as e:
            raise WarcError(f"frame at byte {at}: {e}") from None
        at = end


# -- Spark -------------------------------------------------------------------------------------
def train_dictionary(pages: DataFrame, sample_records: int = SAMPLE_RECORDS, size: int = DICTIONARY_BYTES,
                     id_col: str = "page_id", payload_col: str = "html", max_chars: int = 16384) -> bytes:
    """Dictionary from the ``sample_records`` pages of smallest id hash (at most ``max_chars``
    characters of each, which bounds what reaches the driver); empty where they are too few."""
    import zstandard
    rows = hash_sample(pages.select(id_col, F.substring(payload_col, 1, max_chars).alias("p")), sample_records, id_col).collect()
    samples = sorted(r["p"].encode() for r in rows if r["p"])
    total = sum(map(len, samples))
    if len(samples) < 16 or total < 32768:
        return b""
    try:
        return zstandard.train_dictionary(min(size, total // 8), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``page_id, url, html, refers_to``: among equal payloads of ``MIN_REVISIT_BYTES`` or more the
    largest page_id is the response, the others refer to it.  Rows that share that id are all
    responses; a null id never is one, unless all are null."""
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(payload_col).alias("html"))
    p = p.withColumn("digest", F.sha1(F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))))
    first = (p.filter(F.length(F.encode("html", "UTF-8")) >= MIN_REVISIT_BYTES).groupBy("digest")
             .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    return p.join(first, "digest", "left").select(
        "page_id", "url", "html", F.when(F.col("page_id").eqNullSafe(F.col("response")), None).otherwise(F.col("response")).alias("refers_to"))


def write_archives(records: DataFrame, path: str, dictionary: bytes, date: str = "1970-01-01T00:00:00Z", level: int = LEVEL) -> None:
    """Write ``page_id, url, html, refers_to`` rows as archives under ``path``, one per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        writer = zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=True, write_content_size=True)
        head = [struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary]
        for b in batches:
            if b.num_rows:
                frames = head + [writer.compress(build_record(p, u, (h or "").encode(), r, date))
                                 for p, u, h, r in zip(*(b.column(i).to_pylist() for i in range(4)))]
                head = []
                yield pa.record_batch([pa.array(frames, pa.binary())], names=["frame"])
    frames = bounded(records).select("page_id", "url", "html", "refers_to").mapInArrow(run, "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)


def read_archives(spark: SparkSession, path: str, glob: str = "part-*") -> DataFrame:
    """Records of the archives under ``path``: ``archive, offset, record_type, page_id, url,
    refers_to, payload_bytes, payload_digest`` (bare hex SHA-1) ``, payload``.  A broken archive or
    record fails the read, with its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["archive", "offset", "record_type", "page_id", "url", "refers_to", "payload_bytes", "payload_digest", "payload"]
        types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

        def out(rows):
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows, held = [], 0
                at = 0
                try:
                    for at, data in read_archive(content.as_py()):
                        r = parse_record(data)
                        f = r["fields"]
                        rows.append((name, at, r["type"], page_of(f["WARC-Record-ID"]), f.get("WARC-Target-URI"),
                                     page_of(f.get("WARC-Refers-To")), r["payload_bytes"], r["payload_digest"], r["payload"]))
                        held += len(data)
                        if held > 8 << 20:
                            yield out(rows)
                            rows, held = [], 0
                except WarcError as e:
                    raise WarcError(f"{name} at byte {at}: {e}") from None
                if rows:
                    yield out(rows)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).filter("length > 0")
    return bounded(files).select("path", "content").mapInArrow(
        run, "archive string, offset long, record_type string, page_id long, url string, refers_to long, "
             "payload_bytes long, payload_digest string, payload binary")
