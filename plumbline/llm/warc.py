"""Dictionary-compressed WARC archives.

Records follow WARC/1.1: an HTTP response for the first of equal payloads, and a revisit (identical payload digest)
without payload for the others. Every record is a zstandard frame of its own, made with a dictionary that was trained
on a bounded sample of whole records; the dictionary opens each archive in a skippable frame (magic 0x184D2A5D), so an
archive can be read by itself, from its beginning or at any record's offset once the dictionary is loaded.

Which record is a revisit is settled before anything is written: payloads of at least ``REVISIT_BYTES`` are grouped by
digest, length and a second hash, only groups of several rows are kept, and these are joined back. The join puts both
sides through an exchange of their own, so AQE can split a payload that many rows share.

A task writes archives of about ``ARCHIVE_BYTES`` (before compression) under names of its own; the manifest names those
of the attempts that counted.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.store import filesystem, keep, map_arrow, shared_dir

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 32 << 20
DICT_BYTES = 64 * 1024
#: Whole records that the dictionary is trained on: so many of the least hashes, as long as they add up to these bytes.
SAMPLE, SAMPLE_TOTAL = 800, 32 << 20
LEVEL = 3
DATE = "2000-01-01T00:00:00Z"  # of every record: the table has no fetch times
_SKIPPABLE = 0x184D2A5D
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id, which: str) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}:{which}>"


def record(page_id, url: str | None, payload: bytes | None, digest: str, size: int, refers_to=None) -> bytes:
    """The plain bytes of one record; a payload of None makes a revisit to ``refers_to``."""
    uri = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "about:blank")
    sha = base64.b32encode(bytes.fromhex(digest)).decode()
    # What revisits refer to is named by id and payload; all other records, repeats of an id too, by themselves.
    own = digest if payload is not None and size >= REVISIT_BYTES and page_id is not None else uuid.uuid4().hex
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    kind = "response" if payload is not None else "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id, own)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{sha}"]
    if payload is None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, payload) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    warc = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(warc["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def train(samples: list[bytes]) -> bytes:
    """A dictionary from sample records; where they are too few to train on, their own bytes serve."""
    import zstandard as z

    total = sum(map(len, samples))
    try:
        return z.train_dictionary(min(DICT_BYTES, max(1024, total // 8)), samples).as_bytes()
    except z.ZstdError:
        return (b"".join(samples))[-DICT_BYTES:] or b"WARC/1.1\r\nWARC-Type: response\r\n"


class Writer:
    """One archive in memory: the dictionary's frame, then a frame per record."""

    def __init__(self, dictionary: bytes):
        import zstandard as z

        made = z.ZstdCompressionDict(dictionary)
        made.precompute_compress(level=LEVEL)
        self._compress = z.ZstdCompressor(dict_data=made, write_content_size=True).compress
        plain = z.ZstdCompressor(level=19).compress(dictionary)
        self.parts, self.plain, self.size = [struct.pack("<II", _SKIPPABLE, len(plain)) + plain], 0, 8 + len(plain)

    def add(self, data: bytes) -> tuple[int, int]:
        """Offset and length of the record's frame."""
        frame = self._compress(data)
        at = self.size
        self.parts.append(frame)
        self.plain += len(data)
        self.size += len(frame)
        return at, len(frame)


def read_archive(stream, chunk: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(offset, plain record) of every frame of an archive, read in chunks: one record is held at a time."""
    import zstandard as z

    magic, size = struct.unpack("<II", stream.read(8))
    if magic != _SKIPPABLE:
        raise ValueError("the archive does not begin with a dictionary")
    tool = z.ZstdDecompressor(dict_data=z.ZstdCompressionDict(z.ZstdDecompressor().decompress(stream.read(size))))
    data, at = b"", 8 + size
    ended = False
    while True:
        if not data and not ended:
            data = stream.read(chunk)
            ended = not data
        if not data:
            return
        frame, parts, used = tool.decompressobj(), [], 0
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                used += len(data) - len(frame.unused_data)
                data = frame.unused_data
                break
            used += len(data)
            data = stream.read(chunk)
            if not data:
                raise ValueError("the archive is cut short")
        yield at, b"".join(parts)
        at += used


_MANIFEST = "path string, n_records long, bytes long, plain_bytes long"


def _write_batches(folder: str, sent, archive_bytes: int):
    schema = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("bytes", pa.int64()), ("plain_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        writer, n = None, 0

        def flush() -> pa.RecordBatch:
            nonlocal writer, n
            name = f"{uuid.uuid4().hex}.warc.zst"
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(f"{root}/{name}") as out:
                for part in writer.parts:
                    out.write(part)
            row = [f"{folder}/{name}"], [n], [writer.size], [writer.plain]
            writer, n = None, 0
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            page, url, html, digest, size, refers, revisit = (batch.column(c) for c in ("page_id", "url", "html", "digest", "size", "refers_to", "revisit"))
            for i in range(batch.num_rows):
                writer = writer or Writer(sent.value)
                body = None if revisit[i].as_py() else (html[i].as_py() or "").encode("utf-8", "surrogatepass")
                writer.add(record(page[i].as_py(), url[i].as_py(), body, digest[i].as_py(), size[i].as_py(), refers[i].as_py()))
                n += 1
                if writer.plain >= archive_bytes:
                    yield flush()
        if writer:
            yield flush()

    return run


def write(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every row of ``pages(page_id, url, html)``; returns the manifest, a written table.

    A null html is an empty payload, a null url ``about:blank``; a null page_id gets a response record of its own that
    no revisit refers to. Repeated rows of one page_id are a record each: of equal payloads, the row of the largest
    page_id (one of its repeats) is the response, all others are revisits. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or shared_dir(spark)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html").cast("long"))
    rows = rows.withColumn("key", F.when((F.col("size") >= REVISIT_BYTES) & F.col("page_id").isNotNull(), F.concat_ws(":", "digest", "size", F.hex(F.xxhash64("html")))))
    # Grouped by a struct, so that the join below gets an exchange of its own on this side, too.
    shared = rows.where("key is not null").groupBy(F.struct("key").alias("k")).agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("k.key").alias("key"), "first")
    joined = rows.join(shared, "key", "left")
    # A repeated largest id: one of its rows stays the response.
    repeated = rows.where("key is not null").groupBy("page_id", "key").count().where("count > 1").select("page_id", "key").withColumn("again", F.lit(True))
    is_revisit = F.coalesce(F.col("first") != F.col("page_id"), F.lit(False))
    settled = joined.withColumn("revisit", is_revisit).withColumn("refers_to", F.when(is_revisit, F.col("first")))
    if not repeated.isEmpty():
        from pyspark.sql import Window

        place = F.row_number().over(Window.partitionBy("page_id", "key").orderBy("url"))
        settled = settled.withColumn("place", place).withColumn("revisit", F.col("revisit") | ((F.col("place") > 1) & F.col("key").isNotNull()))
        settled = settled.withColumn("refers_to", F.when(F.col("revisit"), F.coalesce("first", "page_id")))
    # The least hashes are found without any payload; about four times the sample is looked at.
    total = pages.count()
    hashed = rows.withColumn("h", F.xxhash64("page_id", "url", "digest"))
    few = hashed.where(F.col("h").cast("double") <= (2 * min(1.0, 4 * SAMPLE / max(1, total)) - 1) * 2.0**63)
    wanted, size = [], 0
    for r in few.groupBy("h").agg(F.min("size").alias("size")).orderBy("h").limit(SAMPLE).collect():
        if size + r["size"] <= SAMPLE_TOTAL:  # a record that doesn't fit any more is not in the sample
            wanted.append(r["h"])
            size += r["size"]
    one = F.min(F.struct("page_id", "url", "digest", "size")).alias("r"), F.min("html").alias("html")
    picked = hashed.where(F.col("h").isin(wanted)).groupBy("h").agg(*one).orderBy("h").collect() if wanted else []
    sample = [record(p["r"]["page_id"], p["r"]["url"], p["html"].encode("utf-8", "surrogatepass"), p["r"]["digest"], p["r"]["size"]) for p in picked]
    sent = spark.sparkContext.broadcast(train(sample))
    columns = settled.select("page_id", "url", F.when(~F.col("revisit"), F.col("html")).alias("html"), "digest", "size", "refers_to", "revisit")
    return keep(map_arrow(columns, _write_batches(folder, sent, archive_bytes), _MANIFEST))


_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, archive string, offset long"


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("archive", pa.string()), ("offset", pa.int64())])
    number = lambda urn: None if urn is None or urn.startswith("<urn:page:none:") else int(urn.split(":")[2])
    for batch in batches:
        for path in batch.column(0).to_pylist():
            fs, place = filesystem(path)
            rows = []
            with fs.open_input_stream(place) as stream:
                for at, data in read_archive(stream):
                    warc, http, payload = parse(data)
                    kind = warc["WARC-Type"]
                    digest = base64.b32decode(warc["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(http["Content-Length"])):
                        raise ValueError(f"{path}, {at}: the payload does not match its digest")
                    rows.append((number(warc["WARC-Record-ID"]), int(http["Content-Length"]), digest, kind, number(warc.get("WARC-Refers-To")), warc["WARC-Target-URI"], path, at))
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def read(manifest: DataFrame) -> DataFrame:
    """Every record of the archives that a manifest names; each payload is checked against its digest."""
    tasks = max(1, min(manifest.count(), int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return map_arrow(manifest.select("path").repartition(tasks), _read_batches, _RECORD)
