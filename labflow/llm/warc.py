"""Archives of web records: a Zstandard dictionary in a leading skippable frame, then one frame per record.

An archive is one file: a skippable frame that holds the dictionary, the frame of a ``warcinfo`` record, one frame per
record, and a last skippable frame. Any Zstandard reader that is given the dictionary reads it. Files are written by
Spark's own writer, so they go to any store that Spark writes to and survive the loss of executors: it writes rows of
text, ends each with a line break, and puts each row into a file of its own. A row is one whole archive whose last
skippable frame announces one byte of content, which is that line break.
"""

import base64
import hashlib
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labflow.llm.common import Scratch, ship_package, spread_sample

# Fixed values of the archive and frame formats.
DICTIONARY_MAGIC = (0x184D2A5D).to_bytes(4, "little")
FILLER_MAGIC = (0x184D2A50).to_bytes(4, "little")
FRAME_MAGIC = (0xFD2FB528).to_bytes(4, "little")
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = "WARC/1.1"

DICTIONARY_BYTES = 64 << 10
SAMPLE_ROWS = 1000
SAMPLE_CHARS = 16 << 10
ARCHIVE_BYTES = 8 << 20
FEED = 16 << 10
DATE = "2024-01-01T00:00:00Z"
READ = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("archive", T.StringType()),
    ]
)


def with_originals(pages, smallest=0):
    """Add ``sha1`` (hex), ``original`` (page_id of the first record with an equal payload) and ``is_original``.

    Payload: the html in UTF-8, empty for null. Among equal payloads of at least ``smallest`` bytes those with the
    smallest page_id (null counts as larger than any) are originals: one row, unless rows repeat id and payload. Smaller
    payloads are all originals. Only payloads that occur twice are joined back, by their digest and size. Spark splits a
    digest that many rows have when it joins, and the aggregation sends one row per digest and task.
    """
    own = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html").select(
        "*", F.sha1(own).alias("sha1"), F.octet_length(own).cast("bigint").alias("payload_bytes")
    )
    repeated = (
        rows.where(F.col("payload_bytes") >= smallest)
        .groupBy("sha1", "payload_bytes")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    joined = rows.join(repeated, ["sha1", "payload_bytes"], "left")
    return joined.withColumn("original", F.coalesce("_first", "page_id")).select(
        "page_id",
        "url",
        "html",
        "sha1",
        "payload_bytes",
        F.col("original").eqNullSafe(F.col("page_id")).alias("is_original"),
        "original",
    )


def train_dictionary(pages, size=DICTIONARY_BYTES, rows=SAMPLE_ROWS, chars=SAMPLE_CHARS):
    """A Zstandard dictionary (bytes) from the rows with the smallest hashes of their page_id.

    The sample is bounded: at most ``rows`` records, of each at most ``chars`` characters. Too little text for a
    dictionary gives empty bytes: archives then have an empty dictionary frame.
    """
    filled = pages.where("html <> ''").select("page_id", "url", F.substring("html", 1, chars).alias("html"))
    sample = spread_sample(filled, "page_id", rows)
    records = [
        record(r.page_id, r.url, r.html.encode(), True, None, 0, "").replace(b"\0", b"") for r in sample.toLocalIterator()
    ]
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, records)) // 8), records).as_bytes()
    except zstandard.ZstdError:
        return b""


def record_id(page_id):
    """A UUID (version 8) that carries a page's 64-bit id, or that it has none."""
    if page_id is None:
        return uuid.UUID(int=(1 << 120) | (8 << 76) | (2 << 62))
    n = page_id & 0xFFFFFFFFFFFFFFFF
    return uuid.UUID(int=((n >> 62) << 64) | (8 << 76) | (2 << 62) | (n & 0x3FFFFFFFFFFFFFFF))


def page_of(urn):
    n = uuid.UUID(urn.strip("<>").rpartition(":")[2]).int
    if n >> 120:
        return None
    n = ((n >> 64) & 3) << 62 | n & 0x3FFFFFFFFFFFFFFF
    return n - (1 << 64) if n >> 63 else n


def base32_sha1(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id, url, payload, is_original, original, payload_bytes, digest):
    """One record as bytes. A revisit has the HTTP head only; its headers keep the full payload's digest and size."""
    payload_bytes = payload_bytes or len(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n"
    block = head.encode() + (payload if is_original else b"")
    lines = [
        VERSION,
        f"WARC-Type: {'response' if is_original else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{record_id(page_id)}>",
        f"WARC-Date: {DATE}",
    ]
    if url is not None:
        # A line break in an address would end the header.
        lines.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    lines += [
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if not is_original:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <urn:uuid:{record_id(original)}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _info():
    block = b"format: WARC File Format 1.1\r\n"
    lines = f"{VERSION}\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{record_id(None)}>\r\nWARC-Date: {DATE}\r\n"
    lines += f"Content-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def write_archives(pages, path, dictionary, archive_bytes=ARCHIVE_BYTES):
    """Write the frame of ``with_originals`` as archives of about ``archive_bytes`` compressed bytes below ``path``.

    A task holds one archive at a time, besides one record. An empty table writes no archive.
    """
    ship_package(pages.sparkSession)

    def archives(batches):
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=trained)
        start = DICTIONARY_MAGIC + len(dictionary).to_bytes(4, "little") + dictionary + packer.compress(_info())
        end = FILLER_MAGIC + (1).to_bytes(4, "little")
        parts, size = [start], 0
        for batch in batches:
            for row in _rows(batch):
                frame = packer.compress(record(*row))
                parts.append(frame)
                size += len(frame)
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(parts) + end], pa.binary())})
                    parts, size = [start], 0
        if size:
            yield pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(parts) + end], pa.binary())})

    made = pages.select("page_id", "url", "html", "sha1", "payload_bytes", "is_original", "original")
    made.mapInArrow(archives, "archive binary").select(F.col("archive").cast("string").alias("value")).write.option(
        "maxRecordsPerFile", 1
    ).option("compression", "none").text(path)


def _rows(batch):
    for i in range(batch.num_rows):
        r = batch.slice(i, 1).to_pylist()[0]
        digest = base64.b32encode(bytes.fromhex(r["sha1"])).decode()
        payload = (r["html"] or "").encode() if r["is_original"] else b""
        yield r["page_id"], r["url"], payload, r["is_original"], r["original"], r["payload_bytes"], digest


def frames(data):
    """The dictionary and the decompressed records of one archive."""
    size = int.from_bytes(data[4:8], "little")
    if data[:4] != DICTIONARY_MAGIC:
        raise ValueError("an archive starts with its dictionary")
    dictionary = data[8 : 8 + size]
    if dictionary[:4] == FRAME_MAGIC:
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    at = 8 + size
    while at < len(data):
        if 0x50 <= data[at] <= 0x5F and data[at + 1 : at + 4] == FILLER_MAGIC[1:]:
            at += 8 + int.from_bytes(data[at + 4 : at + 8], "little")
            continue
        reader = unpacker.decompressobj()
        got, fed = [], at
        while not reader.eof:
            if fed >= len(data):
                raise ValueError("an archive ends inside a record")
            got.append(reader.decompress(data[fed : fed + FEED]))
            fed = min(len(data), fed + FEED)
        at = fed - len(reader.unused_data)
        yield b"".join(got)


def parse(data):
    """Headers (lower-case names) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:20]}")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return headers, block


def read_archives(spark, path):
    """The records of all archives below a path, with payloads checked against their digests.

    Per record: page_id, url, record_type, payload (null for a revisit), payload_bytes and payload_digest of the full
    payload, refers_to (the original's page_id, for revisits) and archive (the file). Archives are read by Spark, a file
    as a whole: their size is bounded by the writer.
    """
    ship_package(spark)
    names = [f.name for f in READ]

    def records(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(READ)
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1)):
                rows, size = [], 0
                for data in frames(content.as_py()):
                    headers, block = parse(data)
                    if headers["warc-type"] == "warcinfo":
                        continue
                    rows.append((*_record(headers, block), archive.as_py()))
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(records, READ)


def _record(headers, block):
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(head.decode().rpartition("Content-Length: ")[2].split("\r\n")[0])
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    original = headers["warc-type"] == "response"
    if base32_sha1(block) != headers["warc-block-digest"].removeprefix("sha1:"):
        raise ValueError("a block does not have its digest")
    if original and (base32_sha1(payload) != digest or len(payload) != size):
        raise ValueError("a payload does not have its digest")
    url = headers.get("warc-target-uri")
    if url is not None:
        url = url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
    return (
        page_of(headers["warc-record-id"]),
        url,
        headers["warc-type"],
        payload if original else None,
        size,
        digest,
        None if original else page_of(headers["warc-refers-to"]),
    )


def round_trip(pages):
    """Write all pages as archives below the shared folder and read them back; see ``read_archives``.

    Null html is an empty payload, a null page_id stays null, other columns are left out. An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = Scratch(spark, "warc").path()
    prepared = with_originals(pages)
    write_archives(prepared, path, train_dictionary(pages))
    return read_archives(spark, path)
