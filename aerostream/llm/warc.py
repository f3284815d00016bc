"""Legacy archive converter: ARC files to WARC files.

``write_arc`` renders pages as ARC archives (version 1 or 2), ``read_arc``
parses ARC archives by their version-specific header lines and declared
lengths, ``to_warc`` gives every record the identifier, timestamp, type and
digests of its WARC equivalent, ``write_warc`` / ``read_warc`` write and read
the result.

Archives are gzip files in a folder, one per task, written by Spark's text
writer (so its commit protocol covers lost executors, and any file system
works) with the format's own record separator as line separator. They are read
as separator-delimited pieces, in file order, and put together again by the
declared lengths: a payload may hold separators and header look-alikes. Memory
holds one record at a time.

Defined results: a null body is an empty payload; a null url is written as "-"
and read as null; a null id stays null and sorts last among copies; rows that
share id and payload are all responses if that id is the smallest; an empty
table gives no records. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostream.llm.common import saved

# fixed values: field lists of the ARC URL records, by version
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
RECORD_SCHEMA = ("kind string, version int, url string, ip string, archive_date string, mime string, "
                 "ref long, head binary, payload binary")
READ_SCHEMA = ("record_type string, record_id string, refers_to_id string, target_uri string, warc_date string, "
               "ref long, refers_to long, payload_bytes long, payload_digest string, declared_digest string")
BATCH_BYTES = 8 << 20


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (bytes, str))) + 64
        if size >= BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(col, f.type) for col, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


# ------------------------------------------------------------------ ARC

def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
              captured: str = "20240130000000", version: int | None = None) -> None:
    """Write one ARC record per row to new gzip archives under ``path``.

    ``version`` 1 or 2; by default files alternate between both versions.
    """
    out = pa.schema([("value", pa.binary())])

    def render(batches):
        part = TaskContext.get().partitionId()
        v = version or 1 + part % 2
        name = f"part-{part:05d}.arc"

        def line(url: bytes, mime: str, length: int) -> bytes:
            mid = f" 0.0.0.0 {captured} {mime} " if v == 1 else f" 0.0.0.0 {captured} {mime} 200 - - 0 {name} "
            return url + mid.encode() + str(length).encode() + b"\n"

        def rows():
            about = f"{v} 0 aerostream\n{ARC_FIELDS[v]}\n".encode()
            yield (line(f"filedesc://{name}".encode(), "text/plain", len(about)) + about,)
            for b in batches:
                for ref, url, body in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                    body = body or b""
                    own = b"" if ref is None else b"X-Record-Ref: %d\r\n" % ref
                    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n%s\r\n" \
                        % (len(body), own)
                    u = re.sub(rb"[\x00-\x20%\x7f]", lambda m: b"%%%02X" % m[0][0] if m[0] != b"%" else b"%", url or b"-")
                    yield (line(u or b"-", "text/html", len(head) + len(body)) + head + body,)

        yield from _batches(rows(), out)

    src = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string").cast("binary"),
                       F.col(body_col).cast("string").cast("binary"))
    _write(src.mapInArrow(render, "value binary"), path, "\n")


def _write(rows: DataFrame, path: str, sep: str) -> None:
    (rows.select(F.col("value").cast("string").alias("value")).write
     .option("lineSep", sep).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))


def _pieces(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """The archives' bytes between separators, in file order; gzip files are not
    split, so each is read by one task from its start."""
    return spark.read.option("lineSep", sep).schema("value string").text(path) \
        .select(F.col("value").cast("binary").alias("value"))


def _taken(lines: Iterator[bytes], length: int, sep: bytes) -> bytes | None:
    """The next ``length`` bytes, whole pieces; None if the length does not end
    at the end of a piece (a damaged archive)."""
    got, held = 0, []
    while got < length or not held:
        if length == 0:
            return b""
        piece = next(lines, None)
        if piece is None:
            return None
        got += len(piece) + (len(sep) if held else 0)
        held.append(piece)
    return sep.join(held) if got == length else None


def arc_records(lines: Iterator[bytes]) -> Iterator[tuple]:
    """Records of ARC archives given as lines without their line feed."""
    version = 1
    for line in lines:
        if not line:
            continue
        # a page's url may begin like that too: only plain text without an HTTP block describes the file
        about = line.startswith(b"filedesc://") and line.split(b" ")[3:4] == [b"text/plain"]
        if about:
            version = 2 if len(line.split(b" ")) >= 10 else 1
        fields = line.rsplit(b" ", len(ARC_FIELDS[version].split(" ")) - 1)
        if len(fields) != len(ARC_FIELDS[version].split(" ")) or not fields[-1].isdigit() or not fields[2].isdigit():
            yield ("damaged", version, None, None, None, None, None, b"", line)
            continue
        body = _taken(lines, int(fields[-1]), b"\n")
        url, ip, date, mime = (x.decode("utf-8", "replace") for x in fields[:4])
        if body is None:
            yield ("damaged", version, url, ip, date, mime, None, b"", b"")
        elif about and not body.startswith(b"HTTP/"):
            yield ("filedesc", int(body[:1] or b"1"), url, ip, date, mime, None, b"", body)
        else:
            cut = body.find(b"\r\n\r\n") + 4 if body.startswith(b"HTTP/") else 0
            head = body[:cut] if cut >= 4 else b""
            own = re.search(rb"(?im)^X-Record-Ref: (-?\d+)\r$", head)
            yield ("http" if head else "other", version, None if url == "-" else url, ip, date, mime,
                   int(own[1]) if own else None, head, body[len(head):])


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """One row per ARC record: kind is http, other, filedesc or damaged."""
    out = pa.schema([("kind", pa.string()), ("version", pa.int32()), ("url", pa.string()), ("ip", pa.string()),
                     ("archive_date", pa.string()), ("mime", pa.string()), ("ref", pa.int64()),
                     ("head", pa.binary()), ("payload", pa.binary())])

    def parse(batches):
        lines = (x for b in batches for x in b.column(0).to_pylist())
        yield from _batches(arc_records(lines), out)

    return _pieces(spark, path, "\n").mapInArrow(parse, RECORD_SCHEMA)


# ------------------------------------------------------------------ conversion

def _uuid(*parts: Column) -> Column:
    """A name-based identifier: the same record always gets the same one."""
    h = F.md5(F.concat_ws("\x01", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def to_warc(records: DataFrame, least_bytes: int = 100) -> DataFrame:
    """ARC records -> WARC records (header fields as columns, block as binary).

    filedesc blocks become warcinfo, HTTP captures response, anything else
    resource. Of HTTP captures with equal payloads of at least ``least_bytes``
    the one with the smallest ref stays a response, the others become revisits
    of it. First captures are found by a ``min`` per digest (summed up before
    its shuffle); only digests seen more than once are written to the shared folder
    and joined back, so that Spark knows their size and shuffles payloads only if
    they are too many to send to every task.
    """
    r = records.where(F.col("kind") != "damaged")
    digest = F.sha2("payload", 256)
    date = F.regexp_replace("archive_date", r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3T$4:$5:$6Z")
    r = r.withColumn("digest", digest).withColumn("warc_date", date) \
        .withColumn("record_id", _uuid(F.col("url"), F.col("archive_date"), F.col("ref"), F.col("digest")))
    counts = (F.col("kind") == "http") & (F.octet_length("payload") >= least_bytes)
    first = saved(r.where(counts).groupBy(F.col("digest").alias("_d"))
             .agg(F.min(F.struct(F.col("ref").isNull().alias("none"), "ref", "record_id")).alias("_first"),
                  F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") > 1), "warc-first")
    j = r.join(first, (F.col("digest") == F.col("_d")) & counts, "left")
    again = F.coalesce(F.col("_first.ref").isNotNull() & (F.col("ref").isNull() | (F.col("ref") > F.col("_first.ref"))),
                       F.lit(False))
    return j.select(
        F.when(F.col("kind") == "filedesc", "warcinfo").when(F.col("kind") == "other", "resource")
        .when(again, "revisit").otherwise("response").alias("record_type"),
        "record_id", F.col("url").alias("target_uri"), "warc_date", "ip", "mime", "ref", "digest", "head", "payload",
        F.when(again, F.col("_first.record_id")).alias("refers_to_id"), F.when(again, F.col("_first.ref")).alias("refers_to"))


def write_warc(records: DataFrame, path: str) -> None:
    """Write ``to_warc`` records as gzip WARC/1.0 archives under ``path``."""
    kind = F.col("record_type")
    block = F.when(kind == "revisit", F.col("head")).otherwise(F.concat(F.col("head"), F.col("payload")))
    r = records.withColumn("_block", block)

    def field(name: str, value: Column, when: Column | None = None) -> Column:
        v = F.concat(F.lit(f"{name}: "), value.cast("string"))
        return v if when is None else F.when(when, v)

    http = kind.isin("response", "revisit")
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.0"), field("WARC-Type", kind), field("WARC-Record-ID", F.col("record_id")),
        field("WARC-Date", F.col("warc_date")), field("WARC-Target-URI", F.col("target_uri"), kind != "warcinfo"),
        field("WARC-IP-Address", F.col("ip"), http), field("WARC-Refers-To", F.col("refers_to_id")),
        field("X-Refers-To-Ref", F.col("refers_to")),
        field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"), kind == "revisit"),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest"), kind != "warcinfo"),
        field("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2("_block", 256))),
        field("Content-Type", F.when(kind == "response", F.lit("application/http; msgtype=response"))
              .when(kind == "revisit", F.lit("application/http; msgtype=response"))
              .when(kind == "warcinfo", F.lit("text/plain")).otherwise(F.col("mime"))),
        field("Content-Length", F.octet_length("_block")), F.lit("\r\n"))
    # concat_ws put a line end before the last piece, itself a line end: the blank line
    _write(r.select(F.concat(head.cast("binary"), F.col("_block")).alias("value")), path, "\r\n\r\n")


def warc_records(lines: Iterator[bytes]) -> Iterator[tuple]:
    """Records of WARC archives given as pieces between CRLFs."""
    for line in lines:
        if not line.startswith(b"WARC/"):
            continue
        h: dict[str, str] = {}
        for x in lines:
            if not x:
                break
            k, _, v = x.partition(b":")
            h[k.decode().lower()] = v.strip().decode("utf-8", "replace")
        block = _taken(lines, int(h["content-length"]), b"\r\n")
        if block is None:
            raise ValueError(f"record {h.get('warc-record-id')} is cut off")
        if "warc-block-digest" in h and h["warc-block-digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
            raise ValueError(f"record {h.get('warc-record-id')} is damaged")
        cut = block.find(b"\r\n\r\n") + 4 if block.startswith(b"HTTP/") else 0
        head, payload = block[:cut], block[cut:]
        declared = h.get("warc-payload-digest", "").removeprefix("sha256:") or None
        if h["warc-type"] == "revisit":
            n, digest = int(re.search(rb"(?im)^Content-Length: (\d+)\r$", head)[1]), declared
        else:
            n, digest = len(payload), hashlib.sha256(payload).hexdigest()
        own = re.search(rb"(?im)^X-Record-Ref: (-?\d+)\r$", head)
        to = h.get("x-refers-to-ref")
        yield (h["warc-type"], h.get("warc-record-id"), h.get("warc-refers-to"), h.get("warc-target-uri"),
               h.get("warc-date"), int(own[1]) if own else None, int(to) if to else None, n, digest, declared)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record; block digests are checked, payload digests of
    stored payloads computed anew."""
    types = {"ref": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64()}
    out = pa.schema([(n, types.get(n, pa.string())) for n in (x.split(" ")[0] for x in READ_SCHEMA.split(", "))])

    def parse(batches):
        lines = (x for b in batches for x in b.column(0).to_pylist())
        yield from _batches(warc_records(lines), out)

    return _pieces(spark, path, "\r\n").mapInArrow(parse, READ_SCHEMA)
