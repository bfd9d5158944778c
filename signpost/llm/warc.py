"""WARC archives: writing pages, and a normaliser for archives that are one gzip stream.

A crawl's archive may be one gzip stream over all records, which nobody can seek in. The
normaliser inflates such a stream once, front to back, and writes every record again as a gzip
member of its own, with a sidecar index of the members' offsets and lengths, so that a record can
be read by a range request. All bytes go through Spark's readers and writers: input streams are
read in pieces between blank lines, whatever file system they are in, and what a task writes is
committed as a whole or not at all. A task never holds more than a record and a few megabytes.

Spark's text writer puts a separator after each row; here a row is a run of gzip members and the
separator is an empty gzip member, which inflates to nothing.

Defined results: a null html is an empty payload; a null page_id is kept, and refers to no page;
rows that repeat the largest page_id of a payload are all responses; blanks and control
characters in an URL are percent-encoded, a null URL is `urn:unknown`; an empty table gives
no records; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signpost.llm.tables import materialize
from signpost.session import scratch_dir

BLANK = "\r\n\r\n"
CHUNK = 4 << 20
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d+)")


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of a SHA-1: five hex digits are four characters."""
    # The digest goes in as an array: inside the lambda it would be made again for every group.
    digits = F.transform(
        F.array_repeat(F.sha1(data), 8), lambda hex, g: F.conv(F.substring(hex, g * 5 + 1, F.lit(5)), 16, 10).cast("int")
    )
    return F.array_join(F.transform(digits, _four), "")


def _four(v: Column) -> Column:
    return F.concat(*[F.substring(F.lit(_BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)])


def _payload() -> Column:
    return F.encode(F.coalesce("html", F.lit("")), "UTF-8")


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, digest, refers_to of the pages whose payload a page of larger id has as well."""
    short = materialize(
        pages.select("page_id", base32_sha1(_payload()).alias("digest"), F.octet_length(_payload()).alias("bytes")),
        "warc-digests",
    )
    repeated = (
        short.where(F.col("bytes") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies"))
        .where("copies > 1 and refers_to is not null")
    )
    found = short.where(F.col("bytes") >= least_bytes).join(repeated, "digest")
    return found.where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def record_texts(pages: DataFrame, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """A column `value` with one WARC record per page, without the blank line that ends it."""
    again = materialize(revisits(pages, least_bytes), "warc-revisits")
    # A short row per revisit: shipped whole while there are few, else shuffled.
    shipped = F.broadcast(again) if again.count() <= 200_000 else again
    again = shipped.withColumnRenamed("page_id", "again_id").withColumnRenamed("digest", "again_digest")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", base32_sha1(F.encode("html", "UTF-8")))
    rows = rows.join(
        again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest")), "left"
    )
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    url = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.lit("urn:unknown"))
    refers = F.col("refers_to").cast("string")
    is_revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("html").cast("string"),
        F.lit(BLANK),
    )
    block = F.when(is_revisit, http).otherwise(F.concat(http, "html"))
    length = F.octet_length(http) + F.when(is_revisit, 0).otherwise(F.octet_length("html"))
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(is_revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), page,
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(is_revisit, F.concat(
            F.lit("\r\nWARC-Refers-To: <urn:page:"), refers, F.lit(f">\r\nWARC-Profile: {profile}"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"),
        F.lit(BLANK),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write_monolithic(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Archives of all pages under `path`, each one gzip stream."""
    record_texts(pages, least_bytes).write.option("lineSep", BLANK).option("compression", "gzip").text(path)


class Records:
    """Cuts a stream of bytes into WARC records."""

    def __init__(self) -> None:
        self.held = bytearray()
        self.block_at = self.end = -1

    def feed(self, data: bytes) -> Iterator[tuple[bytes, bytes]]:
        """The head and the block of each record that `data` completes."""
        self.held += data
        while True:
            if self.end < 0:
                # Blank lines before a record belong to none.
                skip = 0
                while skip < len(self.held) and self.held[skip] in b"\r\n":
                    skip += 1
                del self.held[:skip]
                at = self.held.find(b"\r\n\r\n")
                if at < 0:
                    return
                found = _LENGTH.search(self.held, 0, at + 2)
                if not self.held.startswith(b"WARC/") or not found:
                    raise ValueError(f"not a WARC record: {bytes(self.held[:80])!r}")
                self.block_at = at + 4
                self.end = self.block_at + int(found.group(1))
            if len(self.held) < self.end:
                return
            yield bytes(self.held[: self.block_at - 4]), bytes(self.held[self.block_at : self.end])
            del self.held[: self.end]
            self.end = -1

    def close(self) -> None:
        if self.end >= 0 or self.held.strip(b"\r\n"):
            raise ValueError("the archive ends within a record")


def fields(head: bytes) -> dict[str, str]:
    """A record's named fields, names in lower case."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The bytes of archives under `path`, cut at blank lines: file, value.

    A compressed file is read by one task, in order.
    """
    text = spark.read.option("lineSep", BLANK).option("pathGlobFilter", "*.gz").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, bytes]]:
    parser, file = Records(), None
    for batch in batches:
        for name, piece in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()):
            if name != file:
                parser.close()
                parser, file = Records(), name
            yield from parser.feed(piece + b"\r\n\r\n")
    parser.close()


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of members, and runs of index lines, packed as members too."""
    members, lines, held, offset, place = [], [], 0, 0, 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal members, lines, held, offset, place
        if members:
            values = [b"".join(members), gzip_member("".join(lines).encode())]
            yield pa.record_batch(
                [pa.array(["archive", "index"]), pa.array([place, place], pa.int64()), pa.array(values)],
                ["kind", "place", "value"],
            )
            offset += len(EMPTY_MEMBER)
            members, lines, held, place = [], [], 0, place + 1

    for head, block in _records(batches):
        member = gzip_member(head + b"\r\n\r\n" + block + b"\r\n\r\n")
        known = fields(head)
        line = {
            "id": known.get("warc-record-id"),
            "type": known.get("warc-type"),
            "uri": known.get("warc-target-uri"),
            "date": known.get("warc-date"),
            "digest": known.get("warc-payload-digest"),
            "offset": offset,
            "length": len(member),
        }
        members.append(member)
        lines.append(json.dumps(line) + "\n")
        offset += len(member)
        held += len(member)
        if held >= CHUNK:
            yield from flush()
    yield from flush()


def normalize(spark: SparkSession, source: str, target: str) -> None:
    """Archives under `source` as `target`/archive/*.warc.gz, with `target`/index/*.cdxj.gz beside them.

    An index file has the name of its archive. Files get their names when all are written.
    """
    runs = _pieces(spark, source).mapInArrow(_rewritten, "kind string, place bigint, value binary")
    between = EMPTY_MEMBER.decode("latin-1")
    (
        runs.sortWithinPartitions("kind", "place")
        .select("kind", F.col("value").cast("string").alias("value"))
        .write.partitionBy("kind")
        .option("encoding", "ISO-8859-1")
        .option("lineSep", between)
        .text(target)
    )
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for kind, suffix in (("archive", ".warc.gz"), ("index", ".cdxj.gz")):
        old, new = (jvm.org.apache.hadoop.fs.Path(f"{target}/{n}") for n in (f"kind={kind}", kind))
        files = old.getFileSystem(conf)
        if not files.exists(old):
            files.mkdirs(new)
            continue
        files.rename(old, new)
        for status in files.listStatus(new):
            name = status.getPath().getName()
            files.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(new, name.removesuffix(".txt") + suffix))


def read_index(spark: SparkSession, target: str) -> DataFrame:
    """file (of the archive), id, type, uri, date, digest, offset, length of every record."""
    lines = spark.read.schema(
        "id string, type string, uri string, date string, digest string, offset bigint, length bigint"
    ).json(f"{target}/index")
    return lines.withColumn("file", F.regexp_replace(F.col("_metadata.file_name"), r"\.cdxj\.gz$", ".warc.gz"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to from archives of pages.

    A response's length and digest are those of the payload read; a revisit has no payload and
    states both.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for head, block in _records(batches):
            known = fields(head)
            http, _, payload = block.partition(b"\r\n\r\n")
            refers = _page_of(known.get("warc-refers-to"))
            if known["warc-type"] == "revisit":
                size, digest = int(fields(http)["content-length"]), known["warc-payload-digest"].removeprefix("sha1:")
            else:
                size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
            rows.append((_page_of(known["warc-record-id"]), size, digest, known["warc-type"], refers))
            if len(rows) == 10_000:
                yield out()
                rows.clear()
        if rows:
            yield out()

    return _pieces(spark, path).mapInArrow(
        read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    )


def _page_of(record_id: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", record_id or "")
    return int(found.group(1)) if found else None


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages as monolithic archives, normalise these, and read the result."""
    spark = pages.sparkSession
    source, target = scratch_dir(spark, "warc-monolithic"), scratch_dir(spark, "warc")
    write_monolithic(pages, source)
    normalize(spark, source, target)
    return read_pages(spark, f"{target}/archive")


SQL = """
WITH base AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
named AS (SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(8), lambda g:
    array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST(((CAST('0x' || substr(hex, CAST(g * 5 + 1 AS INTEGER), 5) AS BIGINT) >> s) & 31) + 1 AS INTEGER), 1)), '')), '')
    AS payload_digest FROM base),
large AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM named)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM large
"""
