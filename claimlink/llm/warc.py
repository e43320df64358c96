"""WARC archives: writing, reading, and revisit resolution.

Records are written by Spark's text writer, one archive per partition or more, gzipped; a record is
its header, a blank line and its block, and the writer's line separator is the two line ends that
close a record. How many records an archive may hold depends on their size (``SIZE_CLASSES``).
Archives are read as files and parsed by ``Content-Length`` while they are decompressed, so a task
holds one compressed archive and one record.

Revisit resolution shuffles headers only, by payload digest: of equal payloads of at least
``least_bytes`` one is chosen as the original response, the others become revisits that refer to
it. The archives written then have fresh headers (record ids, digests, lengths) and each repeated
payload once. Reading them back joins the revisits to their responses. A digest that a third of all
records share is combined in the map tasks before its shuffle, and both joins split hot keys at run
time.

Defined results: a null payload is empty. Of equal payloads the record with the largest page id is
the response (null ids are smallest), among equal ids the one with the largest record id. Repeated
rows are records of their own. A null URL has no header line,
blanks and control characters in one are percent-encoded. Extra
columns are not read. Unlike a crawler's archives, the block is the HTTP head and the payload; dates
are the time of writing.
"""

from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlink.llm.common import arrow_schema, batch, fields, staging

# (payload of at most so many bytes, records a file): no file holds more than 256 MB before it is
# compressed, unless a single record does.
SIZE_CLASSES = ((51_200, 5_000), (1 << 20, 250), (64 << 20, 4), (1 << 31, 1))
LEAST_BYTES = 1000
END = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def _urn(value: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), value, F.lit(">"))


def write_archive(records: DataFrame, folder: str, largest: int) -> None:
    """Write records (record_id, page_id, url, digest, payload, refers_to) as gzipped archives.

    Without ``refers_to`` a record is a response and its block ends in the payload; with it, it is
    a revisit and its block is the HTTP head alone. ``largest`` is the size of the largest payload:
    records go to a folder per size class, each with as many records a file as its sizes
    allow, so no file grows beyond what can be read back. Pages of ordinary size are one class.
    """
    size = F.coalesce(F.octet_length("payload"), F.lit(0))
    least = -1
    for k, (most, per_file) in enumerate(SIZE_CLASSES):
        part = records
        if least >= 0 or largest > most:
            part = records.filter((size > least) & (size <= most))
        _write_class(part, f"{folder}/size-{k}", per_file)
        if largest <= most:
            return
        least = most


def _write_class(records: DataFrame, folder: str, per_file: int) -> None:
    revisit = F.col("refers_to").isNotNull()
    payload = F.when(~revisit, F.coalesce("payload", F.lit(""))).otherwise(F.lit(""))
    url = F.regexp_replace("url", "[\\x00-\\x20\\x7f]", "%20")
    length = F.lit(len(_HTTP)) + F.octet_length(payload)
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    record = F.concat(
        F.lit("WARC/1.1" + END),
        _field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", _urn(F.col("record_id"))),
        _field("WARC-Date", now),
        _field("WARC-Target-URI", url),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _field("WARC-Refers-To", _urn(F.col("refers_to"))),
        _field("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _field("Page-ID", F.col("page_id").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response" + END),
        _field("Content-Length", length.cast("string")),
        F.lit(END + _HTTP),
        payload,
    )
    (
        records.select(record.alias("value"))
        .write.option("lineSep", END + END)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", per_file)
        .mode("errorifexists")
        .text(folder)
    )


class _Stream:
    """Bytes of a gzipped archive (of any number of members), decompressed as they are read."""

    def __init__(self, content: bytes, step: int = 1 << 18):
        self.content, self.at, self.step = content, 0, step
        self.inflate = zlib.decompressobj(31)
        self.ready = bytearray()

    def _more(self) -> bool:
        if self.at >= len(self.content):
            return False
        chunk = self.content[self.at : self.at + self.step]
        self.at += len(chunk)
        while chunk:
            self.ready += self.inflate.decompress(chunk)
            chunk = self.inflate.unused_data
            if chunk:
                self.inflate = zlib.decompressobj(31)
        return True

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (found := self.ready.find(mark, start)) < 0:
            start = max(0, len(self.ready) - len(mark))
            if not self._more():
                return None
        head = bytes(self.ready[:found])
        del self.ready[: found + len(mark)]
        return head

    def take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise ValueError("archive ends inside a record")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out


def parse_archive(content: bytes):
    """(header fields, payload) of every record; the payload is the block behind the HTTP head."""
    stream = _Stream(content)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode().split(END)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts with {lines[0][:40]!r}")
        header = dict(line.split(": ", 1) for line in lines[1:])
        block = stream.take(int(header["Content-Length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("record without end")
        yield header, block.partition(b"\r\n\r\n")[2]


RECORDS = fields(
    ("record_id", "string"), ("page_id", "long"), ("url", "string"), ("record_type", "string"),
    ("refers_to", "string"), ("digest", "string"), ("payload_bytes", "long"),
)
WITH_PAYLOAD = T.StructType([*RECORDS, T.StructField("payload", T.BinaryType())])


def read_archive(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """Records of all archives in a folder; digest and size are those of the payload read, for a
    revisit the digest it names."""
    chosen = WITH_PAYLOAD if payload else RECORDS
    schema = arrow_schema(chosen)

    def read(batches):
        for b in batches:
            for content in b.column("content"):
                rows, size = [], 0
                for header, body in parse_archive(content.as_py()):
                    target = header.get("WARC-Refers-To")
                    said = header["WARC-Payload-Digest"].removeprefix("sha1:")
                    digest = said if target else hashlib.sha1(body).hexdigest()
                    if digest != said:
                        raise ValueError(f"payload of {header['WARC-Record-ID']} is damaged")
                    page = header.get("Page-ID")
                    row = (
                        header["WARC-Record-ID"][10:-1],
                        None if page is None else int(page),
                        header.get("WARC-Target-URI"),
                        header["WARC-Type"],
                        None if target is None else target[10:-1],
                        digest,
                        len(body),
                    )
                    rows.append((*row, body) if payload else row)
                    size += len(body) if payload else 0
                    if size > 4_000_000 or len(rows) >= 2000:
                        yield batch(schema, list(zip(*rows, strict=True)))
                        rows, size = [], 0
                if rows:
                    yield batch(schema, list(zip(*rows, strict=True)))

    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = reader.load(folder).select("content")
    return files.mapInArrow(read, chosen)


def archive_pages(pages: DataFrame, folder: str) -> None:
    """A response record per page, its html as payload."""
    html = F.coalesce(F.col("html"), F.lit(""))
    largest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0
    write_archive(
        pages.select(
            F.uuid().alias("record_id"),
            F.col("page_id").cast("long").alias("page_id"),
            "url",
            F.sha1(html.cast("binary")).alias("digest"),
            html.alias("payload"),
            F.lit(None).cast("string").alias("refers_to"),
        ),
        folder,
        largest,
    )


def resolve_revisits(
    spark: SparkSession, source: str, target: str, least_bytes: int = LEAST_BYTES
) -> None:
    """Write the archives of ``source`` to ``target`` with every repeated payload once."""
    store = staging(spark)
    headers = store(
        read_archive(spark, source).select("record_id", "page_id", "digest", "payload_bytes"),
        "headers",
    )
    same = ["digest", "payload_bytes"]
    originals = (
        headers.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy(*same)
        .agg(F.count("*").alias("n"), F.max(F.struct("page_id", "record_id")).alias("original"))
        .filter("n > 1")
    )
    # Stored, so that Spark knows the size: few revisits go to the records without a shuffle of all
    # payloads, many meet them in one.
    revisits = store(
        headers.join(originals, same).filter("record_id != original.record_id").select(
            "record_id", F.col("original.record_id").alias("original_id")
        ),
        "revisits",
    )
    records = read_archive(spark, source, payload=True).drop("refers_to")
    joined = records.join(revisits, "record_id", "left")
    write_archive(
        joined.select(
            _fresh(F.col("record_id")).alias("record_id"),
            "page_id",
            "url",
            "digest",
            F.when(F.col("original_id").isNull(), F.col("payload").cast("string")).alias("payload"),
            _fresh(F.col("original_id")).alias("refers_to"),
        ),
        target,
        headers.agg(F.max("payload_bytes")).first()[0] or 0,
    )


def _fresh(record_id: Column) -> Column:
    """The id of the new record for an old one: a UUID made from its hash; null stays null."""
    return F.regexp_replace(
        F.substring(F.sha2(record_id, 256), 1, 32),
        "^(.{8})(.{4})(.{4})(.{4})(.{12})$",
        "$1-$2-$3-$4-$5",
    )


def resolved_records(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record: revisits
    joined to their responses."""
    records = staging(spark)(read_archive(spark, folder), "records")
    responses = records.filter("refers_to IS NULL").select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("response_page"),
        F.col("payload_bytes").alias("response_bytes"),
    )
    return records.join(responses, "refers_to", "left").select(
        "page_id",
        F.coalesce("response_bytes", "payload_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("response_page").alias("refers_to"),
    )


def deduplicate_pages(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Archive the pages, write deduplicated archives, and read those back."""
    spark = pages.sparkSession
    store = staging(spark)
    archive, deduplicated = store.path("archive"), store.path("deduplicated")
    archive_pages(pages, archive)
    resolve_revisits(spark, archive, deduplicated, least_bytes)
    return resolved_records(spark, deduplicated)
