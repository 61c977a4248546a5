"""WARC archives: write captures, read the records back, and assemble them into captures.

A capture is up to three kinds of records: the response (or a revisit, which points to an earlier response with
the same payload instead of holding it), the request, and metadata. They name each other in
``WARC-Concurrent-To``, in whichever direction the writer chose. ``assemble`` joins them through these
identifiers into one nested row per capture.

``write_pages`` writes one response or revisit, one request and one metadata record per page. Of pages with equal
payloads of at least 100 bytes that with the smallest page id is the response. Every record is a gzip member of
its own; files are moved to their place when complete.

Defined results: a NULL html is an empty payload. A NULL page id counts as greater than all others, so such a
page is a response only if no other page has its payload; it is read back as NULL. Of equal rows one is the
response and the others revisit it. A NULL url is written without a target. An empty table gives no
files and no rows. Records that name no known response make a capture without response. A nested row holds all
records of its capture. Other columns of the pages are not written.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import filesystem, map_batches, publish, table
from millrace.session import materialise, scratch_path

SMALLEST_REVISITED = 100
# fixed values: names that the format defines
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"  # the tables have no capture time

RECORD_SCHEMA = """record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string,
    date string, payload_bytes long, payload_digest string, http_line string, fields map<string,string>"""
RECORD_ARROW = pa.schema(
    [
        ("record_id", pa.string()),
        ("type", pa.string()),
        ("concurrent_to", pa.list_(pa.string())),
        ("refers_to", pa.string()),
        ("target_uri", pa.string()),
        ("date", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("http_line", pa.string()),
        ("fields", pa.map_(pa.string(), pa.string())),
    ]
)


def record_id(kind: str, row: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{kind}/{row}'.encode(), usedforsecurity=False).digest())}>"


def clean_uri(uri: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)


def member(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as one gzip member; the same input gives the same bytes."""
    head = "".join(f"{name}: {value}\r\n" for name, value in headers if value is not None)
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    data = b"".join((b"WARC/1.1\r\n", head.encode(), b"Content-Length: %d\r\n\r\n" % len(block), block, b"\r\n\r\n"))
    return packer.compress(data) + packer.flush()


def _capture(row: int, page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """The three records of a page; ``first`` is the row of the response that it revisits, if any."""
    uri = None if url is None else clean_uri(url)
    own = record_id("response", row)
    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri)]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if first is None:
        kind = [("WARC-Type", "response")]
        block = http + payload
    else:
        kind = [("WARC-Type", "revisit"), ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id("response", first))]
        block = http
    answer = member(
        [*kind, ("WARC-Record-ID", own), *common, ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response")],
        block,
    )
    host, _, path = (uri or "").partition("://")[2].partition("/")
    request = member(
        [("WARC-Type", "request"), ("WARC-Record-ID", record_id("request", row)), ("WARC-Concurrent-To", own), *common, ("Content-Type", "application/http;msgtype=request")],
        f"GET /{path.partition('#')[0]} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode(),
    )
    fields = ([] if page_id is None else [f"page-id: {page_id}"]) + [f"payload-length: {len(payload)}"]
    metadata = member(
        [("WARC-Type", "metadata"), ("WARC-Record-ID", record_id("metadata", row)), ("WARC-Concurrent-To", own), *common, ("Content-Type", "application/warc-fields")],
        "".join(f"{line}\r\n" for line in fields).encode(),
    )
    return answer + request + metadata


def write_pages(pages: DataFrame, folder: str) -> list[str]:
    """Write a capture per page; the names of the files, which are as many as tasks with rows."""
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    order = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "row")
    firsts = (
        rows.where(F.octet_length("payload") >= SMALLEST_REVISITED)
        .groupBy("digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("digest", F.col("first.row").alias("first"))
    )
    # a payload that very many pages share is split by the adaptive join
    dealt = rows.join(firsts, "digest", "left").select(
        "row", "page_id", "url", "payload", "digest", F.when(F.col("first") != F.col("row"), F.col("first")).alias("first")
    )

    def write(batches):
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        batches = (b for b in batches if b.num_rows)
        begin = next(batches, None)
        if begin is None:
            return
        name = f"captures-{part:05d}.warc.gz"

        def records(out):
            batch = begin
            while batch is not None:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    out.write(_capture(*row))
                batch = next(batches, None)

        publish(folder, name, attempt, records)
        yield pa.RecordBatch.from_pydict({"file": [name]})

    return sorted(row[0] for row in map_batches(dealt, write, "file string").collect())


def parse_archive(source) -> Iterator[dict]:
    """The records of an open archive, gzipped or plain, one at a time."""
    source = io.BufferedReader(source, 1 << 20) if not hasattr(source, "peek") else source
    while True:
        line = source.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        headers: dict[str, list[str]] = {}
        while (line := source.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            headers.setdefault(name.decode("utf-8", "replace").strip().lower(), []).append(value.decode("utf-8", "replace").strip())
        size = int(headers["content-length"][0])
        block = source.read(size)
        if len(block) != size:
            raise ValueError("archive ends within a record")
        yield _record({k: v[0] for k, v in headers.items()}, headers.get("warc-concurrent-to", []), block)


def _record(headers: dict[str, str], concurrent: list[str], block: bytes) -> dict:
    kind = headers.get("warc-type", "")
    found = {
        "record_id": headers.get("warc-record-id"), "type": kind, "concurrent_to": concurrent, "refers_to": headers.get("warc-refers-to"),
        "target_uri": headers.get("warc-target-uri"), "date": headers.get("warc-date"), "payload_bytes": None,
        "payload_digest": None, "http_line": None, "fields": None,
    }
    if kind in ("request", "response", "revisit"):
        head, _, body = block.partition(b"\r\n\r\n")
        found["http_line"] = head.partition(b"\r\n")[0].decode("utf-8", "replace")
        if kind == "response":
            found["payload_bytes"], found["payload_digest"] = len(body), hashlib.sha256(body).hexdigest()
        elif kind == "revisit":
            found["payload_digest"] = headers.get("warc-payload-digest", "").partition(":")[2] or None
    elif kind == "metadata":
        lines = [line.partition(":") for line in block.decode("utf-8", "replace").splitlines() if ":" in line]
        found["fields"] = list({name.strip(): value.strip() for name, _, value in lines}.items())
    return found


def read_archives(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """One row per record of the archives; each task streams whole files."""

    def read(batches):
        files, root = filesystem(folder)
        for batch in batches:
            for number in batch.column(0).to_pylist():
                rows = []
                with files.open_input_stream(f"{root}/{names[number]}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as source:
                    for record in parse_archive(source):
                        rows.append(record)
                        if len(rows) == 5_000:
                            yield pa.RecordBatch.from_pylist(rows, RECORD_ARROW)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, RECORD_ARROW)

    return map_batches(spark.range(0, len(names), 1, max(1, len(names))), read, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: answer (the response or revisit), requests and metadata.

    A request or metadata record belongs to the answer that it names, or that names it, or that a record belongs to which
    it names or which names it (metadata that names only the request).
    """
    is_answer = F.col("type").isin("response", "revisit")
    answers = records.where(is_answer)
    named = records.select("record_id", is_answer.alias("is_answer"), F.explode("concurrent_to").alias("other"))
    direct = (
        named.where("NOT is_answer")
        .join(answers.select(F.col("record_id").alias("other")), "other", "left_semi")
        .select(F.col("record_id").alias("member"), F.col("other").alias("capture"))
    )
    reverse = named.where("is_answer").select(F.col("other").alias("member"), F.col("record_id").alias("capture"))
    known = direct.unionByName(reverse).groupBy("member").agg(F.min("capture").alias("capture"))
    beside = named.where("NOT is_answer")
    beside = beside.select(F.col("record_id").alias("far"), F.col("other").alias("member")).unionByName(
        beside.select(F.col("other").alias("far"), F.col("record_id").alias("member"))
    )
    second = beside.join(known, "member").groupBy(F.col("far").alias("record_id")).agg(F.min("capture").alias("second"))
    members = (
        records.where(~is_answer)
        .join(known.withColumnRenamed("member", "record_id"), "record_id", "left")
        .join(second, "record_id", "left")
        .withColumn("capture", F.coalesce("capture", "second", F.get("concurrent_to", F.lit(0)), "record_id"))
        .drop("second")
    )
    parts = members.unionByName(answers.withColumn("capture", F.col("record_id")))
    body = F.struct(*[F.col(c) for c in records.columns])
    side = lambda kind: F.sort_array(
        F.collect_list(F.when(F.col("type") == kind, F.struct("record_id", "target_uri", "http_line", F.map_entries("fields").alias("fields"))))
    )
    return parts.groupBy("capture").agg(
        F.first(F.when(is_answer, body), ignorenulls=True).alias("answer"),
        side("request").alias("requests"),
        side("metadata").alias("metadata"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Write the pages as archives below the shared folder, read them back and assemble them."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    names = write_pages(pages, folder)
    return assemble(materialise(read_archives(spark, folder, names), "warc-records"))


def digest(pages: DataFrame) -> DataFrame:
    """Per page: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    field = lambda name: F.map_from_entries(F.col("metadata")[0]["fields"])[name].cast("long")
    rows = materialise(
        captures(pages).select(
            "capture",
            field("page-id").alias("page_id"),
            F.coalesce("answer.payload_bytes", field("payload-length")).alias("payload_bytes"),
            F.col("answer.payload_digest").alias("payload_digest"),
            F.col("answer.type").alias("record_type"),
            F.col("answer.refers_to").alias("named"),
        ),
        "captures",
    )
    wanted = rows.where("named IS NOT NULL").select(F.col("named").alias("capture")).distinct()
    first = rows.join(wanted, "capture", "left_semi").select(F.col("capture").alias("named"), F.col("page_id").alias("refers_to"))
    # responses name none: as one key they would lie in one partition
    none = rows.where("named IS NULL").withColumn("refers_to", F.lit(None).cast("long"))
    both = rows.where("named IS NOT NULL").join(first, "named", "left").unionByName(none)
    return both.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_warc(spark, sf_dir):
    return digest(table(spark, sf_dir, "pages"))


OP4_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to FROM f"""
