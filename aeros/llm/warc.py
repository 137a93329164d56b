"""WARC archives: written from pages, read back in one pass, and assembled into captures.

Each page gives a request record, a response record (or, where a page with a smaller id has the same payload of at least
MIN_REVISIT bytes, a revisit record that refers to that page's response) and a metadata record, the first and last of
which name the second in WARC-Concurrent-To. Each file begins with a warcinfo record. A record is a gzip member of its own,
so a reader can start at any of them, and files are cut by their size.

Members are made where the rows are and written by Spark's text writer. Its line separator supplies the last byte of each
member, which is zero in every member of less than 16 MB of content; a larger record is followed by an empty member.

Reading walks the members of a file one at a time, checks the payload digests, and joins the records of a transaction by
the id that they are concurrent to, into one nested row. A payload that its digest does not fit gives digest_ok false.

Null html is an empty payload, a null url an empty target. Rows that repeat a page id are each archived; with the same
payload they are each a response if no smaller id has it. Rows without a page id are archived with an empty id and give
page_id null. Pages are worked on one at a time, however long; columns other than the three play no part. An empty
table gives no captures.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, slices, small, stored, tidy

END = b"\r\n\r\n"
MIN_REVISIT = 100
#: Bytes of compressed records after which a task begins another file.
FILE_BYTES = 4 << 20


def _record(kind: str, record_id: str, headers: list[str], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", *headers, f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def _member(record: bytes) -> bytes:
    """A gzip member of the record, ending in a zero byte."""
    packed = zlib.compress(record, 6, 31)
    return packed if packed[-1] == 0 else packed + zlib.compress(b"", 6, 31)


def _transaction(page: str, row: int, target: str, payload: bytes, owner: str | None, date: str) -> list[bytes]:
    """Records of the request, the response or revisit, and the metadata of one page."""
    own, digest = f"urn:page:{page}:{row}", hashlib.sha256(payload).hexdigest()
    head = [f"WARC-Date: {date}", f"WARC-Target-URI: {target}"]
    beside = f"WARC-Concurrent-To: <{own}:response>"
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d" % len(payload) + END
    http = ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}"]
    if owner is None:
        main = _record("response", f"{own}:response", head + http, status + payload)
    else:
        profile = "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        main = _record("revisit", f"{own}:response", [*head, *http, profile, f"WARC-Refers-To: <{owner}>"], status)
    return [
        _record("request", f"{own}:request", [*head, beside, "Content-Type: application/http; msgtype=request"], f"GET {target} HTTP/1.1".encode() + END),
        main,
        _record("metadata", f"{own}:metadata", [*head, beside, "Content-Type: application/warc-fields"], f"page-id: {page}\r\npayload-length: {len(payload)}\r\n".encode()),
    ]


def write(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Archive pages (page_id, url, html) under path."""
    rows = pages.select("page_id", F.monotonically_increasing_id().alias("row"), "url", F.coalesce("html", F.lit("")).alias("html"))
    digest = F.sha2("html", 256)
    first = F.min(F.struct("page_id", "row"))
    large = rows.filter((F.octet_length("html") >= MIN_REVISIT) & F.col("page_id").isNotNull())
    owners = stored(large.groupBy(digest.alias("digest")).agg(F.count("*").alias("n"), first.alias("owner")).filter("n > 1").select("digest", "owner"), "owners")
    linked = rows.withColumn("digest", digest).join(small(owners), "digest", "left")
    repeats = F.col("page_id") > F.col("owner.page_id")
    owner = F.when(repeats, F.concat_ws(":", F.lit("urn:page"), F.col("owner.page_id").cast("string"), F.col("owner.row").cast("string"), F.lit("response")))
    source = linked.select(F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("page"), "row", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A").alias("target"), owner.alias("owner"), "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, size = -1, FILE_BYTES
        for b in (part for whole in batches for part in slices(whole, 4, 1 << 20)):
            files, members = [], []
            for page, row, target, owner_id, html in zip(*(c.to_pylist() for c in b.columns)):
                if size >= FILE_BYTES:
                    file, size = file + 1, 0
                    info = _record("warcinfo", f"urn:uuid:{uuid.uuid4()}", [f"WARC-Date: {date}", "Content-Type: application/warc-fields"], b"format: WARC File Format 1.1\r\n")
                    files.append(file)
                    members.append(_member(info))
                for record in _transaction(page, row, target, html.encode(), owner_id, date):
                    files.append(file)
                    members.append(_member(record))
                    size += len(members[-1])
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.int32()), pa.array([m[:-1] for m in members], pa.binary())], names=["file", "value"])

    # a task's files are numbered in order, so each is written as it comes
    made = source.mapInArrow(tidy(run), "file int, value binary").select("file", F.col("value").cast("string").alias("value"))
    made.write.partitionBy("file").option("lineSep", "\0").option("compression", "none").text(path)


def _walk(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file, compressed by member or not at all."""
    rest = memoryview(data)
    while len(rest):
        if rest[:2] == b"\x1f\x8b":
            inflate = zlib.decompressobj(31)
            record = inflate.decompress(rest)
            if not inflate.eof:
                raise ValueError("a member is cut off")
            rest = rest[len(rest) - len(inflate.unused_data) :]
            if record:
                yield _parsed(record, len(record))
        else:
            headers, block = _parsed(bytes(rest), None)
            yield headers, block
            rest = rest[bytes(rest).index(END) + 4 + len(block) + 4 :]


def _parsed(record: bytes, size: int | None) -> tuple[dict[str, str], bytes]:
    stop = record.index(END)
    lines = record[:stop].decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("a record does not begin with its version")
    headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    end = stop + 4 + int(headers["content-length"])
    if record[end : end + 4] != END or (size is not None and size != end + 4):
        raise ValueError("a record does not end where its length says")
    return headers, record[stop + 4 : end]


def records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row a record: type, id, concurrent_to, refers_to, target, date, digest, digest_ok, payload_bytes, payload, block.

    payload is a response's body; block what other records hold. payloads=False leaves payload null.
    """
    schema = "type string, record_id string, concurrent_to string, refers_to string, target string, date string, digest string, digest_ok boolean, payload_bytes long, payload binary, block string"
    kinds = [pa.string()] * 7 + [pa.bool_(), pa.int64(), pa.binary(), pa.string()]
    names = [f.split()[0] for f in schema.split(", ")]
    bare = lambda v: v.strip("<>") if v else None

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(kinds), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows, size = [], 0
                for h, block in _walk(content.as_py()):
                    kind, digest, ok, length, body, text = h["warc-type"], h.get("warc-payload-digest"), None, None, None, None
                    if kind == "response":
                        body = block[block.index(END) + 4 :]
                        length, found = len(body), hashlib.sha256(body).hexdigest()
                        ok, digest = digest == f"sha256:{found}", found
                        body = body if payloads else None
                    else:
                        text, digest = block.decode("utf-8"), digest.removeprefix("sha256:") if digest else None
                    rows.append((kind, bare(h["warc-record-id"]), bare(h.get("warc-concurrent-to")), bare(h.get("warc-refers-to")), h.get("warc-target-uri"), h.get("warc-date"), digest, ok, length, body, text))
                    size += 1000 + len(body or b"")
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                yield batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(tidy(run), schema)


def captures(found: DataFrame) -> DataFrame:
    """One nested row a transaction: page_id, target, request, response (or revisit), metadata, digest, sizes, refers_to."""
    whole = F.struct(*found.columns)
    of = lambda *kinds: F.any_value(F.when(F.col("type").isin(*kinds), whole), ignoreNulls=True)
    joined = found.filter("type <> 'warcinfo'").groupBy(F.coalesce("concurrent_to", "record_id").alias("id")).agg(of("response", "revisit").alias("response"), of("request").alias("request"), of("metadata").alias("metadata")).filter("response is not null")
    field = lambda name: F.nullif(F.regexp_extract("metadata.block", rf"(?:^|\n){name}: ?([^\r\n]*)", 1), F.lit("")).try_cast("bigint")
    return joined.select(
        field("page-id").alias("page_id"),
        F.col("response.target").alias("target"),
        "request",
        "response",
        "metadata",
        F.coalesce("response.payload_bytes", field("payload-length")).alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.split("response.refers_to", ":")[2].try_cast("bigint").alias("refers_to"),
        F.coalesce("response.digest_ok", F.lit(True)).alias("digest_ok"),
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive pages into the shared folder and read the captures back, without payloads."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/aeros-warc-{uuid.uuid4().hex}"
    write(pages, path)
    return captures(records(spark, path, payloads=False))
