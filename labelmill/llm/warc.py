"""Web archives: written with segments, read back by segment reassembly.

A record is a block of text with the line feeds of the format; Spark's text
writer puts one per line, and the two line breaks that close a record are the
writer's line separator. A payload that was already stored is written as a
revisit. A response is sent in chunks, and one longer than a segment goes on in
continuation records.

Reading parses every file by the lengths its records state. Segments are grouped
by the record they continue, put in the order of their numbers, joined, held
against the stated total length, freed of the chunked transfer framing and held
against the digest.
"""

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.session import scratch_path, stored

CRLF = b"\r\n"
VERSION = b"WARC/1.1"
# Bytes of a record's block before it goes on in the next segment, and of a
# chunk of the transfer framing.
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
# Records in one file; their payloads are read by one task.
FILE_RECORDS = 1_000
# Payloads or ids that occur more than once and may be broadcast, once counted;
# each takes about 50 bytes.
REPEATED_ROWS = 100_000
HTTP_HEAD = CRLF.join(
    [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Transfer-Encoding: chunked"]
)
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# One row per record of a file: the fields of its head and its block.
PARSED = (
    "page_id long, record_id string, origin string, kind string, segment long, total long, "
    "payload_digest string, refers_to string, block binary"
)


def chunked(payload: bytes) -> bytes:
    parts = []
    for start in range(0, len(payload), CHUNK_BYTES):
        piece = payload[start : start + CHUNK_BYTES]
        parts += [f"{len(piece):x}".encode(), CRLF, piece, CRLF]
    return b"".join([*parts, b"0", CRLF, CRLF])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; an unfinished or damaged one is an error."""
    parts, at = [], 0
    while True:
        end = body.index(CRLF, at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(parts)
        if body[at + size : at + size + 2] != CRLF:
            raise ValueError("chunk without its end")
        parts.append(body[at : at + size])
        at += size + 2


def unzipped(data: bytes) -> bytes:
    """All members of a gzip file."""
    parts = []
    while data:
        member = zlib.decompressobj(31)
        parts.append(member.decompress(data))
        data = member.unused_data
    return b"".join(parts)


def record_id(name: str, segment: int = 1) -> str:
    return f"<urn:page:{name}>" if segment == 1 else f"<urn:page:{name}:{segment}>"


def _head(fields: list[tuple[str, str]]) -> bytes:
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in fields]
    return CRLF.join(lines) + CRLF + CRLF


def records_of(
    name: str, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> Iterator[bytes]:
    """The records of a page, each without its closing line breaks."""
    common = [
        ("WARC-Record-ID", record_id(name)),
        ("WARC-Target-URI", " ".join((url or "").split())),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if refers_to is not None:
        more = [
            ("WARC-Profile", REVISIT_PROFILE.decode()),
            ("WARC-Refers-To", record_id(str(refers_to))),
        ]
        yield _head([("WARC-Type", "revisit"), *common, *more, ("Content-Length", "0")])
        return
    block = HTTP_HEAD + CRLF + CRLF + chunked(payload)
    pieces = [block[i : i + SEGMENT_BYTES] for i in range(0, len(block), SEGMENT_BYTES)]
    for number, piece in enumerate(pieces, start=1):
        if number == 1:
            fields = [("WARC-Type", "response"), *common]
        else:
            fields = [
                ("WARC-Type", "continuation"),
                ("WARC-Record-ID", record_id(name, number)),
                ("WARC-Segment-Origin-ID", record_id(name)),
            ]
        if len(pieces) > 1:
            fields.append(("WARC-Segment-Number", str(number)))
            if number == len(pieces):
                fields.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _head([*fields, ("Content-Length", str(len(piece)))]) + piece


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Heads and blocks of an archive, by the lengths the heads state."""
    at = 0
    while at < len(data):
        if data[at : at + len(VERSION)] != VERSION:
            raise ValueError(f"no record at byte {at}")
        end = data.index(CRLF + CRLF, at)
        lines = data[at:end].decode("utf-8").split("\r\n")[1:]
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        at = end + 4
        size = int(fields["Content-Length"])
        yield fields, data[at : at + size]
        at += size
        if data[at : at + 4] != CRLF + CRLF:
            raise ValueError(f"record not closed at byte {at}")
        at += 4


def _looked_up(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with a stored table that is broadcast if it is counted to be short."""
    short = table.limit(REPEATED_ROWS + 1).count() <= REPEATED_ROWS
    return rows.join(F.broadcast(table) if short else table, keys, "left")


def with_revisits(
    pages: DataFrame, id_column: str, url_column: str, html_column: str, least_bytes: int
) -> DataFrame:
    """Pages with payload, digest and, for a revisit, the page it refers to.

    ``id_repeated`` marks rows whose id does not name a record alone.
    """
    payload = F.coalesce(F.col(html_column).cast("binary"), F.lit(b""))
    given = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        payload.alias("payload"),
        F.unhex(F.sha1(payload)).alias("sha"),
        F.octet_length(payload).alias("n_bytes"),
    )
    held = given.filter(F.col("n_bytes") >= least_bytes).groupBy("sha", "n_bytes").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("held")
    )
    ids = given.groupBy("page_id").count().filter("count > 1").select("page_id", F.lit(True).alias("more"))
    # Only what occurs more than once is looked up.
    repeated = stored(held.filter("held > 1").drop("held"), "repeated-payloads")
    known = _looked_up(given, repeated, ["sha", "n_bytes"])
    known = _looked_up(known, stored(ids, "repeated-ids"), ["page_id"])
    return known.withColumns(
        {
            "refers_to": F.when(F.col("page_id") != F.col("first_id"), F.col("first_id")),
            "id_repeated": F.col("page_id").isNull() | F.col("more").isNotNull(),
        }
    )


def write_archives(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    least_bytes: int = 0,
) -> None:
    """One record per page, in gzipped archives of bounded size below ``path``.

    Of payloads of at least ``least_bytes`` that are equal, the one with the
    smallest id is a response and the others revisit it.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for page, url, payload, sha, refers, repeated in zip(*(batch[c] for c in wanted)):
                count += 1
                name = f"{page}:copy-{task}-{count}" if repeated else page
                digest = base64.b32encode(sha).decode()
                refers = None if pd.isna(refers) else int(refers)
                out += records_of(name, url, bytes(payload), digest, refers)
            yield pd.DataFrame({"record": out})

    wanted = ["page", "url", "payload", "sha", "refers_to", "id_repeated"]
    known = with_revisits(pages, id_column, url_column, html_column, least_bytes)
    named = known.withColumn("page", F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    records = named.select(*wanted).mapInPandas(write, "record binary")
    # The bytes pass through as they are: a string column is not decoded.
    records.select(F.col("record").cast("string").alias("value")).write.option(
        "lineSep", "\r\n\r\n"
    ).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def parsed_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``: fields of its head, its block."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                out = []
                for fields, block in parse_records(unzipped(bytes(content))):
                    rid = fields["WARC-Record-ID"]
                    page = rid[len("<urn:page:") : -1].split(":")[0]
                    out.append(
                        (
                            int(page) if page else None,
                            rid,
                            fields.get("WARC-Segment-Origin-ID", rid),
                            fields["WARC-Type"],
                            int(fields.get("WARC-Segment-Number", 0)),
                            int(fields.get("WARC-Segment-Total-Length", -1)),
                            fields.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
                            fields.get("WARC-Refers-To"),
                            block,
                        )
                    )
                names = [c.split()[0] for c in PARSED.split(", ")]
                frame = pd.DataFrame(out, columns=names)
                frame["page_id"] = frame["page_id"].astype("Int64")
                yield frame

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInPandas(parse, PARSED)


def reassembled(records: DataFrame) -> DataFrame:
    """Whole blocks: segments grouped by origin, in order, of the stated length.

    Records without a segment number pass through and are not shuffled. A
    missing segment or another length than the stated is an error.
    """
    single = records.filter("segment = 0").select("page_id", "kind", "payload_digest", "refers_to", "block")
    parts = records.filter("segment > 0").groupBy("origin").agg(
        F.first("page_id").alias("page_id"),
        F.max(F.when(F.col("segment") == 1, F.col("payload_digest"))).alias("payload_digest"),
        F.count("*").alias("held"),
        F.max("segment").alias("last"),
        F.max("total").alias("total"),
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"),
    )
    # Bytes pass through a string unchanged, which is never decoded.
    joined = F.array_join(F.transform("parts", lambda p: p.block.cast("string")), "").cast("binary")
    whole = parts.select(
        "page_id",
        F.lit("response").alias("kind"),
        "payload_digest",
        F.lit(None).cast("string").alias("refers_to"),
        joined.alias("block"),
        "held",
        "last",
        "total",
    )
    fits = (F.col("held") == F.col("last")) & (
        F.octet_length("block") == F.col("total")
    )
    checked = whole.withColumn(
        "block",
        F.when(fits, F.col("block")).otherwise(
            F.raise_error(F.lit("segments are missing or differ from their total length")).cast("binary")
        ),
    )
    return single.unionByName(checked.drop("held", "last", "total"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload, payload_bytes, payload_digest, record_type, refers_to)``.

    A revisit has no payload of its own; its length is that of the response it
    refers to. A payload that differs from its digest is an error.
    """

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            payloads = []
            for kind, block, digest in zip(batch["kind"], batch["block"], batch["payload_digest"]):
                if kind == "revisit":
                    payloads.append(None)
                    continue
                payload = dechunked(bytes(block).split(CRLF + CRLF, 1)[1])
                if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError("payload differs from its digest")
                payloads.append(payload)
            yield pd.DataFrame(
                {
                    "page": batch["page"],
                    "payload": payloads,
                    "payload_digest": batch["payload_digest"],
                    "record_type": batch["kind"],
                    "refers": batch["refers"],
                }
            )

    whole = reassembled(parsed_archives(spark, path))
    shown = whole.select(
        F.col("page_id").cast("string").alias("page"),
        "kind",
        "block",
        "payload_digest",
        F.regexp_extract("refers_to", "urn:page:(-?[0-9]+)", 1).alias("refers"),
    )
    read = shown.mapInPandas(
        decode, "page string, payload binary, payload_digest string, record_type string, refers string"
    )
    return read.select(
        F.col("page").cast("long").alias("page_id"),
        "payload",
        "payload_digest",
        "record_type",
        F.when(F.col("refers") != "", F.col("refers").cast("long")).alias("refers_to"),
    )


def archived_pages(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Write the pages to archives in the shared folder, read them back, list their records.

    One row per page: ``(page_id, payload_bytes, payload_digest, record_type,
    refers_to)``; length and digest are those of the full payload, also for a
    revisit, whose length comes from the response it refers to. Null html counts
    as empty, null urls as empty. Rows with a null id never are the response
    others refer to unless no other has that payload; then all of them are
    responses. Rows repeated with their id each give a record of their own. An
    empty table gives an empty result; other columns are not read.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path, id_column, url_column, html_column, least_bytes)
    found = read_archives(spark, path).withColumn("own_bytes", F.octet_length("payload").cast("long"))
    listed = stored(found.drop("payload"), "archived")
    # Ids may be repeated with other payloads; the digest tells these apart.
    lengths = listed.filter("record_type = 'response'").groupBy(
        F.col("page_id").alias("response_id"), F.col("payload_digest").alias("response_digest")
    )
    lengths = stored(lengths.agg(F.max("own_bytes").alias("response_bytes")), "lengths")
    same = (listed.refers_to == lengths.response_id) & (listed.payload_digest == lengths.response_digest)
    return listed.join(lengths, same, "left").select(
        "page_id",
        F.coalesce("own_bytes", "response_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )
