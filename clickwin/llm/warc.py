"""WARC archives: writing, reading back and transaction assembly (operator 6).

Each page becomes three records: a response (or, for a payload seen before, a
revisit), its request and its metadata, the latter two pointing at the first
by ``WARC-Concurrent-To``.  Records are built with DataFrame functions and
written by Spark's text writer, whose line end is the empty line pair that
closes a WARC record, as gzip files under the job commit protocol; a lost
executor's part is written again whole.  Reading streams each file through a
small record parser.  Assembly joins the three record kinds in one shuffle
on the concurrent-to identifier.
"""

from __future__ import annotations

import base64
import hashlib
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwin.llm.common import batch_of
from clickwin.session import materialize, scratch_path

END = "\r\n\r\n"
FILE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"       # capture time of records whose table has none
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("record_id string, type string, concurrent_to string, refers_to string, uri string, "
          "page_id string, payload_bytes bigint, payload_digest string, payload binary")


def sha1_base32(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 20 bits (5 hex digits) give 4 symbols."""
    hexa = F.sha1(data)
    digits = [F.lpad(F.conv(F.substring(hexa, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(*parts: Column) -> Column:
    """A record id that follows from its parts (nulls and empty strings differ)."""
    h = F.sha1(F.to_json(F.array(*[p.cast("string") for p in parts])))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        F.substring(h, 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"),
        F.lit(">"))


def _record(kind: str, headers: dict, block: Column) -> Column:
    """One record without its closing line pair; null headers are left out."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.lit(f"WARC-Date: {DATE}")]
    lines += [F.concat(F.lit(f"{k}: "), v) for k, v in headers.items()]
    lines += [F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One string column ``value``: the records of all pages.

    Of the rows whose payloads are equal and of at least ``min_bytes`` bytes,
    those with the smallest page_id are responses and the others revisit
    them.  A null html is an empty payload.  A null page_id is never smallest;
    a group of only such rows is all responses.  Repeated rows give repeated,
    equal records.  Control characters and spaces of a url are escaped, a null
    url leaves the header out.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"),
                        F.octet_length(payload).alias("n"), sha1_base32(payload).alias("digest"))
    rows = rows.withColumn("id", _urn(F.col("page_id"), F.col("url"), F.col("digest")))
    # only payloads seen again: one narrow row each, hot ones summed up per task first
    named = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "id"))
    firsts = (rows.where(F.col("n") >= min_bytes).groupBy("digest")
              .agg(F.min(named).alias("first"), F.count("*").alias("seen"))
              .where("seen > 1").select("digest", "first"))
    rows = rows.join(firsts, "digest", "left")
    again = (F.col("n") >= min_bytes) & F.col("first").isNotNull() & \
        ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    uri = F.regexp_replace(F.regexp_replace("url", r"[\x00-\x1F\x7F]", "%00"), " ", "%20")
    uri = F.when(F.col("url") != "", uri)
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.col("n").cast("string"), F.lit(END))
    message = F.lit("application/http; msgtype=")
    response = _record("response", {
        "WARC-Record-ID": F.col("id"), "WARC-Target-URI": uri, "WARC-Payload-Digest": digest,
        "Content-Type": F.concat(message, F.lit("response"))}, F.concat(http, "payload"))
    revisit = _record("revisit", {
        "WARC-Record-ID": F.col("id"), "WARC-Target-URI": uri, "WARC-Payload-Digest": digest,
        "WARC-Profile": F.lit(PROFILE), "WARC-Refers-To": F.col("first.id"),
        "Content-Type": F.concat(message, F.lit("response"))}, http)
    request = _record("request", {
        "WARC-Record-ID": _urn(F.lit("request"), F.col("id")), "WARC-Target-URI": uri,
        "WARC-Concurrent-To": F.col("id"),
        "Content-Type": F.concat(message, F.lit("request"))},
        F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1" + END)))
    metadata = _record("metadata", {
        "WARC-Record-ID": _urn(F.lit("metadata"), F.col("id")), "WARC-Target-URI": uri,
        "WARC-Concurrent-To": F.col("id"), "Content-Type": F.lit("application/warc-fields")},
        F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"),
                            F.lit("\r\n")), F.lit("")))
    return rows.select(F.explode(F.array(F.when(again, revisit).otherwise(response),
                                         request, metadata)).alias("value"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0,
                   file_bytes: int = FILE_BYTES) -> None:
    """Gzipped WARC files of about ``file_bytes`` (before compression) each."""
    mean = pages.agg(F.avg(F.coalesce(F.octet_length("html"), F.lit(0)))).first()[0] or 0
    per_file = 3 * max(1, int(file_bytes / (mean + 1500)))       # captures stay in one file
    (records(pages, min_bytes).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", per_file).text(path))


def parse_records(stream):
    """(headers, block) of every record of a binary stream; header names are
    lower-cased."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("a WARC record ends before its length")
        yield headers, block


def _row(headers: dict, block: bytes, payloads: bool) -> tuple:
    kind = headers["warc-type"]
    page = size = digest = body = None
    if kind in ("response", "revisit"):
        head, _, body = block.partition(END.encode())
        http = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:])
        size, digest = int(http["Content-Length"]), headers["warc-payload-digest"][5:]
        if kind == "response" and (len(body) != size or digest != base64.b32encode(
                hashlib.sha1(body).digest()).decode()):
            raise ValueError(f"payload of {headers['warc-record-id']} does not fit its digest")
    elif kind == "metadata":
        page = dict(x.split(": ", 1) for x in block.decode().splitlines()).get("page-id")
    return (headers["warc-record-id"], kind, headers.get("warc-concurrent-to"),
            headers.get("warc-refers-to"), headers.get("warc-target-uri"), page, size, digest,
            body if payloads and kind == "response" else None)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives, one row each; a response's payload is held
    against its digest.  ``payloads=False`` leaves the payload column null."""
    import gzip

    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(spark.createDataFrame([], RECORD).schema)

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for headers, block in parse_records(gzip.GzipFile(
                        fileobj=io.BytesIO(content.as_py()))):
                    rows.append(_row(headers, block, payloads))
                    size += len(block) if payloads else 200
                    if size > 8 << 20:
                        yield batch_of(arrow, *map(list, zip(*rows)))
                        rows, size = [], 0
                if rows:
                    yield batch_of(arrow, *map(list, zip(*rows)))

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
             .load(path).select("content"))
    return files.mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture, copies, response, request,
    metadata``.

    All three kinds meet by the identifier of the response (their
    ``concurrent_to``, or its own id) in one shuffle; equal records of
    repeated pages count as ``copies``.  A missing kind is a null struct.
    """
    def of(*kinds, fields):
        return F.max(F.when(F.col("type").isin(*kinds), F.struct(*fields)))

    main = F.col("type").isin("response", "revisit")
    return (records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture"))
            .agg(F.count(F.when(main, 1)).alias("copies"),
                 of("response", "revisit", fields=["type", "uri", "refers_to", "payload_bytes",
                                                   "payload_digest", "payload"]).alias("response"),
                 of("request", fields=["record_id", "uri"]).alias("request"),
                 of("metadata", fields=["record_id", "page_id"]).alias("metadata")))


def captures_digest(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archives of ``pages`` written to the shared folder, read back and
    assembled: ``page_id, payload_bytes, payload_digest, record_type,
    refers_to``, one row per page (an empty table gives none)."""
    spark = pages.sparkSession
    id_type = pages.schema["page_id"].dataType.simpleString()
    path = scratch_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    got = assemble(read_archives(spark, path, payloads=False))
    got = materialize(got.select("capture", "copies", "response",
                                 F.col("metadata.page_id").cast(id_type).alias("page_id")),
                      "captures")
    # a hot response is referred to by many: its side has one row per record;
    # a response looks itself up, so that no third of the rows shares a null key
    target = got.select(F.col("capture").alias("to"), F.col("page_id").alias("first"))
    sought = F.coalesce("response.refers_to", "capture")
    return (got.join(target, sought == F.col("to"), "left")
            .select("page_id", "response.payload_bytes", "response.payload_digest",
                    F.col("response.type").alias("record_type"),
                    F.when(F.col("response.refers_to").isNotNull(), F.col("first"))
                    .alias("refers_to"),
                    F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
            .drop("copy"))
