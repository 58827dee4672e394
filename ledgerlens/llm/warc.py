"""WARC archives: written with an index, read back by coalesced byte ranges.

Writing notes per record its file, offset, length, URL and payload digest. Reading starts
from the index: the selected records of a file are sorted by offset, ranges with small
gaps between them become one read, and each read is parsed for the records it holds.

Archives go to the shared folder through pyarrow's file systems, under names that no other
attempt of a task uses; only files that the stored index names are ever read, so a task
that ran twice does no harm.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import prepare, stored, whole_text
from ledgerlens.session import scratch_path

LEAST_REVISITED = 100
GAP_BYTES = 64 << 10
READ_BYTES = 4 << 20
INDEX = "page_id bigint, url string, digest string, payload_bytes bigint, record_type string, refers_to bigint, file string, offset bigint, length bigint"


def with_types(pages: DataFrame, least: int = LEAST_REVISITED) -> DataFrame:
    """page_id, url, html, payload digest and the page that a revisit refers to (null for responses).

    Digests are grouped without their payloads; the group's smallest page_id is the
    response. Only revisits are joined back, by a key that splits. Rows with equal page_id
    and payload are all written; a null page_id is a response and never the one referred to.
    """
    page = pages.select("page_id", "url", whole_text("html").alias("html")).withColumns(
        {"digest": F.sha2(F.encode("html", "UTF-8"), 256), "payload_bytes": F.octet_length("html").cast("long")}
    )
    groups = page.filter(F.col("payload_bytes") >= least).groupBy("digest").agg(
        F.min("page_id").alias("first_page"), F.count("*").alias("pages")
    )
    groups = groups.filter("pages > 1").drop("pages")
    return page.join(groups, "digest", "left").select(
        "page_id",
        "url",
        "html",
        "digest",
        "payload_bytes",
        F.when(F.col("first_page") != F.col("page_id"), F.col("first_page")).alias("refers_to"),
    )


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One gzip member with a response record, or with a revisit record without its payload."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {''.join((url or '').split())}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    if revisit:
        lines[3:3] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        lines[3:3] = [f"WARC-Refers-To: <urn:page:{refers_to}>"]
    plain = "\r\n".join([*lines, "", ""]).encode() + body + b"\r\n\r\n"
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress(plain) + squeeze.flush()


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of the first record in ``data``."""
    plain = zlib.decompressobj(31).decompress(data)
    head, _, rest = plain.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {name: value for name, _, value in (line.partition(": ") for line in lines)}
    return headers, rest[: int(headers["Content-Length"])]


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").rstrip(">")
    return int(number) if number else None


def write(typed: DataFrame, folder: str) -> DataFrame:
    """Write one archive per task under ``folder``; the stored index of all records."""
    prepare(typed.sparkSession)

    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        path, offset = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
        name = folder.rstrip("/") + "/" + path.rsplit("/", 1)[1]
        with store.open_output_stream(path, compression=None) as out:
            for batch in batches:
                out_rows: list[list] = [[] for _ in range(9)]
                for page_id, url, html, digest, size, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    data = record(page_id, url, html.encode(), digest, refers_to)
                    out.write(data)
                    kind = "response" if refers_to is None else "revisit"
                    row = (page_id, url, digest, size, kind, refers_to, name, offset, len(data))
                    for column, value in zip(out_rows, row):
                        column.append(value)
                    offset += len(data)
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                names = [c.split()[0] for c in INDEX.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out_rows, kinds)], names=names)

    columns = ("page_id", "url", "html", "digest", "payload_bytes", "refers_to")
    return stored(typed.select(*columns).mapInArrow(run, INDEX))


def byte_ranges(selected: DataFrame, gap: int = GAP_BYTES, most: int = READ_BYTES) -> DataFrame:
    """The reads that cover the selected index rows: file, start, end, and offset and length of each record.

    Records of a file are taken in order; one starts a new read after a gap, and where the
    records since the start of the file pass another multiple of ``most`` bytes.
    """
    order = Window.partitionBy("file").orderBy("offset")
    place = selected.select("file", "offset", "length").distinct()
    place = place.withColumn("before", F.lag(F.col("offset") + F.col("length")).over(order))
    starts = F.coalesce(F.col("offset") - F.col("before") > gap, F.lit(True)) | (
        F.floor(F.col("offset") / most) != F.floor(F.col("before") / most)
    )
    numbered = place.withColumn("read", F.sum(starts.cast("long")).over(order))
    return numbered.groupBy("file", "read").agg(
        F.min("offset").alias("start"),
        F.max(F.col("offset") + F.col("length")).alias("end"),
        F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"),
    )


def read(selected: DataFrame) -> DataFrame:
    """Parsed records of the selected index rows: page_id, url, type, digest header, body, refers_to.

    The body of a response is checked against the digest in its header; a wrong one raises.
    """
    # A number of tasks is asked for, since reads look small to the planner whatever they fetch.
    tasks = int(selected.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = byte_ranges(selected).select("file", "start", "end", "records").repartition(tasks, "file", "start")

    def parsed(batch: pa.RecordBatch) -> Iterator[tuple]:
        for row in batch.to_pylist():
            store, path = fs.FileSystem.from_uri(row["file"])
            with store.open_input_file(path) as source:
                source.seek(row["start"])
                data = io.BytesIO(source.read(row["end"] - row["start"])).getbuffer()
            for r in row["records"]:
                begin = r["offset"] - row["start"]
                headers, body = parse(data[begin : begin + r["length"]])
                digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                kind = headers["WARC-Type"]
                if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
                    raise ValueError(f"{row['file']} at {r['offset']}: payload and digest differ")
                refers_to = _page(headers.get("WARC-Refers-To"))
                yield _page(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], kind, digest, body, refers_to

    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64()]
    names = ["page_id", "url", "record_type", "digest", "body", "refers_to"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # one read at a time
                rows = list(parsed(batch.slice(i, 1)))
                columns = list(zip(*rows)) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = "page_id bigint, url string, record_type string, digest string, body binary, refers_to bigint"
    return ranges.mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, read all records back, and resolve revisits by the response they name."""
    spark = pages.sparkSession
    index = write(with_types(pages), scratch_path(spark, "warc"))
    records = read(index).select(
        "page_id",
        F.octet_length("body").cast("long").alias("body_bytes"),
        F.sha2("body", 256).alias("body_digest"),
        "digest",
        "record_type",
        "refers_to",
    )
    records = stored(records)
    responses = records.filter((F.col("record_type") == "response") & F.col("page_id").isNotNull())
    payloads = responses.select(F.col("page_id").alias("refers_to"), F.col("body_digest").alias("digest"), F.col("body_bytes").alias("full_bytes"))
    payloads = payloads.distinct()
    revisits = records.filter("record_type = 'revisit'").join(payloads, ["refers_to", "digest"])
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return (
        records.filter("record_type = 'response'")
        .select("page_id", F.col("body_bytes").alias("payload_bytes"), F.col("body_digest").alias("payload_digest"), "record_type", "refers_to")
        .unionByName(revisits.select("page_id", F.col("full_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"))
        .select(*columns)
    )
