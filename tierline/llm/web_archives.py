"""WARC archives whose repeated payloads are revisit records."""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import workspace

# Fixed values of the archive format.
BREAK = "\r\n"
SEPARATOR = BREAK * 2
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

HEADERS = (
    "row_id bigint, uri string, record_type string, record_id string, payload_digest string,"
    " payload_bytes bigint, refers_to_id string"
)


def records_of(
    pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html"
) -> DataFrame:
    """`row_id, uri, payload, payload_bytes, payload_digest` of pages; a null payload is empty."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    return pages.select(
        F.col(id_col).cast("long").alias("row_id"),
        F.col(uri_col).cast("string").alias("uri"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("payload_digest"),
    )


def _record_id(row_id: Column, uri: Column, digest: Column) -> Column:
    text = F.md5(F.concat_ws("|", row_id.cast("string"), uri, digest))
    parts = [F.substring(text, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def mark_revisits(records: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Adds `record_type, record_id, original_id, original_uri`.

    Of the records with one payload of `least_bytes` or more, that with the largest row id is the
    response and the others revisit it; shorter payloads are always responses. Only headers are
    grouped by digest. Payloads then meet the digests that several records share, which are a
    table of their own, so that a digest with very many records is split over tasks.

    Repeated rows of the largest id are all responses. A null row id counts as the smallest, and
    where all are null, all are responses.
    """
    spark = records.sparkSession
    long = F.col("payload_bytes") >= least_bytes
    place = workspace.new_folder(spark, "archive-originals")
    (
        records.where(long)
        .groupBy("payload_digest")
        .agg(F.max(F.struct("row_id", "uri")).alias("original"), F.count("*").alias("records"))
        .where("records > 1")
        .select(
            F.col("payload_digest").alias("shared_digest"),
            F.col("original.row_id").alias("original_row"),
            F.col("original.uri").alias("original_uri"),
        )
        .write.parquet(place)
    )
    shared = spark.read.schema(
        "shared_digest string, original_row bigint, original_uri string"
    ).parquet(place)
    none = F.lit(None)
    marked = records.where(long).join(
        shared, F.col("payload_digest") == F.col("shared_digest"), "left"
    )
    revisit = F.col("shared_digest").isNotNull() & ~F.col("row_id").eqNullSafe(F.col("original_row"))
    chosen = [
        *("row_id", "uri", "payload", "payload_bytes", "payload_digest"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        _record_id(F.col("row_id"), F.col("uri"), F.col("payload_digest")).alias("record_id"),
        F.when(
            revisit, _record_id(F.col("original_row"), F.col("original_uri"), F.col("payload_digest"))
        ).alias("original_id"),
        F.when(revisit, F.col("original_uri")).alias("original_uri"),
    ]
    short = records.where(~long).withColumns(
        {
            "shared_digest": none.cast("string"),
            "original_row": none.cast("long"),
            "original_uri": none.cast("string"),
        }
    )
    return marked.select(*chosen).unionByName(short.select(*chosen))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null; line breaks in it are escaped."""
    clean = F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(BREAK)), F.lit(""))


def write_archives(marked: DataFrame, path: str, date: str) -> None:
    """Write records with fresh headers as gzip WARC files; a revisit has no payload.

    A record ends with two line breaks, which serve the text writer as its line separator.
    """
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}"),
        _line("Content-Length", F.col("payload_bytes").cast("string")),
        F.lit(BREAK),
    )
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    head = F.concat(
        F.lit(f"WARC/1.1{BREAK}"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", F.col("record_id")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("uri")),
        _line("X-Row-Id", F.col("row_id").cast("string")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        _line("WARC-Refers-To", F.col("original_id")),
        _line("WARC-Refers-To-Target-URI", F.col("original_uri")),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(BREAK),
    )
    marked.select(F.concat(head, block).alias("value")).write.option("lineSep", SEPARATOR).option(
        "compression", "gzip"
    ).text(path)


def parse(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, from what lies between the separators of archives."""
    separator = SEPARATOR.encode()
    parts: list[bytes] = []
    held, wanted = 0, 1
    for chunk in chunks:
        parts += (chunk, separator)
        held += len(chunk) + len(separator)
        while held >= wanted:
            # A payload that ends with a line break leaves a separator too many at a file's end.
            data = b"".join(parts).removeprefix(separator)
            parts, held = [data], len(data)
            if not held:
                break
            end = data.find(separator)
            if end < 0:
                wanted = held + 1
                break
            head = data[:end].decode().split(BREAK)
            if not head[0].startswith("WARC/"):
                raise ValueError(f"no record begins with {head[0][:40]!r}")
            headers = dict(line.split(": ", 1) for line in head[1:])
            begin = end + len(separator)
            after = begin + int(headers["Content-Length"])
            wanted = after + len(separator)
            if held < wanted:
                break
            yield headers, data[begin:after]
            parts = [data[wanted:]]
            held, wanted = held - wanted, 1
    if held:
        raise ValueError("an archive ends within a record")


def read_archives(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """`row_id, uri, record_type, record_id, payload_digest, payload_bytes, refers_to_id` of each
    record, and the payload (binary) on demand.

    Payloads are checked against their digests; `payload_bytes` of a revisit is null until it is
    resolved. Files are read as streams, one task each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunks() -> Iterator[bytes]:
            for batch in batches:
                yield from batch.column(0).to_pylist()

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
            )

        rows: list[tuple] = []
        size = 0
        for headers, block in parse(chunks()):
            body = block[block.index(SEPARATOR.encode()) + len(SEPARATOR) :]
            digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            whole = headers["WARC-Type"] == "response"
            if whole and hashlib.sha1(body).hexdigest() != digest:
                raise ValueError(f"record {headers['WARC-Record-ID']} does not have its digest")
            row = headers.get("X-Row-Id")
            rows.append(
                (
                    None if row is None else int(row),
                    headers.get("WARC-Target-URI"),
                    headers["WARC-Type"],
                    headers["WARC-Record-ID"],
                    digest,
                    len(body) if whole else None,
                    headers.get("WARC-Refers-To"),
                    *[body] * payload,
                )
            )
            size += len(body) * payload
            if len(rows) >= 1000 or size > 1 << 24:
                yield out(rows)
                rows, size = [], 0
        if rows:
            yield out(rows)

    schema = HEADERS + ", payload binary" * payload
    names = [field.split()[0] for field in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[field.split()[1]] for field in schema.split(", ")]
    lines = spark.read.option("lineSep", SEPARATOR).text(path)
    return lines.select(F.col("value").cast("binary")).mapInArrow(run, schema)


def resolve(spark: SparkSession, headers: DataFrame) -> DataFrame:
    """All records' headers with `refers_to`, the original's row id, and revisits' `payload_bytes`.

    Revisits are joined to the responses they name. A revisit whose original is not there keeps
    null in both. `headers` should be a stored table; it is read three times.
    """
    place = workspace.new_folder(spark, "archive-responses")
    (
        headers.where("record_type = 'response'")
        .groupBy("record_id")
        .agg(F.max("row_id").alias("refers_to"), F.max("payload_bytes").alias("original_bytes"))
        .withColumnRenamed("record_id", "original_id")
        .write.parquet(place)
    )
    originals = spark.read.schema(
        "original_id string, refers_to bigint, original_bytes bigint"
    ).parquet(place)
    revisits = headers.where("record_type = 'revisit'").join(
        originals, F.col("refers_to_id") == F.col("original_id"), "left"
    )
    found = revisits.withColumn("payload_bytes", F.col("original_bytes"))
    rest = headers.where("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    columns = [*headers.columns, "refers_to"]
    return rest.select(*columns).unionByName(found.select(*columns))


def archive_pages(
    pages: DataFrame,
    path: str,
    date: str,
    least_bytes: int = 1000,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
) -> DataFrame:
    """Write pages to deduplicated archives in `path`, read those back, resolve the revisits.

    One row for each page: the columns of read_archives() and `refers_to`. Null ids, addresses and
    payloads are kept (a missing header, an empty payload), repeated rows are records each, other
    columns are ignored, and no pages make no records.
    """
    spark = pages.sparkSession
    marked = mark_revisits(records_of(pages, id_col, uri_col, payload_col), least_bytes)
    write_archives(marked, path, date)
    place = workspace.new_folder(spark, "archive-headers")
    read_archives(spark, path).write.parquet(place)
    return resolve(spark, spark.read.schema(HEADERS).parquet(place))
