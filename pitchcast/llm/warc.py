"""WARC archive, content-addressed: payload bytes stored once per verified digest, exact record headers kept apart,
records reconstructed by a join.

An archive has two folders. ``headers`` holds one row per record: its header block and the digest of its payload.
``payloads`` holds WARC/1.1 files with one resource record per distinct payload, which any reader of the format can open;
a payload's record and address are named by its digest. Each of those opens with a line
that names a boundary drawn at random for the archive, which no payload can hold, so that Spark can part the files
at records whatever the payloads contain.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchcast.session import scratch_path

from .common import table

LEAST_SHARED = 100   # a record with fewer payload bytes is a response even if another has the same payload
EOL = "\r\n"
EMPTY = b""
#: Fixed value: how the format names a revisit whose payload is the same.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    """A header line; none for a null value."""
    clean = F.regexp_replace(value.cast("string"), r"[\r\n]+", " ")
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), clean, F.lit(EOL))).otherwise("")


def header(headers: Column, name: str) -> Column:
    """The value of a header line; null without one."""
    found = F.regexp_extract(headers, rf"(?md)^{name}: ([^\r\n]*)\r?$", 1)
    return F.when(headers.contains(f"\n{name}: "), found)


def _urn(id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), id.cast("string"), F.lit(">"))


def page_of(urn: Column) -> Column:
    return F.regexp_extract(urn, "^<urn:page:(.*)>$", 1)


def write_archive(records: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url",
                  payload_col: str = "html", least_shared: int = LEAST_SHARED, date: str | None = None) -> str:
    """Archive one record per row of ``records`` in a new folder ``path``; returns the boundary of its files.

    All records bear the ``date`` (``2026-03-01T00:00:00Z``; now, if it is not given). Revisits have no payload of their own.

    The payload is a string (as UTF-8) or binary column; null is empty. Of the records
    with equal payloads of at least ``least_shared`` bytes, that with the smallest id is
    the response and the others revisit it; records with smaller ones are all responses.
    Records with a null id revisit the response, and are all responses where no record
    of their payload has an id. Rows that repeat the smallest id are all responses.
    Other columns are not read; an empty table gives an empty archive.

    Only digests are grouped, and combined map-side: copies held by a third of all rows
    are one row per task. Payload bytes go from the scan to the files; they are shuffled only where the
    list of shared digests is too large to broadcast.
    """
    boundary = uuid.uuid4().hex
    date = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(bytearray(EMPTY)))
    rec = records.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{uri_col}`").cast("string").alias("uri"), payload.alias("payload"))
    rec = rec.select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("bytes"))
    shared = (rec.groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
              .where("n > 1").select("digest", "first_id", F.lit(True).alias("shared")))

    slim = rec.select("id", "uri", "digest", "bytes").join(shared, "digest", "left")
    revisit = (F.col("bytes") >= least_shared) & F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    block = F.concat(F.lit(f"WARC/1.1{EOL}"), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
                     _line("WARC-Record-ID", _urn(F.col("id"))), _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", F.col("uri")),
                     _line("WARC-Profile", F.when(revisit, SAME_PAYLOAD)),
                     _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
                     _line("WARC-Refers-To", F.when(revisit, _urn(F.col("first_id")))),
                     F.lit(f"Content-Type: text/html{EOL}"),
                     _line("Content-Length", F.when(revisit, 0).otherwise(F.col("bytes"))))
    slim.select(block.alias("headers"), "digest").write.parquet(f"{path}/headers")

    # of a shared payload only the rows with its smallest id offer bytes; those that repeat that id are dropped at reading
    keep = F.col("shared").isNull() | F.col("id").eqNullSafe(F.col("first_id"))
    whole = rec.join(shared, "digest", "left").where(keep)
    record = F.concat(F.lit(f"WARC/1.1{EOL}WARC-Boundary: {boundary}{EOL}WARC-Type: resource{EOL}WARC-Record-ID: <urn:sha256:"), F.col("digest"),
                      F.lit(f">{EOL}WARC-Date: {date}{EOL}WARC-Target-URI: urn:sha256:"), F.col("digest"),
                      F.lit(f"{EOL}WARC-Payload-Digest: sha256:"), F.col("digest"),
                      F.lit(f"{EOL}Content-Type: application/octet-stream{EOL}Content-Length: "), F.col("bytes").cast("string"), F.lit(EOL * 2))
    (whole.select(F.concat(record.cast("binary"), "payload").cast("string").alias("value"))
     .write.option("lineSep", EOL * 2).option("compression", "gzip").text(f"{path}/payloads"))
    return boundary


def read_payloads(spark: SparkSession, path: str, boundary: str) -> DataFrame:
    """(digest, bytes, payload) of each stored record. A payload whose length or SHA-256 is not the one its record
    states ends the query with an error."""
    opening = f"WARC/1.1{EOL}WARC-Boundary: {boundary}{EOL}"
    raw = spark.read.option("lineSep", EOL * 2 + opening).text(f"{path}/payloads")
    # the first record of a file has nothing before it, so its opening is still there
    raw = raw.select(F.when(F.col("value").startswith(opening), F.expr(f"substring(value, {len(opening) + 1})"))
                     .otherwise(F.col("value")).alias("value"))
    head = F.concat(F.lit("\n"), F.substring_index("value", EOL * 2, 1), F.lit("\r"))
    raw = raw.select("value", head.alias("head"), (F.octet_length(F.substring_index("value", EOL * 2, 1)) + 5).alias("at"))
    raw = raw.select(F.col("value").cast("binary").alias("raw"), "at", header(F.col("head"), "Content-Length").cast("int").alias("bytes"),
                     F.replace(header(F.col("head"), "WARC-Payload-Digest"), F.lit("sha256:"), F.lit("")).alias("digest"))
    got = raw.select("digest", F.col("bytes").cast("long").alias("bytes"), F.substring("raw", F.col("at"), F.col("bytes")).alias("payload"))
    right = (F.octet_length("payload") == F.col("bytes")) & (F.sha2("payload", 256) == F.col("digest"))
    return got.select(F.when(right, F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("digest")))).alias("digest"), "bytes", "payload")


def read_records(spark: SparkSession, path: str, boundary: str, payloads: bool = True) -> DataFrame:
    """Each record again: page_id (string), record_type, refers_to, headers, payload_digest, payload_bytes and, unless
    told otherwise, ``payload`` and ``record``, the whole record's bytes. The payload of a revisit is the one it refers to; its
    record has none, as its Content-Length says."""
    store = read_payloads(spark, path, boundary)
    store = store.groupBy("digest").agg(F.first("bytes").alias("bytes"), *([F.first("payload").alias("payload")] * payloads))
    heads = spark.read.parquet(f"{path}/headers")
    both = heads.join(store, "digest")
    h = F.col("headers")
    out = both.select(page_of(header(h, "WARC-Record-ID")).alias("page_id"), header(h, "WARC-Type").alias("record_type"),
                      page_of(header(h, "WARC-Refers-To")).alias("refers_to"), "headers",
                      F.col("digest").alias("payload_digest"), F.col("bytes").alias("payload_bytes"),
                      *([F.col("payload")] * payloads))
    if payloads:
        crlf = F.lit(EOL).cast("binary")
        own = F.when(F.col("record_type") == "revisit", F.lit(bytearray(EMPTY))).otherwise(F.col("payload"))
        out = out.withColumn("record", F.concat(F.col("headers").cast("binary"), crlf, own, crlf, crlf))
    return out


def query(spark, sf):
    pages = table(spark, sf, "pages")
    path = scratch_path(spark, "warc")
    boundary = write_archive(pages, path)
    kind = dict(pages.dtypes)["page_id"]
    out = read_records(spark, path, boundary, payloads=False)
    return out.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast(kind).alias("refers_to"))


SQL = r"""
with q as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
r as (select *, min(page_id) over (partition by payload_digest) as first_id from q)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
from r
"""
