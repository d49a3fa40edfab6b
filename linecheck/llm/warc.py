"""WARC as a content-addressed archive.

The bytes of a payload are stored once, under their SHA-256; the exact header of every
record is stored by itself with the digest it belongs to. Records are put together again by
a join of the two tables, which checks every digest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linecheck.llm.common import as_bytes, stored

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"

# Shorter payloads are always stored as responses of their own.
LEAST_BYTES = 100


@dataclass(frozen=True)
class Archive:
    """``payloads`` (digest, payload) and ``headers`` (digest, header), both stored."""

    payloads: DataFrame
    headers: DataFrame


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a missing value; line ends within it are escaped."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(END)), F.lit(""))


def _header(first: Column) -> Column:
    revisit = first.isNotNull()
    return F.concat(
        F.lit(VERSION + END),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _urn(first))),
        _line("Content-Type", F.lit("text/html; charset=UTF-8")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit(END),
    )


def write(pages: DataFrame, least: int = LEAST_BYTES) -> Archive:
    """Archive pages (``page_id``, ``url``, ``html``) in the shared folder.

    Of the pages with the same payload of at least ``least`` bytes, that with the smallest
    id is a response and the others are revisits that refer to it; repeated rows of that
    page are responses as well. Shorter payloads, missing ones among them (empty), are
    responses. A page without id is a revisit if its payload has a page with one, else a
    response. Two different payloads under one digest raise an error. No pages give an
    empty archive.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        as_bytes(F.col("html")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))

    check = F.struct(F.octet_length("payload").alias("size"), F.xxhash64("payload").alias("hash"))
    facts = rows.select("page_id", "url", "digest", check.alias("check"))
    firsts = facts.groupBy("digest").agg(
        F.min("page_id").alias("first"), F.min("check").alias("low"), F.max("check").alias("high")
    )
    firsts = firsts.select(
        "digest",
        F.when(F.col("low") == F.col("high"), F.col("first"))
        .otherwise(F.raise_error(F.concat(F.lit("two payloads have the digest "), F.col("digest"))))
        .alias("first"),
    )
    known = facts.join(firsts, "digest").withColumn("size", F.col("check.size"))
    refers = F.when((F.col("size") >= least) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    headers = known.select("digest", F.encode(_header(refers), "UTF-8").alias("header"))

    payloads = rows.groupBy("digest").agg(F.first("payload").alias("payload"))
    return Archive(stored(payloads, "warc-payloads"), stored(headers, "warc-headers"))


def open_archive(spark: SparkSession, payloads: str, headers: str) -> Archive:
    """An archive written before, by the paths of its two tables."""
    return Archive(spark.read.parquet(payloads), spark.read.parquet(headers))


def _value(name: str, pattern: str = r"[^\r\n]*") -> Column:
    found = F.regexp_extract(F.col("header_text"), rf"\r\n{name}: ({pattern})\r\n", 1)
    return F.when(found != "", found)


def records(archive: Archive) -> DataFrame:
    """Every record: ``header`` and full ``payload`` in bytes, and what the header says.

    ``record`` holds the exact bytes of the WARC record: a revisit has no block of its own,
    its ``payload`` comes from the record that it refers to. A payload that does not match
    its digest raises an error.
    """
    rows = archive.headers.join(archive.payloads, "digest")
    text = F.decode(F.col("header"), "UTF-8")
    rows = rows.select("digest", "header", "payload", text.alias("header_text"), F.sha2("payload", 256).alias("found"))
    kind = _value("WARC-Type")
    block = F.when(kind == "response", F.col("payload")).otherwise(F.lit(b""))
    return rows.select(
        "header",
        "payload",
        F.concat(F.col("header"), block, F.lit((END * 2).encode())).alias("record"),
        _value("WARC-Record-ID", r"<urn:page:-?\d+>").substr(F.lit(11), F.lit(30)).alias("id"),
        kind.alias("record_type"),
        _value("WARC-Refers-To", r"<urn:page:-?\d+>").substr(F.lit(11), F.lit(30)).alias("to"),
        _value("WARC-Target-URI").alias("url"),
        F.when(F.col("found") == F.regexp_extract("header_text", r"WARC-Payload-Digest: sha256:([0-9a-f]{64})\r\n", 1), F.col("found"))
        .otherwise(F.raise_error(F.concat(F.lit("a payload does not match the digest "), F.col("digest"))))
        .alias("payload_digest"),
    ).select(
        F.regexp_replace("id", ">", "").cast("long").alias("page_id"),
        "url",
        "record_type",
        F.regexp_replace("to", ">", "").cast("long").alias("refers_to"),
        "payload_digest",
        "header",
        "payload",
        "record",
    )
