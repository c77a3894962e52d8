"""Content-addressed WARC archive: payload bytes once by digest, exact record headers apart, records by joins.

An archive is a folder of two tables. `payloads` has each distinct payload once, under its SHA-256. `headers` has one row
per record: the WARC header and the start of the block (its HTTP header) byte for byte, and the payload's digest. Joining
them by digest gives every record back, revisits with the payload they refer to as well. `export` writes the records as
WARC files and `read_warc` reads such files, its own or others'.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardhouse.llm.common import arrow_flow, text_bytes

PAYLOADS, HEADERS = "payloads", "headers"
# Smaller payloads are not worth a reference.
MIN_BYTES = 100
CAPTURED = "1970-01-01T00:00:00Z"
FILE_BYTES = 64 << 20

# WARC 1.1 names.
VERSION, END = "WARC/1.1\r\n", "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE, REVISIT = "response", "revisit"


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value. Line breaks inside a value would end it and are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _record_id(id_: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(id_.cast("string")), F.lit("")), F.lit(":"), F.substring(digest, 1, 32), F.lit(">"))


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?i)\r\n{re.escape(name)}:[ \t]*([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def _page_of(record_id: Column, kind: str) -> Column:
    found = F.regexp_extract(record_id, "^<urn:page:([^:]*):", 1)
    return F.when(found != "", F.url_decode(found)).cast(kind)


def store_payloads(payloads: DataFrame, folder: str) -> None:
    """Adds to `folder` each distinct `body` of (digest, body) once, and how many rows had it and the least `id`.

    Copies are merged in each map task before the shuffle, so a payload that a third of all rows share moves once per
    task. Rows of one digest must agree in length and in a second hash; otherwise the write ends with an error.
    """
    check = F.struct(F.octet_length("body").alias("length"), F.xxhash64("body").alias("hash"))
    groups = payloads.groupBy("digest").agg(
        F.first("body").alias("payload"),
        F.min("id").alias("first_id"),
        F.min(check).alias("low"),
        F.max(check).alias("high"),
    )
    clash = F.raise_error(F.concat(F.lit("different payloads under one digest: "), F.col("digest")))
    same = F.when(F.col("low") == F.col("high"), F.col("low.length").cast("long")).otherwise(clash)
    rows = groups.select("digest", "payload", same.alias("payload_bytes"), "first_id")
    rows.write.parquet(f"{folder}/{PAYLOADS}", compression="zstd")


def write_archive(
    df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
    min_bytes: int = MIN_BYTES, captured: str = CAPTURED,
) -> None:
    """One record per row of `df`; the payload is the text in UTF-8, a null text the empty payload.

    Of records with equal payloads of at least `min_bytes` bytes, the one with the least id is a response and the others
    revisit it; all smaller ones are responses (their bytes are stored once too). Rows that repeat the least id are all
    responses. A null id is larger than any other; payloads that only null ids have are responses. A null url gives a record
    without a target. Other columns are ignored; no rows give an archive without records.
    """
    spark = df.sparkSession
    rows = df.select(df[id_col].alias("id"), df[url_col].cast("string").alias("url"), text_bytes(df, text_col).alias("body"))
    rows = rows.withColumn("digest", F.sha2("body", 256))
    store_payloads(rows.select("id", "digest", "body"), folder)

    stored = spark.read.parquet(f"{folder}/{PAYLOADS}").select("digest", "payload_bytes", "first_id")
    # The join moves no payloads; the adaptive join splits a hot digest.
    joined = rows.select("id", "url", "digest").join(stored, "digest")
    refers = (F.col("payload_bytes") >= min_bytes) & F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    length = F.col("payload_bytes")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), length.cast("string"), F.lit(END))
    made = joined.withColumns({"refers": refers, "prefix": http})
    block = F.octet_length("prefix") + F.when(F.col("refers"), F.lit(0)).otherwise(length)
    when_revisit = lambda value: F.when(F.col("refers"), value)
    header = F.concat(
        F.lit(VERSION),
        _line("WARC-Type", F.when(F.col("refers"), F.lit(REVISIT)).otherwise(F.lit(RESPONSE))),
        _line("WARC-Record-ID", _record_id(F.col("id"), F.col("digest"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Date", F.lit(captured)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Refers-To", when_revisit(_record_id(F.col("first_id"), F.col("digest")))),
        _line("WARC-Profile", when_revisit(F.lit(REVISIT_PROFILE))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        F.concat(F.lit("Content-Length: "), block.cast("string"), F.lit(END)),
    )
    made = made.select(header.alias("header"), "prefix", "digest", (~F.col("refers")).alias("has_payload"))
    made.write.parquet(f"{folder}/{HEADERS}", compression="zstd")


def store_records(records: DataFrame, folder: str) -> None:
    """An archive of (header, prefix, payload) as `read_warc` gives them: their exact headers, their payloads once.

    A revisit without a payload takes that of its `WARC-Payload-Digest`, if that is a SHA-256 in hex.
    """
    body = F.coalesce(F.col("payload"), F.lit(b""))
    rows = records.select("header", "prefix", body.alias("body"), (F.col("payload").isNotNull()).alias("has_payload"))
    named = _field(F.col("header").cast("string"), "WARC-Payload-Digest")
    named = F.regexp_extract(named, "(?i)^sha-?256:([0-9a-f]{64})$", 1)
    digest = F.when(F.col("has_payload") | F.coalesce(named == "", F.lit(True)), F.sha2("body", 256)).otherwise(F.lower(named))
    rows = rows.withColumn("digest", digest)
    store_payloads(rows.where("has_payload").select(F.lit(None).cast("long").alias("id"), "digest", "body"), folder)
    heads = rows.select(F.col("header").cast("string"), F.col("prefix").cast("string"), "digest", "has_payload")
    heads.write.parquet(f"{folder}/{HEADERS}", compression="zstd")


def read_archive(spark: SparkSession, folder: str, id_type: str = "long") -> DataFrame:
    """One row per record of an archive that `write_archive` made: page_id, url, record_type, refers_to, header, prefix, the
    full payload (revisits: the one they refer to), its payload_bytes and payload_digest as computed from the stored bytes.

    A payload that is missing or does not hash to its name ends the read with an error. The payload moves only if it is
    selected: its digest is computed where it is read.
    """
    heads = spark.read.parquet(f"{folder}/{HEADERS}")
    stored = spark.read.parquet(f"{folder}/{PAYLOADS}").select(
        "digest", "payload", F.sha2("payload", 256).alias("found"), F.octet_length("payload").cast("long").alias("payload_bytes")
    )
    joined = heads.join(stored, "digest", "left")
    wrong = F.raise_error(F.concat(F.lit("payload missing or damaged: "), F.col("digest")))
    sure = F.when(F.col("found") == F.col("digest"), F.col("found")).otherwise(wrong)
    header = F.col("header")
    return joined.select(
        _page_of(_field(header, "WARC-Record-ID"), id_type).alias("page_id"),
        _field(header, "WARC-Target-URI").alias("url"),
        _field(header, "WARC-Type").alias("record_type"),
        _page_of(_field(header, "WARC-Refers-To"), id_type).alias("refers_to"),
        "payload_bytes",
        sure.alias("payload_digest"),
        "header",
        "prefix",
        "payload",
    )


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Each record's exact bytes, as column `record`: header, block, two line ends."""
    heads = spark.read.parquet(f"{folder}/{HEADERS}")
    stored = spark.read.parquet(f"{folder}/{PAYLOADS}").select("digest", "payload")
    start = F.concat(F.col("header").cast("binary"), F.col("prefix").cast("binary"))
    # Revisits hold no payload, so only one record of a larger payload moves it.
    full = heads.where("has_payload").join(stored, "digest").select(F.concat(start, F.col("payload"), F.lit(END.encode())).alias("record"))
    return full.unionByName(heads.where("not has_payload").select(F.concat(start, F.lit(END.encode())).alias("record")))


def export(spark: SparkSession, archive: str, folder: str, file_bytes: int = FILE_BYTES, compression: str = "gzip") -> None:
    """The records as WARC files of about `file_bytes` each, before compression."""
    rows = records(spark, archive)
    total = rows.agg(F.sum(F.octet_length("record").cast("long"))).first()[0] or 0
    # The text writer ends each value with a line end: the second of the two behind a record.
    text = F.expr("substring(record, 1, octet_length(record) - 2)").cast("string")
    rows = rows.select(text.alias("value")).repartition(max(1, -(-total // file_bytes)))
    rows.write.text(folder, compression=compression, lineSep="\r\n")


def parse(data: bytes) -> Iterator[tuple[bytes, bytes, bytes | None]]:
    """(header, prefix, payload) of each record in a WARC file's bytes. The prefix is the HTTP header of a response; other
    blocks are payload as a whole, and revisits have none."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        stop = data.index(b"\r\n\r\n", at) + 4
        header = data[at:stop]
        fields = dict(re.findall(rb"\r\n([^:\r\n]+):[ \t]*([^\r\n]*)", header))
        fields = {k.lower(): v for k, v in fields.items()}
        end = stop + int(fields[b"content-length"])
        kind, block = fields.get(b"warc-type", b""), data[stop:end]
        if len(data) < end:
            raise ValueError("a WARC record is shorter than its header says")
        split = block.find(b"\r\n\r\n") + 4 if fields.get(b"content-type", b"").startswith(b"application/http") else 0
        split = max(split, 0) if split != 3 else 0
        if kind == REVISIT.encode():
            yield header, block, None
        else:
            yield header, block[:split], block[split:]
        at = end


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(header, prefix, payload) of every record in the WARC files of a folder, plain or gzip.

    A task holds one file at a time, so files should be of hundreds of megabytes at most; `export` writes small ones.
    """

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows: list[tuple] = []
                held = 0
                for row in parse(data):
                    rows.append(row)
                    held += sum(len(x) for x in row if x)
                    if held > 16 << 20:
                        yield dict(zip(("header", "prefix", "payload"), map(list, zip(*rows))))
                        rows, held = [], 0
                if rows:
                    yield dict(zip(("header", "prefix", "payload"), map(list, zip(*rows))))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").select("content")
    return arrow_flow(files, flow, "header binary, prefix binary, payload binary")
