"""WARC archives with revisit records: write, read back, and resolve revisits.

Of records with equal payloads the one with the smallest id is the response, the others are revisits that refer to it. Only
headers are shuffled to decide that: the payload's SHA-256 is its key. Digests of a single record need no join; the others
meet their response in a join whose key carries a salt, so that one payload may belong to a third of all records.

An archive folder holds plain WARC 1.1 text written by Spark's text sink. Payloads are UTF-8 text. The first header of each
record names the archive by a random boundary, so the version line and that header together mark where records start, whatever a
payload holds; the reader splits there, with no file read whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grove.llm.common import pick, saved

VERSION = "WARC/1.1\r\n"
BOUNDARY = "WARC-Archive-Boundary: "
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SALTS = 32  # tasks among which the revisits of one payload are spread
END = "\r\n\r\n"


def _start(boundary: str) -> str:
    return f"{VERSION}{BOUNDARY}{boundary}\r\n"


def resolve(headers: DataFrame, min_bytes: int = 100) -> DataFrame:
    """Adds ``record_type`` and ``refers_to`` to headers ``record_id, payload_bytes, payload_digest``.

    Payloads under ``min_bytes`` are responses all, and so are rows without a digest or an id. Rows of equal id and digest: all are
    the response if the smallest.
    """
    fit = F.col("payload_bytes") >= min_bytes
    shared = (
        headers.where(fit & F.col("record_id").isNotNull())
        .groupBy("payload_digest")
        .agg(F.min("record_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("payload_digest", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = headers.withColumn("salt", F.when(fit, F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int")))
    joined = salted.join(shared, ["payload_digest", "salt"], "left").drop("salt")
    again = F.col("first_id").isNotNull() & (F.col("record_id") > F.col("first_id"))
    return joined.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(again, F.col("first_id"))
    ).drop("first_id")


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; those whose value is null are left out."""
    return F.concat_ws("", *[F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in pairs])


def _clean(c: Column) -> Column:
    """A header value stays on its line."""
    return F.regexp_replace(c, "[\\r\\n]+", " ")


def write_archive(records: DataFrame, path: str, min_bytes: int = 100, date: str = "2000-01-01T00:00:00Z") -> str:
    """Write ``record_id, url, payload`` as a deduplicated archive with fresh headers; returns its boundary.

    A null payload is empty, a null url leaves out the target header. Revisits have no block. Only
    headers are shuffled to tell them; a payload goes straight from its row to its file.
    """
    boundary = uuid.uuid4().hex
    records = pick(records, "record_id", "url", "payload").withColumn("payload", F.coalesce("payload", F.lit("")))
    digest = F.sha2("payload", 256)
    whole = records.withColumns({"payload_digest": digest, "payload_bytes": F.octet_length("payload").cast("long")})
    again = resolve(whole.select("record_id", "payload_bytes", "payload_digest"), min_bytes).where("record_type = 'revisit'")
    marks = again.select(F.col("record_id").alias("again_id"), F.col("payload_digest").alias("again_digest"), "refers_to").distinct()
    same = (F.col("record_id") == F.col("again_id")) & (F.col("payload_digest") == F.col("again_digest"))
    named = whole.join(marks, same, "left")
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    head = _lines(
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", F.concat(F.lit("<urn:record:"), F.coalesce(F.col("record_id").cast("string"), F.lit("")), F.lit(">"))),
        ("WARC-Target-URI", _clean(F.col("url"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        ("WARC-Refers-To", F.concat(F.lit("<urn:record:"), F.col("refers_to").cast("string"), F.lit(">"))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.octet_length(block).cast("string")),
    )
    text = F.concat(F.lit(_start(boundary)), head, F.lit("\r\n"), block)
    named.select(text.alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", 50_000).text(path)
    return boundary


def read_archive(spark: SparkSession, path: str, boundary: str) -> DataFrame:
    """Records of a written archive: ``record_id`` (string), ``record_type, url, payload_digest, refers_to`` (string) and ``payload``.

    ``payload`` is null for revisits. A block whose length isn't what its header says raises an error.
    """
    raw = spark.read.option("lineSep", _start(boundary)).text(path).where(F.col("value") != "")
    cut = F.locate(END, F.col("value"))
    raw = raw.select(
        F.substr("value", F.lit(1), cut + 1).alias("head"),
        F.substr("value", cut + len(END), F.length("value") - cut - 2 * len(END) + 1).alias("block"),
    )

    def header(name: str) -> Column:
        found = F.regexp_extract("head", f"(?:^|\n){name}: ([^\r\n]*)\r\n", 1)
        return F.when(found != "", found)

    ident = lambda c: F.regexp_extract(c, "^<urn:record:(.*)>$", 1)
    rows = raw.select(
        F.when(ident(header("WARC-Record-ID")) != "", ident(header("WARC-Record-ID"))).alias("record_id"),
        header("WARC-Type").alias("record_type"),
        header("WARC-Target-URI").alias("url"),
        F.regexp_replace(header("WARC-Payload-Digest"), "^sha256:", "").alias("payload_digest"),
        ident(header("WARC-Refers-To")).alias("refers_to"),
        header("Content-Length").cast("long").alias("n"),
        "block",
    )
    right = F.octet_length("block") == F.col("n")
    block = F.when(right, F.col("block")).otherwise(F.raise_error(F.concat(F.lit("a block has not its stated length: record "), F.col("record_id"))))
    return rows.select("record_id", "record_type", "url", "payload_digest", "refers_to", block.alias("block")).select(
        "record_id", "record_type", "url", "payload_digest", "refers_to", F.when(F.col("record_type") == "response", F.col("block")).alias("payload"), F.octet_length("block").alias("block_bytes")
    )


def resolved_headers(archive: DataFrame) -> DataFrame:
    """Headers of an archive, where revisits have taken digest and size of the response that they refer to.

    ``record_id, payload_bytes, payload_digest, record_type, refers_to``. What counts for a response is its payload as read. A revisit whose
    response is missing keeps a null size. Responses that revisits need are found by digest, with a salt again.
    """
    heads = saved(
        archive.select(
            "record_id", "record_type", "refers_to", F.col("payload_digest").alias("told"),
            F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"), "block_bytes",
        ),
        "headers",
    )
    responses = heads.where("record_type = 'response'").select("record_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("string").alias("refers_to"))
    revisits = heads.where("record_type = 'revisit'").select("record_id", "refers_to", "told", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).alias("salt"))
    wanted = revisits.select(F.col("told").alias("payload_digest"), F.col("refers_to").alias("target")).distinct()
    originals = (
        responses.join(wanted, (responses["payload_digest"] == wanted["payload_digest"]) & (responses["record_id"] == wanted["target"]))
        .groupBy("target").agg(F.max("payload_bytes").alias("payload_bytes"), F.max(responses["payload_digest"]).alias("payload_digest"))
        .select("target", "payload_bytes", "payload_digest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    met = revisits.join(
        originals, (revisits["refers_to"] == originals["target"]) & (revisits["salt"] == originals["salt"]) & (revisits["told"] == originals["payload_digest"]), "left"
    )
    return responses.unionByName(met.select("record_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to"))
