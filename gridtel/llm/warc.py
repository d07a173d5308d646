"""WARC archives with revisit resolution.

Pages become records.  Only headers (page, url, digest, length) are shuffled by payload digest, where the smallest page of
every digest is elected; the headers of the other pages become revisit records that refer to it, and their payloads
are never read again.  Responses are written from the scan of the pages, without a shuffle: a bitmap with one bit per
hash of a revisit's (page, digest), of a bounded size, is broadcast, and a page whose bit is not set is no revisit.  Pages
whose bit another page has set are found exactly among the headers, and only their payloads travel, in a join on (page, digest).
Archives are written by Spark's text writer: records are strings and the record separator CRLF CRLF is the line
separator, gzip per file, so they go to any store that Spark writes.  Reading feeds the same chunks to a parser that goes by
Content-Length, hashes every payload again, and joins revisits to their responses by payload digest.  A popular digest is
salted in both joins.

Payloads below ``min_revisit`` bytes are always responses.  Cases: a null page counts as empty; a null url gives a
record without a target; line breaks in a url are percent-encoded; a page without an id can only refer, or stand
alone when no page of its digest has an id; rows that repeat the smallest page_id of a digest are responses all;
a payload of any length is one record, held whole by the one task that writes or reads it;
an empty table gives an empty archive and result; other columns are ignored.
"""
from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, small_batches, stored

MIN_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
SEPARATOR = "\r\n\r\n"
RECORDS_PER_FILE = 20_000
BITS = 2 ** 28     # of the broadcast bitmap: 32 MiB; a fuller one lets more payloads travel and stays right
BITS_EACH = 64     # bits per revisit, below that bound
WORD = 32_768      # bits of one row of the bitmap, as bitmap_construct_agg has them
SALTS = 16
PROFILE = "http://netpreservation.org/warc/1.1/revisit/identical-payload-digest"
PARSED = ("page_id long, url string, record_type string, record_id string, refers_record string, refers_page long, "
          "payload_bytes long, payload_digest string, payload string")


def page_headers(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                        F.sha2(payload, 256).alias("payload_digest"))


def originals(headers: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(payload_digest, original): the page that responds for a digest that several pages have."""
    return headers.where(F.col("payload_bytes") >= min_revisit).groupBy("payload_digest") \
        .agg(F.min("page_id").alias("original"), F.count("*").alias("n")).where("n > 1").select("payload_digest", "original")


def salted(df: DataFrame) -> DataFrame:
    """Every row once per salt: the small side of a join whose other side may hold a popular key."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def revisits(headers: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """The headers of revisiting pages with ``original``, the page they refer to."""
    elected = salted(originals(headers, min_revisit)).withColumnRenamed("payload_digest", "of_digest")
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))
    return headers.join(elected, (headers["payload_digest"] == elected["of_digest"]) & (salt == elected["salt"])) \
        .where(F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))) \
        .drop("of_digest", "salt")


def _slot(bits: int):
    return F.pmod(F.xxhash64("page_id", "payload_digest"), F.lit(bits))


def bitmap(rows: DataFrame, bits: int) -> DataFrame:
    """(word, bitmap): at most ``bits / WORD`` rows of 4 KiB, with the bit of every (page_id, payload_digest) set."""
    slots = rows.select(_slot(bits).alias("slot"))
    return slots.groupBy((F.col("slot") / WORD).cast("long").alias("word")) \
        .agg(F.bitmap_construct_agg(F.col("slot") % WORD).alias("bitmap"))


def marked(rows: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    """``rows`` with ``hit``: whether the bitmap has their bit.  ``words`` is broadcast: its size is bounded by ``bits``."""
    at = F.col("_slot") % WORD
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    one = F.pow(F.lit(2), at % 8).cast("int")
    return rows.withColumn("_slot", _slot(bits)).withColumn("word", (F.col("_slot") / WORD).cast("long")) \
        .join(F.broadcast(words), "word", "left") \
        .withColumn("hit", F.coalesce(byte.bitwiseAND(one) > 0, F.lit(False))).drop("_slot", "word", "bitmap")


def _bits(n: int, bound: int) -> int:
    """The smallest power of two with ``BITS_EACH`` bits for each of ``n`` rows, at most ``bound``."""
    return min(max(1 << (max(n, 1) * BITS_EACH - 1).bit_length(), WORD), max(bound, WORD))


def records(pages: DataFrame, min_revisit: int = MIN_REVISIT, date: str = DATE, bits: int = BITS) -> DataFrame:
    """One WARC record per page as a string, without the separator behind it."""
    scan = page_headers(pages)
    heads = stored(scan.drop("payload"), "warc-page-headers")
    again = stored(revisits(heads, min_revisit), "warc-revisits")
    size = _bits(again.count(), bits)
    first = stored(bitmap(again, size), "warc-bits")
    same = ["page_id", "payload_digest"]
    keys = again.select(*[F.col(c).alias(f"of_{c}") for c in same]).distinct()

    def has(keys):
        return F.col("page_id").eqNullSafe(keys["of_page_id"]) & (F.col("payload_digest") == keys["of_payload_digest"])

    # responses whose bit a revisit has set
    shadowed = stored(marked(heads, first, size).where("hit").join(keys, has(keys), "left_anti").select(*same).distinct(),
                      "warc-shadowed")
    responses = marked(scan, first, size).where("NOT hit").drop("hit")
    n_shadowed = shadowed.count()
    if n_shadowed:
        size2 = _bits(n_shadowed, bits)
        second = stored(bitmap(shadowed, size2), "warc-bits")
        wanted = shadowed.select(*[F.col(c).alias(f"of_{c}") for c in same])
        responses = responses.unionByName(
            marked(scan, second, size2).where("hit").drop("hit").join(wanted, has(wanted), "left_semi"))
    return _written(responses.withColumn("original", F.lit(None).cast("long")), date).unionByName(
        _written(again.withColumn("payload", F.lit(None).cast("string")), date))


def _written(rows: DataFrame, date: str) -> DataFrame:
    revisit = F.col("original").isNotNull()

    def record_id(page, digest):
        h = F.md5(F.concat_ws("|", page.cast("string"), digest))
        parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    def line(name, value):
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))

    digest = F.col("payload_digest")
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(SEPARATOR))
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    refers = F.when(revisit, F.col("original"))
    return rows.select(F.concat(
        F.lit("WARC/1.1\r\n"), F.when(revisit, "WARC-Type: revisit\r\n").otherwise("WARC-Type: response\r\n"),
        line("WARC-Record-ID", record_id(F.col("page_id"), digest)), F.lit(f"WARC-Date: {date}\r\n"),
        line("WARC-Target-URI", target), line("X-Page-Id", F.col("page_id").cast("string")),
        F.lit("WARC-Payload-Digest: sha256:"), digest, F.lit("\r\n"),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("WARC-Refers-To", F.when(revisit, record_id(refers, digest))), line("X-Refers-To-Page", refers.cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit(SEPARATOR), body).alias("value"))


def write_archive(recs: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    recs.write.option("lineSep", SEPARATOR).option("compression", "gzip") \
        .option("maxRecordsPerFile", records_per_file).text(path)


class RecordParser:
    """Incremental reader of one archive: give it chunks of bytes, take complete records (headers, block)."""

    def __init__(self):
        self._held = bytearray()
        self._need: tuple[dict, int, int] | None = None

    def feed(self, chunk: bytes):
        self._held += chunk
        while True:
            if self._need is None:
                while self._held.startswith(b"\r\n"):  # nothing else may stand between records
                    del self._held[:2]
                end = self._held.find(b"\r\n\r\n")
                if end < 0:
                    return
                lines = bytes(self._held[:end]).split(b"\r\n")
                if not lines[0].startswith(b"WARC/"):
                    raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
                headers = {}
                for raw in lines[1:]:
                    name, _, value = raw.decode("utf-8").partition(":")
                    headers[name.strip().lower()] = value.strip()
                self._need = headers, end + 4, int(headers["content-length"])
            headers, start, length = self._need
            if len(self._held) < start + length + 4:
                return
            if self._held[start + length:start + length + 4] != b"\r\n\r\n":
                raise ValueError("record is not closed by an empty line")
            yield headers, bytes(self._held[start:start + length])
            del self._held[:start + length + 4]
            self._need = None

    def close(self) -> None:
        if self._held:
            raise ValueError("archive ends inside a record")


def read_archive(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Records of all archives below ``path``; payload lengths and digests are taken from the payloads themselves.

    Every file is one ordered stream of chunks (gzip is not split), parsed as it arrives: memory holds one record.
    Every chunk is given its separator back, also a file's last one that had none: a payload that ends in CRLF makes
    the separator match two bytes early, and the spare line breaks behind the last record are skipped by the parser.
    """
    small_batches(spark)
    chunks = spark.read.option("lineSep", SEPARATOR).text(path).select("value")
    names = [c.split()[0] for c in PARSED.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def number(text):
        return int(text) if text is not None else None

    def row(headers, block):
        kind = headers["warc-type"]
        http, _, payload = block.partition(b"\r\n\r\n")
        declared = headers["warc-payload-digest"].removeprefix("sha256:")
        if kind == "response":
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
            if digest != declared:
                raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
        else:
            size, digest = None, declared
        return (number(headers.get("x-page-id")), headers.get("warc-target-uri"), kind, headers["warc-record-id"],
                headers.get("warc-refers-to"), number(headers.get("x-refers-to-page")), size, digest,
                payload.decode("utf-8") if payloads and kind == "response" else None)

    def run(batches):
        parser = RecordParser()
        for batch in batches:
            rows = [row(*r) for v in batch["value"].to_pylist() for r in parser.feed(v.encode("utf-8") + b"\r\n\r\n")]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
        parser.close()

    return chunks.mapInArrow(run, PARSED)


def resolve(parsed: DataFrame) -> DataFrame:
    """One row per record: revisits take the length of the response that has their payload digest and record id.

    A revisit without its response is an error.
    """
    again = parsed.where("record_type = 'revisit'")
    named = again.select(F.col("payload_digest").alias("of_digest"), F.col("refers_record").alias("of_record")).distinct()
    responses = parsed.where("record_type = 'response'")
    lengths = responses.join(named, (responses["payload_digest"] == named["of_digest"])
                             & (responses["record_id"] == named["of_record"])) \
        .groupBy("of_digest", "of_record").agg(F.max("payload_bytes").alias("full_bytes"))
    lengths = salted(lengths)
    salt = F.pmod(F.xxhash64("page_id", "record_id"), F.lit(SALTS))
    found = again.join(lengths, (again["payload_digest"] == lengths["of_digest"])
                       & (again["refers_record"] == lengths["of_record"]) & (salt == lengths["salt"]), "left")
    missing = F.raise_error(F.concat(F.lit("no response for the revisit "), F.col("record_id")))
    return responses.select("page_id", "payload_bytes", "payload_digest", "record_type",
                            F.col("refers_page").alias("refers_to")).unionByName(
        found.select("page_id", F.when(F.col("full_bytes").isNull(), missing).otherwise(F.col("full_bytes")).cast("long")
                     .alias("payload_bytes"), "payload_digest", "record_type", F.col("refers_page").alias("refers_to")))


def round_trip(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write deduplicated archives of ``pages`` to the shared folder, read them back and resolve them."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archive(records(pages, min_revisit), path)
    return resolve(stored(read_archive(spark, path).drop("payload"), "warc-headers"))
