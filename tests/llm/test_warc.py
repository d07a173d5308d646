"""WARC: archives are parsed back byte for byte; revisits resolve; SQL compares the whole result."""
import glob
import gzip
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridtel.llm import warc as W
from gridtel.llm.common import scratch

LONG = "<p>" + "x" * 200 + "</p>"
TRICKY = ["\r\n\r\n" * 30, "a\r\n" * 40, "\r" * 120, "\r\n\r" * 40, "WARC/1.1\r\n\r\n" * 12, "é\r\n\r\n\r\n" * 20, "\n" * 130]
ROWS = [(3, "http://a", LONG), (1, "http://b", LONG), (2, None, LONG), (4, "http://c\r\nX-Evil: 1", "short"), (5, "u", "short"),
        (6, "u", None), (7, "u", ""), (None, "u", LONG), (8, "u", LONG + "é"), (1, "http://b", LONG)] + \
       [(10 + i, f"t{i}", t) for i, t in enumerate(TRICKY)] + [(30 + i, f"t{i}", t) for i, t in enumerate(TRICKY)]


def expected(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        revisit = len(data) >= 100 and first is not None and page != first
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, payload string")
    assert sorted(map(tuple, W.round_trip(pages.repartition(3)).collect()), key=str) == expected(ROWS)


def test_payloads_come_back(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    path = scratch(spark, "warc-test")
    W.write_archive(W.records(pages), path, records_per_file=5)
    got = W.read_archive(spark, path, payloads=True).where("record_type = 'response' and page_id is not null").collect()
    want = {p: h or "" for p, _, h in ROWS}
    assert got and all(r["payload"] == want[r["page_id"]] for r in got)


def test_files_are_warc(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1)
    path = scratch(spark, "warc-test")
    W.write_archive(W.records(pages), path)
    data = b"".join(gzip.open(f).read() for f in glob.glob(path.removeprefix("file:") + "/*.gz"))
    n = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and b"X-Evil" not in fields
        assert {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length"} <= set(fields) or fields.get(b"X-Page-Id") is None
        size = int(fields[b"Content-Length"])
        assert rest[size:size + 4] == b"\r\n\r\n"
        data = rest[size + 4:]
        n += 1
    assert n == len(ROWS)


def test_parser_takes_any_chunks():
    block = b"HTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n"
    stream = b"".join(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block) for _ in range(3))
    for step in (1, 3, 50, len(stream)):
        parser, out = W.RecordParser(), []
        for i in range(0, len(stream), step):
            out += parser.feed(stream[i:i + step])
        parser.close()
        assert [b for _, b in out] == [block] * 3


def test_last_record_ends_in_a_line_break(spark):
    for n in (1, 2, 3):
        rows = [(1, "u", "a" + "\r\n" * n)]
        pages = spark.createDataFrame(rows, "page_id long, url string, html string")
        assert [tuple(r) for r in W.round_trip(pages).collect()] == expected(rows)


def test_empty(spark):
    assert W.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_a_full_bitmap_changes_nothing(spark):
    """One word of bits for thousands of revisits: nearly every response shares a bit with one and goes the exact way."""
    rows = [(i, "u", LONG if i % 3 == 0 else f"{LONG} {i % 7000}") for i in range(20_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    heads = W.page_headers(pages).drop("payload")
    again = W.revisits(heads)
    bits = W.bitmap(again, W.WORD)
    assert bits.count() == 1
    plain = W.marked(heads, bits, W.WORD).where("hit").join(again.select("page_id"), "page_id", "left_anti").count()
    assert plain > 1000
    path = scratch(spark, "warc-test")
    W.write_archive(W.records(pages, bits=W.WORD), path)
    got = W.resolve(W.read_archive(spark, path).drop("payload")).collect()
    seen, want = {}, set()
    for page, _, html in rows:
        first = seen.setdefault(html, page)
        want.add((page, len(html), hashlib.sha256(html.encode()).hexdigest(), "response" if first == page else "revisit",
                  None if first == page else first))
    assert len(got) == len(rows) and set(map(tuple, got)) == want


def test_one_page_ten_thousand_times(spark):
    pages = spark.range(10_000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit(LONG).alias("html"))
    out = W.round_trip(pages)
    assert sorted((r["record_type"], r["n"], r["size"]) for r in out.groupBy("record_type").agg(
        F.count("*").alias("n"), F.max("payload_bytes").alias("size")).collect()) == [("response", 1, 207), ("revisit", 9999, 207)]
    assert out.where("refers_to = 0").count() == 9999


def test_revisits_leave_their_payloads_behind(spark):
    """No exchange of the writing plan carries payloads when no page shares a bit with a revisit."""
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    plan = W.records(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and "LeftAnti" not in plan


def test_a_revisit_without_its_response_is_an_error(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    path = scratch(spark, "warc-test")
    W.write_archive(W.records(pages), path)
    parsed = W.read_archive(spark, path).drop("payload")
    with pytest.raises(PySparkException, match="no response for the revisit"):
        W.resolve(parsed.where("record_type = 'revisit'")).collect()
