"""Archives: round trips, and single records."""

import base64
import hashlib
import io
import struct

import zstandard
from pyspark.sql import functions as F

from forecourt.llm import warc
from forecourt.llm.frames import column


def pages(spark):
    rows = [
        (1, "http://a/1", "<p>same</p>"),
        (2, "http://a/2\r\nX: y", "<p>same</p>"),
        (3, None, None),
        (4, "", ""),
        (5, "http://é/ü", "<p>ü\r\n\r\nWARC/1.1\r\n</p>" * 3),
        (6, "u", "x" * 3_000_000),
        (None, "n", "<p>same</p>"),
        (2, "http://a/2", "<p>same</p>"),
        (7, "t", "<p>same</p>"),
        (7, "t", "<p>same</p>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({c: F.lit(1) for c in ("key", "same", "payload", "keep", "n", "a.b")})


def expected(rows, min_bytes=0):
    found = []
    for r in rows:
        body = (r.html or "").encode()
        same = [x.page_id for x in rows if (x.html or "").encode() == body]
        keep = max((x for x in same if x is not None), default=None)
        own = None if r.page_id is None else str(r.page_id)
        again = len(body) >= min_bytes and r.page_id is not None and r.page_id < keep
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        kind = ("revisit", str(keep)) if again else ("response", None)
        found.append((own, len(body), digest, *kind))
    return sorted(map(str, found))


def read(manifest):
    fields = ("key", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(str(tuple(r[f] for f in fields)) for r in warc.read_archives(manifest).collect())


def test_odd_pages(spark):
    df = pages(spark)
    rows = df.collect()
    assert read(warc.write_archives(df)) == expected(rows)
    assert read(warc.write_archives(df, min_bytes=20)) == expected(rows, 20)
    assert read(warc.write_archives(df.repartition(3))) == expected(rows)
    assert column(df, "a.b") is not None


def test_payloads_and_addresses_come_back(spark):
    manifest = warc.write_archives(pages(spark))
    rows = {r.key: r for r in warc.read_archives(manifest, payloads=True).collect()}
    assert bytes(rows["5"].payload).decode() == "<p>ü\r\n\r\nWARC/1.1\r\n</p>" * 3
    assert rows["1"].payload is None and rows["1"].record_type == "revisit"
    assert rows["3"].url is None and bytes(rows["4"].payload) == b""
    assert sum(r.records for r in manifest.collect()) == 10


def test_no_pages(spark):
    none = pages(spark).filter(F.lit(False))
    manifest = warc.write_archives(none)
    assert manifest.collect() == [] and warc.read_archives(manifest).collect() == []


def test_small_archives_and_one_record_by_itself(spark, monkeypatch, tmp_path):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").coalesce(1)
    manifest = warc.write_archives(df, folder=str(tmp_path)).collect()
    assert len(manifest) == 1
    data = open(manifest[0].archive, "rb").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.SKIPPABLE
    content = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    dictionary = zstandard.ZstdCompressionDict(content)
    assert dictionary.dict_id() != 0
    # Every record is a frame of its own that needs the dictionary only.
    rest, records = data[8 + size :], 0
    while rest:
        one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        assert one.decompress(rest).startswith(b"WARC/1.1\r\n")
        rest, records = one.unused_data, records + 1
    assert records == df.count()
    assert sum(1 for _ in warc.records(io.BytesIO(data))) == records


def test_archives_end_at_their_size(spark, monkeypatch, tmp_path):
    data = [warc.record(str(i), "u", bytes([i]) * 50, None, "d") for i in range(5)]
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 100)
    archive = warc.Archive(str(tmp_path))
    for d in data:
        archive.add(d)
    archive.close()
    with open(archive.uri, "rb") as file:
        found = list(warc.records(file))
    assert [f["warc-record-id"] for f, _ in found] == [f"<urn:record:{i}>" for i in range(5)]


def dictionary_of(path):
    data = open(path, "rb").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.SKIPPABLE
    return zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])


def test_few_or_long_first_pages_have_a_dictionary_too(spark, tmp_path):
    three = pages(spark).filter("page_id < 4").dropDuplicates(["page_id"])
    long = pages(spark).select("page_id", "url", F.repeat(F.lit("0123456789abc "), 250_000).alias("html"))
    many = spark.range(300).selectExpr("id + 100 as page_id", "'u' as url", "concat('<p>page ', id) as html")
    for i, df in enumerate((three, long.limit(1).unionByName(many))):
        manifest = warc.write_archives(df.coalesce(1), folder=f"{tmp_path}/{i}")
        assert read(manifest) == expected(df.collect())
        for row in manifest.collect():
            assert dictionary_of(row.archive)


def test_a_task_reads_an_archive(spark, tmp_path):
    df = spark.range(400).selectExpr("id as page_id", "'u' as url", "concat('<p>page ', id) as html")
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merged, "false")
    try:
        manifest = warc.write_archives(df, folder=str(tmp_path))
    finally:
        spark.conf.unset(merged)
    found = warc.read_archives(manifest).withColumn("task", F.spark_partition_id())
    archives, tasks = manifest.count(), found.select("task").distinct().count()
    assert archives > 1 and found.count() == 400
    assert tasks > archives / 3  # dealt by hash, so some tasks get two
