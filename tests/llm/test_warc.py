import hashlib

import pytest
import zstandard
from pyspark.sql import functions as F

from tripmart.llm import warc

BIG, OTHER = "é<p>" * 400, "x" * 1000
ROWS = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (7, "http://b/7", BIG), (3, None, OTHER), (4, "u", OTHER), (5, "u", "small"), (6, "u", "small"),
        (8, "new\r\nline", None), (9, "e", ""), (10, "crlf", "a\r\n\r\nWARC/1.1\r\n\r\n" * 100), (11, "long", "y" * 700000), (None, "none", BIG)]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    folder = f"file://{tmp_path_factory.mktemp('warc')}/out"
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    return folder, warc.write_bundles(pages, folder, frame_bytes=5000, per_bundle=3)


def test_round_trip(spark, written):
    rows = {r.page_id: r for r in warc.read_bundles(spark, written[0]).collect()}
    assert set(rows) == {r[0] for r in ROWS}
    for page, url, html in ROWS:
        data = (html or "").encode()
        assert (rows[page].payload_bytes, rows[page].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        revisit = {1: 7, 2: 7, 3: 4}.get(page)
        assert (rows[page].record_type, rows[page].refers_to) == ("revisit" if revisit else "response", revisit)
        assert rows[page].html == (None if revisit else data)


def test_a_task_for_each_bundle(spark, written):
    """Adaptive execution is on in this session, and does not merge the names of the bundles."""
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    bundles = written[1].select("bundle").distinct().count()
    assert bundles > 3 and warc.read_bundles(spark, written[0]).rdd.getNumPartitions() == bundles


def test_single_records_by_index(spark, written):
    folder, index = written
    got = {r.page_id: bytes(r.html) for r in warc.fetch(folder, index.filter("page_id in (7, 10, 11)")).collect()}
    assert got == {p: h.encode() for p, _, h in ROWS if p in (7, 10, 11)}


def test_frames_stand_alone(written):
    from pathlib import Path

    for file in Path(written[0].removeprefix("file://")).glob("data/*.zst"):
        data = file.read_bytes()
        frames = warc.seek_table(data)
        assert sum(f[1] for f in frames) + 8 + 9 + 8 * len(frames) == len(data)
        for start, packed, raw in reversed(frames):
            assert len(zstandard.ZstdDecompressor().decompress(data[start:start + packed])) == raw


def test_repeated_rows_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", BIG), (1, "u", BIG), (2, "u", "s"), (2, "u", "t")], "page_id long, url string, html string")
    warc.write_bundles(pages, f"file://{tmp_path}/a")
    rows = sorted((r.page_id, r.record_type, r.refers_to or 0) for r in warc.read_bundles(spark, f"file://{tmp_path}/a").collect())
    assert rows == [(1, "response", 0), (1, "revisit", 1), (2, "response", 0), (2, "response", 0)]


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert warc.op5_warc(spark, str(tmp_path)).count() == 0
