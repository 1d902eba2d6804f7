"""WARC archives as seekable Zstandard bundles.

Each page becomes a WARC/1.1 record. Records with equal payloads of at least ``REVISIT`` bytes are written once: the one with
the largest page_id is the response, the others are revisits that refer to it. Records are dealt to bundles by a hash of all of them; a
bundle is one file in the shared folder, made of independent Zstandard frames of about ``FRAME`` bytes of records, closed by a seek
table (a skippable frame, as the public seekable format has it). The index maps a record to bundle, frame and the offset inside the
frame, so one record costs one frame. Bundles grow in number with the data, not in size; a task holds one bundle at a time.
A bundle is written under a name of its task attempt, and the index names the one that counts, so a lost executor leaves
no half bundle in the index.

The payload is the html in UTF-8, null counts as empty. Pages without an id cannot be referred to: they are written as responses.
Of repeated rows (same id, same payload) all but one are revisits of their own id. Columns besides page_id, url and html are not read.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import narrow_batches, new_path, read, settle, size_tasks
from tripmart.llm.simhash import whole_groups

REVISIT = 1000  # payloads below are stored each time
FRAME = 256 << 10  # bytes of records in a frame, before compression
BUNDLE = 2000  # records in a bundle, about
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time
# Fixed values of the seekable format: skippable frame, seek table footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = "record string, page_id long, bundle string, frame int, frame_start long, frame_bytes long, offset long, length long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html binary"


def record_id(page_id: int | None, copy: int) -> str:
    """The record's name; ``copy`` numbers repeated rows of one page."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{copy}')}"


def make_record(page_id: int | None, copy: int, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    revisit = refers_to is not None
    head = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{record_id(page_id, copy)}>"), ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{hashlib.sha1(payload).hexdigest()}"), ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", " ".join(url.split())))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<{record_id(refers_to, 0)}>"), ("X-Refers-To-Page", str(refers_to))]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http if revisit else http + payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, payload) of each record of a frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at offset {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        body = data[end + 4:end + 4 + int(head["Content-Length"])]
        stop = end + 8 + len(body)
        yield at, stop - at, head, body.split(b"\r\n\r\n", 1)[1]
        at = stop


class Bundle:
    """Independent frames and, at the end, their seek table."""

    def __init__(self, frame_bytes: int = FRAME):
        self.limit, self.out, self.table, self.waiting, self.held = frame_bytes, io.BytesIO(), [], [], 0
        self.compressor = zstandard.ZstdCompressor(level=3)

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset in the frame) of the record; a record never spans frames."""
        if self.held and self.held + len(record) > self.limit:
            self.flush()
        place = len(self.table), self.held
        self.waiting.append(record)
        self.held += len(record)
        return place

    def flush(self) -> None:
        if self.waiting:
            packed = self.compressor.compress(b"".join(self.waiting))
            self.table.append((self.out.tell(), len(packed), self.held))
            self.out.write(packed)
            self.waiting, self.held = [], 0

    def close(self) -> bytes:
        self.flush()
        entries = b"".join(struct.pack("<II", packed, raw) for _, packed, raw in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        return self.out.getvalue()


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(start, packed bytes, raw bytes) of each frame, from the end of a bundle."""
    count, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE or flags:
        raise ValueError("not a seekable bundle")
    out, at = [], 0
    for i in range(count):
        packed, raw = struct.unpack_from("<II", data, len(data) - 9 - 8 * (count - i))
        out.append((at, packed, raw))
        at += packed
    return out


def plan_records(pages: DataFrame) -> DataFrame:
    """(page_id, copy, url, html, refers_to): which record is a revisit and of what.

    Payloads are compared by their SHA-1 and length. The largest id of each is found with map-side maxima; only digests that occur
    more than once take part in the join, as a written table: small ones are broadcast, and a large one is joined by shuffles whose hot
    digests adaptive execution splits.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    digested = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("html"),
        F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("bytes"))
    same = (digested.filter(F.col("bytes") >= REVISIT).groupBy("digest", "bytes")
            .agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).filter("n > 1"))
    same = settle(same.select("digest", "bytes", "largest"), "payloads")
    # Rows of one id and payload are told apart by a number; ids that occur once need none.
    repeated = settle(digested.groupBy("page_id").count().filter("count > 1 and page_id is not null").select("page_id"), "repeated")
    joined = digested.join(same, ["digest", "bytes"], "left")
    single = joined.join(repeated, "page_id", "left_anti").withColumn("copy", F.lit(0))
    several = joined.join(repeated, "page_id", "left_semi").withColumn(
        "copy", F.row_number().over(Window.partitionBy("page_id").orderBy(F.col("digest").desc())) - 1)
    first_of = F.row_number().over(Window.partitionBy("page_id", "digest").orderBy("copy"))
    several = several.withColumn("nth", first_of)
    refers = F.when(F.col("largest").isNotNull() & F.col("page_id").isNotNull() & (F.col("largest") != F.col("page_id")), F.col("largest"))
    again = F.when(F.col("largest").isNotNull() & (F.col("nth") > 1), F.col("largest"))
    cols = ["page_id", "copy", "url", "html"]
    return (single.select(*cols, refers.alias("refers_to"))
            .unionByName(several.select(*cols, F.coalesce(refers, again).alias("refers_to"))))


def write_bundles(pages: DataFrame, folder: str, frame_bytes: int = FRAME, per_bundle: int = BUNDLE) -> DataFrame:
    """Write the archives of ``pages`` under ``folder`` (a URI) and return their index, itself written beside them."""
    spark = pages.sparkSession
    narrow_batches(spark)
    shared, root = fs.FileSystem.from_uri(folder)
    shared.create_dir(f"{root}/data", recursive=True)
    planned = plan_records(pages)
    bundles = size_tasks(pages.count(), per_bundle)
    dealt = planned.withColumn("grp", F.pmod(F.xxhash64("page_id", "copy", "url", "html"), F.lit(bundles)).cast("int"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(folder)
        bundle, rows, current = None, [], None

        def finish() -> pd.DataFrame:
            name = f"{current:08d}-{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{base}/data/{name}", compression=None) as out:
                out.write(bundle.close())
            frames = bundle.table
            return pd.DataFrame(
                [(r, p, name, f, frames[f][0], frames[f][1], o, n) for r, p, f, o, n in rows],
                columns=["record", "page_id", "bundle", "frame", "frame_start", "frame_bytes", "offset", "length"]).astype({"page_id": "Int64"})

        for batch in batches:
            for number, page, copy, url, html, refers in zip(
                    batch["grp"].tolist(), batch["page_id"].tolist(), batch["copy"].tolist(), batch["url"].tolist(),
                    batch["html"].tolist(), batch["refers_to"].tolist()):
                if number != current:
                    if bundle:
                        yield finish()
                    bundle, rows, current = Bundle(frame_bytes), [], number
                page = None if pd.isna(page) else int(page)
                refers = None if pd.isna(refers) else int(refers)
                record = make_record(page, copy, url, html.encode(), refers)
                rows.append((record_id(page, copy), page, *bundle.add(record), len(record)))
        if bundle:
            yield finish()

    # A task for each bundle. Sorted by bundle alone, in the order of ids, so that a bundle does not depend on how its rows arrived.
    index = (dealt.repartitionById(bundles, "grp").sortWithinPartitions("grp", "page_id", "copy", "url")
             .mapInPandas(run, INDEX))
    index.write.parquet(f"{folder}/index")
    return spark.read.schema(index.schema).parquet(f"{folder}/index")


def _row(head: dict[str, str], payload: bytes) -> tuple:
    number = lambda key: int(head[key]) if key in head else None
    length, digest = number("X-Payload-Length"), head["WARC-Payload-Digest"].removeprefix("sha1:")
    if head["WARC-Type"] == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (length, digest):
        raise ValueError(f"damaged record {head['WARC-Record-ID']}")
    return (number("X-Page-ID"), head.get("WARC-Target-URI"), length, digest, head["WARC-Type"], number("X-Refers-To-Page"),
            payload if head["WARC-Type"] == "response" else None)


COLUMNS = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]


def frame_rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=COLUMNS).astype({"page_id": "Int64", "refers_to": "Int64"})


def read_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the bundles that the index names, read frame by frame; a response is checked against its digest.

    Only the names of bundles are dealt out; a task opens its bundles itself and holds one frame at a time.
    """
    named = settle(spark.read.parquet(f"{folder}/index").select("bundle").distinct(), "bundles")
    # The names are a few bytes each: without a number of tasks of their own, adaptive execution would give them all to one.
    named = named.repartition(max(1, named.count()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(folder)
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for bundle in batch["bundle"]:
                with store.open_input_file(f"{base}/data/{bundle}") as file:
                    for start, packed, raw in seek_table(read_tail(file)):
                        file.seek(start)
                        frame = unpack.decompress(file.read(packed), max_output_size=raw)
                        yield frame_rows([_row(head, payload) for _, _, head, payload in parse_records(frame)])

    return named.mapInPandas(run, RECORDS)


def read_tail(file) -> bytes:
    """The seek table of an open bundle: its last bytes say how long it is."""
    file.seek(file.size() - 9)
    count, _, _ = struct.unpack("<IBI", file.read(9))
    file.seek(file.size() - 9 - 8 * count)
    return file.read(9 + 8 * count)


def fetch(folder: str, wanted: DataFrame) -> DataFrame:
    """The records of ``wanted``, rows of the index: of each bundle only the frames that hold one are read."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(folder)
        unpack = zstandard.ZstdDecompressor()
        for (bundle, _), rows in whole_groups(batches, ["bundle", "frame"]):
            with store.open_input_file(f"{base}/data/{bundle}") as file:
                file.seek(int(rows["frame_start"].iloc[0]))
                packed = file.read(int(rows["frame_bytes"].iloc[0]))
            frame = unpack.decompressobj().decompress(packed)
            yield frame_rows([_row(head, payload) for a, n in zip(rows["offset"], rows["length"])
                              for _, _, head, payload in parse_records(frame[a:a + n])])

    return wanted.repartition("bundle").sortWithinPartitions("bundle", "frame").mapInPandas(run, RECORDS)


def folder_uri(spark: SparkSession) -> str:
    path = new_path(spark, "warc")
    return path if "://" in path else f"file://{path.removeprefix('file:')}"


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = folder_uri(spark)
    write_bundles(read(spark, sf_dir, "pages"), folder)
    return read_bundles(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
with p as (select page_id, coalesce(html, '') as h, octet_length(encode(coalesce(html, ''))) as n from pages),
best as (select h, max(page_id) as top from p where n >= 1000 group by h)
select p.page_id, cast(n as bigint) as payload_bytes, sha1(p.h) as payload_digest,
       case when top <> page_id then 'revisit' else 'response' end as record_type,
       case when top <> page_id then top end as refers_to
from p left join best on n >= 1000 and best.h = p.h
"""
