"""Exact repeats of long word sequences, found through fixed blocks as anchors.

1. Each document's non-overlapping blocks of ``BLOCK`` words are the index, every rolling window of ``BLOCK`` words probes it. Any ``WINDOW``
   words hold a whole block when ``2 * BLOCK - 1 <= WINDOW``, so two equal windows always meet in a block. Blocks and probes go as hashes to
   buckets of the hash; a bucket answers each document group with the hashes that hit.
2. Hits are extended: of every window around a hit its document group sends one row for each distinct word sequence, the
   earliest. A bucket of sequences keeps the earliest of all; each other one, and what its group held back, is a repeat. Neighbouring
   repeated windows make up the maximal repeats.
3. Words that a repeat covers are removed.

A sequence that a third of all documents share sends one entry from each group or batch, not one from each document. Documents are grouped by a hash
of id and text; buckets and groups grow in number with the bytes read, so what a task holds does not. Texts travel twice, compressed.
A bucket is drawn by one part of a hash and compared by another, so a sequence is told apart by 64 bits and the bucket's number.

"Earlier" means a smaller id, or an earlier start in the same document. Null texts have no words. Rows with one id count as one document:
their equal places are not earlier than each other. A null id comes after all others. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import narrow_batches, read, settle, size_tasks

WINDOW, BLOCK = 20, 10
UNIT = 8 << 20  # bytes of text in a document group, and behind a bucket
LAST = (1 << 63) - 1  # stands for a null id
U64 = np.uint64


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))


def rolling(w: np.ndarray, size: int, factor: int) -> np.ndarray:
    """A 64-bit hash of each ``size`` consecutive entries."""
    n = max(len(w) - size + 1, 0)
    h = np.zeros(n, U64)
    for k in range(size):
        h = h * U64(factor) + w[k:k + n]
    h ^= h >> U64(29)
    h *= U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> U64(32))


def block_keys(w: np.ndarray, block: int, buckets: int) -> np.ndarray:
    """Bucket in the upper and hash in the lower half."""
    h = rolling(w, block, 0x9E3779B97F4A7C15)
    return ((h >> U64(32)) % U64(buckets)) << U64(32) | (h & U64(0xFFFFFFFF))


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys begins in sorted arrays."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])]))


def parts(begin: np.ndarray, n: int) -> Iterator[slice]:
    return (slice(a, b) for a, b in zip(begin.tolist(), [*begin.tolist()[1:], n]))


def batches_of(batches: Iterator[pa.RecordBatch], unit: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(groups, ids, texts), about ``unit`` bytes at a time."""
    groups, ids, texts, held = [], [], [], 0
    for batch in batches:
        for g, i, t in zip(*(c.to_pylist() for c in batch.columns)):
            groups.append(g)
            ids.append(i)
            texts.append(t or b"")
            held += len(texts[-1])
            if held >= unit:
                yield groups, ids, texts
                groups, ids, texts, held = [], [], [], 0
    if groups:
        yield groups, ids, texts


def packed(rows: DataFrame) -> DataFrame:
    """Documents (grp, id, body) as a few compressed chunks for each group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for groups, ids, texts in batches_of(batches, 2 * UNIT):
            order = np.argsort(groups, kind="stable")
            sizes = np.array([len(t) for t in texts], np.int64)
            number, names = np.array(groups)[order], np.array(ids, np.int64)
            out = []
            for part in parts(runs(number), len(order)):
                own = order[part]
                out.append((int(number[part.start]), names[own].tobytes(), sizes[own].tobytes(), squeeze.compress(b"".join(texts[i] for i in own))))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int32(), *[pa.binary()] * 3])], names=["grp", "ids", "sizes", "body"])

    return rows.mapInArrow(run, "grp int, ids binary, sizes binary, body binary")


def unpacked(table: pa.Table) -> Iterator[tuple[int, int, bytes, int]]:
    """(number, id, text, rows) of the distinct documents of one group's chunks, numbered by id and text.

    A group's rows are the same in each pass, so a number names the same document in all of them.
    """
    squeeze, docs = zstandard.ZstdDecompressor(), {}
    for ids, sizes, body in zip(*(table.column(c).to_pylist() for c in ("ids", "sizes", "body"))):
        text, at = squeeze.decompress(body), 0
        for i, n in zip(np.frombuffer(ids, np.int64).tolist(), np.frombuffer(sizes, np.int64).tolist()):
            doc = i, text[at:at + n]
            docs[doc] = docs.get(doc, 0) + 1
            at += n
    for number, doc in enumerate(sorted(docs)):
        yield number, *doc, docs[doc]


def probes(rows: DataFrame, block: int, buckets: int, groups: int) -> DataFrame:
    """For each bucket the hashes of blocks and rolling windows, once for each batch and document group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers, _, texts in batches_of(batches, 2 * UNIT):
            keys, owner, anchor = [], [], []
            for g, t in zip(numbers, texts):
                k = block_keys(word_hashes(t.split()), block, buckets)
                keys.append(k)
                owner.append(np.full(len(k), g, np.int64))
                anchor.append(np.arange(len(k)) % block == 0)
            key, own, ref = np.concatenate(keys), np.concatenate(owner), np.concatenate(anchor)
            place = (key >> U64(32)).astype(np.int64) * groups + own
            low = key.astype(np.uint32)
            order = np.lexsort((low, place))
            place, low, ref = place[order], low[order], ref[order]
            first = runs(place, low)
            if not len(first):
                continue
            several = np.diff(np.append(first, len(low))) > 1
            ref, place, low = np.logical_or.reduceat(ref, first), place[first], low[first]
            bucket = place // groups
            out = []
            for part in parts(runs(bucket), len(low)):
                own = place[part] % groups
                begin = runs(own)
                out.append((int(bucket[part.start]), own[begin].astype(np.uint32).tobytes(), np.diff(np.append(begin, len(own))).astype(np.uint32).tobytes(),
                            low[part].tobytes(), np.packbits(ref[part]).tobytes(), np.packbits(several[part]).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int32(), *[pa.binary()] * 5])],
                                             names=["bucket", "owners", "counts", "low", "ref", "several"])

    return rows.mapInArrow(run, "bucket int, owners binary, counts binary, low binary, ref binary, several binary")


def blob_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows of one key together, from batches sorted by it."""
    current, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[key] != current:
                yield current, held
                held = []
            current = row[key]
            held.append(row)
    if held:
        yield current, held


def anchored(rows: DataFrame) -> DataFrame:
    """(grp, bucket, low): hashes that stand as a block and at another place too, for each group that holds one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in blob_groups(batches, "bucket"):
            low = np.concatenate([np.frombuffer(r["low"], np.uint32) for r in held])
            own = np.concatenate([np.repeat(np.frombuffer(r["owners"], np.uint32), np.frombuffer(r["counts"], np.uint32)) for r in held])
            bits = lambda c: np.concatenate([np.unpackbits(np.frombuffer(r[c], np.uint8), count=len(r["low"]) // 4) for r in held]).astype(bool)
            ref, several = bits("ref"), bits("several")
            order = np.argsort(low, kind="stable")
            low, own = low[order], own[order]
            first = runs(low)
            size = np.diff(np.append(first, len(low)))
            hit = np.logical_or.reduceat(ref[order], first) & ((size > 1) | np.logical_or.reduceat(several[order], first))
            chosen = np.repeat(hit, size)
            low, own = low[chosen], own[chosen]
            order = np.lexsort((low, own))
            low, own = low[order], own[order]
            first = runs(low, own)
            low, own = low[first], own[first]
            out = [(int(own[part.start]), bucket, low[part].tobytes()) for part in parts(runs(own), len(own))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int32(), pa.int32(), pa.binary()])], names=["grp", "bucket", "low"])

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "grp int, bucket int, low binary")


def near_hits(hit: np.ndarray, window: int, block: int, n: int) -> np.ndarray:
    """Starts of the windows that hold a hit block, in a text of ``n`` words."""
    count = np.concatenate([[0], np.cumsum(hit)])
    start = np.arange(max(n - window + 1, 0))
    return start[count[start + window - block + 1] > count[start]]


def later(sequence: tuple[np.ndarray, ...], ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which of sorted places are not the earliest of their sequence."""
    first = runs(*sequence)
    owner = np.repeat(first, np.diff(np.append(first, len(ids))))
    return (ids != ids[owner]) | (starts != starts[owner])


PLACES = "grp int, bucket int, hash binary, ids binary, numbers binary, starts binary"
RETURNED = "grp int, numbers binary, starts binary"
KIND = {"int": pa.int32(), "binary": pa.binary()}


def rows_of(out: list[tuple], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*out) if out else [[]] * len(fields)
    return pa.table([pa.array(c, KIND[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def extended(chunks: DataFrame, hits: DataFrame, window: int, block: int, buckets: int) -> DataFrame:
    """Each group's distinct word sequences around hits, the earliest place of each, by bucket; bucket -1 holds the places that
    the group itself knows to be repeats."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known = [np.zeros(0, U64)]
        for bucket, low in zip(right.column("bucket").to_pylist(), right.column("low").to_pylist()):
            known.append(U64(bucket) << U64(32) | np.frombuffer(low, np.uint32).astype(U64))
        known = np.sort(np.concatenate(known))
        found: list[tuple[np.ndarray, ...]] = []
        for number, i, text, _ in unpacked(left) if len(known) else ():
            w = word_hashes(text.split())
            if len(w) < window:
                continue
            key = block_keys(w, block, buckets)
            at = np.minimum(np.searchsorted(known, key), len(known) - 1)
            start = near_hits(known[at] == key, window, block, len(w))
            if len(start):
                a, b = rolling(w, window, 0xD6E8FEB86659FD93), rolling(w, window, 0xA0761D6478BD642F)
                found.append((a[start], b[start], np.full(len(start), i, np.int64), np.full(len(start), number, np.uint32), start.astype(np.uint32)))
        out = []
        if found:
            group = left.column("grp")[0].as_py()
            a, b, ids, numbers, starts = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((numbers, starts, ids, b, a))
            a, b, ids, numbers, starts = a[order], b[order], ids[order], numbers[order], starts[order]
            again = later((a, b), ids, starts)
            out.append((group, -1, b"", b"", numbers[again].tobytes(), starts[again].tobytes()))
            sent = np.flatnonzero(~again)
            bucket = (b[sent] % U64(buckets)).astype(np.int64)
            order = np.lexsort((starts[sent], numbers[sent], bucket))
            sent, bucket = sent[order], bucket[order]
            for part in parts(runs(bucket), len(bucket)):
                own = sent[part]
                out.append((group, int(bucket[part.start]), a[own].tobytes(), ids[own].tobytes(), numbers[own].tobytes(), starts[own].tobytes()))
        return rows_of(out, PLACES)

    return chunks.groupBy("grp").cogroup(hits.groupBy("grp")).applyInArrow(run, PLACES)


def later_places(rows: DataFrame) -> DataFrame:
    """Of the places of each bucket all but the earliest of each sequence, for their groups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in blob_groups(batches, "bucket"):
            join = lambda c, kind: np.concatenate([np.frombuffer(r[c], kind) for r in held])
            a, ids, numbers, starts = join("hash", U64), join("ids", np.int64), join("numbers", np.uint32), join("starts", np.uint32)
            own = np.repeat([r["grp"] for r in held], [len(r["hash"]) // 8 for r in held])
            order = np.lexsort((starts, ids, a))
            order = order[later((a[order],), ids[order], starts[order])]
            order = order[np.argsort(own[order], kind="stable")]
            out = [(int(own[order[part.start]]), numbers[order[part]].tobytes(), starts[order[part]].tobytes()) for part in parts(runs(own[order]), len(order))]
            yield from rows_of(out, RETURNED).to_batches()

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, RETURNED)


def cut(words: list[bytes], starts: np.ndarray, window: int) -> tuple[bytes, int]:
    """The words outside all windows at ``starts``, joined by one space, and how many are gone."""
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    keep = np.cumsum(edge[:-1]) == 0
    return b" ".join(w for w, k in zip(words, keep.tolist()) if k), int(len(words) - keep.sum())


def remove_repeats(docs: DataFrame, window: int = WINDOW, unit: int = UNIT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept) for each row: the text without the words of sequences that stand earlier too."""
    spark = docs.sparkSession
    narrow_batches(spark)
    block = (window + 1) // 2
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups = buckets = size_tasks(total, unit)
    number = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))
    rows = docs.select(F.pmod(F.xxhash64(number, body), F.lit(groups)).cast("int").alias("grp"), number.alias("id"), body.alias("body"))
    hits = anchored(probes(rows, block, buckets, groups))
    sequences = settle(extended(packed(rows), hits, window, block, buckets), "sequences")
    names = ["grp", "numbers", "starts"]
    repeats = sequences.filter("bucket = -1").select(*names).unionByName(later_places(sequences.filter("bucket >= 0")))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        join = lambda c: np.concatenate([np.zeros(0, np.uint32), *[np.frombuffer(b, np.uint32) for b in right.column(c).to_pylist()]]).astype(np.int64)
        numbers, starts = join("numbers"), join("starts")
        order = np.argsort(numbers, kind="stable")
        numbers, starts = numbers[order], starts[order]
        out = []
        for number, i, t, copies in unpacked(left):
            words = t.split()
            low, high = np.searchsorted(numbers, [number, number + 1])
            kept, gone = (b" ".join(words), 0) if low == high else cut(words, np.unique(starts[low:high]), window)
            out += [(None if i == LAST else i, len(words), gone, kept)] * copies
        columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 4, [pa.int64(), pa.int64(), pa.int64(), pa.binary()])]
        return pa.table(columns, names=["id", "n_words", "n_removed", "kept"])

    done = packed(rows).groupBy("grp").cogroup(repeats.groupBy("grp")).applyInArrow(run, "id long, n_words long, n_removed long, kept binary")
    return done.select(F.col("id").alias(doc_id), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
with words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
windows as (
  select doc_id, s, array_to_string(w[s : s + 19], ' ') as seq
  from (select doc_id, w, unnest(range(1, len(w) - 18)) as s from words where len(w) >= 20)),
ranked as (select doc_id, s, row_number() over (partition by seq order by doc_id, s) as n from windows),
gone as (select distinct doc_id, i from (select doc_id, unnest(range(s, s + 20)) as i from ranked where n > 1)),
places as (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from words),
kept as (
  select doc_id, string_agg(word, ' ' order by i) as t, count(*) as n
  from places p where not exists (select 1 from gone g where g.doc_id = p.doc_id and g.i = p.i) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from words d left join kept using (doc_id)
"""
