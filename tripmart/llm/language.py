"""Scores of documents under language models learned from the training part of the corpus.

Two models learn from the documents whose crc32 of the id is not 1 modulo 5. The base is the additive count of words over all training words.
The other is the online logistic mixture of ``mixing``. Its context of the word so far has a slot for each beginning of a word that the corpus
holds, so it grows with the corpus as the word counts do: groups of documents send the distinct words and edges (a word so far and the byte after it) they
hold to buckets of a hash, buckets add the counts up and answer each group with what it asked for, a byte for each decision of an edge. The contexts of three and five bytes lie in tables whose size is a
parameter: bytes have a code learned from all pairs of neighbours, every input partition counts the decisions of its training documents in hashed slots, the slots are added up block by block, and the
table is sent to the executors. Every count covers all training documents.

A word in a third of all documents is one entry from each group. Groups and buckets grow in number with the bytes read. Texts travel twice, compressed.
Null and empty texts have one token, the end. A null id counts as an empty one and so as training. Repeated rows give a row each.
Only id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import mixing
from tripmart.llm.common import narrow_batches, read, settle, size_tasks
from tripmart.llm.substrings import LAST, blob_groups, packed, parts, runs, unpacked

UNIT = 8 << 20  # bytes of text in a document group
FOLDS, HELD_OUT = 5, 1
SLOTS_PER_BYTE = 2  # at least, that the words so far are hashed to
END = b"\n"  # the token after the last word; no word can be one
PART = 1 << 16  # slots of the table that are added up together
PLAIN = bytes(32 if bytes([b]).isspace() else bytes([b]).lower()[0] for b in range(256))
COUNTED = 1 << 21  # bytes counted at once
CHUNK = 1 << 15  # bytes scored at once: few enough for a processor's cache


def held_out(number: int) -> bool:
    return zlib.crc32(b"" if number == LAST else str(number).encode()) % FOLDS == HELD_OUT


def in_chunks(things: list, size: int = CHUNK, length=len) -> Iterator[list]:
    held, total = [], 0
    for t in things:
        held.append(t)
        total += length(t)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def line(words: list[bytes]) -> bytes:
    return b" ".join(words) + END


def learned_code(training: DataFrame) -> mixing.Code:
    """The code of bytes by the byte before, from all rows of ``training`` (one binary column). It comes from at most 65,536 counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for texts in in_chunks([(t or b"").translate(PLAIN) + END for t in batch.column(0).to_pylist()], COUNTED):
                total += mixing.count_pairs(texts)
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int32()), pa.array(total[pair], pa.int64())], names=["pair", "n"])

    pairs = np.zeros(1 << 16, np.int64)
    for row in training.mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        pairs[row.pair] = row.n
    return mixing.learned_code(pairs.reshape(256, 256))


def train_tables(training: DataFrame, code: mixing.Code) -> DataFrame:
    """(context, part, body): the counts of the mixture's slots over all rows of ``training`` (one binary column)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((mixing.TABLES, 2 * mixing.SLOTS), np.uint32)
        for batch in batches:
            for texts in in_chunks([line(mixing.normal(t or b"")) for t in batch.column(0).to_pylist()], COUNTED):
                mixing.count(texts, tables, code)
        squeeze = zstandard.ZstdCompressor(level=1)
        for k in range(mixing.TABLES):
            for p in range(mixing.SLOTS // PART):
                part = tables[k, 2 * PART * p:2 * PART * (p + 1)]
                if part.any():
                    body = squeeze.compress(part.tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([p], pa.int32()), pa.array([body])], names=["context", "part", "body"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, close = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)

        def done(key: int, total: np.ndarray) -> pa.RecordBatch:
            pairs = total.reshape(-1, 2).astype(np.float64)
            body = close.compress(mixing.stretched(pairs[:, 0], pairs[:, 1]).tobytes())
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([body])], names=["key", "body"])

        current, total = None, np.zeros(2 * PART, np.int64)
        for batch in batches:
            for key, body in zip(batch.column(0), batch.column(1)):
                if current is not None and key.as_py() != current:
                    yield done(current, total)
                    total = np.zeros(2 * PART, np.int64)
                current = key.as_py()
                total += np.frombuffer(open_.decompress(body.as_py()), np.uint32)
        if current is not None:
            yield done(current, total)

    keyed = training.mapInArrow(run, "context int, part int, body binary").select(
        (F.col("context") * (mixing.SLOTS // PART) + F.col("part")).alias("key"), "body")
    return keyed.repartition(mixing.TABLES * mixing.SLOTS // PART, "key").sortWithinPartitions("key").mapInArrow(add, "key int, body binary")


def mixture(training: DataFrame, code: mixing.Code) -> np.ndarray:
    """The table of the mixture. It has ``TABLES * SLOTS`` short numbers whatever the corpus, so it may come to the driver."""
    model = np.zeros(mixing.TABLES * mixing.SLOTS, np.int16)
    squeeze = zstandard.ZstdDecompressor()
    for row in train_tables(training, code).collect():
        model[PART * row.key:PART * (row.key + 1)] = np.frombuffer(squeeze.decompress(row.body), np.int16)
    return model.reshape(mixing.TABLES, mixing.SLOTS)


word_hash = xxhash.xxh3_64_intdigest


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def opened(body: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


class Group:
    """The documents of a group, their words as numbers, and what the group asks the corpus for."""

    def __init__(self, table: pa.Table, buckets: int, key_bits: int, code: mixing.Code | None):
        self.buckets, self.key_bits = buckets, key_bits
        docs = [(i, copies, line(mixing.normal(text))) for _, i, text, copies in unpacked(table)]
        self.ids, self.copies, self.lines = (list(c) for c in zip(*docs))
        # Words with the byte that closes them, a space or the end, one after another: these make up the lines.
        body = np.frombuffer(b"".join(self.lines), np.uint8)
        ends = np.flatnonzero((body == ord(" ")) | (body == ord(END)))
        self.of_doc = np.diff(np.flatnonzero(body[ends] == ord(END)), prepend=-1)
        self.begin = np.cumsum(self.of_doc) - self.of_doc
        buffers = [None, pa.py_buffer(np.concatenate([[0], ends + 1])), pa.py_buffer(body)]
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), buffers).dictionary_encode()
        order = pc.array_sort_indices(coded.dictionary)
        sorted_words = coded.dictionary.take(order)
        _, offsets, held = sorted_words.buffers()
        held, at = held.to_pybytes(), np.frombuffer(offsets, np.int64)[:len(sorted_words) + 1].tolist()
        closed = [held[a:b] for a, b in zip(at, at[1:])]
        place = np.empty(len(closed), np.int64)
        place[order.to_numpy()] = np.arange(len(closed))
        self.tokens = place.take(coded.indices.to_numpy()).astype(np.int32)
        self.words = mixing.Words(closed, key_bits, code)
        # The end stands in no list of words; the line of a document without words has just the end.
        self.word = np.array([w != END for w in closed])
        hashes = np.fromiter(map(word_hash, [w[:-1] for w in closed]), np.uint64, len(closed))
        hashes, self.name = np.unique(np.append(hashes, np.uint64(word_hash(END))), return_inverse=True)
        bucket = (hashes >> np.uint64(33)).astype(np.int64) % buckets
        self.order = np.argsort(bucket, kind="stable")
        self.hashes, self.bucket = hashes[self.order], bucket[self.order]

    def part(self, at: slice) -> np.ndarray:
        """The closed words of a run of documents."""
        return self.tokens[self.begin[at.start]:self.begin[at.stop - 1] + self.of_doc[at.stop - 1]]

    def by_doc(self, of_word: np.ndarray, of_end: float) -> np.ndarray:
        """Sums of ``of_word`` over each document's words and its end."""
        return np.add.reduceat(np.where(self.word, of_word, 0).take(self.tokens), self.begin) + of_end

    def asked(self) -> list[tuple]:
        # Repeated rows count as often as they stand.
        times = np.array([0 if held_out(i) else copies for i, copies in zip(self.ids, self.copies)], np.int64)
        closed = np.bincount(self.tokens, np.repeat(times, self.of_doc), len(self.word)).astype(np.int64)
        number = np.bincount(self.name, np.append(np.where(self.word, closed, 0), times.sum()), len(self.hashes)).astype(np.int64)
        number = number[self.order]
        out = [(int(self.bucket[p.start]), 0, squeezed(np.diff(self.hashes[p], prepend=np.uint64(0))), squeezed(number[p]), b"")
               for p in parts(runs(self.bucket), len(number))]
        edges, passed = self.words.asked, self.words.passed(closed).astype(np.int64)
        of_edge = edge_buckets(edges.prefixes, self.buckets, self.key_bits)
        return out + [(int(of_edge[p.start]), 1, squeezed(np.diff(edges.prefixes[p], prepend=np.uint64(0))), squeezed(passed[p]), squeezed(edges.after[p]))
                      for p in parts(runs(of_edge), len(of_edge))]


def edge_buckets(keys: np.ndarray, buckets: int, key_bits: int) -> np.ndarray:
    """Ascending keys lie in ascending buckets of equal width, all edges of a word so far in one."""
    width = -(-(1 << key_bits + 8) // buckets)
    return (keys // np.uint64(width)).astype(np.int64)


def asked_counts(chunks: DataFrame, buckets: int, key_bits: int, code: mixing.Code | None = None) -> DataFrame:
    """For each group and bucket the distinct words (kind 0) and edges (1) it holds and how often its training documents have them."""
    def run(table: pa.Table) -> pa.Table:
        group = table.column("grp")[0].as_py()
        out = [(group, *row) for row in Group(table, buckets, key_bits, code).asked()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), [*[pa.int32()] * 3, *[pa.binary()] * 3])],
                        names=["grp", "bucket", "kind", "keys", "counts", "after"])

    return chunks.groupBy("grp").applyInArrow(run, "grp int, bucket int, kind int, keys binary, counts binary, after binary")


def summed_counts(asked: DataFrame, buckets: int, code: mixing.Code | None = None) -> DataFrame:
    """The corpus counts of each group's words and the odds of its edges' decisions, in the order asked. Rows of group -1 hold a bucket's sum of counts
    and number of training words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, held in blob_groups(batches, "place"):
            keys = [np.cumsum(opened(r["keys"], np.uint64)) for r in held]
            if place % 2:
                keys = [k << np.uint64(8) | opened(r["after"], np.uint8) for r, k in zip(held, keys)]
            sizes = [len(k) for k in keys]
            names, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            del keys
            total = np.bincount(inverse, np.concatenate([opened(r["counts"], np.int64) for r in held]), len(names)).astype(np.int64)
            if place % 2:
                edges = mixing.Edges(names >> np.uint64(8), (names & np.uint64(255)).astype(np.uint8), code)
                odds = mixing.turned(mixing.as_bytes(mixing.stretched(*edges.sums(total)))[edges.key_of], edges.bit)
                sizes = [int(n.sum()) for n in np.split(edges.each[inverse], np.cumsum(sizes)[:-1])]
                each, out = odds[mixing.spread(edges.first[inverse], edges.each[inverse])], []
            else:
                each, out = total[inverse], [(-1, place % 2, place // 2, squeezed(np.array([total.sum(), (total > 0).sum()], np.int64)))]
            at = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            out += [(r["grp"], place % 2, place // 2, squeezed(each[a:b])) for r, a, b in zip(held, at, at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [*[pa.int32()] * 3, pa.binary()])], names=["grp", "kind", "bucket", "body"])

    keyed = asked.select((F.col("bucket").cast("long") * 2 + F.col("kind")).alias("place"), "grp", "keys", "counts", "after")
    return keyed.repartition(buckets, "place").sortWithinPartitions("place").mapInArrow(run, "grp int, kind int, bucket int, body binary")


SCORED = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"


def score(docs: DataFrame, unit: int = UNIT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's id, fold, tokens, known tokens, base score, and log10 probability and size under the mixture."""
    spark = docs.sparkSession
    narrow_batches(spark)
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups = buckets = size_tasks(size, unit)
    key_bits = (SLOTS_PER_BYTE * size).bit_length()
    number = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))
    rows = docs.select(F.pmod(F.xxhash64(number, body), F.lit(groups)).cast("int").alias("grp"), number.alias("id"), body.alias("body"))
    fold = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS
    training = docs.filter(fold != HELD_OUT).select(body.alias("body"))
    code = learned_code(training)
    model = spark.sparkContext.broadcast(mixture(training, code))
    counts = settle(summed_counts(asked_counts(packed(rows), buckets, key_bits, code), buckets, code), "counts")
    totals = counts.filter("grp = -1").select("body").mapInArrow(unpack_totals, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    n, v = totals[0] or 0, totals[1] or 0

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        answers = {(r["kind"], r["bucket"]): r["body"] for r in right.to_pylist()}
        join = lambda kind, form: np.concatenate([np.zeros(0, form), *[opened(answers[k], form) for k in sorted(answers) if k[0] == kind]])
        group = Group(left, buckets, key_bits, code)
        number = np.zeros(len(group.hashes), np.int64)
        number[group.order] = join(0, np.int64)
        number = number[group.name]
        logs = np.log10((number + 0.5) / (n + 0.5 * (v + 1)))
        of_decision = mixing.from_bytes(mixing.turned(join(1, np.uint8), group.words.asked.bit)).take(group.words.place)
        length, known = (group.by_doc(c[:-1], c[-1]).tolist() for c in (np.ones(len(number), np.int64), (number > 0).astype(np.int64)))
        base, scores = group.by_doc(logs[:-1], logs[-1]).tolist(), []
        for some in in_chunks(list(range(len(group.ids))), CHUNK, lambda at: len(group.lines[at])):
            at = slice(some[0], some[-1] + 1)
            scores += mixing.score(group.lines[at], model.value, group.words, group.part(at), of_decision).tolist()
        rows = [(None if i == LAST else i, held_out(i), length[at], known[at], n, base[at], scores[at], len(group.lines[at]))
                for at, (i, copies) in enumerate(zip(group.ids, group.copies)) for _ in range(copies)]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds)], names=[f.split()[0] for f in SCORED.split(", ")])

    done = packed(rows).groupBy("grp").cogroup(counts.filter("grp >= 0").groupBy("grp")).applyInArrow(run, SCORED)
    return done.withColumnRenamed("id", doc_id)


def unpack_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = np.concatenate([np.zeros(0, np.int64), *[opened(b, np.int64) for b in batch.column(0).to_pylist()]]).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["n", "v"])


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    bits = -F.col("score") * float(np.log2(10)) / F.col("n_bytes")
    return score(read(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", bits.alias("bits_per_byte"))
