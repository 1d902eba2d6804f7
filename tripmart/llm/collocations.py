"""Phrases that occur together more often than their parts, from a multikey quicksort of suffix pointers.

1. One pass counts the words of each language, and the pairs of words that make up a good part of a chunk of text.
2. A second pass makes a suffix of up to ``WIDTH`` words of every place with two words or more and sends it to a bucket of its two leading words. Equal suffixes of a
   chunk of text go as one with a count. A pair with more than one in ``HOT`` of all words is dealt by its third word besides, so no pair is too hot for a task;
   there are at most ``HOT`` such pairs, which is all that goes through the driver.
3. A bucket sorts pointers to its suffixes by a three-way multikey quicksort: the pointers of a partition are split into those whose word at the
   partition's depth is smaller than, equal to and greater than a pivot's. The equal part shares one word more, so its size is the count of a phrase, and it
   goes on one word deeper, down to ``WIDTH``. A part that counts less than ``LEAST`` holds no frequent phrase and is abandoned. All open partitions are split
   at once by array operations, so there are about as many rounds as the quicksort is deep.
4. Parts of frequent phrases are frequent, so the counts at hand hold both sides of every cut. Joins attach them, then the best phrases of each language get their text.

A bucket gets one entry from each chunk, with the words of that entry listed once; buckets grow in number with the words, so what a task holds does not.

Words are told apart by a 64-bit hash of language and word. Null texts are empty, a null language is ``und``; texts without words add nothing. Repeated rows
count each. A text of any length is read in blocks and chunks that overlap by ``WIDTH - 1`` words. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import read, settle, size_tasks

WIDTH, LEAST, TOP, INSIDE = 4, 30, 2000, 80
CHUNK = 1 << 20  # words of a chunk
BLOCK = 8 << 20  # bytes of text that are split into words at once
BUCKET = 2_000_000  # suffixes of a bucket, about
HOT = 1024
U64 = np.uint64
# Pieces end at line breaks after this; a tab is a space.
PLAIN = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
CODES = [f"c{k}" for k in range(WIDTH)]


class Words(dict):
    """Numbers of one language's words in a chunk; the break between pieces is 0 in all languages."""

    def __init__(self, lang: bytes, names: list[tuple[bytes, bytes]]):
        super().__init__({b"\n": 0})
        self.lang, self.names = lang, names

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append((self.lang, word))
        return number


def blocks(text: bytes, size: int) -> Iterator[list[bytes]]:
    """The words and breaks of a text, some megabytes at a time, cut between words."""
    plain, at = text.lower().translate(PLAIN), 0
    while at < len(plain):
        end = at + size
        if end < len(plain):
            cut = max(plain.rfind(b" ", at + 1, end), plain.rfind(b"\n", at + 1, end))
            if cut < 0:
                cut = min([p for p in (plain.find(b" ", end), plain.find(b"\n", end)) if p >= 0], default=len(plain))
            end = cut
        part = plain[at:end] if at or end < len(plain) else plain
        yield list(filter(None, part.replace(b"\n", b" \n ").split(b" ")))
        at = end


def chunks(batches: Iterator[pa.RecordBatch], chunk: int = CHUNK, block: int = BLOCK) -> Iterator[tuple[np.ndarray, int, list[tuple[bytes, bytes]]]]:
    """(numbers, own, names): the words of some texts as numbers, 0 for a break; a suffix belongs to the chunk if it starts before ``own``."""
    names: list[tuple[bytes, bytes]] = [(b"", b"")]
    words: dict[bytes, Words] = {}
    parts: list[np.ndarray] = []
    held = 0

    def number(lang: bytes, found: list[bytes]) -> np.ndarray:
        if lang not in words:
            words[lang] = Words(lang, names)
        return np.fromiter(map(words[lang].__getitem__, found), np.int64, len(found))

    for batch in batches:
        for lang, text in zip(*(pc.cast(c, pa.binary()).to_pylist() for c in batch.columns)):
            lang = b"und" if lang is None else lang
            for found in blocks(text or b"", block):
                for at in range(0, len(found), chunk):
                    parts.append(number(lang, found[at:at + chunk]))
                    held += len(parts[-1])
                    if held >= chunk:
                        ids = np.concatenate(parts)
                        own = max(len(ids) - WIDTH + 1, 0)
                        yield ids, own, names
                        # The last words' suffixes may go on; they start the next chunk.
                        rest = [names[i] for i in ids[own:].tolist()]
                        names, words, parts, held = [(b"", b"")], {}, [], 0
                        for of, word in rest:
                            parts.append(number(of, [word]) if word else np.zeros(1, np.int64))
            parts.append(np.zeros(1, np.int64))
    if parts:
        ids = np.concatenate(parts)
        yield ids, len(ids), names


def codes_of(names: list[tuple[bytes, bytes]]) -> np.ndarray:
    """A hash of each word with its language, 0 for the break."""
    out = np.fromiter((xxhash.xxh3_64_intdigest(lang + b"\n" + word) | 1 for lang, word in names), U64, len(names))
    out[0] = 0
    return out


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a * U64(0x9E3779B97F4A7C15) + b) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(29))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(32))


def shifted(ids: np.ndarray, own: int) -> list[np.ndarray]:
    """The words of every suffix that starts before ``own``, 0 after the end of its piece."""
    padded = np.concatenate([ids, np.zeros(WIDTH, np.int64)])
    columns = [padded[:own]]
    for k in range(1, WIDTH):
        columns.append(np.where(columns[-1] == 0, 0, padded[k:own + k]))
    return columns


def counted_words(docs: DataFrame, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """(lang, word, code, next, n): words (next is 0) and, without names, pairs of a chunk that make up one in ``HOT / 4`` of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, own, names in chunks(batches, chunk, block):
            codes, counts = codes_of(names), np.bincount(ids[:own], minlength=len(names))
            counts[0] = 0
            a, b = shifted(ids, own)[:2]
            pairs, n = np.unique((a * len(names) + b)[(a > 0) & (b > 0)], return_counts=True)
            heavy = n >= max(own * 4 // HOT, 1)
            used = np.flatnonzero(counts)
            text = lambda k: [names[i][k] for i in used.tolist()] + [None] * int(heavy.sum())
            whole = lambda words, more, kind: pa.array(np.concatenate([words, more]), kind)
            first, second = pairs[heavy] // len(names), pairs[heavy] % len(names)
            yield pa.RecordBatch.from_arrays([
                pa.array(text(0), pa.binary()).cast(pa.string()), pa.array(text(1), pa.binary()).cast(pa.string()),
                whole(codes[used].view(np.int64), codes[first].view(np.int64), pa.int64()),
                whole(np.zeros(len(used), np.int64), codes[second].view(np.int64), pa.int64()),
                whole(counts[used], n[heavy], pa.int64())], names=["lang", "word", "code", "next", "n"])

    found = docs.mapInArrow(run, "lang string, word string, code long, next long, n long")
    return found.groupBy("lang", "word", "code", "next").agg(F.sum("n").alias("n"))


def _packed(columns: list[np.ndarray], counts: np.ndarray, codes: np.ndarray, squeeze) -> bytes:
    """Suffixes of one bucket: the codes of their words, then numbers of these words."""
    used = np.zeros(len(codes), bool)
    for c in columns:
        used[c] = True
    used[0] = True
    place = np.cumsum(used) - 1
    kind = np.uint16 if place[-1] < 1 << 16 else np.uint32
    listed = codes[used]
    head = np.array([len(listed), len(counts), np.dtype(kind).itemsize], np.int64)
    return squeeze.compress(b"".join([head.tobytes(), listed.tobytes(), counts.astype(np.int64).tobytes(), *(place[c].astype(kind).tobytes() for c in columns)]))


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    data = zstandard.decompress(blob)
    n_codes, n, width = np.frombuffer(data, np.int64, 3).tolist()
    codes = np.frombuffer(data, U64, n_codes, 24)
    counts = np.frombuffer(data, np.int64, n, 24 + 8 * n_codes)
    at = 24 + 8 * (n_codes + n)
    kind = np.uint16 if width == 2 else np.uint32
    return codes, counts, [np.frombuffer(data, kind, n, at + k * n * width) for k in range(WIDTH)]


def routed(docs: DataFrame, buckets: int, hot: np.ndarray, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """(bucket, hot, body): each chunk's suffixes by their leading words. ``hot``: mixed codes of the pairs that are dealt by the third word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for ids, own, names in chunks(batches, chunk, block):
            codes = codes_of(names)
            columns = shifted(ids, own)
            keep = (columns[0] > 0) & (columns[1] > 0)
            columns = [c[keep] for c in columns]
            lead = mix(codes[columns[0]], codes[columns[1]])
            is_hot = np.isin(lead, hot)
            lead = np.where(is_hot, mix(lead, codes[columns[2]]), lead)
            rest = mix(mix(lead, codes[columns[2]]), codes[columns[3]])
            # By leading words; equal suffixes lie together but for rare collisions of the lower bits, which only keep two entries.
            order = np.argsort((lead & ~U64(0xFFFFFF)) | (rest >> U64(40)))
            columns = [c[order] for c in columns]
            new = np.ones(len(order), bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
            begin = np.flatnonzero(new)
            counts = np.diff(np.append(begin, len(order)))
            columns = [c[begin] for c in columns]
            bucket = ((lead[order][begin] >> U64(32)) * U64(buckets)) >> U64(32)
            flag = is_hot[order][begin]
            rows = []
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist() if len(begin) else []
            for a, b in zip(cuts, [*cuts[1:], len(begin)]):
                for kind in (False, True):
                    own_rows = a + np.flatnonzero(flag[a:b] == kind)
                    if len(own_rows):
                        rows.append((int(bucket[a]), kind, _packed([c[own_rows] for c in columns], counts[own_rows], codes, squeeze)))
            for at in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[at:at + 64]), (pa.int64(), pa.bool_(), pa.binary()))], names=["bucket", "hot", "body"])

    return docs.mapInArrow(run, "bucket long, hot boolean, body binary")


def frequent(columns: list[np.ndarray], weight: np.ndarray, least: int = LEAST, known: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pointer, length, count) of the phrases of two words or more that count at least ``least``, by three-way multikey quicksort.

    Up to a depth of ``known`` words nothing is abandoned: counts of such phrases are parts of larger ones. Word 0 ends a suffix.
    """
    n, width = len(weight), len(columns)
    flat = np.concatenate(columns) if n else np.zeros(0, np.int64)
    order, start, depth = np.arange(n), np.zeros(min(n, 1), np.int64), np.zeros(min(n, 1), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(order):
        size = np.diff(np.append(start, len(order)))
        part = np.repeat(np.arange(len(start)), size)
        key = flat[depth[part] * n + order]
        pivot = key[start + size // 2]
        of = pivot[part]
        slot = 3 * part + (key >= of) + (key > of)
        total = np.bincount(slot, weights=weight[order], minlength=3 * len(start)).astype(np.int64).reshape(-1, 3)
        many = np.bincount(slot, minlength=3 * len(start)).reshape(-1, 3)
        # Which parts stay open: the outer ones at this depth, the middle one at the next.
        keep = (many > 0) & ((total >= least) | (depth < known)[:, None])
        word = keep[:, 1] & (pivot > 0) & ((total[:, 1] >= least) | (depth + 1 <= known))
        keep[:, 1] = word & (depth + 1 < width) & ((total[:, 1] >= least) | (depth + 1 < known))
        phrase = np.flatnonzero(word & (depth > 0))
        if len(phrase):
            found.append((order[start[phrase] + size[phrase] // 2], depth[phrase] + 1, total[phrase, 1]))
        open_sizes = np.where(keep, many, 0)
        begin = (np.cumsum(open_sizes.ravel()) - open_sizes.ravel()).reshape(-1, 3)
        fresh = np.empty(int(open_sizes.sum()), np.int64)
        for side in range(3):
            rows = np.flatnonzero(keep.ravel()[slot] & (slot - 3 * part == side))
            before = np.cumsum(open_sizes[:, side]) - open_sizes[:, side]
            own = part[rows]
            fresh[begin[own, side] + np.arange(len(rows)) - before[own]] = order[rows]
        opened = np.flatnonzero(keep.ravel())
        order, start = fresh, begin.ravel()[opened]
        depth = depth[opened // 3] + (opened % 3 == 1)
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))


def phrases(entries: DataFrame, buckets: int, least: int = LEAST) -> DataFrame:
    """(c0 to c3, a): the frequent phrases of two words or more as codes, 0 where a phrase has fewer words."""
    def counted(bodies: list[bytes], known: int) -> pa.RecordBatch:
        parts = [_unpacked(b) for b in bodies]
        codes = np.unique(np.concatenate([p[0] for p in parts]))  # the smallest is 0, which ends a piece
        places = [np.searchsorted(codes, p[0]) for p in parts]
        columns = [np.concatenate([place[p[2][k]] for place, p in zip(places, parts)]) for k in range(WIDTH)]
        at, length, count = frequent(columns, np.concatenate([p[1] for p in parts]), least, known)
        out = [np.where(k < length, codes[columns[k][at]], U64(0)).view(np.int64) for k in range(WIDTH)]
        return pa.RecordBatch.from_arrays([*map(pa.array, out), pa.array(count, pa.int64())], names=[*CODES, "a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, bodies = None, []
        for batch in batches:
            for bucket, hot, body in zip(*(c.to_pylist() for c in batch.columns)):
                if (bucket, hot) != at and bodies:
                    yield counted(bodies, 2 if at[1] else 0)
                    bodies = []
                at = (bucket, hot)
                bodies.append(body)
        if bodies:
            yield counted(bodies, 2 if at[1] else 0)

    # A task for each bucket; by hashes some tasks would get several and others none.
    sent = entries.repartitionById(buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "hot")
    found = sent.mapInArrow(run, ", ".join(f"{c} long" for c in CODES) + ", a long")
    # A pair that was dealt by its third word has a part of its count in several buckets.
    return found.groupBy(*CODES).agg(F.sum("a").alias("a")).filter(F.col("a") >= least)


def _span(first: int, length: int) -> list:
    """The codes of words ``first`` and on, filled up with 0."""
    return [F.col(CODES[first + k]).alias(CODES[k]) if k < length else F.lit(0).cast("long").alias(CODES[k]) for k in range(WIDTH)]


def _by_length(spans: dict[int, list]):
    """One of several arrays, by the number of words; each row explodes into its structs."""
    size = F.lit(0)
    for c in CODES:
        size = size + (F.col(c) != 0).cast("int")
    return F.explode(F.coalesce(*[F.when(size == m, F.array(*structs)) for m, structs in spans.items()]))


def scored(found: DataFrame, words: DataFrame, inside: int = INSIDE) -> DataFrame:
    """(c0 to c3, a, l, r, score): candidates that no longer one contains too often, by their worst cut. ``words``: code, f."""
    grams = found.unionByName(words.select(F.col("code").alias("c0"), *[F.lit(0).cast("long").alias(c) for c in CODES[1:]], F.col("f").alias("a")))
    cuts = {m: [F.struct(F.lit(k).alias("k"), F.struct(*_span(0, k)).alias("left"), F.struct(*_span(k, m - k)).alias("right")) for k in range(1, m)]
            for m in range(2, WIDTH + 1)}
    parts = found.select(*CODES, "a", _by_length(cuts).alias("cut"))
    side = lambda which, name: grams.select(*[F.col(c).alias(f"{which}_{c}") for c in CODES], F.col("a").alias(name))
    flat = parts.select(*CODES, "a", "cut.k", *[F.col(f"cut.{s}.{c}").alias(f"{s}_{c}") for s in ("left", "right") for c in CODES])
    both = (flat.join(side("left", "l"), [f"left_{c}" for c in CODES]).join(side("right", "r"), [f"right_{c}" for c in CODES])
            .withColumn("score", F.expr("cast(2000000 as decimal(7, 0)) * cast(a as decimal(19, 0)) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")))
    worst = both.groupBy(*CODES, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("w")).select(*CODES, "a", "w.l", "w.r", "w.score")
    within = {m: [F.struct(*_span(at, n)) for n in range(2, m) for at in range(m - n + 1)] for m in range(3, WIDTH + 1)}
    longer = (found.select("a", _by_length(within).alias("s")).groupBy(*[F.col(f"s.{c}").alias(c) for c in CODES])
              .agg(F.max("a").alias("longer")))
    hidden = longer.join(found, CODES).filter(
        F.expr(f"cast(longer as decimal(19, 0)) * 100 >= cast(a as decimal(19, 0)) * {inside}")).select(*CODES)
    return worst.join(hidden, CODES, "left_anti")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, chunk: int = CHUNK, block: int = BLOCK, bucket: int = BUCKET, hot: int = HOT) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score. ``docs``: lang, text."""
    rows = docs.select("lang", "text")
    counts = settle(counted_words(rows, chunk, block), "words")
    words = counts.filter("next = 0")
    totals = settle(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    n = totals.agg(F.sum("n")).first()[0] or 0
    # At most ``hot`` rows: together they count no more than all words.
    heavy = counts.filter((F.col("next") != 0) & (F.col("n") * hot >= n)).select("code", "next").collect()
    pairs = np.array([(r[0], r[1]) for r in heavy], np.int64).reshape(-1, 2).view(U64)
    buckets = size_tasks(n, bucket)
    found = settle(phrases(routed(rows, buckets, np.sort(mix(pairs[:, 0], pairs[:, 1])), chunk, block), buckets, least), "phrases")
    known = settle(words.filter(F.col("n") >= least).select("lang", "word", "code", F.col("n").alias("f")), "known")
    ranked = scored(found, known).join(known.select(F.col("code").alias("c0"), "lang", F.col("word").alias("w0")), "c0")
    # Ties of the last place stay until their text decides.
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = settle(ranked.withColumn("place", F.rank().over(order)).filter(F.col("place") <= top).drop("place"), "best")
    for k in range(1, WIDTH):
        best = best.join(known.select(F.col("code").alias(CODES[k]), F.col("word").alias(f"w{k}")), CODES[k], "left")
    named = best.withColumn("phrase", F.concat_ws(" ", *[f"w{k}" for k in range(WIDTH)]))
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (named.withColumn("rank", F.row_number().over(last).cast("long")).filter(F.col("rank") <= top)
            .join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


ORACLE = rf"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
listed as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
placed as (select lang, w, unnest(range(1, len(w) + 1)) as i from listed),
grams as (
    select lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') as phrase, count(*) as f
    from placed, range(1, {WIDTH + 1}) t(m) where i + m - 1 <= len(w) group by all),
totals as (select lang, cast(sum(f) as bigint) as n from grams where m = 1 group by lang),
candidates as (select lang, m, phrase, f as a, string_split(phrase, ' ') as w from grams where m > 1 and f >= {LEAST}),
cuts as (select *, unnest(range(1, m)) as k from candidates),
parts as (
    select c.lang, c.m, c.phrase, c.a, k, x.f as l, y.f as r, cast((2000000 * cast(c.a as hugeint)) // (x.f + y.f) as bigint) as score
    from cuts c join grams x on x.lang = c.lang and x.phrase = array_to_string(list_slice(w, 1, k), ' ')
    join grams y on y.lang = c.lang and y.phrase = array_to_string(list_slice(w, k + 1, c.m), ' ')),
worst as (select * from parts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
spans as (select lang, a, w, m, unnest(range(2, m)) as size from candidates),
inner_spans as (select lang, a, w, m, size, unnest(range(1, m - size + 2)) as i from spans),
longer as (select lang, array_to_string(list_slice(w, i, i + size - 1), ' ') as phrase, max(a) as longer from inner_spans group by all),
kept as (select v.* from worst v left join longer o on o.lang = v.lang and o.phrase = v.phrase where longer is null or 100 * longer < {INSIDE} * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept join totals using (lang) qualify rank <= {TOP}
"""
