"""Near copies by exact Jaccard similarity of five-word shingles.

1. A text is the set of its shingles' 64-bit hashes; texts with one set are one entry from there on, made with map-side minima.
2. Each set has a SimHash fingerprint, the bits that over half of its shingles' hashes have, as in ``simhash``. BK-trees over shards of the fingerprints find
   for each the smallest one within ``RADIUS`` bits, and the set is compared with the first set there, exactly. So are sets of one fingerprint.
3. Pairs of similarity 0.8 may differ in more bits than a radius can span. ``BANDS`` keys of ``ROWS`` minhashes each find the sets that may have such a partner: two
   sets of similarity s share a key unless all bands differ, which has the chance (1 - s^ROWS)^BANDS, 5e-8 at 0.8. Keys that one set holds propose nothing. A set
   without a neighbour in the trees is compared with the first set of its keys; after that, any set with the first one of another group there. Most groups are whole then.
4. Sets of keys that still hold several groups form families by exact prefixes: shingles are ordered by the number of these sets that have them, rarest first. If
   two sets are similar, their first ``n - ceil(0.8n) + 1`` shingles share one. Shingles that one set has take up the first places and meet nobody, so texts that
   share much but differ by words of their own are in no family. The components of shared prefix shingles are the families.
5. A family is compared within tasks: overlaps of all its sets are counted at once, by products of matrices for shingles that many of them have and by
   postings for the others, and only a link for each two groups that turn out to be one leaves the task. A family of more than ``BLOCK`` shingles is cut into
   blocks, each pair of blocks is a task of its own.
6. Components of all links as in ``simhash``.

Steps 2 and 3 send at most two pairs for each set, step 4 some shingles of each set, step 5 a set as often as its family has blocks. No step sends the pairs of a
group. In steps 2 and 3 a set that many others are compared with is dealt to several tasks.

Texts of less than five words are one shingle, texts without words are equal, null counts as empty. Documents are told apart by id and text: of
a group the one with the smallest id stays, of two texts with this id the one with the smaller hash, repeated rows once. Documents without an id stay
and link nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tripmart.llm.common import narrow_batches, settle
from tripmart.llm.simhash import components, majority, neighbours, whole_groups
from tripmart.llm.substrings import rolling, word_hashes

SHINGLE, SIMILAR = 5, 0.8
BANDS, ROWS = 32, 4
RADIUS = 6  # bits between the fingerprints of sets that the trees propose
BLOCK = 1 << 20  # shingles of one family in one side of one task
DENSE = 512  # columns of a matrix that are multiplied at once
SHARE = 1000  # pairs of one set that are compared in one task
CHUNK = 4096  # shingles whose minhashes are made at once
U64 = np.uint64
_DRAWN = np.random.default_rng(42).integers(0, 1 << 64, (2, BANDS * ROWS), U64)
FLIPS, FACTORS = _DRAWN[0], _DRAWN[1] | U64(1)


def shingles(text: bytes) -> np.ndarray:
    """The distinct shingles' hashes, in order."""
    words = text.lower().split()
    if len(words) <= SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], U64)
    return np.unique(rolling(word_hashes(words), SHINGLE, 0x9E3779B97F4A7C15))


def name(found: np.ndarray) -> int:
    """A signed 64-bit hash of a whole set."""
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def minhashes(found: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * ROWS, ~U64(0))
    for at in range(0, len(found), CHUNK):
        np.minimum(least, ((found[at:at + CHUNK, None] ^ FLIPS) * FACTORS).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    h = np.arange(BANDS, dtype=U64)
    for column in least.reshape(BANDS, ROWS).T:
        h = (h ^ column) * U64(0xBF58476D1CE4E5B9)
        h ^= h >> U64(31)
    return h.view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def sketches(rows: DataFrame) -> DataFrame:
    """(id, hash, name, fp, keys) of ``rows`` (id, hash, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, prints, keys = [], [], []
            for t in pc.cast(batch.column(2), pa.binary()).to_pylist():
                found = shingles(t or b"")
                names.append(name(found))
                prints.append(majority(found))
                keys.append(band_keys(minhashes(found)))
            flat = pa.array(np.concatenate([np.zeros(0, np.int64), *keys]))
            offsets = pa.array(np.arange(len(names) + 1, dtype=np.int32) * BANDS)
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:2], pa.array(names, pa.int64()), pa.array(np.array(prints, U64).view(np.int64)), pa.ListArray.from_arrays(offsets, flat)],
                names=["id", "hash", "name", "fp", "keys"])

    return rows.mapInArrow(run, rows.select("id", "hash").schema.add("name", "long").add("fp", "long").add("keys", ArrayType(LongType())))


def whole_sets(rows: DataFrame) -> DataFrame:
    """(name, n, body): the set of each text and its size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t or b"") for t in pc.cast(batch.column(0), pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                pa.array(list(map(name, found)), pa.int64()), pa.array(list(map(len, found)), pa.int32()),
                pa.array([f.tobytes() for f in found], pa.binary())], names=["name", "n", "body"])

    return rows.select("text").mapInArrow(run, "name long, n int, body binary")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b: names) whose ``sets`` are similar."""
    pairs = settle(pairs, "pairs")
    asked = pairs.select(F.col("a").alias("name")).unionByName(pairs.select(F.col("b").alias("name"))).groupBy("name").agg(F.count("*").alias("n"))
    shares = settle(asked.select("name", F.ceil(F.col("n") / SHARE).cast("int").alias("shares")), "shares")
    dealt = settle(sets.select("name", "body").join(shares, "name").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))), "dealt")
    several = settle(shares.filter("shares > 1"), "several")

    def attach(left: DataFrame, side: str, other: str) -> DataFrame:
        hot = several.select(F.col("name").alias(side), "shares")
        share = F.pmod(F.xxhash64(other), F.coalesce("shares", F.lit(1))).cast("int")
        right = dealt.select(F.col("name").alias(side), "share", F.col("body").alias(f"{side}_body"))
        return left.join(hot, side, "left").withColumn("share", share).drop("shares").join(right, [side, "share"]).drop("share")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [[np.frombuffer(v, U64) for v in batch.column(i).to_pylist()] for i in (2, 3)]
            near = pa.array([similarity(x, y) >= SIMILAR for x, y in zip(*sides)], pa.bool_())
            yield batch.select(["a", "b"]).filter(near)

    both = attach(attach(pairs, "a", "b"), "b", "a").select("a", "b", "a_body", "b_body")
    return both.mapInArrow(run, "a long, b long")


def prefixes(suspects: DataFrame, sets: DataFrame) -> DataFrame:
    """(shingle, name): the shingles of each set's prefix that other suspects have, too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [np.frombuffer(v, np.int64) for v in batch.column(2).to_pylist()]
            row = pa.array(np.repeat(np.arange(len(bodies)), [len(b) for b in bodies]))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(row), batch.column(1).take(row), pa.array(np.concatenate([np.zeros(0, np.int64), *bodies]))],
                names=["name", "n", "shingle"])

    held = settle(sets.join(suspects.select("name"), "name", "left_semi").mapInArrow(run, "name long, n int, shingle long"), "shingles")
    shared = settle(held.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1"), "shared")
    listed = held.join(shared, "shingle").groupBy("name", "n").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("all"))
    # Shingles of its own take up the first places of a set.
    reach = F.greatest(F.col("n") - F.expr("(4 * n + 4) div 5") + 1 - (F.col("n") - F.size("all")), F.lit(0)).cast("int")
    return listed.select("name", F.explode(F.slice("all", F.lit(1), reach)["shingle"]).alias("shingle")).select("shingle", "name")


def families(entries: DataFrame) -> DataFrame:
    """(name, family) of the sets that a chain of shared prefix shingles joins."""
    first = entries.groupBy("shingle").agg(F.min("name").alias("first"), F.count("*").alias("n")).filter("n > 1").select("shingle", "first")
    edges = entries.join(first, "shingle").filter("name != first").select(F.col("first").alias("a"), F.col("name").alias("b")).distinct()
    return components(settle(edges, "meetings")).select(F.col("node").alias("name"), F.col("label").alias("family"))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``left`` shares with each of ``right``."""
    sizes = [len(b) for b in left], [len(b) for b in right]
    listed, column = np.unique(np.concatenate([np.zeros(0, U64), *left, *right]), return_inverse=True)
    sides = []
    for of, cells in zip(sizes, np.split(column, [sum(sizes[0])])):
        order = np.argsort(cells, kind="stable")
        sides.append((cells[order], np.repeat(np.arange(len(of)), of)[order], np.bincount(cells, minlength=len(listed))))
    (columns, rows, many), (columns2, rows2, many2) = sides
    out = np.zeros((len(left), len(right)), np.float32)
    work = many * many2
    dense = work > len(left) * len(right) // 32
    number = np.cumsum(dense) - 1
    for at in range(0, int(dense.sum()), DENSE):
        both = []
        for cells, row, of in ((columns, rows, len(left)), (columns2, rows2, len(right))):
            own = dense[cells] & (number[cells] >= at) & (number[cells] < at + DENSE)
            matrix = np.zeros((of, DENSE), np.float32)
            matrix[row[own], number[cells[own]] - at] = 1
            both.append(matrix)
        out += both[0] @ both[1].T
    # The others by postings: each left row of a column with each right row of it, some millions at a time.
    begin, begin2 = np.cumsum(many) - many, np.cumsum(many2) - many2
    sparse = np.flatnonzero((work > 0) & ~dense)
    cuts = np.searchsorted(np.cumsum(work[sparse]), np.arange(0, int(work[sparse].sum()) + 1, 1 << 22), "left") if len(sparse) else []
    for a, b in zip(cuts, [*cuts[1:], len(sparse)]):
        cols = sparse[a:b]
        if not len(cols):
            continue
        own = np.repeat(cols, many[cols])
        i = rows[np.repeat(begin[cols] - (np.cumsum(many[cols]) - many[cols]), many[cols]) + np.arange(len(own))]
        times = many2[own]
        j = rows2[np.repeat(begin2[own] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))]
        out += np.bincount(np.repeat(i, times) * len(right) + j, minlength=out.size).reshape(out.shape).astype(np.float32)
    return out


def joined(names: np.ndarray, labels: np.ndarray, bodies: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links (a, b) of names that join the groups whose sets in ``left`` and ``right`` are similar, one for each join."""
    sizes = np.array([len(b) for b in bodies], np.int64)
    shared = overlaps([bodies[i] for i in left], [bodies[j] for j in right])
    # Jaccard similarity of 0.8 in whole numbers.
    i, j = np.nonzero(9 * shared >= 4 * (sizes[left][:, None] + sizes[right][None]))
    i, j = left[i], right[j]
    differ = labels[i] != labels[j]
    i, j = i[differ], j[differ]
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    # One pair of sets for each pair of groups is enough.
    _, once = np.unique(np.stack([np.minimum(labels[i], labels[j]), np.maximum(labels[i], labels[j])]), axis=1, return_index=True)
    out = []
    for x, y in zip(i[once].tolist(), j[once].tolist()):
        a, b = find(int(labels[x])), find(int(labels[y]))
        if a != b:
            root[a] = b
            out.append((int(names[x]), int(names[y])))
    return out


def within(member: DataFrame, sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that join the groups of each family. ``member``: name, label, family."""
    held = member.join(sets, "name")
    sizes = settle(held.groupBy("family").agg(F.sum("n").alias("shingles"), F.min("label").alias("low"), F.max("label").alias("high"))
                   .filter("low < high").select("family", F.ceil(F.col("shingles") / block).cast("int").alias("blocks")), "sizes")
    dealt = held.join(sizes, "family").withColumn("own", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
    # Each pair of blocks (low, high) is a task; a block pairs with itself, too.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tasks = dealt.withColumn("other", other).select(
        "family", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "name", "label", "body")
    keys = ["family", "low", "high"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (_, low, high), group in whole_groups(batches, keys):
            own, names, labels = (group[c].to_numpy() for c in ("own", "name", "label"))
            bodies = [np.frombuffer(b, U64) for b in group["body"]]
            found = joined(names, labels, bodies, np.flatnonzero(own == low), np.flatnonzero(own == high))
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    return tasks.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, "a long, b long")


def print_pairs(distinct: DataFrame) -> DataFrame:
    """(a, b): for each name b the first one of its fingerprint, or of the smallest fingerprint within the radius."""
    first = settle(distinct.groupBy("fp").agg(F.min("name").alias("first")), "prints")
    near = (neighbours(first.select("fp"), RADIUS).join(first, "fp")
            .join(first.select(F.col("fp").alias("least"), F.col("first").alias("a")), "least").select("a", F.col("first").alias("b")))
    same = distinct.join(first, "fp").filter("name != first").select(F.col("first").alias("a"), F.col("name").alias("b"))
    return near.unionByName(same)


def links(distinct: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) of names whose components are those of all similar pairs. ``distinct``: name, fp, least, keys; ``rows``: id, hash, text."""
    near = settle(print_pairs(distinct), "near")
    narrow_batches(distinct.sparkSession)
    held = distinct.select("name", F.explode("keys").alias("key"))
    sizes = settle(held.groupBy("key").agg(F.count("*").alias("n"), F.min("name").alias("first")).filter("n > 1").select("key", "first"), "sizes")
    member = settle(held.join(sizes, "key"), "member")
    named = near.select(F.explode(F.array("a", "b")).alias("name")).unionByName(member.select("name")).distinct()
    partners = settle(distinct.join(named, "name", "left_semi").select("name", "least.id", "least.hash"), "partners")
    texts = rows.join(partners.select("id", "hash").distinct(), ["id", "hash"], "left_semi")
    sets = settle(whole_sets(texts).join(partners.select("name"), "name", "left_semi").dropDuplicates(["name"]), "sets")

    def labelled(found: DataFrame) -> DataFrame:
        labels = components(found)
        return member.select("key", "name").join(labels.withColumnRenamed("node", "name"), "name", "left").withColumn("label", F.coalesce("label", "name"))

    stars = member.filter("name != first").groupBy(F.col("name").alias("b")).agg(F.min("first").alias("a"))
    far = stars.join(near.select("b"), "b", "left_anti").select("a", "b")
    found = settle(confirmed(near.unionByName(far), sets), "links")
    groups = settle(labelled(found), "labels")
    leads = groups.groupBy("key").agg(F.min(F.struct("label", "name")).alias("lead"), F.max("label").alias("high")).filter("lead.label < high")
    second = (groups.join(leads.select("key", "lead"), "key").filter(F.col("label") != F.col("lead.label"))
              .groupBy(F.col("name").alias("b")).agg(F.min("lead.name").alias("a")))
    found = settle(found.unionByName(confirmed(second.select("a", "b"), sets)), "links")
    groups = settle(labelled(found), "labels")
    mixed = groups.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("key")
    suspects = settle(groups.join(mixed, "key", "left_semi").select("name", "label").distinct(), "suspects")
    family = families(settle(prefixes(suspects, sets), "prefixes"))
    return found.unionByName(within(suspects.join(family, "name"), sets, block))


def one_of_each(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One document of each group of near copies."""
    narrow_batches(docs.sparkSession)
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.filter("doc_id is not null").select(F.col("doc_id").alias("id"), hashed.alias("hash"), "text")
    found = sketches(rows).groupBy("name").agg(F.min(F.struct("id", "hash")).alias("least"), F.first("fp").alias("fp"), F.first("keys").alias("keys"))
    distinct = settle(found, "distinct")
    labels = components(settle(links(distinct, rows, block), "links"))
    label = F.coalesce("label", "name")
    best = (distinct.select("name", "least").join(labels.withColumnRenamed("node", "name"), "name", "left")
            .groupBy(label.alias("label")).agg(F.min("least").alias("least"))
            .select(F.col("least.id").alias("doc_id"), F.col("least.hash").alias("\0hash")).distinct())
    named = docs.filter("doc_id is not null").withColumn("\0hash", hashed)
    kept = named.join(settle(best, "best"), ["doc_id", "\0hash"], "left_semi").dropDuplicates(["doc_id", "\0hash"])
    return kept.select(*docs.columns).unionByName(docs.filter("doc_id is null"))
