"""Near copies by 64-bit SimHash fingerprints and BK-trees.

A fingerprint comes from one pass over a text. Fingerprints are then deduplicated with map-side sums, so a group of
exact copies is one row from there on. Cut into ``radius + agree`` pieces, two fingerprints at most ``radius`` bits apart agree on ``agree`` of them at least
(pigeonhole), so each choice of ``agree`` pieces with its bits is a shard. ``agree`` follows from the number of fingerprints: one piece does for
millions, with more of them shards stay as small for billions, and any number finds the same pairs. A shard's fingerprints form a BK-tree: a child hangs on
the integer Hamming distance to its parent, and a search follows only the edges within the radius. A task gets the shard
once as tree and in blocks as queries; a shard with more than ``BLOCK`` fingerprints is cut into blocks, each pair of
blocks is a task of its own, so no group is too large for a task and none is capped.

Inside a task the links found go into a union-find and only a star of each group leaves it, so a group of n near copies gives
n links, not n². Components come from rounds of label minima over those stars, each written to the shared folder.

A text without words has fingerprint zero and links like any other; null counts as empty. Repeated rows and null ids keep a
row each; a null id is larger than every other one. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import narrow_batches, read, settle

SHINGLE, SEED, RADIUS, BITS = 4, 42, 4, 64
BLOCK = 4096  # fingerprints in one tree of one task
CHUNK = 1 << 15  # shingles whose bits are unpacked at once


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[: len(words) - width + 1].tolist()
    stops = (ends[width - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(starts)))


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of some hashes: the bits that over half of them have."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def add_fingerprints(docs: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """``docs`` without ``text``, with its fingerprint as a signed long."""
    narrow_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (text, out)]
    rows = docs.select(*kept, F.col(text).alias("\0text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.cast(batch.column(len(kept)), pa.binary()).to_pylist()
            prints = np.fromiter((fingerprint(t or b"") for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(prints)], names=[*kept, out])

    schema = docs.select(*kept).schema.add(out, "long")
    return rows.mapInArrow(run, schema)


class Tree:
    """A BK-tree over 64-bit numbers, its levels kept as arrays so that many searches advance together.

    A node's children are told apart by their distance to it; ``child[node, distance]`` is kept as a sorted key.
    """

    def __init__(self, values: np.ndarray):
        self.values = values
        parent = np.full(len(values), -1, np.int64)
        edge = np.zeros(len(values), np.int64)
        # All values start at the root; at each node the first value with a distance becomes the child of that edge.
        waiting, at = np.arange(1, len(values)), np.zeros(max(len(values) - 1, 0), np.int64)
        while len(waiting):
            distance = np.bitwise_count(values[waiting] ^ values[at]).astype(np.int64)
            key = at * (BITS + 1) + distance
            _, first, group = np.unique(key, return_index=True, return_inverse=True)
            chosen = waiting[first]
            parent[chosen], edge[chosen] = at[first], distance[first]
            rest = np.ones(len(waiting), bool)
            rest[first] = False
            waiting, at = waiting[rest], chosen[group][rest]
        order = np.argsort(parent, kind="stable")
        self.child, self.edge = order, edge[order]
        self.begin = np.searchsorted(parent[order], np.arange(len(values)), "left")
        self.end = np.searchsorted(parent[order], np.arange(len(values)), "right")

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query index, value index) at most ``radius`` apart."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        asked, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        if not len(self.values):
            asked = node = np.zeros(0, np.int64)
        while len(asked):
            distance = np.bitwise_count(queries[asked] ^ self.values[node]).astype(np.int64)
            near = distance <= radius
            found.append((asked[near], node[near]))
            width = self.end[node] - self.begin[node]
            row = np.repeat(np.arange(len(asked)), width)
            place = np.arange(len(row)) - np.repeat(np.cumsum(width) - width, width) + self.begin[node][row]
            follow = np.abs(self.edge[place] - distance[row]) <= radius
            asked, node = asked[row[follow]], self.child[place[follow]]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def stars(tree: np.ndarray, queries: np.ndarray, radius: int, step: int = 256) -> list[tuple[int, int]]:
    """Links (member, smallest member) of the groups that the pairs within the radius form."""
    index = Tree(tree)
    both = np.concatenate([tree, queries])
    root = np.arange(len(both))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for at in range(0, len(queries), step):
        q, v = index.search(queries[at:at + step], radius)
        for a, b in zip((q + at + len(tree)).tolist(), v.tolist()):
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
    groups: dict[int, int] = {}
    tops = [find(i) for i in range(len(both))]
    for i, top in enumerate(tops):
        groups[top] = min(groups.get(top, int(both[i])), int(both[i]))
    return sorted({(int(both[i]), groups[top]) for i, top in enumerate(tops) if int(both[i]) != groups[top]})


def pieces(radius: int, agree: int) -> list[tuple[int, int]]:
    """(first bit, bits) of ``radius + agree`` pieces of nearly equal size."""
    n = radius + agree
    sizes = [BITS // n + (i < BITS % n) for i in range(n)]
    return list(zip(accumulate([0, *sizes]), sizes))


def agreement(count: int, radius: int, block: int = BLOCK) -> int:
    """The fewest pieces that must agree for a shard of spread fingerprints to be no larger than a block."""
    for agree in range(1, BITS - radius):
        if count >> (agree * (BITS // (radius + agree))) <= block:
            return agree
    return BITS - radius


def shards(prints: DataFrame, radius: int, block: int, agree: int | None) -> DataFrame:
    """Tasks (band, value, tree, query, fp, is_tree) in which any two of the distinct fingerprints ``fp`` (long) within the radius meet."""
    narrow_batches(prints.sparkSession, rows=20000)
    agree = agree or agreement(prints.count(), radius, block)

    def value(chosen: tuple[tuple[int, int], ...]) -> Column:
        bits, at = F.lit(0).cast("long"), 0
        for first, size in chosen:
            bits = bits.bitwiseOR(F.shiftleft(F.shiftrightunsigned("fp", first).bitwiseAND((1 << size) - 1), at))
            at += size
        return bits

    band = F.posexplode(F.array(*[value(c) for c in combinations(pieces(radius, agree), agree)])).alias("band", "value")
    placed = prints.select("fp", band)
    # A shard with one member links nothing; its size also says into how many blocks it is cut.
    sizes = placed.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1")
    member = (placed.join(sizes, ["band", "value"])
              .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
              .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")))
    # Block i serves as tree to blocks j >= i: a member is tree of (own, j) and query of (i, own).
    roles = F.concat(
        F.transform(F.sequence("own", F.col("blocks") - 1), lambda j: F.struct(F.col("own").alias("tree"), j.alias("query"), F.lit(True).alias("is_tree"))),
        F.when(F.col("own") > 0, F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda i: F.struct(
            i.alias("tree"), F.col("own").alias("query"), F.lit(False).alias("is_tree"))))
        .otherwise(F.array().cast("array<struct<tree:int,query:int,is_tree:boolean>>")))
    return member.select("band", "value", "fp", F.explode(roles).alias("r")).select("band", "value", "r.*", "fp")


KEYS = ["band", "value", "tree", "query"]


def shard_values(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The fingerprints in the tree and those that are looked up in it, of each task."""
    for key, group in whole_groups(batches, KEYS):
        values = group["fp"].to_numpy().view(np.uint64)
        tree = np.sort(values[group["is_tree"].to_numpy()])
        yield tree, np.sort(values[~group["is_tree"].to_numpy()]) if key[2] != key[3] else tree


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK, agree: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` (long) whose components are those of all pairs within the radius."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for tree, queries in shard_values(batches):
            pairs = np.array(stars(tree, queries, radius), np.uint64).reshape(-1, 2).view(np.int64)
            if len(pairs):
                yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    tasks = shards(prints, radius, block, agree)
    return tasks.repartition(*KEYS).sortWithinPartitions(*KEYS).mapInPandas(run, "a long, b long").distinct()


def least_neighbours(tree: np.ndarray, queries: np.ndarray, radius: int, step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(values, smallest value within the radius) of those values, as signed numbers, that have a smaller one in the tree or among the queries."""
    index = Tree(tree)
    held = np.unique(np.concatenate([tree, queries]).view(np.int64))
    least = held.copy()
    for at in range(0, len(queries), step):
        some = queries[at:at + step]
        q, v = index.search(some, radius)
        left, right = some[q].view(np.int64), tree[v].view(np.int64)
        np.minimum.at(least, np.searchsorted(held, np.maximum(left, right)), np.minimum(left, right))
    return held[least < held], least[least < held]


def neighbours(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK, agree: int | None = None) -> DataFrame:
    """(fp, least): the smallest fingerprint within the radius of each distinct ``fp`` (long) that has a smaller one there."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for tree, queries in shard_values(batches):
            values, least = least_neighbours(tree, queries, radius)
            if len(values):
                yield pd.DataFrame({"fp": values, "least": least})

    tasks = shards(prints, radius, block, agree)
    found = tasks.repartition(*KEYS).sortWithinPartitions(*KEYS).mapInPandas(run, "fp long, least long")
    return found.groupBy("fp").agg(F.min("least").alias("least"))


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]):
    """Cut sorted batches into the groups of ``keys``; a group may span batches."""
    rest: pd.DataFrame | None = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        columns = [batch[k].to_numpy() for k in keys]
        change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        cuts = [0, *change.tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield tuple(c[a] for c in columns), batch.iloc[a:b]
        rest = batch.iloc[cuts[-1]:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield tuple(rest[k].iloc[0] for k in keys), rest


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each component of the undirected ``edges`` (a, b).

    Each round a node takes the smallest label around it, then the label of that label; minima are summed on the map
    side, so a node with a third of all edges is no burden. Each round's labels are written to the shared folder.
    """
    both = settle(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = settle(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    while True:
        around = (both.join(labels.select(F.col("node").alias("b"), "label"), "b").select(F.col("a").alias("node"), "label")
                  .unionByName(labels).groupBy("node").agg(F.min("label").alias("label")))
        near = settle(around, "labels")
        jumped = (near.join(near.select(F.col("node").alias("label"), F.col("label").alias("next")), "label")
                  .select("node", F.least("label", "next").alias("label")))
        fresh = settle(jumped, "labels")
        moved = fresh.join(labels.select("node", F.col("label").alias("old")), "node").filter(F.col("label") != F.col("old"))
        labels = fresh
        if moved.isEmpty():
            return labels


def near_copies(docs: DataFrame, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row its id, ``fp`` and ``component``: the smallest id that links of at most ``radius`` bits reach."""
    prints = settle(add_fingerprints(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))), "prints")
    distinct = settle(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    labels = components(settle(links(distinct.select("fp"), radius), "links"))
    grouped = (distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
               .select("fp", "least", F.coalesce("label", "fp").alias("label")))
    smallest = grouped.groupBy("label").agg(F.min("least").alias("component"))
    of_print = settle(grouped.join(smallest, "label").select("fp", "component"), "components")
    return prints.join(of_print, "fp").select(F.col("id").alias(doc_id), "fp", "component")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(read(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))
