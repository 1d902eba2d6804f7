"""The trie of conversation prefixes, found by peeling turns off from the deepest level upwards.

1. Turns become codes: the digest of role and text, and the text's length in bytes. Conversations are rebuilt from codes alone, in one stream over rows
   that lie sorted by their source conversation: the stream holds the source's first ``HEAD`` turns and the conversation at hand. A conversation's
   path has ``CODE`` bytes a turn: a digest of all turns up to this one, and this one's length. So one place in a path names its node, and paths that
   agree there agree before it.
2. Equal conversations meet in one sorted stream, which counts them, takes the smallest id and digests all their ids as they pass. What is left is one
   *end* for each distinct conversation.
3. Peeling goes from the deepest level to the root. A level's nodes are the surviving nodes of the level below, stripped of their last turn, merged with the
   ends that lie on this level: paths that agree are one node, and its members, children, leaves and saved tokens are sums over what merges. A node is
   complete when its level is done, so each is found and summed in one pass.
   A level with many rows is a grouping with map-side sums, so a prefix that a third of all conversations share is one row from each task. Levels
   with few rows (at most ``CELLS`` rows over all of them, as the counts of ends by depth tell) are peeled together, below each node where they meet in one
   task, so one conversation of thousands of turns takes a few jobs and not thousands.
4. A node gets its parent's id by a join on the digests in the paths. Parents with more than ``SHARE`` children are dealt to several tasks.

Turns are ordered by turn (null first), then by role and digest; repeated rows are turns of their own. Null role or text is empty. Rows without
conv_id belong to no conversation. ``c % 5`` has the sign of c, as in SQL. Without conversations there is no root. Texts are equal if their 128-bit
digests are. A conversation's path is one value, so its turns are limited by the two gigabytes of such a value (89 million turns).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import new_path, read, settle

SPAN, HEAD = 5, 8  # conversations of one source, and the most turns taken from it
CODE, NAME = 24, 16  # bytes of a turn in a path, and of the digest in it; the other eight are the text's length
CELLS = 8192  # rows of the levels that are peeled together
SHARE = 100_000  # children of one node that get its id in one task
# ``own`` and ``above`` name the node and its parent; only nodes that the next step strips keep their path.
NODE_SCHEMA = ("path binary, own binary, above binary, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
               "ends string")
NODE = [c.split()[0] for c in NODE_SCHEMA.split(", ")]
NOBODY = hashlib.sha256(b"").hexdigest()


def rotation(conv_id: int) -> int:
    """Turns that a conversation takes from its source."""
    return zlib.crc32(str(conv_id).encode()) % (HEAD + 1)


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, path) of each conversation: the first turns of its source, then its own later ones. ``turns``: conv_id, turn, role, text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    source = F.col("conv_id") - F.col("conv_id") % SPAN
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    coded = turns.filter("conv_id is not null").select(
        source.alias("source"), (F.col("conv_id") != source).alias("taker"), "conv_id", "turn", role.alias("role"),
        digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    order = ["source", "taker", "conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]
    dealt = coded.repartition("source").sortWithinPartitions(*order).select("source", "taker", "conv_id", "digest", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, paths, held = [], [], 0
        at, own, rank, path, head, of = None, 0, 0, bytearray(), bytearray(), None
        for batch in batches:
            for source, taker, conv, digest, size in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != at:
                    if at is not None:
                        ids.append(at)
                        paths.append(bytes(path))
                        held += len(path)
                    if of != source:
                        of, head = source, bytearray()
                    at, own, rank = conv, rotation(conv), 0
                    path = bytearray() if not taker else head[:own * CODE]
                    if held > 1 << 23:
                        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(paths, pa.binary())], names=["conv_id", "path"])
                        ids, paths, held = [], [], 0
                if not taker or rank >= own:
                    before = path[-CODE:-CODE + NAME]
                    path += hashlib.md5(before + digest).digest() + size.to_bytes(8, "big")
                if not taker and rank < HEAD:
                    head = path[:]
                rank += 1
        if at is not None:
            ids.append(at)
            paths.append(bytes(path))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(paths, pa.binary())], names=["conv_id", "path"])

    return dealt.mapInArrow(run, "conv_id long, path binary")


def ends_of(paths: DataFrame) -> DataFrame:
    """One row for each distinct path: depth, smallest id, number of conversations and the digest of their ids."""
    dealt = paths.repartition("path").sortWithinPartitions("path", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, least, n, sha = None, 0, 0, None
        rows: list[tuple] = []
        made = lambda: pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, (pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.string()))],
            names=["path", "depth", "conv_id", "n_convs", "ends"])
        for batch in batches:
            for conv, path in zip(*(c.to_pylist() for c in batch.columns)):
                if path != at:
                    if at is not None:
                        rows.append((at, len(at) // CODE, least, n, sha.hexdigest()))
                    at, least, n, sha = path, conv, 1, hashlib.sha256(str(conv).encode())
                else:
                    n += 1
                    sha.update(b",%d" % conv)
            if rows:
                yield made()
                rows = []
        if at is not None:
            rows.append((at, len(at) // CODE, least, n, sha.hexdigest()))
        yield made()

    return dealt.mapInArrow(run, "path binary, depth int, conv_id long, n_convs long, ends string")


def steps(counts: dict[int, int], cells: int = CELLS) -> list[tuple[int, int]]:
    """(highest, lowest) depth of each step of the peeling, from the number of ends by depth. A step of several levels has at most ``cells`` rows."""
    out, depth, live = [], max(counts, default=-1), 0
    while depth >= 0:
        live += counts.get(depth, 0)
        top, rows = depth, live
        # The next level's rows are at most those that live now and the ends on it; an empty path has no key to meet below.
        while depth > 1 and rows + live + counts.get(depth - 1, 0) <= cells:
            depth -= 1
            live += counts.get(depth, 0)
            rows += live
        out.append((top, depth))
        depth -= 1
    return out


def _name(path: bytes, depth: int) -> bytes:
    return path[(depth - 1) * CODE:(depth - 1) * CODE + NAME] if depth else b""


def _merged(depth: int, low: int, parts: list[tuple]) -> tuple:
    """A node from what merges in it: (path, id, members, children, leaves, saved, ends). A path may go on below the node."""
    path, conv, n = parts[0][0], min(p[1] for p in parts), sum(p[2] for p in parts)
    children, leaves, saved = (sum(p[k] for p in parts) for k in (3, 4, 5))
    ends = next((p[6] for p in parts if p[6] is not None), None)
    size = int.from_bytes(path[depth * CODE - 8:depth * CODE], "big")
    kept = path[:depth * CODE] if depth == low else None
    return kept, _name(path, depth), _name(path, depth - 1), depth, conv, n, children, leaves or 1, saved + (n - 1) * size, ends


def _peel_together(rows: DataFrame, top: int, low: int) -> DataFrame:
    """Levels ``top`` to ``low``, of which none is the root, at once: all paths through one node of level ``low`` are in one task."""
    dealt = rows.withColumn("key", F.substring("path", (low - 1) * CODE + 1, NAME))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                waiting.setdefault(len(row["path"]) // CODE, []).append(
                    tuple(row[c] for c in ("path", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")))
        live: dict[bytes, list[tuple]] = {}
        for depth in range(top, low - 1, -1) if waiting else ():
            for part in waiting.pop(depth, ()):
                live.setdefault(_name(part[0], depth), []).append(part)
            nodes = [_merged(depth, low, parts) for parts in live.values()]
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*nodes), (
                    *[pa.binary()] * 3, pa.int32(), *[pa.int64()] * 5, pa.string()))], names=NODE)
            stripped: dict[bytes, list[tuple]] = {}
            for parts, (_, _, above, _, conv, n, _, leaves, saved, _) in zip(live.values(), nodes):
                stripped.setdefault(above, []).append((parts[0][0], conv, n, 1, leaves, saved, None))
            live = stripped

    return dealt.repartition("key").drop("key").mapInArrow(run, NODE_SCHEMA)


def _peel_level(rows: DataFrame, depth: int) -> DataFrame:
    """One level as a grouping: ``rows`` hold paths of ``depth`` turns."""
    size = F.conv(F.hex(F.substring("path", depth * CODE - 7, 8)), 16, 10).cast("long") if depth else F.lit(0).cast("long")
    name = lambda d: F.substring("path", (d - 1) * CODE + 1, NAME) if d > 0 else F.substring("path", 1, 0)
    total = lambda c: F.sum(c).alias(c)
    merged = rows.groupBy("path").agg(F.min("conv_id").alias("conv_id"), total("n_convs"), total("n_children"), total("n_leaves"), total("saved_tokens"), F.max("ends").alias("ends"))
    return merged.select(
        "path", name(depth).alias("own"), name(depth - 1).alias("above"), F.lit(depth).alias("depth"), "conv_id", "n_convs", "n_children", F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * size).alias("saved_tokens"), "ends")


def peel(ends: DataFrame, cells: int = CELLS) -> DataFrame:
    """All nodes of the trie of ``ends``."""
    spark = ends.sparkSession
    counts = {r[0]: r[1] for r in ends.groupBy("depth").count().collect()}
    plan = steps(counts, cells)
    if not plan:
        return spark.createDataFrame([], NODE_SCHEMA)
    # Each step reads its own ends and nothing else.
    of_step = F.coalesce(*[F.when(F.col("depth") >= low, k) for k, (_, low) in enumerate(plan)])
    by_step, nodes = new_path(spark, "ends"), new_path(spark, "nodes")
    ends.withColumn("step", of_step).write.partitionBy("step").parquet(by_step)
    schema = ends.schema.add("step", "integer")
    for k, (top, low) in enumerate(plan):
        own = spark.read.schema(schema).parquet(by_step).filter(F.col("step") == k)
        rows = own.select("path", "conv_id", "n_convs", *[F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")], "ends")
        if k:
            below = spark.read.schema(NODE_SCHEMA).parquet(f"{nodes}/step={k - 1}").filter(F.col("depth") == top + 1)
            rows = rows.unionByName(below.select(
                F.substring("path", 1, top * CODE).alias("path"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"),
                "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends")))
        found = _peel_level(rows, top) if top == low else _peel_together(rows, top, low)
        found.write.parquet(f"{nodes}/step={k}")
    return spark.read.schema(NODE_SCHEMA).parquet(nodes)


def with_parents(nodes: DataFrame, share: int = SHARE) -> DataFrame:
    """``nodes`` with their parents' ids; the root's is null."""
    named = nodes.drop("path")
    parents = named.filter("n_children > 0").select(
        F.col("own").alias("above"), F.col("conv_id").alias("parent_conv_id"), F.ceil(F.col("n_children") / share).cast("int").alias("shares"))
    several = settle(parents.filter("shares > 1").select("above", "shares"), "several")
    dealt = parents.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")
    children = (named.filter("depth > 0").join(several, "above", "left")
                .withColumn("share", F.pmod(F.xxhash64("own"), F.coalesce("shares", F.lit(1))).cast("int")).drop("shares"))
    root = named.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return children.join(dealt, ["above", "share"]).drop("share").unionByName(root).drop("own", "above")


def prefix_trie(conversations: DataFrame, cells: int = CELLS, share: int = SHARE) -> DataFrame:
    """The nodes of the trie: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends (digest of the ids that end there, or null)."""
    paths = rebuilt(conversations.select("conv_id", "turn", "role", "text"))
    return with_parents(peel(settle(ends_of(paths), "ends"), cells), share)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read(spark, sf_dir, "conversations")).select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"))


# Eight shifts of the polynomial make a table entry; ``cast`` of one digit after the other feeds it.
ORACLE = f"""
with recursive shifted(i, k, v) as (
    select i, 0, i from range(256) t(i)
    union all select i, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from shifted where k < 8),
entries as (select i, v from shifted where k = 8),
convs as (select distinct conv_id as c from conversations where conv_id is not null),
crc(c, k, v) as (
    select c, 0, 4294967295 from convs
    union all
    select c, k + 1, xor(crc.v >> 8, e.v) from crc join entries e on e.i = xor(crc.v & 255, ascii(substr(cast(c as varchar), k + 1, 1)))
    where k < length(cast(c as varchar))),
heads as (select c, xor(v, 4294967295) % 9 as h, c - c % 5 as source from crc where k = length(cast(c as varchar))),
ranked as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
           row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), md5(concat(length(coalesce(role, '')), ':', role, text))) - 1 as r
    from conversations where conv_id is not null),
turns as (
    select c, r, role, text from heads join ranked on conv_id = source and r < h
    union all select c, r, role, text from heads join ranked on conv_id = c and r >= h),
listed as (
    select c, list(concat(length(role), ':', length(text), ':', role, text) order by r) as p, list(cast(octet_length(encode(text)) as bigint) order by r) as b from turns group by c),
paths as (select c, coalesce(p, []) as p, coalesce(b, []) as b from convs left join listed using (c)),
prefixes as (select c, d, list_slice(p, 1, d) as p, case when d > 0 then b[d] else 0 end as b, d = len(p) as ended
             from (select c, p, b, unnest(range(0, len(p) + 1)) as d from paths) x),
nodes as (
    select p, d, min(c) as conv_id, count(*) as n_convs, any_value(b) as b,
           sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (ended), '')) as ends_sha256
    from prefixes group by p, d),
families as (select list_slice(p, 1, d - 1) as p, count(*) as n_children from nodes where d > 0 group by 1),
counted as (select n.*, coalesce(n_children, 0) as n_children from nodes n left join families f on f.p = n.p),
sums as (
    select a.p, count(*) filter (n_children = 0) as n_leaves, sum((n_convs - 1) * b) as saved_tokens
    from (select list_slice(p, 1, k) as p, n_convs, b, n_children from (select *, unnest(range(0, d + 1)) as k from counted) x) a group by 1)
select n.conv_id, n.d as depth, u.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves, cast(s.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from counted n join sums s on s.p = n.p left join nodes u on u.d = n.d - 1 and u.p = list_slice(n.p, 1, n.d - 1)
"""
