"""Best-fit packing of documents into sequences of several permitted lengths.

Lengths are counted in one pass; texts never move. A document longer than the longest sequence is cut into pieces, each
but the last of that length. Pieces are dealt to packing groups by a hash of id, text and place, so a hot source or many rows without an id spread evenly and the
number of groups grows with the pieces; a group holds about ``GROUP`` of them, few enough for one task and enough that only its
last sequences stay unfilled.

Within a group pieces go longest first. Each takes the open bin, of whatever size, that it leaves least room in. If none fits, a bin is opened, of the size
with the least cost for each token it can expect to hold. A bin costs its capacity, a fixed overhead, and what attention costs over its length; it can expect the piece
and what the longest pieces still to come that fit would fill of the rest. So the sizes compete for the pieces at hand: a size that these would
leave half empty loses, however cheap, and a long one must make up for its attention. In the end each bin shrinks to the least permitted
length that holds its contents.

Null and empty texts have only an end token and are packed like any other. Ties go by identity, repeated rows are packed each;
a null id is an identity like any other. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import narrow_batches, read, settle, size_tasks
from tripmart.llm.simhash import whole_groups

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 64  # what a sequence costs besides its tokens
ATTENTION = 1 << 14  # a sequence of this length costs as much again for its attention
GROUP = 20000  # pieces packed together
FIELDS = ("bin", "capacity", "offset")


def cost(capacity: int, overhead: int = OVERHEAD, attention: int = ATTENTION) -> float:
    """What a sequence costs, in tokens."""
    return capacity + overhead + capacity * capacity / attention


class Waiting:
    """How many pieces of each length are still to come."""

    def __init__(self, lengths: Sequence[int]):
        self.count = Counter(lengths)
        self.lengths = sorted(self.count)

    def remove(self, length: int) -> None:
        self.count[length] -= 1
        if not self.count[length]:
            del self.lengths[bisect_left(self.lengths, length)]

    def filled(self, room: int) -> int:
        """How much of ``room`` the pieces fill, the longest that fits first."""
        left, at = room, len(self.lengths)
        while left:
            at = bisect_right(self.lengths, left, 0, at) - 1
            if at < 0:
                break
            length = self.lengths[at]
            left -= length * min(self.count[length], left // length)
        return room - left


def least_cost(length: int, waiting: Waiting, capacities: Sequence[int], overhead: int, attention: int) -> int:
    """The permitted size, at least ``length``, that costs least for each token it can expect to hold."""
    fits = [c for c in capacities if c >= length]
    return min(fits, key=lambda c: (cost(c, overhead, attention) / (length + waiting.filled(c - length)), c))


def best_fit(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD, attention: int = ATTENTION) -> list[tuple[int, int, int]]:
    """(bin, capacity, offset) for each length, in the order given; lengths must not increase."""
    capacities = sorted(capacities)
    waiting, room, used, out = Waiting(lengths), [], [], []
    for length in lengths:
        waiting.remove(length)
        at = bisect_left(room, (length, -1))  # the open bin with the least room that is enough
        if at < len(room):
            left, number = room.pop(at)
        else:
            left, number = least_cost(length, waiting, capacities, overhead, attention), len(used)
            used.append(0)
        out.append((number, used[number]))
        used[number] += length
        if left > length:
            insort(room, (left - length, number))
    final = [capacities[bisect_left(capacities, n)] for n in used]
    return [(number, final[number], offset) for number, offset in out]


def pieces(docs: DataFrame, longest: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, salt, piece, first_token, length): documents cut at ``longest``; a token is a word or the end after the last one."""
    count = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1
    start = F.sequence(F.lit(0), F.floor((F.col("n") - 1) / longest).cast("int"))
    return (docs.select(F.col(doc_id).alias("id"), count.alias("n"), F.xxhash64(text).alias("salt"))
            .select("id", "n", "salt", F.explode(start).alias("piece"))
            .select("id", "salt", "piece", (F.col("piece") * longest).alias("first_token"),
                    F.least(F.col("n") - F.col("piece") * longest, F.lit(longest)).alias("length")))


def pack(docs: DataFrame, capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD, attention: int = ATTENTION, group: int = GROUP,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, piece, first_token, length, bin, capacity, offset) for every piece of ``docs``."""
    narrow_batches(docs.sparkSession, rows=20000)
    cut = settle(pieces(docs, max(capacities), doc_id, text), "pieces")
    groups = size_tasks(cut.count(), group)
    dealt = cut.withColumn("grp", F.pmod(F.xxhash64("id", "salt", "piece"), F.lit(groups)).cast("int"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (number,), rows in whole_groups(batches, ["grp"]):
            rows = rows.reset_index(drop=True)
            placed = pd.DataFrame(best_fit(rows["length"].tolist(), capacities, overhead, attention), columns=list(FIELDS))
            placed["bin"] = str(number) + "-" + placed["bin"].astype(str)
            yield pd.concat([rows.drop(columns=["grp", "salt"]), placed], axis=1)

    schema = cut.drop("salt").schema.add("bin", "string").add("capacity", "integer").add("offset", "integer")
    order = [F.col("grp"), F.col("length").desc(), F.col("id"), F.col("salt"), F.col("piece")]
    packed = dealt.repartition("grp").sortWithinPartitions(*order).mapInPandas(run, schema)
    return packed.withColumnRenamed("id", doc_id)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
