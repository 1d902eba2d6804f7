import random
from collections import defaultdict

from pyspark.sql import functions as F

from tripmart.llm import packing


NO_ATTENTION = 1 << 60


def test_best_fit_small_cases():
    fit = lambda lengths: packing.best_fit(lengths, (4, 8), 0, NO_ATTENTION)
    assert fit([]) == []
    assert fit([8]) == [(0, 8, 0)]
    assert fit([3]) == [(0, 4, 0)]  # shrinks to what it holds
    assert fit([5, 3]) == [(0, 8, 0), (0, 8, 5)]
    assert fit([6, 5, 3, 2]) == [(0, 8, 0), (1, 8, 0), (1, 8, 5), (0, 8, 6)]  # least room first
    assert fit([4, 3, 3, 2]) == [(0, 4, 0), (1, 8, 0), (1, 8, 3), (1, 8, 6)]  # a full small bin beats a large one with a hole, a full large one a small one with a hole


def brute(lengths, capacities, overhead, attention=packing.ATTENTION):
    """The same rule by searching all bins and all pieces still to come."""
    bins, out = [], []
    for i, n in enumerate(lengths):
        open_bins = [(b["left"], k) for k, b in enumerate(bins) if b["left"] >= n]
        if open_bins:
            k = min(open_bins)[1]
        else:
            def per_token(c):
                held = n
                for m in lengths[i + 1:]:
                    if held + m <= c:
                        held += m
                return (c + overhead + c * c / attention) / held

            c = min((c for c in capacities if c >= n), key=lambda c: (per_token(c), c))
            k = len(bins)
            bins.append({"left": c, "used": 0})
        out.append((k, bins[k]["used"]))
        bins[k]["left"] -= n
        bins[k]["used"] += n
    return [(k, min(c for c in capacities if c >= bins[k]["used"]), o) for k, o in out]


def test_equal_to_brute_force():
    random.seed(3)
    for _ in range(30):
        lengths = sorted((random.randint(1, 64) for _ in range(random.randint(1, 120))), reverse=True)
        for overhead, attention in ((4, 64), (0, NO_ATTENTION), (4, 500)):
            assert packing.best_fit(lengths, (16, 32, 64), overhead, attention) == brute(lengths, (16, 32, 64), overhead, attention)


def spent(lengths, capacities):
    """Cost of all bins, and the sizes that were opened for a hundredth of them at least."""
    sizes = dict((number, capacity) for number, capacity, _ in packing.best_fit(lengths, capacities))
    share = {c: sum(v == c for v in sizes.values()) / len(sizes) for c in set(sizes.values())}
    return sum(map(packing.cost, sizes.values())), {c for c, n in share.items() if n >= 0.01}


def test_sizes_are_chosen_jointly(spark):
    """Several sizes together cost less than the best of them alone, where each single size may shrink no bin and cuts what is longer."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lengths = sorted((r.length for r in packing.pieces(docs, 4096).collect()), reverse=True)
    joint, sizes = spent(lengths, packing.CAPACITIES)
    single = {}
    for c in packing.CAPACITIES:
        cut = sorted((min(c, n - at) for n in lengths for at in range(0, n, c)), reverse=True)
        single[c] = spent(cut, (c,))[0]
    # A size that cuts documents apart is cheaper for attention alone; 4096 keeps as many whole as the joint choice.
    assert len(sizes) >= 3 and joint < 0.95 * single[4096], (joint, single, sizes)


def test_every_token_once(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(None, None), (9001, ""), (9002, "w " * 9999), (9003, "a b"), (9003, "a b")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").union(extra)
    rows = packing.pack(docs, (64, 128, 256), 8, group=50).collect()
    total = sum(len((r.text or "").split()) + 1 for r in docs.collect())
    assert sum(r.length for r in rows) == total
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin].append(r)
    for group in bins.values():
        at = 0
        for r in sorted(group, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert len({r.capacity for r in group}) == 1
        assert group[0].capacity == min(c for c in (64, 128, 256) if c >= at)
    assert len(bins) > 1


def test_same_rows_from_other_partitions_and_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = lambda df: sorted(map(str, packing.pack(df, group=30).collect()))
    assert rows(docs) == rows(docs.withColumn("bin", F.lit(1)).repartition(7))
    assert packing.pack(docs.limit(0)).count() == 0
