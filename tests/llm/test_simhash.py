import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tripmart.llm import simhash


def brute_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + 4]) for i in range(max(len(w) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=4):
    values = sorted(set(prints))
    group = {v: v for v in values}

    def find(v):
        while group[v] != v:
            v = group[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                group[find(a)] = find(b)
    return {v: find(v) for v in values}


def texts(spark):
    rows = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(250).collect()]
    base = rows[:20]
    near = [t + " tail word" for t in base] + [t.replace(" ", "  ", 3).upper() for t in base]
    return rows + near + ["", None, " \t\n", "one", "One", "a b c", "É é", "é É", "x " * 50000, base[0], base[0]]


def test_components_equal_brute_force(spark, tmp_path):
    rows = list(enumerate(texts(spark)))
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in simhash.op7_simhash(spark, str(tmp_path)).collect()}
    prints = {i: brute_print(t) for i, t in rows}
    group = brute_components(prints.values())
    least = {}
    for i, p in prints.items():
        least[group[p]] = min(i, least.get(group[p], i))
    for i, p in prints.items():
        assert got[i].fingerprint == f"{p:016x}"
        assert got[i].component_id == least[group[p]]


def test_tree_finds_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (600, 3)).astype(np.uint64)).sum(axis=1, dtype=np.uint64)
    values = np.unique(base[rng.integers(0, 30, 600)] ^ flips)
    q, v = simhash.Tree(values).search(values, 4)
    want = {(i, j) for i, a in enumerate(values.tolist()) for j, b in enumerate(values.tolist()) if (a ^ b).bit_count() <= 4}
    assert set(zip(q.tolist(), v.tolist())) == want and len(q) == len(want)
    assert simhash.Tree(values[:0]).search(values, 4)[0].size == 0


@pytest.mark.parametrize("block", [7, 4096])
def test_split_shards_lose_no_link(spark, block):
    random.seed(2)
    values = {0, 2**64 - 1}
    for _ in range(6):
        v = random.getrandbits(64)
        for _ in range(25):
            values.add(v)
            v ^= (1 << random.randrange(64)) | (1 << random.randrange(64))
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    labels = {r.node % 2**64: r.label for r in simhash.components(simhash.links(df, 4, block)).collect()}
    want = brute_components(values)
    by = {}
    for v in values:
        by.setdefault(want[v], set()).add(labels.get(v, v - 2**64 if v >= 2**63 else v))
    assert all(len(s) == 1 for s in by.values()) and len(set.union(*by.values())) == len(by)


def test_clashing_names_and_empty_tables(spark):
    rows = [(3, "same text of five words here", "a"), (1, "same text of five words here", "b"), (1, "same text of five words here", "b"),
            (2, "quite another set of words stands here", "c"), (None, "no id", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string")
    out = simhash.near_copies(docs)
    assert out.columns == ["doc_id", "fp", "component"]
    assert sorted((r.doc_id or 0, r.component or 0) for r in out.collect()) == [(0, 0), (1, 1), (1, 1), (2, 2), (3, 1)]
    assert simhash.near_copies(docs.limit(0)).count() == 0
    assert simhash.near_copies(docs.filter("doc_id is null")).count() == 1


def test_pairs_do_not_depend_on_the_split(spark):
    """Fingerprints within and just beyond the radius, with differences at all places: shards of one to four pieces find the same groups."""
    import numpy as np

    rng = np.random.default_rng(9)
    prints = set()
    for _ in range(120):
        at = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(3):
            prints.add(at)
            for bit in rng.choice(64, rng.integers(1, 7), replace=False):
                at ^= 1 << int(bit)
    group = brute_components(prints)
    want = {p: min(q for q in prints if group[q] == group[p]) for p in prints}
    rows = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    for agree in (1, 2, 3, 4):
        labels = {r.node % (1 << 64): r.label for r in simhash.components(simhash.links(rows, agree=agree)).collect()}
        groups = {}
        for p in prints:
            groups.setdefault(labels.get(p, f"alone {p}"), set()).add(want[p])
        assert len(groups) == len(set(want.values())) and all(len(g) == 1 for g in groups.values())


def test_shards_stay_small():
    for count in (10, 10**6, 10**9, 10**11):
        agree = simhash.agreement(count, 4)
        assert count >> (agree * (64 // (4 + agree))) <= simhash.BLOCK
    assert [simhash.agreement(n, 4) for n in (10**6, 10**9, 10**11)] == [1, 2, 3]
    for agree in (1, 2, 5):
        cut = simhash.pieces(4, agree)
        assert len(cut) == 4 + agree and sum(n for _, n in cut) == 64 and all(a + n == b for (a, n), (b, _) in zip(cut, cut[1:]))


@pytest.mark.parametrize("block,agree", [(7, None), (4096, 1), (4096, 2)])
def test_smallest_neighbours_equal_brute_force(spark, block, agree):
    rng = random.Random(4)
    values = {0, 2**64 - 1}
    for _ in range(5):
        v = rng.getrandbits(64)
        for _ in range(30):
            values.add(v)
            v ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64)) | (1 << rng.randrange(64))
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    want = {}
    for a in signed:
        least = min(b for b in signed if ((a ^ b) % 2**64).bit_count() <= 6)
        if least < a:
            want[a] = least
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    assert {r.fp: r.least for r in simhash.neighbours(df, 6, block, agree).collect()} == want
    assert simhash.neighbours(df.limit(0), 6).count() == 0
