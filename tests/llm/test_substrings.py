import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tripmart.llm import substrings as ss


def brute(docs, window):
    best, where = {}, defaultdict(list)
    rows = [(doc_id, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for doc_id, t in docs]
    order = lambda i: ss.LAST if i is None else i
    for k, (i, w) in enumerate(rows):
        for s in range(len(w) - window + 1):
            seq = tuple(w[s:s + window])
            where[seq].append((order(i), s, k))
            best[seq] = min(best.get(seq, (order(i), s)), (order(i), s))
    gone = defaultdict(set)
    for seq, places in where.items():
        for i, s, k in places:
            if (i, s) != best[seq]:
                gone[k] |= set(range(s, s + window))
    return sorted(((i, len(w), len(gone[k]), " ".join(x for j, x in enumerate(w) if j not in gone[k])) for k, (i, w) in enumerate(rows)), key=str)


def sample():
    random.seed(9)
    word = lambda: random.choice(["a", "b", "Ç", "dd", "e"])
    shared = [" ".join(word() for _ in range(n)) for n in (6, 7, 12, 30)]
    docs = []
    for i in range(120):
        parts = [" ".join(str(random.randint(0, 999)) for _ in range(random.randint(0, 9))) if random.random() < .6 else random.choice(shared) for _ in range(random.randint(0, 6))]
        docs.append((i * 7 % 120, random.choice([" ", "\n", "  \t"]).join(parts)))
    docs += [(500, "x " * 400), (501, "x y " * 300), (502, None), (503, ""), (504, docs[3][1]), (504, docs[3][1]), (None, docs[5][1]), (None, "x " * 50)]
    return docs


def test_equal_to_brute_force_on_any_partitions(spark):
    docs = sample()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("grp", F.lit("clash"))
    for window, unit, parts in ((6, 500, 5), (7, 1 << 20, 1)):
        got = [tuple(r) for r in ss.remove_repeats(df.repartition(parts), window, unit).collect()]
        assert sorted(got, key=str) == brute(docs, window)


def test_empty_table(spark):
    assert ss.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_windows_around_hits():
    import numpy as np

    hit = np.zeros(11, bool)
    hit[4] = True  # blocks of 3 in 13 words
    assert ss.near_hits(hit, 6, 3, 13).tolist() == [1, 2, 3, 4]
