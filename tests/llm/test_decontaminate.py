import hashlib
import re

from pyspark.sql import functions as F

from tripmart.llm import decontaminate as dc


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, size=13):
    out = []
    for doc_id, text in docs:
        w, hit, names = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(size, len(v))
            for s in range(max(len(v) - n, 0) + 1 if v else 0):
                for i in range(len(w) - n + 1):
                    if w[i:i + n] == v[s:s + n]:
                        hit |= set(range(i, i + n))
                        names |= {str(item_id)} - {"None"}
        out.append((doc_id, len(w), len(hit), len(names), ",".join(sorted(names)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


LONG = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen é15 sixteen"
ITEMS = [(1, LONG), (2, "short Item"), (10, "a a a a a a a a a a a a a a a"), (3, None), (4, "..."), (5, "one"), (None, "unnamed words here"), (2, "short item")]
DOCS = [
    (1, "x " + LONG.upper().replace("É", "é") + " y"), (2, "nothing " * 60 + "short-ITEM"), (3, "a " * 30), (4, None), (5, ""), (6, "one"),
    (7, LONG[:40]), (8, LONG.replace("ten", "10")), (8, LONG), (8, LONG), (None, "the short item"), (9, "unnamed, words here"),
    (11, "Shört item"), (12, LONG + " " + LONG), (13, LONG.replace("é", "É")),
]


def test_equal_to_plain_search(spark, tmp_path):
    spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("term", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("key", F.lit(0)).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = dc.op9_benchmark_passages(spark, str(tmp_path)).collect()
    want = [(a, b, c, d, hashlib.sha256(e.encode()).hexdigest(), f) for a, b, c, d, e, f in brute(DOCS, ITEMS)]
    assert sorted([tuple(r) for r in got], key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert dc.passages(docs.limit(0), items).count() == 0
    assert dc.passages(docs, items.limit(0)).first().n_hit == 0
    assert dc.clean(docs, items.limit(0)).count() == 1


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha big beta gamma"), (2, "beta far away and quite alpha gamma"), (3, "alpha beta gamma")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    near = {r.doc_id: r.n_items for r in dc.passages(docs, items, slop=1).collect()}
    exact = {r.doc_id: r.n_items for r in dc.passages(docs, items).collect()}
    assert near == {1: 1, 2: 0, 3: 1} and exact == {1: 0, 2: 0, 3: 1}


def test_clean_keeps_other_columns(spark):
    docs = spark.createDataFrame([(1, LONG, "s"), (2, "free", None)], "doc_id long, text string, items string")
    out = dc.clean(docs, spark.createDataFrame(ITEMS[:1], "item_id long, text string"))
    assert out.columns == ["doc_id", "text", "items"] and [r.doc_id for r in out.collect()] == [2]


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    plan = dc.passages(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
