import itertools
import re

import numpy as np
from pyspark.sql import functions as F

from tripmart.llm import quality as q

GOOD = "This is a plain line of words that ends well.\nAnother line follows it and says some more.\nThe third closes the text."
BAD = "WORD!! WORD!! CRY!! CRY!! LOUD!! LOUD!! AGAIN!! AGAIN!! NOW!!\na*** b### c$$$ d%%% e&&& f*** g### h$$$ i%%%"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    spans = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = set()
    for i, s in enumerate(spans):
        if spans.count(s) > 1:
            covered |= set(range(i, i + 5))
    seen, copies = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


TEXTS = [None, "", " \n\t ", GOOD, BAD, "a b c d e " * 30, "x\nx\n\n\nx \n x\nx", "é ü  ß\x0b|<>|\r\n é", "one two three four five six one two three four five",
         " ".join(map(str, range(3000))) + " " + " ".join(map(str, range(3000))), GOOD + "\n" + GOOD, "w " * 5000]


def test_measures_equal_brute_force():
    for t in TEXTS:
        assert q.measure((t or "").encode()) == brute(t), t and t[:50]


def test_large_vocabularies_stay_exact(monkeypatch):
    rng = np.random.default_rng(5)
    words = [str(v).encode() for v in rng.integers(0, 40, 800)] + [str(v).encode() for v in range(70000)]
    few = q.repeated_words(words[:800])
    assert few == brute(b" ".join(words[:800]).decode())[4]
    assert q.repeated_words(words) >= few


def test_viterbi_equals_all_sequences():
    rng = np.random.default_rng(6)
    for _ in range(20):
        field = q.Field(rng.normal(size=len(q.FEATURES)), rng.normal(size=(2, 2)), rng.normal(size=2))
        x = rng.normal(size=(6, len(q.FEATURES)))

        def score(y):
            return field.first[y[0]] + sum(y[t] * (x[t] @ field.weights) for t in range(6)) + sum(field.move[a, b] for a, b in zip(y, y[1:]))
        best = max(itertools.product((0, 1), repeat=6), key=score)
        assert q.viterbi(field, x).tolist() == list(best)


def test_gradient_equals_differences():
    rng = np.random.default_rng(7)
    texts = [(rng.normal(size=(n, len(q.FEATURES))), rng.integers(0, 2, n)) for n in (1, 3, 4)]
    field = q.Field(rng.normal(size=len(q.FEATURES)), rng.normal(size=(2, 2)), rng.normal(size=2))

    def likelihood(f):
        def score(x, y):
            return f.first[y[0]] + sum(y[t] * (x[t] @ f.weights) for t in range(len(y))) + sum(f.move[a, b] for a, b in zip(y, y[1:]))
        return np.mean([score(x, y) - np.logaddexp.reduce([score(x, z) for z in itertools.product((0, 1), repeat=len(y))]) for x, y in texts])

    parts, step = (field.weights, field.move, field.first), 1e-6
    for i, g in enumerate(q.gradient(field, texts)):
        for at in np.ndindex(g.shape):
            moved = [p.copy() for p in parts]
            moved[i][at] += step
            assert abs((likelihood(q.Field(*moved)) - likelihood(field)) / step - g[at]) < 1e-4


def test_query_learns_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = q.op8_quality(spark, sf).join(labels, "doc_id").filter("not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert all(good) and sum(bad) <= 0.1 * len(bad) + 1


def test_edges(spark):
    docs = spark.createDataFrame([(1, GOOD, 5), (1, GOOD, 5), (None, BAD, 6), (2, None, None)], "doc_id long, text string, kept int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = q.keep_content(docs, none)
    assert out.columns == docs.columns and [(r.doc_id, r.kept) for r in out.collect()] == [(1, 5), (1, 5)]
    assert q.judge(docs.limit(0), q.prior()).count() == 0
