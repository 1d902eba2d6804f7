import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tripmart.llm import language, mixing

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_base_equals_plain_counts(spark, tmp_path):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs += [(1001, None), (1002, ""), (1003, "É x é X"), (1003, "É x é X"), (None, "no id here")]
    spark.createDataFrame(docs, "doc_id long, text string").withColumn("grp", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    out = language.score(spark.read.parquet(f"{tmp_path}/documents.parquet"), unit=50_000).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    tokens = [(i, [*words(t), "\n"]) for i, t in docs]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted(((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in ws), 6)) for i, ws in tokens), key=str)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out), key=str) == want


def trained(texts):
    """Scores of other texts after learning from ``texts``, all in this process."""
    tables = np.zeros((mixing.TABLES, 2 * mixing.SLOTS), np.uint32)
    mixing.count(texts, tables)
    model = np.stack([mixing.stretched(t[0::2].astype(float), t[1::2].astype(float)) for t in tables])
    closed = lambda t: [*(w + b" " for w in t[:-1].split(b" ")[:-1]), t[:-1].split(b" ")[-1] + t[-1:]] if t else []
    seen = Counter(w for t in texts for w in closed(t))

    def score(others):
        names = {w: i for i, w in enumerate(sorted({*seen, *(w for t in others for w in closed(t))}))}
        words = mixing.Words(list(names))
        zeros, ones = words.counts(np.array([seen[w] for w in names], np.int64))
        tokens = np.array([names[w] for t in others for w in closed(t)], np.int64)
        return mixing.score(others, model, words, tokens, mixing.stretched(zeros, ones)[words.key_of])

    return score


def test_probabilities_of_all_next_bytes_sum_to_one():
    score = trained([b"the cat sat on the mat\n" * 3])
    start = b"the c"
    tails = [start + bytes([b]) for b in range(256)]
    total = sum(10 ** s for s in score(tails)) / 10 ** score([start])[0]
    assert abs(total - 1) < 1e-3


def test_score_does_not_depend_on_company():
    score = trained([b"some words to learn from\n"])
    texts = [b"some words\n", b"", b"other words to learn\n" * 900, b"x"]
    alone = [score([t])[0] for t in texts]
    assert np.allclose(score(texts), alone) and alone[1] == 0


def test_slots_of_words_equal_plain_counts():
    """The word so far: each decision's counts are those over all training words that begin alike."""
    words = sorted([b"the ", b"then ", b"the\n", b"\n", b"a ", b"\xc3\xa9t ", b"them ", b"tha ", b"then" * 2000 + b" "])
    number = np.array([5, 3, 2, 1, 0, 4, 7, 6, 2])
    held = mixing.Words(words)
    zeros, ones = (v[held.key_of] for v in held.counts(number))
    lengths, offsets, flat = mixing.code()
    path = lambda b: flat[offsets[b]:offsets[b] + lengths[b]].tolist()
    want = Counter()
    for w, k in zip(words, number.tolist()):
        for i, b in enumerate(w):
            for step in path(b):
                want[i, hash(w[:i]), step] += k
    for j, w in enumerate(words):
        each = lengths[np.frombuffer(w, np.uint8)]
        found = [held.inputs(np.array([j]), each, v).tolist() for v in (zeros, ones)]
        steps = [(i, hash(w[:i]), s) for i, b in enumerate(w) for s in path(b)]
        assert found == [[want[i, p, s & ~1] for i, p, s in steps], [want[i, p, s | 1] for i, p, s in steps]]


def test_numbers_come_back_from_planes():
    for kind, values in ((np.uint64, [0, 2 ** 63, 5]), (np.int16, [-7, 30000]), (np.int64, []), (np.uint32, [1])):
        assert language.opened(language.squeezed(np.array(values, kind)), kind).tolist() == values


def test_a_byte_keeps_level_and_odds():
    zeros, ones = np.meshgrid(np.arange(60), [0, 1, 2, 5, 40, 9000])
    full = mixing.stretched(zeros.ravel(), ones.ravel())
    back = mixing.from_bytes(mixing.as_bytes(full))
    assert ((back & 3) == (full & 3)).all() and abs(back.astype(int) - full).max() <= 0.13 * mixing.SCALE
    assert back[0] == full[0] == 0


def test_what_is_gathered_grows_with_the_corpus(spark):
    from tripmart.llm.substrings import packed

    def slots(texts):
        docs = spark.createDataFrame([(0, i, t.encode()) for i, t in enumerate(texts)], "grp int, id long, body binary")
        rows = language.asked_counts(packed(docs), 3, 40).filter("kind = 1").collect()
        return sum(len(language.opened(r["keys"], np.uint64)) for r in rows)

    texts = [" ".join(f"w{i * 37 % 9973}x{j}" for j in range(20)) for i in range(400)]
    assert slots(texts) > 1.5 * slots(texts[:200]) > 0


def test_groups_send_edges_not_decisions(spark):
    """A byte after a word so far is one entry, though it takes several decisions: less travels than two thirds of the text."""
    from tripmart.llm.substrings import packed

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text is not null")
    rows = docs.select(F.lit(0).alias("grp"), F.col("doc_id").alias("id"), F.col("text").cast("binary").alias("body"))
    text = rows.agg(F.sum(F.length("body"))).first()[0]
    sent = sum(len(v) for r in language.asked_counts(packed(rows), 3, 24).collect() for v in r if isinstance(v, (bytes, bytearray)))
    assert 0 < sent < text * 2 / 3


def test_odds_of_what_was_decided_turn_back():
    values, bit = np.meshgrid(np.arange(252, dtype=np.uint8), np.array([0, 1], np.uint8))
    turned = mixing.turned(values, bit)
    assert (mixing.turned(turned, bit) == values).all() and (turned & 3 == values & 3).all()
    zeros, ones = np.meshgrid(np.arange(60), [0, 1, 2, 5, 40, 9000])
    there, back = (mixing.as_bytes(mixing.stretched(*both)) for both in ((zeros, ones), (ones, zeros)))
    assert (mixing.turned(there, np.zeros_like(there)) == back).all()


def test_each_byte_has_its_own_path():
    lengths, offsets, flat = mixing.code()
    paths = [tuple(flat[o:o + n].tolist()) for o, n in zip(offsets.tolist(), lengths.tolist())]
    assert len(set(paths)) == 256 and abs(sum(2.0 ** -len(p) for p in paths) - 1) < 1e-9


def corpus_code(texts):
    return mixing.learned_code(mixing.count_pairs(texts).reshape(256, 256))


def test_learned_paths_are_whole_and_shorter():
    text = b"the cat sat on the mat and the rat sat on the cat\n" * 40
    learned, fixed = corpus_code([text]), mixing.code()
    sums = np.bincount(np.arange(1 << 16) >> 8, 2.0 ** -learned[0])
    assert np.allclose(sums, 1)
    for before in (ord("a"), ord("h"), 7):
        paths = {tuple(learned[2][o:o + n].tolist()) for o, n in zip(learned[1][256 * before:][:256].tolist(), learned[0][256 * before:][:256].tolist())}
        assert len(paths) == 256
    body = np.frombuffer(text, np.uint8)
    each = [mixing.steps(mixing.preceding([text], body), body, of)[0].sum() for of in (learned, fixed)]
    assert each[0] < 0.6 * each[1]


def test_probabilities_sum_to_one_under_a_learned_code():
    texts = [b"the cat sat on the mat\n" * 3]
    of = corpus_code(texts)
    tables = np.zeros((mixing.TABLES, 2 * mixing.SLOTS), np.uint32)
    mixing.count(texts, tables, of)
    model = np.stack([mixing.stretched(t[0::2].astype(float), t[1::2].astype(float)) for t in tables])

    def scores(others):
        names = {w: i for i, w in enumerate(sorted({b"the ", *(t[4:] for t in others)}))}
        words = mixing.Words(list(names), 48, of)
        zeros, ones = words.counts(np.ones(len(names), np.int64))
        tokens = np.array([names[w] for t in others for w in (t[:4], t[4:])], np.int64)
        return mixing.score(others, model, words, tokens, mixing.stretched(zeros, ones)[words.key_of])

    tails = [b"the c" + bytes([b]) for b in range(256)]
    total = sum(10 ** s for s in scores([*tails, b"the c"])[:-1]) / 10 ** scores([*tails, b"the c"])[-1]
    assert abs(total - 1) < 1e-3


def test_tables_equal_plain_counts():
    texts = [b"aab aab aac\n" * 5, b"", b"\n", b"aab\x00\xff\n"]
    for of in (None, corpus_code(texts)):
        tables = np.zeros((mixing.TABLES, 2 * mixing.SLOTS), np.uint32)
        mixing.count(texts, tables, of)
        lengths, offsets, flat = of or mixing.code()
        want = [Counter() for _ in tables]
        slots = [iter(s.tolist()) for s in mixing.contexts(texts)]
        for t in texts:
            for i, b in enumerate(t):
                place = b if of is None else 256 * (t[i - 1] if i else 32) + b
                for k, s in enumerate(map(next, slots)):
                    want[k].update((2 * s) ^ int(x) for x in flat[offsets[place]:offsets[place] + lengths[place]])
        for table, counts in zip(tables, want):
            assert {int(i): int(table[i]) for i in np.flatnonzero(table)} == counts


def test_learning_helps_on_held_out_documents(spark):
    rows = [r for r in language.op2_language_model(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    untrained = trained([])([b"these are plain words of a text\n"])[0]
    assert -untrained * np.log2(10) / 32 > 4  # about the length of the paths
    mean = np.average([r.bits_per_byte for r in rows], weights=[r.n_tokens for r in rows])
    assert mean < 3
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    again = {r.doc_id: r.score for r in language.score(docs.repartition(7)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-6 for r in rows)


def test_empty_table(spark):
    assert language.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
