import random

import numpy as np
import pytest

import corpus_pipeline as cp
from tripmart.llm import near_texts


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))}


def brute(rows):
    """The smallest id of each component of pairs with Jaccard similarity 0.8 at least."""
    sets = {i: shingles(t) for i, t in rows}
    group = {i: i for i in sets}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                group[max(x, y)] = min(x, y)
    return {i for i in sets if find(i) == i}


def planted():
    """Copies of random texts at all similarities from about 0.5 to 1, chains of copies, and a text shared as boilerplate."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for k in range(40):
        base = [word() for _ in range(rng.randrange(60, 400))]
        texts.append(" ".join(base))
        for _ in range(3):
            copy = base[:]
            for _ in range(rng.randrange(0, 1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
            base = copy if k % 2 else base
    shared = [word() for _ in range(150)]
    texts += [" ".join(shared + [word() for _ in range(rng.randrange(20, 90))]) for _ in range(60)]
    texts += ["", None, " \n", "one two", "One  two", "one three", texts[0].upper()]
    rng.shuffle(texts)
    return list(enumerate(texts))


# A small block cuts the keys into several tasks.
@pytest.mark.parametrize("block", [900, near_texts.BLOCK])
def test_groups_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(near_texts, "SHARE", 3 if block == 900 else near_texts.SHARE)
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in near_texts.one_of_each(docs, block).collect()) == sorted(brute(rows))


def test_stage_finds_copies_of_eight_tenths(spark):
    rng = random.Random(5)
    rows, at = [], 0
    for _ in range(30):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        copy = words[:]
        for place in (10, 60, 110, 160):  # 20 of 196 shingles differ: 176 / 216 = 0.81
            copy[place] = f"new{rng.randrange(5000)}"
        rows += [(at, " ".join(words), "en", "s", 0), (at + 1, " ".join(copy), "en", "s", 0)]
        at += 2
    rows += [(None, rows[0][1], "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = cp.near_copies(spark, docs, "")
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in out.collect()) == [-1, *range(0, 60, 2)]
    assert near_texts.one_of_each(docs.limit(0)).count() == 0


def counted(monkeypatch):
    """The pairs that the stars compare, the rows of the prefixes, and the links that leave the families, per call."""
    seen = {"pairs": [], "entries": [], "links": []}
    compare, meet, join = near_texts.confirmed, near_texts.families, near_texts.within

    def confirmed(pairs, sets):
        pairs = near_texts.settle(pairs, "pairs")
        seen["pairs"].append(pairs.count())
        return compare(pairs, sets)

    def families(entries):
        seen["entries"].append(entries.count())
        return meet(entries)

    def within(member, sets, block=near_texts.BLOCK):
        found = join(member, sets, block)
        seen["links"].append(found.count())
        return found

    for name, instead in (("confirmed", confirmed), ("families", families), ("within", within)):
        monkeypatch.setattr(near_texts, name, instead)
    return seen


def family(rng, n, share, size=200):
    """Texts that share words of one base, each with a run of its own words: pairwise similarity about share / (2 - share)."""
    base = [f"b{rng.randrange(10**6)}" for _ in range(size)]
    out = []
    for k in range(n):
        words = base[:]
        own = int(size * (1 - share))
        at = rng.randrange(size - own)
        words[at:at + own] = [f"o{k}x{i}" for i in range(own)]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("share,linked", [(0.8, False), (0.86, False), (0.95, True)])
def test_rows_grow_with_texts_not_pairs(spark, monkeypatch, share, linked):
    """Families below, around and above 0.8: neither the stars nor the families send pairs of their texts."""
    texts = family(random.Random(11), 400, share)
    rows = list(enumerate(texts))
    seen = counted(monkeypatch)
    kept = sorted(r.doc_id for r in near_texts.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept == sorted(brute(rows))
    assert (len(kept) < 100) == linked
    assert sum(seen["pairs"]) <= 2 * len(rows) and sum(seen["links"]) <= len(rows), seen
    assert sum(seen["entries"]) <= 45 * len(rows), seen


@pytest.mark.parametrize("dense", [3, near_texts.DENSE])
def test_overlaps_equal_brute_force(dense, monkeypatch):
    monkeypatch.setattr(near_texts, "DENSE", dense)
    rng = np.random.default_rng(3)
    for n, m, words in ((0, 3, 10), (1, 1, 5), (40, 30, 60), (30, 40, 3000), (20, 20, 400)):
        draw = lambda: np.unique(rng.zipf(1.3, rng.integers(0, 60)) % words).astype(np.uint64)
        left, right = [draw() for _ in range(n)], [draw() for _ in range(m)]
        want = [[len(set(a.tolist()) & set(b.tolist())) for b in right] for a in left]
        assert near_texts.overlaps(left, right).tolist() == want


def test_hundred_copies_of_many_texts(spark):
    """Groups of copies, chains of copies that only neighbours link, and texts between two groups."""
    rng = random.Random(12)
    texts = []
    for _ in range(4):
        words = [f"c{rng.randrange(10**6)}" for _ in range(150)]
        for k in range(25):
            texts.append(" ".join(words))
            words = words[:]
            words[rng.randrange(150)] = f"n{rng.randrange(10**6)}"
        left, right = texts[-1].split(), [f"d{rng.randrange(10**6)}" for _ in range(150)]
        texts.append(" ".join(left[:75] + right[75:]))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    out = near_texts.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), 5000)
    assert sorted(r.doc_id for r in out.collect()) == sorted(brute(rows))


def test_texts_that_share_an_id_stay(spark):
    rng = random.Random(13)
    text = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(80))
    a, b, c, long = text(), text(), text(), " ".join(f"l{rng.randrange(10**5)}" for _ in range(60_000))
    rows = [(1, a, "x"), (2, b, "x"), (2, c, "x"), (2, c, "x"), (3, b, "y"), (4, long, "x"), (5, long + " end", "y"), (6, "", "x"), (6, None, "x"), (None, a, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, name string")
    out = near_texts.one_of_each(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id if r.doc_id is not None else -1, (r.text or "")[:50]) for r in out.collect()))
    assert got == sorted([(1, a[:50]), (2, b[:50]), (2, c[:50]), (4, long[:50]), (6, ""), (-1, a[:50])])


def test_trees_propose_what_is_compared(spark, monkeypatch):
    """Without minhash keys the fingerprints in the trees find the copies within the radius, and nothing that is not similar."""
    monkeypatch.setattr(near_texts, "band_keys", lambda least: np.arange(near_texts.BANDS) + 1000 * (hash(least.tobytes()) % 10**12))
    rng = random.Random(21)
    texts = []
    for _ in range(20):
        words = [f"t{rng.randrange(10**6)}" for _ in range(400)]
        texts += [" ".join(words), " ".join([*words, "one", "more"]), " ".join(words[1:])]
    rows = list(enumerate(texts))
    prints = [near_texts.majority(near_texts.shingles(t.encode())) for t in texts]
    # Links of the trees alone: each print with the smallest one, as signed numbers, within the radius.
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    group = list(range(len(texts)))
    for i, p in enumerate(prints):
        least = min((q for q in range(len(prints)) if (p ^ prints[q]).bit_count() <= near_texts.RADIUS), key=signed.__getitem__)
        a, b = group[i], group[least]
        group = [min(a, b) if g in (a, b) else g for g in group]
    assert len(set(group)) < len(texts)
    out = near_texts.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(group))
