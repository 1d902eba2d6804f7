import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tripmart.llm import collocations as C


def brute(rows, least=C.LEAST, top=C.TOP):
    counts = defaultdict(Counter)
    for lang, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = tuple(re.findall("[^ \t]+", piece))
            for m in range(1, 5):
                counts["und" if lang is None else lang].update(w[i:i + m] for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longest[p[i:i + m]] = max(longest[p[i:i + m]], a)
        kept = []
        for p, a in candidates.items():
            if 100 * longest[p] >= 80 * a:
                continue
            score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def planted(seed):
    """Languages, common words and pairs, passages that repeat, pieces, capitals, odd spaces, and words beyond ASCII."""
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "big", "Apple", "é", "ü-x", "a b", "zz\x1cy", "ÀB"] + [f"w{k}" for k in range(40)]
    rows = []
    for k in range(300):
        lang = rng.choice(["en", "en", "en", "de", None, "und", ""])
        text = []
        for _ in range(rng.randrange(0, 60)):
            text.append(rng.choice([" ", "  ", "\t", " ", " ", ", ", "\n", ". ", "!?", "\x0b", "\r\n"]))
            text.append(rng.choice(["in the year of", "the cat", "hot pair " + rng.choice(words)]) if rng.random() < 0.3 else rng.choice(words))
        rows.append((lang, "".join(text)))
    rows += [("en", "passage one two three four five. ")] * 40 + [("en", None), (None, None), ("en", ""), ("en", " .,;\n"), ("fr", "x")]
    rows += [("de", "lang " * 5000), ("de", "aa bb " * 4000 + ". " + "cc dd ee " * 500)]
    return rows


def found(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "lang string, text string, n long, word string")
    return sorted(tuple(r) for r in C.collocations(docs, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


# Small chunks cut texts between all words, small buckets and a low limit of hot pairs deal pairs by their third word.
@pytest.mark.parametrize("more", [{}, {"chunk": 50, "block": 97, "bucket": 300, "hot": 20_000}, {"top": 7, "least": 12, "chunk": 1000}])
def test_phrases_equal_brute_force(spark, more):
    rows = planted(1)
    want = brute(rows, more.get("least", C.LEAST), more.get("top", C.TOP))
    assert len({r[0] for r in want}) >= 3 and found(spark, rows, **more) == want


def test_blocks_cut_between_words():
    words = [b"x" * 300, b"y", b"z" * 98, b"\n", b"w" * 97, b"\n", b"v"]
    text = b"  " + b"x" * 300 + b" y " + b"z" * 98 + b"." + b"w" * 97 + b"\nv"
    for size in (1, 2, 97, 98, 99, 10**6):
        assert [w for part in C.blocks(text, size) for w in part] == words
    assert list(C.blocks(b"", 5)) == []


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None), ("en", "one two three")]) == []


@pytest.mark.parametrize("seed", range(4))
def test_quicksort_counts(seed):
    rng = np.random.default_rng(seed)
    n = [0, 1, 500, 5000][seed]
    columns = [rng.zipf(1.5, n) % 20 + (k == 0) for k in range(4)]
    for k in range(1, 4):
        columns[k] = np.where(columns[k - 1] == 0, 0, columns[k])
    weight = rng.integers(1, 4, n)
    want = Counter()
    for row, w in zip(zip(*(c.tolist() for c in columns)), weight.tolist()):
        for m in range(1, 5):
            if 0 not in row[:m]:
                want[row[:m]] += w
    for least, known in ((30, 0), (30, 2), (1, 0)):
        at, length, count = C.frequent(columns, weight, least, known)
        got = {tuple(int(columns[k][a]) for k in range(m)): c for a, m, c in zip(at.tolist(), length.tolist(), count.tolist())}
        assert len(got) == len(at)
        assert got == {p: c for p, c in want.items() if len(p) > 1 and (c >= least or len(p) <= known)}


def test_scores_pass_64_bits(spark):
    big = 3 * 10**18
    codes = spark.createDataFrame([(1, 2, 0, 0, big)], "c0 long, c1 long, c2 long, c3 long, a long")
    words = spark.createDataFrame([(1, big + 1), (2, big + 2)], "code long, f long")
    assert [tuple(r) for r in C.scored(codes, words).select("l", "r", "score").collect()] == [(big + 1, big + 2, 999999)]
