import re

import pytest
from pyspark.sql import functions as F

from tripmart.llm import licenses as lic

RULES = lic.make_rules()


def labels(text):
    padded = b" " + b" ".join(text.encode().translate(lic.WORDS).split()) + b" "
    return [d[2] for d in lic.scan(padded, RULES)]


@pytest.mark.parametrize("text,want", [
    ("Licensed under the Apache License, Version 2.0.", ["apache-2.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["gpl-3.0"]),
    ("Released under the MIT License.", ["mit"]),
    ("Licensed under CC BY-NC 4.0.", ["cc-by-nc-4.0"]),
    ("SPDX-License-Identifier: GPL-2.0-or-later", ["gpl-2.0"]),
    ("GNU Lesser General Public License v2.1 and the BSD 3-Clause License", ["lgpl-2.1", "bsd-3-clause"]),
    ("see https://creativecommons.org/licenses/by-nc-sa/4.0/", ["cc-by-nc-sa"]),
    ("Mozilla Public License 2.0; Mozilla Public License 1.1", ["mpl-2.0", "mpl-1.1"]),
    ("he is in the apache tribe, a gnu, cc my boss", []),
    ("", []),
])
def test_labels(text, want):
    assert labels(text) == want


def test_rules_are_many_and_gated():
    assert len(RULES) > 200
    for rule in RULES:
        assert rule.keywords


def test_containment():
    # the longer place wins unless the inner one has the better priority
    assert lic.resolve([(0, 10, 2, 0), (2, 5, 2, 1), (2, 5, 1, 2), (0, 10, 2, 3)]) == [(0, 10, 2, 0), (2, 5, 1, 2)]
    assert lic.resolve([(0, 5, 1, 0), (3, 8, 1, 1)]) == [(0, 5, 1, 0), (3, 8, 1, 1)]


TEXTS = ["MIT License mit-license, the MIT\nLICENSE", None, "", "cc by cc by cc_by", "é apache license", "GNU  general public license " * 3,
         "xcc by", "w " * 40000 + "Apache License", "commit license mit licenses"]


def test_base_equals_plain_search(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)) + [(0, TEXTS[0])], "doc_id long, text string").withColumn("base", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    rows = lic.op10_licenses(spark, str(tmp_path)).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), TEXTS[r.doc_id] or ""))
        places = sorted((i, lab) for p, lab in lic.BASE.items() for n in [p.decode().split()] for i in range(len(w)) if w[i:i + len(n)] == n)
        starts = [p[0] for p in places]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        base = {p[1] for p in places}
        assert r.base_labels == ",".join(sorted(base)) and base <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_empty_table(spark):
    assert lic.find_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def examples(parsed):
    """Texts a parsed pattern matches: each alternative once, optional parts left out."""
    out = [""]
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            part = [chr(value)]
        elif name == "IN":
            part = [chr(value[0][1] if str(value[0][0]) == "LITERAL" else value[0][1][0])]
        elif name == "BRANCH":
            part = [t for branch in value[1] for t in examples(branch)]
        elif name == "SUBPATTERN":
            part = examples(value[-1])
        elif name == "MAX_REPEAT":
            part = [t * value[0] for t in examples(value[2])] if value[0] else [""]
        else:
            assert name == "ASSERT"
            part = [" "]
        out = [a + b for a in out for b in part]
    return out


def test_an_example_of_every_rule_passes_the_gate():
    for rule in lic.make_rules():
        for text in examples(re._parser.parse(rule.pattern.pattern.decode())):
            assert rule.pattern.search(text.encode())
            assert lic.scan(text.encode(), [rule]), text
    assert "mpl-2.0" in labels("https://mozilla.org/MPL/2.0/")


def test_detections_that_better_ones_contain_go():
    """The one pass over all detections equals comparing each with each."""
    import random

    rng = random.Random(4)
    for _ in range(300):
        found = list({(a, a + rng.randrange(1, 12), rng.randrange(4), rng.randrange(6)) for a in (rng.randrange(20) for _ in range(rng.randrange(12)))})
        better = lambda k, d: k != d and k[0] <= d[0] and d[1] <= k[1] and k[2] <= d[2] and ((k[0], k[1]) != (d[0], d[1]) or k[2:] < d[2:])
        assert lic.resolve(found) == sorted(d for d in found if not any(better(k, d) for k in found))


def test_megabytes_of_notices_take_seconds():
    import time

    rules, start = lic.make_rules(), time.perf_counter()
    padded = b" " + b"mit license apache license 2 0 " * 40_000
    assert len(lic.base_places(padded)) == 80_000
    found = lic.scan(padded, rules)
    assert len(found) == 80_000 and found[-1][1] == 240_000
    assert time.perf_counter() - start < 20
