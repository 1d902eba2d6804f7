import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline as cp
import test_decontaminate
import test_near_texts
import test_packing
import test_pii
import test_quality
from tripmart.llm import packing, pii, quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returned, as rows by id."""
    from tripmart.llm.common import settle

    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append({r.doc_id: r for r in docs.collect()})
    for _, stage in cp.STAGES[:-1]:
        docs = settle(stage(spark, docs, SF))
        assert docs.columns == list(cp.COLUMNS)
        out.append({r.doc_id: r for r in docs.collect()})
    return [*out, cp.STAGES[-1][1](spark, docs, SF).collect()]


def test_quality_keeps_what_the_labels_call_good(spark, stages):
    before, after = stages[0], stages[1]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for i, row in before.items():
        if test_quality.brute(row.text)[5]:
            assert i not in after
        elif labels.get(i) == 1:
            assert after[i] == row
    bad = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in bad) <= 0.1 * len(bad)


def test_one_of_each_group_stays(stages):
    before, after = stages[1], stages[2]
    kept = test_near_texts.brute([(i, r.text) for i, r in before.items()])
    assert len(kept) < len(before) and after == {i: before[i] for i in kept}


def test_contaminated_documents_go(spark, stages):
    before, after = stages[2], stages[3]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    # Without a common run of words there is nothing to compare word by word.
    thirteen = lambda t: {tuple(w[i:i + 13]) for w in [test_decontaminate.words(t)] for i in range(max(len(w) - 12, 1))}
    known = set().union(*(thirteen(t) for _, t in items))
    suspects = [(i, r.text) for i, r in before.items() if thirteen(r.text) & known]
    marked = {r[0] for r in test_decontaminate.brute(suspects, items) if r[5]}
    assert marked and after == {i: r for i, r in before.items() if i not in marked}


def test_personal_data_is_masked(stages):
    before, after = stages[3], stages[4]
    assert set(before) == set(after)
    for i, row in before.items():
        text = after[i].text
        assert after[i].n_chars == len(text)
        assert text == row.text or re.search(r"\[(%s)\]" % "|".join(k.name.upper() for k in pii.KINDS), text)
        found = test_pii.brute(row.text)
        assert bool(found) <= (text != row.text)
        for span in filter(None, found.split(",")):
            _, a, b = span.split(":")
            assert row.text[int(a):int(b)] not in text


def test_packing_holds_every_token(stages):
    before, rows = stages[4], stages[5]
    assert sum(r.length for r in rows) == sum(len(r.text.split()) + 1 for r in before.values())
    ordered = sorted(((r.length, r.doc_id, r.piece) for r in rows), key=lambda r: (-r[0], r[1], r[2]))
    want = test_packing.brute([r[0] for r in ordered], packing.CAPACITIES, packing.OVERHEAD)
    got = {(r.doc_id, r.piece): (int(r.bin.split("-")[1]), r.capacity, r.offset) for r in rows}
    assert [got[r[1], r[2]] for r in ordered] == want


def test_run_is_the_stages(spark, stages):
    assert sorted(map(str, cp.run(spark, SF).collect())) == sorted(map(str, stages[5]))
