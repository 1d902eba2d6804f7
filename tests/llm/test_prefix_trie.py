import hashlib
import random
import zlib

import pytest

from tripmart.llm import prefix_trie as T


def brute(rows):
    """Nodes from a dict of prefixes, sums by walking every node's ancestors."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (*t[:3], hashlib.md5(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest()))
    full = {}
    for c in own:
        h = (zlib.crc32(str(c).encode()) & 0xFFFFFFFF) % 9
        source = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        full[c] = tuple(t[2:] for t in own.get(source, [])[:h] + own[c][h:])
    members, ended = {}, {}
    for c, path in full.items():
        ended.setdefault(path, []).append(c)
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children, leaves, saved = ({p: 0 for p in members} for _ in range(3))
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        gain = (len(m) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += gain
            leaves[p[:d]] += not children[p]
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(ended.get(p, [])))
        for p, m in members.items())


def trie(spark, rows, cells=T.CELLS, share=T.SHARE):
    frame = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    out = T.prefix_trie(frame, cells, share).na.fill(T.NOBODY, ["ends"])
    return sorted(tuple(r) for r in out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends").collect())


def planted(seed):
    """Shared starts, copies, a third with one first turn, a long conversation, gaps in the ids, and odd rows."""
    rng = random.Random(seed)
    rows, texts = [], ["", "a", "é ü", "x" * 50, "hello", "b\nc"]
    for c in [*range(0, 60), *range(71, 90, 3), -1, -5, -7, 10**12 + 3]:
        n = rng.choice([1, 2, 5, 9, 14])
        same = c % 3 == 0
        for k in range(n):
            rows.append((c, k, "user" if k % 2 == 0 else "assistant", "hello" if same and k < 3 else rng.choice(texts)))
    rows += [(33, 20 + k, "user", f"t{k % 7}") for k in range(300)]
    rows += [(34, 20 + k, "user", f"t{k % 7}") for k in range(290)]
    rows += [(35, None, None, "first"), (35, None, None, None), (35, 3, None, "tie"), (35, 3, "user", "tie"), (35, 3, "user", "eit")]
    rows += [(40, 0, "user", "again")] * 3
    rows += [(None, 0, "user", "nobody"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cells,share", [(T.CELLS, T.SHARE), (100, 2), (1, 1)])
def test_nodes_equal_brute_force(spark, cells, share):
    # With one cell every level is a step of its own, so that run has no long conversation.
    rows = [r for r in planted(1) if cells > 1 or r[1] is None or r[1] < 20]
    assert trie(spark, rows, cells, share) == brute(rows)


def test_edges(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "x")]) == []
    # Without turns of its own after those its source should have given, a conversation is a member of the root.
    alone = [(c, 0, "user", "x") for c in (1, 2, 3, 4)]
    assert trie(spark, alone) == brute(alone)
    long = [(5, 0, "user", "z" * 300_000), (6, 0, "user", "z" * 300_000), (5, 1, None, None)]
    assert trie(spark, long) == brute(long)


def test_steps_bound_their_rows():
    counts = {400: 1, 300: 2, 9: 40, 8: 500, 3: 6000, 1: 10}
    for cells in (1, 50, 1000, 10**6):
        plan = T.steps(counts, cells)
        assert [d for top, low in plan for d in range(top, low - 1, -1)] == list(range(400, -1, -1))
        for top, low in plan:
            rows = sum(sum(n for e, n in counts.items() if e >= d) for d in range(low, top + 1))
            assert top == low or rows <= cells
    assert T.steps({}) == []
    # A single conversation of a hundred thousand turns takes few steps.
    assert len(T.steps({100_000: 1})) < 20
