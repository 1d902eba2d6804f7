"""The arithmetic of the language model: hashed-context bit predictors, gated online mixing, an adaptive refinement.

A text is its lower-cased words joined by one space and closed by a newline, as bytes. A byte is a few binary decisions, the path to it
in a prefix code, in which bytes that often follow the byte before are short. For each decision three contexts (the three bytes before, the five bytes before,
the word so far) name a slot; its pair of counts gives a stretched probability. The first two lie in hashed tables, the nodes of a byte close
together; the third is one slot for each beginning of a word of the corpus, however many there are. The weighted sum of the three is squashed;
the weights belong to a gate, that is how well the longer two contexts are known. A text starts with fixed weights, and after each block
of decisions the weights of each gate follow the error. The refinement maps the mixed probability to what happened at that level and gate
so far in the text, and both are averaged.
"""

from __future__ import annotations

import heapq
from collections import deque
from functools import cache, cached_property

import numpy as np

SLOT_BITS = 22
SLOTS = 1 << SLOT_BITS
TABLES = 2  # contexts that lie in tables of slots
CONTEXTS = 3
LEVELS = 4  # 0 to 3: how often a slot was seen
GATES = LEVELS * LEVELS
STEPS = 24  # levels of the refinement
FIRST_BLOCK, LAST_BLOCK = 1408, 11264  # some 430 to 3400 bytes
PRIOR, LIMIT, SCALE = 0.4, 7.5, 2048  # log-odds times SCALE; the last two bits are the level
START = (0.5, 0.7, 0.2)
RATE, TRUST = 2.5e-7, 60.0
U32, U64 = np.uint32, np.uint64
FAST = "wrap"  # all indices are in range; this mode of take is the quick one
# Bytes of running text from frequent to rare; all others follow by number.
FREQUENT = b" etnaoishrdluecgmpfbwy.v,\xc3qk\n\xa9|!*#$%&jxz-'\":;?()0123456789"
R = 0x9E3779B97F4A7C15


Code = tuple[np.ndarray, np.ndarray, np.ndarray]  # length of each byte's path, where it begins in the flat list, the flat list of 2 * node + bit


def paths(weights: list[float]) -> list[list[int]]:
    """The path to each byte in a prefix code in which heavy bytes are short."""
    heap: list[tuple[float, int, object]] = [(w, b, b) for b, w in enumerate(weights)]
    heapq.heapify(heap)
    number = 256
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (a[0] + b[0], number, (a[2], b[2])))
        number += 1
    out: list[list[int]] = [[]] * 256
    count, todo = 0, deque([(heap[0][2], [])])
    while todo:  # level by level: the nodes of frequent bytes have low numbers
        tree, path = todo.popleft()
        if isinstance(tree, tuple):
            node, count = count, count + 1
            todo += [(side, [*path, 2 * node + bit]) for bit, side in enumerate(tree)]
        else:
            out[tree] = path
    return out


def laid_out(each: list[list[int]]) -> Code:
    lengths = np.fromiter(map(len, each), np.int64, len(each))
    return lengths, np.cumsum(lengths) - lengths, np.array([x for path in each for x in path], np.uint16)


@cache
def code() -> Code:
    """The code of a byte when nothing is known of the corpus."""
    rank = {b: r for r, b in enumerate(dict.fromkeys([*FREQUENT, *range(256)]))}
    return laid_out(paths([1 / (rank[b] + 20) ** 4 for b in range(256)]))


def learned_code(pairs: np.ndarray) -> Code:
    """A code for each byte before, by the times (256 x 256) a byte followed it: most bytes take fewer decisions. Place 256 * byte before + byte."""
    plain = paths_of(code())
    unseen = [2.0 ** -len(p) for p in plain]
    return laid_out([p for row in pairs.tolist() for p in (paths([n + u for n, u in zip(row, unseen)]) if any(row) else plain)])


def paths_of(of: Code) -> list[list[int]]:
    lengths, offsets, flat = of
    return [flat[a:a + n].tolist() for n, a in zip(lengths.tolist(), offsets.tolist())]


@cache
def powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of R and of its inverse modulo 2^64."""
    both = []
    for base in (R, pow(R, -1, 1 << 64)):
        p = np.full(1 << bits, base, U64)
        p[0] = 1
        both.append(np.multiply.accumulate(p))
    return both[0], both[1]


def normal(text: bytes) -> list[bytes]:
    return text.lower().split()


def preceding(texts: list[bytes], body: np.ndarray) -> np.ndarray:
    """The byte before each byte of the texts one after another; a space before the first of each."""
    out = np.full(len(body), ord(" "), np.uint8)
    out[1:] = body[:-1]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out[(np.cumsum(sizes) - sizes)[sizes > 0]] = ord(" ")
    return out


def steps(before: np.ndarray, body: np.ndarray, of: Code | None) -> tuple[np.ndarray, np.ndarray]:
    """(decisions of each byte, 2 * node + bit of each decision); ``before``: the byte before each."""
    lengths, offsets, flat = of or code()
    place = body if len(lengths) == 256 else before.astype(np.uint16) << np.uint16(8) | body
    each = lengths.take(place, mode=FAST)
    return each, flat.take(spread(offsets.take(place, mode=FAST), each), mode=FAST)


def count_pairs(texts: list[bytes]) -> np.ndarray:
    body = np.frombuffer(b"".join(texts), np.uint8)
    return np.bincount(preceding(texts, body).astype(np.int64) << 8 | body, minlength=1 << 16)


def spread(first: np.ndarray, each: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``first`` and have ``each`` places, one run after another."""
    out = np.repeat(first - np.cumsum(each) + each, each)
    out += np.arange(len(out))
    return out


def contexts(texts: list[bytes]) -> list[np.ndarray]:
    """For each table the slot of every byte of the texts, by the bytes before it; a text starts after zeros."""
    gap = bytes(5)
    body = np.frombuffer(b"".join(x for t in texts for x in (gap, t)), np.uint8).astype(U32)
    before = lambda k: body[5 - k:len(body) - k]
    three, five = before(1) | before(2) << U32(8) | before(3) << U32(16), before(1) * U32(pow(R, 1, 1 << 32))
    for k in range(2, 6):
        five += before(k) * U32(pow(R, k, 1 << 32))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 5) - 5
    out = []
    for x in (three * U32(0x9E3779B1), five):
        x ^= x >> U32(15)
        x *= U32(0x85EBCA77)
        x ^= x >> U32(13)
        x *= U32(0xC2B2AE35)
        x >>= U32(32 - SLOT_BITS)
        out.append(np.concatenate([np.zeros(0, np.int64), *[x[b - n:b] for n, b in zip(sizes.tolist(), ends.tolist())]], dtype=np.int64))
    return out


def count(texts: list[bytes], tables: np.ndarray, of: Code | None = None) -> None:
    """Add the decisions of ``texts`` to ``tables`` (tables x 2 * slots)."""
    if not any(texts):
        return
    body = np.frombuffer(b"".join(texts), np.uint8)
    pair = preceding(texts, body).astype(U64) << U64(8) | body
    for k, slot in enumerate(contexts(texts)):
        # Bytes in the same slot go together, so that their decisions are counted once.
        key = slot.view(U64) << U64(16)
        key |= pair
        key.sort()
        first = np.flatnonzero(np.concatenate([np.ones(1, bool), key[1:] != key[:-1]]))
        times, key = np.diff(first, append=len(key)), key[first]
        each, step = steps((key >> U64(8)).astype(np.uint8), key.astype(np.uint8), of)
        at = np.repeat((key >> U64(16)).view(np.int64) * 2, each)
        at ^= step  # a byte's nodes share a few cache lines
        np.add.at(tables[k], at, np.repeat(times.astype(tables.dtype), each))


def ascending(keys: np.ndarray, bits: int) -> np.ndarray:
    """An order in which ``keys``, below 2 to the ``bits``, ascend."""
    places = len(keys).bit_length()
    if bits + places > 64:
        return np.argsort(keys)
    both = keys << U64(places)
    both |= np.arange(len(keys), dtype=U64)
    both.sort()
    both &= U64((1 << places) - 1)
    return both.view(np.int64)


class Edges:
    """Distinct pairs of a word so far, named by a hash and below it its last byte (a space before a word), and the byte after it, ascending, and the
    decisions on the way to each such byte.

    ``key_of``: for each decision the number of its slot, that is of its (word so far, node).
    """

    def __init__(self, prefixes: np.ndarray, after: np.ndarray, of: Code | None = None):
        self.prefixes, self.after, self.of = prefixes, after, of

    @cached_property
    def steps(self) -> tuple[np.ndarray, np.ndarray]:
        return steps((self.prefixes & U64(255)).astype(np.uint8), self.after, self.of)

    each = property(lambda self: self.steps[0])
    step = property(lambda self: self.steps[1])

    @cached_property
    def first(self) -> np.ndarray:
        return np.cumsum(self.each) - self.each

    @cached_property
    def bit(self) -> np.ndarray:
        return (self.step & np.uint16(1)).astype(np.uint8)

    @cached_property
    def key_of(self) -> np.ndarray:
        new = self.prefixes[1:] != self.prefixes[:-1]
        key = np.repeat(np.concatenate([np.zeros(min(1, len(self.after)), U64), np.cumsum(new, dtype=U64)]), self.each)
        key <<= U64(8)
        key |= self.step >> np.uint16(1)
        order = ascending(key, (len(self.after) << 8).bit_length())
        key = key.take(order, mode=FAST)
        out = np.empty(len(key), np.int32)
        out[order] = np.cumsum(np.concatenate([np.zeros(min(1, len(key)), bool), key[1:] != key[:-1]]))
        return out

    def sums(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Zeros and ones of each slot when edge ``i`` is passed ``number[i]`` times."""
        slots = int(self.key_of.max()) + 1 if len(self.key_of) else 0
        both = np.bincount(2 * self.key_of.astype(np.int64) + self.bit, np.repeat(number.astype(np.float64), self.each), 2 * slots)
        return both[0::2], both[1::2]


class Words:
    """Distinct words, ascending, each with the byte that closes it, and their edges.

    ``asked`` has the edges by hash. For the scores they are numbered as the words bring them, so that those of a word lie together; ``to`` leads from
    there to ``asked``, ``place`` does so for decisions, and ``key_of`` is the slot of each decision.
    """

    def __init__(self, words: list[bytes], key_bits: int = 48, of: Code | None = None):
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.begin = np.cumsum(self.sizes) - self.sizes
        body = np.frombuffer(b"".join(words), np.uint8)
        place = np.arange(len(body)) - np.repeat(self.begin, self.sizes)
        # The first word that has a beginning holds it for all others.
        new = place >= np.repeat(self.shared(body), self.sizes)
        first = np.flatnonzero(new)
        key = self.hashes(body).take(first, mode=FAST)
        key ^= key >> U64(32)
        key *= U64(R)
        key >>= U64(64 - key_bits)
        key <<= U64(16)
        key |= preceding(words, body).take(first, mode=FAST).astype(U64) << U64(8) | body.take(first, mode=FAST)
        order = ascending(key, key_bits + 16)
        key = key.take(order, mode=FAST)
        distinct = np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]])
        self.to = np.empty(len(key), np.int64)
        self.to[order] = np.cumsum(distinct) - 1
        key = key[distinct]
        self.asked = Edges(key >> U64(8), (key & U64(255)).astype(np.uint8), of)
        # Words that begin alike stand together, so at each place the new beginnings number all.
        order = np.argsort(place.astype(np.uint16) if len(words) and self.sizes.max() < 1 << 16 else place, kind="stable")
        fresh = new.take(order, mode=FAST)
        self.edge = np.empty(len(body), np.int32)
        self.edge[order] = (np.cumsum(new) - 1).take(order[fresh], mode=FAST).take(np.cumsum(fresh) - 1, mode=FAST)

    @cached_property
    def each(self) -> np.ndarray:
        return self.asked.each.take(self.to, mode=FAST)

    @cached_property
    def first(self) -> np.ndarray:
        return np.cumsum(self.each) - self.each

    @cached_property
    def place(self) -> np.ndarray:
        return spread(self.asked.first.take(self.to, mode=FAST), self.each)

    @cached_property
    def step(self) -> np.ndarray:
        return self.asked.step.take(self.place, mode=FAST)

    @property
    def key_of(self) -> np.ndarray:
        return self.asked.key_of.take(self.place, mode=FAST)

    def shared(self, body: np.ndarray) -> np.ndarray:
        """How many bytes each word shares with the one before."""
        shared = np.zeros(len(self.sizes), np.int64)
        alike, n = np.arange(1, len(self.sizes)), 0
        while len(alike):
            alike = alike[(self.sizes[alike] > n) & (self.sizes[alike - 1] > n)]
            alike = alike[body[self.begin[alike] + n] == body[self.begin[alike - 1] + n]]
            n += 1
            shared[alike] = n
        return shared

    def hashes(self, body: np.ndarray) -> np.ndarray:
        """For each byte a hash of the word before it: differences of prefix sums, moved to the same power, in parts of bounded length."""
        out, at = np.empty(len(body), U64), 0
        while at < len(self.sizes):
            upto = max(at + 1, int(np.searchsorted(self.begin, self.begin[at] + (1 << 18))))
            low = int(self.begin[at])
            part = body[low:int(self.begin[upto - 1] + self.sizes[upto - 1])]
            up, down = powers(max(16, (len(part) + 1).bit_length()))
            total = np.concatenate([np.zeros(1, U64), np.cumsum((part.astype(U64) + U64(1)) * up[:len(part)])])
            start = np.repeat(self.begin[at:upto] - low, self.sizes[at:upto])
            h = (total[:-1] - total[start]) * down[start]
            h ^= h >> U64(31)
            h *= U64(0x9FB21C651E98DF25)
            out[low:low + len(part)] = h ^ (h >> U64(28))
            at = upto
        return out

    def passed(self, number: np.ndarray) -> np.ndarray:
        """How often each edge of ``asked`` is passed when word ``i`` stands ``number[i]`` times."""
        own = np.bincount(self.edge, np.repeat(number, self.sizes).astype(np.float64), len(self.to))
        return np.bincount(self.to, own, len(self.asked.after))

    def counts(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Zeros and ones of each slot when word ``i`` stands ``number[i]`` times."""
        return self.asked.sums(self.passed(number))

    def edges(self, tokens: np.ndarray) -> np.ndarray:
        """The edge of every byte of the words with numbers ``tokens``, one after another."""
        return self.edge.take(spread(self.begin.take(tokens, mode=FAST), self.sizes.take(tokens, mode=FAST)), mode=FAST)

    def places(self, edges: np.ndarray, each: np.ndarray) -> np.ndarray:
        """The place among all decisions of each decision on ``edges``; ``each``: decisions of each edge."""
        return spread(self.first.take(edges, mode=FAST), each)

    def inputs(self, tokens: np.ndarray, each: np.ndarray, of_decision: np.ndarray) -> np.ndarray:
        """``of_decision`` for every decision of the words with numbers ``tokens``, one after another; ``each``: decisions of each byte."""
        return of_decision.take(self.places(self.edges(tokens), each), mode=FAST)


def stretched(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """A count pair as one short number: the log-odds of a one, and in the last two bits how often the slot was seen."""
    odds = np.clip(np.log((ones + PRIOR) / (zeros + PRIOR)), -LIMIT, LIMIT)
    seen = zeros + ones
    level = (seen > 0).astype(np.int16) + (seen > 3) + (seen > 30)
    return (np.rint(odds * (SCALE / LEVELS)).astype(np.int16) * np.int16(LEVELS)) | level


def as_bytes(values: np.ndarray) -> np.ndarray:
    """``stretched`` numbers as one byte each, the log-odds in steps of a quarter."""
    step = np.rint((values >> 2) * (31 * LEVELS / (SCALE * LIMIT))) + 31
    return (step.astype(np.uint8) << 2) | (values & (LEVELS - 1)).astype(np.uint8)


def from_bytes(values: np.ndarray) -> np.ndarray:
    known = np.arange(256)
    odds = np.rint(((known >> 2) - 31) * (SCALE * LIMIT / (31 * LEVELS))).astype(np.int16)
    return (odds * np.int16(LEVELS) | (known & (LEVELS - 1)).astype(np.int16)).take(values)


def turned(values: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Odds of a one, ``as_bytes``, as odds of the decision that was made, and back: after a word so far that goes on in one way only, all are the same."""
    level = values & np.uint8(LEVELS - 1)
    return np.where(bit, values, np.uint8(62 * LEVELS) - values + level + level)


def first_weights() -> np.ndarray:
    """Where each text begins: the same for all gates."""
    return np.repeat(np.array(START, np.float32)[:, None] / SCALE, GATES, axis=1)


def score(texts: list[bytes], model: np.ndarray, words: Words, tokens: np.ndarray, of_decision: np.ndarray) -> np.ndarray:
    """log10 of the probability of each text.

    ``model``: tables x slots, from ``stretched``. ``tokens``: the numbers in ``words`` of the texts' words, one after another; ``of_decision``:
    the stretched counts of the slot of each decision of ``words``.
    """
    edges = words.edges(tokens)
    each = words.each.take(edges, mode=FAST)
    place = words.places(edges, each)
    step = words.step.take(place, mode=FAST)
    found = []
    for k, slot in enumerate(contexts(texts)):
        at = np.repeat(slot, each)
        at ^= step >> np.uint16(1)
        found.append(model[k].take(at, mode=FAST))
    found.append(of_decision.take(place, mode=FAST))
    bit = step & np.uint16(1)
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(each)])
    sizes = np.diff(total[np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])])
    gate = (found[1] & np.int16(LEVELS - 1)) * np.int16(LEVELS) + (found[2] & np.int16(LEVELS - 1))
    return mixed_scores([v.astype(np.float32) for v in found], gate, bit, sizes)


def mixed_scores(inputs: list[np.ndarray], gate: np.ndarray, bit: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mix, refine and learn. Texts are independent; the same block of all of them is worked off together."""
    out = np.zeros(len(sizes))
    begin = np.cumsum(sizes) - sizes
    active, at, block = np.flatnonzero(sizes), 0, FIRST_BLOCK
    weights = np.tile(first_weights(), len(active))
    # What the refinement has seen happen beyond the mixed probability, by gate and level; it starts with trust in the mixture.
    beyond, seen = np.zeros(len(active) * GATES * STEPS), np.full(len(active) * GATES * STEPS, TRUST)
    shift = float(1 << 20)  # above any sum of errors in a block: one pass adds up errors and numbers
    while len(active):
        first = begin[active] + at
        width = np.minimum(sizes[active] - at, block)
        spans = [slice(a, a + n) for a, n in zip(first.tolist(), width.tolist())]
        part = (lambda v: v[spans[0]]) if len(spans) == 1 else (lambda v: np.concatenate([v[s] for s in spans]))
        g = np.repeat(np.arange(len(active)) * GATES, width)
        g += part(gate)
        x = [part(v) for v in inputs]
        y = part(bit).astype(np.float32)
        mixed = weights[0].take(g, mode=FAST)
        mixed *= x[0]
        for k in range(1, CONTEXTS):
            term = weights[k].take(g, mode=FAST)
            term *= x[k]
            mixed += term
        np.clip(mixed, -11.9, 11.9, out=mixed)
        p = np.exp(-mixed)
        p += 1
        np.reciprocal(p, out=p)
        mixed += np.float32(STEPS / 2)
        cell = g * STEPS
        cell += mixed.astype(np.int8)
        final = (beyond / seen).astype(np.float32).take(cell, mode=FAST)
        final += p
        np.clip(final, np.float32(1e-5), np.float32(1 - 1e-5), out=final)
        final += y  # a probability f of a one: what came has |1 - (f + y)|, f for a one and 1 - f for a zero
        np.abs(np.float32(1) - final, out=final)
        np.log(final, out=final)
        out[active] += np.add.reduceat(final, np.cumsum(width) - width, dtype=np.float64)
        at += block
        going = sizes[active] > at
        if going.any():
            y -= p
            if not going.all():  # a text that ended has nothing more to learn for
                ends = np.cumsum(width)
                kept = [slice(b - n, b) for b, n, go in zip(ends.tolist(), width.tolist(), going.tolist()) if go]
                rest = (lambda v: v[kept[0]]) if len(kept) == 1 else (lambda v: np.concatenate([v[s] for s in kept]))
                y, cell, x = rest(y), rest(cell), [rest(v) for v in x]
            both = np.bincount(cell, y.astype(np.float64) + shift, len(beyond))
            number = np.rint(both / shift)
            counts = np.maximum(number.reshape(-1, STEPS).sum(axis=1), 64)
            for k in range(CONTEXTS):
                x[k] *= y
                # By cell and then by gate: neighbours rarely meet in one sum, which would make them wait for each other.
                weights[k] += RATE * np.bincount(cell, x[k], len(beyond)).reshape(-1, STEPS).sum(axis=1) / counts
            beyond += both - number * shift
            seen += number
            if not going.all():
                weights = weights[:, np.repeat(going, GATES)]
                beyond, seen = (v[np.repeat(going, GATES * STEPS)] for v in (beyond, seen))
        active, block = active[going], min(2 * block, LAST_BLOCK)
    return out / np.log(10)
