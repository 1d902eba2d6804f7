"""Quality rules: a linear-chain conditional random field labels each line as content or boilerplate.

Line features go in, Viterbi decoding gives the likeliest sequence of labels, and the share of words on content lines decides
whether a document stays. The field is trained here on labelled documents: at most ``SAMPLE`` of each class, those with the least hash
of their id and at most ``LINES`` lines; their line features, not their texts, come to the driver. A document's label is first given to all of its lines;
a second round relabels the lines of bad documents by what the first one learned. Everything else covers all rows and whole texts.

Without labels of both classes the fixed weights ``PRIOR`` decide. Null and empty texts have no words and fail the base rule.
Repeated rows and null ids give a row each; only id and text are read. Rows stay where they are: one Arrow pass, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.llm.common import narrow_batches, read

SAMPLE, LINES = 750, 200
ROUNDS, STEPS, RATE, DECAY = 2, 150, 0.1, 1e-3
SHARE = 0.5  # least share of words on content lines
LEAST_WORDS, REPEAT_PERCENT, SPAN = 10, 20, 5

SYMBOLS, UPPER, DIGITS = b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
BLANK_OR_CONTINUED = b" \t\n\x0b\x0c\r" + bytes(range(0x80, 0xC0))
ENDS = (b".", b"!", b"?", b":", b";", b'"')
FEATURES = ("bias", "symbols", "marks", "upper", "repeats", "digits", "copied", "short", "open")
# Log-odds for content of each feature, for a table without labels.
PRIOR = (3.0, -12.0, -6.0, -8.0, -10.0, -4.0, -1.0, -0.5, -0.2)


@dataclass(frozen=True)
class Field:
    """Two labels, 0 boilerplate and 1 content: log-odds of content by feature, and scores of first and following labels."""
    weights: np.ndarray
    move: np.ndarray  # move[a, b]: label b after label a
    first: np.ndarray


def prior() -> Field:
    return Field(np.array(PRIOR), np.array([[1.0, -1.0], [-1.0, 1.0]]), np.zeros(2))


def line_features(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, words) of each line that has a word."""
    rows, counts, seen = [], [], set()
    for line in lines:
        words = line.split()
        n = len(words)
        if not n:
            continue
        size = len(line)
        without = lambda chars: (size - len(line.translate(None, chars))) / size
        copied = line in seen
        seen.add(line)
        rows.append((
            1.0, min(1.0, without(SYMBOLS) * 4), min(1.0, line.count(b"!!") / n), without(UPPER),
            sum(map(eq, words, words[1:])) / n, without(DIGITS), float(copied), float(n < 4), float(not words[-1].endswith(ENDS))))
        counts.append(n)
    return np.array(rows, float).reshape(-1, len(FEATURES)), np.array(counts, np.int64)


def viterbi(field: Field, features: np.ndarray) -> np.ndarray:
    """The likeliest labels of one text's lines; a tie goes to content."""
    odds = (features @ field.weights).tolist()
    if not odds:
        return np.zeros(0, np.int64)
    (aa, ab), (ba, bb) = field.move.tolist()
    zero, one = float(field.first[0]), float(field.first[1]) + odds[0]
    back: list[tuple[int, int]] = []
    for odd in odds[1:]:
        z, o = (0, zero + aa) if zero + aa > one + ba else (1, one + ba), (0, zero + ab) if zero + ab > one + bb else (1, one + bb)
        back.append((z[0], o[0]))
        zero, one = z[1], o[1] + odd
    labels = [0 if zero > one else 1]
    for step in reversed(back):
        labels.append(step[labels[-1]])
    return np.array(labels[::-1], np.int64)


def gradient(field: Field, texts: list[tuple[np.ndarray, np.ndarray]], together: int = 128) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Observed minus expected counts of features, moves and first labels, for each text; texts of like length advance together."""
    texts = sorted(texts, key=lambda t: len(t[1]))
    parts = [_summed(field, texts[at:at + together]) for at in range(0, len(texts), together)]
    return tuple(sum(p[i] for p in parts) / len(texts) for i in range(3))


def _summed(field: Field, texts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    longest = max(len(y) for _, y in texts)
    n = len(texts)
    size = np.array([len(y) for _, y in texts])
    x = np.zeros((n, longest, len(FEATURES)))
    y = np.zeros((n, longest), np.int64)
    for i, (f, labels) in enumerate(texts):
        x[i, : len(labels)], y[i, : len(labels)] = f, labels
    emit = np.zeros((n, longest, 2))
    emit[:, :, 1] = x @ field.weights
    forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
    forward[:, 0] = field.first + emit[:, 0]
    for t in range(1, longest):
        forward[:, t] = np.logaddexp.reduce(forward[:, t - 1, :, None] + field.move, axis=1) + emit[:, t]
    for t in range(longest - 2, -1, -1):
        step = np.logaddexp.reduce(field.move + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
        backward[:, t] = np.where((t + 1 < size)[:, None], step, 0)
    total = np.logaddexp.reduce(forward[np.arange(n), size - 1], axis=1)
    real = np.arange(longest) < size[:, None]
    one = np.exp(forward + backward - total[:, None, None])[:, :, 1] * real
    pair = np.exp(forward[:, :-1, :, None] + field.move + (emit + backward)[:, 1:, None, :] - total[:, None, None, None]) * real[:, 1:, None, None]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:, :-1][real[:, 1:]], y[:, 1:][real[:, 1:]]), 1)
    start = np.bincount(y[:, 0], minlength=2) - np.array([(1 - one[:, 0]).sum(), one[:, 0].sum()])
    return np.einsum("nt,ntf->f", (y - one) * real, x), seen - pair.sum(axis=(0, 1)), start


def fit(texts: list[tuple[np.ndarray, int]]) -> Field:
    """Train on (line features, document label)."""
    texts = [(f, label) for f, label in texts if len(f)]
    if len({label for _, label in texts}) < 2:
        return prior()
    labelled = [(f, np.full(len(f), label)) for f, label in texts]
    field = prior()
    for _ in range(ROUNDS):
        parts = [np.zeros(len(FEATURES)), np.zeros((2, 2)), np.zeros(2)]
        mean, power = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
        for step in range(1, STEPS + 1):
            for i, g in enumerate(gradient(Field(*parts), labelled)):
                g = g - DECAY * parts[i]
                mean[i] = 0.9 * mean[i] + 0.1 * g
                power[i] = 0.999 * power[i] + 0.001 * g * g
                parts[i] = parts[i] + RATE * (mean[i] / (1 - 0.9**step)) / (np.sqrt(power[i] / (1 - 0.999**step)) + 1e-8)
        field = Field(*parts)
        # A bad document may hold content lines; its worst line stays boilerplate.
        for i, (f, label) in enumerate(texts):
            if label == 0:
                found = (f @ field.weights > 0).astype(np.int64)
                found[np.argmin(f @ field.weights)] = 0
                labelled[i] = (f, found)
    return field


def repeated_words(words: list[bytes], span: int = SPAN) -> int:
    """How many words lie in a window of ``span`` words that stands twice or more, its first place included."""
    n = len(words) - span + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    kinds = len(number)
    if kinds == len(words):
        return 0
    code = ids[:n].copy()
    for k in range(1, span):
        if kinds > 2**62 // len(number):  # keep codes exact: number what there is so far anew
            found, code = np.unique(code, return_inverse=True)
            kinds = len(found)
        code = code * len(number) + ids[k:k + n]
        kinds *= len(number)
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    start = np.zeros(n, bool)
    start[order[1:][same]] = True
    start[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(span):
        covered[k:k + n] |= start
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, int, int, int, int, bool]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    words = text.split()
    seen: set[bytes] = set()
    copies = 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            copies += line in seen
            seen.add(line)
    n, repeats = len(words), repeated_words(words)
    return (n, len(text.translate(None, BLANK_OR_CONTINUED)), len(text) - len(text.translate(None, SYMBOLS)), copies, repeats,
            n < LEAST_WORDS or 100 * repeats > REPEAT_PERCENT * n)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """Fit the field on a bounded sample of labelled documents."""
    order = F.xxhash64("doc_id")
    short = F.size(F.split(F.coalesce("text", F.lit("")), "\n")) <= LINES
    chosen = [labels.filter(F.col("quality") == q).select("doc_id", F.lit(q).alias("label")).distinct().orderBy(order, "doc_id").limit(sample)
              for q in (0, 1)]
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").filter(short)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [line_features((t or b"").split(b"\n"))[0].tobytes() for t in pc.cast(batch.column(0), pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column(1)], names=["features", "label"])

    rows = picked.select("text", "label").mapInArrow(run, "features binary, label int").collect()
    ordered = sorted((bytes(r.features), r.label) for r in rows)  # the fit must not depend on the order of arrival
    return fit([(np.frombuffer(f).reshape(-1, len(FEATURES)), label) for f, label in ordered])


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VERDICT = "content_share double, base_failed boolean, kept boolean"


def judge(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``docs`` with the base measures, the content share and whether to keep each row; columns so named are replaced."""
    narrow_batches(docs.sparkSession)
    fresh = StructType.fromDDL(", ".join(f"{m} long" for m in MEASURES) + ", " + VERDICT)
    clash = set(fresh.names)
    rows = docs.select(*[c for c in docs.columns if c not in clash])
    at, names = rows.columns.index(text), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for t in pc.cast(batch.column(at), pa.binary()).to_pylist():
                t = t or b""
                *numbers, failed = measure(t)
                share = 0.0
                if not failed:
                    features, words = line_features(t.split(b"\n"))
                    share = float((viterbi(field, features) * words).sum() / words.sum())
                found.append((*numbers, share, failed, not failed and share >= SHARE))
            columns = [pa.array(list(c), k) for c, k in zip(
                zip(*found), [pa.int64()] * 5 + [pa.float64(), pa.bool_(), pa.bool_()])] if found else [
                pa.array([], k) for k in [pa.int64()] * 5 + [pa.float64(), pa.bool_(), pa.bool_()]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*names, *fresh.names])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, *fresh.fields]))


def keep_content(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    field = train(docs, labels)
    # Under plain numbers no column of the caller can clash with a measure.
    inner = [f"\0{i}" for i in range(len(docs.columns))]
    kept = judge(docs.toDF(*inner), field, inner[docs.columns.index("text")]).filter("kept")
    return kept.select(*[F.col(i).alias(c) for i, c in zip(inner, docs.columns)])


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, train(docs, read(spark, sf_dir, "labels"))).select("doc_id", *MEASURES, "base_failed", "kept")
