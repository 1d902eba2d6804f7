import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tripmart.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    text, found = text or "", []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                  "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                found.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


TEXTS = [
    None, "", "nothing here", "a@b.co", "é x.y+z@mail.example.com, ring +1 (386) 555-3733 or +49 30 1234567 now",
    "a@b.c_d@e.f.g", "x@y x@y.z..q", "10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 0000255.01.1.0001 1.2.3", "+1+1 +12345678901234567",
    "card 4944339490429605 and 4944-3394 9042-9605 1234567890123", "4944339490429605" * 3, "+4944339490429605",
    "ß" * 50 + " me@x.org " * 700, "9" * 2000, "a" * 900 + "@" + "b" * 900, "1 " * 2000, ". + - @ " * 50,
    "mail a@b.c.d then 9.9.9.9 and a@b.c", "line\none@two.com\r\n8.8.8.8",
]


def test_base_spans_equal_plain_search(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in pii.op1_pii(spark, str(tmp_path)).collect()}
    for i, text in enumerate(TEXTS):
        want = brute(text)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (i, want, got[i].spans)
        assert got[i].n_email == want.count("email:") and got[i].n_card == want.count("card:")


def spans_of(spark, text):
    df = pii.find_spans(spark.createDataFrame([(text,)], "text string"))
    return [(s["kind"], s["value"]) for s in df.first()["spans"]]


@pytest.mark.parametrize("text,want", [
    ("iban GB82 WEST 1234 5698 7654 32 here", [("iban", "GB82 WEST 1234 5698 7654 32")]),
    ("DE89370400440532013000", [("iban", "DE89370400440532013000")]),
    ("DE89370400440532013001", []),
    ("my ssn is 123-45-6789", [("ssn", "123-45-6789")]),
    ("part 123-45-6789", []),
    ("born on 1980-02-03", [("birth", "1980-02-03")]),
    ("released 1980-02-03", []),
])
def test_checksum_and_context(spark, text, want):
    assert [s for s in spans_of(spark, text) if s[0] not in pii.BASE] == want


def test_redacted_text(spark):
    rows = [("to a@b.co and 8.8.8.8!",), (None,), ("",), ("é nº 4944339490429605 x",), ("plain",)]
    got = [r[0] for r in pii.redact(spark.createDataFrame(rows, "text string")).collect()]
    assert got == ["to [EMAIL] and [IP]!", None, "", "é nº [CARD] x", "plain"]


def test_other_columns_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a@b.co", "kept"), (1, "a@b.co", "kept"), (None, None, None)], "doc_id long, text string, spans string")
    out = pii.find_spans(df)
    assert out.columns == ["doc_id", "text", "spans"] and out.count() == 3
    assert [len(r.spans or []) for r in out.orderBy("doc_id").collect()] == [0, 1, 1]
    assert pii.redact(df.limit(0)).count() == 0


def test_main_path_is_free_of_python(spark):
    plan = pii.redact(spark.createDataFrame([("a",)], "text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
