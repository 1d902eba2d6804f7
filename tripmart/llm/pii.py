"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust their score.

Everything is a column expression, so the rows neither leave the JVM nor move between tasks: one pass over the text,
no shuffle. A null text has no spans; an empty one neither. Repeated rows and null ids give a row each. Positions
are code points, the end exclusive. Columns the caller's table has besides are kept; one named like the result is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import let, read, running_sum

BASE = ("email", "ip", "card", "phone")


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.

    ``pattern`` uses possessive quantifiers and look-behinds so that no text costs more than a linear scan.
    ``valid`` confirms a match. ``score`` is what a confirmed match gets, ``raised`` what it gets beside a context word.
    """
    name: str
    pattern: str
    valid: object
    score: float
    raised: float
    context: str = ""
    hint: str = ""  # a cheap test of the text before the pattern runs


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def digit_count(low: int, high: int):
    return lambda m: F.length(digits(m)).between(low, high)


def luhn(match: Column) -> Column:
    """Every second digit from the right doubled, nine taken off what passes nine, the sum divisible by ten."""
    def total(d: Column) -> Column:
        def value(i: Column) -> Column:
            n = d.substr(F.length(d) - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
            return F.when(n > 9, n - 9).otherwise(n)
        return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda a, i: a + value(i))
    return let(digits(match), lambda d: F.length(d).between(12, 19) & (total(d) % 10 == 0))


def mod97(match: Column) -> Column:
    """The check of an account number: country and check digits moved to the end, letters as 10 to 35, remainder one."""
    def remainder(s: Column) -> Column:
        moved = F.concat(s.substr(F.lit(5), F.length(s)), s.substr(F.lit(1), F.lit(4)))
        def step(a: Column, i: Column) -> Column:
            c = F.ascii(moved.substr(i, F.lit(1)))
            return F.when(c < 58, a * 10 + c - 48).otherwise(a * 100 + c - 55) % 97
        return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), step)
    return let(F.regexp_replace(match, " ", ""), lambda s: F.length(s).between(15, 34) & (remainder(s) == 1))


def parts_in_range(match: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return match.rlike(f"^{part}(?:[.]{part}){{3}}$")


def always(_: Column) -> Column:
    return F.lit(True)


KINDS = (
    Kind("email",
         r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         always, 0.9, 1.0, "mail|contact|write to", "@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", parts_in_range, 0.6, 0.9, "address|host|server|from", "."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", luhn, 0.8, 1.0, "card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", digit_count(9, 15), 0.7, 1.0, "phone|call|tel|mobile|fax", "+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", mod97, 0.8, 1.0,
         "iban|account|bank"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", always, 0.4, 0.8, "ssn|social security", "-"),
    Kind("birth", r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])", always, 0.2, 0.7,
         "born|birth|dob|date of birth", "-"),
)
THRESHOLD, NEAR = 0.6, 40
SPANS = "array<struct<start:int,rank:int,end:int,kind:string,score:double,value:string>>"


def _proposed(text: Column, kind: Kind, rank: int) -> Column:
    """Confirmed matches of one kind, leftmost and not overlapping, with their places.

    The text is cut at the matches; the lengths of the pieces and of the matches give the places.
    """
    def placed(matches: Column) -> Column:
        pieces = F.transform(F.split(text, kind.pattern, -1), F.length)
        steps = F.zip_with(pieces, matches, lambda p, m: F.coalesce(p, F.lit(0)) + F.coalesce(F.length(m), F.lit(0)))
        return let(pieces, lambda p: let(running_sum(steps), lambda before: F.transform(
            matches, lambda m, i: F.struct(
                (before[i] + p[i]).alias("start"), F.lit(rank).alias("rank"),
                (before[i] + p[i] + F.length(m)).alias("end"), F.lit(kind.name).alias("kind"),
                F.lit(kind.score).alias("score"), m.alias("value")))))

    found = let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), lambda m: F.when(
        F.size(m) > 0, placed(m)).otherwise(F.array().cast(SPANS)))
    confirmed = F.filter(found, lambda s: kind.valid(s["value"]))
    near = lambda s: F.lower(text.substr(
        F.greatest(s["start"] - NEAR + 1, F.lit(1)), s["end"] - F.greatest(s["start"] - NEAR, F.lit(0)) + NEAR))
    return F.transform(confirmed, lambda s: s.withField("score", F.when(
        near(s).rlike(kind.context), kind.raised).otherwise(kind.score).cast("double")))


def find_spans(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with an array of spans (start, rank, end, kind, score, value), by start and then kind.

    The four base kinds stay whatever their score; the others need ``THRESHOLD``, which a context word can bring.
    """
    body, none = F.col(text), F.array().cast(SPANS)
    has_digit = body.rlike("[0-9]")
    parts = []
    for rank, kind in enumerate(KINDS):
        spans = _proposed(body, kind, rank)
        if kind.name not in BASE:
            spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
        test = body.contains(kind.hint) if kind.hint else F.lit(True)
        if kind.name != "email":
            test = test & F.col("\0digit")
        parts.append(F.when(test, spans).otherwise(none))
    return docs.withColumn("\0digit", has_digit).withColumn(out, F.array_sort(F.concat(*parts))).drop("\0digit")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets; overlapping spans become one."""
    body = F.col(text)

    def masked(spans: Column) -> Column:
        # A running end cuts each span to what no earlier one covers; ends, not texts, are carried.
        ends = lambda i: F.array_max(F.transform(F.slice(spans, F.lit(1), i), lambda s: s["end"]))
        cut = F.transform(spans, lambda s, i: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
            F.when(i > 0, ends(i)).otherwise(F.lit(0)).alias("seen")))
        pieces = F.transform(cut, lambda s: F.when(s["start"] >= s["seen"], F.concat(
            body.substr(s["seen"] + 1, s["start"] - s["seen"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(""))
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(pieces, ""), let(last, lambda e: body.substr(e + 1, F.length(body))))

    return (find_spans(docs, text, "\0spans")
            .withColumn(text, F.when(F.size("\0spans") > 0, let(F.col("\0spans"), masked)).otherwise(body))
            .drop("\0spans"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    listed = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    spans = F.coalesce(F.col("spans"), F.array().cast(SPANS))
    base = F.filter(spans, lambda s: s["rank"] < len(BASE))
    count = lambda rank: F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")
    return find_spans(docs).select(
        "doc_id", *[count(i).alias(f"n_{kind}") for i, kind in enumerate(BASE)],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans"))


def _oracle() -> str:
    """The query as DuckDB SQL: plain patterns, places from the lengths of pieces and matches, neighbours tested afterwards."""
    digits_of = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn_sum = (f"list_sum(list_transform(range(0, length({digits_of})), lambda i: case when i % 2 = 1 "
                f"then (2 * cast(substr({digits_of}, length({digits_of}) - i, 1) as int)) // 10 + (2 * cast(substr({digits_of}, length({digits_of}) - i, 1) as int)) % 10 "
                f"else cast(substr({digits_of}, length({digits_of}) - i, 1) as int) end))")
    moved = "concat(substr(replace(m, ' ', ''), 5), substr(replace(m, ' ', ''), 1, 4))"
    rest = (f"list_reduce(list_prepend(0, list_transform(range(1, length({moved}) + 1), lambda i: ascii(substr({moved}, i, 1)))), "
            "lambda a, c: case when c < 58 then (a * 10 + c - 48) % 97 else (a * 100 + c - 55) % 97 end)")
    near = "lower(substr(t, greatest(s - 39, 1), e - greatest(s - 40, 0) + 40))"
    alone = lambda chars: f"not regexp_matches(substr(t, s, case when s > 0 then 1 else 0 end), '[{chars}]') and not regexp_matches(substr(t, e + 1, 1), '[{chars}]')"
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
        ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
         "list_max(list_transform(string_split(m, '.'), lambda x: coalesce(try_cast(x as hugeint), 999))) <= 255"),
        ("card", r"[0-9](?:[ -]?[0-9])+", f"length({digits_of}) between 12 and 19 and {luhn_sum} % 10 = 0"),
        ("phone", r"\+[0-9][ ().0-9-]+[0-9]", f"length({digits_of}) between 9 and 15"),
        ("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}",
         f"length(replace(m, ' ', '')) between 15 and 34 and {alone('A-Za-z0-9')} and {rest} = 1"),
        ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", f"{alone('0-9-')} and regexp_matches({near}, 'ssn|social security')"),
        ("birth", r"[0-9]{4}-[0-9]{2}-[0-9]{2}", f"{alone('0-9-')} and regexp_matches({near}, 'born|birth|dob|date of birth')"),
    ]
    parts = [f"""
        select k, t, '{name}' as kind, {rank} as r, m, s, s + length(m) as e from (
            select k, t, ms[i] as m,
                   cast(list_sum(list_transform(ps[1 : i], lambda x: length(x)))
                        + coalesce(list_sum(list_transform(ms[1 : i - 1], lambda x: length(x))), 0) as bigint) as s
            from (select k, t, ms, ps, unnest(range(1, len(ms) + 1)) as i from (
                select k, t, regexp_extract_all(t, '{pattern}') as ms, regexp_split_to_array(t, '{pattern}') as ps from docs) a) b) c
        where {valid}""" for rank, (name, pattern, valid) in enumerate(kinds)]
    count = lambda kind: f"count(*) filter (kind = '{kind}') as n_{kind}"
    listed = lambda which: f"coalesce(string_agg(concat(kind, ':', s, ':', e), ',' order by s, r){which}, '')"
    return f"""
        with docs as (select row_number() over () as k, doc_id, coalesce(text, '') as t from documents),
        spans as ({' union all '.join(parts)})
        select d.doc_id, {', '.join(count(kind) for kind in BASE)},
               sha256({listed(' filter (r < 4)')}) as base_sha256, {listed(' filter (r is not null)')} as spans
        from docs d left join spans using (k) group by d.k, d.doc_id"""


ORACLE = _oracle()
