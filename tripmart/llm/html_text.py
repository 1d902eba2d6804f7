"""The main text of web pages: nearest-URL page differencing, guided by the markup.

Pages of a host are ordered by URL path; a page is paired with the neighbour that shares the longer start of the path (a tie
goes to the one before). The text lines of both are aligned by their longest common subsequence and shared lines are deleted.

Differencing alone gives wrong results where two pages carry the same article or quote the same passage, and where menus differ from page to
page. So markup says first what it can: regions that are named as no content (menus, page headers and footers, side bars, notices, adverts,
forms, comments, scripts) are left out, and lines inside an article, main or named content region are never deleted. Shared lines
are deleted among what no region claims.

A class is read name by name: ``content has-sidebar`` is content, ``comment-content`` a comment. A name such as header is no reason to drop the head of an article. Page frames
may bear a name of junk, as a form or a search page does: an article or main inside such a frame is kept aside, and counts if it holds more than
``OUTWEIGHS`` times the words of all else. Of the regions the strongest counts, article before main before content, unless a weaker one holds as many
times more words; what is nested in the region that counts belongs to it.

The order of the pages is a range-partitioned sort with row numbers, not a window over a host, so a host with a third of all pages is
spread over tasks like any other. Only hashes of lines travel to the neighbour. The html is shuffled once.

A null html counts as empty and gives an empty text. A null or odd url is a host and path of its own text. Repeated rows give a row each.
Only page_id, url and html are read.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tripmart.llm.common import narrow_batches, read, settle

# A comment, a declaration, or a tag with its attributes; whatever is left open runs to the end of the page.
TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]|=\s*"[^"]*"|=\s*'[^']*'|["'=])*+)(?:>|\Z)""", re.S)
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)

RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol option optgroup p pre search section select summary table tbody td tfoot th thead tr ul".split())
DROPPED = frozenset("head nav aside button select dialog menu svg canvas object audio video datalist".split())
FRAMES = frozenset("form fieldset search".split())  # no content, unless an article stands in them
OUTER = frozenset(("header", "footer"))  # no content, unless they stand in an article and head it
# Words of class, id and role that say what a region is.
JUNK = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox comment comments commentlist consent contentinfo"
    " cookie cookies copyright disqus footer gdpr menu modal nav navbar navigation newsletter notice notices notification"
    " pager pagination popup promo promotion related recommended recommendations replies respond sponsor sponsored subscribe subscription"
    " tracking complementary".split())
# Words that also name frames of whole pages.
LOOSE = frozenset("alert banner breadcrumb breadcrumbs header login masthead overlay search share sharing sidebar sidebars signup skip social toolbar widget".split())
HEADS = frozenset(("header", "masthead", "banner"))
BESIDE = frozenset(("has", "with", "no", "without"))  # a name with one of these tells what stands beside the element
CONTENT = frozenset("article articlebody body content entry main maincontent post postbody story storybody text".split())
OTHER, REGION, MAIN, ARTICLE, BURIED = 0, 1, 2, 3, 4
LOST, FRAME = -2, -1  # text left out for good, and text left out but for articles
OUTWEIGHS = 2

Line = tuple[str, int, int]  # text, the strongest region around it, the outermost one


def names_of(attributes: str) -> list[set[str]]:
    """The words of each class, id and role: main-content and mainContent are main and content."""
    names = [n for m in NAMED.finditer(attributes) for n in (m[1] or m[2] or m[3] or "").split()]
    return [{w.lower() for w in re.split(r"[^A-Za-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", n)) if w} for n in names]


def role(name: str, attributes: str, level: int) -> int:
    """The region an element opens, ``LOST`` or ``FRAME``."""
    if level == LOST or name in DROPPED or (name in OUTER and (level <= OTHER or name == "footer")):
        return LOST
    aside = level in (FRAME, BURIED)
    if name == "article":
        words = set().union(*names_of(attributes)) if attributes else set()
        return LOST if words & {"comment", "comments", "reply", "ad", "promo", "related"} else BURIED if aside else ARTICLE
    if name == "main":
        return BURIED if aside else max(level, MAIN)
    if name in FRAMES:
        return FRAME if level <= OTHER else LOST
    if attributes and ("class" in attributes or "id" in attributes or "role" in attributes or "hidden" in attributes or "style" in attributes
                       or attributes.isupper()):
        if HIDDEN.search(attributes):
            return LOST
        if name not in ("body", "html"):
            names = [n for n in names_of(attributes) if not (n & BESIDE and n & (JUNK | LOOSE))]
            if any(n & JUNK for n in names):
                return LOST
            if any(n & CONTENT and not n & LOOSE for n in names):
                return level if aside else max(level, REGION)
            loose = set().union(*names) & LOOSE
            if loose and not (level > OTHER and loose <= HEADS):
                return FRAME if level <= OTHER else LOST
    return level


def parse(page: str) -> list[Line]:
    """The text lines of a page outside the regions left out; one line for each block."""
    lines: list[Line] = []
    parts: list[str] = []
    stack: list[tuple[str, int, int]] = []
    level, outer, at = OTHER, OTHER, 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            lines.append((text, level, outer))

    def leave(depth: int) -> None:
        nonlocal level, outer
        del stack[depth:]
        _, level, outer = stack[-1] if stack else ("", OTHER, OTHER)

    raw: tuple[str, re.Pattern] | None = None
    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            if level >= 0:
                parts.append(page[at:])
            break
        if m.start() > at and level >= 0:
            parts.append(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if not closing and name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            if name in ("noscript", "textarea", "iframe") and level >= 0:
                parts.append(" ")
            continue
        if name in BLOCK:
            flush()
        elif name == "br" and level >= 0:
            parts.append(" ")
        if name in VOID or name in RAW:
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    leave(depth)
                    break
        else:
            if name in BLOCK and stack and stack[-1][0] == "p":
                leave(len(stack) - 1)
            if name == "li" and stack and stack[-1][0] == "li":
                leave(len(stack) - 1)
            if not m[0].endswith("/>") or name in BLOCK:
                inside = role(name, m[3], level)
                outer = inside if outer <= OTHER or inside == BURIED else outer
                stack.append((name, inside, outer))
                level = inside
    flush()
    return lines


def shared(a: Sequence[int], b: Sequence[int]) -> set[int]:
    """Positions of ``a`` in one longest common subsequence of ``a`` and ``b``.

    A row of the table is one big number with a bit for each place of ``b``; every √n-th row is kept and the others are made again.
    """
    if not a or not b:
        return set()
    full, places = (1 << len(b)) - 1, {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j

    def rows(row: int, part: Sequence[int]) -> list[int]:
        out = []
        for x in part:
            hit = row & places.get(x, 0)
            row = ((row + hit) | (row - hit)) & full
            out.append(row)
        return out

    step = max(1, math.isqrt(len(a)))
    starts, row = [], full
    for at in range(0, len(a), step):
        starts.append(row)
        row = rows(row, a[at:at + step])[-1]
    found: set[int] = set()
    j = len(b)
    for k in range(len(starts) - 1, -1, -1):
        at = k * step
        table = [starts[k], *rows(starts[k], a[at:at + step])]
        i = len(table) - 1
        while i and j:
            bit = 1 << (j - 1)
            if table[i] & bit:
                j -= 1
            else:
                i -= 1
                if table[i] & bit:
                    found.add(at + i)
                    j -= 1
    return found


def main_text(lines: Sequence[Line], deleted: set[int]) -> str:
    """Lines of the region that counts; without regions those that are not deleted."""
    words = [0] * (BURIED + 1)
    for text, level, _ in lines:
        words[level] += text.count(" ") + 1
    best = next((level for level in (ARTICLE, MAIN, REGION) if words[level]), OTHER)
    for level in (MAIN, REGION, BURIED):
        if words[level] > OUTWEIGHS * words[best] and (best != OTHER or level == BURIED):
            best = level
    if best == OTHER:
        return "\n".join(text for i, (text, level, _) in enumerate(lines) if level == OTHER and i not in deleted)
    return "\n".join(text for text, level, outer in lines if level == best or (OTHER < outer <= best < level < BURIED))


def signed(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def neighbours(pages: DataFrame) -> DataFrame:
    """(key, near): for each page the line hashes of the page next to it. ``pages``: key, host, path, hashes."""
    order = ["host", "path", "key"]
    ordered = settle(pages.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("id", F.monotonically_increasing_id()), "ordered")
    # A place is the number of rows in earlier partitions, one row each, plus the place in its own.
    part = F.shiftright("id", 33)
    counts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = settle(counts.select("part", F.sum("n").over(Window.orderBy("part")).alias("upto"), "n")
                    .select("part", (F.col("upto") - F.col("n")).alias("before")), "before")
    numbered = settle(ordered.withColumn("part", part).join(before, "part")
                      .withColumn("place", F.col("before") + F.col("id").bitwiseAND((1 << 33) - 1))
                      .select("key", "host", "path", "hashes", "place"), "numbered")
    def beside(shift: int) -> DataFrame:
        return numbered.select((F.col("place") + shift).alias("place"), F.col("host").alias("host2"), F.col("path").alias("path2"),
                               F.col("hashes").alias("near"), F.lit(shift).alias("before"))

    pairs = numbered.join(beside(1).unionByName(beside(-1)), "place").filter(F.col("host") == F.col("host2"))
    return (pairs.withColumn("score", common_start(F.col("path"), F.col("path2")))
            .groupBy("key").agg(F.max_by("near", F.struct("score", "before")).alias("near")))


def common_start(a: Column, b: Column) -> Column:
    """How many characters two strings share at their start."""
    n = F.least(F.length(a), F.length(b))
    differ = F.filter(F.sequence(F.lit(1), n), lambda i: a.substr(i, F.lit(1)) != b.substr(i, F.lit(1)))
    return F.when(n > 0, F.coalesce(F.array_min(differ) - 1, n)).otherwise(0)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): the path without scheme, query and fragment."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*:", "")
    rest = F.regexp_replace(rest, "[?#].*$", "")
    host = F.lower(F.regexp_extract(rest, "^//([^/]*)", 1))
    return host, F.regexp_replace(rest, "^//[^/]*", "")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for each row of ``pages``."""
    spark = pages.sparkSession
    narrow_batches(spark)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("key", F.xxhash64("page_id", "url", "html"))
    host, path = split_url(F.col("url"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [[signed(t) for t, _, _ in parse(h)] for h in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(lines, pa.list_(pa.int64()))], names=["key", "host", "path", "hashes"])

    listed = (rows.select("key", host.alias("host"), path.alias("path"), "html")
              .mapInArrow(hashed, "key long, host string, path string, hashes array<long>"))
    near = settle(neighbours(listed.dropDuplicates(["key"])), "near")
    schema = StructType([*pages.select("page_id", "url").schema.fields, *StructType.fromDDL("text string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, other in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                lines = parse(page)
                texts.append(main_text(lines, shared([signed(t) for t, _, _ in lines], other or [])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return rows.join(near, "key", "left").select("page_id", "url", "html", "near").mapInArrow(run, schema)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
