"""Benchmark passages inside training documents, found through a positional inverted index.

The index stores a posting (term, document, position) for each training word that the benchmark can ask for; it is
written where the words are read, without a shuffle. A window of benchmark words looks up its rarest term, shifts the
postings back by the term's offset and intersects them with the shifted postings of the next rarest term. What is
left, a few places, is compared with the window word by word, exactly or within a distance (proximity).
Frequent words are therefore stored and counted, but their lists are never joined.

Only built-in functions: no Python runs on the executors. Nothing is broadcast by hand: the benchmark's windows and
terms are written out first, so Spark knows their size and shuffles them when they are large.

A null or empty text has no words, an item without words no window. Items without an id hit words, but are neither
counted nor listed. Rows are told apart by id and text together: repeated rows each get their result, null ids too.
Columns of either table beside the named ones are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import NOT_WORD, ascii_lower, let, new_path, read, settle

WINDOW = 13


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def windows(items: DataFrame, size: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, phrase, terms) for every run of ``size`` words; a shorter item is one window."""
    cut = items.select(F.col(item_id).alias("item"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0))))
    return (cut.select("item", "w", start.alias("s"))
            .select("item", F.slice("w", F.col("s") + 1, F.lit(size)).alias("terms"))
            .select("item", F.array_join("terms", " ").alias("phrase"), "terms"))


def store_postings(docs: DataFrame, path: str, terms: DataFrame | None = None) -> DataFrame:
    """Write the postings of ``docs`` (key, text) and read them back; ``terms`` keeps only those words."""
    postings = docs.select("key", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    if terms is not None:
        postings = postings.join(terms, "term", "left_semi")
    postings.write.parquet(path)
    return docs.sparkSession.read.schema(postings.schema).parquet(path)


def candidates(postings: DataFrame, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """(key, start, phrase): places where the two rarest terms of a phrase stand at their distance."""
    asked = phrases.select("phrase", F.posexplode("terms").alias("offset", "term"))
    # A term without postings keeps a null count: its phrase stands nowhere.
    counts = settle(postings.groupBy("term").agg(F.count("*").alias("n")), "terms")
    by_phrase = Window.partitionBy("phrase")
    ranked = (asked.join(counts, "term", "left")
              .withColumn("missing", F.max(F.col("n").isNull()).over(by_phrase))
              .withColumn("rank", F.row_number().over(by_phrase.orderBy("n", "offset")))
              .filter(~F.col("missing") & (F.col("rank") <= 2)))
    ranked = settle(ranked.select("phrase", "term", "offset", "rank"), "rarest")
    first = ranked.filter("rank = 1").select("phrase", "term", "offset")
    second = ranked.filter("rank = 2").select("phrase", F.col("term").alias("term2"), F.col("offset").alias("offset2"))
    found = (postings.join(first, "term").select("key", "phrase", (F.col("pos") - F.col("offset")).alias("start"))
             .filter(F.col("start") >= -slop).distinct())
    shifts = F.array(*[F.lit(d) for d in range(-slop, slop + 1)])
    single = found.join(second, "phrase", "left_anti")
    pairs = (found.join(second, "phrase")
             .withColumn("shift", F.explode(shifts))
             .select("key", "start", "phrase", F.col("term2").alias("term"),
                     (F.col("start") + F.col("offset2") + F.col("shift")).alias("pos")))
    lists = postings.join(second.select(F.col("term2").alias("term")).distinct(), "term", "left_semi")
    met = pairs.join(lists, ["key", "term", "pos"], "left_semi").select("key", "start", "phrase")
    return met.distinct().unionByName(single.select("key", "start", "phrase"))


def stands(w: Column, start: Column, phrase: Column, slop: int) -> Column:
    """Whether the words of the phrase stand from ``start`` on, each at most ``slop`` places off."""
    terms = F.split(phrase, " ")
    if slop == 0:
        return F.array_join(F.slice(w, start + 1, F.size(terms)), " ") == phrase
    low = lambda i: F.greatest(start + i - slop, F.lit(0))
    return F.forall(F.transform(terms, lambda t, i: F.array_contains(
        F.slice(w, low(i) + 1, F.greatest(start + i + slop + 1 - low(i), F.lit(0))), t)), lambda x: x)


def passages(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = 0, doc_id: str = "doc_id",
             text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """For each document row: id, key, n_words, n_hit, n_items, items (sorted as strings) and hits (start, end, phrase).

    ``slop`` 0 gives exact phrases; above it, windows whose words all stand within ``slop`` places of theirs.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col(doc_id).alias("id"), F.xxhash64(doc_id, text).alias("key"), F.col(text).alias("text"))
    listed = settle(windows(items, size, item_id, item_text), "windows")
    phrases = listed.select("phrase", "terms").distinct()
    terms = settle(phrases.select(F.explode("terms").alias("term")).distinct(), "terms")
    postings = store_postings(keyed.select("key", "text"), new_path(spark, "postings"), terms)
    places = (candidates(postings, phrases, slop)
              .groupBy("key").agg(F.collect_set(F.struct("start", "phrase")).alias("places")))

    def checked(p: Column) -> Column:
        return let(words(F.col("text")), lambda w: F.array_sort(F.transform(
            F.filter(p, lambda c: stands(w, c["start"], c["phrase"], slop)),
            lambda c: F.struct(
                F.greatest(c["start"] - slop, F.lit(0)).alias("start"),
                F.least(c["start"] + F.size(F.split(c["phrase"], " ")) + slop, F.size(w)).alias("end"),
                c["phrase"].alias("phrase")))))

    def covered(hits: Column) -> Column:
        step = lambda a, h: F.struct(
            F.greatest(a["upto"], h["end"]).alias("upto"),
            (a["n"] + F.greatest(h["end"] - F.greatest(h["start"], a["upto"]), F.lit(0))).alias("n"))
        return F.aggregate(hits, F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")), step, lambda a: a["n"])

    none = F.array().cast("array<struct<start:int,end:int,phrase:string>>")
    found = settle(keyed.join(places, "key", "left").select(
        "id", "key",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long").alias("n_words"),
        F.when(F.col("places").isNotNull(), checked(F.col("places"))).otherwise(none).alias("hits")), "passages")
    named = (found.filter(F.size("hits") > 0)
             .select("key", F.explode(F.array_distinct(F.transform("hits", lambda h: h["phrase"]))).alias("phrase"))
             .join(listed.select("phrase", F.col("item").cast("string").alias("item")).distinct(), "phrase")
             .groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items")))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return found.join(named, "key", "left").select(
        F.col("id").alias(doc_id), "key", "n_words", covered(F.col("hits")).cast("long").alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"), items_of.alias("items"), "hits")


def contaminated() -> Column:
    """At least one word in twenty lies in a benchmark window."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    marked = passages(docs, items).filter(contaminated()).select(F.col("key").alias("\0key")).distinct()
    return (docs.withColumn("\0key", F.xxhash64("doc_id", "text"))
            .join(marked, "\0key", "left_anti").drop("\0key"))


def op9_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"))


ORACLE = """
with bench as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark),
docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents),
starts as (
  select item_id, w, least(len(w), 13) as n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as s from bench where len(w) > 0),
wanted as (select item_id, n, array_to_string(w[s : s + n - 1], ' ') as phrase from starts),
lengths as (select distinct n from wanted),
places as (
  select doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') as phrase
  from (select doc_id, w, n, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) as s from docs cross join lengths)),
hits as (select doc_id, s, p.n, item_id from places p join wanted q on p.phrase = q.phrase and p.n = q.n),
hit_words as (select doc_id, count(distinct i) as n_hit from (select doc_id, unnest(range(s, s + n)) as i from hits) group by doc_id),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs d left join hit_words using (doc_id) left join hit_items using (doc_id)
"""
