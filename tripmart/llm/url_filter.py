"""Web pages filtered by rules on their address and by the reputation of their host.

Rules come first: the longest one that fits decides. Elsewhere the reputation does. Pages with a label count as outcomes, good or bad. A host's share of
bad pages is drawn from a beta distribution around the share of its registered domain, a domain's around that of its suffix, a suffix's around
that of all pages. How strongly each level holds its members together (the beta's weight in pages) is estimated from the outcomes:
the variation between members beyond what chance brings, by the analysis of variance for beta-binomial counts. The posterior of a host is a beta, too; the
host is blocked if the lower bound of its bad share, ``Z`` posterior deviations below the mean, exceeds ``LIMIT``. A host without
outcomes keeps what its domain, suffix or all pages say.

Only DataFrame functions. Outcomes are summed on the map side into one row per host, so a host with a third of all pages is one row for each
task; what reaches the driver is three rows of sums. The table of hosts is written once, and Spark sends it to the pages if its size allows.

Null addresses and those without ``://`` have empty host and path, and count as one host. Ports, names before ``@`` and a last dot do not tell
hosts' domains apart; addresses of digits are their own domain. An id with several labels is bad if one of them says so; labels without any value say nothing.
Repeated pages count once each. Without outcomes every share is one half and nothing is blocked by reputation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import ascii_lower, read, settle

# Verdict, host, path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# Suffixes of two labels; all others have one.
LONG_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "com.tw", "gov.uk", "org.au", "org.uk")
Z, LIMIT = 1.645, 0.5
LEAST, MOST, USUAL = 1.0, 1000.0, 10.0  # weight of a level in pages: bounds, and what holds where outcomes cannot tell


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [((host == h) | host.endswith(f".{h}")) & path.startswith(p) for _, h, p in longest]
    first = lambda values: F.coalesce(*[F.when(fit, F.lit(v)) for fit, v in zip(fits, values)], F.lit(None).cast("string"))
    return first([h + p for _, h, p in longest]), first([v for v, _, _ in longest])


def domain_of(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"\.?(:[0-9]*)?$", "")
    size = F.when(F.substring_index(name, ".", -2).isin(*LONG_SUFFIXES), 2).otherwise(1)
    number = name.rlike(r"^[0-9.]*$")
    tail = lambda labels: F.when(number, name).when(labels == 1, F.substring_index(name, ".", -1)).when(
        labels == 2, F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -3))
    return tail(size + 1), tail(size)


def outcomes_of(labels: DataFrame) -> DataFrame:
    """(id, bad): one outcome for each labelled id."""
    told = labels.filter("doc_id is not null and (quality is not null or toxic is not null)")
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    return told.groupBy(F.col("doc_id").alias("id")).agg(F.max(bad.cast("int")).alias("bad"))


def _weight(members: DataFrame, parents: DataFrame, keys: list[str]) -> float:
    """Pages that a parent's share counts for in its members' priors."""
    square = lambda x: (F.col(x).cast("double") * F.col(x) / F.col("n")).cast("decimal(38,9)")
    own = members.filter("n > 0")
    of_parent = parents.filter("n > 0").select(*keys, F.col("n").alias("all_n"))
    inner = own.join(of_parent, keys)
    size = (F.col("n").cast("double") * F.col("n") / F.col("all_n")).cast("decimal(38,9)")
    k, n, bad, between, sizes = inner.agg(F.count("*"), F.sum("n"), F.sum("bad"), F.sum(square("bad")), F.sum(size)).first()
    p, among = parents.filter("n > 0").agg(F.count("*"), F.sum(square("bad"))).first()
    if not n or not 0 < bad < n:
        return USUAL
    spread = bad / n * (1 - bad / n)
    room = float(n) - float(sizes) - (k - p)
    if room <= 0:
        return USUAL
    shared = ((float(between) - float(among)) / spread - (k - p)) / room
    return min(max(1 / shared - 1, LEAST), MOST) if shared > 0 else MOST


def reputation(pages: DataFrame, outcomes: DataFrame, z: float = Z) -> DataFrame:
    """One row per ``host``: n outcomes, n bad, the posterior's mean and its lower and upper bound. ``pages``: id, host; ``outcomes``: id, bad."""
    told = pages.select("id", "host").join(outcomes.select("id", "bad"), "id", "left")
    domain, suffix = domain_of(F.col("host"))
    hosts = settle(told.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
                   .select("host", domain.alias("domain"), suffix.alias("suffix"), F.lit("").alias("root"), "n", "bad"), "hosts")
    total = lambda rows, *keys: settle(rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "level")
    domains = total(hosts, "domain", "suffix", "root")
    suffixes = total(domains, "suffix", "root")
    every = total(suffixes, "root")
    of_suffix = _weight(suffixes, every, ["root"])
    of_domain = _weight(domains, suffixes, ["suffix"])
    of_host = _weight(hosts, domains, ["domain", "suffix"])
    _, n, bad = every.first() or ("", 0, 0)
    share = (bad + 1.0) / (n + 2.0)
    drawn = lambda weight, prior: (F.col("bad") + weight * prior) / (F.col("n") + weight)
    suffix_share = suffixes.select("suffix", drawn(of_suffix, F.lit(share)).alias("above"))
    domain_share = domains.join(suffix_share, "suffix").select("domain", "suffix", drawn(of_domain, F.col("above")).alias("prior"))
    mean = drawn(of_host, F.col("prior"))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + of_host + 1))
    return (hosts.join(settle(domain_share, "domains"), ["domain", "suffix"]).withColumn("mean", mean)
            .select("host", "n", "bad", "mean", (F.col("mean") - z * deviation).alias("lower"), (F.col("mean") + z * deviation).alias("upper")))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, limit: float = LIMIT, z: float = Z,
          page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Each page's id with host, path, rule, verdict, and the reputation's n, bad, mean, lower and upper."""
    host, path = split_url(F.col(url))
    placed = pages.select(F.col(page_id).alias("id"), host.alias("host"), path.alias("path"))
    known = settle(reputation(placed, outcomes, z), "reputation")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    told = F.when(F.col("lower") > limit, "block").otherwise("allow")
    return placed.join(known, "host", "left").select(
        F.col("id").alias(page_id), "host", "path", rule.alias("rule"), F.coalesce(verdict, told).alias("verdict"), "n", "bad", "mean", "lower", "upper")


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's address judged; its label is that of the document with its number."""
    return judge(read(spark, sf_dir, "pages"), outcomes_of(read(spark, sf_dir, "labels"))).select(
        "page_id", "host", "path", "rule", "verdict", F.col("n").alias("n_labelled"), F.col("bad").cast("long").alias("n_bad"))


def _oracle() -> str:
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fit = lambda h, p: f"((host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}'))"
    cases = lambda value: "case " + " ".join(f"when {fit(h, p)} then '{value(v, h, p)}'" for v, h, p in longest) + " end"
    listed = ", ".join(f"'{s}'" for s in LONG_SUFFIXES)
    tail = lambda k: f"array_to_string(list_slice(parts, greatest(len(parts) - {k} + 1, 1), len(parts)), '.')"
    weight = lambda members, parents, on: f"""
        select case when n is null or bad = 0 or bad = n or n - sizes - (k - p) <= 0 then {USUAL}
                    when ((between_them - among) / (bad / n * (1 - bad / n)) - (k - p)) <= 0 then {MOST}
                    else least(greatest((n - sizes - (k - p)) / ((between_them - among) / (bad / n * (1 - bad / n)) - (k - p)) - 1, {LEAST}), {MOST}) end as w
        from (select count(*) as k, cast(sum(m.n) as double) as n, cast(sum(m.bad) as double) as bad, sum(m.bad * m.bad / m.n) as between_them, sum(m.n * m.n / u.n) as sizes
              from (select * from {members} where n > 0) m join (select * from {parents} where n > 0) u on {on}) a,
             (select count(*) as p, sum(bad * bad / n) as among from {parents} where n > 0) b"""
    return f"""
        with cut as (
            select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
        placed as (
            select page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
        outcomes as (
            select doc_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad from labels
            where doc_id is not null and (quality is not null or toxic is not null) group by 1),
        counted as (
            select host, cast(count(o.bad) as double) as n, cast(coalesce(sum(o.bad), 0) as double) as bad
            from placed left join outcomes o on o.doc_id = page_id group by 1),
        named as (select *, regexp_replace(regexp_replace(host, '^.*@', ''), '\\.?(:[0-9]*)?$', '') as name from counted),
        labelled as (select *, string_split(name, '.') as parts, regexp_matches(name, '^[0-9.]*$') as number from named),
        hosts as (
            select host, n, bad,
                   case when number then name when {tail(2)} in ({listed}) then {tail(3)} else {tail(2)} end as domain,
                   case when number then name when {tail(2)} in ({listed}) then {tail(2)} else {tail(1)} end as suffix from labelled),
        domains as (select domain, suffix, sum(n) as n, sum(bad) as bad from hosts group by 1, 2),
        suffixes as (select suffix, sum(n) as n, sum(bad) as bad from domains group by 1),
        every as (select sum(n) as n, sum(bad) as bad from suffixes),
        w1 as ({weight("suffixes", "every", "true")}),
        w2 as ({weight("domains", "suffixes", "m.suffix = u.suffix")}),
        w3 as ({weight("hosts", "domains", "m.suffix = u.suffix and m.domain = u.domain")}),
        above as (select suffix, (s.bad + w * ((e.bad + 1) / (e.n + 2))) / (s.n + w) as above from suffixes s, every e, w1),
        prior as (select domain, d.suffix, (bad + w * above) / (n + w) as prior from domains d join above a on a.suffix = d.suffix, w2),
        known as (
            select host, n, bad, w, (bad + w * prior) / (n + w) as mean
            from hosts h join prior p on p.domain = h.domain and p.suffix = h.suffix, w3)
        select page_id, p.host, path, {cases(lambda v, h, k: h + k).replace('host', 'p.host')} as rule,
               coalesce({cases(lambda v, h, k: v).replace('host', 'p.host')}, case when mean - {Z} * sqrt(mean * (1 - mean) / (n + w + 1)) > {LIMIT} then 'block' else 'allow' end) as verdict,
               cast(n as bigint) as n_labelled, cast(bad as bigint) as n_bad
        from placed p join known k on k.host = p.host"""


ORACLE = _oracle()
