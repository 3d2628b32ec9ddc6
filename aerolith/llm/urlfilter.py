"""URL filters from dated block lists, by an as-of join.

A list is a table of dated entries (kind, value, at, action): a domain with its
subdomains, one host, or the start of a path on a host is added or removed on a
day. Entries become validity intervals, from one addition to the next entry of
the same rule, and every capture is held against the entries active on the day
it was fetched. All of it is DataFrame operations.

Defined cases: blanks around a URL, escapes in its host and a dot at the host's end
do not tell hosts apart; a null URL, or one without scheme and host, matches nothing; a
capture without a fetch day meets no active entry; of entries of one rule on
one day a removal counts last; repeated additions change nothing; captures that
repeat keep their row each; an entry with a null value or day is void. The most
specific active entry is reported: prefix, then host, then domain, the longer
value first. Only the columns named are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import table

#: What stands before the last @ of the authority is a user, not the host; an address in brackets is a host whole.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*)"


def _clean(url: Column) -> Column:
    """url without the blanks and control characters around it, which browsers drop."""
    return F.regexp_replace(url, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def host_of(url: Column) -> Column:
    """The host in lower case, with escapes read and without the dot of the root at its end; null if there is none."""
    host = F.regexp_extract(_clean(url), HOST, 1)
    read = F.when(host.contains("%"), F.coalesce(F.try_url_decode(F.replace(host, F.lit("+"), F.lit("%2B"))), host)).otherwise(host)
    return F.nullif(F.lower(F.regexp_replace(read, r"\.$", "")), F.lit(""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_clean(url), PATH, 1)


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, value, valid_from, valid_to): days on which an entry is active, valid_to excluded, null for open ends."""
    daily = entries.filter("kind IS NOT NULL AND value IS NOT NULL AND at IS NOT NULL").groupBy("kind", "value", "at").agg(F.max((F.col("action") == "remove").cast("int")).alias("removed"))
    following = F.lead("at").over(Window.partitionBy("kind", "value").orderBy("at"))
    return daily.withColumn("valid_to", following).filter("removed = 0").select("kind", "value", F.col("at").alias("valid_from"), "valid_to")


def _rules(named: DataFrame, keys: list[str], depths: dict[str, list[int]] | None = None) -> DataFrame:
    """The rules that could name each URL of ``named`` (keys, host, path): keys, kind, value, rank, a higher rank being more specific.

    One row for each label of the host, one for the host, one for each part of
    the path; with ``depths`` only of numbers of labels and parts that entries
    have. Rows are made one by one, so a URL of very many parts is never held
    once for each of them.
    """
    parted = named.select(*keys, "host", F.split("host", r"\.").alias("labels"), F.filter(F.split("path", "/"), lambda s: s != "").alias("steps"))

    def numbers(kind: str, size: Column) -> Column:
        all_ = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))
        some = all_ if depths is None else F.array_intersect(all_, F.array(*map(F.lit, depths.get(kind, []))).cast("array<int>"))
        return F.transform(some, lambda i: F.struct(F.lit(kind).alias("kind"), i.alias("n")))

    whole = F.array(F.struct(F.lit("host").alias("kind"), F.lit(1).alias("n")))
    each = parted.select(*keys, "host", "labels", "steps", F.explode(F.concat(numbers("domain", F.size("labels")), whole, numbers("prefix", F.size("steps")))).alias("c"))
    n, count = F.col("c.n"), F.size("labels")
    of = F.when(F.col("c.kind") == "domain", F.array_join(F.slice("labels", count - n + 1, n), ".")).when(F.col("c.kind") == "host", F.col("host"))
    value = of.otherwise(F.concat("host", F.lit("/"), F.array_join(F.slice("steps", F.lit(1), n), "/")))
    rank = F.when(F.col("c.kind") == "domain", n).when(F.col("c.kind") == "host", count + 1).otherwise(count + 1 + n)
    return each.select(*keys, F.col("c.kind").alias("kind"), value.alias("value"), rank.alias("rank"))


def entry_depths(entries: DataFrame) -> dict[str, list[int]]:
    """How many labels domain entries have, and how many parts path entries: a few numbers."""
    parts = F.when(F.col("kind") == "domain", F.size(F.split("value", r"\."))).when(F.col("kind") == "prefix", F.size(F.split("value", "/")) - 1)
    found = entries.filter("kind IN ('domain', 'prefix')").select("kind", parts.alias("n")).filter("n IS NOT NULL").distinct().collect()
    return {kind: sorted(r["n"] for r in found if r["kind"] == kind) for kind in ("domain", "prefix")}


def as_of(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """captures (page_id, url, fetched_on) with host, blocked, kind, rule, listed_since and n_active.

    Equal (url, day) pairs are judged once. The join is an equi-join on the rule,
    so that a host with many captures is split where it is skewed, and each
    capture meets at most one interval of a rule.
    """
    captures = captures.select("page_id", "url", "fetched_on")
    pairs = captures.filter("url IS NOT NULL AND fetched_on IS NOT NULL").select("url", "fetched_on").distinct()
    named = pairs.withColumn("host", host_of(F.col("url"))).filter("host IS NOT NULL")
    valid = intervals(entries)
    rules = _rules(named.withColumn("path", path_of(F.col("url"))), ["url", "fetched_on"], entry_depths(entries))
    active = (F.col("fetched_on") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to")))
    hits = rules.join(valid, ["kind", "value"]).filter(active)
    best = F.max(F.struct("rank", "kind", "value", "valid_from")).alias("best")
    verdicts = hits.groupBy("url", "fetched_on").agg(best, F.count("*").alias("n_active")).select("url", "fetched_on", "best.kind", F.col("best.value").alias("rule"), F.col("best.valid_from").alias("listed_since"), "n_active")
    out = captures.join(verdicts, ["url", "fetched_on"], "left")
    return out.select("page_id", "url", host_of(F.col("url")).alias("host"), "fetched_on", F.col("rule").isNotNull().alias("blocked"), "kind", "rule", "listed_since", F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"))


def dated_list(pages: DataFrame) -> DataFrame:
    """A dated list over the domains, hosts and path starts that pages have, drawn by a hash of each: added once, some removed later, some of these added again."""
    named = pages.filter("url IS NOT NULL").select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).filter("host IS NOT NULL")
    rules = _rules(named, []).select("kind", "value").distinct()
    drawn = rules.withColumn("v", F.conv(F.substring(F.md5(F.concat_ws(" ", "kind", "value").cast("binary")), 1, 6), 16, 10).cast("int")).filter("v % 7 = 0")
    first = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.floor(F.col("v") / 7), F.lit(600)).cast("int"))
    entries = F.array(
        F.struct(first.alias("at"), F.lit("add").alias("action")),
        F.struct(F.when(F.col("v") % 2 == 0, F.date_add(first, 90)).alias("at"), F.lit("remove").alias("action")),
        F.struct(F.when(F.col("v") % 4 == 0, F.date_add(first, 200)).alias("at"), F.lit("add").alias("action")),
    )
    return drawn.select("kind", "value", F.explode(entries).alias("e")).select("kind", "value", "e.*").filter("at IS NOT NULL")


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_on", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(730)).cast("int")))
    return as_of(captures, dated_list(pages))


OP6_SQL = r"""
WITH captures AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 730 AS INTEGER) AS fetched_on,
         nullif(lower(regexp_replace(CASE WHEN contains(h, '%') THEN url_decode(replace(h, '+', '%2B')) ELSE h END, '\.$', '')), '') AS host,
         list_filter(string_split(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^?#]*)', 1), '/'), lambda s: s <> '') AS steps
  FROM (SELECT *, regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:@]+)', 1) AS h FROM (SELECT page_id, url, regexp_replace(url, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS u FROM pages))),
rules AS (
  SELECT page_id, url, fetched_on, 'domain' AS kind, i AS rank, array_to_string(list_slice(string_split(host, '.'), -i, -1), '.') AS value
  FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM captures WHERE host IS NOT NULL)
  UNION ALL SELECT page_id, url, fetched_on, 'host', 100000, host FROM captures WHERE host IS NOT NULL
  UNION ALL SELECT page_id, url, fetched_on, 'prefix', 200000 + i, host || '/' || array_to_string(list_slice(steps, 1, i), '/')
  FROM (SELECT *, unnest(range(1, len(steps) + 1)) AS i FROM captures WHERE host IS NOT NULL)),
drawn AS (
  SELECT kind, value, v, DATE '2024-01-01' + CAST((v // 7) % 600 AS INTEGER) AS first
  FROM (SELECT kind, value, CAST('0x' || substr(md5(kind || ' ' || value), 1, 6) AS INTEGER) AS v FROM (SELECT DISTINCT kind, value FROM rules)) WHERE v % 7 = 0),
entries AS (
  SELECT kind, value, first AS day, 0 AS removed FROM drawn
  UNION ALL SELECT kind, value, first + 90, 1 FROM drawn WHERE v % 2 = 0
  UNION ALL SELECT kind, value, first + 200, 0 FROM drawn WHERE v % 4 = 0),
valid AS (
  SELECT kind, value, day AS valid_from, removed, lead(day) OVER (PARTITION BY kind, value ORDER BY day) AS valid_to FROM entries),
hits AS (
  SELECT page_id, rules.kind, rules.value, rank, valid_from FROM rules JOIN valid USING (kind, value)
  WHERE removed = 0 AND fetched_on >= valid_from AND (valid_to IS NULL OR fetched_on < valid_to)),
best AS (
  SELECT page_id, arg_max(kind, rank) AS kind, arg_max(value, rank) AS rule, arg_max(valid_from, rank) AS listed_since, count(*) AS n_active FROM hits GROUP BY page_id)
SELECT page_id, url, host, fetched_on, rule IS NOT NULL AS blocked, kind, rule, listed_since, coalesce(n_active, 0) AS n_active
FROM captures LEFT JOIN best USING (page_id)
"""
