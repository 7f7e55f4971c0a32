"""URL filters as a temporal list join.

List entries are dated: on some day a pattern is added to or removed from a
list. They become validity intervals [day, next change); a capture is judged by
the entries valid on the day it was fetched, not by today's list. Patterns are
whole URLs, path prefixes, hosts, or domains (which cover their subdomains). Every
capture names the patterns that could match it, and an as-of join with the
intervals finds those in force; the most specific decides: URL, then the longest
prefix, host, then the longest domain; then the latest entry; block before allow.

Defined cases: on one day a removal beats an addition; repeated entries count
once; a capture without a URL, host or day has verdict ``none``; a text that
isn't a URL matches nothing; repeated captures are judged row by row; empty
tables give no rows (captures) or no matches (entries); other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexcurate.llm import common

KINDS = {"url": 4, "prefix": 3, "host": 2, "domain": 1}


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.regexp_replace(F.regexp_replace(host, r"\.+$", ""), r"^www\.", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def intervals(entries: DataFrame) -> DataFrame:
    """``entries``: list, kind, pattern, day, action ('add' or 'remove'). Adds from_day and to_day (exclusive,
    null: open). Additions while the pattern is on the list change nothing."""
    # one row a pattern and day: a pattern's window holds no more rows than the calendar has days
    days = entries.where("list IS NOT NULL AND pattern IS NOT NULL AND day IS NOT NULL AND action IN ('add', 'remove')") \
        .groupBy("list", "kind", "pattern", "day").agg(F.min(F.col("action") == "add").alias("on"))
    line = Window.partitionBy("list", "kind", "pattern").orderBy("day")
    changes = days.withColumn("was", F.coalesce(F.lag("on").over(line), F.lit(False))).where("on <> was")
    return changes.withColumn("to_day", F.lead("day").over(line)).where("on") \
        .select("list", "kind", "pattern", F.col("day").alias("from_day"), "to_day")


def deepest_prefix(force: DataFrame) -> int:
    """Path levels of the deepest prefix pattern, at least 1."""
    return force.where("kind = 'prefix'").agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 1


def patterns_of(url: Column, path_levels: int) -> Column:
    """The patterns (kind, pattern) that match a URL, of prefixes those of at most ``path_levels`` levels."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    levels = F.split(F.trim(path, F.lit("/")), "/")
    one = lambda kind, pattern: F.struct(F.lit(kind).alias("kind"), pattern.alias("pattern"))
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: one("domain", F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    prefixes = F.transform(F.sequence(F.lit(1), F.least(F.size(levels), F.lit(path_levels))),
                           lambda i: one("prefix", F.concat(host, F.lit("/"), F.array_join(F.slice(levels, F.lit(1), i), "/"))))
    whole = F.array(one("url", F.concat(host, path)), one("host", host))
    return F.when(host != "", F.concat(whole, domains, F.when(F.length(F.trim(path, F.lit("/"))) > 0, prefixes)
                                       .otherwise(F.slice(whole, 1, 0))))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures``: page_id, url, day. One row a capture: page_id, day, verdict, kind, pattern, from_day, to_day."""
    dated = common.table(intervals(entries), "intervals")
    force, path_levels = common.sized(dated), deepest_prefix(dated)
    # equal (url, day) captures are judged once: a hot page is one row here
    asked = captures.where("url IS NOT NULL AND day IS NOT NULL").groupBy("url", "day").agg(F.count(F.lit(1)).alias("n"))
    keys = asked.select("url", "day", F.explode(patterns_of(F.col("url"), path_levels)).alias("p")).select("url", "day", "p.kind", "p.pattern")
    level = F.lit(0)
    for kind, n in KINDS.items():
        level = F.when(F.col("kind") == kind, n).otherwise(level)
    order = F.struct(level.alias("level"), F.length("pattern").alias("length"), F.col("from_day"), (F.col("list") == "block").alias("b"),
                     "list", "kind", "pattern", "to_day")
    hit = (keys.join(force, ["kind", "pattern"]).where("day >= from_day AND (to_day IS NULL OR day < to_day)")
           .groupBy("url", "day").agg(F.max(order).alias("best")))
    best = F.col("best")
    return captures.join(hit, ["url", "day"], "left").select(
        "page_id", "day", F.coalesce(best["list"], F.lit("none")).alias("verdict"), best["kind"].alias("kind"),
        best["pattern"].alias("pattern"), best["from_day"].alias("from_day"), best["to_day"].alias("to_day"))


def _number(text: Column) -> Column:
    """A number below 2**28 from a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("int")


def dated_entries(pages: DataFrame) -> DataFrame:
    """List history for the hosts, sections and pages that ``pages`` holds, drawn from hashes of their names."""
    host = host_of(F.col("url"))
    names = pages.select(host.alias("host"), path_of(F.col("url")).alias("path")).where("host <> ''")
    section = F.concat("host", F.lit("/"), F.split(F.trim(F.col("path"), F.lit("/")), "/")[0])
    parent = F.regexp_replace("host", r"^[^.]+\.", "")
    some = [names.select(F.lit("block").alias("list"), F.lit("host").alias("kind"), F.col("host").alias("pattern"), F.lit(3).alias("one_in")),
            names.where(F.size(F.split("host", r"\.")) > 3).select(F.lit("block"), F.lit("domain"), parent, F.lit(4)),
            names.select(F.lit("block"), F.lit("prefix"), section, F.lit(5)),
            names.select(F.lit("allow"), F.lit("prefix"), section, F.lit(6)),
            names.select(F.lit("allow"), F.lit("url"), F.concat("host", "path"), F.lit(40))]
    listed = some[0]
    for more in some[1:]:
        listed = listed.union(more)
    n = _number(F.concat("list", F.lit(":"), "pattern"))
    listed = listed.distinct().withColumn("n", n).where("n % one_in = 0").withColumn("h", F.floor(F.col("n") / 64).cast("int"))
    days = F.array(*(F.struct((F.col("h") % 200 + shift).cast("int").alias("day"), F.lit(action).alias("action"))
                     for shift, action in ((0, "add"), (40, "add"), (90, "remove"), (150, "add"))))
    return listed.select("list", "kind", "pattern", F.explode(days).alias("e")).select("list", "kind", "pattern", "e.day", "e.action")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    captures = pages.withColumn("day", (F.col("page_id") * 37 % 365).cast("int"))
    return judge(captures, dated_entries(pages))


OP2_SQL = r"""
WITH p AS (SELECT page_id, url, CAST(page_id * 37 % 365 AS INTEGER) AS day,
  regexp_replace(regexp_replace(regexp_extract(lower(trim(url)), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\.+$', ''), '^www\.', '') AS host,
  regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
nm AS (SELECT DISTINCT host, path, host || '/' || split_part(trim(path, '/'), '/', 1) AS section FROM p WHERE host <> ''),
listed AS (
  SELECT 'block' AS list, 'host' AS kind, host AS pattern, 3 AS one_in FROM nm
  UNION SELECT 'block', 'domain', regexp_replace(host, '^[^.]+\.', ''), 4 FROM nm WHERE len(string_split(host, '.')) > 3
  UNION SELECT 'block', 'prefix', section, 5 FROM nm
  UNION SELECT 'allow', 'prefix', section, 6 FROM nm
  UNION SELECT 'allow', 'url', host || path, 40 FROM nm),
n AS (SELECT *, CAST('0x' || substr(md5(list || ':' || pattern), 1, 7) AS INTEGER) AS n FROM listed),
e AS (SELECT list, kind, pattern, (n // 64) % 200 + s AS day, a AS action FROM n,
      (VALUES (0, 'add'), (40, 'add'), (90, 'remove'), (150, 'add')) AS x(s, a) WHERE n % one_in = 0),
d AS (SELECT list, kind, pattern, day, bool_and(action = 'add') AS is_on FROM e GROUP BY ALL),
c AS (SELECT *, coalesce(lag(is_on) OVER w, false) AS was FROM d WINDOW w AS (PARTITION BY list, kind, pattern ORDER BY day)),
i AS (SELECT list, kind, pattern, day AS from_day, lead(day) OVER w AS to_day, is_on FROM c WHERE is_on <> was
      WINDOW w AS (PARTITION BY list, kind, pattern ORDER BY day)),
m AS (SELECT p.page_id, p.day, i.list, i.kind, i.pattern, i.from_day, i.to_day,
        row_number() OVER (PARTITION BY p.page_id ORDER BY CASE i.kind WHEN 'url' THEN 4 WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END DESC,
          length(i.pattern) DESC, i.from_day DESC, (i.list = 'block') DESC) AS r
      FROM p JOIN i ON i.is_on AND p.day >= i.from_day AND (i.to_day IS NULL OR p.day < i.to_day) AND (
        i.kind = 'url' AND i.pattern = p.host || p.path OR i.kind = 'host' AND i.pattern = p.host
        OR i.kind = 'domain' AND (p.host = i.pattern OR ends_with(p.host, '.' || i.pattern))
        OR i.kind = 'prefix' AND starts_with(p.host || '/' || trim(p.path, '/') || '/', i.pattern || '/')))
SELECT p.page_id, p.day, coalesce(m.list, 'none') AS verdict, m.kind, m.pattern, m.from_day, m.to_day
FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.r = 1
"""
