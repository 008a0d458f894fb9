"""URL filters: host-suffix and path-prefix expressions, hash-prefix equi-join, full digest check.

Native: SQL functions and one equi-join. Every URL is expanded into (host suffix, path prefix)
expressions; only lengths that occur among the rules are tried, so the fan-out is bounded by the
rules. Both sides meet on a 32-bit prefix of the expression's SHA-256; the full digest then confirms,
and the longest rule wins (longer host first, then longer path).

Results in odd cases: a null URL or one without ``://`` has an empty host and path and no rule; a null id keeps its row; very long
URLs are read as a whole; repeated rows are judged alike; an empty table gives no rows; without rules every verdict is the
method's default, allow; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The fixed rules of the query: (verdict, host, path).
PAGE_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Rules up to this many rows and bytes are broadcast; beyond either the join shuffles.
BROADCAST_RULES, BROADCAST_BYTES = 100_000, 32 << 20


def rules_frame(spark: SparkSession, rules=PAGE_RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def with_host_and_path(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host`` and ``path``: between the first ``://`` and ``/ ? #``; then up to ``?`` or ``#``."""
    rest = F.expr(f"case when instr(`{url_col}`, '://') > 0 then substring(`{url_col}`, instr(`{url_col}`, '://') + 3) else '' end")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    # Only A-Z are lower-cased: lower() would also fold other letters.
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return urls.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit("")))


def apply_rules(urls: DataFrame, rules: DataFrame, key: str, url_col: str = "url") -> DataFrame:
    """Return key, host, path, rule, verdict: one row for each row of ``urls``.

    Equal (host, path) pairs are looked up once. A rule ``(host, path)`` covers its host and all
    subdomains where the URL's path starts with the rule's path.
    """
    parts = with_host_and_path(urls.select(key, url_col), url_col).select(key, "host", "path")
    rules = rules.where("host is not null and path is not null").groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    shape = rules.select(F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars")).distinct()
    shape = shape.agg(F.collect_set("labels"), F.collect_set("chars"), F.lit(0)).first()  # lengths, not rules: few
    labels, chars = sorted(shape[0]), sorted(shape[1])
    if not labels:
        return parts.select(key, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    digest = lambda h, p: F.sha2(F.concat_ws("\x00", h, p), 256)
    listed = rules.select("verdict", F.concat("host", "path").alias("rule"), F.size(F.split("host", r"\.")).alias("depth"), F.length("path").alias("chars"), digest(F.col("host"), F.col("path")).alias("digest"))
    listed = listed.withColumn("short", F.substring("digest", 1, 8))
    size = listed.agg(F.count("*").alias("n"), F.sum(F.octet_length("rule") + 120).alias("b")).first()
    if size["n"] <= BROADCAST_RULES and (size["b"] or 0) <= BROADCAST_BYTES:
        listed = F.broadcast(listed)
    array = lambda xs: F.array(*[F.lit(x) for x in xs])
    places = parts.select("host", "path").distinct()
    names = F.split("host", r"\.")
    tried = places.withColumn("p__names", names).withColumn("p__labels", F.filter(array(labels), lambda n: n <= F.size("p__names")))
    tried = tried.withColumn("p__chars", F.filter(array(chars), lambda n: n <= F.length("path"))).where("host <> ''")
    tried = tried.withColumn("p__n", F.explode("p__labels")).withColumn("p__c", F.explode("p__chars"))
    suffix = F.expr("array_join(slice(p__names, size(p__names) - p__n + 1, p__n), '.')")
    tried = tried.select("host", "path", digest(suffix, F.expr("substring(path, 1, p__c)")).alias("p__digest"))
    tried = tried.withColumn("short", F.substring("p__digest", 1, 8))
    hit = tried.join(listed, "short").where("p__digest = digest")
    best = hit.groupBy("host", "path").agg(F.max(F.struct("depth", "chars", "rule", "verdict")).alias("best"))
    out = parts.join(best.withColumnsRenamed({"host": "p__host", "path": "p__path"}), (F.col("host") == F.col("p__host")) & (F.col("path") == F.col("p__path")), "left")
    return out.select(key, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict"))


def op7_query(spark, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page."""
    return apply_rules(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules_frame(spark), "page_id")


#: The same rows in DuckDB: every rule against every page, longest first.
OP7_SQL = r"""
with parts as (
  select page_id, case when coalesce(strpos(url, '://'), 0) > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), split as (
  select page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) as path from parts
), rules(verdict, rhost, rpath, rank) as (
  values ('allow', 'com', '/', 1), ('block', 'example.com', '/en/', 2), ('allow', 'www.example.com', '/en/', 3),
         ('block', 'net', '/es/', 1), ('block', 'net', '/fr/', 1)
), hits as (
  select page_id, max_by(rhost || rpath, rank) as rule, max_by(verdict, rank) as verdict from split, rules
  where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by page_id
)
select s.page_id, s.host, s.path, h.rule, coalesce(h.verdict, 'allow') as verdict from split s left join hits h on s.page_id = h.page_id
"""
