"""URL filters with DataFrame functions only.

Listed URLs are brought to a canonical form and held in a blocked Bloom filter: each key has one block of eight
64-bit words and sets one bit in each. Blocks are rows (block, w0 .. w7), built by a grouped bit-or. A URL whose bits
are all set in its block is a possible hit; only possible hits are shuffled to the exact hash join with the list,
which removes the filter's false positives (see bloom). A false positive rate never changes the result.

Host rules stand before the list: the longest rule (host and path together) that fits a URL decides.

Nulls: a null URL, or one without "://", has empty host and path, fits no rule and is never listed. Empty texts, very
long URLs and repeated rows are ordinary rows. Two rules of one length that both fit would tie; the one of the longer host
decides. Extra columns are dropped. An empty list allows all; no pages give an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.llm.bloom import build_filter, filter_blocks, with_possible
from strandmill.llm.shared import write_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Verdict, host, path.
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
#: Sites, endings and languages of the query's list.
LISTED_SITES = ["ads-track", "casino-win", "cheap-pills", "free-bets"]
LISTED_ENDINGS = ["example.com", "example.net", "example.org"]
LISTED_LANGUAGES = ["de", "en", "es", "fr"]
SALTS = 16
#: Rows of the salted list in one partition's hash table, at most a few times over.
HASHED_ROWS = 500_000


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What stands after the first ://, or nothing."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading www. or m., path without .html and closing slashes; scheme, query and fragment don't count. Null for an empty host."""
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, r"(\.html|/+)\z", "")))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; both null if none fits. rules is a short configured list."""
    rule = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] = RULES, n_listed: int | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and listed (whether the canonical URL is in the list; null where a rule decides).

    pages has page_id and url; listed has a column canonical, which may hold nulls and repeats. Pages that a rule
    decides need no look-up.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    judged = pages.select("page_id", host.alias("host"), path.alias("path")).withColumns({"rule": rule, "ruled": verdict})
    judged = judged.withColumn("canonical", F.when(F.col("ruled").isNull(), canonical(F.col("host"), F.col("path"))))
    # Stored once: counted, made into a filter and joined.
    wanted, _ = write_table(listed.select(F.col("canonical").alias("entry")).where("entry is not null").distinct(), "listed")
    blocks = filter_blocks(wanted.count() if n_listed is None else n_listed)
    seen = with_possible(judged, "canonical", build_filter(wanted, "entry", blocks), blocks, "possible")
    sure = seen.where(~F.col("possible")).withColumn("entry", F.lit(None).cast("string"))
    # One canonical URL may have a third of all rows: the exact join's large side is dealt by a salted key. The list is
    # the hashed side, in as many partitions as keep a partition's table small.
    salted = wanted.select("entry", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of"))
    hits = seen.where("possible").withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    parts = wanted.count() * SALTS // HASHED_ROWS + 1
    if parts > int(judged.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")):
        salted, hits = salted.repartition(parts, "entry", "of"), hits.repartition(parts, "canonical", "salt")
    exact = hits.join(salted.hint("shuffle_hash"), (F.col("canonical") == F.col("entry")) & (F.col("salt") == F.col("of")), "left").drop("salt", "of")
    out = sure.unionByName(exact)
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("entry").isNotNull(), "block").otherwise("allow")).alias("verdict"), F.when(F.col("ruled").isNull(), F.col("entry").isNotNull()).alias("listed"))


def listed_urls(labels: DataFrame) -> DataFrame:
    """The query's list, which doesn't depend on the pages: on every listed site, ending and language the number of each toxic
    document. Some have a page, most have none."""
    across = lambda names: F.explode(F.array(*map(F.lit, names)))
    rows = labels.where("toxic = 1 and doc_id is not null").select("doc_id").distinct()
    rows = rows.select("doc_id", across(LISTED_SITES).alias("site")).select("*", across(LISTED_ENDINGS).alias("ending")).select("*", across(LISTED_LANGUAGES).alias("lang"))
    return rows.select(F.concat("site", F.lit("."), "ending", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string")).alias("canonical"))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL, judged by the host rules and the list."""
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), listed_urls(spark.read.parquet(f"{sf_dir}/labels.parquet")))


OP1_SQL = r"""
WITH split AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
keyed AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html|/+)$', '') END AS canonical FROM parts),
rules(verdict, h, p) AS (
  VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
fits AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS ruled
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id),
list AS (
  SELECT DISTINCT site || '.' || ending || '/' || lang || '/' || doc_id AS canonical
  FROM labels, unnest(['ads-track', 'casino-win', 'cheap-pills', 'free-bets']) a(site), unnest(['example.com', 'example.net', 'example.org']) b(ending), unnest(['de', 'en', 'es', 'fr']) c(lang)
  WHERE toxic = 1 AND doc_id IS NOT NULL)
SELECT k.page_id, k.host, k.path, f.rule,
       coalesce(f.ruled, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN f.ruled IS NULL THEN l.canonical IS NOT NULL END AS listed
FROM keyed k LEFT JOIN fits f USING (page_id) LEFT JOIN list l ON k.canonical = l.canonical
"""
