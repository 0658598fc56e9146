"""Driver tables in the roles of the raw feeds, once as DataFrames and once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table

AS_OF = "2001-08-01"  # the day of the last order: repositories of that day are 0 days old
HOST = "https://host.example/"



def rounded_ratio(numerator: str, denominator: str) -> str:
    """SQL of a ratio of whole numbers to 2 digits, halves up, without a detour through binary fractions."""
    return f"((200 * CAST({numerator} AS HUGEINT) + {denominator}) // nullif(2 * {denominator}, 0)) / 100"


# --- contributors: part = repository, supplier = contributor, quantity - 1 = contributions -----

CONTRIBUTORS_SQL = f"""
contributors_raw AS (
  SELECT 'part/' || l_partkey AS repo_full_name,
         CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN NULL ELSE 'dev-' || l_suppkey END AS contributor_login,
         CASE WHEN l_tax = 0 THEN NULL ELSE l_suppkey END AS contributor_id,
         CAST(l_quantity AS BIGINT) - 1 AS contributions,
         '{HOST}' || l_orderkey || '/' || l_linenumber AS html_url,
         '{HOST}' || l_orderkey || '/followers' AS followers_url,
         CAST(20010801 AS BIGINT) AS snapshot_date
  FROM lineitem
)"""


def contributors_raw(spark: SparkSession, sf: str) -> DataFrame:
    url = F.concat(F.lit(HOST), F.col("l_orderkey").cast("string"))
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("part/"), F.col("l_partkey").cast("string")).alias("repo_full_name"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "N"), F.lit(None))
        .otherwise(F.concat(F.lit("dev-"), F.col("l_suppkey").cast("string"))).alias("contributor_login"),
        F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(F.col("l_suppkey")).alias("contributor_id"),
        (F.col("l_quantity").cast("long") - 1).alias("contributions"),
        F.concat(url, F.lit("/"), F.col("l_linenumber").cast("string")).alias("html_url"),
        F.concat(url, F.lit("/followers")).alias("followers_url"),
        F.lit(20010801).cast("long").alias("snapshot_date"),
    )


# --- commits: user = repository, two events per commit id, messages from documents -------------

COMMITS_SQL = f"""
commits_raw AS (
  SELECT 'user/' || user_id AS repo_full_name,
         'c' || (event_id // 2) AS sha,
         CASE event_type
           WHEN 'click' THEN 'feat: ' || props || coalesce(' ' || text, '')
           WHEN 'view' THEN 'Fix(core): ' || props || coalesce(' ' || text, '')
           WHEN 'purchase' THEN 'Merge pull request ' || props
           WHEN 'error' THEN 'oops'
           ELSE text END AS commit_message,
         CASE WHEN value < 1 THEN 'dependabot[bot]' WHEN value < 2 THEN NULL
              ELSE 'dev' || regexp_extract(props, '[0-9]+') END AS author_name,
         CASE WHEN value > 200 THEN 'x@NoReply.example' WHEN value > 120 THEN 'no-at-sign' WHEN value > 90 THEN NULL
              ELSE ' Dev' || regexp_extract(props, '[0-9]+') || '@Example.com' || chr(9) END AS author_email,
         ts AS commit_date,
         '{HOST}c/' || event_id AS html_url,
         CAST(20240131 AS BIGINT) AS snapshot_date
  FROM events LEFT JOIN documents ON doc_id = event_id
)"""


def commits_raw(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "documents").select("doc_id", "text")
    events = table(spark, sf, "events")
    kind, value, number = F.col("event_type"), F.col("value"), F.regexp_extract("props", "[0-9]+", 0)
    tail = F.coalesce(F.concat(F.lit(" "), F.col("text")), F.lit(""))
    return events.join(texts, F.col("doc_id") == F.col("event_id"), "left").select(
        F.concat(F.lit("user/"), F.col("user_id").cast("string")).alias("repo_full_name"),
        F.concat(F.lit("c"), F.floor(F.col("event_id") / 2).cast("string")).alias("sha"),
        F.when(kind == "click", F.concat(F.lit("feat: "), "props", tail))
        .when(kind == "view", F.concat(F.lit("Fix(core): "), "props", tail))
        .when(kind == "purchase", F.concat(F.lit("Merge pull request "), "props"))
        .when(kind == "error", F.lit("oops"))
        .otherwise(F.col("text")).alias("commit_message"),
        F.when(value < 1, F.lit("dependabot[bot]")).when(value < 2, F.lit(None))
        .otherwise(F.concat(F.lit("dev"), number)).alias("author_name"),
        F.when(value > 200, F.lit("x@NoReply.example")).when(value > 120, F.lit("no-at-sign")).when(value > 90, F.lit(None))
        .otherwise(F.concat(F.lit(" Dev"), number, F.lit("@Example.com\t"))).alias("author_email"),
        F.col("ts").alias("commit_date"),
        F.concat(F.lit(HOST + "c/"), F.col("event_id").cast("string")).alias("html_url"),
        F.lit(20240131).cast("long").alias("snapshot_date"),
    )


# --- repositories: customer = repository, each order = one sighting of it ----------------------

REPOS_SQL = f"""
repos_raw AS (
  SELECT 'cust/' || c_custkey AS full_name,
         CAST(floor(o_totalprice) AS BIGINT) AS stargazers_count,
         CAST(floor(abs(c_acctbal)) AS BIGINT) AS forks_count,
         nullif(c_mktsegment, 'MACHINERY') AS language,
         nullif(o_orderpriority, '5-LOW') AS description,
         '{HOST}' || o_orderkey AS html_url,
         o_orderdate AS updated_at, CAST(20010801 AS BIGINT) AS snapshot_date, o_orderdate AS created_at,
         o_orderkey AS watchers_count, CAST(c_nationkey AS BIGINT) AS open_issues_count
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey
)"""

REPOS_CLEAN_SQL = f"""
repos AS (
  SELECT full_name AS name, stargazers_count AS stars, forks_count AS forks,
         coalesce(language, 'Unknown') AS language,
         coalesce(description, 'No description provided') AS description, html_url AS url,
         updated_at, snapshot_date, created_at, watchers_count AS watchers, open_issues_count AS open_issues,
         date_diff('day', CAST(created_at AS DATE), DATE '{AS_OF}') AS repo_age_days,
         {rounded_ratio('stargazers_count', "date_diff('day', CAST(created_at AS DATE), DATE '" + AS_OF + "')")} AS stars_per_day
  FROM (SELECT *, row_number() OVER (PARTITION BY full_name ORDER BY updated_at DESC NULLS LAST, html_url) AS rn FROM repos_raw)
  WHERE rn = 1
)"""


def repos_raw(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "customer").join(table(spark, sf, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select(
        F.concat(F.lit("cust/"), F.col("c_custkey").cast("string")).alias("full_name"),
        F.floor("o_totalprice").cast("long").alias("stargazers_count"),
        F.floor(F.abs("c_acctbal")).cast("long").alias("forks_count"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("language"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("description"),
        F.concat(F.lit(HOST), F.col("o_orderkey").cast("string")).alias("html_url"),
        F.col("o_orderdate").alias("updated_at"),
        F.lit(20010801).cast("long").alias("snapshot_date"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderkey").alias("watchers_count"),
        F.col("c_nationkey").cast("long").alias("open_issues_count"),
    )


# --- languages: either source and language of documents, or customer and brand of what it bought

DOC_LANGUAGES_SQL = """
languages_raw AS (SELECT source AS repo_full_name, lang AS language, n_chars AS bytes FROM documents)"""

BRAND_LANGUAGES_SQL = """
languages_raw AS (
  SELECT 'cust/' || o_custkey AS repo_full_name, p_brand AS language, CAST(l_quantity AS BIGINT) AS bytes
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""

DOC_FAMILIES = {"has_germanic": ["en", "de"], "has_romance": ["fr", "es"], "has_other": ["xx"]}
BRAND_FAMILIES = {
    "has_javascript": ["Brand#1", "Brand#2"],
    "has_compiled_language": ["Brand#3", "Brand#4", "Brand#5"],
}


def doc_languages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("source").alias("repo_full_name"), F.col("lang").alias("language"), F.col("n_chars").alias("bytes")
    )


def bought(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with the customer's repository name."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("cust/"), F.col("o_custkey").cast("string")).alias("repo_full_name"))
    return table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def brand_languages(spark: SparkSession, sf: str) -> DataFrame:
    brands = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("language"))
    return bought(spark, sf).join(brands, F.col("l_partkey") == F.col("p_partkey")).select(
        "repo_full_name", "language", F.col("l_quantity").cast("long").alias("bytes")
    )


def language_summary_sql(families: dict[str, list[str]]) -> str:
    flags = ",\n".join(
        f"count(*) FILTER (WHERE language IN ({', '.join(repr(x) for x in names)})) > 0 AS {flag}"
        for flag, names in families.items()
    )
    return f"""
language_sums AS (SELECT repo_full_name, language, CAST(sum(bytes) AS BIGINT) AS bytes FROM languages_raw GROUP BY 1, 2),
language_totals AS (SELECT repo_full_name, sum(bytes) AS total_bytes FROM language_sums GROUP BY 1),
language_details AS (
  SELECT s.repo_full_name, s.language, s.bytes, {rounded_ratio('100 * s.bytes', 'total_bytes')} AS percentage,
         row_number() OVER (PARTITION BY s.repo_full_name ORDER BY s.bytes DESC, s.language) AS language_rank
  FROM language_sums s JOIN language_totals t ON s.repo_full_name = t.repo_full_name
),
language_summary AS (
  SELECT repo_full_name, count(DISTINCT language) AS language_count,
         max(CASE WHEN language_rank = 1 THEN language END) AS primary_language,
         max(CASE WHEN language_rank = 1 THEN percentage END) AS primary_language_pct,
         max(CASE WHEN language_rank = 2 THEN language END) AS secondary_language,
         max(CASE WHEN language_rank = 2 THEN percentage END) AS secondary_language_pct,
         max(CASE WHEN language_rank = 3 THEN language END) AS tertiary_language,
         max(CASE WHEN language_rank = 3 THEN percentage END) AS tertiary_language_pct,
         string_agg(language, ',' ORDER BY language_rank) FILTER (WHERE language_rank <= 5) AS top_5_languages,
         CAST(sum(bytes) AS BIGINT) AS total_bytes,
         round(max(CASE WHEN language_rank = 1 THEN percentage END)
               - coalesce(max(CASE WHEN language_rank = 2 THEN percentage END), 0), 2) AS language_dominance_gap,
         count(*) FILTER (WHERE percentage > 5) AS languages_above_5_percent,
         count(*) FILTER (WHERE percentage > 10) AS languages_above_10_percent,
         count(*) FILTER (WHERE bytes > 1000) AS languages_above_1000_bytes,
         min(percentage) AS smallest_language_pct, max(percentage) AS largest_language_pct,
         {flags}
  FROM language_details GROUP BY repo_full_name
)"""


# --- the report table: one row per customer ----------------------------------------------------

READY_SQL = f"""
order_facts AS (
  SELECT o_custkey, CAST(floor(max(o_totalprice)) AS BIGINT) AS stars_count, count(*) AS total_commits,
         count(DISTINCT o_orderstatus || o_orderpriority) AS total_contributors,
         count(DISTINCT o_orderpriority) AS language_count,
         date_diff('day', CAST(min(o_orderdate) AS DATE), DATE '{AS_OF}') AS repo_age_days
  FROM orders GROUP BY o_custkey
),
ready AS (
  SELECT 'cust/' || c_custkey AS repo_name, stars_count, CAST(floor(abs(c_acctbal)) AS BIGINT) AS forks_count,
         total_commits, total_contributors, repo_age_days * 2 AS repo_age_days,
         stars_count / nullif(repo_age_days, 0) AS stars_per_day, language_count,
         total_commits / nullif(total_contributors, 0) AS commits_per_contributor,
         floor(abs(c_acctbal)) / nullif(stars_count, 0) AS forks_per_star,
         n_name AS primary_language, nullif(c_mktsegment, 'MACHINERY') AS category,
         CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 2500 THEN 'beginner' WHEN c_acctbal < 5000 THEN 'intermediate'
              WHEN c_acctbal < 8000 THEN 'advanced' ELSE 'expert' END AS complexity_level,
         c_nationkey AS cluster
  FROM customer LEFT JOIN order_facts ON o_custkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
)"""


def ready(spark: SparkSession, sf: str) -> DataFrame:
    from stargauge.functions.numbers import age_days, ratio

    facts = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.floor(F.max("o_totalprice")).cast("long").alias("stars_count"),
        F.count(F.lit(1)).alias("total_commits"),
        F.count_distinct(F.concat("o_orderstatus", "o_orderpriority")).alias("total_contributors"),
        F.count_distinct("o_orderpriority").alias("language_count"),
        age_days(AS_OF, F.min("o_orderdate")).alias("_days"),
    )
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    balance = F.col("c_acctbal")
    rows = (
        table(spark, sf, "customer")
        .join(facts, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    )
    return rows.select(
        F.concat(F.lit("cust/"), F.col("c_custkey").cast("string")).alias("repo_name"),
        "stars_count",
        F.floor(F.abs(balance)).cast("long").alias("forks_count"),
        "total_commits",
        "total_contributors",
        (F.col("_days") * 2).alias("repo_age_days"),
        ratio(F.col("stars_count"), F.col("_days")).alias("stars_per_day"),
        "language_count",
        ratio(F.col("total_commits"), F.col("total_contributors")).alias("commits_per_contributor"),
        ratio(F.floor(F.abs(balance)), F.col("stars_count")).alias("forks_per_star"),
        F.col("n_name").alias("primary_language"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("category"),
        F.when(balance < 0, F.lit(None)).when(balance < 2500, "beginner").when(balance < 5000, "intermediate")
        .when(balance < 8000, "advanced").otherwise("expert").alias("complexity_level"),
        F.col("c_nationkey").alias("cluster"),
    )


CATEGORIES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
LEVELS = ["beginner", "intermediate", "advanced"]

# --- parts as repositories with lists ----------------------------------------------------------

PARTS_SQL = """
parts AS (
  SELECT p_partkey AS repo_name, p_type AS category, p_brand AS primary_language, string_split(p_name, ' ') AS use_cases,
         p_name, p_size AS stars_count, p_retailprice
  FROM part
)"""


def parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("repo_name"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("primary_language"), F.split("p_name", " ").alias("use_cases"),
        "p_name", F.col("p_size").alias("stars_count"), "p_retailprice",
    )
