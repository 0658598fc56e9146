"""Raw feeds to cleaned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

import stargauge as sg
from stargauge.plans import reports as R
from stargauge.sources import payloads as P

from . import roles
from .registry import query, rounded, table

RANKED_SQL = f"""
WITH {roles.CONTRIBUTORS_SQL},
once AS (
  SELECT repo_full_name, coalesce(contributor_login, 'unknown_contributor') AS contributor_login, contributor_id,
         contributions, html_url, followers_url, snapshot_date,
         row_number() OVER (PARTITION BY repo_full_name, contributor_login, snapshot_date
                            ORDER BY contributions DESC NULLS LAST, contributor_id NULLS LAST, html_url) AS rn
  FROM contributors_raw
),
ranked AS (
  SELECT * EXCLUDE (rn),
         CAST(row_number() OVER (PARTITION BY repo_full_name ORDER BY contributions DESC NULLS LAST, contributor_login, html_url) AS INTEGER) AS contribution_rank,
         CASE WHEN contributor_login = 'unknown_contributor' THEN 'missing_login'
              WHEN contributions < 1 THEN 'invalid_contributions'
              WHEN contributor_id IS NULL THEN 'missing_id' ELSE 'valid' END AS data_quality_flag
  FROM once WHERE rn = 1
),
contributors AS (
  SELECT * EXCLUDE (total), contribution_rank <= 10 AS is_core_contributor,
         {roles.rounded_ratio('100 * contributions', 'total')} AS contribution_percentage
  FROM (SELECT *, sum(contributions) OVER (PARTITION BY repo_full_name) AS total FROM ranked WHERE data_quality_flag = 'valid')
)"""


@query(RANKED_SQL + "SELECT * FROM contributors")
def contributors_clean(spark, sf):
    return sg.clean_contributors(roles.contributors_raw(spark, sf))


@query(RANKED_SQL + """
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY repo_full_name ORDER BY contribution_rank) AS place FROM contributors)
WHERE place <= 5""")
def contributors_top_per_repo(spark, sf):
    return sg.clean_contributors(roles.contributors_raw(spark, sf), max_per_repo=5)


@query(RANKED_SQL + """
SELECT count(*) AS total_contributors, count(DISTINCT repo_full_name) AS total_repos,
       count(DISTINCT contributor_login) AS unique_contributors,
       count(*) FILTER (WHERE is_core_contributor) AS core_contributors
FROM contributors""")
def contributor_stats(spark, sf):
    return sg.contributor_stats(sg.clean_contributors(roles.contributors_raw(spark, sf)))


FLAGGED_SQL = f"""
WITH {roles.COMMITS_SQL},
once AS (
  SELECT *, lower(regexp_replace(author_email, '^\\s+|\\s+$', '', 'g')) AS email,
         row_number() OVER (PARTITION BY sha ORDER BY commit_date DESC NULLS LAST, repo_full_name, html_url) AS rn
  FROM commits_raw
),
flagged AS (
  SELECT repo_full_name, sha, commit_message, author_name, email AS author_email, commit_date AS commit_timestamp,
         strftime(commit_date, '%Y-%m-%d') AS commit_date_only, CAST(hour(commit_date) AS INTEGER) AS commit_hour,
         CAST(dayofweek(commit_date) + 1 AS INTEGER) AS commit_day_of_week, html_url, snapshot_date,
         CASE WHEN regexp_matches(lower(commit_message), '^feat[:(]') THEN 'feat'
              WHEN regexp_matches(lower(commit_message), '^fix[:(]') THEN 'fix'
              WHEN regexp_matches(lower(commit_message), '^docs[:(]') THEN 'docs'
              WHEN regexp_matches(lower(commit_message), '^refactor[:(]') THEN 'refactor'
              WHEN regexp_matches(lower(commit_message), '^test[:(]') THEN 'test'
              WHEN regexp_matches(lower(commit_message), '^chore[:(]') THEN 'chore' ELSE 'other' END AS commit_type,
         coalesce(regexp_matches(lower(author_name), 'bot|dependabot|renovate|github-actions'), FALSE)
           OR coalesce(regexp_matches(email, 'bot|noreply|automated'), FALSE) AS is_bot_commit,
         coalesce(regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}$'), FALSE) AS is_valid_email,
         CAST(length(commit_message) AS INTEGER) AS message_length,
         coalesce(starts_with(lower(commit_message), 'merge'), FALSE) AS is_merge_commit
  FROM once WHERE rn = 1
),
commits AS (
  SELECT *, CASE WHEN is_bot_commit THEN 'bot_commit' WHEN NOT is_valid_email THEN 'invalid_email'
                 WHEN message_length < 10 THEN 'short_message' ELSE 'valid' END AS data_quality_flag
  FROM flagged
)"""


def _day_text(df):
    return df.withColumn("commit_date_only", F.date_format("commit_date_only", "yyyy-MM-dd"))


@query(FLAGGED_SQL + "SELECT * FROM commits WHERE NOT is_bot_commit")
def commits_clean(spark, sf):
    return _day_text(sg.clean_commits(roles.commits_raw(spark, sf)))


@query(FLAGGED_SQL + "SELECT * FROM commits")
def commits_flagged(spark, sf):
    return _day_text(sg.flag_commits(roles.commits_raw(spark, sf)))


@query(FLAGGED_SQL + "SELECT * FROM commits WHERE NOT is_bot_commit ORDER BY commit_timestamp DESC NULLS LAST, sha LIMIT 300")
def newest_commits(spark, sf):
    return _day_text(sg.clean_commits(roles.commits_raw(spark, sf), limit=300))


@query(FLAGGED_SQL + """
SELECT count(*) AS total_commits, count(DISTINCT repo_full_name) AS total_repos,
       count(DISTINCT author_email) AS unique_authors, count(*) FILTER (WHERE is_merge_commit) AS merge_commits
FROM commits WHERE NOT is_bot_commit""")
def commit_stats(spark, sf):
    return sg.commit_stats(sg.clean_commits(roles.commits_raw(spark, sf)))


@query(f"WITH {roles.REPOS_SQL}, {roles.REPOS_CLEAN_SQL} SELECT * FROM repos")
def repos_summary(spark, sf):
    return sg.clean_repos(roles.repos_raw(spark, sf), roles.AS_OF)


@query(f"WITH {roles.REPOS_SQL}, {roles.REPOS_CLEAN_SQL} SELECT * FROM repos ORDER BY stars DESC NULLS LAST, name LIMIT 300")
def top_repos(spark, sf):
    return sg.clean_repos(roles.repos_raw(spark, sf), roles.AS_OF, limit=300)


@query(f"WITH {roles.REPOS_SQL}, {roles.REPOS_CLEAN_SQL} SELECT count(*) AS row_count FROM repos")
def repos_row_count(spark, sf):
    return sg.row_count(sg.clean_repos(roles.repos_raw(spark, sf), roles.AS_OF))


@query("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""")
def latest_order_per_customer(spark, sf):
    return sg.latest_per_key(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", [F.col("o_orderkey").desc()])


@query(f"WITH {roles.DOC_LANGUAGES_SQL}, {roles.language_summary_sql(roles.DOC_FAMILIES)} SELECT repo_full_name, CAST(total_bytes AS BIGINT) AS total_bytes FROM language_totals")
def language_totals(spark, sf):
    return sg.language_totals(roles.doc_languages(spark, sf))


@query(f"WITH {roles.BRAND_LANGUAGES_SQL}, {roles.language_summary_sql(roles.BRAND_FAMILIES)} SELECT * REPLACE (CAST(language_rank AS INTEGER) AS language_rank) FROM language_details")
def language_details(spark, sf):
    return sg.language_details(roles.brand_languages(spark, sf))


@query(f"WITH {roles.DOC_LANGUAGES_SQL}, {roles.language_summary_sql(roles.DOC_FAMILIES)} SELECT * FROM language_summary")
def language_summary(spark, sf):
    return sg.language_summary(roles.doc_languages(spark, sf), families=roles.DOC_FAMILIES)


@query(f"WITH {roles.BRAND_LANGUAGES_SQL}, {roles.language_summary_sql(roles.BRAND_FAMILIES)} SELECT * FROM language_summary")
def language_summary_wide(spark, sf):
    return sg.language_summary(roles.brand_languages(spark, sf), families=roles.BRAND_FAMILIES)


@query(f"""WITH {roles.BRAND_LANGUAGES_SQL}, {roles.language_summary_sql(roles.BRAND_FAMILIES)}
SELECT repo_full_name, place, language, coalesce(percentage, 0) AS percentage FROM (
  SELECT repo_full_name, 1 AS place, primary_language AS language, primary_language_pct AS percentage FROM language_summary
  UNION ALL SELECT repo_full_name, 2, secondary_language, secondary_language_pct FROM language_summary
  UNION ALL SELECT repo_full_name, 3, tertiary_language, tertiary_language_pct FROM language_summary)
WHERE language IS NOT NULL""")
def unpivot_top3(spark, sf):
    return R.language_breakdown(sg.language_summary(roles.brand_languages(spark, sf), families=roles.BRAND_FAMILIES))


# --- payload shaping ----------------------------------------------------------------------------


def _commit_payloads(spark, sf):
    """One API answer per user, with its events as an array of nested commit objects."""
    events = table(spark, sf, "events")
    author = F.struct(
        F.concat(F.lit("dev"), F.col("user_id").cast("string")).alias("name"),
        F.when(F.col("value") > 100, F.lit(None)).otherwise(F.lit("dev@example.com")).alias("email"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
    )
    commit = F.struct(
        F.col("event_id").cast("string").alias("sha"),
        F.struct(F.col("props").alias("message"), author.alias("author")).alias("commit"),
    )
    return events.select(
        F.when(F.col("event_type") == "signup", F.lit(None))
        .otherwise(F.concat(F.lit("user/"), F.col("user_id").cast("string"))).alias("full_name"),
        F.when(F.col("event_type") == "error", 404).when(F.col("value") < 1, 500).otherwise(200).alias("status"),
        F.to_json(F.array(commit)).alias("body"),
    )


@query("""
SELECT 'user/' || user_id AS repo_full_name, CAST(event_id AS VARCHAR) AS sha, props AS commit_message,
       'dev' || user_id AS author_name, CASE WHEN value > 100 THEN NULL ELSE 'dev@example.com' END AS author_email,
       strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS commit_date, CAST(NULL AS VARCHAR) AS html_url
FROM events WHERE event_type NOT IN ('signup', 'error') AND value >= 1""")
def flatten_nested(spark, sf):
    flat = P.flatten_commits(_commit_payloads(spark, sf))
    return flat.withColumn("commit_date", F.date_format("commit_date", "yyyy-MM-dd HH:mm:ss"))


@query("""
SELECT count(*) AS attempts, count(*) FILTER (WHERE event_type <> 'error' AND value >= 1) AS success_count,
       count(*) FILTER (WHERE event_type = 'error') AS missing_count,
       count(*) FILTER (WHERE event_type <> 'error' AND value < 1) AS error_count
FROM events WHERE event_type <> 'signup'""")
def extraction_tally(spark, sf):
    return P.extraction_tally(_commit_payloads(spark, sf))


@query("""
SELECT 'order/' || l_orderkey AS repo_full_name, 'dev-' || l_suppkey AS contributor_login, l_suppkey AS contributor_id,
       CAST(l_quantity AS BIGINT) AS contributions, CAST(NULL AS VARCHAR) AS html_url, CAST(NULL AS VARCHAR) AS followers_url
FROM lineitem""")
def flatten_contributors(spark, sf):
    """One answer per line item, with its supplier as the only contributor."""
    person = F.struct(
        F.concat(F.lit("dev-"), F.col("l_suppkey").cast("string")).alias("login"), F.col("l_suppkey").alias("id"),
        F.col("l_quantity").cast("long").alias("contributions"),
    )
    payloads = table(spark, sf, "lineitem").select(
        F.concat(F.lit("order/"), F.col("l_orderkey").cast("string")).alias("full_name"), F.lit(200).alias("status"),
        F.to_json(F.array(person)).alias("body"),
    )
    return P.flatten_contributors(payloads)


@query("""
SELECT 'doc/' || doc_id AS repo_full_name, 'README.md' AS name, CAST(n_chars AS BIGINT) AS size, text AS content, 'none' AS encoding
FROM documents""")
def flatten_readme(spark, sf):
    body = F.struct(
        F.lit("README.md").alias("name"), F.col("n_chars").alias("size"), F.col("text").alias("content"),
        F.lit("none").alias("encoding"), F.struct(F.lit("x").alias("self")).alias("_links"),
    )
    payloads = table(spark, sf, "documents").select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("full_name"), F.lit(200).alias("status"),
        F.to_json(body).alias("body"),
    )
    return P.flatten_readme(payloads).select("repo_full_name", "name", "size", "content", "encoding")


@query("""
SELECT 'doc/' || doc_id AS repo_full_name, unnest([lang, source]) AS language, unnest([n_chars, n_chars * 2]) AS bytes
FROM documents""")
def explode_map(spark, sf):
    sizes = F.map_from_arrays(F.array("lang", "source"), F.array(F.col("n_chars"), F.col("n_chars") * 2))
    payloads = table(spark, sf, "documents").select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("full_name"), F.lit(200).alias("status"),
        F.to_json(sizes).alias("body"),
    )
    return P.flatten_languages(payloads).drop("extracted_at")


@query("""
SELECT o_orderkey AS full_name, o_totalprice AS stargazers_count FROM orders WHERE o_totalprice > 5000
ORDER BY o_totalprice DESC, o_orderkey LIMIT 300""")
def candidates(spark, sf):
    repos = table(spark, sf, "orders").select(F.col("o_orderkey").alias("full_name"), F.col("o_totalprice").alias("stargazers_count"))
    return P.candidates(repos, 300)


@query("""
SELECT year(o_orderdate) * 10000 + 101 AS snapshot_date, count(*) AS row_count,
       count(DISTINCT o_custkey) AS repos, round(sum(o_totalprice), 2) AS stars
FROM orders GROUP BY 1""")
def snapshot_append(spark, sf):
    """One snapshot per year, stacked into one table; then figures per snapshot."""
    orders = table(spark, sf, "orders")
    dated = orders.withColumn("snapshot_date", (F.year("o_orderdate") * 10000 + 101).cast("long"))
    old = F.coalesce(F.col("snapshot_date") < 19980101, F.lit(False))
    stacked = sg.stack_snapshots([dated.where(old), dated.where(~old).drop("o_orderpriority")])
    return rounded(stacked.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("o_custkey").alias("repos"), F.sum("o_totalprice").alias("stars")
    ), 2)


@query("""
WITH stacked AS (
  SELECT p_brand, p_type, p_size, 20240107 AS snapshot_date FROM part
  UNION ALL SELECT p_brand, p_type, p_size + 1, 20240114 FROM part WHERE p_size > 10),
sums AS (SELECT p_brand AS repo_full_name, p_type AS language, sum(p_size) AS bytes FROM stacked
         WHERE snapshot_date = (SELECT max(snapshot_date) FROM stacked) GROUP BY 1, 2)
SELECT repo_full_name, language, bytes, row_number() OVER (PARTITION BY repo_full_name ORDER BY bytes DESC, language) AS language_rank
FROM sums""")
def languages_latest_snapshot(spark, sf):
    """Two stacked snapshots; without a date the languages are those of the latest."""
    part = table(spark, sf, "part").select(F.col("p_brand").alias("repo_full_name"), F.col("p_type").alias("language"), F.col("p_size").cast("long").alias("bytes"))
    first = part.withColumn("snapshot_date", F.lit(20240107).cast("long"))
    second = part.where("bytes > 10").withColumn("bytes", F.col("bytes") + 1).withColumn("snapshot_date", F.lit(20240114).cast("long"))
    return sg.language_details(sg.stack_snapshots([first, second])).drop("percentage")
