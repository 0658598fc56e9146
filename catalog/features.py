"""Feature tables, encoding, scaling, grouping and text measures."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

import stargauge as sg
from stargauge.functions import text as X
from stargauge.operators import enrich as EN
from stargauge.plans import features as FE
from stargauge.plans import reports as R

from . import roles
from .registry import query, rounded, table

# --- per-repository features --------------------------------------------------------------------


def _order_commits(spark, sf):
    return table(spark, sf, "orders").select(
        F.concat(F.lit("cust/"), F.col("o_custkey").cast("string")).alias("repo_full_name"),
        F.length("o_orderpriority").alias("message_length"),
        (F.col("o_orderstatus") == "F").alias("is_merge_commit"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_bot_commit"),
    )


def _order_contributors(spark, sf):
    sums = roles.bought(spark, sf).groupBy("repo_full_name", F.col("l_suppkey").alias("contributor_login")).agg(
        F.sum("l_quantity").cast("long").alias("contributions")
    )
    return sg.rank_and_share(sums, ["repo_full_name"], "contributions", ["contributor_login"], core="is_core_contributor")


FEATURES_SQL = f"""
WITH {roles.REPOS_SQL}, {roles.REPOS_CLEAN_SQL}, {roles.BRAND_LANGUAGES_SQL}, {roles.language_summary_sql(roles.BRAND_FAMILIES)},
commits AS (
  SELECT 'cust/' || o_custkey AS repo_full_name,
         count(*) FILTER (WHERE o_orderpriority <> '1-URGENT') AS total_commits,
         avg(length(o_orderpriority)) FILTER (WHERE o_orderpriority <> '1-URGENT') AS avg_message_length,
         avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) FILTER (WHERE o_orderpriority <> '1-URGENT') AS merge_commit_ratio,
         avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS bot_commit_ratio
  FROM orders GROUP BY 1
),
people AS (
  SELECT *, row_number() OVER (PARTITION BY repo_full_name ORDER BY contributions DESC, login) AS place FROM (
    SELECT 'cust/' || o_custkey AS repo_full_name, l_suppkey AS login, CAST(sum(l_quantity) AS BIGINT) AS contributions
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
),
contributors AS (
  SELECT repo_full_name, count(DISTINCT login) AS total_contributors, avg(contributions) AS avg_contributions_per_person,
         avg(CASE WHEN place <= 10 THEN 1 ELSE 0 END) AS core_contributor_ratio
  FROM people GROUP BY 1
),
features AS (
  SELECT r.name AS repo_name, r.url AS repo_url, r.language AS main_language, r.stars AS stars_count, r.forks AS forks_count,
         r.watchers, r.open_issues, r.repo_age_days, r.stars_per_day,
         coalesce(c.total_commits, 0) AS total_commits, coalesce(c.avg_message_length, 0) AS avg_message_length,
         coalesce(c.merge_commit_ratio, 0) AS merge_commit_ratio, coalesce(c.bot_commit_ratio, 0) AS bot_commit_ratio,
         coalesce(p.total_contributors, 0) AS total_contributors,
         coalesce(p.avg_contributions_per_person, 0) AS avg_contributions_per_person,
         coalesce(p.core_contributor_ratio, 0) AS core_contributor_ratio,
         coalesce(l.primary_language, r.language) AS primary_language, coalesce(l.primary_language_pct, 0.0) AS primary_language_pct,
         coalesce(l.language_count, 0) AS language_count, coalesce(l.languages_above_10_percent, 0) AS languages_above_10_percent,
         coalesce(l.has_javascript, FALSE) AS has_javascript, coalesce(l.has_compiled_language, FALSE) AS has_compiled_language,
         c.total_commits / nullif(p.total_contributors, 0) AS commits_per_contributor, r.forks / nullif(r.stars, 0) AS forks_per_star
  FROM repos r LEFT JOIN commits c ON r.name = c.repo_full_name LEFT JOIN contributors p ON r.name = p.repo_full_name
       LEFT JOIN language_summary l ON r.name = l.repo_full_name
)
SELECT * REPLACE (round(avg_message_length, 6) AS avg_message_length, round(merge_commit_ratio, 6) AS merge_commit_ratio,
  round(bot_commit_ratio, 6) AS bot_commit_ratio, round(avg_contributions_per_person, 6) AS avg_contributions_per_person,
  round(core_contributor_ratio, 6) AS core_contributor_ratio, round(commits_per_contributor, 6) AS commits_per_contributor,
  round(forks_per_star, 6) AS forks_per_star, round(stars_per_day, 6) AS stars_per_day,
  round(primary_language_pct, 6) AS primary_language_pct) FROM features"""


@query(FEATURES_SQL)
def repo_features(spark, sf):
    return rounded(sg.repo_features(
        sg.clean_repos(roles.repos_raw(spark, sf), roles.AS_OF),
        _order_commits(spark, sf),
        _order_contributors(spark, sf),
        sg.language_summary(roles.brand_languages(spark, sf), families=roles.BRAND_FAMILIES),
    ))


@query("""
SELECT doc_id AS repo_name, source AS main_language, lang AS primary_language, n_chars AS stars_count, quality, toxic
FROM documents LEFT JOIN labels USING (doc_id)""")
def ml_ready(spark, sf):
    documents = table(spark, sf, "documents").select(
        F.col("doc_id").alias("repo_name"), F.col("source").alias("main_language"),
        F.col("lang").alias("primary_language"), F.col("n_chars").alias("stars_count"),
    )
    return sg.ml_ready(documents, table(spark, sf, "labels").withColumnRenamed("doc_id", "repo_name"))


# --- encoding and scaling -----------------------------------------------------------------------


@query("""
SELECT p_partkey, coalesce(b.code, 0) AS p_brand_label, coalesce(t.code, 0) AS p_type_label, coalesce(n.code, 0) AS p_name_label
FROM part
LEFT JOIN (SELECT p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) AS INTEGER) AS code FROM (SELECT DISTINCT p_brand FROM part)) b USING (p_brand)
LEFT JOIN (SELECT p_type, CAST(dense_rank() OVER (ORDER BY p_type) AS INTEGER) AS code FROM (SELECT DISTINCT p_type FROM part)) t USING (p_type)
LEFT JOIN (SELECT p_name, CAST(dense_rank() OVER (ORDER BY p_name) AS INTEGER) AS code FROM (SELECT DISTINCT p_name FROM part)) n USING (p_name)""")
def label_encode(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    return sg.label_encode(rows, ["p_brand", "p_type", "p_name"])


@query(f"""
WITH {roles.READY_SQL}
SELECT event_id, user_id, value, CASE WHEN value > 50 THEN 1 ELSE 0 END AS is_large,
       CAST(floor(epoch(ts)) AS BIGINT) AS ts,
       CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS event_type_label,
       coalesce(code, 0) AS k_label
FROM events LEFT JOIN (
  SELECT k, CAST(row_number() OVER (ORDER BY k) AS INTEGER) AS code FROM (
    SELECT DISTINCT CASE WHEN value > 50 THEN NULL ELSE regexp_extract(props, '[0-9]+') END AS k FROM events) WHERE k IS NOT NULL) c
  ON c.k = CASE WHEN value > 50 THEN NULL ELSE regexp_extract(props, '[0-9]+') END""")
def encode_numeric(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", "user_id", "value", (F.col("value") > 50).alias("is_large"), "ts", "event_type", "props",
        F.when(F.col("value") <= 50, F.regexp_extract("props", "[0-9]+", 0)).alias("k"),
    )
    return sg.encode_numeric(rows, "event_id", exclude=["props"])


@query("""
SELECT p_partkey, round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_pop(p_size) FROM part), 6) AS p_size,
       round((p_retailprice - (SELECT avg(p_retailprice) FROM part)) / (SELECT stddev_pop(p_retailprice) FROM part), 6) AS p_retailprice,
       0.0::DOUBLE AS constant
FROM part""")
def standardise(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", F.lit(7).alias("constant"))
    return rounded(sg.standardise(rows, ["p_size", "p_retailprice", "constant"]), 6)


# --- grouping -----------------------------------------------------------------------------------


def _clustered(spark, sf):
    return R.clustered(roles.ready(spark, sf).drop("cluster"))


@query()
def kmeans_assign(spark, sf):
    return rounded(_clustered(spark, sf).select("repo_name", "cluster", "cluster_name", "stars_count", "forks_count"))


@query()
def kmeans_embeddings(spark, sf):
    """Groups of the embedding vectors."""
    rows = table(spark, sf, "embeddings").select("vec_id", "label", array_to_vector("embedding").alias("vector"))
    return sg.kmeans_vectors(rows, "vector").select("vec_id", "label", "cluster")


@query()
def cluster_summary(spark, sf):
    return rounded(sg.group_means(_clustered(spark, sf), "cluster", ["stars_count", "forks_count", "total_commits", "repo_age_days"]))


# Customers in four groups far apart on two measures, with a constant third; each group is spread by the customer's key.
_PLANTED_SQL = """planted AS (SELECT c_custkey, c_nationkey % 4 AS planted, 40000 - 10000 * (c_nationkey % 4) + c_custkey % 100 AS stars_count,
  CAST(CASE WHEN c_nationkey % 2 = 0 THEN 500 ELSE 9000 END + c_custkey % 37 AS DOUBLE) AS forks_count, 7 AS watchers FROM customer)"""


def _planted(spark, sf):
    group = F.col("c_nationkey") % 4
    rows = table(spark, sf, "customer").select(
        "c_custkey", group.alias("planted"), (40000 - 10000 * group + F.col("c_custkey") % 100).alias("stars_count"),
        (F.when(F.col("c_nationkey") % 2 == 0, 500).otherwise(9000) + F.col("c_custkey") % 37).cast("double").alias("forks_count"),
        F.lit(7).alias("watchers"),
    )
    return sg.kmeans(rows, ["stars_count", "forks_count", "watchers"])


@query(f"WITH {_PLANTED_SQL} SELECT c_custkey, planted, stars_count, planted AS cluster FROM planted")
def kmeans_planted(spark, sf):
    """Ten restarts find groups that are there; ids fall by mean stars, as the groups do."""
    return _planted(spark, sf).select("c_custkey", "planted", "stars_count", "cluster")


@query(f"""WITH {_PLANTED_SQL}
SELECT planted AS cluster, round(avg(stars_count), 6) AS stars_count, round(avg(forks_count), 6) AS forks_count, round(avg(watchers), 6) AS watchers
FROM planted GROUP BY planted""")
def kmeans_planted_means(spark, sf):
    return rounded(sg.group_means(_planted(spark, sf), "cluster", ["stars_count", "forks_count", "watchers"]))


MEANS = ["stars_count", "forks_count", "total_commits", "total_contributors", "stars_per_day", "language_count", "commits_per_contributor"]


@query(f"WITH {roles.READY_SQL} SELECT cluster, {', '.join(f'round(avg({c}), 6) AS {c}' for c in MEANS)} FROM ready GROUP BY cluster")
def group_means(spark, sf):
    return rounded(sg.group_means(roles.ready(spark, sf), "cluster", MEANS))


@query(f"WITH {roles.READY_SQL} SELECT cluster, count(*) AS repos, round(avg(stars_count), 6) AS avg_stars FROM ready GROUP BY cluster")
def cluster_sizes(spark, sf):
    rows = roles.ready(spark, sf).withColumn("cluster_name", F.lit("x"))
    return rounded(R.cluster_sizes(rows).drop("cluster_name"))


@query(f"""
WITH {roles.READY_SQL}
SELECT cluster, count(*) AS repos, CAST(floor(avg(stars_count)) AS BIGINT) AS avg_stars, CAST(floor(avg(forks_count)) AS BIGINT) AS avg_forks,
       CAST(floor(avg(total_commits)) AS BIGINT) AS avg_commits, CAST(floor(avg(total_contributors)) AS BIGINT) AS avg_contributors,
       round_even(avg(repo_age_days) / 365, 1) AS avg_age_years, round_even(avg(stars_per_day), 2) AS avg_stars_per_day,
       round_even(avg(language_count), 1) AS avg_languages,
       CASE cluster WHEN 0 THEN 'Cluster 0: High Activity' WHEN 1 THEN 'Cluster 1: Growing Projects' WHEN 2 THEN 'Cluster 2: Mature Repos'
                    WHEN 3 THEN 'Cluster 3: Niche Projects' ELSE 'Cluster ' || cluster END AS cluster_label
FROM ready GROUP BY cluster""")
def cluster_comparison(spark, sf):
    return R.cluster_comparison(roles.ready(spark, sf))


@query(f"""
WITH {roles.READY_SQL}
SELECT cluster, count(*) AS repos, CAST(sum(stars_count) AS BIGINT) AS stars_count, CAST(sum(total_commits) AS BIGINT) AS total_commits,
       CAST(sum(total_contributors) AS BIGINT) AS total_contributors FROM ready GROUP BY cluster""")
def cluster_totals(spark, sf):
    return R.cluster_totals(roles.ready(spark, sf))


@query(f"WITH {roles.READY_SQL} SELECT count(DISTINCT cluster) AS clusters FROM ready")
def cluster_count(spark, sf):
    return R.cluster_count(roles.ready(spark, sf))


@query(f"""
WITH {roles.READY_SQL}
SELECT cluster, repo_name, stars_count, forks_count, total_commits, total_contributors, language_count,
       round_even(stars_per_day, 2) AS stars_per_day
FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY stars_count DESC NULLS LAST, repo_name) AS place FROM ready)
WHERE place <= 20""")
def cluster_top_repos(spark, sf):
    return R.cluster_top_repos(roles.ready(spark, sf))


@query("""
WITH span AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
binned AS (SELECT least(floor((value - lo) / ((hi - lo) / 20)), 19) AS bin, lo, (hi - lo) / 20 AS w FROM events, span)
SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n, round(min(lo + w * bin), 6) AS lower, round(min(lo + w * (bin + 1)), 6) AS upper
FROM binned GROUP BY bin""")
def histogram_20(spark, sf):
    return rounded(sg.histogram(table(spark, sf, "events"), "value", 20))


@query(f"""
WITH {roles.READY_SQL},
span AS (SELECT cluster, min(stars_count) AS lo, max(stars_count) AS hi FROM ready GROUP BY cluster),
binned AS (SELECT cluster, least(coalesce(floor((stars_count - lo) / nullif((hi - lo) / 20, 0)), 0), 19) AS bin, lo, (hi - lo) / 20 AS w
           FROM ready JOIN span USING (cluster) WHERE stars_count IS NOT NULL)
SELECT cluster, CAST(bin AS INTEGER) AS bin, count(*) AS n, round(min(lo + w * bin), 6) AS lower, round(min(lo + w * (bin + 1)), 6) AS upper
FROM binned GROUP BY cluster, bin""")
def cluster_histograms(spark, sf):
    return rounded(R.cluster_histograms(roles.ready(spark, sf), "stars_count"))


_PROFILED = ["value", "user_id", "event_id"]


@query("WITH o AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _PROFILED) + " FROM events),\n"
       + "g AS (SELECT event_type, " + ", ".join(f"avg({c}) AS g_{c}" for c in _PROFILED) + " FROM events GROUP BY event_type)\n"
       + "\nUNION ALL\n".join(
           f"SELECT event_type, '{c}' AS feature, round(g_{c}, 6) AS group_avg, round(m_{c}, 6) AS overall_avg,"
           f" round(CASE WHEN m_{c} > 0 THEN (g_{c} - m_{c}) / m_{c} * 100 ELSE 0 END, 6) AS difference_pct,"
           f" round(CASE WHEN s_{c} > 0 THEN (g_{c} - m_{c}) / s_{c} ELSE 0 END, 6) AS z_score FROM g, o" for c in _PROFILED))
def group_profile_z(spark, sf):
    profile = sg.group_profile(table(spark, sf, "events"), "event_type", _PROFILED)
    return rounded(sg.by_distinctness(profile, "event_type"))


# --- README text --------------------------------------------------------------------------------

# Word boundaries spelled out, because DuckDB's own know ASCII letters only.
_PRE, _POST = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
_SECTIONS_SQL = ",\n".join(
    f"regexp_matches(lower(text), '{pattern}') AS {flag}"
    for flag, pattern in {
        "has_installation": f"{_PRE}(install(ation|ing)?|setup|getting started){_POST}",
        "has_usage": f"{_PRE}(usage|how to use|examples?|quick ?start){_POST}",
        "has_contributing": f"{_PRE}contribut(e|ing|ions?|ors?){_POST}",
        "has_license": f"{_PRE}licen[cs]e",
        "has_tests": f"{_PRE}(tests?|testing){_POST}",
        "has_documentation": f"{_PRE}(documentation|docs){_POST}",
    }.items()
)


_METRICS_SQL = f"""
       CAST(length(text) AS INTEGER) AS content_length,
       CAST(len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) AS INTEGER) AS word_count_estimate,
       CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS INTEGER) AS line_count,
       CAST(len(regexp_extract_all(text, '(?m)^#{{1,6}}\\s')) AS INTEGER) AS header_count,
       CAST(len(regexp_extract_all(text, '(?m)^```')) // 2 AS INTEGER) AS code_block_count,
       CAST(len(regexp_extract_all(text, '\\[[^\\]]*\\]\\([^)]*\\)')) - len(regexp_extract_all(text, '!\\[[^\\]]*\\]\\([^)]*\\)')) AS INTEGER) AS link_count,
       CAST(len(regexp_extract_all(text, '!\\[[^\\]]*\\]\\([^)]*\\)')) AS INTEGER) AS image_count,
       {_SECTIONS_SQL},
       regexp_matches(lower(text), '!\\[[^\\]]*\\]\\([^)]*(badge|shields\\.io)[^)]*\\)') AS has_badges,
       left(text, 500) AS content_preview"""


@query(f"SELECT doc_id AS repo_full_name, {_METRICS_SQL} FROM documents")
def readme_summary(spark, sf):
    return FE.readme_features(table(spark, sf, "documents"), "doc_id", "text")


@query(f"""
WITH markup AS (
  SELECT CAST(page_id AS VARCHAR) AS repo_full_name, '# ' || url || chr(10) || '## Usage' || chr(10) || '```' || chr(10) || 'run' || chr(10)
         || '```' || chr(10) || '[home](' || url || ')' || chr(10) || '![badge](https://img.shields.io/x)' || chr(10) || html AS text
  FROM pages)
SELECT repo_full_name, 'README.md' AS readme_filename, {_METRICS_SQL} FROM markup""")
def readme_summary_encoded(spark, sf):
    """The same measures through the raw feed: base64 bodies that hold markup."""
    pages = table(spark, sf, "pages")
    markup = F.concat(
        F.lit("# "), F.col("url"), F.lit("\n## Usage\n```\nrun\n```\n[home]("), F.col("url"),
        F.lit(")\n![badge](https://img.shields.io/x)\n"), F.col("html"),
    )
    raw = pages.select(
        F.col("page_id").cast("string").alias("repo_full_name"), F.lit("README.md").alias("name"),
        F.base64(F.encode(markup, "UTF-8")).alias("content"), F.lit("base64").alias("encoding"),
    )
    return sg.readme_summary(raw)


_PRESENT = "(has_installation::INT + has_usage::INT + has_contributing::INT + has_license::INT + has_tests::INT + has_documentation::INT)"


@query(f"""
WITH flags AS (SELECT doc_id, {_SECTIONS_SQL} FROM documents)
SELECT doc_id AS repo_full_name, {_PRESENT} AS sections_present, 6 AS total_sections, round({_PRESENT} / 6 * 100, 6) AS completeness_pct,
       concat_ws(', ', CASE WHEN NOT has_installation THEN 'Installation' END, CASE WHEN NOT has_usage THEN 'Usage' END,
                 CASE WHEN NOT has_contributing THEN 'Contributing' END, CASE WHEN NOT has_license THEN 'License' END,
                 CASE WHEN NOT has_tests THEN 'Tests' END, CASE WHEN NOT has_documentation THEN 'Documentation' END) AS missing_sections
FROM flags""")
def doc_completeness(spark, sf):
    summary = FE.readme_features(table(spark, sf, "documents"), "doc_id", "text")
    out = sg.doc_completeness(summary)
    return rounded(out.withColumn("missing_sections", F.array_join("missing_sections", ", ")))


@query("""
WITH words AS (SELECT p_partkey, p_type, string_split(p_name, ' ') AS w FROM part)
SELECT p_partkey, array_to_string(w, ',') AS items, len(w) AS n_items, left(array_to_string(w[1:3], ', '), 50) AS label
FROM words""")
def parse_array_text(spark, sf):
    """Lists printed in the two spellings met in the wild, parsed back and labelled."""
    words = F.split("p_name", " ")
    quoted = F.transform(words, lambda w: F.concat(F.lit("'"), w, F.lit("'")))
    glue = F.when(F.col("p_type") == "SMALL", F.array_join(quoted, ", ")).otherwise(F.array_join(quoted, " "))
    rows = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("["), glue, F.lit("]")).alias("printed"))
    items = rows.withColumn("_i", X.parse_list_text(F.col("printed")))
    return items.select(
        "p_partkey", F.array_join("_i", ",").alias("items"), F.size("_i").cast("long").alias("n_items"),
        X.list_label(F.col("_i"), "General", first=3, width=50).alias("label"),
    )


@query("""
SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k, event_type AS category,
       CASE WHEN value > 50 THEN NULL ELSE props END AS json_text
FROM events WHERE value <= 50
UNION ALL SELECT event_id, NULL, NULL, NULL FROM events WHERE value > 50""")
def json_extract(spark, sf):
    """A JSON object inside free text; answers of expensive events hold none."""
    answer = F.when(F.col("value") > 50, F.lit("Sorry, no answer.")).otherwise(
        F.concat(F.lit("Here it is:\n"), F.regexp_replace("props", r"\}", F.concat(F.lit(', "category": "'), "event_type", F.lit('"}'))), F.lit(" Done. {x}"))
    )
    found = table(spark, sf, "events").select("event_id", "value", "props", answer.alias("answer"))
    record = X.parse_json_record(F.col("answer"), "k long, category string")
    return found.withColumn("_r", record).select(
        "event_id", "_r.k", "_r.category",
        F.when(X.first_json_object(F.col("answer")).isNotNull(), F.col("props")).alias("json_text"),
    )


# --- enrichment ---------------------------------------------------------------------------------

RULES = sg.KeywordAnnotator(
    categories={"Databases": "tion", "Networking": "the", "Graphics": "ie"},
    stack={"Python": "en", "Go": "ou", "Rust": "zz"},
    audience={"researcher": "an", "sysadmin": "er", "IT-ops": "qu"},
    use_cases={"caching": "in", "database": "re", "devops": "ch"},
    length_steps=(500, 3000),
)


def _all_sql(rules: dict[str, str]) -> str:
    return "concat_ws(', ', " + ", ".join(f"CASE WHEN contains(lower(text), '{p}') THEN '{n}' END" for n, p in rules.items()) + ")"


@query(f"""
SELECT doc_id, CASE WHEN contains(lower(text), 'tion') THEN 'Databases' WHEN contains(lower(text), 'the') THEN 'Networking'
                    WHEN contains(lower(text), 'ie') THEN 'Graphics' ELSE 'Other' END AS category,
       {_all_sql(RULES.stack)} AS tech_stack,
       CASE WHEN length(text) < 500 THEN 'beginner' WHEN length(text) < 3000 THEN 'intermediate' ELSE 'advanced' END AS complexity_level,
       CAST(CASE WHEN length(text) < 500 THEN 1 WHEN length(text) < 3000 THEN 2 ELSE 3 END AS BIGINT) AS complexity_score,
       {_all_sql(RULES.audience)} AS audience, {_all_sql(RULES.use_cases)} AS use_cases
FROM documents""")
def enrich_keywords(spark, sf):
    out = sg.enrich(table(spark, sf, "documents"), "doc_id", "text", RULES)
    return out.withColumns({c: F.array_join(c, ", ") for c in ("tech_stack", "audience", "use_cases")})


@query(f"""
SELECT count(*) AS records, 0::BIGINT AS bad_category, 0::BIGINT AS bad_level,
       count(*) FILTER (WHERE contains(lower(text), 'qu')) AS bad_audience, 0::BIGINT AS bad_use_cases
FROM documents""")
def vocabulary_report(spark, sf):
    out = sg.enrich(table(spark, sf, "documents"), "doc_id", "text", RULES)
    return sg.vocabulary_report(out, audiences=["researcher", "sysadmin"])


# A word boundary in the Unicode sense, spelt out for a dialect whose own knows ASCII only; one character is consumed.
_EDGE = r"(?:^|$|[^\pL\pN\pM_])"


def _rule_sql(rule: str) -> str:
    between = rule.replace(r"\b.{0,40}\b", _EDGE + r"(?:.{0,39}" + _EDGE + ")?")  # two edges with one character between
    return f"regexp_matches(low, '{between.replace(chr(92) + 'b', _EDGE)}')"


def _rules_sql(rules) -> str:
    return "concat_ws(', ', " + ", ".join(f"CASE WHEN {_rule_sql(p)} THEN '{n}' END" for n, p in rules.items()) + ")"


@query(f"""
WITH texts AS (SELECT page_id, CASE WHEN page_id % 10 = 3 THEN NULL WHEN page_id % 10 = 4 THEN '' ELSE html END AS text FROM pages),
lowered AS (SELECT *, lower(text) AS low, coalesce(text, '') <> '' AS given FROM texts)
SELECT page_id,
       CASE WHEN given THEN CASE {' '.join(f"WHEN {_rule_sql(p)} THEN '{n}'" for n, p in EN.CATEGORY_RULES.items())} ELSE 'Other' END END AS category,
       CASE WHEN given THEN {_rules_sql(EN.STACK_RULES)} END AS tech_stack,
       CASE WHEN given THEN CASE WHEN length(text) < 2000 THEN 'beginner' WHEN length(text) < 10000 THEN 'intermediate' ELSE 'advanced' END END AS complexity_level,
       CASE WHEN given THEN {_rules_sql(EN.AUDIENCE_RULES)} END AS audience, CASE WHEN given THEN {_rules_sql(EN.USE_CASE_RULES)} END AS use_cases
FROM lowered""")
def enrich_default_rules(spark, sf):
    """The default rules over raw pages, some of them null or empty: those have an all-null record."""
    step = F.col("page_id") % 10
    text = F.when(step == 3, F.lit(None)).when(step == 4, "").otherwise(F.col("html"))
    out = sg.enrich(table(spark, sf, "pages").select("page_id", text.alias("text")), "page_id", "text")
    return out.drop("complexity_score").withColumns({c: F.array_join(c, ", ") for c in ("tech_stack", "audience", "use_cases")})


@query("""
WITH lists AS (SELECT p_partkey, p_size, CAST(to_json(string_split(p_name, ' ')) AS VARCHAR) AS words, p_brand FROM part)
SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, dense_rank() OVER (ORDER BY p_brand) AS p_brand_label, dense_rank() OVER (ORDER BY words) AS words_label
FROM lists""")
def encode_lists(spark, sf):
    """A table with a list column in numbers: equal lists have one code."""
    rows = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("long").alias("p_size"), "p_brand", F.split("p_name", " ").alias("words"))
    return sg.encode_numeric(rows, "p_partkey")


@query(f"WITH {roles.READY_SQL} SELECT cluster FROM ready WHERE repo_name = 'cust/7'")
def repo_cluster(spark, sf):
    """The group of one repository."""
    return R.repo_cluster(roles.ready(spark, sf), "cust/7")


@query("""
WITH sized AS (SELECT doc_id, text, least(len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) // 200, 2) AS level FROM documents)
SELECT doc_id, CASE WHEN contains(text, 'tion') THEN 'Databases' ELSE 'Other' END AS category, 'Python' AS tech_stack,
       CASE level WHEN 0 THEN 'beginner' WHEN 1 THEN 'intermediate' ELSE 'advanced' END AS complexity_level,
       CAST(level + 1 AS BIGINT) AS complexity_score, 'researcher' AS audience, 'caching' AS use_cases
FROM sized""")
def enrich_replies(spark, sf):
    """Enrichment through a Python annotator that answers in prose around a JSON object."""

    def word_annotator(text: str) -> str:  # local, so that it travels to the tasks by value
        import json

        level = min(len(text.split()) // 200, 2)
        record = {
            "category": "Databases" if "tion" in text else "Other",
            "tech_stack": ["Python"], "audience": ["researcher"], "use_cases": ["caching"],
            "complexity_level": ["beginner", "intermediate", "advanced"][level], "complexity_score": level + 1,
        }
        return f"Sure: {json.dumps(record)}"

    out = sg.annotate_replies(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text", word_annotator)
    return out.withColumns({c: F.array_join(c, ", ") for c in ("tech_stack", "audience", "use_cases")})


@query("""
SELECT host, page_id, kind FROM (
  SELECT *, row_number() OVER (PARTITION BY host ORDER BY CASE kind WHEN 'de' THEN 1 WHEN 'fr' THEN 2 WHEN 'es' THEN 3 ELSE 4 END, page_id) AS place
  FROM (SELECT regexp_extract(url, '^https?://([^/]+)/', 1) AS host, regexp_extract(url, '^https?://[^/]+/([^/]+)/', 1) AS kind, page_id FROM pages)
  WHERE kind IN ('de', 'fr', 'es', 'en'))
WHERE place = 1""")
def first_existing_file(spark, sf):
    pages = table(spark, sf, "pages").select(
        F.regexp_extract("url", "^https?://([^/]+)/", 1).alias("host"),
        F.regexp_extract("url", "^https?://[^/]+/([^/]+)/", 1).alias("kind"), "page_id",
    )
    return sg.first_existing(pages, "host", "kind", ["de", "fr", "es", "en"], ["page_id"])
