"""The queries of the report pages."""

from __future__ import annotations

from pyspark.sql import functions as F

import stargauge as sg
from stargauge.plans import reports as R

from . import roles
from .cleaning import FLAGGED_SQL
from .registry import query, rounded, table

READY = f"WITH {roles.READY_SQL}"
PARTS = f"WITH {roles.PARTS_SQL}"
DOC_SUMMARY = f"WITH {roles.DOC_LANGUAGES_SQL}, {roles.language_summary_sql(roles.DOC_FAMILIES)}"
BRAND_SUMMARY = f"WITH {roles.BRAND_LANGUAGES_SQL}, {roles.language_summary_sql(roles.BRAND_FAMILIES)}"
BAND = """
  CASE WHEN age_years > 0 AND age_years <= 2 THEN '0-2 years' WHEN age_years > 2 AND age_years <= 5 THEN '2-5 years'
       WHEN age_years > 5 AND age_years <= 10 THEN '5-10 years' WHEN age_years > 10 AND age_years <= 15 THEN '10-15 years'
       WHEN age_years > 15 AND age_years <= 100 THEN '15+ years' END"""
STAGE = """
  CASE WHEN age_years > 0 AND age_years <= 3 THEN 'New (0-3y)' WHEN age_years > 3 AND age_years <= 7 THEN 'Growing (3-7y)'
       WHEN age_years > 7 AND age_years <= 12 THEN 'Mature (7-12y)' WHEN age_years > 12 AND age_years <= 100 THEN 'Legacy (12y+)' END"""
AGED = f"""{READY},
aged AS (SELECT *, {BAND} AS age_bin, {STAGE} AS age_category FROM (SELECT *, repo_age_days / 365 AS age_years FROM ready))"""


def _brand_summary(spark, sf):
    return sg.language_summary(roles.brand_languages(spark, sf), families=roles.BRAND_FAMILIES)


# --- overview -----------------------------------------------------------------------------------


@query(f"""{READY}
SELECT repo_name, stars_count, forks_count, category FROM ready WHERE stars_count IS NOT NULL""")
def repo_list(spark, sf):
    return R.repo_list(roles.ready(spark, sf), ["repo_name", "stars_count", "forks_count", "category", "not_there"])


@query(f"""{READY}, {BRAND_SUMMARY[5:]}
SELECT count(*) AS total_repos, round(avg(stars_count), 6) AS avg_stars, CAST(sum(total_commits) AS BIGINT) AS total_commits,
       (SELECT count(DISTINCT primary_language) FROM language_summary) AS languages
FROM ready""")
def overview_kpis(spark, sf):
    return rounded(R.overview_kpis(roles.ready(spark, sf), _brand_summary(spark, sf)))


@query(f"""{AGED}
SELECT label AS age_bin, ord AS age_bin_ord, count(age_bin) AS n
FROM (VALUES ('0-2 years', 1), ('2-5 years', 2), ('5-10 years', 3), ('10-15 years', 4), ('15+ years', 5)) v(label, ord)
LEFT JOIN aged ON age_bin = label GROUP BY 1, 2""")
def age_bands(spark, sf):
    return R.age_bands(roles.ready(spark, sf))


@query(f"""{AGED}
SELECT repo_name AS "Repository", stars_count AS "Stars", round_even(age_years, 1) AS "Age (years)", cluster AS "ML Cluster",
       total_commits AS "Total Commits"
FROM aged WHERE age_bin = '10-15 years'""")
def age_band_drilldown(spark, sf):
    return R.age_band_repos(roles.ready(spark, sf), "10-15 years")


@query(f"{AGED} SELECT age_category, count(*) AS n FROM aged WHERE age_category IS NOT NULL GROUP BY 1")
def age_category(spark, sf):
    return sg.value_counts(R.with_age(roles.ready(spark, sf)), "age_category")


@query(f"""{AGED}, {BRAND_SUMMARY[5:]},
shown AS (SELECT a.*, coalesce(s.primary_language, a.primary_language) AS display_language
          FROM aged a LEFT JOIN language_summary s ON a.repo_name = s.repo_full_name),
top AS (SELECT display_language FROM shown WHERE display_language IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 8)
SELECT repo_name, stars_count, forks_count, display_language,
       CASE WHEN display_language IN (SELECT display_language FROM top) THEN display_language ELSE 'Other' END AS language_grouped,
       round(age_years, 6) AS age_years, age_category, greatest(coalesce(total_commits, 100), 100) AS size_for_plot
FROM shown""")
def forks_vs_stars(spark, sf):
    return rounded(R.forks_vs_stars(roles.ready(spark, sf), _brand_summary(spark, sf)))


@query("""
SELECT doc_id, lang, quality AS lang_label, coalesce(CAST(quality AS VARCHAR), lang) AS display_language
FROM documents LEFT JOIN labels USING (doc_id)""")
def display_language_join(spark, sf):
    """Left join on differently named keys with a suffix, then column fallback."""
    left = table(spark, sf, "documents").select("doc_id", "lang")
    right = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("lang"))
    joined = sg.left_join_suffixed(left, right, "doc_id", "doc_id", "_label").drop("doc_id_label")
    return joined.withColumn("display_language", F.coalesce(F.col("lang_label").cast("string"), "lang"))


@query("""
WITH top AS (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 8)
SELECT p_partkey, p_brand, CASE WHEN p_brand IN (SELECT p_brand FROM top) THEN p_brand ELSE 'Other' END AS brand_grouped FROM part""")
def other_bucket(spark, sf):
    return sg.other_bucket(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", 8, "brand_grouped")


@query(f"{BRAND_SUMMARY} SELECT language_count, count(*) AS n FROM language_summary GROUP BY 1")
def value_counts(spark, sf):
    return R.language_count_distribution(_brand_summary(spark, sf))


@query(f"""{BRAND_SUMMARY}
SELECT round(avg(language_count), 6) AS avg_languages, count(*) FILTER (WHERE language_count = 1) AS single_language,
       count(*) FILTER (WHERE language_count >= 5) AS many_languages FROM language_summary""")
def language_count_stats(spark, sf):
    return rounded(R.language_count_stats(_brand_summary(spark, sf)))


@query(f"{BRAND_SUMMARY} SELECT primary_language, count(*) AS n FROM language_summary GROUP BY 1 ORDER BY n DESC, 1 LIMIT 15")
def top_languages(spark, sf):
    return R.top_languages(_brand_summary(spark, sf))


@query(f"""{READY}, {BRAND_SUMMARY[5:]}
SELECT s.repo_full_name AS "Repository", stars_count AS "Stars", s.language_count AS "Total Languages", total_commits AS "Commits",
       top_5_languages AS "Languages Used"
FROM language_summary s LEFT JOIN ready ON repo_name = s.repo_full_name WHERE s.primary_language = 'Brand#1'
ORDER BY stars_count DESC NULLS LAST, s.repo_full_name LIMIT 20""")
def drilldown_left_join_top20(spark, sf):
    return R.language_repos(_brand_summary(spark, sf), roles.ready(spark, sf), "Brand#1")


# --- one repository, or all at once -------------------------------------------------------------

DAILY_SQL = FLAGGED_SQL + """,
daily AS (
  SELECT repo_full_name, commit_date_only, count(*) AS commit_count, count(DISTINCT author_name) AS unique_authors,
         row_number() OVER (PARTITION BY repo_full_name ORDER BY commit_date_only DESC) AS place
  FROM commits WHERE NOT is_bot_commit AND commit_date_only IS NOT NULL GROUP BY 1, 2
)"""


@query(DAILY_SQL + "SELECT * EXCLUDE (place) FROM daily WHERE place <= 365")
def daily_activity(spark, sf):
    days = R.daily_activity(sg.clean_commits(roles.commits_raw(spark, sf)))
    return days.withColumn("commit_date_only", F.date_format("commit_date_only", "yyyy-MM-dd"))


@query(DAILY_SQL + """
SELECT repo_full_name, CAST(sum(commit_count) AS BIGINT) AS total, round(avg(commit_count), 6) AS avg_per_day,
       max(commit_count) AS peak, count(*) AS active_days FROM daily WHERE place <= 365 GROUP BY 1""")
def activity_kpis(spark, sf):
    return rounded(R.activity_kpis(R.daily_activity(sg.clean_commits(roles.commits_raw(spark, sf)))))


@query(FLAGGED_SQL + """
SELECT * EXCLUDE (place) FROM (
  SELECT repo_full_name, author_name, count(*) AS commit_count, min(commit_date_only) AS first_commit,
         max(commit_date_only) AS last_commit,
         row_number() OVER (PARTITION BY repo_full_name ORDER BY count(*) DESC, author_name) AS place
  FROM commits WHERE NOT is_bot_commit AND author_name IS NOT NULL GROUP BY 1, 2)
WHERE place <= 20""")
def top_authors(spark, sf):
    return R.top_authors(sg.clean_commits(roles.commits_raw(spark, sf)))


@query(f"""{READY}
SELECT repo_name, coalesce(stars_count, 0) AS stars_count, coalesce(forks_count, 0) AS forks_count,
       coalesce(repo_age_days, 0) // 365 AS age_years, coalesce(total_commits, 0) AS total_commits,
       coalesce(total_contributors, 0) AS total_contributors
FROM ready""")
def entity_card(spark, sf):
    return R.entity_card(roles.ready(spark, sf))


@query("""
SELECT p_partkey AS repo_name, coalesce(nullif(p_type, 'PROMO'), 'Not classified') AS category,
       CASE WHEN p_size > 25 THEN 'Unknown' ELSE 'beginner' END AS complexity_level,
       CASE WHEN p_size > 25 THEN 0 ELSE p_size END::BIGINT AS complexity_score,
       CASE WHEN p_type = 'PROMO' THEN 'General' ELSE replace(p_name, ' ', ', ') END AS audience,
       CASE WHEN p_type = 'PROMO' THEN 'Not specified' ELSE replace(p_name, ' ', ', ') END AS use_cases,
       'Not specified' AS tech_stack
FROM part""")
def enrichment_card(spark, sf):
    words = F.when(F.col("p_type") != "PROMO", F.split("p_name", " "))
    small = F.col("p_size") <= 25
    return R.enrichment_card(table(spark, sf, "part").select(
        F.col("p_partkey").alias("repo_name"), F.nullif(F.col("p_type"), F.lit("PROMO")).alias("category"),
        F.when(small, F.lit("beginner")).alias("complexity_level"), F.when(small, F.col("p_size")).alias("complexity_score"),
        words.alias("audience"), words.alias("use_cases"), F.lit(None).cast("array<string>").alias("tech_stack"),
    ))


@query("SELECT * FROM part WHERE p_name = 'small ring' ORDER BY p_retailprice DESC, p_partkey LIMIT 1")
def point_lookup(spark, sf):
    return sg.lookup(table(spark, sf, "part"), "p_name", "small ring", [F.desc("p_retailprice"), "p_partkey"])


# --- insights -----------------------------------------------------------------------------------


@query("""
SELECT count(*) AS total, count(quality) AS covered, count(DISTINCT quality) AS distinct_values,
       round(count(quality) / count(*) * 100, 6) AS coverage_pct
FROM documents LEFT JOIN labels USING (doc_id)""")
def coverage(spark, sf):
    joined = sg.ml_ready(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id")
    return rounded(R.coverage(joined, "quality"))


@query(f"{READY} SELECT category, count(*) AS n FROM ready WHERE category IS NOT NULL GROUP BY 1")
def category_counts(spark, sf):
    return sg.value_counts(roles.ready(spark, sf), "category")


FLOW_SQL = f"""{PARTS},
links AS (SELECT category, unnest(use_cases) AS item FROM parts WHERE category IS NOT NULL AND use_cases IS NOT NULL),
counts AS (SELECT category, item, count(*) AS n FROM links WHERE item NOT IN ('', 'widget') GROUP BY 1, 2),
top AS (SELECT item FROM counts GROUP BY 1 ORDER BY sum(n) DESC, 1 LIMIT 8),
pairs AS (SELECT * FROM counts WHERE item IN (SELECT item FROM top) AND n >= 2),
nodes AS (
  SELECT side, node, CAST(row_number() OVER (ORDER BY side, total DESC, node) - 1 AS INTEGER) AS node_index, total FROM (
    SELECT DISTINCT 0 AS side, category AS node, 0::BIGINT AS total FROM pairs
    UNION ALL SELECT 1, item, CAST(sum(n) AS BIGINT) FROM pairs GROUP BY item)
)"""


def _pairs(spark, sf):
    return sg.flow_pairs(roles.parts(spark, sf), "category", "use_cases", exclude=["widget"])


@query(FLOW_SQL + "SELECT * FROM pairs")
def flow_pairs(spark, sf):
    return _pairs(spark, sf)


@query(FLOW_SQL + "SELECT * FROM nodes")
def flow_nodes(spark, sf):
    return sg.flow_nodes(_pairs(spark, sf), "category")


@query(FLOW_SQL + """
SELECT a.node_index AS source_index, b.node_index AS target_index, n AS value
FROM pairs JOIN nodes a ON a.side = 0 AND a.node = category JOIN nodes b ON b.side = 1 AND b.node = item""")
def flow_links(spark, sf):
    return sg.flow_links(_pairs(spark, sf), "category")


@query(f"""{READY}
SELECT repo_name AS "Repository", stars_count AS "Stars", forks_count AS "Forks", complexity_level AS "Complexity",
       primary_language AS "Language" FROM ready WHERE category = 'BUILDING'""")
def category_drilldown(spark, sf):
    return R.category_repos(roles.ready(spark, sf), "BUILDING")


_ORD = "CASE complexity_level WHEN 'beginner' THEN 1 WHEN 'intermediate' THEN 2 WHEN 'advanced' THEN 3 END"


@query(f"""{READY}
SELECT complexity_level, count(*) AS n, {_ORD}::BIGINT AS level_ord FROM ready WHERE {_ORD} IS NOT NULL GROUP BY 1""")
def level_counts_ordered(spark, sf):
    return sg.level_counts(roles.ready(spark, sf), "complexity_level", roles.LEVELS)


@query(f"""{READY}
SELECT complexity_level, count(*) AS n, round(avg(stars_count), 6) AS avg_stars_count, round(avg(forks_count), 6) AS avg_forks_count,
       {_ORD}::BIGINT AS level_ord FROM ready WHERE complexity_level IS NOT NULL GROUP BY 1""")
def level_means(spark, sf):
    return rounded(sg.level_means(roles.ready(spark, sf), "complexity_level", roles.LEVELS, ["stars_count", "forks_count"]))


@query(f"""{READY}
SELECT complexity_level, ord AS level_ord, count(repo_name) AS n, round(coalesce(avg(stars_count), 0), 6) AS avg_stars_count
FROM (VALUES ('beginner', 1), ('intermediate', 2), ('advanced', 3), ('legendary', 4)) v(complexity_level, ord)
LEFT JOIN ready USING (complexity_level) GROUP BY 1, 2""")
def level_stats(spark, sf):
    return rounded(sg.level_stats(roles.ready(spark, sf), "complexity_level", [*roles.LEVELS, "legendary"], "stars_count"))


_TOP_LANG = "SELECT primary_language FROM ready WHERE primary_language IS NOT NULL AND {0} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT {1}"


@query(f"""{READY}
SELECT primary_language, {', '.join(f"count(*) FILTER (WHERE category = '{c}') AS {c}" for c in roles.CATEGORIES)}
FROM ready WHERE category IS NOT NULL AND primary_language IN ({_TOP_LANG.format('category', 10)}) GROUP BY 1""")
def category_by_language_crosstab(spark, sf):
    return sg.crosstab(roles.ready(spark, sf), "primary_language", "category", roles.CATEGORIES[:3], k=10)  # the fourth is found


@query(f"""{READY},
counts AS (SELECT primary_language, complexity_level, count(*) AS n FROM ready
  WHERE complexity_level IS NOT NULL AND primary_language IN ({_TOP_LANG.format('category', 10)}) GROUP BY 1, 2)
SELECT primary_language, complexity_level, n, CAST(sum(n) OVER (PARTITION BY primary_language) AS BIGINT) AS row_total,
       {_ORD}::BIGINT AS level_ord FROM counts""")
def level_by_language(spark, sf):
    rows = roles.ready(spark, sf)
    classified = rows.where(F.col("category").isNotNull())
    return sg.level_profile(rows, "primary_language", "complexity_level", roles.LEVELS, 10, among=classified)


@query(f"""{READY},
rows AS (SELECT * FROM ready WHERE category IS NOT NULL AND primary_language IS NOT NULL AND complexity_level IS NOT NULL),
kept AS (SELECT * FROM rows WHERE primary_language IN (SELECT primary_language FROM rows GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 8))
SELECT category, primary_language, complexity_level, count(*) AS n,
       3 - grouping(category)::INT - grouping(primary_language)::INT - grouping(complexity_level)::INT AS depth
FROM kept GROUP BY ROLLUP (category, primary_language, complexity_level) HAVING grouping(category) = 0""")
def hierarchy_rollup(spark, sf):
    return sg.hierarchy(roles.ready(spark, sf), ["category", "primary_language", "complexity_level"], 8, "primary_language")


@query(f"{PARTS} SELECT item, count(*) AS n FROM (SELECT unnest(use_cases) AS item FROM parts) WHERE item <> '' GROUP BY 1 ORDER BY n DESC, 1 LIMIT 12")
def list_value_counts(spark, sf):
    return sg.list_counts(roles.parts(spark, sf), "use_cases", 12)


@query(f"""{PARTS}
SELECT repo_name AS "Repository", category AS "Category", stars_count AS "Stars", stars_count * 2 AS "Forks", primary_language AS "Complexity"
FROM parts WHERE list_contains(use_cases, 'ring')""")
def list_contains(spark, sf):
    rows = roles.parts(spark, sf).select(
        "repo_name", "category", "stars_count", (F.col("stars_count") * 2).alias("forks_count"),
        F.col("primary_language").alias("complexity_level"), F.col("use_cases").alias("audience"),
    )
    return R.audience_repos(rows, "ring")


@query(f"""{READY}
SELECT repo_name, category, complexity_level, stars_count, forks_count, primary_language FROM ready
WHERE category IN ('BUILDING', 'FURNITURE') AND complexity_level IN ('advanced') AND stars_count >= 100000
ORDER BY stars_count DESC, repo_name LIMIT 50""")
def faceted_search(spark, sf):
    return R.search_repos(roles.ready(spark, sf), ["BUILDING", "FURNITURE"], ["advanced"], 100_000)


@query(f"""{READY}
SELECT repo_name, category, complexity_level, stars_count, forks_count, primary_language FROM ready
WHERE stars_count >= 0 ORDER BY stars_count DESC, repo_name LIMIT 50""")
def search_without_facets(spark, sf):
    return R.search_repos(roles.ready(spark, sf))


@query("SELECT * FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 8)")
def semi_topk(spark, sf):
    return sg.top_k_semi(table(spark, sf, "orders"), "o_custkey", 8)


@query(f"{READY} SELECT DISTINCT category FROM ready WHERE category IS NOT NULL")
def distinct_options(spark, sf):
    return sg.distinct_options(roles.ready(spark, sf), "category")


@query("""
SELECT p_partkey AS part, p_name AS name, p_size AS size FROM part ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 20""")
def ordered_lists(spark, sf):
    shown = sg.present(table(spark, sf, "part"), ["p_partkey", "p_name", "p_size", "p_missing"])
    top = sg.n_largest(table(spark, sf, "part"), 20, "p_retailprice", ["p_partkey"]).select(*shown)
    return top.withColumnsRenamed({"p_partkey": "part", "p_name": "name", "p_size": "size"})


@query("""
SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS word FROM documents)
GROUP BY word ORDER BY n DESC, word LIMIT 8""")
def top_words(spark, sf):
    """The most frequent words of all texts: a summary names candidates, which alone are counted exactly."""
    words = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    return sg.top_counts(table(spark, sf, "documents").select(F.explode(words).alias("word")), "word", 8)


@query("""
SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, true AS estimate_holds
FROM orders WHERE year(o_orderdate) BETWEEN 1994 AND 1996 GROUP BY o_orderpriority""")
def distinct_over_years(spark, sf):
    """Customers of three years from one sketch a year, beside the exact count: within five standard errors."""
    dated = table(spark, sf, "orders").select("o_orderpriority", "o_custkey", F.year("o_orderdate").cast("long").alias("snapshot_date"))
    about = sg.distinct_over(sg.distinct_sketches(dated, ["o_orderpriority"], "o_custkey"), ["o_orderpriority"], 1994, 1996, "about")
    exact = dated.where("snapshot_date BETWEEN 1994 AND 1996").groupBy("o_orderpriority").agg(F.countDistinct("o_custkey").alias("customers"))
    holds = F.abs(F.col("about") - F.col("customers")) <= 5 * sg.distinct_error() * F.col("customers")
    return exact.join(about, "o_orderpriority").select("o_orderpriority", "customers", holds.alias("estimate_holds"))
