"""The queries behind the four report pages.

``repos`` is the ML-ready table (one row per repository); ``languages`` the
language summary; ``commits`` the cleaned commits. Each function is one query;
cache the grouped table when several are asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions.text import list_label
from ..operators.cluster import kmeans
from ..operators.dedup import top_per_group
from ..operators.joins import drill_down, fallback, left_join_suffixed, present, search
from ..operators.tallies import declared_counts, histogram
from ..operators.topk import n_largest, other_bucket, value_counts
from ..schemas import CLUSTER_FEATURES, CLUSTER_NAMES, OVERVIEW_FEATURES

def _by_stars(name: str = "repo_name") -> list:
    return [F.col("stars_count").desc_nulls_last(), name]


def repo_list(repos: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Repositories with a star count, most stars first; listed columns that exist."""
    rows = repos.where(F.col("stars_count").isNotNull())
    return rows.orderBy(*_by_stars()).select(*(present(rows, columns) if columns else rows.columns))


# --- overview -------------------------------------------------------------------------------


def grouped(repos: DataFrame, features: Sequence[str] = OVERVIEW_FEATURES, **options) -> DataFrame:
    """The repositories with their k-means group, on those of the features the table has."""
    return kmeans(repos, present(repos, features), **options)


def overview_kpis(repos: DataFrame, languages: DataFrame) -> DataFrame:
    stars = repos.agg(
        F.count(F.lit(1)).alias("total_repos"),
        F.avg("stars_count").alias("avg_stars"),
        F.sum("total_commits").alias("total_commits"),
    )
    return stars.withColumn("languages", languages.agg(F.count_distinct("primary_language")).scalar())


def with_age(repos: DataFrame, days: str = "repo_age_days") -> DataFrame:
    """Add age in years, its band and its stage."""
    age = N.years(F.col(days))
    return repos.withColumns({
        "age_years": age,
        "age_bin": N.cut(age, N.AGE_EDGES, N.AGE_LABELS),
        "age_category": N.cut(age, N.STAGE_EDGES, N.STAGE_LABELS),
    })


def age_bands(repos: DataFrame) -> DataFrame:
    return declared_counts(with_age(repos), "age_bin", N.AGE_LABELS)


def age_band_repos(repos: DataFrame, band: str) -> DataFrame:
    rows = with_age(repos)
    columns = ["repo_name", "stars_count", F.bround("age_years", 1).alias("age_years"), *present(rows, ["cluster", "total_commits"])]
    return drill_down(rows, F.col("age_bin") == band, columns, _by_stars(), {
        "repo_name": "Repository", "stars_count": "Stars", "age_years": "Age (years)",
        "cluster": "ML Cluster", "total_commits": "Total Commits",
    })


def forks_vs_stars(repos: DataFrame, languages: DataFrame, k: int = 8, min_size: int = 100) -> DataFrame:
    """Scatter data: display language (rare ones folded into Other), age stage, point size."""
    side = languages.select("repo_full_name", "primary_language")
    joined = left_join_suffixed(with_age(repos), side, "repo_name", "repo_full_name", "_lang")
    shown = fallback(joined, "display_language", "primary_language_lang", "primary_language")
    bucketed = other_bucket(shown, "display_language", k, "language_grouped")
    return bucketed.select(
        "repo_name", "stars_count", "forks_count", "display_language", "language_grouped", "age_years", "age_category",
        N.at_least(F.col("total_commits"), min_size).alias("size_for_plot"),
    )


def language_count_distribution(languages: DataFrame) -> DataFrame:
    return value_counts(languages, "language_count").orderBy("language_count")


def language_count_stats(languages: DataFrame, many: int = 5) -> DataFrame:
    return languages.agg(
        F.avg("language_count").alias("avg_languages"),
        F.count_if(F.col("language_count") == 1).alias("single_language"),
        F.count_if(F.col("language_count") >= many).alias("many_languages"),
    )


def top_languages(languages: DataFrame, k: int = 15) -> DataFrame:
    return value_counts(languages, "primary_language").orderBy(F.desc("n"), "primary_language").limit(k)


def language_repos(languages: DataFrame, repos: DataFrame, language: str, k: int = 20) -> DataFrame:
    """The most starred repositories of one primary language."""
    rows = languages.where(F.col("primary_language") == language)
    joined = left_join_suffixed(rows, repos.select("repo_name", "stars_count", "total_commits"), "repo_full_name", "repo_name", "_r")
    return n_largest(joined, k, "stars_count", ["repo_full_name"]).select(
        F.col("repo_full_name").alias("Repository"), F.col("stars_count").alias("Stars"),
        F.col("language_count").alias("Total Languages"), F.col("total_commits").alias("Commits"),
        F.col("top_5_languages").alias("Languages Used"),
    )


# --- one repository, or all of them at once -------------------------------------------------


def daily_activity(commits: DataFrame, days: int = 365, group: str = "repo_full_name", date: str = "commit_date_only", author: str = "author_name") -> DataFrame:
    """Commits and distinct authors per repository and day, its latest ``days`` active days."""
    daily = commits.where(F.col(date).isNotNull()).groupBy(group, date).agg(
        F.count(F.lit(1)).alias("commit_count"), F.count_distinct(author).alias("unique_authors")
    )
    return top_per_group(daily, [group], [F.col(date).desc()], days).orderBy(group, date)


def activity_kpis(daily: DataFrame, group: str = "repo_full_name") -> DataFrame:
    return daily.groupBy(group).agg(
        F.sum("commit_count").alias("total"),
        F.avg("commit_count").alias("avg_per_day"),
        F.max("commit_count").alias("peak"),
        F.count(F.lit(1)).alias("active_days"),
    )


def top_authors(commits: DataFrame, k: int = 20, group: str = "repo_full_name", author: str = "author_name", date: str = "commit_date_only") -> DataFrame:
    """The ``k`` most active authors of each repository, with first and last commit day as text."""
    per_author = commits.where(F.col(author).isNotNull()).groupBy(group, author).agg(
        F.count(F.lit(1)).alias("commit_count"), F.min(date).alias("_first"), F.max(date).alias("_last")
    )
    top = top_per_group(per_author, [group], [F.col("commit_count").desc(), F.col(author)], k)
    return top.select(
        group, author, "commit_count",
        F.date_format("_first", "yyyy-MM-dd").alias("first_commit"),
        F.date_format("_last", "yyyy-MM-dd").alias("last_commit"),
    ).orderBy(group, F.desc("commit_count"), author)


def entity_card(repos: DataFrame) -> DataFrame:
    """Head-line numbers of every repository as whole numbers, 0 where unknown."""
    return repos.select(
        "repo_name",
        *[N.count_or_zero(F.col(c)).alias(c) for c in ["stars_count", "forks_count"]],
        N.whole_years(N.count_or_zero(F.col("repo_age_days"))).alias("age_years"),
        *[N.count_or_zero(F.col(c)).alias(c) for c in ["total_commits", "total_contributors"]],
    )


def enrichment_card(enriched: DataFrame) -> DataFrame:
    """Display texts of the enrichment record, with labels for what is missing."""
    return enriched.select(
        "repo_name",
        F.coalesce("category", F.lit("Not classified")).alias("category"),
        F.coalesce("complexity_level", F.lit("Unknown")).alias("complexity_level"),
        N.count_or_zero(F.col("complexity_score")).alias("complexity_score"),
        list_label(F.col("audience"), "General", first=3).alias("audience"),
        list_label(F.col("use_cases"), "Not specified").alias("use_cases"),
        list_label(F.col("tech_stack"), "Not specified").alias("tech_stack"),
    )


def language_breakdown(languages: DataFrame, key: str = "repo_full_name") -> DataFrame:
    """Top-3 columns as rows; places without a language are left out, a missing share is 0."""
    places = F.array(*[
        F.struct(
            F.lit(i).alias("place"),
            F.col(f"{p}_language").alias("language"),
            F.coalesce(f"{p}_language_pct", F.lit(0.0)).alias("percentage"),
        )
        for i, p in enumerate(["primary", "secondary", "tertiary"], 1)
    ])
    return languages.select(key, F.inline(places)).where(F.col("language").isNotNull())


# --- groups ---------------------------------------------------------------------------------


def clustered(repos: DataFrame, features: Sequence[str] = CLUSTER_FEATURES, **options) -> DataFrame:
    rows = grouped(repos, features, **options)
    return rows.withColumn("cluster_name", N.lookup_label(F.col("cluster"), CLUSTER_NAMES))


def cluster_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("cluster", "cluster_name").agg(
        F.count(F.lit(1)).alias("repos"), F.avg("stars_count").alias("avg_stars")
    ).orderBy("cluster")


def cluster_comparison(rows: DataFrame) -> DataFrame:
    """Size and mean measures per group, cut and rounded as shown; 0 for a measure that the rows lack."""
    have = set(rows.columns)
    whole = {"avg_stars": "stars_count", "avg_forks": "forks_count", "avg_commits": "total_commits", "avg_contributors": "total_contributors"}

    def mean(column: str) -> Column:
        return F.avg(column) if column in have else F.lit(0.0)

    means = [F.floor(mean(c)).cast("long").alias(name) for name, c in whole.items()]
    rounded = [
        ("avg_age_years", mean("repo_age_days") / N.DAYS_PER_YEAR, 1),
        ("avg_stars_per_day", mean("stars_per_day"), 2),
        ("avg_languages", mean("language_count"), 1),
    ]
    means += [F.bround(expr, digits).alias(name) for name, expr, digits in rounded]
    return (
        rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("repos"), *means)
        .withColumn("cluster_label", N.lookup_label(F.col("cluster"), CLUSTER_NAMES, "Cluster "))
        .orderBy("cluster")
    )


def cluster_totals(rows: DataFrame) -> DataFrame:
    sums = present(rows, ["stars_count", "total_commits", "total_contributors"])
    return rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("repos"), *[F.sum(c).alias(c) for c in sums])


def cluster_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_distinct("cluster").alias("clusters"))


def cluster_histograms(rows: DataFrame, column: str, bins: int = 20) -> DataFrame:
    return histogram(rows, column, bins, by=["cluster"])


def cluster_top_repos(rows: DataFrame, k: int = 20) -> DataFrame:
    """The most starred repositories of every group."""
    shown = present(rows, ["stars_count", "forks_count", "total_commits", "total_contributors", "language_count"])
    daily = [F.bround("stars_per_day", 2).alias("stars_per_day")] if "stars_per_day" in rows.columns else []
    return top_per_group(rows, ["cluster"], _by_stars(), k).select("cluster", "repo_name", *shown, *daily)


def repo_cluster(rows: DataFrame, repo: str) -> DataFrame:
    return rows.where(F.col("repo_name") == F.lit(repo)).select("cluster")


# --- enrichment insights --------------------------------------------------------------------


def coverage(repos: DataFrame, column: str = "category") -> DataFrame:
    """How many rows have the column filled, in percent, and how many values there are."""
    counts = repos.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(column).alias("covered"),
        F.count_distinct(column).alias("distinct_values"),
    )
    pct = N.guarded(F.col("total"), F.col("covered") / F.col("total") * 100)
    return counts.withColumn("coverage_pct", pct)


def category_repos(repos: DataFrame, category: str) -> DataFrame:
    return drill_down(
        repos, F.col("category") == category,
        ["repo_name", "stars_count", "forks_count", "complexity_level", "primary_language"], _by_stars(),
        {"repo_name": "Repository", "stars_count": "Stars", "forks_count": "Forks",
         "complexity_level": "Complexity", "primary_language": "Language"},
    )


def audience_repos(repos: DataFrame, audience: str) -> DataFrame:
    """Repositories whose audience list holds a value."""
    return drill_down(
        repos, F.array_contains("audience", audience),
        ["repo_name", "category", "stars_count", "forks_count", "complexity_level"], _by_stars(),
        {"repo_name": "Repository", "category": "Category", "stars_count": "Stars",
         "forks_count": "Forks", "complexity_level": "Complexity"},
    )


def search_repos(repos: DataFrame, categories: Sequence[str] = (), levels: Sequence[str] = (), min_stars: int = 0, k: int = 50) -> DataFrame:
    found = search(repos, {"stars_count": min_stars}, category=categories, complexity_level=levels)
    return n_largest(found, k, "stars_count", ["repo_name"]).select(
        "repo_name", "category", "complexity_level", "stars_count", "forks_count", "primary_language"
    )
