"""Feature tables: per-repository aggregates, enrichment joined on, README measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import readme as R
from ..functions.numbers import ratio
from ..sources.snapshots import one_snapshot


DATE = "snapshot_date"


def _keys(df: DataFrame, group: str) -> list[str]:
    """A repository, and its snapshot where the table tells snapshots apart."""
    return [group, *([DATE] if DATE in df.columns else [])]


def commit_profile(commits: DataFrame, group: str = "repo_full_name") -> DataFrame:
    """Counts, message length and merge ratio over human commits; bot ratio over all commits given.

    One row a repository and, if the table has one, ``snapshot_date``. On a table that has lost its bots already, the ratio is 0; pass the flagged
    table to learn the true one.
    """
    human = ~F.col("is_bot_commit")
    return commits.groupBy(*_keys(commits, group)).agg(
        F.count_if(human).alias("total_commits"),
        F.avg(F.when(human, F.col("message_length"))).alias("avg_message_length"),
        F.avg(F.when(human, F.col("is_merge_commit").cast("int"))).alias("merge_commit_ratio"),
        F.avg(F.col("is_bot_commit").cast("int")).alias("bot_commit_ratio"),
    )


def contributor_profile(contributors: DataFrame, group: str = "repo_full_name", exact: bool = True) -> DataFrame:
    """Contributor count, mean contributions and core ratio of each repository and snapshot; ``exact=False`` estimates the count."""
    distinct = F.count_distinct if exact else F.approx_count_distinct
    return contributors.groupBy(*_keys(contributors, group)).agg(
        distinct("contributor_login").alias("total_contributors"),
        F.avg("contributions").alias("avg_contributions_per_person"),
        F.avg(F.col("is_core_contributor").cast("int")).alias("core_contributor_ratio"),
    )


def repo_features(
    repos: DataFrame, commits: DataFrame, contributors: DataFrame, languages: DataFrame, dated: bool = False
) -> DataFrame:
    """One row per repository: three left joins to aggregates that hold one row per repository each.

    Where both sides have ``snapshot_date``, it is part of the join key, so snapshots side by side stay apart (``dated``
    keeps it as a column). Of a side that has it where ``repos`` has not, the latest snapshot counts. From tables
    bucketed by repository and snapshot (``replace_table(bucket_by=...)``) the joins need no exchange.
    """
    if DATE not in repos.columns:
        commits, contributors, languages = (one_snapshot(x).drop(DATE) for x in (commits, contributors, languages))
    profiles = [
        commit_profile(commits),
        contributor_profile(contributors),
        languages.select(
            *_keys(languages, "repo_full_name"), "primary_language", "primary_language_pct", "language_count",
            "languages_above_10_percent", "has_javascript", "has_compiled_language",
        ),
    ]
    wide = repos
    for side in profiles:
        same = F.col("name") == F.col("_repo")
        if DATE in side.columns:
            same &= F.col(DATE) == F.col("_date")
        wide = wide.join(side.withColumnsRenamed({"repo_full_name": "_repo", DATE: "_date"}), same, "left").drop("_repo", "_date")

    def zero(column: str):
        return F.coalesce(column, F.lit(0)).alias(column)

    def no(column: str):
        return F.coalesce(column, F.lit(False)).alias(column)

    return wide.select(
        *([DATE] if dated else []),
        F.col("name").alias("repo_name"),
        F.col("url").alias("repo_url"),
        F.col("language").alias("main_language"),
        F.col("stars").alias("stars_count"),
        F.col("forks").alias("forks_count"),
        "watchers",
        "open_issues",
        "repo_age_days",
        "stars_per_day",
        zero("total_commits"),
        zero("avg_message_length"),
        zero("merge_commit_ratio"),
        zero("bot_commit_ratio"),
        zero("total_contributors"),
        zero("avg_contributions_per_person"),
        zero("core_contributor_ratio"),
        F.coalesce("primary_language", "language").alias("primary_language"),
        zero("primary_language_pct"),
        zero("language_count"),
        zero("languages_above_10_percent"),
        no("has_javascript"),
        no("has_compiled_language"),
        ratio(F.col("total_commits"), F.col("total_contributors")).alias("commits_per_contributor"),
        ratio(F.col("forks"), F.col("stars")).alias("forks_per_star"),
    )


def ml_ready(features: DataFrame, enriched: DataFrame, key: str = "repo_name") -> DataFrame:
    """Every feature row with its enrichment, if any. Lists stay lists."""
    return features.join(enriched, key, "left")


def readme_features(df: DataFrame, key: str, text: str, filename: str | None = None) -> DataFrame:
    """Size, structure and section flags of README texts, with a short preview."""
    body = F.col(text)
    return df.select(
        F.col(key).alias("repo_full_name"),
        *([F.col(filename).alias("readme_filename")] if filename else []),
        *[expr.alias(name) for name, expr in R.text_metrics(body).items()],
        *[expr.alias(name) for name, expr in R.section_flags(body).items()],
        F.substring(body, 1, R.PREVIEW_CHARS).alias("content_preview"),
    )


def readme_summary(raw: DataFrame) -> DataFrame:
    """README features of the raw feed, decoded."""
    text = raw.withColumn("_text", R.decode_content(F.col("content"), F.col("encoding")))
    return readme_features(text, "repo_full_name", "_text", "name")


def doc_completeness(summary: DataFrame, key: str = "repo_full_name") -> DataFrame:
    """Sections present out of six, in percent, and the names of those that are missing."""
    present = R.sections_present()
    return summary.select(
        key,
        present.alias("sections_present"),
        F.lit(len(R.COMPLETENESS)).alias("total_sections"),
        (present / len(R.COMPLETENESS) * 100).alias("completeness_pct"),
        R.missing_sections().alias("missing_sections"),
    )
