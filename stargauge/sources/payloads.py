"""API payloads to flat rows.

A payload row is ``(full_name, status, body)``: repository, HTTP status and the
JSON text that came back. Fetching is not this library's business.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import COMMIT_BODY, CONTRIBUTOR_BODY, LANGUAGE_BODY, README_BODY

OK, NOT_FOUND = 200, 404
MIN_STARS = 5000


def named(df: DataFrame, name: str = "full_name") -> DataFrame:
    """Rows with a repository name; the others cannot be attributed."""
    return df.where(F.col(name).isNotNull() & (F.col(name) != ""))


def answered(payloads: DataFrame) -> DataFrame:
    return named(payloads).where(F.col("status") == OK)


def flatten_commits(payloads: DataFrame) -> DataFrame:
    """One row per commit; absent fields become null."""
    each = answered(payloads).select("full_name", F.explode(F.from_json("body", COMMIT_BODY)).alias("c"))
    return each.select(
        F.col("full_name").alias("repo_full_name"),
        "c.sha",
        F.col("c.commit.message").alias("commit_message"),
        F.col("c.commit.author.name").alias("author_name"),
        F.col("c.commit.author.email").alias("author_email"),
        F.col("c.commit.author.date").alias("commit_date"),
        "c.html_url",
    )


def flatten_contributors(payloads: DataFrame) -> DataFrame:
    each = answered(payloads).select("full_name", F.explode(F.from_json("body", CONTRIBUTOR_BODY)).alias("c"))
    return each.select(
        F.col("full_name").alias("repo_full_name"),
        F.col("c.login").alias("contributor_login"),
        F.col("c.id").alias("contributor_id"),
        "c.contributions",
        "c.html_url",
        "c.followers_url",
    )


def flatten_languages(payloads: DataFrame, extracted_at: Column | None = None) -> DataFrame:
    """One row per repository and language of a language -> bytes map."""
    when = F.current_timestamp() if extracted_at is None else extracted_at
    return answered(payloads).select(
        F.col("full_name").alias("repo_full_name"),
        F.explode(F.from_json("body", LANGUAGE_BODY)).alias("language", "bytes"),
        when.alias("extracted_at"),
    )


def flatten_readme(payloads: DataFrame, extracted_at: Column | None = None) -> DataFrame:
    """The declared README fields plus repository and extraction time."""
    when = F.current_timestamp() if extracted_at is None else extracted_at
    return (
        answered(payloads)
        .withColumn("r", F.from_json("body", README_BODY))
        .select(F.col("full_name").alias("repo_full_name"), "r.*", when.alias("extracted_at"))
    )


def first_repos(repos: DataFrame, n: int, stars: str = "stargazers_count", name: str = "full_name") -> DataFrame:
    """The first ``n`` repositories in search order: most stars first, then by name."""
    return repos.orderBy(F.col(stars).desc_nulls_last(), name).limit(n)


def candidates(repos: DataFrame, n: int, min_stars: int = MIN_STARS, stars: str = "stargazers_count", name: str = "full_name") -> DataFrame:
    """The search behind the repository feed: more than ``min_stars`` stars, cut to ``n``."""
    return first_repos(repos.where(F.col(stars) > min_stars), n, stars, name)


def extraction_tally(payloads: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Attempts, successes, not-founds and errors, over all or per feed."""
    tried = named(payloads)
    return tried.groupBy(*by).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("status") == OK).alias("success_count"),
        F.count_if(F.col("status") == NOT_FOUND).alias("missing_count"),
        F.count_if(~F.col("status").isin(OK, NOT_FOUND) | F.col("status").isNull()).alias("error_count"),
    )
