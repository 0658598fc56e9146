"""Raw snapshots to cleaned tables.

Every function works on one snapshot (``date``) or, without a date, on all
snapshots side by side: ``snapshot_date`` is part of each key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.numbers import age_days, as_time, ratio, share_pct
from ..operators.dedup import latest_per_key, top_per_group
from ..operators.ranking import rank_and_share
from ..schemas import LANGUAGE_FAMILIES
from ..sources.snapshots import at_snapshot, one_snapshot


# After the address, the latest row of a repository is the one with the larger measures, then the later texts.
_MEASURES = ("stargazers_count", "forks_count", "watchers_count", "open_issues_count", "created_at", "language", "description")


def clean_repos(raw: DataFrame, as_of: dt.date | str, date: int | None = None, limit: int | None = None, tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """Latest row per repository, narrowed and renamed, with age and stars per day.

    ``limit`` keeps the repositories with the most stars.
    """
    rows = at_snapshot(raw, date).select(
        "full_name", "stargazers_count", "forks_count", "language", "description", "html_url",
        "updated_at", "snapshot_date", "created_at", "watchers_count", "open_issues_count",
    )
    latest = latest_per_key(rows, ["full_name", "snapshot_date"], "updated_at", tiebreak or [F.col("html_url"), *[F.col(c).desc_nulls_last() for c in _MEASURES]])
    age = age_days(as_of, F.col("created_at"))
    out = latest.select(
        F.col("full_name").alias("name"),
        F.col("stargazers_count").alias("stars"),
        F.col("forks_count").alias("forks"),
        F.coalesce("language", F.lit("Unknown")).alias("language"),
        F.coalesce("description", F.lit("No description provided")).alias("description"),
        F.col("html_url").alias("url"),
        "updated_at",
        "snapshot_date",
        "created_at",
        F.col("watchers_count").alias("watchers"),
        F.col("open_issues_count").alias("open_issues"),
        age.alias("repo_age_days"),
        F.round(ratio(F.col("stargazers_count"), age), 2).alias("stars_per_day"),
    )
    return out.orderBy(F.col("stars").desc_nulls_last(), "name").limit(limit) if limit else out


def flag_commits(raw: DataFrame, date: int | None = None, patterns: Mapping[str, str] = X.COMMIT_TYPES) -> DataFrame:
    """One row per commit id with type, bot, merge, address and quality flags; bots still in.

    The flags are taken before the deduplication, so a query that does not ask
    for the message text does not shuffle it.
    """
    when = as_time(F.col("commit_date"), raw.schema["commit_date"].dataType.simpleString())
    parsed = at_snapshot(raw, date).select(
        "repo_full_name",
        "sha",
        "commit_message",
        "author_name",
        X.normalise_email(F.col("author_email")).alias("author_email"),
        when.alias("commit_timestamp"),
        "html_url",
        "snapshot_date",
        X.commit_type(F.col("commit_message"), patterns).alias("commit_type"),
        F.length("commit_message").alias("message_length"),
        X.is_merge(F.col("commit_message")).alias("is_merge_commit"),
    )
    once = latest_per_key(parsed, ["sha", "snapshot_date"], "commit_timestamp", [F.col("repo_full_name"), F.col("html_url")])
    flagged = once.withColumns({
        "commit_date_only": F.to_date("commit_timestamp"),
        "commit_hour": F.hour("commit_timestamp"),
        "commit_day_of_week": F.dayofweek("commit_timestamp"),
        "is_bot_commit": X.is_bot(F.col("author_name"), F.col("author_email")),
        "is_valid_email": X.is_valid_email(F.col("author_email")),
    })
    quality = X.commit_quality(F.col("is_bot_commit"), F.col("is_valid_email"), F.col("message_length"))
    return flagged.withColumn("data_quality_flag", quality).select(
        "repo_full_name", "sha", "commit_message", "author_name", "author_email", "commit_timestamp",
        "commit_date_only", "commit_hour", "commit_day_of_week", "html_url", "snapshot_date", "commit_type",
        "is_bot_commit", "is_valid_email", "message_length", "is_merge_commit", "data_quality_flag",
    )


def clean_commits(raw: DataFrame, date: int | None = None, drop_bots: bool = True, limit: int | None = None, patterns: Mapping[str, str] = X.COMMIT_TYPES) -> DataFrame:
    """Flagged commits without the automated ones; ``limit`` keeps the newest."""
    out = flag_commits(raw, date, patterns)
    if drop_bots:
        out = out.where(~F.col("is_bot_commit"))
    return out.orderBy(F.col("commit_timestamp").desc_nulls_last(), "sha").limit(limit) if limit else out


def clean_contributors(raw: DataFrame, date: int | None = None, max_per_repo: int | None = None) -> DataFrame:
    """Valid contributors with rank, core flag and share of the repository's contributions.

    Ranks count the invalid rows too and so may have gaps; shares are over the
    valid rows only.
    """
    valid = F.col("data_quality_flag") == "valid"

    def once_flagged(rows: DataFrame) -> DataFrame:
        once = latest_per_key(
            rows, ["repo_full_name", "snapshot_date", "contributor_login"], "contributions",
            [F.col("contributor_id").asc_nulls_last(), F.col("html_url")],
        )
        named = once.withColumn("contributor_login", F.coalesce("contributor_login", F.lit(X.MISSING_LOGIN)))
        return named.withColumn(
            "data_quality_flag",
            X.contributor_quality(F.col("contributor_login"), F.col("contributions"), F.col("contributor_id")),
        )

    ranked = rank_and_share(
        at_snapshot(raw, date), ["repo_full_name", "snapshot_date"], "contributions", ["contributor_login", "html_url"],
        rank="contribution_rank", total="_total", core="is_core_contributor", counted=valid,
        first=once_flagged,
    )
    out = ranked.where(valid).select(
        "repo_full_name", "contributor_login", "contributor_id", "contributions", "html_url", "followers_url",
        "snapshot_date", "contribution_rank", "data_quality_flag", "is_core_contributor",
        share_pct(F.col("contributions"), F.col("_total")).alias("contribution_percentage"),
    )
    if max_per_repo:
        out = top_per_group(out, ["repo_full_name", "snapshot_date"], [F.col("contribution_rank")], max_per_repo)
    return out


def language_totals(raw: DataFrame, group: str = "repo_full_name", weight: str = "bytes", date: int | None = None) -> DataFrame:
    """Sum of the weights of a repository, in one snapshot (default: the latest)."""
    return one_snapshot(raw, date).groupBy(group).agg(F.sum(weight).alias("total_bytes"))


def language_details(raw: DataFrame, group: str = "repo_full_name", item: str = "language", weight: str = "bytes", date: int | None = None) -> DataFrame:
    """Share and rank of every language of a repository, in one snapshot (default: the latest)."""
    sums = one_snapshot(raw, date).groupBy(group, item).agg(F.sum(weight).alias(weight))
    ranked = rank_and_share(sums, [group], weight, [item], rank="language_rank", total="_total")
    return ranked.select(
        group, item, weight, share_pct(F.col(weight), F.col("_total")).alias("percentage"), "language_rank"
    )


def language_summary(
    raw: DataFrame,
    group: str = "repo_full_name",
    item: str = "language",
    weight: str = "bytes",
    families: Mapping[str, Sequence[str]] = LANGUAGE_FAMILIES,
    date: int | None = None,
) -> DataFrame:
    """One row per repository: top languages and shares, spread, and family flags.

    Totals, counts and extremes are plain aggregates, combined before the
    shuffle; the shares above a limit are counted over all languages. Ranks are
    needed for the five largest languages only, and Spark prunes the rest before
    the exchange. Without a date, the latest snapshot counts.
    """
    raw = one_snapshot(raw, date)
    sums = raw.groupBy(group, item).agg(F.sum(weight).alias("_bytes"))
    spread = sums.groupBy(group).agg(
        F.count(item).alias("language_count"),
        F.sum("_bytes").alias("total_bytes"),
        F.min("_bytes").alias("_least"),
        F.max("_bytes").alias("_most"),
        F.count_if(F.col("_bytes") > 1000).alias("languages_above_1000_bytes"),
        *[
            F.bool_or(F.coalesce(F.col(item).isin(list(names)), F.lit(False))).alias(flag)
            for flag, names in families.items()
        ],
    )
    largest = top_per_group(sums, [group], [F.col("_bytes").desc_nulls_last(), F.col(item)], 5)
    largest = largest.groupBy(group).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("_bytes")).alias("b"), F.col(item).alias("l")))).alias("_top")
    )
    total = F.col("total_bytes")
    share = share_pct(F.col("_bytes"), total)
    above = sums.select(F.col(group), "_bytes").join(spread.select(group, "total_bytes"), group).groupBy(group).agg(
        F.count_if(share > 5).alias("languages_above_5_percent"), F.count_if(share > 10).alias("languages_above_10_percent")
    )
    both = spread.join(largest, group).join(above, group)

    def name(place: int) -> Column:
        return F.try_element_at("_top", F.lit(place))["l"]

    def pct(place: int) -> Column:
        return share_pct(-F.try_element_at("_top", F.lit(place))["b"], total)

    return both.select(
        group,
        "language_count",
        name(1).alias("primary_language"),
        pct(1).alias("primary_language_pct"),
        name(2).alias("secondary_language"),
        pct(2).alias("secondary_language_pct"),
        name(3).alias("tertiary_language"),
        pct(3).alias("tertiary_language_pct"),
        F.concat_ws(",", F.transform(F.slice("_top", 1, 5), lambda e: e["l"])).alias("top_5_languages"),
        "total_bytes",
        F.round(pct(1) - F.coalesce(pct(2), F.lit(0.0)), 2).alias("language_dominance_gap"),
        "languages_above_5_percent",
        "languages_above_10_percent",
        "languages_above_1000_bytes",
        share_pct(F.col("_least"), total).alias("smallest_language_pct"),
        share_pct(F.col("_most"), total).alias("largest_language_pct"),
        *families,
    )


def table_stats(df: DataFrame, names: Mapping[str, Column]) -> DataFrame:
    """Row of statistics a transform reports about the table it wrote."""
    return df.agg(*[expr.alias(name) for name, expr in names.items()])


def commit_stats(commits: DataFrame) -> DataFrame:
    return table_stats(commits, {
        "total_commits": F.count(F.lit(1)),
        "total_repos": F.count_distinct("repo_full_name"),
        "unique_authors": F.count_distinct("author_email"),
        "merge_commits": F.count_if("is_merge_commit"),
    })


def contributor_stats(contributors: DataFrame) -> DataFrame:
    return table_stats(contributors, {
        "total_contributors": F.count(F.lit(1)),
        "total_repos": F.count_distinct("repo_full_name"),
        "unique_contributors": F.count_distinct("contributor_login"),
        "core_contributors": F.count_if("is_core_contributor"),
    })


def row_count(df: DataFrame) -> DataFrame:
    return table_stats(df, {"row_count": F.count(F.lit(1))})
