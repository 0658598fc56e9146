"""The weekly batch: raw snapshot files to result tables, in dependency order.

Each step writes its table before the next one reads it, so a step that fails
can be run again on its own and nothing is computed twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.readme import decode_content
from ..operators.cluster import kmeans
from ..operators.dedup import latest_per_key
from ..operators.encode import encode_numeric
from ..operators.enrich import KeywordAnnotator, annotate_changed, annotate_replies, enrich
from ..operators.profile import group_means
from ..schemas import FEEDS
from ..sources.snapshots import at_snapshot, has_snapshot, read_snapshots, split_corrupt, today_utc
from ..sources.tables import PARTITION, append_snapshot, ensure_database, ensure_table, raw_table_schema, replace_table
from .clean import clean_contributors, clean_repos, flag_commits, language_summary
from .features import ml_ready, readme_summary, repo_features

IDENTIFIERS = ["repo_url"]
QUARANTINE = (
    T.StructType()
    .add("corrupt_record", "string").add("readable", "string").add("feed", "string").add(PARTITION, "long")
)


@dataclass(frozen=True)
class Databases:
    """Names of the databases of a run; runs with other names do not touch one another."""

    raw: str = "raw_github_data"
    clean: str = "cleaned_github_data"
    results: str = "ml_results"


def setup(spark: SparkSession, names: Databases = Databases()) -> None:
    """Create the databases and the declared raw tables that are not there yet."""
    for database in (names.raw, names.clean, names.results):
        ensure_database(spark, database)
    for feed, schema in FEEDS.items():
        ensure_table(spark, f"{names.raw}.{feed}", raw_table_schema(schema))
    ensure_table(spark, f"{names.raw}.quarantine", QUARANTINE, partition_by=["feed", PARTITION])


def load_snapshot(spark: SparkSession, base: str, date: int, lines: bool = False, names: Databases = Databases(), split: bool = False) -> dict[str, str]:
    """Load every feed of one date; a feed that is not there is reported as skipped and the others go on.

    ``lines`` and ``split`` are those of ``read_snapshots``. The date is replaced in the raw table and in the quarantine, also by no rows. Any other failure is raised.
    """
    outcome = {}
    for feed in FEEDS:
        if not has_snapshot(spark, base, feed, date):
            outcome[feed] = "skipped: no folder of this date"
            continue
        good, bad = split_corrupt(read_snapshots(spark, base, feed, date, lines, split))
        append_snapshot(good, f"{names.raw}.{feed}", partitions=[{PARTITION: date}])
        append_snapshot(bad.withColumn("feed", F.lit(feed)), f"{names.raw}.quarantine", partitions=[{"feed": feed, PARTITION: date}])
        outcome[feed] = "loaded"
    return outcome


def run_weekly(
    spark: SparkSession,
    base: str,
    date: int | None = None,
    as_of: dt.date | str | None = None,
    repo_limit: int | None = None,
    annotator: KeywordAnnotator | Callable[[str], str | None] | None = None,
    clusters: int = 4,
    buckets: int = 32,
    lines: bool = False,
    names: Databases = Databases(),
    split: bool = False,
    annotator_version: str | None = None,
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Run all steps for one snapshot; returns the tables written and the outcome of each feed.

    A table is replaced only if every feed it comes from was loaded; the others keep their rows and are not returned.

    The date defaults to today (UTC); ages are counted up to ``as_of``, by default the snapshot date. The tables that are
    joined by repository are stored in ``buckets`` buckets by repository and snapshot, so that the joins read them in place.
    Codes of texts last from run to run in ``label_codes``. With an ``annotator_version``, answers of a Python ``annotator``
    are kept in ``annotations`` and only new texts are put to it.
    """
    date = date or today_utc()
    as_of = as_of or dt.datetime.strptime(str(date), "%Y%m%d").date()
    setup(spark, names)
    outcome = load_snapshot(spark, base, date, lines, names, split)
    raw = {feed: at_snapshot(spark.table(f"{names.raw}.{feed}"), date) for feed in FEEDS}

    def loaded(*feeds: str) -> bool:
        return all(outcome[f"github_{feed}_raw"] == "loaded" for feed in feeds)

    out: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame, database: str = names.clean, key: str | None = None) -> DataFrame:
        out[name] = replace_table(df, f"{database}.{name}", bucket_by=[key, "snapshot_date"] if key else [], buckets=buckets)
        return out[name]

    stamped = {"transformed_at": F.current_timestamp()}
    dated = {"snapshot_date": F.lit(date).cast("long")}
    if loaded("repos"):
        repos = keep("repos_summary", clean_repos(raw["github_repos_raw"], as_of, limit=repo_limit), key="name")
    if loaded("commits"):
        flagged = keep("commits_flagged", flag_commits(raw["github_commits_raw"]), key="repo_full_name")
        keep("commits_clean", flagged.where(~F.col("is_bot_commit")))
    if loaded("contributors"):
        contributors = keep("contributors_clean", clean_contributors(raw["github_contributors_raw"]), key="repo_full_name")
    if loaded("languages"):
        languages = keep("language_summary", language_summary(raw["github_languages_raw"], date=date).withColumns(stamped | dated), key="repo_full_name")
    if loaded("readme"):
        readme_raw = latest_per_key(raw["github_readme_raw"], ["repo_full_name"], "extracted_at", [F.col("sha")])
        keep("readme_summary", readme_summary(readme_raw))
    if not loaded("repos", "commits", "contributors", "languages", "readme"):
        return out, outcome

    features = keep("repo_ml_dataset", repo_features(repos, flagged, contributors, languages).withColumns(stamped))
    texts = readme_raw.select(
        F.col("repo_full_name").alias("repo_name"), decode_content(F.col("content"), F.col("encoding")).alias("text")
    )
    with_text = features.select("repo_name").join(texts, "repo_name", "left")
    if callable(annotator) and annotator_version:
        records = annotate_changed(with_text, "repo_name", "text", annotator, f"{names.clean}.annotations", annotator_version)
    else:
        records = (annotate_replies if callable(annotator) else enrich)(with_text, "repo_name", "text", annotator)
    enriched = keep("repo_enriched", records)

    ready = keep("repo_ml_ready", ml_ready(features, enriched))
    numeric = keep("repo_ml_numeric_final", encode_numeric(ready, "repo_name", IDENTIFIERS, f"{names.results}.label_codes"))

    measures = [c for c in numeric.columns if c not in ("repo_name", "transformed_at")]
    assigned = keep("repo_clusters", kmeans(numeric, measures, clusters, order_by="stars_count"), names.results)
    keep("repo_cluster_summary", group_means(assigned, "cluster", measures), names.results)
    return out, outcome
