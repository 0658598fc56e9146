"""Cleaned tables on small golden inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import stargauge as sg
from tests.test_ranking import explain
from stargauge.schemas import COMMITS, CONTRIBUTORS, LANGUAGES
from stargauge.sources.tables import raw_table_schema

D = 20240107


def test_repos(spark):
    rows = [
        ("a/x", 10, 5, "Go", None, "u1", dt.datetime(2001, 1, 1), D, dt.datetime(2002, 1, 1, 3), 1, 2),
        ("a/x", 20, 5, None, "d", "u2", dt.datetime(2001, 1, 2), D, dt.datetime(2001, 12, 22), 1, 2),
        ("b/y", 7, 0, "C", "d", "u3", None, D, dt.datetime(2002, 1, 1), 1, 2),
        ("c/z", None, 0, "C", "d", "u4", None, 20240101, None, 1, 2),
    ]
    raw = spark.createDataFrame(rows, (
        "full_name string, stargazers_count bigint, forks_count bigint, language string, description string, html_url string,"
        "updated_at timestamp, snapshot_date bigint, created_at timestamp, watchers_count bigint, open_issues_count bigint"))
    out = {r.name: r for r in sg.clean_repos(raw, "2002-01-01").collect()}
    assert (out["a/x"].stars, out["a/x"].language, out["a/x"].repo_age_days, out["a/x"].stars_per_day) == (20, "Unknown", 10, 2.0)
    assert (out["b/y"].repo_age_days, out["b/y"].stars_per_day) == (0, None)
    assert out["c/z"].repo_age_days is None
    assert [r.name for r in sg.clean_repos(raw, "2002-01-01", limit=2).collect()] == ["a/x", "b/y"]
    assert [r.name for r in sg.clean_repos(raw, "2002-01-01", date=20240101).collect()] == ["c/z"]


@pytest.fixture(scope="module")
def commits(spark):
    t = dt.datetime(2024, 1, 7, 0, 0)  # a Sunday
    rows = [
        ("r1", "s1", "feat: a thing", "Ann", " Ann@X.io ", t, "u1", D),
        ("r2", "s1", "feat: a thing", "Ann", "ann@x.io", t, "u2", D),
        ("r1", "s2", "Merge pull request #1", "Abbott", "a@x.io", t, "u3", D),
        ("r1", "s3", "123456789", "Bob", "no-at-sign", t, "u4", D),
        ("r1", "s4", "123456789", "Cy", "c@x.io", t + dt.timedelta(hours=5), "u5", D),
        ("r1", "s5", None, "Cy", "c@x.io", None, "u6", D),
        ("r1", "s6", "1234567890", "Cy", "c@noreply.example", t, "u7", D),
    ]
    names = [f.name for f in raw_table_schema(COMMITS).fields]
    return sg.flag_commits(spark.createDataFrame(rows, raw_table_schema(COMMITS)).select(*names))


def test_commits(spark, commits):
    out = {r.sha: r for r in commits.collect()}
    assert len(out) == 6
    assert out["s1"].repo_full_name == "r1" and out["s1"].author_email == "ann@x.io" and out["s1"].commit_type == "feat"
    assert (out["s1"].commit_day_of_week, out["s1"].commit_hour, out["s1"].commit_date_only) == (1, 0, dt.date(2024, 1, 7))
    assert out["s2"].is_bot_commit and out["s2"].is_merge_commit and out["s2"].data_quality_flag == "bot_commit"
    assert out["s3"].data_quality_flag == "invalid_email"
    assert out["s4"].data_quality_flag == "short_message"
    assert out["s5"].data_quality_flag == "valid" and out["s5"].message_length is None
    assert out["s6"].is_bot_commit


def test_commit_profile_reduces_to_the_clean_table(spark, commits):
    human = commits.where("not is_bot_commit")
    flagged = sg.commit_profile(commits).collect()[0]
    clean = sg.commit_profile(human).collect()[0]
    assert flagged.total_commits == clean.total_commits == 4
    assert flagged.avg_message_length == clean.avg_message_length
    assert flagged.bot_commit_ratio == pytest.approx(2 / 6) and clean.bot_commit_ratio == 0


def test_contributors(spark):
    rows = [("r", f"p{i:02d}", i, 20 - i, "u", "f", D) for i in range(11)]  # 20 .. 10, ranks 1..11
    rows += [("r", "p00", 0, 3, "u", "f", D)]  # a second, smaller sighting
    rows += [("r", None, 50, 15, "u", "f", D), ("r", None, 51, 99, "u", "f", D)]  # no login: rank 1 goes to it
    rows += [("r", "zero", 60, 0, "u", "f", D), ("r", "noid", None, 20, "u", "f", D), ("s", "a", 1, 5, "u", "f", D), ("s", "b", 2, 5, "u", "f", D)]
    raw = spark.createDataFrame(rows, raw_table_schema(CONTRIBUTORS))
    out = sg.clean_contributors(raw)
    r = {x.contributor_login: x for x in out.where("repo_full_name = 'r'").collect()}
    assert set(r) == {f"p{i:02d}" for i in range(11)}
    # 99 (no login) first, then noid before p00 by login, then the rest: gaps stay
    assert r["p00"].contribution_rank == 3 and r["p07"].contribution_rank == 10
    assert r["p07"].is_core_contributor and not r["p08"].is_core_contributor
    total = sum(20 - i for i in range(11))
    assert r["p00"].contribution_percentage == round(20 / total * 100, 2)
    assert abs(sum(x.contribution_percentage for x in r.values()) - 100) <= 0.01 * len(r)
    s = {x.contributor_login: x.contribution_rank for x in out.where("repo_full_name = 's'").collect()}
    assert s == {"a": 1, "b": 2}
    capped = sg.clean_contributors(raw, max_per_repo=2)
    assert capped.groupBy("repo_full_name").count().where("count <> 2").count() == 0


def test_contributors_snapshots_side_by_side_equal_one_by_one(spark):
    rows = [(f"r{i % 3}", f"p{i % 7}", i, i % 5 + 1, f"u{i}", "f", D + i % 2) for i in range(60)]
    raw = spark.createDataFrame(rows, raw_table_schema(CONTRIBUTORS))
    both = sg.clean_contributors(raw).collect()
    single = [r for day in (D, D + 1) for r in sg.clean_contributors(raw, day).collect()]
    assert sorted(both) == sorted(single)


LANGS = [("one", "Go", 10), ("two", "C", 900), ("two", "HTML", 100)]
LANGS += [("six", n, b) for n, b in [("Python", 1001), ("Rust", 1001), ("Shell", 1000), ("CSS", 200), ("X", 160), ("Y", 150)]]


def test_language_summary(spark):
    raw = spark.createDataFrame([(r, l, b, None, D) for r, l, b in LANGS], raw_table_schema(LANGUAGES))
    again = raw.withColumn("snapshot_date", F.col("snapshot_date") + 7)
    out = {r.repo_full_name: r for r in sg.language_summary(raw.unionByName(again), date=D).collect()}
    assert out["one"].language_count == 1 and out["one"].secondary_language is None and out["one"].language_dominance_gap == 100
    assert out["two"].top_5_languages == "C,HTML" and out["two"].languages_above_10_percent == 1  # 10 % is not above 10 %
    assert out["two"].has_web_markup and out["two"].has_compiled_language and not out["two"].has_javascript
    six = out["six"]
    assert (six.primary_language, six.secondary_language, six.tertiary_language) == ("Python", "Rust", "Shell")
    assert six.top_5_languages == "Python,Rust,Shell,CSS,X" and six.total_bytes == 3512
    assert six.languages_above_1000_bytes == 2 and six.languages_above_5_percent == 4
    assert six.smallest_language_pct == 4.27 and six.largest_language_pct == 28.5
    assert "transformed_at" not in six.asDict()


def test_language_summary_agrees_with_full_ranking(spark):
    rows = [(f"r{i % 9}", f"l{(i * 7) % 83}", (i * 131) % 997 + 1, None, D) for i in range(2000)]
    raw = spark.createDataFrame(rows, raw_table_schema(LANGUAGES))
    full = sg.language_details(raw).groupBy("repo_full_name").agg(
        F.count_if(F.col("percentage") > 5).alias("a5"), F.count_if(F.col("percentage") > 10).alias("a10"),
        F.min("percentage").alias("lo"), F.max("percentage").alias("hi"), F.max_by("language", -F.col("language_rank")).alias("first"))
    short = sg.language_summary(raw).select(
        "repo_full_name", F.col("languages_above_5_percent").alias("a5"), F.col("languages_above_10_percent").alias("a10"),
        F.col("smallest_language_pct").alias("lo"), F.col("largest_language_pct").alias("hi"), F.col("primary_language").alias("first"))
    assert sorted(full.collect()) == sorted(short.collect())


def test_share_counts_look_at_every_language(spark):
    """Thirty shares of 100 % and one of -2900 %: weights may be negative."""
    rows = [("r", f"l{i}", 100, None, D) for i in range(30)] + [("r", "less", -2900, None, D)]
    out = sg.language_summary(spark.createDataFrame(rows, raw_table_schema(LANGUAGES))).first()
    assert (out.total_bytes, out.languages_above_5_percent, out.languages_above_10_percent) == (100, 30, 30)


def test_languages_take_the_latest_snapshot(spark):
    rows = [("r", "Go", 15, None, D), ("r", "Go", 40, None, D + 7), ("r", "C", 5, None, D)]
    raw = spark.createDataFrame(rows, raw_table_schema(LANGUAGES))
    assert [tuple(r) for r in sg.language_totals(raw).collect()] == [("r", 40)]
    assert [r.bytes for r in sg.language_details(raw).collect()] == [40]
    assert sg.language_summary(raw).first().total_bytes == 40
    assert sg.language_totals(raw, date=D).first().total_bytes == 20


def test_latest_repository_row_is_decided_by_its_measures(spark):
    from stargauge.schemas import FEEDS

    when = dt.datetime(2024, 1, 1)
    rows = [{"full_name": "a", "html_url": "u", "updated_at": when, "stargazers_count": s, "forks_count": f, "snapshot_date": D} for s, f in ((1, 9), (2, 1), (2, 5))]
    schema = raw_table_schema(FEEDS["github_repos_raw"])
    for order in (rows, rows[::-1]):
        out = sg.clean_repos(spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in order], schema), "2024-01-07").collect()
        assert [(r.stars, r.forks) for r in out] == [(2, 5)]


def test_features_keep_every_repository(spark):
    repos = spark.createDataFrame(
        [("a", "u", "Go", 0, 5, 1, 1, 10, 1.0), ("b", "u", "C", 10, 5, 1, 1, 10, 1.0)],
        "name string, url string, language string, stars bigint, forks bigint, watchers bigint, open_issues bigint, repo_age_days bigint, stars_per_day double")
    commits = spark.createDataFrame([("b", 10, False, False)], "repo_full_name string, message_length int, is_bot_commit boolean, is_merge_commit boolean")
    people = spark.createDataFrame([("b", "p", 4, True), ("b", "q", 2, False)], "repo_full_name string, contributor_login string, contributions bigint, is_core_contributor boolean")
    languages = sg.language_summary(spark.createDataFrame([("b", "Rust", 5)], "repo_full_name string, language string, bytes bigint"))
    out = {r.repo_name: r for r in sg.repo_features(repos, commits, people, languages).collect()}
    assert out["a"].total_commits == 0 and out["a"].primary_language == "Go" and out["a"].primary_language_pct == 0
    assert out["a"].commits_per_contributor is None and out["a"].forks_per_star is None and out["a"].has_javascript is False
    assert out["b"].commits_per_contributor == 0.5 and out["b"].primary_language == "Rust" and out["b"].has_compiled_language
    enriched = spark.createDataFrame([("b", "Other"), ("b", "Web Tools")], "repo_name string, category string")
    assert sg.ml_ready(sg.repo_features(repos, commits, people, languages), enriched).count() == 3  # fan-out is kept


def test_doc_completeness(spark):
    df = spark.createDataFrame([("a", True, True, True, True, True, True, False), ("b", True, False, False, None, True, False, True)],
                               "repo_full_name string, has_installation boolean, has_usage boolean, has_contributing boolean,"
                               "has_license boolean, has_tests boolean, has_documentation boolean, has_badges boolean")
    out = {r.repo_full_name: r for r in sg.doc_completeness(df).collect()}
    assert out["a"].sections_present == 6 and out["a"].missing_sections == [] and out["a"].completeness_pct == 100
    assert out["b"].sections_present == 2 and out["b"].missing_sections == ["Usage", "Contributing", "License", "Documentation"]


def two_snapshots(spark):
    """Two repositories in two snapshots: the second has one more commit, another contributor and another language."""
    repos = spark.createDataFrame(
        [(n, "u", "Go", stars, 1, 1, 0, 10, 1.0, d) for n in ("a/x", "b/y") for d, stars in ((1, 10), (2, 20))],
        "name string, url string, language string, stars long, forks long, watchers long, open_issues long, repo_age_days int, stars_per_day double, snapshot_date long",
    )
    commits = spark.createDataFrame(
        [("a/x", k, False, False, d) for d in (1, 2) for k in range(2 + d)], "repo_full_name string, message_length int, is_merge_commit boolean, is_bot_commit boolean, snapshot_date long"
    )
    people = spark.createDataFrame(
        [("a/x", f"p{k}", 5, True, d) for d in (1, 2) for k in range(d)], "repo_full_name string, contributor_login string, contributions long, is_core_contributor boolean, snapshot_date long"
    )
    languages = spark.createDataFrame(
        [("a/x", lang, 90.0, 1, 1, False, True, d) for d, lang in ((1, "Go"), (2, "C"))],
        "repo_full_name string, primary_language string, primary_language_pct double, language_count long, languages_above_10_percent long, has_javascript boolean, has_compiled_language boolean, snapshot_date long",
    )
    return repos, commits, people, languages


def test_features_keep_snapshots_apart(spark):
    tables = two_snapshots(spark)
    rows = sorted(sg.repo_features(*tables, dated=True).select(
        "repo_name", "snapshot_date", "stars_count", "total_commits", "total_contributors", "primary_language"
    ).collect())
    assert [tuple(r) for r in rows] == [
        ("a/x", 1, 10, 3, 1, "Go"), ("a/x", 2, 20, 4, 2, "C"), ("b/y", 1, 10, 0, 0, "Go"), ("b/y", 2, 20, 0, 0, "Go"),
    ]
    undated = tables[0].where("snapshot_date = 2").drop("snapshot_date")
    latest = sg.repo_features(undated, *tables[1:]).where("repo_name = 'a/x'").first()
    assert (latest.total_commits, latest.total_contributors, latest.primary_language) == (4, 2, "C")
    assert "snapshot_date" not in latest.asDict()


def test_features_of_bucketed_tables_need_no_exchange(spark):
    sg.ensure_database(spark, "t_buckets")
    keys = ["name", "repo_full_name", "repo_full_name", "repo_full_name"]
    tables = two_snapshots(spark)
    stored = [
        sg.replace_table(df, f"t_buckets.t{k}", bucket_by=[key, "snapshot_date"], buckets=4)
        for k, (df, key) in enumerate(zip(tables, keys))
    ]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = sg.repo_features(*stored, dated=True)
        assert "Exchange" not in explain(out) and "SortMergeJoin" in explain(out)
        assert "Exchange" in explain(sg.repo_features(*tables, dated=True))
        rows = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(rows) == sorted(sg.repo_features(*tables, dated=True).collect())
