"""Snapshot files, payloads, tables, incremental ingest and the weekly job."""

import base64
import json
import pathlib

import pytest
from pyspark.sql import functions as F

import stargauge as sg
from stargauge.schemas import FEEDS, LANGUAGES
from stargauge.sources import payloads as P
from stargauge.sources.tables import raw_table_schema

FEED = "github_languages_raw"


def put(base, feed, date, rows, name="languages_300.json"):
    folder = base / feed / f"date={date}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(rows if isinstance(rows, str) else json.dumps(rows))


def lang(repo, language, size):
    return {"repo_full_name": repo, "language": language, "bytes": size, "snapshot_date": "text", "unknown": 1}


def test_read_arrays_objects_and_dates(spark, tmp_path):
    put(tmp_path, FEED, 20240101, [lang("a", "Go", 1), lang("a", "C", 2)])
    put(tmp_path, FEED, 20240108, lang("b", "Go", 3))
    rows = sg.read_snapshots(spark, str(tmp_path), FEED)
    assert sorted((r.repo_full_name, r.bytes, r.snapshot_date) for r in rows.collect()) == [("a", 1, 20240101), ("a", 2, 20240101), ("b", 3, 20240108)]
    assert dict(rows.dtypes)["snapshot_date"] == "bigint" and "unknown" not in rows.columns
    one = sg.read_snapshots(spark, str(tmp_path), FEED, 20240108)
    assert one.count() == 1 and len(one.inputFiles()) >= 1


def test_one_date_reads_one_directory(spark, tmp_path):
    from tests.test_ranking import explain

    put(tmp_path, FEED, 20240101, [lang("a", "Go", 1)])
    put(tmp_path, FEED, 20240108, [lang("b", "Go", 3)])
    text = explain(sg.read_snapshots(spark, str(tmp_path), FEED, 20240108))
    assert "PartitionFilters: [isnotnull(date" in text and "20240108" in text


def test_corrupt_text_is_quarantined(spark, tmp_path):
    put(tmp_path, FEED, 20240101, [lang("a", "Go", 1)])
    put(tmp_path, FEED, 20240101, '{"repo_full_name": "b", ', "broken.json")
    put(tmp_path, FEED, 20240101, [{"repo_full_name": "c", "bytes": "many"}], "wrong_type.json")
    good, bad = sg.split_corrupt(sg.read_snapshots(spark, str(tmp_path), FEED))
    assert [r.repo_full_name for r in good.collect()] == ["a"]
    assert bad.count() == 2 and bad.where("corrupt_record is null or snapshot_date <> 20240101").count() == 0


def test_written_snapshots_are_read_back(spark, tmp_path):
    df = spark.createDataFrame([("a", "Go", 1, None)], LANGUAGES)
    for _ in range(2):  # a repeated run replaces the date
        sg.write_snapshot(df, str(tmp_path), FEED, 20240101)
    sg.write_snapshot(df, str(tmp_path), FEED, 20240102)
    assert sg.read_snapshots(spark, str(tmp_path), FEED, lines=True).groupBy("snapshot_date").count().orderBy("snapshot_date").collect() == [(20240101, 1), (20240102, 1)]


def payload(spark, rows):
    return spark.createDataFrame([(n, s, None if b is None else json.dumps(b)) for n, s, b in rows], "full_name string, status int, body string")


def test_flatten_payloads(spark):
    commit = {"sha": "1", "html_url": "u", "commit": {"message": "m", "author": {"name": "n", "email": "e", "date": "2024-01-07T00:00:00Z"}}}
    df = payload(spark, [("a", 200, [commit, {"sha": "2"}]), ("", 200, [commit]), (None, 200, [commit]), ("b", 404, None), ("c", 500, None)])
    out = {r.sha: r for r in P.flatten_commits(df).collect()}
    assert set(out) == {"1", "2"} and out["1"].author_email == "e" and out["1"].commit_date.isoformat() == "2024-01-07T00:00:00"
    assert out["2"].commit_message is None and out["2"].author_name is None
    tally = P.extraction_tally(df).first()
    assert (tally.attempts, tally.success_count, tally.missing_count, tally.error_count) == (3, 1, 1, 1)

    people = P.flatten_contributors(payload(spark, [("a", 200, [{"login": "x", "id": 1, "contributions": 5}])])).first()
    assert (people.repo_full_name, people.contributor_login, people.contributor_id, people.followers_url) == ("a", "x", 1, None)
    languages = P.flatten_languages(payload(spark, [("a", 200, {"Go": 5, "C": 6}), ("b", 200, {})]))
    assert sorted((r.repo_full_name, r.language, r.bytes) for r in languages.collect()) == [("a", "C", 6), ("a", "Go", 5)]
    readme = P.flatten_readme(payload(spark, [("a", 200, {"name": "README.md", "content": "eA==", "encoding": "base64", "_links": {}})])).first()
    assert readme.repo_full_name == "a" and readme.name == "README.md" and readme.extracted_at is not None
    for feed, frame in [("github_commits_raw", P.flatten_commits(df)), (FEED, languages)]:
        assert frame.columns == [f.name for f in FEEDS[feed].fields]


def test_candidates(spark):
    repos = spark.createDataFrame([("a", 5000), ("b", 5001), ("c", 9000), ("d", 5001), ("e", None)], "full_name string, stargazers_count bigint")
    assert [r.full_name for r in P.candidates(repos, 2).collect()] == ["c", "b"]
    assert [r.full_name for r in P.first_repos(repos, 4).collect()] == ["c", "b", "d", "a"]


def test_tables_append_and_replace(spark):
    sg.ensure_database(spark, "t_raw")
    schema = raw_table_schema(LANGUAGES)
    assert sg.ensure_table(spark, "t_raw.languages", schema) and not sg.ensure_table(spark, "t_raw.languages", schema)
    rows = spark.createDataFrame([("a", "Go", 1, None, 20240101)], schema)
    later = rows.withColumn("snapshot_date", F.lit(20240108).cast("long"))
    sg.append_snapshot(rows.unionByName(later), "t_raw.languages")
    sg.append_snapshot(later, "t_raw.languages")  # again: same rows
    assert spark.table("t_raw.languages").count() == 2
    sg.append_snapshot(later, "t_raw.languages", mode="append")
    assert spark.table("t_raw.languages").count() == 3
    with pytest.raises(ValueError):
        sg.append_snapshot(later, "t_raw.languages", mode="replace")
    assert sg.replace_table(rows, "t_raw.copy").count() == 1
    assert sg.replace_table(rows.unionByName(later), "t_raw.copy").count() == 2


def ingest(spark, tmp_path, table, checkpoint, **options):
    sg.ingest_available(spark, str(tmp_path), FEED, table, str(checkpoint), **options).awaitTermination()
    return sorted((r.repo_full_name, r.language, r.bytes, r.snapshot_date) for r in spark.table(table).collect())


def test_incremental_ingest(spark, tmp_path):
    sg.ensure_database(spark, "t_stream")
    table = "t_stream.languages"
    put(tmp_path, FEED, 20240101, [lang("a", "Go", 1), lang("a", "Go", 1)])
    put(tmp_path, FEED, 20240108, [lang("b", "C", 2)])
    first = ingest(spark, tmp_path, table, tmp_path / "ck1", files_per_batch=1)
    assert first == [("a", "Go", 1, 20240101), ("a", "Go", 1, 20240101), ("b", "C", 2, 20240108)]
    put(tmp_path, FEED, 20240108, [lang("late", "C", 9)], "late.json")
    second = ingest(spark, tmp_path, table, tmp_path / "ck1", files_per_batch=1)
    assert second == sorted(first + [("late", "C", 9, 20240108)])
    assert ingest(spark, tmp_path, table, tmp_path / "ck2", files_per_batch=1) == second  # lost checkpoint: same rows
    assert ingest(spark, tmp_path, table, tmp_path / "ck3") == second


def stored_files(spark, table):
    """Data files of a table with their sizes and times of change."""
    top = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first().data_type.removeprefix("file:")
    return {p: (p.stat().st_size, p.stat().st_mtime_ns) for p in pathlib.Path(top).rglob("*.parquet")}


def test_a_late_file_writes_its_own_partition_only(spark, tmp_path):
    sg.ensure_database(spark, "t_ledger")
    table, day = "t_ledger.languages", 20240108
    put(tmp_path, FEED, day, [lang(f"r{k}", "Go", k) for k in range(5_000)], "big.json")
    ingest(spark, tmp_path, table, tmp_path / "ck")
    before = stored_files(spark, table)
    put(tmp_path, FEED, day, [lang("late", "C", 9)], "late.json")
    ingest(spark, tmp_path, table, tmp_path / "ck")
    after = stored_files(spark, table)
    assert {p: after[p] for p in before} == before  # nothing of the date was rewritten
    written = sum(size for p, (size, _) in after.items() if p not in before)
    assert 0 < written < sum(size for size, _ in before.values()) / 5
    names = {r.source_file.rsplit("/", 1)[1]: (r.rows, r.bytes) for r in sg.loaded_files(spark, table).collect()}
    folder = tmp_path / FEED / f"date={day}"
    assert names == {"big.json": (5_000, (folder / "big.json").stat().st_size), "late.json": (1, (folder / "late.json").stat().st_size)}

    ingest(spark, tmp_path, table, tmp_path / "lost")  # from an empty checkpoint: the ledger knows both files
    assert stored_files(spark, table) == after and spark.table(f"{table}_files").count() == 2

    (folder / "late.json").unlink()
    put(tmp_path, FEED, day, [lang("late", "C", 10), lang("later", "C", 11)], "late.json")
    ingest(spark, tmp_path, table, tmp_path / "again")
    final = stored_files(spark, table)
    assert {p: final[p] for p in before} == before
    assert spark.table(table).count() == 5_002 and {r.rows for r in sg.loaded_files(spark, table).collect()} == {5_000, 2}


def test_a_batch_that_runs_twice_leaves_its_rows_once(spark):
    sg.ensure_database(spark, "t_twice")
    rows = spark.createDataFrame([("f1", 1, 20240101), ("f1", 2, 20240101), ("f2", 3, None)], "source_file string, x int, snapshot_date long")
    for _ in range(2):
        sg.merge_files(rows, "t_twice.raw")
    assert sorted(r.x for r in spark.table("t_twice.raw").collect()) == [1, 2, 3]
    sg.merge_files(rows.limit(0), "t_twice.raw")
    assert sg.loaded_files(spark, "t_twice.raw").count() == 2
    sg.ensure_table(spark, "t_twice.old", rows.schema)
    with pytest.raises(ValueError, match="file_id"):
        sg.merge_files(rows, "t_twice.old")


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    date = 20240107
    names = [f"org/r{i}" for i in range(24)]
    put(folder, "github_repos_raw", date, [
        {"full_name": n, "stargazers_count": 6000 + 100 * i, "forks_count": 10 * i, "watchers_count": i, "open_issues_count": 1,
         "language": "Go" if i % 2 else None, "html_url": f"http://h/{n}", "created_at": f"20{10 + i % 12}-01-01T00:00:00Z",
         "updated_at": "2024-01-06T00:00:00Z", "topics": ["x"], "license": {"key": "mit", "name": "MIT"}, "score": 1.0}
        for i, n in enumerate(names)])
    put(folder, "github_commits_raw", date, [
        {"repo_full_name": n, "sha": f"{n}-{j}", "commit_message": ["feat: add things", "Merge pull request #1", "typo"][j % 3],
         "author_name": "dependabot[bot]" if j == 4 else f"dev{j}", "author_email": f"dev{j}@x.io",
         "commit_date": f"2024-01-0{1 + j % 6}T10:00:00Z", "html_url": "u", "snapshot_date": str(date)}
        for i, n in enumerate(names) for j in range(i % 6)])
    put(folder, "github_contributors_raw", date, [
        {"repo_full_name": n, "contributor_login": f"dev{j}", "contributor_id": j, "contributions": j, "html_url": "u", "followers_url": "f"}
        for i, n in enumerate(names) for j in range(i % 5)])
    put(folder, "github_languages_raw", date, [
        {"repo_full_name": n, "language": ["Python", "C", "JavaScript"][j], "bytes": 100 * (j + 1) + i, "extracted_at": "2024-01-07T00:00:00"}
        for i, n in enumerate(names) for j in range(i % 4)])
    put(folder, "github_readme_raw", date, [
        {"repo_full_name": n, "name": "README.md", "sha": "s", "encoding": "base64", "extracted_at": "2024-01-07T00:00:00", "_links": {"x": 1},
         "content": base64.encodebytes(f"# {n}\nA machine learning tool in Python.\n## Usage\nLicense: MIT\n".encode()).decode()}
        for n in names[:20]])
    return folder, date, names


def test_weekly_job(spark, base):
    folder, date, names = base
    out, outcome = sg.run_weekly(spark, str(folder), date)
    assert set(outcome.values()) == {"loaded"}
    assert out["repos_summary"].where("repo_age_days <> datediff(date'2024-01-07', created_at)").count() == 0
    assert out["repos_summary"].count() == len(names)
    assert out["commits_clean"].where("is_bot_commit").count() == 0 and out["commits_flagged"].where("is_bot_commit").count() > 0
    ready = {r.repo_name: r for r in out["repo_ml_ready"].collect()}
    assert len(ready) == len(names) and ready["org/r0"].category == "AI/ML" and ready["org/r23"].category is None
    assert ready["org/r5"].total_commits == 4 and ready["org/r5"].bot_commit_ratio == pytest.approx(0.2)
    assert out["readme_summary"].where("header_count = 2 and has_usage and has_license").count() == 20
    numeric = out["repo_ml_numeric_final"]
    assert numeric.where(" or ".join(f"`{c}` is null" for c in numeric.columns)).count() == 0
    assert "repo_url_label" not in numeric.columns and "category_label" in numeric.columns
    assert out["repo_cluster_summary"].count() == 4 and out["repo_clusters"].count() == len(names)

    again = sg.load_snapshot(spark, str(folder), date)  # a repeated load leaves the same rows
    assert set(again.values()) == {"loaded"}
    assert spark.table("raw_github_data.github_repos_raw").count() == len(names)


def test_a_skipped_feed_replaces_no_table(spark, base, tmp_path):
    folder, date, names = base
    own = sg.Databases("w_raw", "w_clean", "w_results")
    out, _ = sg.run_weekly(spark, str(folder), date, clusters=2, names=own)
    before = {t: df.count() for t, df in out.items()}
    put(tmp_path, "github_repos_raw", date + 7, [{"full_name": "org/new", "stargazers_count": 7000, "created_at": "2020-01-01T00:00:00Z", "updated_at": "2024-01-13T00:00:00Z"}])
    out, outcome = sg.run_weekly(spark, str(tmp_path), date + 7, names=own)
    assert set(out) == {"repos_summary"} and outcome["github_repos_raw"] == "loaded"
    assert [v for k, v in outcome.items() if k != "github_repos_raw"] == ["skipped: no folder of this date"] * (len(FEEDS) - 1)
    assert spark.table("w_clean.repos_summary").count() == 1
    assert spark.table("w_clean.commits_clean").count() == before["commits_clean"] > 0
    assert spark.table("w_results.repo_clusters").count() == before["repo_clusters"]


def test_a_reload_empties_what_became_empty(spark, tmp_path):
    own, date = sg.Databases("x_raw", "x_clean", "x_results"), 20240107
    sg.setup(spark, own)
    put(tmp_path, "github_languages_raw", date, [lang("a", "Go", 1)])
    (tmp_path / "github_languages_raw" / f"date={date}" / "broken.json").write_text("[{not json")
    sg.load_snapshot(spark, str(tmp_path), date, names=own)
    assert spark.table("x_raw.github_languages_raw").count() == 1 and spark.table("x_raw.quarantine").count() == 1
    put(tmp_path, "github_languages_raw", date, [], "broken.json")
    for file in (tmp_path / "github_languages_raw" / f"date={date}").glob("*.json"):
        file.write_text("[]")
    assert sg.load_snapshot(spark, str(tmp_path), date, names=own)["github_languages_raw"] == "loaded"
    assert spark.table("x_raw.github_languages_raw").count() == 0 and spark.table("x_raw.quarantine").count() == 0


def test_weekly_job_goes_on_without_a_feed(spark, base, tmp_path):
    outcome = sg.load_snapshot(spark, str(tmp_path), 20230101)
    assert all(v.startswith("skipped") for v in outcome.values()) and len(outcome) == len(FEEDS)


def test_weekly_job_with_an_annotator(spark, base):
    folder, date, names = base

    def annotator(text):
        return '{"category": "Web Tools", "complexity_level": "advanced", "complexity_score": 3}'

    out, _ = sg.run_weekly(spark, str(folder), date, repo_limit=10, annotator=annotator, clusters=2)
    assert out["repo_ml_ready"].count() == 10
    assert out["repo_enriched"].where("category = 'Web Tools'").count() == sum(n in names[:20] for n in names[-10:])


class FakeSession:
    """A session that names, or does not name, a checkpoint folder."""

    def __init__(self, master, folder=None):
        self.sparkContext = self
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.master = master
        self.used = None

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, folder):
        self.used = folder


def test_checkpoint_folder():
    from stargauge.session import ensure_checkpoint_dir

    named = FakeSession("yarn", "hdfs:///shared/checkpoints")
    ensure_checkpoint_dir(named)
    assert named.used == "hdfs:///shared/checkpoints"
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(FakeSession("yarn"))
    local = FakeSession("local[2]")
    ensure_checkpoint_dir(local)
    assert local.used
