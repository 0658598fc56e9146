"""Contingency tables, flows, histograms, top-k, profiles, encoding and grouping."""

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

import stargauge as sg
from stargauge.operators import enrich as EN
from stargauge.operators.cluster import best_kmeans
from stargauge.plans import reports as R


@pytest.fixture(scope="module")
def repos(spark):
    rows = [
        ("a", 100, 10, 3650.0, "Go", "AI/ML", "beginner", ["x", "y", "cli-automation"]),
        ("b", 50, 5, 730.0, "Go", "AI/ML", "advanced", ["x"]),
        ("c", 50, 1, 0.0, "C", "Graphics", "advanced", ["x", "y"]),
        ("d", None, 1, 40000.0, None, None, None, None),
        ("e", 10, 2, 731.0, "C", "AI/ML", "odd", ["y", "", "x"]),
        ("f", 9, 2, 100.0, "R", "AI/ML", "beginner", ["y"]),
    ]
    return spark.createDataFrame(rows, "repo_name string, stars_count bigint, forks_count bigint, repo_age_days double,"
                                       "primary_language string, category string, complexity_level string, use_cases array<string>")


LEVELS = ["beginner", "intermediate", "advanced"]


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_bands_show_empty_labels(repos):
    assert rows_of(R.age_bands(repos), "age_bin", "n") == [
        ("0-2 years", 2), ("2-5 years", 1), ("5-10 years", 1), ("10-15 years", 0), ("15+ years", 0)]


def test_levels(repos):
    assert rows_of(sg.level_counts(repos, "complexity_level", LEVELS), "complexity_level", "n") == [("beginner", 2), ("advanced", 2)]
    assert rows_of(sg.level_means(repos, "complexity_level", LEVELS, ["stars_count"]), "complexity_level", "avg_stars_count") == [
        ("beginner", 54.5), ("advanced", 50.0), ("odd", 10.0)]
    assert rows_of(sg.level_stats(repos, "complexity_level", LEVELS, "stars_count"), "complexity_level", "n", "avg_stars_count") == [
        ("beginner", 2, 54.5), ("intermediate", 0, 0.0), ("advanced", 2, 50.0)]
    profile = sg.level_profile(repos, "primary_language", "complexity_level", LEVELS, k=2)
    assert rows_of(profile, "primary_language", "complexity_level", "n") == [
        ("C", "advanced", 1), ("C", "odd", 1), ("Go", "beginner", 1), ("Go", "advanced", 1)]


def test_crosstab(repos):
    table = sg.crosstab(repos, "primary_language", "category", ["AI/ML", "Graphics"], k=2)
    assert [tuple(r) for r in table.collect()] == [("C", 1, 1), ("Go", 2, 0)]
    found = sg.crosstab(repos, "primary_language", "category", ["None", "Graphics"], k=2)  # one nobody has, one not listed
    assert found.columns == ["primary_language", "None", "Graphics", "AI/ML"]
    assert [tuple(r) for r in found.collect()] == [("C", 0, 1, 1), ("Go", 0, 0, 2)]


def test_hierarchy_parents_are_sums_of_children(repos):
    tree = sg.hierarchy(repos, ["category", "primary_language", "complexity_level"])
    by_depth = dict(tree.groupBy("depth").agg(F.sum("n")).collect())
    assert by_depth == {1: 5, 2: 5, 3: 5}
    assert tree.where("depth = 1 and category = 'AI/ML'").first().n == 4


def test_flow(repos):
    pairs = sg.flow_pairs(repos, "category", "use_cases", exclude=["cli-automation"], k=8, min_count=2)
    assert sorted(rows_of(pairs, "category", "item", "n")) == [("AI/ML", "x", 3), ("AI/ML", "y", 3)]
    assert rows_of(sg.flow_nodes(pairs, "category").orderBy("node_index"), "node", "node_index") == [("AI/ML", 0), ("x", 1), ("y", 2)]
    assert sorted(rows_of(sg.flow_links(pairs, "category"), "source_index", "target_index", "value")) == [(0, 1, 3), (0, 2, 3)]


def test_lists(repos):
    assert rows_of(sg.list_counts(repos, "use_cases"), "item", "n") == [("x", 4), ("y", 4), ("cli-automation", 1)]
    found = R.audience_repos(repos.withColumnRenamed("use_cases", "audience"), "y")
    assert [r[0] for r in found.collect()] == ["a", "c", "e", "f"]


def test_other_bucket_and_semi(repos):
    out = rows_of(sg.other_bucket(repos, "primary_language", 1, "g").orderBy("repo_name"), "repo_name", "g")
    assert out == [("a", "Other"), ("b", "Other"), ("c", "C"), ("d", "Other"), ("e", "C"), ("f", "Other")]  # C before Go at a tie
    assert sg.top_k_semi(repos, "primary_language", 2).count() == 4


def test_search_and_lookup(repos):
    assert [r.repo_name for r in R.search_repos(repos, [], [], 50).collect()] == ["a", "b", "c"]
    assert [r.repo_name for r in R.search_repos(repos, ["AI/ML"], ["beginner", "odd"], 10).collect()] == ["a", "e"]
    assert sg.lookup(repos, "repo_name", "x' or '1'='1").count() == 0
    assert sg.lookup(repos, "category", "AI/ML", ["repo_name"]).first().repo_name == "a"


def test_suffixed_join_keeps_left_rows(spark, repos):
    right = spark.createDataFrame([("a", "Zig"), ("zz", "Ada")], "repo_name string, primary_language string")
    out = sg.left_join_suffixed(repos, right, "repo_name", "repo_name", "_lang")
    assert out.count() == 6 and "primary_language_lang" in out.columns
    shown = sg.fallback(out, "shown", "primary_language_lang", "primary_language", "absent")
    assert dict(rows_of(shown, "repo_name", "shown"))["a"] == "Zig" and dict(rows_of(shown, "repo_name", "shown"))["b"] == "Go"


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0.5, 1, 19.99, 20, 20]] + [(None,)], "v double")
    out = {r.bin: r.n for r in sg.histogram(df, "v", 20).collect()}
    assert out == {0: 2, 1: 1, 19: 3}
    same = spark.createDataFrame([(3.0, "a"), (3.0, "a"), (1.0, "b"), (2.0, "b")], "v double, g string")
    assert {(r.g, r.bin): r.n for r in sg.histogram(same, "v", 2, by=["g"]).collect()} == {("a", 0): 2, ("b", 0): 1, ("b", 1): 1}


def test_profile_guards(spark):
    df = spark.createDataFrame([("p", 1.0, 5.0, -1.0), ("p", 3.0, 5.0, 1.0), ("q", 8.0, 5.0, 0.0)], "g string, v double, c double, z double")
    out = {(r.g, r.feature): r for r in sg.group_profile(df, "g", ["v", "c", "z"]).collect()}
    sd = statistics.stdev([1, 3, 8])
    assert out["p", "v"].z_score == pytest.approx((2 - 4) / sd) and out["p", "v"].difference_pct == pytest.approx(-50)
    assert out["p", "c"].z_score == 0 and out["p", "c"].difference_pct == 0
    assert out["p", "z"].difference_pct == 0  # overall mean 0
    order = rows_of(sg.by_distinctness(sg.group_profile(df, "g", ["c", "v"]), "g"), "g", "feature")
    assert order == [("p", "v"), ("p", "c"), ("q", "v"), ("q", "c")]


def test_label_codes_number_distinct_values(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("abcdefghijkl"), None if i % 4 == 0 else f"v{rng.randrange(30):02d}") for i in range(400)]
    df = spark.createDataFrame(rows, "id int, s string, t string")
    out = {r.id: r for r in sg.label_encode(df, ["s", "t"]).collect()}
    for column, values in (("s", [r[1] for r in rows]), ("t", [r[2] for r in rows])):
        code = {v: i for i, v in enumerate(sorted({v for v in values if v is not None}), 1)}
        assert all(out[i][f"{column}_label"] == code.get(values[i], 0) for i in range(400))


def test_encode_numeric_has_no_nulls(spark):
    t = dt.datetime(1970, 1, 1, 0, 1, 0, 900_000)
    df = spark.createDataFrame([("k", 1, 1.5, True, "b", t, ["x"], "id1"), ("l", None, None, None, None, None, None, "id2"), ("m", 2, 0.0, False, "a", t, ["x"], "id3")],
                               "key string, i int, d double, f boolean, s string, t timestamp, l array<string>, url string")
    out = sg.encode_numeric(df, "key", exclude=["url"]).orderBy("key")
    assert out.columns == ["key", "i", "d", "f", "t", "s_label", "l_label"]
    assert [tuple(r) for r in out.collect()] == [("k", 1, 1.5, 1, 60, 2, 1), ("l", 0, 0.0, 0, 0, 0, 0), ("m", 2, 0.0, 0, 60, 1, 1)]


def test_standardise_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 4), (3.0, 4), (None, 4)], "x double, c int")
    out = sg.standardise(df, ["x", "c"]).collect()
    sd, mean = statistics.pstdev([1, 3, 0]), statistics.mean([1, 3, 0])
    assert [r.x for r in out] == pytest.approx([(v - mean) / sd for v in (1, 3, 0)])
    assert [r.c for r in out] == [0, 0, 0]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(1)
    centres = [(0, 0), (50, 0), (0, 50), (50, 50)]
    rows = [(i, i % 4, centres[i % 4][0] + rng.gauss(0, 1), centres[i % 4][1] + rng.gauss(0, 1), 7.0) for i in range(200)]
    return spark.createDataFrame(rows, "id int, planted int, stars_count double, forks_count double, constant double")


def test_kmeans_recovers_planted_groups(blobs):
    out = sg.kmeans(blobs, ["stars_count", "forks_count", "constant"], k=4, restarts=5)
    assert out.columns == [*blobs.columns, "cluster"] and out.count() == 200
    pairs = out.groupBy("planted", "cluster").count().collect()
    assert len(pairs) == 4 and {r["count"] for r in pairs} == {50}
    means = rows_of(out.groupBy("cluster").agg(F.avg("stars_count").alias("m")).orderBy("cluster"), "cluster", "m")
    assert [c for c, _ in means] == [0, 1, 2, 3] and [m for _, m in means] == sorted((m for _, m in means), reverse=True)


def lloyd(x, centres):
    """Plain k-means from given centres: centres and cost."""
    for _ in range(300):
        near = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([x[near == j].mean(axis=0) if (near == j).any() else centres[j] for j in range(len(centres))])
        if ((moved - centres) ** 2).sum() <= 1e-4:
            break
        centres = moved
    return centres, ((x[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum()


def test_restarts_advance_in_one_pass(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5)) + rng.integers(0, 3, size=(400, 1)) * 2.0
    rows = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(5)
    spark.sparkContext.setJobGroup("restarts", "restarts")
    try:
        best = best_kmeans(rows, "v", k=4, restarts=10)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("restarts"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    costs = [best_kmeans(rows, "v", k=4, restarts=1, seed=s) for s in range(3)]
    assert best.passes <= 4 + 60 and jobs <= 4 * best.passes  # adaptive execution makes a job of every stage
    centres, cost = lloyd(x, best.points)
    assert cost == pytest.approx(best.cost, rel=0.01) and best.cost <= min(c.cost for c in costs) * 1.02
    assert np.abs(centres - best.points).max() < 0.1
    ml = min(KMeans(k=4, seed=s, featuresCol="v").fit(rows.select(array_to_vector("v").alias("v"))).summary.trainingCost for s in range(3))
    assert best.cost <= ml * 1.02
    again = best_kmeans(rows.repartition(3), "v", k=4, restarts=10)
    assert np.allclose(np.sort(again.points, axis=0), np.sort(best.points, axis=0))


def test_tasks_of_a_pass_follow_the_vectors_not_the_partitions(spark):
    """Few vectors in very many partitions: a pass is one small job, and the partitions change nothing."""
    rows = spark.range(600).select(F.array((F.col("id") % 7).cast("double"), (F.col("id") % 11).cast("double")).alias("v"))
    spark.sparkContext.setJobGroup("spread", "spread")
    try:
        many = best_kmeans(rows.repartition(64), "v", k=3, restarts=4)
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("spread") for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sum(s.numTasks for s in stages if s) < 5 * 64 + 2 * many.passes < 64 * many.passes
    one = best_kmeans(rows.coalesce(1), "v", k=3, restarts=4)
    assert many.cost == pytest.approx(one.cost) and np.allclose(many.points, one.points)


def test_kmeans_of_few_equal_and_missing_rows(spark):
    rows = spark.createDataFrame([([1.0, 2.0],)] * 30 + [([5.0, 5.0],)] + [(None,)], "v array<double>")
    best = best_kmeans(rows, "v", k=4, restarts=3)
    assert len(best.points) == 2 and best.cost == pytest.approx(0)
    found = rows.withColumn("c", best.nearest(F.col("v"))).groupBy("c").count().collect()
    assert sorted((r.c is None, r["count"]) for r in found) == [(False, 1), (False, 30), (True, 1)]
    assert len(best_kmeans(rows.limit(0), "v").points) == 0


def test_cluster_reports(blobs):
    rows = R.clustered(blobs.withColumn("repo_name", F.col("id").cast("string")), restarts=2)
    assert rows.where("cluster_name is null").count() == 0
    assert R.cluster_sizes(rows).agg(F.sum("repos")).first()[0] == 200
    compared = R.cluster_comparison(rows)
    zeros = ["avg_commits", "avg_contributors", "avg_age_years", "avg_stars_per_day", "avg_languages"]
    assert compared.columns == ["cluster", "repos", "avg_stars", "avg_forks", *zeros, "cluster_label"]
    assert {tuple(r) for r in compared.select(*zeros).collect()} == {(0, 0, 0.0, 0.0, 0.0)}  # measures the rows lack
    assert R.cluster_top_repos(rows, 3).count() == 12
    assert R.repo_cluster(rows, "5").count() == 1
    assert sg.group_means(rows, "cluster", ["stars_count"]).count() == 4


def test_coverage_of_nothing(repos):
    full = R.coverage(repos).first()
    assert (full.total, full.covered, full.distinct_values) == (6, 5, 2) and full.coverage_pct == pytest.approx(500 / 6)
    assert R.coverage(repos.where("1 = 0")).first().coverage_pct == 0


def test_enrichment_with_rules(spark):
    texts = [("a", "A machine learning library in Python for research"), ("b", ""), ("c", None), ("d", "x" * 20000)]
    out = {r.k: r for r in sg.enrich(spark.createDataFrame(texts, "k string, text string"), "k", "text").collect()}
    assert out["a"].category == "AI/ML" and out["a"].tech_stack == ["Python"] and "researcher" in out["a"].audience
    assert out["a"].complexity_level == "beginner" and out["d"].complexity_score == 3 and out["d"].category == "Other"
    assert all(v is None for n in "bc" for f, v in out[n].asDict().items() if f != "k")


def test_words_that_rules_ask_for():
    from stargauge.operators.enrich import _alternatives, rule_marks

    assert _alternatives(r"a|(b|c)d|[|)]e|\||f") == ["a", "(b|c)d", "[|)]e", r"\|", "f"]
    assert rule_marks(r"\bnetwork|\btcp\b") == {"net", "tcp"} and rule_marks(r"\bcach(e|ing)\b") == {"cac"}
    assert rule_marks(r"\bweb+\b") == {"web"} and rule_marks(r"\bmachine learning\b") == {"mac"}
    for free in (r"\bgo (get|build)\b", r"\bc\+\+", "network", r"\bweb?\b", r"\bnet|tcp", r"\b(net|tcp)\b", r"(?i)\bweb", r"\bwe\w", r"\bweb{0,1}x", "", r"\bnet|"):
        assert rule_marks(free) is None, free


def test_the_index_of_words_changes_no_record(spark):
    rules = [r for kind in (EN.CATEGORY_RULES, EN.STACK_RULES, EN.AUDIENCE_RULES, EN.USE_CASE_RULES) for p in kind.values() for r in EN._alternatives(p)]
    heads = [r.replace("\\b", "").replace("\\+", "+").split("(")[0].split("[")[0].split(".")[0].split("?")[0] for r in rules]
    rng = random.Random(5)
    between = [" ", "-", "_", "\n", "é", "\u0301", "日", ".", "", " x"]
    texts = ["".join(rng.choice([h.upper(), h, h[:-1], "s" + h]) + rng.choice(between) for h in rng.choices(heads, k=rng.randrange(6))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate([*texts, None, ""])), "k int, text string")
    plain = EN.KeywordAnnotator().record(F.col("text"))
    want = df.select("k", *[plain[name].alias(name) for name in EN.FIELDS])
    assert sorted(map(repr, sg.enrich(df, "k", "text").collect())) == sorted(map(repr, want.collect()))
    own = EN.KeywordAnnotator({"A": "x"}, {}, {"b": r"\bserver"}, {})
    assert sg.enrich(df, "k", "text", own).count() == 602


def test_enrichment_with_replies(spark):
    def annotator(text):
        if text == "boom":
            raise RuntimeError("service down")
        if text == "chat":
            return "I do not know."
        return 'Here: {"category": "Other", "audience": ["x"], "complexity_score": 2} bye'

    df = spark.createDataFrame([("a", "fine"), ("b", "boom"), ("c", "chat"), ("d", None)], "k string, text string")
    out = {r.k: r for r in sg.annotate_replies(df, "k", "text", annotator).collect()}
    assert out["a"].category == "Other" and out["a"].audience == ["x"] and out["a"].complexity_score == 2
    assert len(out) == 4 and all(out[k].category is None and out[k].audience is None for k in "bcd")
    told = {r.k: r.outcome for r in sg.annotate_replies(df, "k", "text", annotator, outcome="outcome").collect()}
    assert told == {"a": "ok", "b": "failed", "c": "unusable", "d": "no text"}
    report = sg.vocabulary_report(sg.annotate_replies(df, "k", "text", annotator)).first()
    assert (report.records, report.bad_category, report.bad_audience) == (4, 0, 1)


def test_cards_and_breakdown(spark, repos):
    card = {r.repo_name: r for r in R.entity_card(repos.withColumns({"total_commits": F.lit(None).cast("int"), "total_contributors": F.lit(2)})).collect()}
    assert (card["d"].stars_count, card["d"].total_commits, card["a"].age_years) == (0, 0, 10)
    summary = spark.createDataFrame([("a", "Go", 60.0, "C", None, None, None)],
                                    "repo_full_name string, primary_language string, primary_language_pct double, secondary_language string,"
                                    "secondary_language_pct double, tertiary_language string, tertiary_language_pct double")
    assert rows_of(R.language_breakdown(summary), "place", "language", "percentage") == [(1, "Go", 60.0), (2, "C", 0.0)]


def test_activity(spark):
    day = dt.date(2024, 1, 1)
    rows = [("r", day + dt.timedelta(days=i // 2), f"a{i % 3}") for i in range(20)] + [("r", None, "a9"), ("s", day, None)]
    commits = spark.createDataFrame(rows, "repo_full_name string, commit_date_only date, author_name string")
    daily = R.daily_activity(commits, days=4)
    assert rows_of(daily.where("repo_full_name = 'r'"), "commit_date_only", "commit_count", "unique_authors") == [
        (day + dt.timedelta(days=i), 2, 2) for i in range(6, 10)]
    kpi = {r.repo_full_name: r for r in R.activity_kpis(daily).collect()}
    assert (kpi["r"].total, kpi["r"].avg_per_day, kpi["r"].peak) == (8, 2.0, 2) and kpi["s"].total == 1
    top = R.top_authors(commits, k=2)
    assert rows_of(top, "repo_full_name", "author_name", "commit_count", "first_commit") == [
        ("r", "a0", 7, "2024-01-01"), ("r", "a1", 7, "2024-01-01")]
