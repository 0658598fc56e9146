"""Summaries beside the exact figures: frequent values and distinct counts over snapshots."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import stargauge as sg
from tests.test_ranking import explain


def skewed(rows, values, seed=1):
    rng = random.Random(seed)
    return [int(values ** rng.random()) for _ in range(rows)]


def expected(values, k):
    return sorted(collections.Counter(v for v in values if v is not None).items(), key=lambda c: (-c[1], c[0]))[:k]


@pytest.mark.parametrize("kind", ["int", "string", "date"])
def test_frequent_values_are_exact_without_counting_all(spark, kind):
    values = skewed(20_000, 5_000) + [None] * 500
    typed = {"int": "v", "string": "concat('w', v)", "date": "date_add(DATE'2000-01-01', v)"}[kind]
    df = spark.createDataFrame([(v,) for v in values], "v int").selectExpr(f"{typed} AS v", "'own' AS n").repartition(6)
    want = [tuple(r) for r in sg.value_counts(df, "v").orderBy(F.desc("n"), "v").limit(8).collect()]
    assert [n for _, n in want] == [n for _, n in expected(values, 8)]
    assert "join" not in explain(sg.top_counts(df.limit(0), "v", 8)).lower()
    got = sg.top_counts(df, "v", 8, tracked=512)
    assert [tuple(r) for r in got.collect()] == want
    assert "Exchange hashpartitioning" not in explain(got) and "Scan ExistingRDD" in explain(got)


def test_flat_columns_are_counted_in_full(spark):
    flat = spark.range(3_000).selectExpr("id % 1000 AS v")
    got = sg.top_counts(flat, "v", 5, tracked=128)
    assert [tuple(r) for r in got.collect()] == [(i, 3) for i in range(5)]  # ties by value
    assert "HashAggregate" in explain(got)


def test_ties_at_the_last_place_and_few_values(spark):
    df = spark.createDataFrame([(v,) for v in ["b"] * 5 + ["a"] * 5 + ["c"] * 5 + ["d"] + [None] * 9], "v string")
    for k in (1, 2, 4, 9):
        assert [tuple(r) for r in sg.top_counts(df, "v", k).collect()] == expected(["b"] * 5 + ["a"] * 5 + ["c"] * 5 + ["d"], k)
    assert sg.top_counts(df.where("v is null"), "v", 3).count() == 0 == sg.top_counts(df, "v", 0).count()


def test_any_summary_gives_the_same_answer(spark):
    for seed in range(3):
        values = skewed(3_000, 10 ** (seed + 1), seed)
        df = spark.createDataFrame([(v,) for v in values], "`a b` long").repartition(5)
        for tracked, candidates in ((8, 4), (64, 8), (4096, 0)):
            got = [tuple(r) for r in sg.top_counts(df, "a b", 4, tracked=tracked, candidates=candidates).collect()]
            assert got == expected(values, 4)


def test_other_types_are_counted_in_full(spark):
    df = spark.createDataFrame([(0.5,), (0.5,), (float("nan"),)], "v double")
    assert [r.n for r in sg.top_counts(df, "v", 1).collect()] == [2]


def test_distinct_counts_over_any_range_of_snapshots(spark):
    dates = [20240101, 20240108, 20240115, 20240122]
    sg.ensure_database(spark, "sketched")
    rows = spark.range(40_000).selectExpr(
        "CASE WHEN id % 4 = 0 THEN 'small' ELSE 'large' END AS repo", "id % 17 AS _",
        "CASE WHEN id % 4 = 0 THEN cast(id % 20 AS string) WHEN id % 9 <> 0 THEN concat('u', (id * 7919) % 9000) END AS author",
        f"element_at(array({', '.join(f'{d}L' for d in dates)}), cast(1 + (id * 31 + id div 977) % 4 AS int)) AS snapshot_date",
    )
    sketches = sg.distinct_sketches(rows, ["repo"], "author")
    sg.ensure_table(spark, "sketched.authors", sketches.schema)
    for date in [*dates, dates[1]]:  # one date is loaded twice
        sg.append_snapshot(sketches.where(F.col("snapshot_date") == date), "sketched.authors")
    stored = spark.table("sketched.authors")
    assert stored.count() == 8
    for since, until in ((None, None), (dates[1], dates[2]), (dates[3], None), (None, dates[0])):
        chosen = rows.where(F.col("snapshot_date").between(since or 0, until or 99999999))
        exact = {r.repo: r.n for r in chosen.groupBy("repo").agg(F.countDistinct("author").alias("n")).collect()}
        got = {r.repo: r.n for r in sg.distinct_over(stored, ["repo"], since, until, "n").collect()}
        assert got.keys() == exact.keys() and got["small"] == exact["small"]
        assert abs(got["large"] - exact["large"]) <= 4 * sg.distinct_error() * exact["large"]
    assert "PartitionFilters: [isnotnull(snapshot_date" in explain(sg.distinct_over(stored, ["repo"], dates[1]))
    nothing = spark.createDataFrame([("r", None, 1)], "repo string, author string, snapshot_date long")
    assert [tuple(r) for r in sg.distinct_over(sg.distinct_sketches(nothing, ["repo"], "author"), ["repo"]).collect()] == [("r", 0)]
