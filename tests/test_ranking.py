"""Deduplication and ranking, with a third of the rows in one group."""

import random

import pytest
from pyspark.sql import functions as F

import stargauge as sg


@pytest.fixture(scope="module")
def skewed_rows():
    """One group (and the null group) holds a third of the rows; values tie heavily."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        group = "big" if i % 3 == 0 else (None if i % 3 == 1 else f"g{rng.randrange(40)}")
        rows.append((group, rng.choice([1, 1, 1, 2, 5, None]), f"login{i:05d}"))
    rng.shuffle(rows)
    return rows


def expected_ranks(rows):
    groups = {}
    for g, v, login in rows:
        groups.setdefault(g, []).append((v, login))
    out = {}
    for g, members in groups.items():
        members.sort(key=lambda m: (m[0] is None, -(m[0] or 0), m[1]))
        total = sum(v or 0 for v, _ in members)
        for place, (_, login) in enumerate(members, 1):
            out[login] = (place, total)
    return out


def test_rank_matches_brute_force(spark, skewed_rows):
    df = spark.createDataFrame(skewed_rows, "grp string, v bigint, login string").repartition(7)
    ranked = sg.rank_and_share(df, ["grp"], "v", ["login"], core="core")
    found = {r.login: (r["rank"], r.total) for r in ranked.collect()}
    assert found == expected_ranks(skewed_rows)
    assert ranked.where("core <> (rank <= 10)").count() == 0
    assert ranked.columns == ["grp", "v", "login", "rank", "total", "core"]
    plan = explain(ranked)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_a_big_group_is_cut_over_partitions(spark, skewed_rows):
    df = spark.createDataFrame(skewed_rows, "grp string, v bigint, login string")
    plan = explain(sg.rank_and_share(df, ["grp"], "v", ["login"]))
    assert "ExistingRDD" in plan and "BroadcastExchange" not in plan  # the sorted rows are pinned; offsets join by key


def test_numbering_a_whole_table(spark):
    df = spark.range(1000).repartition(6)
    numbered = sg.rank_in_group(df, [], [F.col("id").desc()], "n")
    assert dict(numbered.dtypes)["n"] == "bigint"
    assert numbered.where(F.col("n") != 1000 - F.col("id")).count() == 0
    assert numbered.columns == ["id", "n"]


def test_latest_per_key_keeps_one_row_per_key(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "b"), ("b", None, "z"), ("b", 0, "q"), (None, 1, "n"), (None, 2, "m")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    out = sg.latest_per_key(df, ["k"], "t", [F.col("v")])
    assert {(r.k, r.t, r.v) for r in out.collect()} == {("a", 3, "b"), ("b", 0, "q"), (None, 2, "m")}


def test_latest_per_key_prunes_before_the_exchange(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    text = explain(sg.latest_per_key(orders, ["o_custkey"], "o_orderdate"))
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def explain(df) -> str:
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_top_per_group_beyond_the_group_limit(spark):
    df = spark.range(5000).withColumn("g", F.col("id") % 2)
    out = sg.top_per_group(df, ["g"], [F.col("id")], 1500)
    assert out.groupBy("g").agg(F.count("*").alias("n"), F.max("id").alias("m")).orderBy("g").collect() == [(0, 1500, 2998), (1, 1500, 2999)]


def test_first_existing_follows_the_listed_order(spark):
    rows = [("r", "readme.md"), ("r", "README.md"), ("s", "README.MD"), ("t", "other.txt")]
    from stargauge.schemas import README_NAMES

    out = sg.first_existing(spark.createDataFrame(rows, "repo string, name string"), "repo", "name", README_NAMES)
    assert {tuple(r) for r in out.collect()} == {("r", "README.md"), ("s", "README.MD")}
