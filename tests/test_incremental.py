"""What a weekly run keeps from the one before: label codes, annotations, partitions."""

import pathlib

import pytest

import stargauge as sg
from tests.test_ranking import explain


@pytest.fixture(scope="module")
def database(spark):
    sg.ensure_database(spark, "kept")
    return "kept"


def codes(df):
    return {(r.column, r.value): r.code for r in df.collect()}


def test_codes_last_over_growing_snapshots(spark, database):
    table = f"{database}.codes"
    one = spark.createDataFrame([("m", "x"), ("t", None), ("m", "x")], "a string, b string")
    two = spark.createDataFrame([("a", "x"), ("z", "w"), ("m", None), ("n", "x")], "a string, b string")
    first = codes(sg.extend_codes(one, ["a", "b"], table))
    assert first == codes(sg.label_codes(one, ["a", "b"])) == {("a", "m"): 1, ("a", "t"): 2, ("b", "x"): 1}
    second = codes(sg.extend_codes(two, ["a", "b"], table))
    assert second == first | {("a", "a"): 3, ("a", "n"): 4, ("a", "z"): 5, ("b", "w"): 2}
    for again in (one, two, two.limit(0)):  # nothing new, nothing written
        assert codes(sg.extend_codes(again, ["a", "b"], table)) == second
    assert spark.table(table).count() == len(second)
    added = codes(sg.extend_codes(two.selectExpr("a", "a AS c"), ["a", "c"], table))
    assert {c: v for (k, c), v in added.items() if k == "c"} == {"a": 1, "m": 2, "n": 3, "z": 4}
    assert {k: v for k, v in added.items() if k[0] == "a"} == {k: v for k, v in second.items() if k[0] == "a"}


def test_numbers_of_a_table_keep_their_codes(spark, database):
    table = f"{database}.list_codes"
    one = spark.createDataFrame([(1, "q", ["b"]), (2, None, None)], "k int, t string, l array<string>")
    two = spark.createDataFrame([(1, "q", ["b"]), (3, "a", ["a", "c"]), (4, "q", [])], "k int, t string, l array<string>")

    def numbers(df):
        return {r.k: (r.t_label, r.l_label) for r in sg.encode_numeric(df, "k", code_table=table).collect()}

    assert numbers(one) == {1: (1, 1), 2: (0, 0)}
    assert numbers(two) == {1: (1, 1), 3: (2, 2), 4: (1, 3)}


def test_a_second_run_asks_about_changed_texts_only(spark, database, tmp_path):
    table, log = f"{database}.answers", str(tmp_path)

    def annotator(text):
        import uuid

        with open(f"{log}/{uuid.uuid4().hex}", "w") as out:
            out.write(text)
        if text.startswith("boom"):
            raise RuntimeError("service down")
        return "no record" if text == "chat" else '{"category": "Other", "tech_stack": ["%s"], "complexity_score": 2}' % text

    def run(rows, version="1"):
        seen = set(pathlib.Path(log).iterdir())
        df = spark.createDataFrame(rows, "hash int, text string, category string")
        out = sg.annotate_changed(df, "hash", "text", annotator, table, version, outcome="told").collect()
        out += sg.annotate_changed(df.limit(0), "hash", "text", annotator, table, version, outcome="told").collect()
        asked = sorted(p.read_text() for p in set(pathlib.Path(log).iterdir()) - seen)
        return asked, sorted((r.hash, r.told, r.category, (r.tech_stack or [None])[0]) for r in out)

    rows = [(1, "one", "own"), (2, "two", None), (3, "one", None), (3, "one", None), (4, None, None), (5, "", "x"), (6, "boom", None), (7, "chat", None)]
    want = [(1, "ok", "Other", "one"), (2, "ok", "Other", "two"), (3, "ok", "Other", "one"), (3, "ok", "Other", "one"),
            (4, "no text", None, None), (5, "no text", None, None), (6, "failed", None, None), (7, "unusable", None, None)]
    assert run(rows) == (["boom", "chat", "one", "two"], want)
    assert run(rows) == (["boom"], want)  # only the failure is tried again
    changed = [(1, "one!", None) if r[0] == 1 else r for r in rows if r[0] != 6]
    asked, out = run(changed)
    assert asked == ["one!"] and out[0] == (1, "ok", "Other", "one!") and len(out) == 7
    assert run(rows, "2")[0] == ["boom", "chat", "one", "two"]  # a new version answers all anew


def test_the_latest_snapshot_is_found_without_reading(spark, database):
    table = f"{database}.dated"
    df = spark.createDataFrame([(1, 20240101), (2, 20240108), (3, 20240108)], "v int, snapshot_date long")
    sg.ensure_table(spark, table, df.schema)
    assert sg.latest_snapshot(spark, table).count() == 0
    sg.append_snapshot(df, table)
    latest = sg.latest_snapshot(spark, table)
    assert sorted(r.v for r in latest.collect()) == [2, 3] == sorted(r.v for r in sg.one_snapshot(spark.table(table)).collect())
    plan = explain(latest)
    assert "PartitionFilters" in plan and "20240108" in plan and "Subquery" not in plan and "Aggregate" not in plan
    sg.append_snapshot(df.where("v = 1").selectExpr("v", "20240115L AS snapshot_date"), table)
    assert [r.v for r in sg.latest_snapshot(spark, table).collect()] == [1]


def test_the_latest_of_tables_partitioned_by_more(spark, database):
    table = f"{database}.by_file"
    df = spark.createDataFrame([(1, 20240101, "snapshot_date=20990101"), (2, 20240108, "b")], "v int, snapshot_date long, source_file string")
    df.write.partitionBy("snapshot_date", "source_file").saveAsTable(table)
    assert [r.v for r in sg.latest_snapshot(spark, table).collect()] == [2]
