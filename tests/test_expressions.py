"""Golden values of the column expressions."""

import base64

import pytest
from pyspark.sql import functions as F

from stargauge.functions import numbers as N
from stargauge.functions import readme as R
from stargauge.functions import text as X


def values(spark, rows, schema, expr):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    return [r.out for r in df.select("i", expr.alias("out")).orderBy("i").collect()]


def one(spark, items, expr, kind="string"):
    return values(spark, [(x,) for x in items], f"x {kind}", expr)


def test_commit_type(spark):
    messages = ["feat: x", "Fix(core): y", "feature", "docs", "REFACTOR: z", "test(a)", "chore:", "Merge pull request #1", "", None]
    assert one(spark, messages, X.commit_type(F.col("x"))) == [
        "feat", "fix", "other", "other", "refactor", "test", "chore", "other", "other", "other"]


def test_email_cleaning_and_shape(spark):
    mails = [" A@B.io\t", " x@y.com\n", "no-at-sign", "a@b.c", "a@b.cd\n", None]
    clean = X.normalise_email(F.col("x"))
    assert one(spark, mails, clean) == ["a@b.io", "x@y.com", "no-at-sign", "a@b.c", "a@b.cd", None]
    assert one(spark, mails, X.is_valid_email(clean)) == [True, True, False, False, True, False]
    assert one(spark, ["a@b.cd\n"], X.is_valid_email(F.col("x"))) == [False]


def test_bot_flag_matches_inside_names(spark):
    rows = [("dependabot[bot]", None), ("Abbott", "a@b.co"), ("Ann", "ann@NoReply.example"), ("Ann", None), (None, None)]
    assert values(spark, rows, "n string, e string", X.is_bot(F.col("n"), F.col("e"))) == [True, True, True, False, False]


def test_merge_flag(spark):
    assert one(spark, ["Merge branch", "merged", "a merge", None], X.is_merge(F.col("x"))) == [True, True, False, False]


def test_commit_quality_cascade(spark):
    rows = [(True, False, 1), (False, False, 1), (False, True, 9), (False, True, 10), (False, True, None)]
    assert values(spark, rows, "b boolean, v boolean, n int", X.commit_quality(F.col("b"), F.col("v"), F.col("n"))) == [
        "bot_commit", "invalid_email", "short_message", "valid", "valid"]


def test_parse_list_text_in_every_spelling(spark):
    texts = ["['a' 'b']", "['a', 'b c']", '["a"]', "[]", "None", "nan", None, "", "[a]", "['None' 'x']", " ['p'\n 'q'] "]
    assert one(spark, texts, X.parse_list_text(F.col("x"))) == [
        ["a", "b"], ["a", "b c"], ["a"], [], [], [], [], [], ["a"], ["x"], ["p", "q"]]


def test_list_label(spark):
    lists = [["a", "b", "c", "d"], [], None]
    assert one(spark, lists, X.list_label(F.col("x"), "General", first=3), "array<string>") == ["a, b, c", "", "General"]
    assert one(spark, [["x" * 60]], X.list_label(F.col("x"), "-", width=50), "array<string>") == ["x" * 50]


def test_json_out_of_prose(spark):
    texts = ['Sure: {"category": "Other",\n "complexity_score": 2} ok', "no braces", '{"category": ', '{"a": {"category": 1}}', None]
    assert one(spark, texts, X.first_json_object(F.col("x"))) == [
        '{"category": "Other",\n "complexity_score": 2}', None, None, '{"a": {"category": 1}', None]
    record = X.parse_json_record(F.col("x"), "category string, complexity_score bigint")
    assert one(spark, texts, record["category"]) == ["Other", None, None, None, None]


def test_bands_are_right_closed(spark):
    band = N.cut(F.col("x"), N.AGE_EDGES, N.AGE_LABELS)
    assert one(spark, [0.0, 0.1, 2.0, 2.0001, 5.0, 15.1, 100.0, 100.1, None], band, "double") == [
        None, "0-2 years", "0-2 years", "2-5 years", "2-5 years", "15+ years", "15+ years", None, None]
    with pytest.raises(ValueError):
        N.cut(F.col("x"), [0, 1], ["a", "b"])


def test_ratio_and_age(spark):
    assert values(spark, [(1, 0), (1, None), (1, 4)], "a int, b int", N.ratio(F.col("a"), F.col("b"))) == [None, None, 0.25]
    assert one(spark, ["2001-12-31", "2002-01-01", None], N.age_days("2002-01-01", F.col("x").cast("timestamp"))) == [1, 0, None]
    assert one(spark, [364, 365, 800], N.whole_years(F.col("x")), "int") == [0, 1, 2]


def test_small_helpers(spark):
    assert one(spark, [5.0, 500.0, None], N.at_least(F.col("x"), 100.0), "double") == [100.0, 500.0, 100.0]
    assert one(spark, ["b", "z", None], N.level_position(F.col("x"), ["a", "b"])) == [2, None, None]
    assert one(spark, [0, 9], N.lookup_label(F.col("x"), {0: "zero"}, "Cluster "), "int") == ["zero", "Cluster 9"]
    assert one(spark, [0, 9], N.lookup_label(F.col("x"), {0: "zero"}), "int") == ["zero", None]
    assert one(spark, [3.0, 0.0, None], N.guarded(F.col("x"), 6 / F.col("x")), "double") == [2.0, 0.0, 0.0]


README = """# Title

![badge](https://img.shields.io/x) [home](http://a) ![shot](b.png)
## Installation
```
pip install x
```
#hashtag
Usage notes. License: MIT
"""


def test_readme_metrics(spark):
    found = {n: one(spark, [README, "", None], e) for n, e in R.text_metrics(F.col("x")).items()}
    assert found["content_length"] == [len(README), 0, None]
    assert found["word_count_estimate"] == [len(README.split()), 0, None]
    assert found["line_count"] == [README.count("\n") + 1, 1, None]
    assert found["header_count"] == [2, 0, None]
    assert found["code_block_count"] == [1, 0, None]
    assert found["link_count"] == [1, 0, None]
    assert found["image_count"] == [2, 0, None]


def test_readme_flags_know_word_boundaries(spark):
    texts = [README, "a contest and étest", "Testing the docs", None]
    found = {n: one(spark, texts, e) for n, e in R.section_flags(F.col("x")).items()}
    assert found["has_installation"] == [True, False, False, False]
    assert found["has_usage"] == [True, False, False, False]
    assert found["has_license"] == [True, False, False, False]
    assert found["has_tests"] == [False, False, True, False]
    assert found["has_documentation"] == [False, False, True, False]
    assert found["has_badges"] == [True, False, False, False]


def test_every_section_match_holds_a_stem(spark):
    """The cheap test must never hide a match of the pattern."""
    samples = {
        "has_installation": ["install", "installing", "installation", "setup", "getting started"],
        "has_usage": ["usage", "how to use", "example", "examples", "quickstart", "quick start"],
        "has_contributing": ["contribute", "contributing", "contribution", "contributions", "contributor", "contributors"],
        "has_license": ["license", "licence", "licensed"],
        "has_tests": ["test", "tests", "testing"],
        "has_documentation": ["documentation", "docs"],
        "has_badges": ["![a](http://badge)", "![](https://shields.io/x)"],
    }
    for name, texts in samples.items():
        assert all(one(spark, texts, R.section_flags(F.col("x"))[name])), name


def test_decode_base64_with_line_breaks(spark):
    body = base64.encodebytes(("Grüße " * 40).encode()).decode()
    expr = R.decode_content(F.col("c"), F.col("e"))
    assert values(spark, [(body, "base64"), ("plain", "none"), (None, "base64")], "c string, e string", expr) == ["Grüße " * 40, "plain", None]
