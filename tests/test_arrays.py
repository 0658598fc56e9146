"""Array files split over tasks: the rows of the whole-file reader, whatever the cuts."""

import json
import random

import pytest

import stargauge as sg
from stargauge.session import ship_package
from stargauge.sources.arrays import array_objects
from tests.test_sources import FEED, lang, put

DATE = 20240101


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def blocks(spark):
    """Sets the largest split, so that small files have many blocks."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def texts(spark, base):
    return [r.text for r in array_objects(spark, f"{base}/{FEED}").collect()]


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def odd_text(rng):
    return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", "\n", "é", "日", "a", " "]) for _ in range(rng.randrange(25)))


def odd_value(rng, deep=0):
    kind = rng.randrange(5 if deep < 3 else 2)
    if kind == 0:
        return odd_text(rng)
    if kind == 1:
        return rng.randrange(1000)
    if kind == 2:
        return [odd_value(rng, deep + 1) for _ in range(rng.randrange(3))]
    return {odd_text(rng): odd_value(rng, deep + 1) for _ in range(rng.randrange(4))}


@pytest.mark.parametrize("size", [37, 200, 100_000])
def test_objects_survive_every_cut(spark, tmp_path, blocks, size):
    rng = random.Random(size)
    wanted = []
    for i in range(4):
        objects = [{"n": i, "v": odd_value(rng)} for _ in range(15)]
        wanted += objects
        put(tmp_path, FEED, DATE, json.dumps(objects, ensure_ascii=i % 2 == 0, indent=[None, 2][i // 2]), f"f{i}.json")
    blocks(size)
    found = texts(spark, tmp_path)
    assert sorted(json.dumps(json.loads(t)) for t in found) == sorted(json.dumps(o) for o in wanted)


@pytest.mark.parametrize("size", [64, 100_000])
def test_rows_equal_those_of_the_whole_file_reader(spark, tmp_path, blocks, size):
    many = [lang(f"o/{i}", 'C"{' if i % 3 else None, i) for i in range(40)]
    put(tmp_path, FEED, DATE, many, "array.json")
    put(tmp_path, FEED, DATE, many[0], "object.json")
    put(tmp_path, FEED, DATE, json.dumps(many[1]) + "\n", "line.json")
    put(tmp_path, FEED, DATE, "﻿" + json.dumps(many[2]), "mark.json")
    put(tmp_path, FEED, DATE, "[]", "none.json")
    put(tmp_path, FEED, DATE, "", "empty.json")
    put(tmp_path, FEED, DATE + 7, many[:3], "later.json")
    blocks(size)
    for date in (None, DATE):
        want, got = (sg.split_corrupt(sg.read_snapshots(spark, str(tmp_path), FEED, date, split=s)) for s in (False, True))
        assert rows(got[0]) == rows(want[0]) and len(rows(got[0])) == (46 if date is None else 43)
        assert got[1].count() == want[1].count() == 0


@pytest.mark.parametrize("size", [9, 100_000])
def test_only_what_is_broken_is_quarantined(spark, tmp_path, blocks, size):
    put(tmp_path, FEED, DATE, [{"repo_full_name": "a"}, {"repo_full_name": "b", "bytes": "many"}, {"repo_full_name": "c"}], "type.json")
    put(tmp_path, FEED, DATE, '[{"repo_full_name": "d"}, {"repo_full_name": "e"', "cut_in_object.json")
    put(tmp_path, FEED, DATE, '[{"repo_full_name": "f"}, {"repo_full_name": "g}', "cut_in_text.json")
    put(tmp_path, FEED, DATE, '[{"repo_full_name": "h"},', "cut_between.json")
    put(tmp_path, FEED, DATE, '{"repo_full_name": "i"', "cut_alone.json")
    put(tmp_path, FEED, DATE, '[{"repo_full_name": "j"}, 7 }, {"repo_full_name": "k"}] x', "stray.json")
    blocks(size)
    good, bad = sg.split_corrupt(sg.read_snapshots(spark, str(tmp_path), FEED, split=True))
    assert sorted(r.repo_full_name for r in good.collect()) == ["a", "c", "d", "f", "h", "j", "k"]
    found = sorted(r.corrupt_record for r in bad.collect())
    assert [t for t in found if t == "["] == ["["] * 4  # three cut arrays, and the one that ends in a stray letter
    rest = [json.dumps(t) for t in found if t != "["]
    assert len(rest) == 6, rest  # the wrong type, objects cut short (e, g, i), 7 and x


def test_one_large_array_is_read_by_several_tasks(spark, tmp_path, blocks):
    put(tmp_path, FEED, DATE, [lang(f"o/{i}", "C", i) for i in range(3000)])
    blocks(40_000)
    df = sg.read_snapshots(spark, str(tmp_path), FEED, split=True)
    assert df.rdd.getNumPartitions() > 4 and df.count() == 3000
    assert spark.read.option("lineSep", "}").text(f"{tmp_path}/{FEED}").rdd.getNumPartitions() > 4


def test_no_folder_of_a_date_gives_no_row(spark, tmp_path):
    put(tmp_path, FEED, DATE, [lang("a", "C", 1)])
    assert sg.read_snapshots(spark, str(tmp_path), FEED, DATE + 1, split=True).count() == 0
