"""Conversation repair, token alignment and shards."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stargauge.llm import alignment as A
from stargauge.llm import catalog as Q
from stargauge.llm import dialogues as D
from stargauge.llm import sharding as S
from stargauge.llm.store import ship_package
from stargauge.llm.words import byte_letters
from tests.oracle import connect, difference

@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


GOOD = re.compile(r"(s?(ua)+)?")


def cheapest(rows, entry=0, goals=(0, 3)):
    """All edits with up to two insertions in a place, by trying; from the beginning only."""
    found = []
    choices = [("", "I", "II")] * (len(rows) + 1)
    for deeds in itertools.product("DKR", repeat=len(rows)):
        for adds in itertools.product(*choices):
            for new in itertools.product("ua", repeat=sum(map(len, adds)) + deeds.count("R")):
                given, roles, cost, audit = iter(new), "", 0, ""
                for k, add in enumerate(adds):
                    roles += "".join(next(given) for _ in add)
                    cost, audit = cost + 3 * len(add), audit + add
                    if k < len(rows):
                        initial, forced, cut = rows[k]
                        deed = deeds[k]
                        if forced and deed != "D":
                            break
                        roles += "" if deed == "D" else initial if deed == "K" else next(given)
                        cost += {"D": 4, "K": 0, "R": 3}[deed] + (3 if cut and deed != "D" else 0)
                        audit += deed
                else:
                    if GOOD.fullmatch(roles):
                        found.append((cost, audit))
    return min(found)


def test_search_equals_all_edits():
    rng = random.Random(5)
    for _ in range(30):
        rows = [(rng.choice("suat"), rng.random() < 0.3, False) for _ in range(rng.randint(0, 3))]
        rows = [(i, f, not f and rng.random() < 0.4) for i, f, _ in rows]
        assert D.search(rows, 0, (0, 3)) == cheapest(rows)


def test_bounds_are_below_every_answer():
    rng = random.Random(6)
    for _ in range(50):
        rows = [(rng.choice("suat"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(8)]
        bounds = D.suffix_bounds(rows, (0, 3))
        for k in range(9):
            for state in range(4):
                found = D.search(rows[k:], state, (0, 3))
                assert found is None or bounds[k][state] <= found[0]


def talk(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def repaired(spark, df):
    return {r.conv_id: r.asDict() for r in D.repair_report(df).collect()}


@pytest.fixture(scope="module")
def long_talks(spark):
    """One conversation of 3,000 rows beside short ones, with nulls, ties, repeated rows and unknown roles."""
    rng = random.Random(7)
    texts = ["Yes.", "No", "", " ", "Why?", None, "x" * 70_000, "été 😀.", "Same."]
    rows = [(7, rng.choice([None, *range(2_500)]), rng.choice(["user", "assistant", "system", "tool", None, ""]),
             rng.choice(texts[:6] + [f"Text {k}.", f"cut {k}"])) for k in range(3_000)]
    for c in [None, *range(100, 160)]:
        rows += [(c, rng.choice([None, 0, 1, 2, 3, 5]), rng.choice(["user", "assistant", "system"]), rng.choice(texts)) for _ in range(rng.randint(1, 9))]
    rows += rows[-20:]
    return rows


def test_repair_of_long_and_odd_conversations_equals_sql(spark, long_talks, tmp_path):
    df = talk(spark, long_talks).withColumn("at", F.lit("own")).withColumn("stretch", F.lit(1)).repartition(5)
    con = connect("/root/testdata/sf0.001")
    path = str(tmp_path / "conversations")
    talk(spark, long_talks).write.parquet(path)
    con.sql(f"CREATE OR REPLACE TEMP VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    assert difference(D.repair_report(df), con, Q.SQL["op11_dialogue_repair"]) is None


def test_a_cut_conversation_is_searched_like_a_whole_one(spark, long_talks):
    got = repaired(spark, talk(spark, long_talks))[7]
    damaged = D.damage(talk(spark, [r for r in long_talks if r[0] == 7])).collect()
    order = sorted(damaged, key=lambda r: (r.turn is not None, r.turn or 0, r.role, r.text.encode()))
    seen, rows = set(), []
    for r in order:
        body = r.text.strip(" \t\n\x0b\x0c\r")
        forced = not body or (r.role, r.text) in seen
        seen.add((r.role, r.text))
        rows.append((r.role[:1], forced, not forced and body[-1] not in ".!?"))
    assert (got["cost"], got["audit"]) == D.search(rows, 0, (0, 3))


def test_repaired_rows_are_in_order(spark, long_talks):
    _, lines = D.repair_conversations(D.damage(talk(spark, long_talks)))
    talks = collections.defaultdict(list)
    for r in lines.collect():
        talks[r.conv_id].append((r.at, r.k, r.role))
    for rows in talks.values():
        assert GOOD.fullmatch("".join(role[:1] for _, _, role in sorted(rows)))


def test_no_conversations(spark):
    empty = talk(spark, []).withColumn("cost", F.lit("own"))
    assert D.repair_report(empty).count() == 0


@pytest.fixture(scope="module")
def models():
    return Q.tokenizer_file("byte_bpe_50k.json"), Q.tokenizer_file("piece_bpe_32k.model")


def plain_alignment(models, texts):
    """Whole texts, by the bytes of the tokens alone."""
    first = Tokenizer.from_buffer(models[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_proto=models[1])
    letters = {c: b for b, c in byte_letters().items()}
    one = lambda i: bytes(letters[c] for c in first.id_to_token(i))
    two = lambda i: bytes([int(second.id_to_piece(i)[1:-1], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
    out, count = [], collections.Counter()
    for text in texts:
        groups = []
        if text:
            a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
            whole = (" " + text).encode()
            if b"".join(map(one, a)) == whole and b"".join(map(two, b)) == whole:
                ends = [list(itertools.accumulate(len(f(i)) for i in ids)) for f, ids in ((one, a), (two, b))]
                cuts, i, j = sorted(set(ends[0]) & set(ends[1])), 0, 0
                for cut in cuts:
                    p, q = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
                    groups.append((a[i:p], b[j:q]))
                    i, j = p, q
        links = collections.Counter((x, y) for p, q in groups for x in p for y in q)
        count.update(set(links))
        out.append((groups, links))
    best = collections.defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return [
        (
            sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), sum(links.values()),
            sum(n for pair, n in links.items() if count[pair] == best[pair[0]]), sum(n * count[pair] for pair, n in links.items()),
            hashlib.sha256(";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups).encode()).hexdigest() if groups else "",
        )
        for groups, links in out
    ]


def alignment_rows(df):
    assert df.columns == A._OUT
    return sorted((r[0] is not None, r[0] or 0, *r[1:]) for r in df.collect())


def expected(models, rows):
    return sorted((i is not None, i or 0, *x) for (i, _), x in zip(rows, plain_alignment(models, [t for _, t in rows])))


def odd_texts():
    rng = random.Random(3)
    alphabet = " \n\t.a1éの😀①'s\x1c\x85　▁"
    texts = ["▁x", "ﬁ ①", "é", "\x00a", "a b ", "a  ", " ", "", None, "<s> <|endoftext|><unk>", "﻿x", "<0x41>", "a  b", "= " * 3_000, "=" * 5_000]
    return texts + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(600)]


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_alignment_equals_whole_texts(spark, odd, models, limit):
    rows = [(k if k % 7 else None, t) for k, t in enumerate(odd_texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert alignment_rows(A.align_tokens(df, models, limit)) == expected(models, rows)
    known = [(r.doc_id, r.text) for r in odd.collect()]
    assert alignment_rows(A.align_tokens(odd, models, limit)) == expected(models, known)


def test_alignment_query(spark, sf, docs, models, texts):
    got = alignment_rows(Q.QUERIES["op12_token_alignment"](spark, sf))
    assert got == expected(models, list(texts.items()))


def test_runs_are_forgotten_and_learnt_again(models):
    aligner = A.Aligner(*models, limit=50)
    rng = random.Random(4)
    for _ in range(20):
        lists = [[rng.choice(["the", f"w{rng.randint(0, 300)}", "ё\n"]) for _ in range(20)] for _ in range(3)]
        for runs, numbers in zip(lists, aligner.numbers(lists)):
            for run, number in zip(runs, numbers):
                ids = aligner.first.encode(" " + run, add_special_tokens=False).ids
                assert aligner.all.n_a[number] == len(ids)
                assert aligner.all.shown[number].startswith(str(ids[0]))
    assert len(aligner.known) < 200


def test_a_batch_numbers_its_runs_in_a_row(models):
    aligner = A.Aligner(*models)
    texts = ["one two three", "", "two\u00a0\x00 two", None, "three one"]
    batch = A._Batch(aligner, pa.array(texts))
    good = [all(aligner.all.good[k] for k in runs) for runs in aligner.numbers([aligner.runs_of(t or "") for t in texts])]
    assert batch.counts.tolist() == [len(aligner.runs_of(t or "")) if g else 0 for t, g in zip(texts, good)]
    assert len(batch.run) == len(batch.owner) == batch.counts.sum() and batch.owner.tolist() == sorted(batch.owner.tolist())
    assert [d == "" for d in batch.digests()] == [n == 0 for n in batch.counts]
    assert A._distinct(np.array([3, 1, 3, 2, 1])).tolist() == [1, 2, 3] and not len(A._distinct(np.zeros(0, np.int64)))


def test_wide_groups_are_unfolded_by_distinct_ids():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 5, 400), rng.integers(0, 7, 300)
    _, pair, times = A.links_of(a, np.zeros(400, int), b, np.zeros(300, int), 1)
    assert times.sum() == 400 * 300 and len(pair) == 35


def test_alignment_of_nothing(empty, models):
    assert A.align_tokens(empty, models).count() == 0


@pytest.mark.parametrize("name", ["op11_dialogue_repair", "op13_sharding"])
def test_queries_equal_their_sql(spark, sf, name):
    assert difference(Q.QUERIES[name](spark, sf), connect(sf), Q.SQL[name]) is None


def shards_of(rows):
    held = collections.defaultdict(list)
    for r in rows:
        held[r.shard].append((r.slot, r["size"]))
    return held


def check_shards(rows, shards):
    held, total, most = shards_of(rows), sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for slots in held.values():
        assert sorted(s for s, _ in slots) == list(range(len(slots)))
    if most * shards <= total:
        assert set(held) == set(range(shards))
        assert all(abs(sum(x for _, x in slots) - total / shards) <= most for slots in held.values())


def test_shards_do_not_depend_on_the_sample(docs):
    a = S.shard_documents(docs, 16)
    b = S.shard_documents(docs.repartition(7), 16, ranges=5, sample=1)
    check_shards(a.collect(), 16)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_overfull_ranges_are_subdivided(spark):
    """A third of all rows have one text, and many of them one id as well."""
    rows = [(k % 50 if k < 700 else k, "same text" if k < 1_400 else f"text {k} " + "y" * (k % 300)) for k in range(4_200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check_shards(S.shard_documents(df, 16, ranges=64, sample=1).collect(), 16)
    keyed = df.select(
        F.octet_length("text").cast("long").alias("__size"), S.digest_key(F.col("text")).alias("__key0"),
        S.digest_key(F.col("doc_id")).alias("__key1"), F.xxhash64(F.monotonically_increasing_id()).alias("__salt"),
    ).persist()
    total = keyed.agg(F.sum("__size")).first()[0]
    _, held = S.splitters(keyed, 64, 1)
    assert sum(size for _, size, _, _ in held) == total
    assert all(size - most <= 2 * (total // 64) for _, size, _, most in held)
    keyed.unpersist()


def test_shards_of_odd_rows(odd, empty):
    rows = S.shard_documents(odd, 3).collect()
    check_shards(rows, 3)
    assert len(rows) == 15 and {r.text_crc32 for r in rows if r["size"] == 1} == {0}
    assert S.shard_documents(empty).count() == 0


def test_shards_are_written_in_order(spark, docs, tmp_path):
    placed = S.place_in_shards(
        docs.where("text is not null"), F.octet_length("text") + 1, (S.digest_key(F.col("text")), S.digest_key(F.col("doc_id"))), 4
    )
    S.write_shards(placed, str(tmp_path / "shards"), rows_a_file=20)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.select("doc_id", "text", "slot").exceptAll(placed.select("doc_id", "text", "slot")).isEmpty()
    assert back.count() == placed.count()
