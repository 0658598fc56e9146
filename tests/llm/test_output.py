"""Mixing, token files, personal data, secrets and the pipeline."""

import collections
import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from stargauge.llm import catalog as Q
from stargauge.llm import secrets_scan as S
from stargauge.llm import token_files
from stargauge.llm.language import vocabulary_pieces
from stargauge.llm.mixing import mix_documents, mixture_sizes, plan_mixture
from stargauge.llm.private_data import find_private_data, span_report
from stargauge.llm.store import new_folder
from stargauge.llm.token_files import _Encoder as Encoder, read_token_files, write_token_files

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Source targets: weights 3, 1, 2 in turn, 150 % of all, twice a source's size at most."""
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    free, left, out = set(sizes), 1.5 * sum(sizes.values()), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            return out | {s: weight[s] * level for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2.0 * sizes[s] for s in over)
        free -= over
    return out


def check_mixture(rows, source, texts, slack):
    size = {d: len(WORD.findall(t or "")) for d, t in texts.items()}
    sizes, taken = collections.Counter(), collections.Counter()
    for d in texts:
        sizes[source[d]] += size[d]
    want = targets(sizes)
    for r in rows:
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[source[r.doc_id]])
        assert r.target == pytest.approx(want[source[r.doc_id]])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source[r.doc_id]] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= slack


def test_runs_of_letters_and_marks_encode_as_whole_texts():
    """Runs that go to the merges of the model, marks cut off, and what looks like either."""
    data = Q.vocabulary("word_bpe_49k.json")
    whole = Tokenizer.from_str(data)
    texts = ["abc, Abc. a1! x", "a). b ,, c!! d.\ne?", "stra\u00dfe \u00e9t\u00e9, na\u00efve \u00aa\u00ba e\u0301 \u0130", "don't we'll 's d\tend", "<|endoftext|> A. b", "", "x.y, z.", "\u4e2d, a\u0142. b"]
    got = Encoder(data, 1)([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [[*whole.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_mixture_meets_its_targets(spark, sf, docs, texts):
    source = {r.doc_id: r.source for r in docs.collect()}
    rows = Q.op2_mix_sources(spark, sf).collect()
    check_mixture(rows, source, texts, max(len(WORD.findall(t or "")) for t in texts.values()))
    assert sorted(rows) == sorted(Q.op2_mix_sources(spark, sf).collect())  # reruns agree
    # Small blocks and shards: the same targets, and the documents themselves come out as often as they are drawn.
    plan = plan_mixture(docs, block_words=300, blocks_per_shard=8)
    assert plan.shards > 8
    rows = mixture_sizes(plan).collect()
    check_mixture(rows, source, texts, max(len(WORD.findall(t or "")) for t in texts.values()))
    out = mix_documents(docs, plan)
    assert out.columns == docs.columns
    times = collections.Counter(r.doc_id for r in out.collect())
    assert all(times[r.doc_id] * r.size == r.taken for r in rows)
    per_shard = plan.draws.select(F.explode("draws").alias("d")).groupBy("d.shard").count().collect()
    assert len(per_shard) == plan.shards and max(r["count"] for r in per_shard) <= 8


def split_quotas(quotas, first, last, shards, total, seed):
    """Leaves (shard, source) -> quota of the splitting tree, in plain Python."""
    if last - first == 1:
        return {(first, s): q for s, q in quotas.items() if q}
    middle, names = (first + last) // 2, sorted(quotas)
    wanted = total * middle // shards - total * first // shards
    drawn = np.random.default_rng([seed, first, last]).multivariate_hypergeometric([quotas[s] for s in names], wanted, method="marginals")
    left = {s: int(n) for s, n in zip(names, drawn) if n}
    right = {s: quotas[s] - left.get(s, 0) for s in names if quotas[s] > left.get(s, 0)}
    return split_quotas(left, first, middle, shards, total, seed) | split_quotas(right, middle, last, shards, total, seed)


def test_mixture_comes_through_its_tree(spark, sf, docs):
    plan = plan_mixture(docs, weights=(3, 1, 2), share=1.5, most=2.0)
    assert plan.shards == 32
    draws = [(r.source_no, r.block, r["pass"], r.shard) for r in plan.draws.select("source_no", "block", F.explode("draws").alias("d")).select("source_no", "block", "d.*").collect()]
    assert len({d[:3] for d in draws}) == len(draws)  # disjoint
    leaves, own = {(r.shard, r.source_no): r.quota for r in plan.quotas.collect()}, collections.Counter((d[3], d[0]) for d in draws)
    quotas = collections.Counter()
    for (_, s), n in leaves.items():
        quotas[s] += n
    assert leaves == split_quotas(dict(quotas), 0, plan.shards, plan.shards, sum(quotas.values()), 17) and len(leaves) > 100
    missing = collections.Counter(leaves) - own  # a crossing block of which no document is taken
    assert own <= collections.Counter(leaves) and max(collections.Counter(s for _, s in missing.elements()).values(), default=0) <= 1
    order = {tuple(r)[:3]: r.h for r in spark.createDataFrame([d[:3] for d in draws], plan.draws.selectExpr("source_no", "block", "0L AS pass").schema).selectExpr("*", "xxhash64(17, source_no, block, pass) AS h").collect()}
    for s in quotas:  # a leaf's draws are a consecutive run of its source's permuted blocks
        own = sorted((d for d in draws if d[0] == s), key=lambda d: (d[2], order[d[:3]], d[1]))
        assert [d[3] for d in own] == sorted(d[3] for d in own)
    # The query's documents are taken for the shards that drew their blocks, as often as the mixture holds them.
    rows = {r.doc_id: r for r in Q.op2_mix_sources(spark, sf).collect()}
    assert all(r.taken == r.size * len(r.shards.split(",") if r.shards else []) for r in rows.values())
    assert {int(x) for r in rows.values() for x in r.shards.split(",") if x} == {d[3] for d in draws}


def test_mixture_of_odd_texts(odd, empty):
    plan = plan_mixture(odd, block_words=10)
    rows = mixture_sizes(plan).collect()
    assert len(rows) == odd.count() and all(r.taken <= 2 * r.size for r in rows)
    assert mix_documents(odd, plan).columns == odd.columns
    assert mixture_sizes(plan_mixture(empty)).count() == 0 and mix_documents(empty, plan_mixture(empty)).count() == 0
    blank = plan_mixture(odd.where("doc_id IN (3, 4, 5)"))
    assert {(r.size, r.target, r.taken) for r in mixture_sizes(blank).collect()} == {(0, 0.0, 0)}


def test_few_runs_pass_the_whole_tokenizer():
    """Runs of letters, digits and marks go to the merges by pieces; only the others pass normalizing and cutting."""
    data, passed = Q.vocabulary("word_bpe_49k.json"), []
    whole, encoder = Tokenizer.from_str(data), Encoder(data, 1)

    class Counted:
        model = encoder.tokenizer.model

        def encode_batch_fast(self, runs, **options):
            passed.extend(runs)
            return whole.encode_batch_fast(runs, **options)

    encoder.tokenizer = Counted()
    texts = ["aiier\u00e9. \u00f3miar! thr$$$ r\u00e9on### x1y22 (a_b) www.a-b.com/c?d=1 \u00e9\u00f7. 3.5, [`~{|}] \u00e9.. \u00df.\n\u00ff, \u00c9. \u00e9.'s don't a<|b m\u00b2 \u0142! \x01a \u00e9\u0301.", "\u00e9. \u00f3."]
    got = encoder([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [[*whole.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert sorted(passed) == sorted(["\u00e9\u00f7.", "\u00c9.", "\u00e9.'s", "don't", "a<|b", "m\u00b2", "\u0142!", "\x01a", "\u00e9\u0301."])


def test_runs_are_remembered_up_to_the_limit():
    data, rng = Q.vocabulary("word_bpe_49k.json"), random.Random(5)
    whole, encoder, often = Tokenizer.from_str(data), Encoder(data, 1, limit=200), [f"often{k}" for k in range(20)]
    for batch in range(30):
        words = often + [f"rare{rng.random()}" for _ in range(40)]
        rng.shuffle(words)
        text = " ".join(words)
        assert np.frombuffer(encoder([text.encode()])[0], "<u4").tolist() == [*whole.encode(text, add_special_tokens=False).ids, 1]
        assert len(encoder.known) <= 100 and len(encoder.known.old) <= 100
        assert all(w.encode() in encoder.known or w.encode() in encoder.known.old for w in often)
        if batch % 7 == 6:
            encoder.trim()
            assert len(encoder.known.old) <= 100 and all(w.encode() in encoder.known.old for w in often)


def test_token_files_round_trip(spark, sf, texts):
    tokenizer = Tokenizer.from_str(Q.vocabulary("word_bpe_49k.json"))
    found, start = {r.doc_id: r for r in Q.op7_token_files(spark, sf).collect()}, 0
    for d in sorted(texts):
        ids = [*tokenizer.encode(texts[d] or "", add_special_tokens=False).ids, 1]
        assert found[d] == (d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_a_frame_of_long_texts_is_encoded_little_by_little(monkeypatch):
    """Whatever Spark sends at once, few of its words are held at a time; the rows are those of one large slice."""
    text = " ".join(f"word{k % 500}" for k in range(1000))
    frame = pa.record_batch([pa.array([*range(599), None], pa.int64()), pa.array([None, "", *[f"{k} {text}" for k in range(598)]])], names=["id", "text"])
    data, bounds = Q.vocabulary("word_bpe_49k.json"), np.array([100, 400])

    def encoded():
        encoder = Encoder(data, 1)
        encoder([text.encode()])
        tracemalloc.start()
        rows, held = [], []
        for part in token_files._frames(iter([frame]), encoder, zstandard.ZstdCompressor(), bounds, 2):
            held.append(tracemalloc.get_traced_memory()[1])
            rows += part.to_pylist()
            tracemalloc.reset_peak()
        tracemalloc.stop()
        return rows, max(held)

    rows, most = encoded()
    monkeypatch.setattr(token_files, "_ROWS", 2048)
    monkeypatch.setattr(token_files, "_STEP", 1 << 23)
    whole, more = encoded()
    assert rows == whole and [r["id"] for r in rows] == frame.column(0).to_pylist()
    assert [r["shard"] for r in rows] == [0] * 100 + [1] * 300 + [2] * 199 + [0]
    assert most < 24e6 < more


def test_token_files_of_odd_texts(spark, odd, empty):
    data = Q.vocabulary("word_bpe_49k.json")
    tokenizer, path = Tokenizer.from_str(data), new_folder(spark, "token-test")
    write_token_files(odd, path, data, docs_per_shard=4, block_bytes=200)
    rows = sorted(read_token_files(spark, path).collect(), key=lambda r: r.start)
    given = sorted(((r.doc_id is not None, r.doc_id or 0), [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in odd.collect())
    assert sorted(((r.doc_id is not None, r.doc_id or 0), list(r.ids)) for r in rows) == given
    assert [(r.doc_id is not None, r.doc_id or 0) for r in rows] == [k for k, _ in given]
    assert [r.start for r in rows] == list(np.cumsum([0, *(r.n_tokens for r in rows)])[:-1])
    few = read_token_files(spark, path, ids=[11, 7, 999]).collect()
    assert sorted((r.doc_id, list(r.ids)) for r in few) == sorted((k[1], x) for k, x in given if k in ((True, 7), (True, 11)))
    block = spark.read.parquet(f"{path}/blocks")
    assert block.count() >= 4 and spark.read.parquet(f"{path}/dictionary").count() == 1
    # A dictionary of other content is noticed.
    other = new_folder(spark, "token-test")
    block.write.parquet(f"{other}/blocks")
    spark.createDataFrame([(bytearray(b"other words"), hashlib.sha256(b"other words").hexdigest())], "dictionary binary, sha256 string").write.parquet(f"{other}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        read_token_files(spark, other).collect()
    path = new_folder(spark, "token-test")
    write_token_files(empty, path, data)
    assert read_token_files(spark, path, digest=True).count() == 0
    path = new_folder(spark, "token-test")  # another tokenizer: no short cuts for plain words
    write_token_files(odd, path, Q.vocabulary("word_bpe_49k.json").replace('"Lowercase"', '"NFC"'), docs_per_shard=4)
    assert read_token_files(spark, path).count() == odd.count()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0 if kind == "card" else None
            if {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")), "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def check_spans(rows, texts):
    for d, text in texts.items():
        base, r = base_spans(text), rows[d]
        as_text = [f"{kind}:{a}:{b}" for a, _, b, kind in base]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[3] == k for s in base) for k in PATTERNS), d
        assert r.base_sha256 == hashlib.sha256(",".join(as_text).encode()).hexdigest(), d
        assert set(as_text) <= set(r.spans.split(",")) | {""}, d


def test_private_data_base(spark, sf, texts):
    check_spans({r.doc_id: r for r in Q.op8_private_data(spark, sf).collect()}, texts)


def test_private_data_of_odd_texts(spark, odd, empty):
    odd_texts = [
        "a@b.c_x.y@d.e", "a@b.c.@d.e é😀 x@y.zz", "1.2.3.4.5 256.1.1.1 001.2.3.4 0.0.0.0 1.2.3", "4111 1111 1111 1111  4111-1111-1111-1111 41111111111111111",
        "+1 (017) 555-7713 +12345678 +1-", "", "+++1 234567890 12", None, "1 " * 30_000, "9" * 30_000, "a." * 20_000 + "@", "a@" * 20_000, "x@y..z",
        "4111 1111 1111 1111 +14111111111111", "0000001.0000.00.255 1.2.3.99999999999999999999", "1.1.1.1@b.cc 5500-0000-0000-0004",
    ]
    texts = dict(enumerate(odd_texts))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check_spans({r.doc_id: r for r in span_report(find_private_data(df.union(df.where("doc_id < 4")))).collect()}, texts)
    assert span_report(find_private_data(odd)).count() == odd.count() and find_private_data(empty).count() == 0


def test_contexts_find_new_identifiers(spark):
    rows = [(i, f"hello please call me at +1 (555) 123-45{i:02d} soon ok") for i in range(12)]
    rows += [(50, "hello please call me at 555 123 9999 soon ok"), (51, "numbers like 555 123 8888 here and there"), (52, "write me at bob (at) example.org soon ok")]
    rows += [(60 + i, f"you may write me at bob{i}@example.org soon ok") for i in range(12)]
    by = {r.doc_id: r for r in span_report(find_private_data(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert by[50].spans == "phone:24:36" and by[50].n_phone == 0 and by[51].spans == "" and by[52].spans == "email:12:32"


def test_contexts_lead_on_from_found_identifiers(spark):
    rows = [(i, f"hello please call me at +1 (555) 123-45{i:02d} soon ok") for i in range(12)]
    rows += [(100 + i, f"hello please call me at 555 123 70{i:02d} soon ok") for i in range(30)]  # one hop
    rows += [(200 + i, f"the night desk answers 555 123 70{i:02d} until dawn") for i in range(30)]  # the same in another context
    rows += [(300, "the night desk answers 555 123 9999 until dawn"), (301, "numbers like 555 123 8888 here and there")]  # two hops, none
    by = {r.doc_id: r.spans for r in span_report(find_private_data(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert by[100] == "phone:24:36" and by[200] == "phone:23:35" and by[300] == "phone:23:35" and by[301] == ""


def test_patterns_extract_unseen_forms(spark):
    forms = ["5551239999", "ext.5551239999", "0049/555/1239999", "0049/555-1239998,"]
    rows = [(i, f"hello please call me at +1 (555) 123-45{i:02d} soon ok") for i in range(30)]
    rows += [(100 + i, f"hello please call me at {form} soon ok") for i, form in enumerate(forms)]
    rows += [(200 + i, f"some order {form} was shipped") for i, form in enumerate(["7771239999", "no.7771238888"])]  # in no pattern
    rows += [(300, "hello please call me at 12 soon ok"), (301, "hello please call me at 55512399991234567890 soon ok")]  # of no shape
    rows += [(400, None), (401, "hello please call me at " + "7x" * 30_000 + " soon"), (402, "hello please call me at 5551239999 soon ok"), (102, rows[32][1])]
    by = {}
    for r in span_report(find_private_data(spark.createDataFrame(rows, "doc_id long, text string"))).collect():
        assert by.setdefault(r.doc_id, r) == r  # repeated rows alike
    at = len("hello please call me at ")
    assert [by[100 + i].spans for i in range(3)] == [f"phone:{at}:{at + len(f)}" for f in forms[:3]]
    assert by[103].spans == f"phone:{at}:{at + 16}" and by[402].spans == by[100].spans
    assert not any(by[d].spans for d in (200, 201, 300, 301, 400, 401)) and all(by[d].n_phone == 0 for d in by if d >= 100)


def test_contexts_find_long_addresses(spark):
    long = "first.last-name (at) department-of-something (dot) university-name (dot) edu"
    rows = [(i, f"you may write me at bob{i}@example.org soon ok") for i in range(12)] + [(50, f"write me at {long} soon ok")]
    by = {r.doc_id: r.spans for r in span_report(find_private_data(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert len(long) > 64 and by[50] == f"email:12:{12 + len(long)}"


def test_secrets_are_told_from_false_positives(spark, odd, empty):
    sf, own = "/root/testdata/sf0.01", S.dictionary_of(vocabulary_pieces(Q.vocabulary("word_bpe_49k.json")))
    docs = Q.table(spark, sf, "documents")
    findings = S.find_candidates(docs, own).cache()
    test = Q.remainder("doc_id", 3) == 1
    model = S.train_forest(S.label_by_form(findings.where(~test)))
    labelled = S.label_by_form(findings.where(test)).select("doc_id", "start", "label")
    judged = S.judge_findings(findings, model).join(labelled, ["doc_id", "start"]).collect()
    assert len({r.label for r in judged}) == 2 and sum(r.is_secret == (r.label == 1) for r in judged) / len(judged) > 0.95
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r.doc_id][r.start:].startswith(r.value) for r in findings.collect())
    assert S.find_candidates(empty, own).count() == 0 and S.train_forest(S.label_by_form(S.find_candidates(empty, own))) is None
    assert S.judge_findings(S.find_candidates(odd, own), model).where("score IS NULL").count() == 0
    rows = S.judge_findings(S.find_candidates(odd, own), None)
    assert rows.where("NOT is_secret").count() == 0


def test_pipeline(spark, sf, docs):
    seen, names = [], docs.columns
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, sf)
        path = new_folder(spark, "stage-test")
        now.write.parquet(path)
        now = spark.read.parquet(path)
        seen.append(now)
        assert now.columns == (names if k < 4 else ["doc_id", "start", "n_tokens", "ids_crc32"]), name
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in seen]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and ids[3] == ids[4]
    base = {r.doc_id: r.text for r in docs.collect()}
    assert ids[0] == {d for d, t in base.items() if any(c.isalpha() for c in t or "")}
    from tests.llm.test_joins import groups

    left = groups({d: base[d] for d in ids[0]}, 5, 80)
    assert ids[1] == {d for d in ids[0] if left[d][1] == d}
    hit = {r.doc_id for r in Q.op6_benchmark_passages(spark, sf).where("contaminated").collect()}
    assert ids[2] == ids[1] - hit
    times = seen[3].groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert times <= 2 and seen[4].count() == seen[3].count()


@pytest.mark.parametrize("rows", ["odd", "empty"])
def test_pipeline_of_odd_rows(spark, sf, tmp_path, request, rows):
    """Nulls, repeated rows, clashing names, and a table without rows, from end to end."""
    request.getfixturevalue(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert (len(out) > 0) == (rows == "odd") and all(r.n_tokens > 0 for r in out)


def test_secret_candidates_are_whole_given_values(spark, odd):
    lines = [
        ('password = "p@ss!w0rd#1"', "p@ss!w0rd#1"), ('pwd: "hunter2"', "hunter2"), ('key = "Tr0ub4dor&3xyz"', "Tr0ub4dor&3xyz"), ("secret    =      s3!", "s3!"),
        ("token => a b", "a"), ("{'pass phrase': 1, 'auth': 'two words \\' more'}", "two words \\' more"), ("https://x.y/?user=bob&token=q!w2", "q!w2"),
        ('conn = "Server=x;Password=h(u)nt!;"', "h(u)nt!"), ("login(password='é😀')", "é😀"), ('config["pwd"]\t=\t`x y`', "x y"), ("a" * 50_000 + ": z", "z"),
    ]
    for line, value in lines:
        text = f"é see\n{line}\nend"
        found = {(start, v) for start, v, _ in S._candidates(text)}
        assert (text.index(value, text.index(line) + line.index(value)), value) in found, line
    assert "Tr0ub4dor" not in {v for _, v, _ in S._candidates('key = "Tr0ub4dor&3xyz"')}
    assert not list(S._given("a == b, x::y http://z \n =c")) and list(S._given("=a:" * 20_000))
    rows = S.find_candidates(spark.createDataFrame([(1, 'pwd: "x!"', "a")], "doc_id long, text string, source string"), frozenset()).collect()
    assert [(r.start, r.value, r.assigned, r.quoted, r.secret_name) for r in rows] == [(6, "x!", 1.0, 1.0, 1.0)]
    wide = S.find_candidates(spark.createDataFrame([(1, "pwd" + " " * 500 + "= x!", "a")], "doc_id long, text string, source string"), frozenset()).collect()
    assert [(r.value, r.assigned, r.secret_name) for r in wide] == [("x!", 1.0, 1.0)]


def test_coverage_is_of_the_whole_candidate():
    value = "9" * 300 + "password" * 150
    assert S.finding_features(value, "", "", frozenset({"password"}))[2] == pytest.approx(1200 / 1500)
