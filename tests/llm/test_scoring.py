"""Language model, language identification and quality rules against plain Python."""

import collections
import math
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stargauge.llm import catalog as Q
from stargauge.llm.boosting import fit_boosted
from stargauge.llm.language import UNKNOWN, Pieces, _long_score, expected_counts, identify_languages, learn_languages, vocabulary_pieces, word_scores
from stargauge.llm.ngram_model import build_filter, expected_count, quantise, score_texts, train_ngrams
from stargauge.llm.quality import judge_quality, learn_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def test_lm_scores(spark, sf, texts):
    found = {r.doc_id: r for r in Q.op1_lm_score(spark, sf).collect()}
    assert set(found) == set(texts)
    split = {d: tokens(t) for d, t in texts.items()}
    single, pairs, before = collections.Counter(), collections.Counter(), collections.Counter()
    for d, words in split.items():
        if not held(d):
            single.update(words)
            pairs.update(zip(["\n", *words], words))
            before.update(["\n", *words][:-1])
    total, distinct = sum(single.values()), len(single)
    model = exact = 0
    for d, words in split.items():
        r = found[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(d), len(words), sum(single[w] > 0 for w in words), total)
        assert r.base_score == pytest.approx(sum(math.log10((single[w] + 1) / (total + distinct + 1)) for w in words), rel=1e-9)
        exact += sum(math.log10((pairs[p] + 4 * (single[p[1]] + 1) / (total + distinct + 1)) / (before[p[0]] + 4)) for p in zip(["\n", *words], words))
        model += r.score
    assert model == pytest.approx(exact, rel=0.02)  # quantised counts and a few false positives


def test_lm_gives_the_same_by_broadcast_and_by_exchange(odd, empty):
    model = train_ngrams(odd, order=3, segment_tokens=1000)
    assert model.n_segments > 8
    out = F.lit(False)
    rows = [sorted(score_texts(odd, model, out, broadcast_bytes=b).collect(), key=repr) for b in (1 << 30, 0)]
    assert rows[0] == rows[1] and len(rows[0]) == odd.count()
    by = {r.doc_id: r for r in rows[0]}
    assert by[4].n_tokens == by[3].n_tokens == 1 and by[12].n_tokens == 7
    assert score_texts(empty, model, out).count() == 0
    none = train_ngrams(empty)
    assert {r.score for r in score_texts(odd, none, out).collect()} == {0.0} and none.total == 0


def test_lm_exchanges_rows_of_few_megabytes(spark, monkeypatch):
    from stargauge.llm import ngram_model
    from stargauge.llm.store import ship_package

    ship_package(spark)
    written, sizes = ngram_model.written, {}

    def measured(df, name):
        out = written(df, name)
        size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in out.dtypes if kind == "binary"), F.lit(0))
        sizes[name] = out.agg(F.max(size)).first()[0]
        return out

    monkeypatch.setattr(ngram_model, "written", measured)
    texts = [" ".join(f"w{(k * j) % 1009}" for j in range(2_000)) for k in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    model = train_ngrams(df, segment_tokens=1 << 16)
    rows = [sorted(map(tuple, score_texts(df, model, F.lit(False), broadcast_bytes=b).collect())) for b in (1 << 30, 0)]
    assert rows[0] == rows[1] and len(rows[0]) == 600
    assert 0 < sizes["token-batches"] < 4 << 20  # eight bytes a word of 8 MB of text were 9.6 MB


def test_written_leaves_no_shuffle_files(spark):
    from stargauge.llm.store import forget, written

    def kept():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {x for x in files.split("\n") if "/shuffle_" in x}

    before = kept()
    out = written(spark.range(100).repartition(3, "id"), "numbers")
    end = time.time() + 30
    while kept() - before and time.time() < end:  # they are deleted in the background
        time.sleep(0.1)
    assert not kept() - before and out.count() == 100
    forget(out)
    with pytest.raises(Exception, match="(?i)not exist|not found|no such file"):
        out.collect()


def test_filter_holds_every_event():
    from stargauge.llm.ngram_model import Segments
    import pyarrow as pa

    rng = np.random.default_rng(1)
    keys, counts = np.unique(rng.integers(1, 1 << 62, 5000).astype(np.uint64)), None
    counts = rng.integers(1, 500, len(keys))
    table = pa.table({"segment": pa.array([0], pa.int32()), "filter": [build_filter(keys, counts, 1.5)], "words": [b""], "counts": [b""]})
    sizes = pa.table({"segment": [0], "filter": [len(table["filter"][0].as_py())], "words": [0], "counts": [0]})
    held = Segments(sizes, 1).fill(table)
    levels = held.levels(keys)
    assert (levels >= quantise(counts, 1.5)).all() and (levels == quantise(counts, 1.5)).mean() > 0.95
    assert (held.levels(rng.integers(1, 1 << 62, 5000).astype(np.uint64)) > 0).mean() < 0.05
    middle = expected_count(quantise(counts, 1.5), 1.5)
    assert (middle <= counts * 1.5).all() and (middle >= counts / 1.5).all()


def brute(word, pieces, p):
    """Sum over all segmentations, by recursion."""
    ways = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        for begin in range(end):
            k = pieces.get((word[begin:end], end == len(word)))
            if k is not None:
                ways[end] += ways[begin] * p[k]
    return ways[-1]


def test_forward_algorithm_sums_all_segmentations():
    pieces = sorted({(bytes([b]), e) for b in b"abc" for e in (False, True)} | {(b"ab", False), (b"bc", True), (b"abc", True), (b"ca", False)})
    index = {x: k for k, x in enumerate(pieces)}
    p = np.random.default_rng(2).random((len(pieces), 2))
    words = [b"a", b"abc", b"abcabc", b"ccabca", b"bca"]
    scores = word_scores(words, Pieces(pieces), p)
    for w, row in zip(words, scores):
        assert row == pytest.approx([math.log(brute(w, index, p[:, k])) for k in (0, 1)])
    # Expected counts: the derivative of the log probability by the log of a piece's probability.
    counts = expected_counts(words, np.array([0, 1, 0, 1, 0]), np.ones(5), Pieces(pieces), p)
    for k in range(len(pieces)):
        for lang in (0, 1):
            q = p.copy()
            q[k, lang] *= 1 + 1e-6
            change = sum(math.log(brute(w, index, q[:, lang]) / brute(w, index, p[:, lang])) for w, own in zip(words, (0, 1, 0, 1, 0)) if own == lang)
            assert counts[k, lang] == pytest.approx(change / 1e-6, abs=1e-3)


def test_words_of_any_length_are_scored_whole():
    """Words beyond the length that is scored many at a time: all segmentations, no cut, no underflow."""
    pieces = sorted({(bytes([b]), e) for b in b"abc" for e in (False, True)} | {(b"ab", False), (b"bc", True), (b"abc", True), (b"ca" * 9, False)})
    index, rng = {x: k for k, x in enumerate(pieces)}, np.random.default_rng(4)
    p = rng.random((len(pieces), 2))
    words = [bytes(rng.choice(list(b"abc"), n).tolist()) for n in (31, 32, 33, 64, 65, 90, 200)] + [b"ca" * 40]
    scores = word_scores(words, Pieces(pieces), p)
    for w, row in zip(words, scores):
        assert row == pytest.approx([math.log(brute(w, index, p[:, k])) for k in (0, 1)])
        assert _long_score(w, Pieces(pieces), p) == pytest.approx(row)
    small = word_scores([b"abc" * 20_000], Pieces(pieces), p * 1e-6)
    assert np.isfinite(small).all() and (small < -100_000).all()
    word = [words[4]]
    counts = expected_counts(word, np.array([1]), np.full(1, 2.0), Pieces(pieces), p)
    assert counts[:, 0].sum() == 0
    for k in range(len(pieces)):
        q = p.copy()
        q[k, 1] *= 1 + 1e-6
        change = 2 * math.log(brute(word[0], index, q[:, 1]) / brute(word[0], index, p[:, 1]))
        assert counts[k, 1] == pytest.approx(change / 1e-6, abs=1e-3)


def test_language_of_held_out_documents(spark, sf, docs):
    found = Q.op4_language(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    test = [r.lang == r.lang_pred for r in found if r.held_out]
    assert sum(test) / len(test) > 0.97


def test_language_of_odd_texts(odd, empty):
    pieces = Q.vocabulary("word_bpe_49k.json")
    model = learn_languages(odd, pieces)
    out = identify_languages(odd, model)
    assert set(out.columns) == set(odd.columns)
    by = {r.doc_id: r for r in out.collect()}
    assert by[7].lang_pred == "de" and by[1].lang_pred == "en"
    for d in (3, 4, 5, 6):
        assert (by[d].lang_pred, by[d].score) == (UNKNOWN, 0.0)
    assert by[10].lang_pred in ("de", "en") and by[8].lang_pred in ("de", "en")
    assert identify_languages(empty, model).count() == 0
    assert {r.lang_pred for r in identify_languages(odd, learn_languages(empty, pieces)).collect()} == {UNKNOWN}
    assert len(vocabulary_pieces(pieces)) > 49_000


def test_quality_counts_and_held_out_verdicts(spark, sf, texts):
    found = {r.doc_id: r for r in Q.op3_quality_rules(spark, sf).collect()}
    for d, text in texts.items():
        words, text = WORD.findall(text or ""), text or ""
        runs = collections.Counter(tuple(words[i: i + 8]) for i in range(len(words) - 7))
        hit = {k for i in range(len(words) - 7) if runs[tuple(words[i: i + 8])] > 1 for k in range(i, i + 8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        r = found[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))
        assert r.base_failed == (len(words) < 20 or 100 * len(hit) > 30 * len(words)) and not (r.base_failed and r.kept)
    bigger = "/root/testdata/sf0.01"
    docs, labels = Q.table(spark, bigger, "documents"), Q.table(spark, bigger, "labels")
    test = Q.remainder("doc_id", 3) == 1
    verdicts = judge_quality(docs, learn_quality(docs, labels.where(~test))).join(labels.where(test), "doc_id").where("NOT base_failed").collect()
    assert sum(r.kept == (r.quality == 1) for r in verdicts) / len(verdicts) > 0.95


def test_quality_of_odd_texts(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (9, 0), (2, 1), (None, 1), (77, None)], "doc_id long, quality int")
    model = learn_quality(odd, labels)
    by = {r.doc_id: r for r in judge_quality(odd, model).collect()}
    assert by[3].n_words == by[4].n_words == by[5].n_words == 0 and by[3].base_failed
    assert by[9].n_repeat_words == 30_000 and not by[9].kept and by[12].n_dup_lines == 1
    assert judge_quality(empty, model).count() == 0
    assert {r.score for r in judge_quality(odd, learn_quality(odd, labels.limit(0))).collect()} == {0.5}


def test_trees_keep_the_order_of_constrained_features():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 3))
    y = ((x[:, 0] + 0.5 * np.sin(12 * x[:, 1]) + 0.3 * rng.random(4000)) > 0.7).astype(float)
    model = fit_boosted(x, y, [1, -1, 0], trees=30)
    assert ((model.probability(x) > 0.5) == y).mean() > 0.75
    rows = rng.random((300, 3))
    for feature, sign in ((0, 1), (1, -1)):
        higher = rows.copy()
        higher[:, feature] += rng.random(300)
        assert (sign * (model.margin(higher) - model.margin(rows)) >= -1e-9).all()
