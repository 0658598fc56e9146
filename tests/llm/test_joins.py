"""Near copies, benchmark passages and fuzzy lines against plain Python."""

import collections
import gc
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stargauge.llm import catalog as Q
from stargauge.llm import fuzzy_lines as L
from stargauge.llm.decontaminate import find_passages, passage_report, remove_contaminated
from stargauge.llm.graph import components
from stargauge.llm.set_join import jaccard_groups, keep_one_of_each_group
from stargauge.llm.words import Words
from tests.oracle import connect, difference


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i: i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def groups(texts, size, percent):
    """Set size and smallest linked id of each text, by comparing all pairs."""
    sets = {d: shingles(t, size) for d, t in texts.items()}
    union, ids = Union(sets), sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    union.link(a, b)
    return {d: (len(sets[d]), union.find(d)) for d in ids}


def test_jaccard_groups_equal_all_pairs(spark, sf, texts):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in Q.op5_ngram_jaccard(spark, sf).collect()}
    assert found == groups(texts, 3, 90)


@pytest.mark.parametrize("pivots,percent", [(1, 80), (8, 70), (2, 90)])
def test_jaccard_groups_of_many_near_copies(spark, pivots, percent):
    """A large group of near copies, so that lists are longer than their pivots; chains of links included."""
    rng = random.Random(pivots)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for d in range(160):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"u{rng.randrange(12)}"
        texts[d] = " ".join(words[rng.randint(0, 4):])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_groups(df, 3, percent, pivots).collect()}
    assert found == groups(texts, 3, percent)


def test_jaccard_of_odd_texts(odd, empty):
    rows = jaccard_groups(odd, 3, 90).collect()
    assert len(rows) == odd.count()
    by = collections.defaultdict(set)
    for r in rows:
        by[r.doc_id].add((r.n_shingles, r.component_id))
    assert by[1] == {(12, 1)} and by[2] == {(12, 1)} and by[3] == {(0, 3)} and by[5] == {(0, 5)} and by[9] == {(1, 9)}
    assert by[11] == {(1, 11)} and by[None] == {(10, None), (0, None)}
    assert jaccard_groups(empty).count() == 0
    kept = keep_one_of_each_group(odd, 3, 60)
    assert kept.columns == odd.columns
    left = sorted((str(r.doc_id), (r.text or "")[:20]) for r in kept.collect())
    assert ("1", "The quick brown fox ") in left and not any(d == "2" for d, _ in left)
    assert [d for d, t in left if t.startswith("Der")] == ["7"]  # the copy without an id goes
    assert keep_one_of_each_group(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5000, 5000), (7, 3)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {found[k] for k in range(61)} == {0} and {found[1000 + k] for k in range(300)} == {1000} and 5000 not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_passages_equal_their_sql(spark, sf):
    assert difference(Q.op6_benchmark_passages(spark, sf), connect(sf), Q.SQL["op6_benchmark_passages"]) is None


def test_passages_of_odd_texts(spark, odd, empty):
    items = [(1, "QUICK brown fox jumps over the lazy dog near the river"), (2, "one two"), (3, None), (4, "..."), (None, "the quick"), (20, "one TWO"), (5, "über")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(9))
    found = find_passages(odd, bench).collect()
    assert len(found) == odd.count()
    by = {r.doc_id: r for r in found}
    assert (by[1].n_hit, by[1].items) == (11, ["1"]) and by[2].items == ["1"]
    assert (by[12].n_hit, by[12].items) == (6, ["2", "20"]) and by[7].items == ["5"] and by[3].n_words == 0
    assert {r.n_hit for r in find_passages(odd, bench.limit(0)).collect()} == {0} and find_passages(empty, bench).count() == 0
    report = {r.doc_id: r for r in passage_report(find_passages(odd, bench)).collect()}
    assert report[3].items_sha256 == hashlib.sha256(b"").hexdigest() and report[12].items_sha256 == hashlib.sha256(b"2,20").hexdigest()
    kept = remove_contaminated(odd, bench)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {None, 3, 4, 5, 6, 8, 9, 10}


def test_edit_distance():
    rng = random.Random(4)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
            row = new
        return row[-1]

    for _ in range(300):
        a, b = ("".join(rng.choice("abé") for _ in range(rng.randint(0, 14))) for _ in range(2))
        assert L.edit_distance(a, b) == plain(a, b)
    assert L.edit_distance("x" * 5000, "x" * 4000 + "y" * 1000) == 1000



def test_edit_distance_stops_beyond_what_is_allowed():
    rng = random.Random(9)
    for _ in range(300):
        a, b = ("".join(rng.choice("ab\u00e9\U0001F600") for _ in range(rng.randint(0, 20))) for _ in range(2))
        whole = L.edit_distance(a, b)
        for most in range(8):
            assert (L.edit_distance(a, b, most) == whole) if whole <= most else L.edit_distance(a, b, most) > most


def test_few_pairs_are_compared_letter_by_letter(monkeypatch):
    """Pairs whose letters or runs of letters differ too much go without; the verdict is that of comparing all."""
    rng, compared, distance = random.Random(10), [], L.edit_distance

    def line(n, letters):
        return "".join(rng.choice(letters) for _ in range(n))

    def edited(text, edits):
        text = list(text)
        for _ in range(edits):
            at = rng.randrange(len(text) + 1)
            text[at: at + rng.randint(0, 1)] = line(rng.randint(0, 1), "xy\u00e9\u0142")
        return "".join(text)

    pairs = [("", ""), ("a", ""), ("ab", "ab"), ("abcde", "abcdx"), ("abcd", "abcx"), ("\U0001F600" * 9, "\U0001F600" * 8)]
    for k in range(700):
        a = line(rng.randint(1, 200), "abcdefgh \u00e9\u4e2d")
        pairs.append((a, edited(a, rng.randint(0, 1 + len(a) // 3))))
        pairs.append((line(len(a), "abcdefgh"), line(len(a), "fghijklm ")))
    right = [100 * (max(len(a), len(b)) - distance(a, b)) >= 80 * max(len(a), len(b)) for a, b in pairs]
    monkeypatch.setattr(L, "edit_distance", lambda a, b, most: compared.append(a) or distance(a, b, most))
    assert L.similar([a for a, _ in pairs], [b for _, b in pairs], 80) == right and L.similar([], [], 80) == []
    assert 400 < sum(right) <= len(compared) < 0.6 * len(pairs)


def test_many_pairs_are_compared_together(monkeypatch):
    """The verdict on many pairs is that of comparing each alone; only few are."""
    rng, alone, distance = random.Random(12), [], L.edit_distance

    def line(n, letters):
        return "".join(rng.choice(letters) for _ in range(n))

    pairs = []
    for k in range(2400):
        n = rng.choice((1, 9, 40, 63, 64, 65, 127, 128, 129, 200, 330))
        a = line(n, "ab cde\u00e9\u4e2d" if k % 3 else "abcdefghijklmnopqrstuvwxyz \U0001F600")
        cut = rng.randrange(n + 1)
        b = list(a[cut:] + a[:cut] if k % 7 == 0 else a)
        for _ in range(rng.randint(0, 2 + n // 4)):
            at = rng.randrange(len(b) + 1)
            b[at: at + rng.randint(0, 1)] = line(rng.randint(0, 1), "abcxy\u0142")
        pairs.append((a, "".join(b)))
    right = [100 * (max(len(a), len(b)) - distance(a, b)) >= 80 * max(len(a), len(b), 1) if a or b else True for a, b in pairs]
    monkeypatch.setattr(L, "edit_distance", lambda a, b, most: alone.append(a) or distance(a, b, most))
    assert L.similar([a for a, _ in pairs], [b for _, b in pairs], 80) == right
    assert 800 < sum(right) < 2200 and len(alone) < 100


def test_simhashes_sum_the_bits_of_words():
    import xxhash

    marks = {chr(k) for k in range(128) if not chr(k).isalnum()}
    lines = ["", "--", "a --", "-- a", "- - !", "\u00e9 -", "-\x00- b", "_ x", "b a b", "!\x0b? c", "\x1c d", " ".join(f"w{k}" for k in range(61_000))]

    def plain(line):
        words = set(line.encode().split())
        words = {w for w in words if not set(w.decode()) <= marks} or words
        ones = [sum(xxhash.xxh64_intdigest(w, 7).to_bytes(8, "little")[k // 8] >> (7 - k % 8) & 1 for w in words) for k in range(64)]
        return bytes(sum((2 * ones[8 * i + j] > len(words)) << (7 - j) for j in range(8)) for i in range(8))

    assert [x.tobytes() for x in L.simhashes([x.encode() for x in lines])] == [plain(x) for x in lines]


def test_lines_of_long_lists_with_other_letters_are_not_joined_with_their_texts(spark, monkeypatch):
    from stargauge.llm.store import ship_package

    ship_package(spark)
    rng, verified, asked = random.Random(3), L._verified, []

    def counted(docs, nodes, pairs, percent):
        asked.append(pairs.count())
        return verified(docs, nodes, pairs, percent)

    monkeypatch.setattr(L, "_verified", counted)
    common = "the same run of letters in all of them "
    lines = [common + "".join(rng.choice(c) for _ in range(40)) for c in ("abc", "def", "ghi", "klm", "npq", "uvw") for _ in range(12)]
    lines += [x[:-2] + "zz" for x in lines[::12]]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "doc_id long, text string")
    kept = {r.doc_id: r.n_dropped for r in L.dedup_lines(df, grams=8).collect()}
    assert len(asked) == 2 and asked[1] < 78 * 77 / 2 * 0.4
    groups = {k: k for k in range(len(lines))}

    def top(k):
        return k if groups[k] == k else top(groups[k])

    for k, x in enumerate(lines):
        for j, y in enumerate(lines[:k]):
            if 100 * (max(len(x), len(y)) - L.edit_distance(x, y)) >= 80 * max(len(x), len(y)):
                groups[top(k)] = top(j)
    assert kept == {k: int(groups[k] != k) for k in groups}


def test_minhashes_of_many_lines_are_those_of_each_line():
    rng = random.Random(11)
    lines = [bytes(rng.choices(b"abcdef \xc3", k=rng.choice([1, 3, 15, 16, 17, 400, 70_000]))) for _ in range(120)]
    for run in (2, 16):
        assert (L.gram_keys(lines, run, 8) == np.concatenate([L._gram_keys([x], run, 8) for x in lines])).all()
    assert L.gram_keys([], 5, 8).shape == (0, 8)


def kept_lines(texts, radius, percent):
    """Texts without the lines that go, comparing all pairs of distinct lines."""
    first = {}
    for d in sorted(texts):
        for k, line in enumerate((texts[d] or "").split("\n")):
            n = L.normalise(line.encode())
            if n:
                first.setdefault(n, []).append((d, k))
    lines = list(first)
    sims, union = L.simhashes(lines), Union(range(len(lines)))
    for i, a in enumerate(lines):
        for j in np.flatnonzero(np.bitwise_count(sims[i + 1:] ^ sims[i]) <= radius) + i + 1:
            b = lines[j]
            longest = max(len(a.decode()), len(b.decode()))
            if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * (longest - L.edit_distance(a.decode(), b.decode())) >= percent * longest:
                union.link(i, int(j))
    stays, gone = {}, collections.defaultdict(set)
    for i, line in enumerate(lines):
        stays[union.find(i)] = min([*first[line], *([stays[union.find(i)]] if union.find(i) in stays else [])])
    for i, line in enumerate(lines):
        for d, k in first[line]:
            if (d, k) != stays[union.find(i)]:
                gone[d].add(k)
    return {d: t and "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d]) for d, t in texts.items()}


def test_line_dedup_equals_all_pairs(docs, texts):
    found = {r.doc_id: r.text for r in L.dedup_lines(docs).collect()}
    assert found == kept_lines(texts, 4, 80)


def test_line_dedup_of_near_lines_and_odd_texts(spark, odd, empty):
    rng = random.Random(5)
    base = [f"word{i}" for i in range(40)]
    texts = {d: "\n".join(" ".join(w if rng.random() > 0.03 else f"x{rng.randrange(9)}" for w in base[k * 5:]) for k in range(3)) for d in range(40)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    out = {r.doc_id: r for r in L.dedup_lines(df).collect()}
    assert {d: r.text for d, r in out.items()} == kept_lines(texts, 4, 80)
    assert sum(r.n_dropped for r in out.values()) > 40
    rows = L.dedup_lines(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].n_dropped == 0 and by[2].text == "" and by[3].text is None and by[4].text == "" and by[5].n_lines == 0
    assert (by[12].n_lines, by[12].n_dropped, by[12].text) == (3, 3, "") and by[11].text == "one two"
    assert L.dedup_lines(empty).count() == 0


def test_line_dedup_bounds_lengths_in_code_points(spark, odd):
    words = [f"w{chr(97 + k % 26)}{k % 10}" for k in range(40)]
    plain, dashes = " - ".join(words), " \u2013 ".join(words)
    assert 100 * len(plain.encode()) < 80 * len(dashes.encode()) and 100 * (len(plain) - L.edit_distance(plain, dashes)) >= 80 * len(plain)
    df = spark.createDataFrame([(1, plain), (2, dashes)], "doc_id long, text string")
    assert {r.doc_id: r.n_dropped for r in L.dedup_lines(df, radius=20, clean=1).collect()} == {1: 0, 2: 1}


def dropped_of_all_pairs(texts, percent):
    """Lines that go from each text, by edit similarity of all pairs alone; pairs with too few equal letter pairs for it are passed over."""
    first = {}
    for d in sorted(texts):
        for k, line in enumerate((texts[d] or "").split("\n")):
            if n := L.normalise(line.encode()).decode():
                first.setdefault(n, []).append((d, k))
    lines = sorted(first, key=len)
    sizes, letters = np.array([len(x) for x in lines]), np.zeros((len(lines), 512), np.uint16)
    for i, line in enumerate(lines):
        for x, y in zip(line, line[1:]):
            letters[i, (31 * ord(x) + 7 * ord(y)) % 512] += 1
    union = Union(range(len(lines)))
    for i, line in enumerate(lines):
        near = np.arange(i + 1, np.searchsorted(percent * sizes, 100 * sizes[i], "right"))
        common = np.minimum(letters[near], letters[i]).sum(axis=1)
        for j in near[common >= sizes[near] - 1 - 2 * ((100 - percent) * sizes[near] // 100)]:
            if union.find(i) != union.find(int(j)) and 100 * (sizes[j] - L.edit_distance(line, lines[j])) >= percent * sizes[j]:
                union.link(i, int(j))
    groups = collections.defaultdict(list)
    for i, line in enumerate(lines):
        groups[union.find(i)] += first[line]
    gone = collections.Counter(d for places in groups.values() for d, _ in sorted(places)[1:])
    return {d: gone[d] for d in texts}


def test_line_dedup_by_grams_equals_all_pairs_by_edit_similarity(spark, docs, texts):
    assert {r.doc_id: r.n_dropped for r in L.dedup_lines(docs, grams=8).collect()} == dropped_of_all_pairs(texts, 80)
    rng = random.Random(6)
    def word():
        return "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))

    rows = {}
    for k in range(150):  # one word of 10, 20 or 40 is another
        line = [word() for _ in range((10, 20, 40)[k % 3])]
        other = list(line)
        other[rng.randrange(len(line))] = word()
        rows[2 * k], rows[2 * k + 1] = " ".join(line), " ".join(other)
    rows |= {1000 + k: f"Page {k} of 9000" for k in range(300)}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(3)
    found, right = ({d: n for d, n in x.items() if n} for x in ({r.doc_id: r.n_dropped for r in L.dedup_lines(df, grams=8).collect()}, dropped_of_all_pairs(rows, 80)))
    assert found.keys() <= right.keys() and len(found) >= 0.99 * len(right) and len(right) > 400


def test_line_dedup_by_grams_of_odd_texts(odd, empty):
    assert L.dedup_lines(odd, grams=8).count() == odd.count() and L.dedup_lines(empty, grams=8).count() == 0


def test_words_leave_no_reference_cycle():
    """A worker sees millions of words; those of the last batch must go with it, not when Python next looks for cycles."""
    gc.collect()
    gc.disable()
    try:
        words = Words([b"one two three", b"", b"two ONE"], lower=True)
        assert words.distinct == [b"one", b"two", b"three"] and words.ids.tolist() == [0, 1, 2, 1, 0]
        del words
        assert not any(isinstance(x, dict) and b"three" in x for x in gc.get_objects())
    finally:
        gc.enable()
