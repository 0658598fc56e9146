"""The registered queries of this package: each operator on the whole driver tables, with production parameters."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align_tokens
from .decontaminate import find_passages, passage_report
from .dialogues import repair_report
from .fuzzy_lines import dedup_lines
from .language import identify_languages, learn_languages, vocabulary_pieces
from .mixing import mixture_sizes, plan_mixture
from .ngram_model import score_texts, train_ngrams
from .private_data import find_private_data, span_report
from .quality import judge_quality, learn_quality
from .secrets_scan import dictionary_of, find_candidates, judge_findings, label_by_form, train_forest
from .set_join import jaccard_groups
from .sharding import shard_documents
from .store import new_folder, ship_package, written
from .token_files import read_token_files, write_token_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name; without SQL it is tested against brute force in tests/llm."""

    def register(function: Query) -> Query:
        @functools.wraps(function)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship_package(spark)
            return function(spark, sf)

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str) -> bytes:
    """A public tokenizer file, read on the driver."""
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def vocabulary(name: str) -> str:
    """A public tokenizer file's text, read on the driver."""
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


@query()
def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    write_token_files(table(spark, sf, "documents"), path, vocabulary("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path, digest=True)


def remainder(name: str, by: int):
    """crc32 of the id as text, modulo ``by``; a null id gives -1."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % by, F.lit(-1))


@query()
def op4_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held = remainder("doc_id", 3) == 1
    model = learn_languages(docs.where(~held), vocabulary("word_bpe_49k.json"))
    found = identify_languages(docs.select("doc_id", "text", held.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query()
def op5_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_groups(table(spark, sf, "documents"), size=3, percent=90)


_WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)


@query(f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, w[i:i + least(10, len(w)) - 1] AS win
       FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, i, k, w[i:i + k - 1] AS win FROM d, ks, unnest(range(1, len(w) - k + 2)) AS t(i)),
occ AS (SELECT doc_id, i, dw.k, item_id FROM dw JOIN bw ON dw.win = bw.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
""")
def op6_benchmark_passages(spark: SparkSession, sf: str) -> DataFrame:
    return passage_report(find_passages(table(spark, sf, "documents"), table(spark, sf, "benchmark")))


@query()
def op2_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixture_sizes(plan_mixture(table(spark, sf, "documents"), weights=(3, 1, 2), share=1.5, most=2.0))


@query()
def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return judge_quality(docs, learn_quality(docs, table(spark, sf, "labels")))


@query()
def op1_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held = remainder("doc_id", 7) == 2
    return score_texts(docs, train_ngrams(docs.where(~held)), held)


@query()
def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf, "documents"), grams=8)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@query()
def op8_private_data(spark: SparkSession, sf: str) -> DataFrame:
    return span_report(find_private_data(table(spark, sf, "documents")))


@query()
def op9_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    findings = written(find_candidates(docs, dictionary_of(vocabulary_pieces(vocabulary("word_bpe_49k.json")))), "findings")
    model = train_forest(label_by_form(findings.where(remainder("doc_id", 3) != 1)))
    return judge_findings(findings, model)


@query()
def op12_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    models = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return align_tokens(table(spark, sf, "documents"), models)


# CRC-32 by its table, which is made from the polynomial.
_CRC_TABLE_SQL = """crc_table AS (
  SELECT list(list_reduce([v::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY v) AS crc
  FROM range(256) AS t(v))"""


@query("""
WITH """ + _CRC_TABLE_SQL + """,
points AS (
  SELECT doc_id, text, strlen(coalesce(text, '')) + 1 AS size,
         list_transform(regexp_extract_all(coalesce(text, ''), '(?s).'), lambda x: unicode(x)::BIGINT) AS cps
  FROM documents),
bytes AS (
  SELECT doc_id, text, size, flatten(list_transform(cps, lambda c: CASE
    WHEN c < 128 THEN [c] WHEN c < 2048 THEN [192 | (c >> 6), 128 | (c & 63)]
    WHEN c < 65536 THEN [224 | (c >> 12), 128 | ((c >> 6) & 63), 128 | (c & 63)]
    ELSE [240 | (c >> 18), 128 | ((c >> 12) & 63), 128 | ((c >> 6) & 63), 128 | (c & 63)] END)) AS b
  FROM points),
keyed AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b),
           lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]))) AS text_crc32,
         CAST('0x' || left(md5(coalesce(text, '')), 15) AS BIGINT) AS k0,
         CAST('0x' || left(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 15) AS BIGINT) AS k1
  FROM bytes, crc_table),
run AS (
  SELECT *, sum(size) OVER (ORDER BY k0, k1 ROWS UNBOUNDED PRECEDING) AS seen, sum(size) OVER () AS total FROM keyed),
dealt AS (
  SELECT *, CAST((2 * seen - size) * 16 // (2 * total) AS INTEGER) AS shard FROM run)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY k0, k1) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM dealt
""")
def op13_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return shard_documents(table(spark, sf, "documents"), shards=16)


@query("""
WITH RECURSIVE
""" + _CRC_TABLE_SQL + """,
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
coded AS (
  SELECT conv_id, turn, role, text,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(split(key, ''), lambda x: unicode(x)::BIGINT)),
             lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) % 20 AS kind
  FROM keyed, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         left(role, 1) AS ini, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
  FROM damaged),
faults AS (
  SELECT *, body = '' AS blank, body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
marked AS (
  SELECT *, NOT blank AND NOT dup AND right(body, 1) NOT IN ('.', '!', '?') AS cut FROM faults),
steps AS (
  SELECT conv_id, 0 AS i, {c: 0::BIGINT, a: '', r: ''} AS s0, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR)) AS s1,
         {c: 3::BIGINT, a: 'I', r: chr(10) || 'user:'} AS s2, {c: 6::BIGINT, a: 'II', r: chr(10) || 'user:' || chr(10) || 'assistant:'} AS s3
  FROM (SELECT DISTINCT conv_id FROM damaged)
  UNION ALL
  SELECT conv_id, i, t0, t1, t2, least(t3, CASE WHEN t2 IS NOT NULL THEN {c: t2.c + 3, a: t2.a || 'I', r: t2.r || chr(10) || 'assistant:'} END)
  FROM (
    SELECT conv_id, i, t0, t1, t3, least(t2,
             CASE WHEN t0 IS NOT NULL THEN {c: t0.c + 3, a: t0.a || 'I', r: t0.r || chr(10) || 'user:'} END,
             CASE WHEN t1 IS NOT NULL THEN {c: t1.c + 3, a: t1.a || 'I', r: t1.r || chr(10) || 'user:'} END,
             CASE WHEN t3 IS NOT NULL THEN {c: t3.c + 3, a: t3.a || 'I', r: t3.r || chr(10) || 'user:'} END) AS t2
    FROM (
      SELECT conv_id, i, d0 AS t0,
             least(d1, CASE WHEN free AND ini = 's' AND s0 IS NOT NULL THEN {c: s0.c + stay, a: s0.a || 'K', r: s0.r || own} END) AS t1,
             least(d2,
               CASE WHEN free AND ini = 'u' AND s0 IS NOT NULL THEN {c: s0.c + stay, a: s0.a || 'K', r: s0.r || own} END,
               CASE WHEN free AND ini = 'u' AND s1 IS NOT NULL THEN {c: s1.c + stay, a: s1.a || 'K', r: s1.r || own} END,
               CASE WHEN free AND ini = 'u' AND s3 IS NOT NULL THEN {c: s3.c + stay, a: s3.a || 'K', r: s3.r || own} END,
               CASE WHEN free AND s0 IS NOT NULL THEN {c: s0.c + stay + 3, a: s0.a || 'R', r: s0.r || usr} END,
               CASE WHEN free AND s1 IS NOT NULL THEN {c: s1.c + stay + 3, a: s1.a || 'R', r: s1.r || usr} END,
               CASE WHEN free AND s3 IS NOT NULL THEN {c: s3.c + stay + 3, a: s3.a || 'R', r: s3.r || usr} END) AS t2,
             least(d3,
               CASE WHEN free AND ini = 'a' AND s2 IS NOT NULL THEN {c: s2.c + stay, a: s2.a || 'K', r: s2.r || own} END,
               CASE WHEN free AND s2 IS NOT NULL THEN {c: s2.c + stay + 3, a: s2.a || 'R', r: s2.r || ast} END) AS t3
      FROM (
        SELECT m.conv_id, m.i, NOT blank AND NOT dup AS free, CASE WHEN cut THEN 3 ELSE 0 END AS stay, ini, s0, s1, s2, s3,
               chr(10) || role || ':' || text AS own, chr(10) || 'user:' || text AS usr, chr(10) || 'assistant:' || text AS ast,
               {c: s0.c + 4, a: s0.a || 'D', r: s0.r} AS d0,
               CASE WHEN s1 IS NOT NULL THEN {c: s1.c + 4, a: s1.a || 'D', r: s1.r} END AS d1,
               {c: s2.c + 4, a: s2.a || 'D', r: s2.r} AS d2, {c: s3.c + 4, a: s3.a || 'D', r: s3.r} AS d3
        FROM steps JOIN marked m ON m.conv_id IS NOT DISTINCT FROM steps.conv_id AND m.i = steps.i + 1)))),
solved AS (
  SELECT conv_id, arg_max(least(s0, s3), i) AS best FROM steps GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE dup) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
         count(*) FILTER (WHERE i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(best.r[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN solved ON solved.conv_id IS NOT DISTINCT FROM ids.conv_id
""")
def op11_dialogue_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repair_report(table(spark, sf, "conversations"))
