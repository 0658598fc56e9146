"""The document pipeline: STAGES in order, each over all rows its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns the columns of ``docs``, the last one what its files hold. Null texts,
repeated rows, empty tables and extra columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargauge.llm.catalog import table, vocabulary
from stargauge.llm.decontaminate import remove_contaminated
from stargauge.llm.language import UNKNOWN, language_of, learn_languages
from stargauge.llm.mixing import mix_documents, plan_mixture
from stargauge.llm.set_join import keep_one_of_each_group
from stargauge.llm.store import new_folder, ship_package
from stargauge.llm.token_files import read_token_files, write_token_files

ORACLE_SQL = None  # the stages hold trained models and seeded draws, which SQL cannot state

#: A document goes if no language reaches this posterior.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a known language; null, empty and letterless texts go."""
    ship_package(spark)
    model = learn_languages(docs, vocabulary("word_bpe_49k.json"))
    found = docs.select("*", language_of(docs, model, docs["text"]).alias("__language"))
    good = (F.col("__language.lang") != UNKNOWN) & (F.col("__language.score") >= LEAST_SCORE)
    return found.where(good).drop("__language")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 of five-word shingles."""
    ship_package(spark)
    return keep_one_of_each_group(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them (never, once or twice), shuffled within its shards."""
    ship_package(spark)
    return mix_documents(docs, plan_mixture(docs, weights=(3, 1, 2), share=1.5, most=2.0))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the documents as token files; returns what the files hold of each document."""
    ship_package(spark)
    path = new_folder(spark, "token-files")
    write_token_files(docs, path, vocabulary("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path, digest=True)


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = new_folder(spark, f"stage-{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
