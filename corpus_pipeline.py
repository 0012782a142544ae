"""The training-data pipeline: language, quality, near copies, mixture, tokens.

Every stage works on all that the one before it kept, writes Parquet to the shared
folder and is read again by the next, so a lost executor costs a stage's tasks
and never the stages before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vaultframe.llm import bpe, jaccard, language, mixing, quality
from vaultframe.llm.common import ready, table
from vaultframe.llm.queries import tokenizer_file
from vaultframe.session import stage

#: Near copies: shingles of five words, similarity 0.8.
NEAR_COPIES = jaccard.Likeness(words=5, of=80, per=100)
#: No source is used more than twice, and the budget lets every document in once.
MIXTURE = mixing.Target(max_repeats=2.0)


def name_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is recognised; learns from their own labels.

    Null texts, texts without a letter and unsure ones go. Without a label nothing is learned and nothing kept; repeated rows and
    ties are judged row by row; other columns, whatever their names, are carried along; no rows give none.
    """
    ready(spark)
    return language.keep_named(docs, language.learn(docs))


def check_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that pass every quality rule.

    Null and empty texts have no words and go. Whole texts are judged, row by row, so repeated rows share their fate; other columns,
    whatever their names, are carried along; no rows give none.
    """
    ready(spark)
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of exact and near copies, that of the smallest id.

    Texts without words are near no other and all stay. Of repeated rows one stays; of one id with different texts
    in a group, the first by a hash of the text. Other columns are carried along; no rows give none.
    """
    ready(spark)
    return jaccard.keep_one(docs, NEAR_COPIES)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of rare sources again as far as the mixture asks: a row for each use.

    A null source is a source of its own. Texts without words cost nothing and are used once. Repeated rows are used together or not
    at all. Other columns are carried along; no rows give none.
    """
    ready(spark)
    return mixing.mixed(docs, MIXTURE).select("row.*")


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` for each use of a document.

    Null and empty texts have no tokens. Whole texts are encoded; other columns are dropped; no rows give none.
    """
    ready(spark)
    return bpe.encode_digests(docs, tokenizer_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", name_language),
    ("quality_rules", check_quality),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]
#: Training, sampling order and BPE merges are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), name)
    return docs
