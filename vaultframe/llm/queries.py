"""The operators as registered queries, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultframe.llm import bpe, jaccard, language, lexical, licenses, lm, mixing, neighbours, quality, resampling, sharding, tokenfiles, topk
from vaultframe.llm.common import ready, remainder, table
from vaultframe.session import new_work_path, tune

BPE_FILE = "byte_bpe_50k.json"
END_OF_TEXT = 50256
MIX_REPEATS = 4.0


def tokenizer_file(name: str = BPE_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(tune(spark), sf_dir, "documents")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(documents(spark, sf_dir), tokenizer_file())


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(tune(spark), sf_dir, "embeddings"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the corpus as flat token files, then finds every document's tokens again from the files alone."""
    path = new_work_path(ready(spark), "tokens")
    tokenfiles.write_token_files(documents(spark, sf_dir), path, tokenizer_file(), END_OF_TEXT)
    return tokenfiles.documents_of(tokenfiles.read_token_files(spark, path), END_OF_TEXT)


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(documents(ready(spark), sf_dir), jaccard.Likeness(words=3, of=90, per=100))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), 24)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    model = language.learn(docs.where(~held_out))
    return language.predicted(docs, model, doc_id=F.col("doc_id"), held_out=held_out)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir)).drop("detections")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_query(documents(spark, sf_dir), mixing.Target(max_repeats=MIX_REPEATS))


def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(tune(spark), sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_quality_rules, op2_bpe, op3_ann, op4_lm_scoring, op5_token_counts, op6_ngram_jaccard,
        op7_sharding, op8_language_id, op9_license_scan, op10_mixing, op11_exact_topk, op12_lexical_search,
        op13_importance_resampling,
    )
}
ORACLES: dict[str, str] = {
    "op1_quality_rules": quality.SQL,
    "op9_license_scan": licenses.SQL,
    "op11_exact_topk": topk.SQL,
    "op12_lexical_search": lexical.SQL,
    "op13_importance_resampling": resampling.SQL,
}
