"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns a DataFrame.

All but the last return the columns of documents, with `n_chars` set to the code points of the
text that they hand on. Null and empty texts pass through every stage: the classifier scores
them like any text, the join links them with nothing, and they hold no passage, no personal data
and no tokens. Repeated rows of one id and text are one document from the join on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinwork.llm import byte_bpe, nbsvm, pii_crf, simhash_windows, token_groups
from veinwork.llm.common import numbered, read
from veinwork.llm.queries import QUALITY_CUT, VOCABULARY, training_fold

# Near-duplicates share at least NEAR_PERCENT of their runs of NEAR_WORDS words.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least QUALITY_CUT."""
    model = nbsvm.fit(docs, read(spark, sf_dir, "labels").filter(training_fold() != 0))
    plain, at = numbered(docs)
    others = [c for c in plain.columns if c != at["doc_id"]]
    scored = nbsvm.score(plain, model, at["doc_id"], at["text"], keep=tuple(others))
    return scored.filter(F.col("score") >= QUALITY_CUT).select(plain.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one whose id names the group."""
    linked = token_groups.link_components(docs, width=NEAR_WORDS, percent=NEAR_PERCENT)
    kept = linked.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    ids = kept.select(F.col("doc_id").alias("kept_id")).distinct()
    plain, at = numbered(docs)
    left = plain.join(ids, F.col(at["doc_id"]).eqNullSafe(F.col("kept_id")), "left_semi")
    return left.dropDuplicates([at["doc_id"], at["text"]]).toDF(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage like a benchmark item."""
    return simhash_windows.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the kind in brackets."""
    masked = pii_crf.mask(docs, pii_crf.fit(docs))
    return masked.withColumn("n_chars", F.char_length("text").cast("long"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens and ids."""
    ranks = byte_bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN)
