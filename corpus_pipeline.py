"""Preparation of a training corpus in five stages, each written as Parquet and read again as the next one's input.

Documents without a recognisable language go, one of each group of near copies stays, passages that repeat are cut
out, sources are mixed to their weights (a document is repeated or left out), and the texts are encoded. There is no
SQL for the whole: tests compare it with a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.llm import bpe, langid, mixing, nearcopies, substring
from quillframe.llm.common import bounded_batches, remove, table
from quillframe.llm.queries import tokenizer_file
from quillframe.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document is rejected if no language comes nearer than this share of the largest distance allows.
LEAST_SCORE = 0.2
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language; profiles are learned from the labelled rows of the stage's own input."""
    bounded_batches(spark)
    model = langid.train(docs.select("text", "lang"))
    named = langid.predict(docs.select(COLUMNS), model, *COLUMNS, keep_text=True)
    return named.where((F.col("lang_pred") != langid.UND) & (F.col("score") >= LEAST_SCORE)).select(COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    bounded_batches(spark)
    return nearcopies.without_copies(docs.select(COLUMNS))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out every passage of 35 words or more that occurs elsewhere too; n_chars follows the text."""
    bounded_batches(spark)
    return substring.without_repeats(docs.select(COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources come near their target weights."""
    bounded_batches(spark)
    return mixing.copies(docs.select(COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, decoded_sha256: the token ids of each text, and digests of them and of what they decode to."""
    bounded_batches(spark)
    return bpe.corpus(docs, tokenizer_file())


STAGES = [("language ID", language_id), ("MinHash near-dedup", near_copies), ("substring dedup", substring_dedup),
          ("mixing sources", source_mix), ("BPE encoding and decoding", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = table(spark, sf_dir, "documents"), []
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = scratch_path(spark, f"stage-{k}")
        out.write.parquet(path)
        remove(spark, *written)  # the stage that read it is written
        docs, written = spark.read.parquet(path), [path]
    return docs
