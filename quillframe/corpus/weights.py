"""Term weights, word vectors, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.corpus import skipgram
from quillframe.plans.ordered import scan
from quillframe.plans.seeded import order_key, uniform
from quillframe.session import scratch_path

WORD = r"[\p{L}\p{N}_]{2,}"


def terms(text: Column) -> Column:
    """Lower-case words of two characters or more."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def tf_idf(df: DataFrame, doc: str, text: str, min_df: int = 1) -> DataFrame:
    """(doc, term, weight): tf * (ln((1 + N) / (1 + df)) + 1) over terms in at least ``min_df`` documents, each document scaled to length one."""
    # Both uses read what was counted once.
    path = scratch_path(df.sparkSession, "terms")
    df.select(doc, F.explode(terms(F.col(text))).alias("term")).groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf")).write.parquet(path)
    tf = df.sparkSession.read.parquet(path)
    total = df.agg(F.count(F.lit(1))).scalar()
    idf = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= min_df).select(
        "term", (F.ln((1 + total) / (1 + F.col("df"))) + 1).alias("idf"))
    raw = tf.join(idf, "term").select(doc, "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = raw.groupBy(doc).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, doc).select(doc, "term", (F.col("w") / F.col("norm")).alias("weight"))


def word_vectors(df: DataFrame, text: str, size: int = 300, window: int = 10, min_count: int = 1, seed: int = 0) -> DataFrame:
    """(word, vector) learned from the cleaned texts, the same however many task slots there are."""
    texts = skipgram.slices(df, text, seed)
    return skipgram.learned(texts, skipgram.word_counts(texts), size, window, min_count, seed)


def with_unknown_vectors(wanted: DataFrame, vectors: DataFrame, size: int, seed: int = 0) -> DataFrame:
    """A vector for every wanted word; words without one get numbers in [-0.25, 0.25) from their hash."""
    made = F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: uniform(seed, F.col("word"), i) * 0.5 - 0.25)
    return wanted.join(vectors, "word", "left").withColumn("vector", F.coalesce("vector", made))


def batches(df: DataFrame, ids: list[str], size: int, epochs: int, seed: int = 0) -> DataFrame:
    """(epoch, batch, ids): the rows shuffled anew in each epoch and cut into numbered batches."""
    each = df.select(*ids, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    keyed = each.withColumn("_k", order_key(seed, F.col("epoch"), *ids))
    rows = scan(keyed, ["epoch"], ["_k", *ids], {"_rn": ("row_number",)})
    return rows.select("epoch", F.floor((F.col("_rn") - 1) / size).alias("batch"), *ids)


def write_batches(batched: DataFrame, path: str) -> None:
    """Batches stored in order, many to a file, so that a reader takes them by range."""
    batched.repartitionByRange("epoch", "batch").sortWithinPartitions("epoch", "batch").write.parquet(path)
