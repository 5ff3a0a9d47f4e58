"""Word vectors by skip-grams with negative sampling, learned in slices of the corpus.

Texts are dealt into slices of about ``SLICE_WORDS`` words by a hash of their row. A slice holds the vectors of its own words
only, starts them from a hash of the word and learns them in one pass, whatever the number of tasks; a word's vector is the
mean of its slices, weighed by how often it stands there. So the work grows with the words of the corpus, a task's memory with
a slice, and nothing of the vocabulary's size is on the driver or broadcast. Words of fewer than ``min_count`` places are left
out before windows are taken. The same rows and seed give the same vectors but for the rounding of sums.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.corpus.tokens import token_array
from quillframe.corpus.vectors import kept

SLICE_WORDS = 1 << 21
#: Words of the text that learn together, noise words for each pair, neighbouring words that share a noise word, first rate.
CENTRES, NEGATIVE, SHARE, RATE = 1024, 5, 4, 0.025
#: Steps that one vector takes in full when CENTRES words learn together; the sum of more is shortened to as many.
STEPS = 32
#: Noise words are drawn from so many, which are drawn once a slice.
NOISE_TABLE = 1 << 20


def slices(df: DataFrame, text: str, seed: int = 0, slice_words: int = SLICE_WORDS) -> DataFrame:
    """(at, words, slice): the cleaned texts with words one blank apart, written once; texts without words are left out."""
    cleaned = F.transform(F.array(token_array(F.col(text))), lambda w: F.struct(F.size(w).alias("size"), F.array_join(w, " ").alias("words")))[0]
    rows = kept(df.select(F.xxhash64(*df.columns, F.lit(seed)).alias("at"), cleaned.alias("text")), "words").where("text.size > 0")
    total = rows.agg(F.coalesce(F.sum("text.size"), F.lit(0))).scalar()
    return rows.select("at", "text.words").withColumn("slice", F.pmod(F.col("at"), F.greatest(F.ceil(total / slice_words), F.lit(1))).cast("int"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(slice, word, n): how often a word stands in a slice, counted once and written."""
    def counted(key: tuple, table: pa.Table) -> pa.Table:
        found = _split(table).flatten().value_counts()
        return pa.table({"slice": pa.array([key[0].as_py()] * len(found), pa.int32()), "word": found.field("values"), "n": found.field("counts")})

    return kept(texts.select("slice", "words").groupBy("slice").applyInArrow(counted, "slice int, word string, n bigint"), "counts")


def learned(texts: DataFrame, counts: DataFrame, size: int, window: int, min_count: int, seed: int = 0) -> DataFrame:
    """(word, vector) of the words of ``min_count`` places or more."""
    known = counts.groupBy("word").agg(F.sum("n").alias("total")).where(F.col("total") >= min_count)
    vocabulary = counts.join(known, "word").select("slice", "word", "total", F.xxhash64("word", F.lit(seed)).alias("hash"))

    def learn(key: tuple, some: pa.Table, words: pa.Table) -> pa.Table:
        some, words = some.sort_by("at"), words.sort_by("word")
        named = words["word"].combine_chunks()
        split = _split(some)
        ids = pc.index_in(split.flatten(), value_set=named).fill_null(-1).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
        row, ids = row[ids >= 0], ids[ids >= 0]
        vectors = start(words["hash"].to_numpy(), size)
        skip_grams(ids, row, vectors, words["total"].to_numpy(), window, np.random.default_rng([seed, key[0].as_py()]))
        ends = pa.array(np.arange(0, vectors.size + 1, size), pa.int32())
        return pa.table({"word": named, "n": np.bincount(ids, minlength=len(named)), "vector": pa.ListArray.from_arrays(ends, pa.array(vectors.ravel()))})

    parts = texts.groupBy("slice").cogroup(vocabulary.groupBy("slice")).applyInArrow(learn, "word string, n bigint, vector array<float>")
    sums = parts.groupBy("word").agg(F.sum("n").alias("n"), *[F.sum(F.col("n") * F.get("vector", F.lit(j))).alias(f"s{j}") for j in range(size)])
    return sums.select("word", F.array(*[F.col(f"s{j}") / F.col("n") for j in range(size)]).alias("vector"))


def _split(table: pa.Table) -> pa.ListArray:
    return pc.split_pattern(table["words"].combine_chunks(), " ")


def start(hashes: np.ndarray, size: int) -> np.ndarray:
    """Numbers in [-0.5, 0.5) / size from the hash of each word."""
    x = hashes.astype(np.uint64)[:, None] + np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for turn, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(turn))) * np.uint64(times)
    return (((x >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24) - np.float32(0.5)) / np.float32(size)).astype(np.float32)


def skip_grams(ids: np.ndarray, row: np.ndarray, vectors: np.ndarray, count: np.ndarray, window: int, rng: np.random.Generator) -> None:
    """Learn ``vectors`` in place from word numbers and the texts they stand in, one pass with a falling rate.

    A word meets those up to a drawn distance of at most ``window``, and noise words drawn by their count to the power of 3/4.
    """
    if not len(ids):
        return
    context = np.zeros_like(vectors)
    share = np.cumsum(count.astype(float) ** 0.75)
    table = np.searchsorted(share, np.sort(rng.random(NOISE_TABLE)) * share[-1], "right").astype(np.int32)
    size = np.bincount(row)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    reach = rng.integers(1, window + 1, len(ids))
    before, after = np.minimum(at, reach), np.minimum(size[row] - 1 - at, reach)
    edge = np.zeros(window, np.int32)  # met by nothing
    ids, far = np.concatenate([edge, ids.astype(np.int32), edge]), np.arange(1, window + 1)[:, None]
    for a in range(0, len(row), CENTRES):
        b = min(a + CENTRES, len(row))
        own, around = ids[a + window : b + window], ids[a : b + 2 * window]
        rate = np.float32(RATE * max(1e-4, 1 - a / len(row)))
        # Vectors stand in columns, so that a step meets a run of words at once.
        x, near = np.ascontiguousarray(vectors[own].T), np.ascontiguousarray(context[around].T)
        push, back, faced = np.zeros_like(x), np.zeros_like(near), np.zeros(len(around), np.float32)
        real = np.vstack([before[a:b] >= far[::-1], after[a:b] >= far]).astype(np.float32)
        met = real.sum(0)
        there = [slice(p, p + b - a) for p in range(2 * window + 1) if p != window]
        step = rate * real * _sigmoid(-np.stack([np.einsum("ij,ij->j", x, near[:, p]) for p in there]))
        for p, pulled, n in zip(there, step, real):
            push += pulled * near[:, p]
            back[:, p] += pulled * x
            faced[p] += n
        drawn = table[rng.integers(0, NOISE_TABLE, (NEGATIVE, -(-(b - a) // SHARE)))]
        away, weight = [], _joined(met[None, :])[0]
        for words in drawn:
            y = np.repeat(np.ascontiguousarray(context[words].T), SHARE, axis=1)[:, : b - a]
            pushed = -rate * met * _sigmoid(np.einsum("ij,ij->j", x, y))
            push += pushed * y
            away.append(_joined(pushed * x))
        _add(vectors, own, push, met * (1 + NEGATIVE))
        _add(context, np.append(around, drawn), np.hstack([back, *away]), np.append(faced, np.tile(weight, NEGATIVE)))


def _joined(columns: np.ndarray) -> np.ndarray:
    """Sums of SHARE neighbouring columns."""
    out = columns[:, ::SHARE].copy()
    for i in range(1, SHARE):
        more = columns[:, i::SHARE]
        out[:, : more.shape[1]] += more
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) + np.float32(0.5) * np.tanh(x * np.float32(0.5))


def _add(table: np.ndarray, at: np.ndarray, change: np.ndarray, steps: np.ndarray) -> None:
    """Add columns to the rows of a table, those for one row together; a sum of many steps is shortened so that it can't overshoot."""
    order = np.argsort(at)
    at = at[order]
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    total = np.maximum(np.add.reduceat(steps[order], first), np.float32(STEPS))
    table[at[first]] += np.add.reduceat(np.ascontiguousarray(change.T)[order], first, axis=0) * (np.float32(STEPS) / total)[:, None]
