"""Language identification by rank-order profiles.

A profile is a language's most frequent letter n-grams in order; a document's own most frequent n-grams are compared
with it by the out-of-place distance: the sum of rank differences, an n-gram that the profile lacks counting as far as
a rank can be. The nearest profile names the language.

Training covers all labelled texts: n-grams are counted inside each task, summed by Spark and ranked per language.
Rules: a null text or one without a letter is ``und`` with score 0; equal distances go to the language that sorts
first; n-grams of equal count are ranked by their letters; null languages teach nothing; without any labelled text all
documents are ``und``. Case is ignored, other characters than letters only separate words.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UND = "und"
#: Longest n-gram; letters are packed 21 bits each, so three fill one 64-bit number exactly.
ORDER = 3
#: Ranks of a profile.
TOP = 300
#: Characters taken at once; long texts are counted in pieces, of which only the sums are kept.
PIECE = 1 << 19


class Letters:
    """Maps characters to lower-case letters, or to 0 what is no letter; one table for each Python worker."""

    def __init__(self):
        self.table = np.zeros(0x110000, np.uint32)
        self.seen = np.zeros(0x110000, bool)

    def __call__(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not self.seen[codes].all():
            for c in np.unique(codes[~self.seen[codes]]).tolist():
                low = chr(c).lower() if chr(c).isalpha() else ""
                self.table[c] = ord(low) if len(low) == 1 else (c if low else 0)
                self.seen[c] = True
        return self.table[codes]


_letters: list[Letters] = []


def letters(text: str) -> np.ndarray:
    if not _letters:
        _letters.append(Letters())
    return _letters[0](text)


def grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of letters with a word border (1) around each word, and their counts."""
    ok = codes > 0
    c = np.where(ok, codes, 1).astype(np.uint64)
    c = np.concatenate([[np.uint64(1)], c, [np.uint64(1)]])
    a, b, d = c[:-2], c[1:-1], c[2:]
    shift = np.uint64(21)
    pair = (c[:-1] << shift) | c[1:]
    pair = pair[(c[:-1] != 1) | (c[1:] != 1)]
    three = ((a << shift | b) << shift | d)[b != 1]
    return np.unique(np.concatenate([c[c != 1], pair, three]), return_counts=True)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    if len(text) <= PIECE:
        return grams(letters(text))
    keys, counts = [], []
    for i in range(0, len(text), PIECE):
        k, n = grams(letters(text[i:i + PIECE]))
        keys.append(k)
        counts.append(n)
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, np.concatenate(counts)).astype(np.int64)


def ranked(text: str) -> np.ndarray:
    """A document's most frequent n-grams in order."""
    key, n = counted(text)
    if len(key) > TOP:
        least = np.partition(n, len(n) - TOP)[len(n) - TOP]
        keep = n >= least
        key, n = key[keep], n[keep]
    return key[np.lexsort((key, -n))][:TOP]


def train(labelled: DataFrame) -> DataFrame:
    """lang, gram, rank (from 0) from ``labelled`` rows with columns text and lang, all of them."""

    def count(batches):
        sums: dict[str, Counter] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                if text and lang is not None:
                    key, n = counted(text)
                    sums.setdefault(lang, Counter()).update(dict(zip(key.tolist(), n.tolist())))
        for lang, counter in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(counter), "gram": list(counter), "n": list(counter.values())},
                                             schema=pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())]))

    parts = labelled.select(F.col("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null").mapInArrow(count, "lang string, gram bigint, n bigint")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
            .withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < TOP).select("lang", "gram", "rank"))


class Profiles:
    """The learned profiles in arrays: sorted n-grams and, for each language, their ranks."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({r[0] for r in rows})
        self.keys = np.array(sorted({r[1] for r in rows}), np.int64).astype(np.uint64)
        at = {k: i for i, k in enumerate(self.keys.tolist())}
        self.ranks = np.full((len(self.langs), len(self.keys) + 1), TOP, np.int64)
        place = {lang: i for i, lang in enumerate(self.langs)}
        self.missing = np.full((len(self.langs), len(self.keys) + 1), True)
        for lang, gram, rank in rows:
            self.ranks[place[lang], at[gram]] = rank
            self.missing[place[lang], at[gram]] = False

    def predict(self, text: str | None) -> tuple[str, float]:
        top = ranked(text) if text and self.langs else np.zeros(0, np.uint64)
        if not len(top):
            return UND, 0.0
        at = np.searchsorted(self.keys, top)
        at = np.where((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == top), at, len(self.keys))
        out = np.where(self.missing[:, at], TOP, np.abs(self.ranks[:, at] - np.arange(len(top)))).sum(1)
        best = int(out.argmin())
        return self.langs[best], 1.0 - float(out[best]) / (TOP * len(top))


def predict(documents: DataFrame, profiles: DataFrame, *keep: str, keep_text: bool = False) -> DataFrame:
    """The columns ``keep`` of each document with lang_pred and score, 1 less the share of the largest distance.

    The profiles hold TOP rows for each language, so they are small whatever the table's size.
    """
    rows = [tuple(r) for r in profiles.select("lang", "gram", "rank").collect()]
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(rows)
    model: list[Profiles] = []
    read = "text" if keep_text else "_text"

    def run(batches):
        if not model:
            model.append(Profiles(shared.value))
        for batch in batches:
            at = batch.schema.get_field_index(read)
            found = [model[0].predict(t) for t in batch.column(at).to_pylist()]
            if keep_text:
                at = -1
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != at), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                                             names=[*(n for i, n in enumerate(batch.schema.names) if i != at), "lang_pred", "score"])

    source = documents.select(*keep) if keep_text else documents.select(*keep, F.col("text").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "_text")
    return source.mapInArrow(run, f"{fields}, lang_pred string, score double")


def remainder(column: str, modulus: int) -> F.Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from two thirds of the labelled rows, predicted for all."""
    held = remainder("doc_id", 3) == 1
    model = train(documents.where(F.coalesce(~held, F.lit(True))).select("text", "lang"))
    kept = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held_out"), "text")
    return predict(kept, model, "doc_id", "held_out")
