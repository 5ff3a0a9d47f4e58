"""Language-model scores by deleted interpolation.

Word pairs and words are counted over all training texts. The probability of a word mixes its share after the word
before it, its share overall and an even share of all words; the weights depend on how often the word before was seen
(one bucket for each power of two) and are learned by expectation-maximisation on held-out counts: a part of the
training texts (fold DEV) is left out of the counts for that.

Texts are packed into blocks of bounded size. A block asks for the counts of its distinct words and pairs, range by
range of their 64-bit hashes; each range is summed in one task and the sums go back to the block. So what is shuffled
are distinct items of blocks, a frequent pair costs one entry in each block, and no dictionary is broadcast.

Rules: a null text is empty and has only the end token; repeated rows are texts of their own; without training texts
every word is unknown and all probabilities are the even share; without a DEV text the weights stay even.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm.common import Hashes, packed_counts, packed_keys, saved, scramble, unpacked_counts, unpacked_keys, words_of
from quillframe.llm.langid import remainder

FOLDS, HELD, DEV = 7, 2, 3
#: Characters of a block; a longer text is a block of its own.
BLOCK_CHARS = 3_000_000
#: Tokens of the corpus for each range of hashes, and the fewest ranges.
RANGE_TOKENS, LEAST_RANGES = 1_000_000, 64
#: Counts of a context are bucketed by powers of two; ratios of probabilities by tenths of a decade for learning.
BUCKETS, BINS = 48, 160
_END, _START = np.uint64(0x1D8E4E27C47D124F), np.uint64(0x72BE5D74F27B8965)

BLOCK = pa.schema([("doc_id", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("dev", pa.list_(pa.bool_())), ("text", pa.list_(pa.string())), ("tokens", pa.int64()), ("train_docs", pa.int64()), ("dev_docs", pa.int64())])
ASK = pa.schema([("kind", pa.int32()), ("range", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("keys", pa.binary()), ("train", pa.binary()), ("dev", pa.binary())])
ANSWER = pa.schema([("kind", pa.int32()), ("range", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("train", pa.binary()), ("dev", pa.binary()), ("total", pa.int64()), ("distinct", pa.int64()), ("dev_total", pa.int64()), ("dev_distinct", pa.int64())])
COUNTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("dev", pa.bool_()), ("word", pa.list_(pa.int64())), ("pair", pa.list_(pa.int64())), ("dev_word", pa.list_(pa.int64())), ("dev_pair", pa.list_(pa.int64()))])


def blocks(documents: DataFrame) -> DataFrame:
    """The texts in blocks, numbered once and for all by being written."""
    rest = remainder("doc_id", FOLDS)
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(rest == HELD, F.lit(False)).alias("held_out"), F.coalesce(rest == DEV, F.lit(False)).alias("dev"), "text")

    def pack(batches):
        rows, size = [], 0

        def flush():
            ids, held, dev, texts = zip(*rows)
            tokens = sum(len(words_of(t)) + 1 for t in texts)
            values = [ids, held, dev, texts, tokens, sum(not h for h in held), sum(dev)]
            return pa.RecordBatch.from_arrays([pa.array([list(v) if isinstance(v, tuple) else v], f.type) for v, f in zip(values, BLOCK)], schema=BLOCK)

        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "held_out", "dev", "text"))):
                if rows and size + len(row[3] or "") > BLOCK_CHARS:
                    yield flush()
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3] or "")
        if rows:
            yield flush()

    made = docs.mapInArrow(pack, "doc_id array<bigint>, held_out array<boolean>, dev array<boolean>, text array<string>, tokens bigint, train_docs bigint, dev_docs bigint")
    return saved(made.withColumn("block", F.monotonically_increasing_id()))


def tokens(texts: list[str | None], hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all texts, pair hashes, and the place after each text's last token."""
    parts = []
    for t in texts:
        parts.append(hashes.array(b" ".join(words_of(t)).lower().split()))
        parts.append(np.array([_END]))
    word = np.concatenate(parts)
    stop = np.cumsum([len(a) + 1 for a in parts[::2]])
    before = np.concatenate([[_START], word[:-1]])
    before[stop[:-1]] = _START
    return word, scramble(before * np.uint64(0x9FB21C651E98DF25) + word, 1), stop


def asked(made: DataFrame, ranges: int) -> DataFrame:
    """For each block and range: sorted distinct hashes, and their counts in training and DEV texts."""
    edges = [np.uint64((i << 64) // ranges) for i in range(1, ranges)]

    def run(batches):
        hashes = Hashes()
        for batch in batches:
            for block, texts, held, dev in zip(*(batch.column(n).to_pylist() for n in ("block", "text", "held_out", "dev"))):
                word, pair, stop = tokens(texts, hashes)
                of = np.diff(np.concatenate([[0], stop]))
                train, left = np.repeat(~np.array(held, bool), of), np.repeat(np.array(dev, bool), of)
                for kind, values in enumerate((word, pair)):
                    key, at = np.unique(values, return_inverse=True)
                    counts = [np.bincount(at, w, len(key)).astype(np.uint32) for w in (train, left)]
                    cut = np.concatenate([[0], np.searchsorted(key, edges), [len(key)]])
                    rows = [(kind, r, block, b - a, packed_keys(key[a:b]), packed_counts(counts[0][a:b]), packed_counts(counts[1][a:b])) for r, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ASK)], schema=ASK)

    return made.select("block", "text", "held_out", "dev").mapInArrow(run, "kind int, range int, block bigint, n int, keys binary, train binary, dev binary")


def answered(asks: DataFrame) -> DataFrame:
    """The corpus counts of all asked hashes, range by range; a range holds its share of the distinct items of blocks."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        n = [r["n"] for r in rows]
        key, at = np.unique(np.concatenate([unpacked_keys(r["keys"], r["n"]) for r in rows]), return_inverse=True)
        train, dev = (np.bincount(at, np.concatenate([unpacked_counts(r[c], r["n"]) for r in rows]), len(key)).astype(np.int64) for c in ("train", "dev"))
        stop = np.cumsum(n)
        out = []
        for i, r in enumerate(rows):
            mine = at[stop[i] - n[i]:stop[i]]
            once = (int(train.sum()), int((train > 0).sum()), int(dev.sum()), int((train > dev).sum())) if i == 0 else (0, 0, 0, 0)
            out.append((r["kind"], r["range"], r["block"], r["n"], packed_counts(train[mine]), packed_counts(dev[mine]), *once))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), ANSWER)], schema=ANSWER)

    return asks.groupBy("kind", "range").applyInArrow(run, "kind int, range int, block bigint, n int, train binary, dev binary, total bigint, distinct bigint, dev_total bigint, dev_distinct bigint")


def counted(made: DataFrame, answers: DataFrame) -> DataFrame:
    """Per document the corpus counts of its words and pairs in text order; DEV documents also without DEV."""
    back = answers.groupBy(F.col("block").alias("_block")).agg(F.collect_list(F.struct("kind", "range", "n", "train", "dev")).alias("found"))

    def run(batches):
        hashes = Hashes()
        for batch in batches:
            for ids, held, dev, texts, found in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "held_out", "dev", "text", "found"))):
                values = tokens(texts, hashes)
                stop = values[2]
                total, left = [], []
                for kind in (0, 1):
                    rows = sorted((f for f in found if f["kind"] == kind), key=lambda f: f["range"])
                    at = np.unique(values[kind], return_inverse=True)[1]
                    train, without = (np.concatenate([unpacked_counts(f[c], f["n"]) for f in rows])[at] for c in ("train", "dev"))
                    total.append(train)
                    left.append(train - without)
                begin = stop - np.diff(np.concatenate([[0], stop]))
                cuts = pa.array(np.concatenate([[0], stop]).astype(np.int32))
                held_cuts = np.where(np.array(dev, bool), stop - begin, 0)
                chosen = np.repeat(np.array(dev, bool), stop - begin)
                dev_cuts = pa.array(np.concatenate([[0], np.cumsum(held_cuts)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in total] + [pa.ListArray.from_arrays(dev_cuts, pa.array(x[chosen])) for x in left]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(dev, pa.bool_()), *lists], schema=COUNTED)

    joined = made.join(back, made["block"] == back["_block"]).select("doc_id", "held_out", "dev", "text", "found")
    return saved(joined.mapInArrow(run, "doc_id bigint, held_out boolean, dev boolean, word array<bigint>, pair array<bigint>, dev_word array<bigint>, dev_pair array<bigint>"))


def shares(word: np.ndarray, pair: np.ndarray, starts: int, total: int, distinct: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the context, and the pair's and the word's share against the even share 1 / (distinct + 1)."""
    before = np.concatenate([[starts], word[:-1]]).astype(np.float64)
    bucket = np.where(before > 0, np.floor(np.log2(np.maximum(before, 1))) + 1, 0).astype(np.int64)
    even = distinct + 1.0
    return np.minimum(bucket, BUCKETS - 1), pair / np.maximum(before, 1) * even, word / max(total, 1) * even


def learned(counts: DataFrame, starts: int, total: int, distinct: int) -> np.ndarray:
    """Weights (pair, word, even) for each bucket. The counts gathered have BUCKETS * (BINS + 1) ** 2 rows at most."""

    def level(x):
        return np.where(x > 0, np.clip(np.rint(np.log10(np.maximum(x, 1e-12)) * 10) + BINS // 4, 0, BINS - 1) + 1, 0).astype(np.int64)

    def run(batches):
        schema = pa.schema([("cell", pa.int64()), ("n", pa.int64())])
        for batch in batches:
            cells = []
            for word, pair in zip(batch.column("dev_word").to_pylist(), batch.column("dev_pair").to_pylist()):
                bucket, two, one = shares(np.array(word), np.array(pair), starts, total, distinct)
                cells.append((bucket * (BINS + 1) + level(two)) * (BINS + 1) + level(one))
            if cells:
                cell, n = np.unique(np.concatenate(cells), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], schema=schema)

    rows = counts.where("dev").select("dev_word", "dev_pair").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = (0, 0.5, 0.5)
    if not rows:
        return weights
    cell, n = np.array([r["cell"] for r in rows]), np.array([r["n"] for r in rows], np.float64)
    one, rest = cell % (BINS + 1), cell // (BINS + 1)
    two, bucket = rest % (BINS + 1), rest // (BINS + 1)

    def value(k):
        return np.where(k > 0, 10.0 ** ((k - 1 - BINS // 4) / 10), 0)

    p = np.stack([value(two), value(one), np.ones(len(cell))], 1)
    for _ in range(200):
        part = weights[bucket] * p
        part *= (n / part.sum(1))[:, None]
        sums = np.stack([np.bincount(bucket, part[:, k], BUCKETS) for k in range(3)], 1)
        # A bucket without held-out tokens keeps even weights; one pseudo-token for each keeps all weights above 0.
        sums[1:] += 1 / 3
        sums[0, 1:] += 0.5
        weights = sums / sums.sum(1, keepdims=True)
    return weights


def score(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document."""
    made = blocks(documents)
    size = made.agg(F.sum("tokens").alias("tokens"), F.sum("train_docs").alias("docs"), F.sum("dev_docs").alias("dev")).first()
    ranges = max(LEAST_RANGES, (size["tokens"] or 0) // RANGE_TOKENS)
    answers = saved(answered(asked(made, ranges)))
    sums = answers.where("kind = 0").agg(*(F.sum(c).alias(c) for c in ("total", "distinct", "dev_total", "dev_distinct"))).first()
    total, distinct, dev_total, dev_distinct = (sums[c] or 0 for c in ("total", "distinct", "dev_total", "dev_distinct"))
    counts = counted(made, answers)
    starts = size["docs"] or 0
    weights = learned(counts, starts - (size["dev"] or 0), total - dev_total, dev_distinct)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, held, word, pair in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "held_out", "word", "pair"))):
                word, pair = np.array(word, np.float64), np.array(pair, np.float64)
                base = float(np.log10((word + 1) / (total + distinct + 1)).sum())
                bucket, two, one = shares(word, pair, starts, total, distinct)
                w = weights[bucket]
                p = (w[:, 0] * two + w[:, 1] * one + w[:, 2]) / (distinct + 1.0)
                rows.append((doc_id, held, len(word), int((word > 0).sum()), total, base, float(np.log10(p).sum())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return counts.select("doc_id", "held_out", "word", "pair").mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
