"""Tokens, vocabularies, encodings."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.functions.text import clean_sentence
from quillframe.plans.ordered import scan
from quillframe.session import partitions_of

UNKNOWN = "UNK"
PAD = "<PAD/>"
BROADCAST_WORDS = 50_000
TOKENS_AT_ONCE = 1 << 20  # words whose pairs a task counts together
# Punctuation a word filter removes, besides tab and newline.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def token_array(text: Column) -> Column:
    """Words of the cleaned text, which stand one blank apart."""
    return F.filter(F.split(clean_sentence(text), " "), lambda w: w != "")


def tokenize(df: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, pos, token), positions from 0."""
    return df.select(doc, F.posexplode(token_array(F.col(text))).alias("pos", "token"))


def vocabulary(tokens: DataFrame, size: int | None = None) -> DataFrame:
    """(token, id, n): words by falling frequency (ties by word) with ids from 1; id 0 is everything else.

    With ``size`` only the most frequent words get ids of their own and UNK carries the rest.
    """
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ranked = scan(counts.withColumn("_o", -F.col("n")), [], ["_o", "token"], {"id": ("row_number",)}).select("token", "id", "n")
    if size is None:
        return ranked
    rest = ranked.filter(F.col("id") > size).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    named = ranked.filter(F.col("id") <= size).unionByName(
        rest.select(F.lit(UNKNOWN).alias("token"), F.lit(0).cast("bigint").alias("id"), "n"))
    return named.hint("broadcast") if size <= BROADCAST_WORDS else named  # at most size + 1 rows


def encode(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Tokens with their id, 0 for unknown words."""
    known = vocab.filter("id > 0").select("token", "id")
    return tokens.join(known, "token", "left").withColumn("id", F.coalesce("id", F.lit(0)))


def decode(ids: DataFrame, vocab: DataFrame) -> DataFrame:
    return ids.join(vocab.select("id", F.col("token").alias("word")), "id", "left").withColumn("word", F.coalesce("word", F.lit(UNKNOWN)))


def char_ids(text: Column) -> Column:
    """a-z to 1..26, anything else to 0."""
    return F.transform(F.split(text, ""), lambda c: F.when(c.rlike("^[a-z]$"), F.ascii(c) - 96).otherwise(0))


def char_text(ids: Column) -> Column:
    """Back to text, 0 as a blank."""
    return F.array_join(F.transform(ids, lambda i: F.when(i > 0, F.char(i + 96)).otherwise(" ")), "")


def skip_grams(df: DataFrame, doc: str, text: str, window: int) -> DataFrame:
    """(doc, pos, center, context): every word with each word up to ``window`` places away.

    Neighbours are cut out of the document's own array, so no rows are joined and no group is built.
    """
    t = F.col("_t")
    around = F.transform(t, lambda w, i: F.struct(
        i.alias("pos"), w.alias("center"),
        F.slice(t, F.greatest(i + 1 - window, F.lit(1)), F.least(i, F.lit(window))).alias("before"),
        F.slice(t, i + 2, F.lit(window)).alias("after")))
    pairs = df.select(doc, token_array(F.col(text)).alias("_t")).select(doc, F.explode(around).alias("p"))
    return pairs.select(doc, F.col("p.pos").alias("pos"), F.col("p.center").alias("center"),
                        F.explode(F.concat("p.before", "p.after")).alias("context"))


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """The sorted words of some token arrays, the numbers of their tokens, the row of each token, the rows; TOKENS_AT_ONCE or one row at a time."""
    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column(0)))
        lists = batch.column(0)
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(lists):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + TOKENS_AT_ONCE, "right")))
            part = lists.slice(start, stop - start)
            coded = part.flatten().dictionary_encode()
            order = pc.array_sort_indices(coded.dictionary).to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            sizes = pc.list_value_length(part).to_numpy(zero_copy_only=False)
            yield (coded.dictionary.take(pa.array(order)), place[coded.indices.to_numpy()], np.repeat(np.arange(len(sizes)), sizes),
                   batch.slice(start, stop - start))
            start = stop


def _places(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each token in its row, and how many tokens the row has."""
    size = np.bincount(doc)
    return np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size), size[doc]


def _counted(words_: pa.Array, met: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows (word, word, n) of pairs of word numbers, each held as one number."""
    pair, n = np.unique(np.concatenate(met), return_counts=True) if met else (np.empty(0, np.int64),) * 2
    for i in range(0, len(pair), 1 << 16):
        first, second = (words_.take(pa.array(x)) for x in np.divmod(pair[i : i + (1 << 16)], len(words_)))
        yield pa.RecordBatch.from_arrays([first, second, pa.array(n[i : i + (1 << 16)], pa.int64())], names=names)


def pair_counts(df: DataFrame, text: str, window: int) -> DataFrame:
    """(first, second, n): how often two words, ``first`` <= ``second``, stand at most ``window`` places apart in a text.

    Each pair of places counts once. Tasks count the pairs of some texts before they give them out, so frequent pairs cost one
    row for many.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words_, ids, doc, _ in _coded(batches):
            met = [np.minimum(ids[:-d], ids[d:])[same] * len(words_) + np.maximum(ids[:-d], ids[d:])[same]
                   for d in range(1, min(window, len(ids) - 1) + 1) for same in [doc[:-d] == doc[d:]]]
            yield from _counted(words_, met, ["first", "second", "n"])

    rows = df.select(token_array(F.col(text)).alias("_t")).mapInArrow(counted, "first string, second string, n bigint")
    return rows.groupBy("first", "second").agg(F.sum("n").alias("n"))


def both_ways(pairs: DataFrame, value: str, center: str = "center", context: str = "context") -> DataFrame:
    """(center, context, value) of (first, second, value): a pair of two words stands for both of its directions."""
    there, back = F.struct(F.col("first").alias("a"), F.col("second").alias("b")), F.struct(F.col("second").alias("a"), F.col("first").alias("b"))
    ways = F.when(F.col("first") == F.col("second"), F.array(there)).otherwise(F.array(there, back))
    return pairs.select(F.explode(ways).alias("p"), value).select(F.col("p.a").alias(center), F.col("p.b").alias(context), value)


def directed(pairs: DataFrame) -> DataFrame:
    """``pair_counts`` with a word beside itself counted in both directions, as every other pair is."""
    return pairs.withColumn("n", F.when(F.col("first") == F.col("second"), 2 * F.col("n")).otherwise(F.col("n")))


def places(df: DataFrame, text: str, window: int) -> DataFrame:
    """(word, n_word): how many places stand at most ``window`` from those of a word, the sum of its pairs without counting them."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words_, ids, doc, _ in _coded(batches):
            at, size = _places(doc)
            near = np.minimum(at, window) + np.minimum(size - 1 - at, window)
            total = np.bincount(ids, near, len(words_)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([words_, pa.array(total)], names=["word", "n_word"])

    rows = df.select(token_array(F.col(text)).alias("_t")).mapInArrow(counted, "word string, n_word bigint")
    return rows.groupBy("word").agg(F.sum("n_word").alias("n_word")).where("n_word > 0")


# Fixed values of MD5: the constants of its 64 steps, their rotations and the order in which they take the words of a block.
MD5_ADD = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
MD5_TURN = [turn for turns in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for turn in turns * 4]
MD5_WORD = [(a * i + b) % 16 for a, b in ((1, 0), (5, 1), (3, 5), (7, 0)) for i in range(16)]
MD5_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
MD5_MIX = (lambda b, c, d, out: np.bitwise_xor(np.bitwise_and(np.bitwise_xor(c, d, out=out), b, out=out), d, out=out),
           lambda b, c, d, out: np.bitwise_xor(np.bitwise_and(np.bitwise_xor(b, c, out=out), d, out=out), c, out=out),
           lambda b, c, d, out: np.bitwise_xor(np.bitwise_xor(b, c, out=out), d, out=out),
           lambda b, c, d, out: np.bitwise_xor(np.bitwise_or(np.bitwise_not(d, out=out), b, out=out), c, out=out))
MD5_AT_ONCE = 1 << 14  # messages hashed together, so that a step stays in the cache


def md5_keys(block: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The MD5 of messages, rows of bytes with zeros behind them, as two numbers that sort like the digest."""
    n, wide = block.shape
    high, low = np.empty(n, np.uint64), np.empty(n, np.uint64)
    if n and length.max() > 55:  # more than one block of MD5
        for i, m in enumerate(block):
            digest = hashlib.md5(m[: length[i]].tobytes()).digest()
            high[i], low[i] = int.from_bytes(digest[:8], "big"), int.from_bytes(digest[8:], "big")
        return high, low
    used = wide // 4 + 1
    for at in range(0, n, MD5_AT_ONCE):
        size = length[at : at + MD5_AT_ONCE]
        padded = np.zeros((len(size), used * 4), np.uint8)
        padded[:, :wide] = block[at : at + MD5_AT_ONCE]
        padded[np.arange(len(size)), size] = 0x80
        word = dict(enumerate(np.ascontiguousarray(padded.view("<u4").T).astype(np.uint32, copy=False)))
        word[14] = 8 * size.astype(np.uint32)  # words that are not named are zero in all messages
        a, b, c, d = (np.full(len(size), x, np.uint32) for x in MD5_START)
        mixed, turned = np.empty_like(a), np.empty_like(a)
        for i in range(64):
            mixed = MD5_MIX[i // 16](b, c, d, mixed)
            mixed += a
            mixed += MD5_ADD[i]
            if MD5_WORD[i] in word:
                mixed += word[MD5_WORD[i]]
            np.left_shift(mixed, MD5_TURN[i], out=turned)
            mixed >>= 32 - MD5_TURN[i]
            turned |= mixed
            turned += b
            a, b, c, d, turned = d, turned, b, c, a
        a, b, c, d = ((x + np.uint32(s)).byteswap().astype(np.uint64) for x, s in zip((a, b, c, d), MD5_START))
        high[at : at + len(size)], low[at : at + len(size)] = a << np.uint64(32) | b, c << np.uint64(32) | d
    return high, low


def _place_keys(named: list[str | None], doc: np.ndarray, i: np.ndarray, j: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``md5_keys`` of 'seed-document-i-j' for rows of a document number and two places; a null document is left out of the text."""
    heads = [(f"{seed}-" if d is None else f"{seed}-{d}-").encode() for d in named]
    longest = max(map(len, heads))
    head = np.frombuffer(b"".join(h.ljust(longest) for h in heads), np.uint8).reshape(len(heads), longest)
    most = int(max(i.max(), j.max()))
    wide = len(str(most))
    digits = (np.arange(most + 1)[:, None] // 10 ** np.arange(wide - 1, -1, -1) % 10 + ord("0")).astype(np.uint8)
    size = np.digitize(np.arange(most + 1), 10 ** np.arange(1, wide)) + 1 if wide > 1 else np.ones(most + 1, np.int64)
    # Messages of one layout are put together by slices.
    layout = (np.array([len(h) for h in heads])[doc] * 64 + size[i]) * 64 + size[j]
    order = np.argsort(layout, kind="stable")
    block, length = np.zeros((len(i), longest + 2 * wide + 1), np.uint8), np.empty(len(i), np.int64)
    for rows in np.split(order, np.flatnonzero(np.diff(layout[order])) + 1):
        front, li, lj = len(heads[doc[rows[0]]]), int(size[i[rows[0]]]), int(size[j[rows[0]]])
        text = np.empty((len(rows), front + li + 1 + lj), np.uint8)
        text[:, :front] = head[doc[rows], :front]
        text[:, front : front + li] = digits[i[rows], wide - li :]
        text[:, front + li] = ord("-")
        text[:, front + li + 1 :] = digits[j[rows], wide - lj :]
        block[rows, : text.shape[1]], length[rows] = text, text.shape[1]
    return md5_keys(block, length)


def _drawn(batches: Iterator[pa.RecordBatch], window: int, num_skips: int, seed: int,
           at_once: int = 1 << 14) -> Iterator[tuple]:
    """Of some rows (token array, id as text, ...): words, numbers and places of their tokens, chunks of (row, centre, context), the rows.

    Centres and contexts are numbers of tokens, counted from 0 through all these rows.
    """
    steps = np.array([d for d in range(-window, window + 1) if d])
    for words_, ids, doc, rows in _coded(batches):
        at, size = _places(doc)
        named = rows.column(1).to_pylist()

        def chunks() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for a in range(0, len(ids), at_once):
                centre = np.arange(a, min(a + at_once, len(ids)))
                place = at[centre, None] + steps
                real = (place >= 0) & (place < size[centre, None])
                if not real.any():
                    continue
                keys = np.full((2, *real.shape), 2**64 - 1, np.uint64)
                row = np.nonzero(real)[0]
                keys[0][real], keys[1][real] = _place_keys(named, doc[centre][row], at[centre][row], place[real], seed)
                first = np.lexsort((keys[1], keys[0]))[:, :num_skips]
                taken = np.take_along_axis(real, first, 1)
                context = (centre[:, None] + steps[first])[taken]
                yield doc[centre][np.nonzero(taken)[0]], centre[np.nonzero(taken)[0]], context

        yield words_, ids, at, chunks(), rows


def sampled_skip_grams(df: DataFrame, doc: str, text: str, window: int, num_skips: int, seed: int) -> DataFrame:
    """(doc, pos, center, context_pos, context): ``num_skips`` contexts of every word, drawn without repetition from its window.

    The draw takes the places with the smallest hashes of (seed, document, place, place of the context), so it is the same
    in every run; a window cut off by the end of the text gives what it has. Documents need an id of their own.
    """
    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words_, ids, at, chunks, rows in _drawn(batches, window, num_skips, seed):
            for row, centre, context in chunks:
                for i in range(0, len(row), 1 << 16):
                    r, a, b = (x[i : i + (1 << 16)] for x in (row, centre, context))
                    yield pa.RecordBatch.from_arrays([rows.column(2).take(pa.array(r)), pa.array(at[a], pa.int32()), words_.take(pa.array(ids[a])),
                                                      pa.array(at[b], pa.int32()), words_.take(pa.array(ids[b]))], names=out.names)

    out = df.select(doc, F.lit(0).alias("pos"), F.lit("").alias("center"), F.lit(0).alias("context_pos"), F.lit("").alias("context")).schema
    return _named(df, doc, text).mapInArrow(drawn, out)


def sampled_pair_counts(df: DataFrame, doc: str, text: str, window: int, num_skips: int, seed: int) -> DataFrame:
    """(center, context, n): the pairs of ``sampled_skip_grams``, counted in the tasks before they are given out."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words_, ids, _, chunks, _ in _drawn(batches, window, num_skips, seed):
            yield from _counted(words_, [ids[a] * len(words_) + ids[b] for _, a, b in chunks], ["center", "context", "n"])

    rows = _named(df, doc, text).mapInArrow(counted, "center string, context string, n bigint")
    return rows.groupBy("center", "context").agg(F.sum("n").alias("n"))


def _named(df: DataFrame, doc: str, text: str) -> DataFrame:
    return df.select(token_array(F.col(text)).alias("_t"), F.col(doc).cast("string").alias("_d"), doc)


def pad_to_longest(df: DataFrame, tokens: str, pad: str = PAD) -> DataFrame:
    """Arrays filled up at the end to the length of the longest."""
    longest = df.agg(F.max(F.size(tokens))).scalar()
    missing = F.greatest(longest - F.size(tokens), F.lit(0))
    return df.withColumn(tokens, F.concat(tokens, F.array_repeat(F.lit(pad), missing)))


def padded_text(df: DataFrame, tokens: str, out: str, pad: str = PAD) -> DataFrame:
    """The arrays of ``pad_to_longest`` joined by blanks, without an array of that length for every row."""
    longest = df.agg(F.max(F.size(tokens))).scalar()
    missing = F.greatest(longest - F.size(tokens), F.lit(0))
    tail = F.when(F.size(tokens) > 0, F.repeat(F.lit(f" {pad}"), missing)).otherwise(F.substring(F.repeat(F.lit(f" {pad}"), missing), 2, 2**31 - 1))
    return df.withColumn(out, F.concat(F.array_join(tokens, " "), tail))


def pad_front(ids: Column, length: int) -> Column:
    """Exactly ``length`` numbers: the tail of a longer array, zeros in front of a shorter one."""
    n = F.size(ids)
    tail = F.slice(ids, F.greatest(n - length + 1, F.lit(1)), length)
    return F.concat(F.array_repeat(F.lit(0).cast("bigint"), F.greatest(F.lit(length) - n, F.lit(0))), tail)


def char_windows(df: DataFrame, doc: str, text: str, length: int = 20, step: int = 1) -> DataFrame:
    """(doc, start, window, next): overlapping character windows and the character that follows each.

    The text is split into characters once; cutting windows from the string itself would walk it from
    the start every time.
    """
    c = F.col("_c")
    windows = F.transform(F.sequence(F.lit(0), F.size(c) - length - 1, F.lit(step)), lambda i: F.struct(
        i.alias("start"), F.array_join(F.slice(c, i + 1, length), "").alias("window"), F.get(c, i + length).alias("next")))
    split = df.select(doc, F.split(text, "").alias("_c")).filter(F.size("_c") > length)
    return split.select(doc, F.explode(windows).alias("w")).select(doc, "w.start", "w.window", "w.next")


def _pieces(text: str, length: int, most: int) -> Iterator[tuple[int, str]]:
    """(bucket key, piece): the runs of neighbouring windows of ``length`` characters whose smallest 12-gram by hash is the same.

    Equal windows have the same smallest 12-gram, so they get the same key whatever stands around them. A run is cut after
    ``most`` windows.
    """
    grams = min(12, length)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    h = np.zeros(len(code) - grams + 1, np.uint64)
    for i in range(grams):
        h = h * np.uint64(0x100000001B3) + code[i : len(code) - grams + 1 + i]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    least = np.minimum.reduce([h[i : len(h) - (length - grams) + i] for i in range(length - grams + 1)])  # one per window
    starts = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    ends = np.append(starts[1:], len(least))
    for a, b in zip(starts.tolist(), ends.tolist()):
        key = int(least[a]) >> 33
        for i in range(a, b, most):
            yield key, text[i : min(i + most, b) + length - 1]


def window_counts(df: DataFrame, text: str, length: int = 20, chars: int = 1 << 21) -> DataFrame:
    """(next, n, distinct_windows): per character, how often and after how many different windows of ``length`` characters it comes.

    The rows of ``char_windows`` at step 1 are counted exactly without being shuffled: texts are cut into runs of windows that
    share their smallest 12-gram, a task puts equal runs together, and the runs meet by that 12-gram in as many buckets as keep
    about ``chars`` windows each.
    """
    whole = length + 1  # a window and the character that follows it

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for x in batch.column(0).to_pylist():
                if x is not None and len(x) >= whole:
                    found.update(_pieces(x, whole, 64))
                if len(found) >= 1 << 17:
                    yield counts(found)
                    found = Counter()
            if found:
                yield counts(found)

    def counts(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([p for _, p in found], pa.string()),
                                           pa.array(found.values(), pa.int64())], names=["key", "piece", "n"])

    buckets = max(partitions_of(df.sparkSession), -(-df.agg(F.coalesce(F.sum(F.length(text)), F.lit(0))).first()[0] // chars))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for batch in batches:
            for piece, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for i in range(len(piece) - length):
                    w = piece[i : i + whole]
                    seen[w] = seen.get(w, 0) + n
        total, distinct = Counter(), Counter()
        for w, n in seen.items():
            total[w[-1]] += n
            distinct[w[-1]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.string()), pa.array(total.values(), pa.int64()), pa.array(distinct.values(), pa.int64())],
                                         names=["next", "n", "distinct_windows"])

    # A task is one bucket.
    runs = df.select(text).mapInArrow(cut, "key int, piece string, n bigint")
    met = runs.repartition(buckets, "key").select("piece", "n").mapInArrow(tally, "next string, n bigint, distinct_windows bigint")
    return met.groupBy("next").agg(F.sum("n").alias("n"), F.sum("distinct_windows").alias("distinct_windows"))


def hashed_index(text: Column, n: int) -> Column:
    """Index 1..n-1 of every word by a stable hash, punctuation removed, lower case."""
    blank = F.translate(F.lower(text), PUNCTUATION + "\t\n", " " * (len(PUNCTUATION) + 2))
    ws = F.filter(F.split(blank, " "), lambda w: w != "")
    return F.transform(ws, lambda w: F.conv(F.substring(F.md5(w), 1, 13), 16, 10).cast("bigint") % (n - 1) + 1)
