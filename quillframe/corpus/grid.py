"""Pairs of words counted in a grid of word groups, as compact blocks instead of a row a pair.

A word belongs to a group by its hash and has a place there by its frequency; a pair of words belongs to the cell of its two
groups. Tasks count the pairs of a chunk of texts and give out one block a cell: sorted places and counts as compressed bytes, some
three bytes a pair. Groups and cells are as many as keep a cell's pairs bounded, so a task holds the words of two groups and the
pairs of one cell, whatever the size of the corpus.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.corpus.tokens import TOKENS_AT_ONCE, _coded, _places, token_array
from quillframe.session import scratch_path

#: Places of pairs that a cell takes, and characters a word, both about.
CELL, WORD = 1 << 22, 6


def pack(a: np.ndarray) -> bytes:
    """Whole numbers as bytes: their kind, how many, and their first, second, ... bytes together, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()
    return a.dtype.char.encode() + len(a).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(b: bytes) -> np.ndarray:
    kind, n = np.dtype(b[:1].decode()), int.from_bytes(b[1:9], "little")
    planes = pa.decompress(b[9:], decompressed_size=n * kind.itemsize, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()


def pack_words(words: pa.Array) -> bytes:
    sizes = pack(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int32))
    return len(sizes).to_bytes(8, "little") + sizes + pack(np.frombuffer(b"".join(words.cast(pa.binary()).to_pylist()), np.uint8))


def unpack_words(b: bytes) -> pa.Array:
    cut = 8 + int.from_bytes(b[:8], "little")
    ends = np.cumsum(unpack(b[8:cut]), dtype=np.int32)
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(np.append(np.int32(0), ends).astype(np.int32).tobytes()), pa.py_buffer(unpack(b[cut:]).tobytes()))


def pack_pairs(first: np.ndarray, second: np.ndarray, n: np.ndarray) -> bytes:
    """Pairs in order: steps of the first place, of the second where the first stays, and the counts."""
    step = np.diff(first, prepend=0)
    near = second - np.where(step == 0, np.append(0, second[:-1]), 0)
    parts = [pack(x.astype(np.int64 if len(x) and x.max() >= 1 << 31 else np.int32)) for x in (step, near, n)]
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def unpack_pairs(b: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts, at = [], 0
    for _ in range(3):
        size = int.from_bytes(b[at : at + 8], "little")
        parts.append(unpack(b[at + 8 : at + 8 + size]).astype(np.int64))
        at += 8 + size
    step, near, n = parts
    if not len(n):
        return step, near, n
    run = np.flatnonzero(np.append(True, step[1:] != 0))
    total = np.cumsum(near)
    second = total - np.repeat(total[run] - near[run], np.diff(np.append(run, len(near))))
    return np.cumsum(step), second, n


def cell_of(i, j, groups: int):
    """Number of the cell of two groups, i <= j."""
    return i * groups - i * (i - 1) // 2 + j - i


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of token arrays put together until they hold TOKENS_AT_ONCE tokens."""
    wait, size = [], 0
    for batch in batches:
        wait.append(batch)
        size += len(batch.column(0).flatten())
        if size >= TOKENS_AT_ONCE:
            yield pa.concat_batches(wait)
            wait, size = [], 0
    if wait:
        yield pa.concat_batches(wait)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _cell(i, j, groups: int):
    """``cell_of`` for columns."""
    return (i * groups - F.shiftright(i * (i - 1), 1) + j - i).cast("int")


class Grid:
    """Words and pair counts of a column of texts; pairs stand at most ``window`` places apart and each pair of places counts once.

    Words whose places next to other words are fewer than ``min_count`` are left out with their pairs.
    """

    def __init__(self, df: DataFrame, text: str, window: int, min_count: int):
        spark = df.sparkSession
        met = (df.agg(F.sum(F.length(text))).first()[0] or 0) // WORD * window
        cells = max(met / CELL, min(3 * spark.sparkContext.defaultParallelism, met / (CELL // 64)))
        self.window, self.groups = window, max(1, math.ceil(math.sqrt(2 * cells)))
        self.cells = [(i, j) for i in range(self.groups) for j in range(i, self.groups)]
        self.scratch = [scratch_path(spark, "chunks"), scratch_path(spark, "words")]
        path = self.scratch[0]
        df.select(token_array(F.col(text)).alias("_t")).mapInArrow(self._chunks(), "kind int, chunk bigint, part int, a binary, b binary").write.partitionBy("kind").parquet(path)
        chunks = spark.read.schema("chunk bigint, part int, a binary, b binary, kind int").parquet(path)
        self.heads = chunks.where("kind = 0").select("chunk", "a", "b")
        path = self.scratch[1]
        words = chunks.where("kind = 1").select("chunk", "part", "a", "b").repartitionById(self.groups, "part")
        words.mapInArrow(self._settle(min_count), "kind int, chunk bigint, part int, a binary, b binary, total bigint").write.partitionBy("kind").parquet(path)
        words = spark.read.schema("chunk bigint, part int, a binary, b binary, total bigint, kind int").parquet(path)
        self.places = words.where("kind = 0").select("chunk", "part", "a")
        #: One row a group: its words by falling frequency and their counts.
        self.vocabulary = words.where("kind = 1").select("part", "a", "b", "total")
        self.total = self.vocabulary.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]

    def _chunks(self):
        window, groups = self.window, self.groups

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task, number = TaskContext.get().partitionId(), 0
            for words, ids, doc, _ in _coded(_merged(batches)):
                at, size = _places(doc)
                near = np.minimum(at, window) + np.minimum(size - 1 - at, window)
                total = np.bincount(ids, near, len(words)).astype(np.int64)
                part = np.fromiter((zlib.crc32(w) % groups for w in words.cast(pa.binary()).to_pylist()), np.int64, len(words))
                order = np.argsort(part, kind="stable")  # words are numbered by group from here on
                place = np.empty(len(order), np.int32)
                place[order] = np.arange(len(order))
                chunk, ends = task << 32 | number, np.searchsorted(part[order], np.arange(groups + 1))
                rows = [(0, chunk, -1, pack(place[ids]), pack(np.bincount(doc).astype(np.int32)))]
                for g in range(groups):
                    if ends[g] < ends[g + 1]:
                        some = order[ends[g] : ends[g + 1]]
                        rows.append((1, chunk, g, pack_words(words.take(pa.array(some))), pack(total[some])))
                number += 1
                yield _batch(rows, ["kind", "chunk", "part", "a", "b"], [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()])

        return run

    def _settle(self, min_count: int):
        names, kinds = ["kind", "chunk", "part", "a", "b", "total"], [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = [r for batch in batches for r in batch.to_pylist()]  # one group
            if not rows:
                return
            words = [unpack_words(r["a"]) for r in rows]
            coded = pa.chunked_array([w.cast(pa.large_string()) for w in words]).combine_chunks().dictionary_encode()
            known, ids = coded.dictionary.cast(pa.string()), coded.indices.to_numpy()
            n = np.bincount(ids, np.concatenate([unpack(r["b"]) for r in rows]), len(known)).astype(np.int64)
            by_word = np.empty(len(known), np.int64)
            by_word[pc.array_sort_indices(known).to_numpy()] = np.arange(len(known))
            order = np.lexsort((by_word, -n))
            order = order[n[order] >= max(1, min_count)]
            place = np.full(len(known), -1, np.int32)
            place[order] = np.arange(len(order))
            part = rows[0]["part"]
            yield _batch([(1, -1, part, pack_words(known.take(pa.array(order))), pack(n[order]), int(n[order].sum()))], names, kinds)
            at = 0
            for r, w in zip(rows, words):
                yield _batch([(0, r["chunk"], part, pack(place[ids[at : at + len(w)]]), None, None)], names, kinds)
                at += len(w)

        return run

    def blocks(self) -> DataFrame:
        """(cell, part, a, b): the pairs of each chunk and cell, of which part is -1."""
        window, groups = self.window, self.groups

        def count(codes: np.ndarray, sizes: np.ndarray, parts: list[tuple[int, bytes]]) -> list[tuple]:
            places = [(g, unpack(a).astype(np.int64)) for g, a in sorted(parts)]
            place = np.concatenate([a for _, a in places])
            full = np.repeat([g for g, _ in places], [len(a) for _, a in places]) << 32 | np.maximum(place, 0)
            order = np.flatnonzero(place >= 0)
            order = order[np.argsort(full[order], kind="stable")]
            rank = np.full(len(place), -1)
            rank[order] = np.arange(len(order))
            full, ids, doc, wide = full[order], rank[codes], np.repeat(np.arange(len(sizes)), sizes), len(order)
            met = []
            for d in range(1, min(window, len(ids) - 1) + 1):
                a, b = ids[:-d], ids[d:]
                real = (doc[:-d] == doc[d:]) & (a >= 0) & (b >= 0)
                a, b = a[real], b[real]
                met.append(np.minimum(a, b) * wide + np.maximum(a, b))
            pair = np.concatenate(met) if met else np.empty(0, np.int64)
            if not len(pair):
                return []
            pair, n = np.unique(pair, return_counts=True)
            first, second = (full[x] for x in np.divmod(pair, wide))
            cell = cell_of(first >> 32, second >> 32, groups)
            by = np.argsort(cell, kind="stable")
            first, second, n, cell = first[by] & 0xFFFFFFFF, second[by] & 0xFFFFFFFF, n[by], cell[by]
            starts = np.flatnonzero(np.append(True, np.diff(cell) != 0))
            return [(int(cell[a]), -1, pack_pairs(first[a:b], second[a:b], n[a:b]), None) for a, b in zip(starts, np.append(starts[1:], len(cell)))]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    rows = count(unpack(r["a"]), unpack(r["b"]), [(p["part"], p["a"]) for p in r["parts"]])
                    yield _batch(rows, ["cell", "part", "a", "b"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()])

        parts = self.places.groupBy("chunk").agg(F.collect_list(F.struct("part", "a")).alias("parts"))
        return self.heads.join(parts, "chunk").mapInArrow(run, "cell int, part int, a binary, b binary")

    def mapped(self, use, schema: str) -> DataFrame:
        """Rows that ``use`` makes of each cell: its number, the words and counts of both groups, places of the words of its pairs, counts."""
        part, groups = F.col("part"), self.groups
        own = F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: _cell(F.least(part, g), F.greatest(part, g), groups))
        words = self.vocabulary.select(F.explode(own).alias("cell"), "part", "a", "b")
        cells = self.cells

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, keys, ns, waiting, cell = {}, [], [], 0, None
            for batch in batches:
                for r in batch.to_pylist():
                    cell = r["cell"]
                    if r["part"] >= 0:
                        known[r["part"]] = (r["a"], r["b"])
                        continue
                    first, second, n = unpack_pairs(r["a"])
                    keys.append(first << 32 | second)
                    ns.append(n)
                    waiting += len(n)
                    if waiting > CELL and len(keys) > 1:
                        key, n = _summed(keys, ns)
                        keys, ns, waiting = [key], [n], 0
            if keys:
                key, n = _summed(keys, ns)
                (i, j), one = cells[cell], {}
                for g in {i, j}:
                    one[g] = unpack_words(known[g][0]), unpack(known[g][1])
                yield from use(cell, one[i], one[j], key >> 32, key & 0xFFFFFFFF, n)

        return self.blocks().unionByName(words).repartitionById(len(self.cells), "cell").mapInArrow(run, schema)


def _summed(keys: list[np.ndarray], ns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(ns)
    order = np.argsort(key, kind="stable")  # runs in order already
    key, n = key[order], n[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[starts], np.add.reduceat(n, starts)
