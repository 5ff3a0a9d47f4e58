"""Word vectors from co-occurrence counts, with nothing of the vocabulary's size on the driver.

The shifted positive PMI of words and their contexts is a sparse symmetric matrix; for vectors it is held as the counted pairs of
each cell of a grid of word groups. A randomised range finder takes its leading eigenvectors: in each round a task for every group
of words multiplies its rows of the matrix with a block of vectors, which it reads group by group; only the groups' Gram matrices, of
``size`` + ``SPARE`` rows and columns, reach the driver. Tables without words, or texts that are null or of one word, give no rows; a word without a context above the
shift has no vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.corpus.grid import Grid, pack_pairs, unpack, unpack_pairs, unpack_words
from quillframe.session import cleared, scratch_path

SPARE = 8


def shifted_pmi(df: DataFrame, doc: str, text: str, window: int = 10, min_count: int = 1, shift: float = 1.0) -> DataFrame:
    """(word, context, value): ln(n * total / (n_word * n_context)) - ln(shift) where it is above zero.

    ``n`` counts how often two words stand at most ``window`` places apart; words of fewer than ``min_count`` such
    places are left out with all their pairs.
    """
    grid = Grid(df, text, window, min_count)
    total, least = float(grid.total), float(shift) * (1 - 1e-9)

    def ratios(cell: int, one: tuple, other: tuple, first: np.ndarray, second: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        (words, sums), (contexts, their) = one, other
        within = grid_cells[cell][0] == grid_cells[cell][1]
        for i in range(0, len(n), 1 << 16):
            a, b, c = (x[i : i + (1 << 16)] for x in (first, second, n))
            alone = (a == b) if within else np.zeros(len(a), bool)
            # A word beside itself counts in both directions, as every other pair does.
            ratio = np.where(alone, 2 * c, c) * total / (sums[a].astype(float) * their[b])
            far = ratio > least
            a, b, ratio, alone = a[far], b[far], ratio[far], alone[far]
            yield pa.RecordBatch.from_arrays([words.take(pa.array(a)), contexts.take(pa.array(b)), pa.array(ratio)], names=["word", "context", "ratio"])
            a, b, ratio = a[~alone], b[~alone], ratio[~alone]
            yield pa.RecordBatch.from_arrays([contexts.take(pa.array(b)), words.take(pa.array(a)), pa.array(ratio)], names=["word", "context", "ratio"])

    grid_cells = grid.cells
    found = grid.mapped(ratios, "word string, context string, ratio double")
    value = F.ln("ratio") - F.ln(F.lit(float(shift)))
    return found.select("word", "context", value.alias("value")).filter("value > 0")


def kept(df: DataFrame, label: str) -> DataFrame:
    """A table in the shared folder: its size is known, so a small one is broadcast and a large one joined."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pairs_of(path: str, cell: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The written pairs of a cell, read where they are needed."""
    files, root = pa.fs.FileSystem.from_uri(path)
    return unpack_pairs(pq.read_table(f"{root}/cell={cell}", filesystem=files, columns=["pairs"], partitioning=None).column(0)[0].as_py())


def block_of(path: str, part: int, by: list[np.ndarray]) -> tuple[np.ndarray, dict]:
    """The written vectors of a group of words, times small matrices, and the row that holds them."""
    files, root = pa.fs.FileSystem.from_uri(path)
    row = pq.read_table(f"{root}/part={part}", filesystem=files, partitioning=None).to_pylist()[0]
    return turned(row, by), row


def turned(row: dict, by: list[np.ndarray]) -> np.ndarray:
    rows = np.frombuffer(row["vectors"]).reshape(-1, row["width"])
    for m in by:
        rows = rows @ m
    return rows


BLOCK = "part int, width int, words binary, counts binary, vectors binary, met binary, gram binary"


def block_row(part: int, words: bytes, counts: bytes, vectors: np.ndarray, met: np.ndarray, gram: np.ndarray) -> pa.RecordBatch:
    row = {"part": part, "width": vectors.shape[1], "words": words, "counts": counts, "vectors": vectors.tobytes(), "met": met.tobytes(), "gram": gram.tobytes()}
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)], names=list(row))


def gram_sum(df: DataFrame, width: int) -> np.ndarray:
    """The sum of small matrices, one a group of words."""
    return sum((np.frombuffer(r["gram"]).reshape(width, width) for r in df.select("gram").collect()), np.zeros((width, width)))


def started(grid: Grid, width: int, seed: int) -> str:
    """Vectors of random numbers for all words, a row a group, written by group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                # The numbers of ``plans.seeded.uniform``.
                drawn = [int(md5(f"{seed}-{w}-{i}".encode()).hexdigest()[:13], 16) / 2**52 - 0.5
                         for w in unpack_words(r["a"]).to_pylist() for i in range(1, width + 1)]
                yield block_row(r["part"], r["a"], r["b"], np.array(drawn).reshape(-1, width), np.empty(0), np.empty(0))

    path = scratch_path(grid.vocabulary.sparkSession, "block")
    grid.vocabulary.select("part", "a", "b").mapInArrow(run, BLOCK).write.partitionBy("part").parquet(path)
    return path


def products(spark: SparkSession, groups: list[int], cells: dict[tuple[int, int], int], matrix: str, block: str, by: list[np.ndarray],
             total: float, shift: float, width: int, beside: bool = False) -> str:
    """The matrix times a block of vectors, themselves times the matrices ``by``, written by group of words.

    A task makes the rows of one group: it reads the cells of the group and the vectors of one other group at a time, so nothing
    is dealt out. ``gram`` is that of the product; with ``beside`` the block itself is written, with the Gram matrix of block and product.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in (g for batch in batches for g in batch.column(0).to_pylist()):
            own, row = block_of(block, g, by)
            counts = unpack(row["counts"]).astype(float)
            out, met = np.zeros((len(counts), width)), np.zeros(len(counts), bool)
            for h in groups:
                if (cell := cells.get((min(g, h), max(g, h)))) is None:
                    continue
                first, second, n = pairs_of(matrix, cell)
                vectors, other = (own, row) if g == h else block_of(block, h, by)
                other = unpack(other["counts"]).astype(float)
                if g == h:
                    n = np.where(first == second, 2 * n, n)
                ways = [(first, second, n)] if g <= h else []
                if g >= h:
                    some = np.flatnonzero(first != second) if g == h else np.arange(len(n))
                    order = some[np.argsort(second[some], kind="stable")]
                    ways.append((second[order], first[order], n[order]))
                for rows, columns, m in ways:
                    for i in range(0, len(m), 1 << 16):
                        a, b, c = (x[i : i + (1 << 16)] for x in (rows, columns, m))
                        value = np.log(c * total / (counts[a] * other[b])) - np.log(shift)
                        starts = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
                        out[a[starts]] += np.add.reduceat(vectors[b] * value[:, None], starts)
                        met[a[starts]] = True
            yield block_row(g, row["words"], row["counts"], own if beside else out, met, (own if beside else out).T @ out)

    path = scratch_path(spark, "block")
    asked = spark.createDataFrame([*zip(groups, range(len(groups)))], "part int, at int").repartitionById(len(groups), "at").select("part")
    asked.mapInArrow(run, BLOCK).write.partitionBy("part").parquet(path)
    return path


def orthonormal(gram: np.ndarray) -> np.ndarray:
    """What turns a block of this Gram matrix into one with orthonormal columns; directions that the block lacks become zero."""
    values, vectors = np.linalg.eigh(gram)
    real = values > max(values.max(), 0) * 1e-13
    return vectors * np.where(real, 1 / np.sqrt(np.where(real, values, 1)), 0)


def pmi_vectors(df: DataFrame, doc: str, text: str, size: int = 300, window: int = 10, min_count: int = 1, shift: float = 1.0,
                rounds: int = 4, seed: int = 0) -> DataFrame:
    """(word, vector): the leading ``size`` eigenvectors of the shifted PMI, each scaled by the root of its eigenvalue's size.

    The inner products of two vectors approach their words' shifted PMI where eigenvalues are positive. A fixed
    ``seed`` starts from the same block; sums of doubles may differ in their last digits from run to run.
    """
    spark, width, grid = df.sparkSession, size + SPARE, Grid(df, text, window, min_count)
    total, shift, grid_cells = float(grid.total), float(shift), grid.cells

    def above(cell: int, one: tuple, other: tuple, first: np.ndarray, second: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        i, j = grid_cells[cell]
        twice = np.where(first == second, 2 * n, n) if i == j else n
        far = np.log(twice * total / (one[1][first].astype(float) * other[1][second])) - np.log(shift) > 0
        if far.any():
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in ((cell, pa.int32()), (i, pa.int32()), (j, pa.int32()), (pack_pairs(first[far], second[far], n[far]), pa.binary()))],
                                             names=["cell", "i", "j", "pairs"])

    matrix = scratch_path(spark, "matrix")
    grid.mapped(above, "cell int, i int, j int, pairs binary").write.partitionBy("cell").parquet(matrix)
    written = spark.read.schema("i int, j int, pairs binary, cell int").parquet(matrix)
    cells = {(r["i"], r["j"]): r["cell"] for r in written.select("i", "j", "cell").collect()}  # one row a cell
    if not cells:
        return spark.createDataFrame([], "word string, vector array<double>")
    groups = sorted({g for cell in cells for g in cell})
    block, by = started(grid, width, seed), []
    cleared(spark, *grid.scratch)  # matrix and block hold what is needed of it
    schema = f"{BLOCK.removeprefix('part int, ')}, part int"
    for _ in range(rounds):
        before, block = block, products(spark, groups, cells, matrix, block, by, total, shift, width)
        cleared(spark, before)
        made = spark.read.schema(schema).parquet(block)
        by = [orthonormal(gram_sum(made, width))]
        # Two orthonormalisations a round keep the small Gram matrix exact when the products lie far apart in size.
        by.append(orthonormal(gram_sum(again(made, by), width)))
    last = spark.read.schema(schema).parquet(products(spark, groups, cells, matrix, block, by, total, shift, width, beside=True))
    small = gram_sum(last, width)
    cleared(spark, block, matrix)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    first = np.argsort(-np.abs(values))[:size]
    return rows_of(last, vectors[:, first] * np.sqrt(np.abs(values[first])))


def again(block: DataFrame, by: list[np.ndarray]) -> DataFrame:
    """(gram): of each group's vectors times small matrices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows = turned(r, by)
                yield pa.RecordBatch.from_arrays([pa.array([(rows.T @ rows).tobytes()], pa.binary())], names=["gram"])

    return block.select("width", "vectors").mapInArrow(run, "gram binary")


def rows_of(block: DataFrame, by: np.ndarray) -> DataFrame:
    """(word, vector) of the words that have a value in the matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                met = np.flatnonzero(np.frombuffer(r["met"], bool))
                words, rows = unpack_words(r["words"]).take(pa.array(met)), turned(r, [by])[met]
                for i in range(0, len(words), 1 << 14):
                    some = rows[i : i + (1 << 14)]
                    ends = np.arange(len(some) + 1, dtype=np.int32) * some.shape[1]
                    yield pa.RecordBatch.from_arrays([words[i : i + (1 << 14)], pa.ListArray.from_arrays(pa.array(ends), pa.array(some.ravel()))], names=["word", "vector"])

    return block.select("width", "words", "vectors", "met").mapInArrow(run, "word string, vector array<double>")
