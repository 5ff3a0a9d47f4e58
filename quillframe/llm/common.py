"""Words, fingerprints and Arrow plumbing shared by the operators of this package."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from quillframe.session import scratch_path

#: Words are runs of characters other than ASCII white space; ``bytes.split()`` splits at exactly these.
WORDS = r"[^\x20\x09-\x0D]+"
#: Rows and bytes of one Arrow batch, so that a task holds a bounded piece of text in Python.
BATCH_ROWS, BATCH_BYTES = "1000", "16m"


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of a bounded size from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of a folder, read by Spark alone."""
    bounded_batches(spark)
    return spark.read.parquet(f"{path.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: the lineage ends here and a lost executor costs nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, "rows")
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders that nothing reads any more, in whatever file system they are."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


def dropped(*frames: DataFrame | None) -> None:
    """Delete the tables of ``saved`` frames; every result that read them must be written by now."""
    for frame in frames:
        if frame is not None:
            remove(frame.sparkSession, frame.saved_at)


def by_rows(fn: Callable[..., tuple], schema: pa.Schema, *names: str):
    """An Arrow function that calls ``fn`` with the named values of each row; it gives one tuple per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [fn(*v) for v in zip(*(batch.column(n).to_pylist() for n in names))]
            columns = list(zip(*rows)) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


class Hashes(dict):
    """Word to 64-bit hash; forgets when it holds ``most`` words, so it never grows without bound."""

    most = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def scramble(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words, in time independent of ``k`` up to its logarithm."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = scramble(hashes, seed)
    parts, have, width, out = power, 0, 1, None
    bits = k
    while bits:
        if bits & 1:
            piece = parts[have:have + n]
            out = piece.copy() if out is None else scramble(out * np.uint64(0xD6E8FEB86659FD93), seed) + piece
            have += width
        bits >>= 1
        if bits:
            parts = scramble(parts[:-width] * np.uint64(0xA0761D6478BD642F), seed) + parts[width:]
            width *= 2
    return scramble(out, seed)


#: Bytes of a word that have a random number for each place and value; longer words are hashed by the library.
SHORT = 48
#: Two families of word hashes with nothing in common.
_TABLES = [np.random.default_rng(seed).integers(0, 1 << 64, SHORT * 256, np.uint64) for seed in (606, 1717)]
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_IS_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
FACTOR = 0xD1342543DE82EF95
INVERSE = pow(FACTOR, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(n: int, factor: int = FACTOR) -> np.ndarray:
    """The first ``n`` powers of an odd factor, kept for the next call."""
    if len(_powers.get(factor, ())) < n:
        base = np.full(max(n, 1 << 16), factor, np.uint64)
        base[0] = 1
        _powers[factor] = np.multiply.accumulate(base)
    return _powers[factor][:n]


def hashed(texts: list[str | None], lower: bool = False, family: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of some texts, one after the other, and the number of words up to each text's end.

    A word's hash is the sum of random numbers drawn for its bytes and their places (tabulation), so no arithmetic of
    places lets two words meet; words of more than SHORT bytes take the library's hash.
    """
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    blob = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    inside = ~_IS_SPACE[blob]
    step = np.diff(inside.view(np.int8), prepend=np.int8(0))
    start, stop = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    ends = np.searchsorted(start, np.cumsum([len(d) + 1 for d in data]))
    if not len(start):
        return np.zeros(0, np.uint64), ends
    size = stop - start
    first = np.cumsum(size) - size
    letters = _LOWER[blob] if lower else blob
    at = np.arange(int(size.sum())) - np.repeat(first, size)
    value = _TABLES[family][np.minimum(at, SHORT - 1) * 256 + letters[inside]]
    out = scramble(np.add.reduceat(value, first) + size.astype(np.uint64))
    for i in np.flatnonzero(size > SHORT).tolist():
        out[i] = xxhash.xxh3_64_intdigest(letters[start[i]:stop[i]].tobytes(), seed=family)
    return out, ends


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def packed_keys(key: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences, byte plane by byte plane, without the planes that are all zero."""
    step = np.diff(key, prepend=np.uint64(0)).astype("<u8")
    first, step[:1] = step[:1].tobytes(), 0
    planes = np.ascontiguousarray(step.view(np.uint8).reshape(len(step), 8).T)
    used = np.flatnonzero(planes.any(axis=1))
    return first + planes[:used[-1] + 1 if len(used) else 0].tobytes()


def unpacked_keys(data: bytes, n: int) -> np.ndarray:
    planes = np.zeros((8, n), np.uint8)
    have = np.frombuffer(data, np.uint8, offset=8).reshape(-1, n)
    planes[:len(have)] = have
    step = np.ascontiguousarray(planes.T).reshape(-1).view("<u8").copy()
    step[0] = np.frombuffer(data[:8], "<u8")[0]
    return np.cumsum(step, dtype=np.uint64)


def packed_counts(x: np.ndarray) -> bytes:
    """Counts in one byte each; those of 255 or more follow in full."""
    x = x.astype("<u8")
    return np.minimum(x, 255).astype(np.uint8).tobytes() + x[x >= 255].tobytes()


def unpacked_counts(data: bytes, n: int) -> np.ndarray:
    low = np.frombuffer(data, np.uint8, n).astype(np.int64)
    low[low == 255] = np.frombuffer(data, "<u8", offset=n).astype(np.int64)
    return low
