"""Exact top-k search by inner product with a table of pivot distances.

Vectors are packed into blocks that carry each vector's distances to the pivots. For a query, the largest difference of
pivot distances is a lower bound of the distance to a candidate and so gives an upper bound of the inner product;
candidates are evaluated in the order of that bound until no bound reaches the k-th score any more. Blocks of queries
meet blocks of candidates, each pair returns k rows a query at most, and the best of these are the answer.

Scores are whole numbers and exact whatever the components: bounds are used among plain vectors only, whose squares a double
holds exactly; others are compared with all, in longs or, where these do not reach, in Python's integers.

Rules: vectors that are null, empty, or hold null or non-finite components take no part; a score beyond a long is given
as the nearest long, its rank is that of the exact score; only vectors of one length are compared; rows of the query's own id are no candidates; ties go
to the smaller id; a repeated query row is asked once, repeated candidates are candidates each; fewer than k candidates
give fewer rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillframe.llm.common import saved

SCALE = 256.0
#: Bounds of whole numbers that doubles and longs hold.
DOUBLE, LONG = 2.0 ** 53, 2.0 ** 63
#: Vectors of a block, pivots of the table, candidates evaluated at once.
BLOCK, PIVOTS, STEP = 4096, 32, 256

PACKED = pa.schema([("length", pa.int32()), ("plain", pa.bool_()), ("ids", pa.binary()), ("values", pa.binary()), ("far", pa.binary())])
FOUND = pa.schema([("query_id", pa.int64()), ("query_hash", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("beyond", pa.binary())])


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (double array) of the rows that take part."""
    v = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    return v.where("vec_id is not null and size(v) > 0").where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))


def is_plain(x: np.ndarray) -> np.ndarray:
    """Whether sums of four squared vectors of this kind are exact in doubles."""
    with np.errstate(over="ignore"):
        return 4.0 * x.shape[1] * (SCALE * np.abs(x).max(1) + 1.0) ** 2 < DOUBLE


def whole(x: np.ndarray) -> np.ndarray:
    """Scaled components as Python integers."""
    out = np.empty(x.shape, object)
    out.ravel()[:] = [math.floor(SCALE * a) if abs(a) < 1e300 else int(a) * int(SCALE) for a in x.ravel().tolist()]
    return out


def as_long(score: int) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, score))


def beyond(score: int) -> bytes | None:
    """A key in the order of scores that are not below the ends of a long: two's complement with the sign turned."""
    return None if -(1 << 63) < score < (1 << 63) - 1 else (score + (1 << 2103)).to_bytes(264, "big")


def distances(values: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x, p = values.astype(np.float64), pivots.astype(np.float64)
    square = (x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * x @ p.T
    return np.sqrt(np.maximum(square, 0))


def packed_blocks(rows: DataFrame, pivots: dict[int, list[list[float]]]) -> DataFrame:
    """The vectors in blocks of one length, plain ones apart, as they come, so a repeated or frequent value is no hot group."""

    def run(batches):
        wait: dict[tuple[int, bool], list[tuple[np.ndarray, np.ndarray]]] = {}

        def block(length, plain):
            ids, values = (np.concatenate(c) for c in zip(*wait.pop((length, plain))))
            known = pivots.get(length) if plain else None
            far = distances(np.floor(SCALE * values), np.floor(SCALE * np.array(known))) if known else np.zeros((len(ids), 0))
            for i in range(0, len(ids), BLOCK):
                s = slice(i, i + BLOCK)
                yield pa.RecordBatch.from_arrays([pa.array([length], pa.int32()), pa.array([plain]), *(pa.array([a[s].tobytes()], pa.binary()) for a in (ids, values, far))], schema=PACKED)

        for batch in batches:
            sizes = np.array(pc.list_value_length(batch.column("v")))
            for length in np.unique(sizes).tolist():
                at = pa.array(np.flatnonzero(sizes == length))
                ids, x = batch.column("vec_id").take(at).to_numpy(), batch.column("v").take(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
                plain = is_plain(x)
                for kind, some in ((True, plain), (False, ~plain)):
                    if some.any():
                        wait.setdefault((length, kind), []).append((ids[some], x[some]))
                        if sum(len(w[0]) for w in wait[length, kind]) >= BLOCK:
                            yield from block(length, kind)
        for key in list(wait):
            yield from block(*key)

    return rows.mapInArrow(run, "length int, plain boolean, ids binary, values binary, far binary")


def best(q: np.ndarray, own: int, q_far: np.ndarray, ids: np.ndarray, values: np.ndarray, far: np.ndarray, norms: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """ids and scores of the k best of one block; without ``norms`` no bounds are used."""
    if norms is None:
        high = np.full(len(ids), np.inf)
    else:
        low = np.abs(far - q_far).max(1) if far.shape[1] else np.zeros(len(ids))
        # The slack covers rounding of the square roots; scores themselves are whole numbers.
        high = (norms + float(q @ q) - low * low * (1 - 1e-9)) / 2 + 1.0
    high[ids == own] = -np.inf
    order = np.argsort(-high, kind="stable")
    order = order[high[order] > -np.inf]
    kind = object if values.dtype == object else np.int64
    top_id, top = np.zeros(0, np.int64), np.zeros(0, kind)
    for i in range(0, len(order), STEP):
        if len(top) == k and high[order[i]] < top[-1]:
            break
        at = order[i:i + STEP]
        top_id, top = np.concatenate([top_id, ids[at]]), np.concatenate([top, (values[at] @ q).astype(kind)])
        keep = np.array(sorted(range(len(top)), key=lambda j: (-top[j], top_id[j]))[:k]) if kind is object else np.lexsort((top_id, np.invert(top)))[:k]
        top_id, top = top_id[keep], top[keep]
    return top_id, top


def search(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score for the queries, whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    # Pivots are a bounded choice: PIVOTS vectors of each length, the first in the order of a hash.
    pick = Window.partitionBy(F.size("v")).orderBy(F.xxhash64("vec_id"), "vec_id")
    pivots: dict[int, list[list[float]]] = {}
    size = F.size("v").cast("double")
    small = rows.where(4 * size * F.pow(SCALE * F.array_max(F.transform("v", F.abs)) + 1, F.lit(2.0)) < DOUBLE)
    for r in small.withColumn("n", F.row_number().over(pick)).where(F.col("n") <= PIVOTS).select("v").collect():
        pivots.setdefault(len(r["v"]), []).append(list(r["v"]))
    queries = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"])
    blocks = saved(packed_blocks(rows, pivots).withColumn("number", F.monotonically_increasing_id()))
    asks = saved(packed_blocks(queries, pivots))
    # Every query block goes to every part of the candidate blocks, so the queries are copied once a part: parts are no more than
    # blocks, a few for each task slot or of a few blocks each. The sizes that Spark assumes leave the copies out, so a join by
    # broadcast would gather them all at the driver.
    count = blocks.count()
    parts = max(1, min(count, 4 * spark.sparkContext.defaultParallelism), count // 8)
    left = blocks.withColumn("part", F.pmod(F.xxhash64("number"), F.lit(parts)))
    right = asks.select("length", F.col("plain").alias("q_plain"), F.col("ids").alias("q_ids"), F.col("values").alias("q_values"), F.col("far").alias("q_far"),
                        F.explode(F.expr(f"sequence(0L, {parts - 1}L)")).alias("part")).hint("merge")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n = row["length"]
                ids, q_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
                x, y = (np.frombuffer(row[c]).reshape(-1, n) for c in ("values", "q_values"))
                raw = y
                with np.errstate(over="ignore"):
                    wide = n * float(np.abs(np.floor(SCALE * x)).max()) * float(np.abs(np.floor(SCALE * y)).max())
                both = row["plain"] and row["q_plain"]
                top = max(float(np.abs(x).max()), float(np.abs(y).max())) * SCALE
                if wide < LONG and top < LONG:
                    kind = np.float64 if wide < DOUBLE else np.int64  # exact either way
                    x, y = (np.floor(SCALE * a).astype(kind) for a in (x, y))
                else:
                    x, y = whole(x), whole(y)
                far, q_far = (np.frombuffer(row[c]).reshape(len(a), -1) if both else np.zeros((len(a), 0)) for c, a in (("far", ids), ("q_far", q_ids)))
                norms = (np.floor(SCALE * np.frombuffer(row["values"]).reshape(-1, n)) ** 2).sum(1) if both else None
                out = []
                for i in range(len(q_ids)):
                    found, scores = best(y[i], int(q_ids[i]), q_far[i], ids, x, far, norms, k)
                    hashed = xxhash.xxh3_64_intdigest(raw[i].tobytes()) - (1 << 63)
                    out.extend((int(q_ids[i]), hashed, j, as_long(s), beyond(s)) for j, s in zip(found.tolist(), scores.tolist()))
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], f.type) for j, f in enumerate(FOUND)], schema=FOUND)

    found = (left.join(right, ["part", "length"]).select("length", "plain", "q_plain", "ids", "values", "far", "q_ids", "q_values", "q_far")
             .mapInArrow(run, "query_id bigint, query_hash bigint, vec_id bigint, score bigint, beyond binary"))
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), F.desc_nulls_last("beyond"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle(k: int = 5, every: int = 50) -> str:
    """The same rows in DuckDB SQL, for vectors of one length without odd components."""
    return f"""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % {every} = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {k}
    """
