"""Product codes of vectors: codebooks per part, learned by rounds of exact nearest-entry search.

A vector's components become whole numbers and are cut into equal parts; a part is replaced by the index of its nearest
codebook entry. The search is LAESA's: the distances of every part to a few fixed pivots (spread out over the first
codebook) are computed once and written beside the vectors. Each round computes only pivot-to-entry distances, whose
differences to those of a part are lower bounds; entries are evaluated in the order of their bounds, in whole numbers,
until the next bound is above the best distance. A bound is used with slack for rounding, so the answer is exact.

Scale: vectors stay where they are, in a written table that each round scans once. Codebooks and pivots (entries x
components numbers, nothing of the data's size) go out with the tasks. A task adds the parts of each entry up and gives
one row of sums per used entry, so what is shuffled is tasks x entries. Nothing is dealt by a data key but the label
totals, where one row a label and task takes part; the totals are written, so the join back may split a frequent label.

Rules: null vectors and those with null or non-finite components are dropped, and so are vectors whose length is not that
of the first kept row (smallest id, null ids last, then smallest vector) or is no multiple of the parts; fewer rows than
entries make a shorter codebook; repeated ids are rows of their own and may be entries twice (the lower index wins ties);
null ids are coded like others; null labels are added up together; numbers beyond longs are exact inside and given
as the largest long; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm.common import saved

SCALE, PARTS, ENTRIES, ROUNDS, PIVOTS = 1024, 4, 256, 4, 8
#: Pivot distances are kept as floats; their rounding, as a share.
ROUNDING = 1e-6
#: Sums travel in digits of so many bits, so that no sum of any number of tasks overflows.
DIGIT = 30
LAST = (1 << 63) - 1


def is_small(most: float, width: int) -> bool:
    """Whether squared distances of ``width`` whole numbers of at most this size fit longs."""
    return 8.0 * width * (most + 1.0) ** 2 < 2.0 ** 63


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): longs where squared distances fit them, Python's integers otherwise."""
    values = values.astype(np.float64)
    with np.errstate(over="ignore"):
        if not values.size or is_small(float(np.abs(values).max()) * scale, values.shape[1]):
            return np.floor(values * scale).astype(np.int64)
    out = np.empty(values.shape, object)
    out.ravel()[:] = [math.floor(x * scale) if abs(x) < 1e300 else int(x) * scale for x in values.ravel().tolist()]
    return out


def real(x: np.ndarray) -> np.ndarray:
    """As doubles; numbers beyond them are infinite."""
    if x.dtype != object:
        return x.astype(np.float64)
    return np.array([float(v) if v.bit_length() < 1000 else math.inf for v in x.ravel()], np.float64).reshape(x.shape)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows that stand opposite each other."""
    d = a - b
    return (d * d).sum(-1)


def lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances (rounded) between each row of ``a`` and each of ``b``."""
    return np.stack([np.sqrt(real(squares(a, row[None, :]))) for row in b], 1) if len(b) else np.zeros((len(a), 0))


def spread(entries: np.ndarray, count: int) -> np.ndarray:
    """Pivots: the first entry, then always the one farthest from those chosen."""
    chosen = [0]
    near = lengths(entries, entries[:1])[:, 0]
    while len(chosen) < min(count, len(entries)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, lengths(entries, entries[chosen[-1:]])[:, 0])
    return entries[chosen]


def nearest(x: np.ndarray, far: np.ndarray, entries: np.ndarray, far_entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of the nearest entry of each row, its squared distance, and the number of distances evaluated.

    ``far`` and ``far_entries`` hold the distances of rows and entries to the same pivots.
    """
    if x.dtype != entries.dtype:
        x, entries = x.astype(object), entries.astype(object)
    far, far_entries = far.astype(np.float64), far_entries.astype(np.float64)
    low = np.zeros((len(x), len(entries)))
    with np.errstate(invalid="ignore", over="ignore"):
        for p in range(far.shape[1]):
            a, b = far[:, p, None], far_entries[None, :, p]
            np.maximum(low, np.abs(a - b) - (a + b) * ROUNDING, out=low)
        low = np.nan_to_num(low * low * (1 - 1e-12), nan=0.0, posinf=0.0)
    order = np.argsort(low, 1, kind="stable")
    low = np.take_along_axis(low, order, 1)
    best = np.full(len(x), -1, object if x.dtype == object else np.int64)
    index = np.zeros(len(x), np.int64)
    live, at, step, seen = np.arange(len(x)), 0, 1, 0
    while len(live) and at < len(entries):
        some = order[live, at:at + step]
        d = squares(x[live][:, None, :], entries[some])
        seen += d.size
        least = d.min(1)
        entry = np.where(d == least[:, None], some, len(entries)).min(1)
        better = (best[live] < 0) | (least < best[live]) | ((least == best[live]) & (entry < index[live]))
        best[live[better]], index[live[better]] = least[better], entry[better]
        at += step
        step = min(2 * step, 32)
        if at < len(entries):
            live = live[low[live, at] <= real(best[live])]
    return index, best, seen


@dataclass
class Codebooks:
    """Entries of every part, the fixed pivots, and the distances between them."""

    scale: int
    entries: list[np.ndarray]
    pivots: list[np.ndarray]

    def __post_init__(self):
        self.far = [lengths(e, p) for e, p in zip(self.entries, self.pivots)]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(n)) for e in self.entries for n in e.ravel()).encode()).hexdigest()

    def assign(self, values: np.ndarray, far: np.ndarray):
        """Whole parts, indexes, squared distances and evaluations of a batch, part by part."""
        parts = np.split(whole(values, self.scale), len(self.entries), 1)
        fars = np.split(far, len(self.entries), 1)
        for x, f, e, fe in zip(parts, fars, self.entries, self.far):
            yield x, *nearest(x, f[:, :fe.shape[1]], e, fe)


def usable(vectors: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """_id, _label, v of the rows without null or non-finite components."""
    kind = "array<float>" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    v = vectors.select(F.col(id).cast("bigint").alias("_id"), F.col(label).alias("_label"), F.col(vector).cast(kind).alias("v"))
    return v.where("size(v) > 0").where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))


def matrix(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)


@dataclass
class Model:
    """Learned codebooks and the written rows they were learned from (_id, _label, v, far)."""

    rows: DataFrame
    books: Codebooks
    length: int

    def _width(self) -> int:
        return sum(len(p) for p in self.books.pivots)


def prepared(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE, parts: int = PARTS,
             entries: int = ENTRIES, pivots: int = PIVOTS) -> Model | None:
    """First codebooks, pivots, and the table with every part's pivot distances; None without a usable row."""
    rows = usable(vectors, id, vector, label).where(F.size("v") % parts == 0)
    order = [F.col("_id").asc_nulls_last(), F.col("v")]
    first = rows.orderBy(*order).limit(1).collect()  # one row
    if not first:
        return None
    length = len(first[0]["v"])
    rows = rows.where(F.size("v") == length)
    start = np.array([r["v"] for r in rows.orderBy(*order).limit(entries).collect()], np.float64)  # at most ``entries`` rows
    books = [b for b in np.split(whole(start, scale), parts, 1)]
    chosen = [spread(b, pivots) for b in books]
    width = max(len(c) for c in chosen)
    # Parts with fewer pivots repeat their first, so that all distances have one width.
    chosen = [np.concatenate([c, np.repeat(c[:1], width - len(c), 0)]) for c in chosen]

    def run(batches):
        for batch in batches:
            x = np.split(whole(matrix(batch, "v", length), scale), parts, 1)
            far = np.concatenate([lengths(a, c) if a.dtype == c.dtype else lengths(a.astype(object), c.astype(object)) for a, c in zip(x, chosen)], 1)
            offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * far.shape[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(far.ravel().astype(np.float32)))], names=["_id", "_label", "v", "far"])

    label_type, kind = (rows.schema[c].dataType.simpleString() for c in ("_label", "v"))
    table = saved(rows.mapInArrow(run, f"_id bigint, _label {label_type}, v {kind}, far array<float>"))
    return Model(table, Codebooks(scale, books, chosen), length)


def digits(number: int) -> list[int]:
    """A whole number in signed digits, lowest first."""
    sign, number, out = (-1 if number < 0 else 1), abs(number), []
    while number:
        out.append(sign * (number & ((1 << DIGIT) - 1)))
        number >>= DIGIT
    return out


def refined(model: Model) -> Codebooks:
    """The codebooks after one more round: each entry is the floored mean of its parts, unused ones stay."""
    books, length = model.books, model.length
    width, size = model._width(), length // len(books.entries)

    def run(batches):
        sums: dict[tuple[int, int], list] = {}
        for batch in batches:
            values, far = matrix(batch, "v", length), matrix(batch, "far", width)
            for part, (x, index, _, _) in enumerate(books.assign(values, far)):
                order = np.argsort(index, kind="stable")
                used, begin, count = np.unique(index[order], return_index=True, return_counts=True)
                if len(used):
                    for entry, total, n in zip(used.tolist(), np.add.reduceat(x[order], begin, 0).tolist(), count.tolist()):
                        held = sums.setdefault((part, entry), [0, [0] * size])
                        held[0] += n
                        held[1] = [a + b for a, b in zip(held[1], total)]
        rows = [(part, entry, place, n if place == 0 else 0, d) for (part, entry), (n, total) in sums.items()
                for place, d in _by_place([digits(t) for t in total])]
        columns = list(zip(*rows)) if rows else [[]] * 5
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["part", "entry", "place", "n", "sums"])

    partial = model.rows.mapInArrow(run, "part int, entry int, place int, n bigint, sums array<bigint>")
    added = partial.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(size))).alias("sums"))
    totals: dict[tuple[int, int], list] = {}
    for r in added.collect():  # entries x parts rows for each digit
        held = totals.setdefault((r["part"], r["entry"]), [0, [0] * size])
        held[0] += r["n"]
        held[1] = [a + (int(b) << (DIGIT * r["place"])) for a, b in zip(held[1], r["sums"])]
    out = []
    for part, entries in enumerate(books.entries):
        new = entries.astype(object)
        for entry in range(len(entries)):
            if (part, entry) in totals:
                n, total = totals[part, entry]
                new[entry] = [t // n for t in total]
        out.append(new.astype(np.int64) if is_small(float(np.abs(real(new)).max()), size) else new)
    return Codebooks(books.scale, out, books.pivots)


def _by_place(numbers: list[list[int]]):
    """The digits of some numbers place by place; at least one place."""
    for place in range(max(1, *(len(n) for n in numbers))):
        yield place, [n[place] if place < len(n) else 0 for n in numbers]


def learn(vectors: DataFrame, rounds: int = ROUNDS, **options) -> Model | None:
    """Codebooks after ``rounds`` rounds; see ``prepared`` for the options."""
    model = prepared(vectors, **options)
    for _ in range(rounds if model else 0):
        model.books = refined(model)
    return model


def encode(model: Model) -> DataFrame:
    """_id, _label, code (hex digits of the indexes in part order), error (decimal digits), evaluated: every kept row."""
    books, length, width = model.books, model.length, model._width()
    kind = model.rows.schema["_label"].dataType.simpleString()
    digits_of = max(2, len(f"{max(len(e) for e in books.entries) - 1:x}"))

    def run(batches):
        for batch in batches:
            code, error, evaluated = [""] * len(batch), [0] * len(batch), 0
            for _, index, far, seen in books.assign(matrix(batch, "v", length), matrix(batch, "far", width)):
                code = [c + f"{i:0{digits_of}x}" for c, i in zip(code, index.tolist())]
                error = [a + b for a, b in zip(error, far.tolist())]
                evaluated += seen
            share = np.full(len(batch), evaluated / max(1, len(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_label"), pa.array(code, pa.string()), pa.array([min(e, LAST) for e in error], pa.int64()), pa.array(share)],
                                             names=["_id", "_label", "code", "error", "evaluated"])

    return model.rows.mapInArrow(run, f"_id bigint, _label {kind}, code string, error bigint, evaluated double")


def digest(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    model = learn(vectors, **options)
    if model is None:
        return vectors.sparkSession.createDataFrame([], "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string")
    coded = saved(encode(model).drop("evaluated"))
    # A decimal sum cannot overflow; what passes the largest long is given as that.
    total = F.least(F.sum(F.col("error").cast("decimal(20,0)")), F.lit(LAST).cast("decimal(20,0)")).cast("bigint")
    totals = saved(coded.groupBy(F.col("_label").alias("_of")).agg(total.alias("label_error")))
    return (coded.join(totals, F.col("_label").eqNullSafe(F.col("_of")))
            .select(F.col("_id").alias("vec_id"), "code", "error", "label_error", F.lit(model.books.sha256()).alias("codebooks_sha256")))


def oracle(scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same rows in DuckDB SQL, for vectors of one length that the parts divide, with distinct ids."""
    book = f"""book0 AS MATERIALIZED (SELECT part, CAST(row_number() OVER (PARTITION BY part, place ORDER BY vec_id) - 1 AS INTEGER) AS entry, place, x FROM cells
        WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries}))"""
    steps = [book]
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (SELECT vec_id, part, min(d * {entries} + entry) AS best FROM (
            SELECT c.vec_id, c.part, b.entry, CAST(sum((c.x - b.x) * (c.x - b.x)) AS HUGEINT) AS d FROM cells c JOIN book{r} b USING (part, place) GROUP BY ALL) GROUP BY ALL)""")
        if r < rounds:
            steps.append(f"""book{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.place, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN (
                SELECT c.part, CAST(n.best % {entries} AS INTEGER) AS entry, c.place, CAST((sum(c.x) - ((sum(c.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
                FROM cells c JOIN near{r} n USING (vec_id, part) GROUP BY ALL) m ON b.part = m.part AND b.entry = m.entry AND b.place = m.place)""")
    return f"""
    WITH kept AS MATERIALIZED (SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    longs AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i, len(embedding) // {parts} AS size FROM kept),
    cells AS MATERIALIZED (SELECT vec_id, i // size AS part, i % size AS place, CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM longs),
    {", ".join(steps)},
    coded AS (SELECT vec_id, string_agg(printf('%02x', CAST(best % {entries} AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id),
    labelled AS (SELECT c.vec_id, c.code, c.error, k.label FROM coded c JOIN kept k USING (vec_id))
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
        (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256 FROM labelled
    """
