"""Nearest-neighbour joins over a two-level index of cells.

Coarse centres, and below each of them its own finer ones, are learned by rounds of Spark aggregates; every row of the right
side belongs to one fine cell, whose radius is known. Cells are cut into blocks of bounded size by a hash. A query visits
the cells nearest first, a few more each round, and carries its k-th distance: a cell whose centre is farther away than that
and the cell's radius cannot matter (triangle inequality), and a query without such cells left is done. Stopping after a
number of cells is the approximate form.

What tasks hold of the index is one centre and radius per cell, of which there are at most MOST_CELLS; rows per cell grow
beyond ``rows`` only above MOST_CELLS * rows rows, and blocks stay bounded then too.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillframe.plans.seeded import order_key
from quillframe.session import scratch_path

SLACK = 1e-9
MOST_CELLS = 16_384
CELLS_AT_ONCE = 1 << 21  # distances taken at once
SLAB = 1 << 16  # numbers of a step that stay in the cache


def _distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Rows of ``a`` against rows of ``b``, in slabs that fit in cache-sized memory."""
    out = np.empty((len(a), len(b)))
    step = max(1, SLAB // max(1, b.size))
    for i in range(0, len(a), step):
        diff = a[i : i + step, None, :] - b[None, :, :]
        out[i : i + step] = np.abs(diff).sum(-1) if metric == "l1" else np.sqrt((diff * diff).sum(-1))
    return out


def _rough_l1(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, float] | None:
    """Whole numbers that differ from the l1 distances times a scale by less than one a dimension and one more; None where no scale serves."""
    if not (left.size and right.size):
        return None
    levels = np.iinfo(np.int16).max // left.shape[1] - 1
    with np.errstate(invalid="ignore", over="ignore", divide="ignore"):
        low = np.minimum(left.min(0), right.min(0))
        scale = levels / (np.maximum(left.max(0), right.max(0)) - low).max()
    if levels < 64 or not (np.isfinite(low).all() and np.isfinite(scale) and scale > 0):
        return None
    a, b = (np.ascontiguousarray(np.rint((x - low) * scale).astype(np.int16).T) for x in (left, right))
    out = np.zeros((len(left), len(right)), np.int16)
    wide = min(len(right), 2048)
    deep = max(1, SLAB // wide)
    part, total = np.empty((deep, wide), np.int16), np.empty((deep, wide), np.int16)
    for j in range(0, len(right), wide):
        for i in range(0, len(left), deep):
            rows, columns = min(deep, len(left) - i), min(wide, len(right) - j)
            one, all_ = part[:rows, :columns], total[:rows, :columns]
            all_[:] = 0
            for x, y in zip(a, b):
                np.subtract(x[i : i + rows, None], y[None, j : j + columns], out=one)
                np.abs(one, out=one)
                all_ += one
            out[i : i + rows, j : j + columns] = all_
    return out, scale


def _closest(left: np.ndarray, right: np.ndarray, barred: np.ndarray | None, k: int, metric: str, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, distance) of the k smallest finite distances of each row, by distance and column; l2 only up to ``limit``.

    Products bound the l2 distances to within their rounding, short whole numbers the l1 distances to within theirs; only those
    that may be among the k are then taken exactly.
    """
    rough = _rough_l1(left, right) if metric == "l1" else None
    if metric == "l1" and rough is None:
        d = _distances(left, right, metric)
        if barred is not None:
            d[barred] = np.inf
        column = np.argsort(d, axis=1, kind="stable")[:, :k]
        row = np.repeat(np.arange(len(d)), column.shape[1])
        column = column.ravel()
        d = d[row, column]
    else:
        if rough is not None:
            near, scale = rough
            off = left.shape[1] + 1
            if barred is not None:
                near[barred] = np.iinfo(near.dtype).max
            most = np.full(len(left), np.inf) if k >= near.shape[1] else (near.min(1) if k == 1 else np.partition(near, k - 1, axis=1)[:, k - 1]) + 2.0 * off
            most = np.minimum(most, limit * scale + off)
            maybe = near <= np.minimum(most, np.iinfo(near.dtype).max).astype(near.dtype)[:, None]  # whole numbers up to the bound
            if barred is not None:
                maybe &= ~barred
        else:
            with np.errstate(invalid="ignore", over="ignore"):
                size = (left * left).sum(1)[:, None] + (right * right).sum(1)
                near = size - 2 * (left @ right.T)
                size *= 4 * (left.shape[1] + 4) * np.finfo(float).eps
                if barred is not None:
                    near[barred] = np.inf
                high = near + size
                most = np.full(len(left), np.inf) if k >= high.shape[1] else np.partition(high, k - 1, axis=1)[:, k - 1] if k > 1 else np.nanmin(np.where(np.isnan(high), np.inf, high), axis=1)
                low = near - size
                # A sum that overflowed says nothing; the exact distance does.
                maybe = (low <= np.minimum(most, limit * limit)[:, None]) | ~np.isfinite(size)
                if barred is not None:
                    maybe &= ~barred
        row, column = np.nonzero(maybe)
        d = np.empty(len(row))
        step = max(1, CELLS_AT_ONCE // max(1, left.shape[1]))
        for i in range(0, len(row), step):
            diff = left[row[i : i + step]] - right[column[i : i + step]]
            d[i : i + step] = np.abs(diff).sum(-1) if metric == "l1" else np.sqrt((diff * diff).sum(-1))
        order = np.lexsort((column, d, row))
        row, column, d = row[order], column[order], d[order]
        at = np.arange(len(row)) - np.searchsorted(row, row)
        row, column, d = row[at < k], column[at < k], d[at < k]
    fine = np.isfinite(d)
    return row[fine], column[fine], d[fine]


def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype="float64") for v in col]) if len(col) else np.empty((0, 0))


def unit_vectors(df: DataFrame, vec: str) -> DataFrame:
    """Scale vectors to length one; a zero vector has no direction and is dropped."""
    v = F.transform(vec, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return df.withColumn("_norm", norm).filter("_norm > 0").withColumn(
        vec, F.transform(v, lambda x: x / F.col("_norm"))).drop("_norm")


class Cells:
    """Centres of both levels, the coarse centre of each fine one, and the radii: what tasks know of an index."""

    def __init__(self, metric: str, coarse: np.ndarray, fine: np.ndarray, parent: np.ndarray, radius: np.ndarray):
        self.metric, self.coarse, self.fine, self.parent, self.radius = metric, coarse, fine, parent, radius
        # The ball of a coarse centre holds those of its cells.
        self.coarse_radius = np.full(len(coarse), -np.inf)
        for c, (p, r) in enumerate(zip(parent, radius)):
            self.coarse_radius[p] = max(self.coarse_radius[p], _distances(fine[c][None, :], coarse[p][None, :], metric)[0, 0] + r)

    def within(self, vectors: np.ndarray, reach: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each vector, the cells that may hold rows at most ``reach`` away, nearest centre first, and the centres' distances.

        Cells below a coarse centre are looked at only if its own ball may be reached.
        """
        out = []
        far = _distances(vectors, self.coarse, self.metric)
        for v, limit, top in zip(vectors, reach, far):
            cells = np.flatnonzero((_lower(top, self.coarse_radius) <= limit)[self.parent])
            centre = _distances(v[None, :], self.fine[cells], self.metric)[0]
            near = _lower(centre, self.radius[cells]) <= limit
            cells, centre = cells[near], centre[near]
            order = np.lexsort((cells, centre))
            out.append((cells[order], centre[order]))
        return out

    def after(self, pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The cells each asking row has still to visit."""
        found = self.within(_matrix(pdf["v"]), pdf["reach"].to_numpy())
        for (cells, centre), d, c in zip(found, pdf["last_d"], pdf["last_cell"]):
            left = (centre > d) | ((centre == d) & (cells > c))
            yield cells[left], centre[left]


@dataclass
class Index:
    """The cells, their numbers of blocks, and the written rows (id, v, cell, block)."""

    table: DataFrame
    cells: Cells
    blocks: list[int]
    size: int


def _lower(centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Lower bounds of the distances to rows of balls, with slack for rounding; empty balls are out of reach."""
    with np.errstate(invalid="ignore"):
        low = centre - radius
        return np.where(np.isneginf(radius), np.inf, np.maximum(0.0, low - SLACK * (np.abs(centre) + np.abs(radius)) - 1e-12))


def _home(vectors: np.ndarray, coarse: np.ndarray, fine: np.ndarray, parent: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """The fine cell of each vector, below its nearest coarse centre, and the distance to it."""
    cell, d = np.zeros(len(vectors), np.int64), np.zeros(len(vectors))
    top = _distances(vectors, coarse, metric).argmin(1)
    for c in np.unique(top):
        rows, cells = np.flatnonzero(top == c), np.flatnonzero(parent == c)
        far = _distances(vectors[rows], fine[cells], metric)
        best = far.argmin(1)
        cell[rows], d[rows] = cells[best], far[np.arange(len(rows)), best]
    return cell, d


def _means(rows: DataFrame, home, dims: int) -> dict[int, np.ndarray]:
    """Mean of the rows of each cell: partial sums in the tasks, one row per cell and task shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            if len(pdf):
                m = _matrix(pdf["v"])
                cell = home(m)
                for c in np.unique(cell):
                    part = m[cell == c]
                    sums[int(c)] = sums.get(int(c), 0.0) + np.append(part.sum(0), len(part))
        if sums:
            yield pd.DataFrame({"cell": list(sums), "s": [list(v) for v in sums.values()]})

    partial = rows.mapInPandas(run, "cell bigint, s array<double>")
    added = partial.groupBy("cell").agg(F.array(*(F.sum(F.col("s")[i]) for i in range(dims + 1))).alias("s"))
    return {r.cell: np.array(r.s[:-1]) / r.s[-1] for r in added.collect()}  # one row per cell


def build_index(right: DataFrame, id_col: str, vec: str, metric: str = "l2", rows: int = 4096, rounds: int = 2) -> Index | None:
    """Learn the centres (first ones: rows in the order of a hash) and write the rows with their cell; None without rows."""
    spark = right.sparkSession
    data = right.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec).cast("array<double>").alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    size = data.count()
    if not size:
        return None
    cells = max(1, min(MOST_CELLS, math.ceil(size / rows)))
    top = math.ceil(math.sqrt(cells))
    seeds = np.array([r.v for r in data.orderBy(order_key(7, "id"), "id").limit(cells).select("v").collect()], dtype="float64")  # MOST_CELLS at most
    coarse = seeds[:top].copy()
    for _ in range(rounds if top > 1 else 0):  # one centre attracts all rows wherever it is
        for c, mean in _means(data, lambda m: _distances(m, coarse, metric).argmin(1), seeds.shape[1]).items():
            coarse[c] = mean
    parent = _distances(seeds, coarse, metric).argmin(1)
    lone = np.setdiff1d(np.arange(len(coarse)), parent)  # a coarse centre without a seed is its own only cell
    fine, parent = np.vstack([seeds, coarse[lone]]), np.concatenate([parent, lone])
    for _ in range(rounds if cells > top else 0):  # as many coarse centres as cells leave nothing finer to learn
        for c, mean in _means(data, lambda m: _home(m, coarse, fine, parent, metric)[0], seeds.shape[1]).items():
            fine[c] = mean

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                cell, d = _home(_matrix(pdf["v"]), coarse, fine, parent, metric)
                yield pdf.assign(cell=cell.astype("int32"), d=d)

    path = scratch_path(spark, "index")
    data.mapInPandas(settle, "id bigint, v array<double>, cell int, d double").write.parquet(path)
    placed = spark.read.parquet(path)
    radius, count = np.full(len(fine), -np.inf), np.zeros(len(fine))
    for r in placed.groupBy("cell").agg(F.max("d").alias("radius"), F.count("*").alias("n")).collect():  # one row per cell
        radius[r.cell], count[r.cell] = r.radius, r.n
    blocks = np.maximum(1, np.ceil(count / rows)).astype(int)
    table = placed.select("id", "v", "cell", F.pmod(F.xxhash64("id"), F.get(F.lit(blocks.tolist()), F.col("cell"))).cast("int").alias("block"))
    return Index(table, Cells(metric, coarse, fine, parent, radius), blocks.tolist(), size)


def search_index(index: Index, left: DataFrame, id_col: str, vec: str, k: int, exclude_self: bool = True, cells: int | None = None,
                 rows: int = 4096, within: float | None = None) -> DataFrame:
    """(id, neighbour, distance, rank, visited) of the k nearest for each row of ``left``, ``visited`` counting the cells asked.

    With ``cells`` the search of a row ends after so many cells and may miss neighbours. With ``within`` only rows at that
    distance or less are found, and cells farther away are never asked. Ties go to the smaller id.
    """
    spark, limit = left.sparkSession, float("inf") if within is None else within * (1 + SLACK)
    path = scratch_path(spark, "queries")
    left.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec).cast("array<double>").alias("v")).filter("id IS NOT NULL AND v IS NOT NULL").write.parquet(path)
    known = index.cells
    fields = "id bigint, v array<double>, visited int, reach double, last_d double, last_cell int"
    state = spark.read.parquet(path).select("id", "v", F.lit(0).alias("visited"), F.lit(limit).alias("reach"), F.lit(-1.0).alias("last_d"), F.lit(-1).alias("last_cell"))
    best, finished, step = None, [], 1

    def take(pdf: pd.DataFrame, step: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        for (cells_left, centre), seen in zip(known.after(pdf), pdf["visited"]):
            yield cells_left, centre, step if cells is None else max(0, min(step, cells - int(seen)))

    while True:
        def visit(batches: Iterator[pd.DataFrame], step=step) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    out = [(i, c) for i, (left_, _, n) in enumerate(take(pdf, step)) for c in left_[:n].tolist()]
                    yield pdf.iloc[[i for i, _ in out]][["id", "v"]].assign(cell=np.array([c for _, c in out], dtype="int32"))

        def advance(batches: Iterator[pd.DataFrame], step=step) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    took = [(left_[:n], centre[:n]) for left_, centre, n in take(pdf, step)]
                    yield pdf.assign(visited=pdf["visited"] + [len(c) for c, _ in took],
                                     last_d=[d[-1] if len(d) else old for (_, d), old in zip(took, pdf["last_d"])],
                                     last_cell=np.array([c[-1] if len(c) else old for (c, _), old in zip(took, pdf["last_cell"])], dtype="int32"))

        def still(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    yield pdf.assign(more=[bool(n) and len(left_) > 0 for left_, _, n in take(pdf, 1)])

        met = _met(state.mapInPandas(visit, "id bigint, v array<double>, cell int"), index, k, exclude_self, rows, limit)
        met = met if within is None else met.where(F.col("distance") <= limit)
        both = met if best is None else best.unionByName(met)
        order = Window.partitionBy("id").orderBy("distance", "neighbour")
        best_path, state_path = scratch_path(spark, "best"), scratch_path(spark, "state")
        both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank").write.parquet(best_path)
        best = spark.read.schema("id bigint, neighbour bigint, distance double").parquet(best_path)
        reached = best.groupBy("id").agg(F.count("*").alias("_n"), F.max("distance").alias("_d"))
        # A row with fewer than k neighbours so far reaches as far as the limit.
        reach = F.when(F.col("_n") >= k, F.col("_d")).otherwise(F.lit(limit))
        moved = state.mapInPandas(advance, fields).drop("reach").join(reached, "id", "left").select("id", "v", "visited", reach.alias("reach"), "last_d", "last_cell")
        moved.mapInPandas(still, f"{fields}, more boolean").write.parquet(state_path)
        every = spark.read.schema(f"{fields}, more boolean").parquet(state_path)
        finished.append(every.where("NOT more").select("id", "visited"))
        state = every.where("more").drop("more")
        if state.isEmpty():
            break
        step *= 4
    ended = functools.reduce(DataFrame.unionByName, finished)  # one frame a round; rounds grow as the logarithm of the cells
    rank = Window.partitionBy("id").orderBy("distance", "neighbour")
    return best.withColumn("rank", F.row_number().over(rank)).join(ended.dropDuplicates(["id"]), "id").select("id", "neighbour", "distance", "rank", "visited")


def _met(visits: DataFrame, index: Index, k: int, exclude_self: bool, rows: int, limit: float = math.inf) -> DataFrame:
    """The k nearest rows of each visited cell: groups of visitors of bounded size meet the blocks of the cell."""
    spark = visits.sparkSession
    path = scratch_path(spark, "visits")
    visits.write.parquet(path)
    visits = spark.read.schema("id bigint, v array<double>, cell int").parquet(path)
    counted = {r.cell: r.n for r in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # one row per cell
    groups = F.get(F.lit([math.ceil(counted.get(c, 0) / rows) or 1 for c in range(len(index.cells.fine))]), F.col("cell"))
    blocks = F.get(F.lit(index.blocks), F.col("cell"))
    askers = visits.select("id", "v", "cell", F.pmod(F.xxhash64("id"), groups).cast("int").alias("group"), F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)).alias("block"))
    wanted = F.get(F.lit([c in counted for c in range(len(index.cells.fine))]), F.col("cell"))
    held = index.table.where(wanted).select("id", "v", "cell", "block", F.explode(F.sequence(F.lit(0), groups.cast("int") - 1)).alias("group"))
    metric = index.cells.metric

    def best(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if x.empty or y.empty:
            return pd.DataFrame({"id": [], "neighbour": [], "distance": []}).astype({"id": "int64", "neighbour": "int64"})
        y = y.sort_values("id")
        left, right, ids, own = _matrix(x["v"]), _matrix(y["v"]), y["id"].to_numpy(), x["id"].to_numpy()
        step, parts = max(1, CELLS_AT_ONCE // len(ids)), []
        for i in range(0, len(own), step):
            barred = own[i : i + step, None] == ids[None, :] if exclude_self else None
            row, column, d = _closest(left[i : i + step], right, barred, k, metric, limit)
            parts.append(pd.DataFrame({"id": own[i + row], "neighbour": ids[column], "distance": d}))
        return pd.concat(parts)

    return askers.groupBy("cell", "group", "block").cogroup(held.groupBy("cell", "group", "block")).applyInPandas(best, "id bigint, neighbour bigint, distance double")


def nearest(left: DataFrame, right: DataFrame, id_col: str, vec: str, k: int, metric: str = "l2",
            exclude_self: bool = True, rows: int = 4096, cells: int | None = None) -> DataFrame:
    """(id, neighbour, distance, rank): the k nearest rows of ``right`` for each row of ``left``.

    Ties go to the smaller neighbour id. ``metric`` is ``l2`` or ``l1``. Exact unless ``cells`` ends the search after so many
    cells of about ``rows`` rows. Null ids and vectors take no part; ids are unique on each side.
    """
    index = build_index(right, id_col, vec, metric, rows)
    if index is None:
        return left.sparkSession.createDataFrame([], "id bigint, neighbour bigint, distance double, rank int")
    return search_index(index, left, id_col, vec, k, exclude_self, cells, rows).drop("visited")


def classify(neighbours: DataFrame, labels: DataFrame, id_col: str, label: str) -> DataFrame:
    """(id, label, votes, share): the most voted label of each row's neighbours, the smaller label on ties."""
    votes = (neighbours.join(labels.select(F.col(id_col).alias("neighbour"), F.col(label).alias("label")), "neighbour")
             .groupBy("id", "label").agg(F.count(F.lit(1)).alias("votes")))
    best = votes.groupBy("id").agg(
        F.max(F.struct("votes", (-F.col("label")).alias("neg"))).alias("m"), F.sum("votes").alias("total"))
    return best.select("id", (-F.col("m.neg")).alias("label"), F.col("m.votes").alias("votes"),
                       (F.col("m.votes") / F.col("total")).alias("share"))


def classify_each(neighbours: DataFrame, labels: DataFrame, id_col: str, label: str, ks: list[int]) -> DataFrame:
    """(id, k, label, votes, share) for every k of ``ks`` from one search for the largest of them, ties as in ``classify``."""
    named = neighbours.join(labels.select(F.col(id_col).alias("neighbour"), F.col(label).alias("label")), "neighbour")
    # A neighbour votes under every k from its rank on: counted once per rank, added up over the few ks.
    taking = F.filter(F.lit(sorted(set(ks))), lambda k: k >= F.col("rank"))
    votes = named.select("id", "label", F.explode(taking).alias("k")).groupBy("id", "k", "label").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("id", "k").agg(F.min(F.struct((-F.col("votes")).alias("neg"), "label")).alias("m"), F.sum("votes").alias("total"))
    return best.select("id", "k", F.col("m.label").alias("label"), (-F.col("m.neg")).alias("votes"), (-F.col("m.neg") / F.col("total")).alias("share"))
