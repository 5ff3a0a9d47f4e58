"""Near duplicates among embeddings by NN-descent.

Equal vectors of a label are one node from the start. The first neighbour lists come from slabs of a few rows that lie
together in the order of random hyperplane codes; then rounds of local joins follow: the neighbours of a node, in both
directions, are compared with each other, and each node keeps its nearest. Links are the edges that reach the
threshold. A node whose whole list reaches it is saturated and may have links beyond its list, also to nodes that no list
connects it with. So all members of components with a saturated node are compared with all others of their kind, block by
block: only counts and one link for each pair of components leave the tasks, and blocks whose members are surely too far
apart never meet. An edge that a list has no room for always has a saturated end, so nothing that was seen is lost.
Kinds of at most SMALL nodes are compared in full instead, each in one block. A brute-force audit of a fixed number of
nodes measures the recall; further rounds follow while it is below the aim. A second audit takes the final counts, without
a cap; when they miss the aim, all nodes are compared with all others of their kind, block by block, which finds every link.

Rules: null labels, null, empty or zero vectors and those with null or non-finite components link with nothing and are
components of their own; only vectors of one length are compared; repeated rows and equal vectors link with each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillframe.llm.common import saved
from quillframe.llm.components import components

THRESHOLD = 0.98
#: Length of a neighbour list, rows of a slab, orders by hyperplane codes, bits of a code.
NEIGHBOURS, SLAB, ORDERS, BITS = 12, 64, 6, 24
#: Nodes of a kind that are compared in full at once.
SMALL = 2 * SLAB
#: Rounds of local joins at least and at most, nodes of the audit, and the recall that ends the rounds.
ROUNDS, MOST_ROUNDS, AUDIT, AIM = 2, 6, 200, 0.97
#: Members of saturated components compared at once.
BLOCK = 512
#: Angles of balls are rounded up by this much, far above the errors of rounding.
SLACK = 1e-6

EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("s", pa.float64())])
EDGE_SQL = "u bigint, v bigint, s double"


def matrix(column: list[bytes]) -> np.ndarray:
    """Rows of unit length from packed doubles."""
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def unit(vectors: DataFrame) -> DataFrame:
    """vec_id, kind (label and length), node, x (packed unit vector) of the rows that can link."""
    v = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    v = v.where("label is not null and size(v) > 0").where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    v = v.where(F.exists("v", lambda x: x != 0)).select("vec_id", F.concat_ws(":", F.size("v").cast("string"), "label").alias("kind"), "v")

    def run(batches):
        schema = pa.schema([("vec_id", pa.int64()), ("kind", pa.string()), ("x", pa.binary())])
        for batch in batches:
            out = []
            for a in batch.column("v"):
                a = a.values.to_numpy()
                a = a / np.abs(a).max()
                out.append((a / np.sqrt((a * a).sum())).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("kind"), pa.array(out, pa.binary())], schema=schema)

    return v.mapInArrow(run, "vec_id bigint, kind string, x binary").withColumn("node", F.xxhash64("kind", "x"))


def nearest(edges: DataFrame, most: int) -> DataFrame:
    """The ``most`` nearest of each node's edges."""
    order = Window.partitionBy("u").orderBy(F.desc("s"), "v")
    return edges.dropDuplicates(["u", "v"]).withColumn("n", F.row_number().over(order)).where(F.col("n") <= most).drop("n")


def first_lists(nodes: DataFrame) -> DataFrame:
    """Edges inside slabs of the rows sorted by the code of one set of hyperplanes, for each of ORDERS sets.

    A range partition by code and node has no hot part: rows of one code spread over as many slabs as they need. Slabs end
    where a range does; kinds follow each other in another order for each set, so the ends cut them at other places.
    """

    def coded(seed: int):
        def run(batches):
            for batch in batches:
                x = [np.frombuffer(b, np.float64) for b in batch.column("x").to_pylist()]
                code = []
                for a in x:
                    planes = planes_of(len(a), seed)
                    code.append(int(((planes @ a) > 0) @ (1 << np.arange(BITS)[::-1])))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code, pa.int64())], names=[*batch.schema.names, "code"])

        return run

    def slabs(batches):
        wait = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            wait = t if wait is None else pa.concat_tables([wait, t])
            while wait.num_rows >= 2 * SLAB:
                yield edges_of_slab(wait.slice(0, 2 * SLAB))
                wait = wait.slice(SLAB)  # slabs overlap by half
        if wait is not None and wait.num_rows:
            yield edges_of_slab(wait)

    out = None
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for seed in range(ORDERS):
        dealt = nodes.select("kind", "node", "x").mapInArrow(coded(seed), "kind string, node bigint, x binary, code bigint")
        order = [F.xxhash64("kind", F.lit(seed)), F.col("kind"), F.col("code"), F.col("node")]
        dealt = dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        edges = dealt.mapInArrow(slabs, EDGE_SQL)
        out = edges if out is None else out.unionByName(edges)
    return out


def small_kinds(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    """The nearest NEIGHBOURS of each node of the kinds in ``sizes``, which have at most SMALL nodes, by full comparison."""
    groups = nodes.join(sizes.select("kind"), "kind").groupBy("kind").agg(F.collect_list(F.struct("kind", "node", "x")).alias("rows"))

    def run(batches):
        for batch in batches:
            for rows in batch.column("rows").to_pylist():
                yield edges_of_slab(pa.Table.from_pylist(rows))

    return groups.select("rows").mapInArrow(run, EDGE_SQL)


_planes: dict[tuple[int, int], np.ndarray] = {}


def planes_of(length: int, seed: int) -> np.ndarray:
    if (length, seed) not in _planes:
        _planes[length, seed] = np.random.default_rng([seed, length]).standard_normal((BITS, length))
    return _planes[length, seed]


def edges_of_slab(rows: pa.Table) -> pa.RecordBatch:
    """The nearest NEIGHBOURS of each row among the rows of its kind in the slab."""
    kinds = np.array(rows.column("kind").to_pylist())
    node = rows.column("node").to_numpy()
    x = rows.column("x").to_pylist()
    out = []
    for kind in dict.fromkeys(kinds.tolist()):
        at = np.flatnonzero(kinds == kind)
        if len(at) > 1:
            m = matrix([x[i] for i in at])
            s = m @ m.T
            np.fill_diagonal(s, -2)
            k = min(NEIGHBOURS, len(at) - 1)
            top = np.argpartition(-s, k - 1, axis=1)[:, :k]
            out.append((np.repeat(node[at], k), node[at][top].ravel(), np.take_along_axis(s, top, 1).ravel()))
    cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=EDGE)


def refined(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """One round: around each node its nearest on both sides meet, and pairs nearer than a known one become edges."""
    back = nearest(edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "s"), NEIGHBOURS)
    around = edges.select("u", "v").unionByName(back.select("u", "v")).unionByName(edges.select("u", F.col("u").alias("v"))).distinct()
    worst = edges.groupBy(F.col("u").alias("node")).agg(F.min("s").alias("worst"), F.count(F.lit(1)).alias("n"))
    members = nodes.join(worst, "node").select(F.col("node").alias("v"), "x", F.expr(f"case when n < {NEIGHBOURS} then -2D else worst end").alias("worst"))
    groups = around.join(members, "v").groupBy("u").agg(F.collect_list(F.struct("v", "worst", "x")).alias("members"))

    def run(batches):
        for batch in batches:
            out = []
            for members in batch.column("members").to_pylist():
                m = matrix([r["x"] for r in members])
                v, worst = np.array([r["v"] for r in members]), np.array([r["worst"] for r in members])
                s = m @ m.T
                np.fill_diagonal(s, -3)
                a, b = np.nonzero(s > worst[:, None])
                out.append((v[a], v[b], s[a, b]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=EDGE)

    return saved(nearest(edges.unionByName(groups.mapInArrow(run, EDGE_SQL)), NEIGHBOURS))


def audit(found: DataFrame, nodes: DataFrame, threshold: float = THRESHOLD, most: int | None = None, size: int = AUDIT) -> float:
    """Share of the links that ``found`` (node, links) holds, against brute force for ``size`` nodes with links in it and
    ``size`` of all, chosen by a hash.

    ``nodes`` has kind, node, x, copies; with ``most`` a node's links count up to it only.
    """
    order = F.xxhash64("node", F.lit(7))
    linked = nodes.join(found.where("links > 0").select("node"), "node", "left_semi").orderBy(order).limit(size)
    chosen = {r["node"]: r for part in (linked, nodes.orderBy(order).limit(size)) for r in part.select("kind", "node", "x").collect()}
    if not chosen:
        return 1.0
    by_kind: dict[str, tuple[list[int], np.ndarray]] = {}
    for kind in {r["kind"] for r in chosen.values()}:
        mine = [r for r in chosen.values() if r["kind"] == kind]
        by_kind[kind] = ([r["node"] for r in mine], matrix([bytes(r["x"]) for r in mine]))
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            kinds, node, x, copies = (batch.column(c).to_pylist() for c in ("kind", "node", "x", "copies"))
            out = []
            for kind in set(kinds) & set(by_kind):
                at = [i for i, k in enumerate(kinds) if k == kind]
                names, m = by_kind[kind]
                near = (m @ matrix([x[i] for i in at]).T >= threshold) & (np.array(names)[:, None] != np.array([node[i] for i in at])[None, :])
                out.extend(zip(names, (near @ np.array([copies[i] for i in at])).tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    true = nodes.select("kind", "node", "x", "copies").mapInArrow(run, "node bigint, n bigint").groupBy("node").agg(F.sum("n").alias("n"))
    cap = "n" if most is None else f"least(n, {most})"
    r = true.join(found.select("node", "links"), "node", "left").agg(F.sum(F.expr(cap)).alias("n"), F.sum(F.expr(f"least(coalesce(links, 0), {cap})")).alias("found")).first()
    return (r["found"] or 0) / r["n"] if r["n"] else 1.0


def balls_of(component: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and largest angles of the components in a block."""
    names, at = np.unique(component, return_inverse=True)
    centre = np.zeros((len(names), m.shape[1]))
    np.add.at(centre, at, m)
    size = np.linalg.norm(centre, axis=1, keepdims=True)
    first = m[np.unique(at, return_index=True)[1]]  # members that cancel out have one of them as their centre
    centre = np.where(size > 1e-9, centre / np.maximum(size, 1e-9), first)
    angle = np.zeros(len(names))
    np.maximum.at(angle, at, np.arccos(np.clip((m * centre[at]).sum(1), -1, 1)))
    return centre, angle + SLACK


def compared_blocks(members: DataFrame, threshold: float) -> DataFrame:
    """node, links, a, b: links of each of ``members`` with the others of its kind, in parts, and links a, b that join two components.

    ``members`` has kind, component, node, x, copies. Components stay together in a block, except large ones. Each
    component's part in a block lies in a ball; two blocks meet if any two of their balls are near enough.
    """
    spark = members.sparkSession
    sizes = members.groupBy("kind", "component").agg(F.count(F.lit(1)).alias("size"))
    totals = sizes.groupBy("kind").agg(F.ceil(F.sum("size") / BLOCK).cast("bigint").alias("blocks"))
    piece = F.expr(f"case when size < {BLOCK} then 0 else pmod(xxhash64(node, 3), cast(ceil(size / {BLOCK}) as bigint)) end")
    dealt = members.join(sizes, ["kind", "component"]).join(totals, "kind").withColumn("block", F.pmod(F.xxhash64("component", piece), F.col("blocks")))
    packs = saved(dealt.groupBy("kind", "blocks", "block").agg(F.collect_list(F.struct("component", "node", "copies", "x")).alias("rows")))

    def ball(batches):
        for batch in batches:
            out = []
            for rows in batch.column("rows").to_pylist():
                centre, angle = balls_of(np.array([r["component"] for r in rows]), matrix([r["x"] for r in rows]))
                out.append((centre.tobytes(), angle.tobytes()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("kind", "blocks", "block")), *(pa.array([o[i] for o in out], pa.binary()) for i in (0, 1))], names=["kind", "blocks", "block", "centres", "angles"])

    balls = saved(packs.mapInArrow(ball, "kind string, blocks bigint, block bigint, centres binary, angles binary"))
    reach = float(np.arccos(threshold))

    def near(batches):
        for batch in batches:
            keep = []
            for c, r, d, q in zip(*(batch.column(k).to_pylist() for k in ("centres", "angles", "centres_2", "angles_2"))):
                r, q = np.frombuffer(r), np.frombuffer(q)
                between = np.arccos(np.clip(np.frombuffer(c).reshape(len(r), -1) @ np.frombuffer(d).reshape(len(q), -1).T, -1, 1))
                keep.append(bool((between <= r[:, None] + q[None, :] + reach + SLACK).any()))
            yield batch.select(["kind", "block", "other"]).filter(pa.array(keep, pa.bool_()))

    # Each block asks those of its number and above, by (kind, other), so that a frequent kind is no hot key.
    left = balls.withColumn("other", F.explode(F.expr("sequence(block, blocks - 1)"))).select("kind", "block", "other", "centres", "angles")
    right = balls.select("kind", F.col("block").alias("other"), F.col("centres").alias("centres_2"), F.col("angles").alias("angles_2"))
    meet = saved(left.join(right, ["kind", "other"]).mapInArrow(near, "kind string, block bigint, other bigint"))
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            for a, b, same in zip(*(batch.column(c).to_pylist() for c in ("rows", "rows_2", "same"))):
                (node, comp, copies), (node_2, comp_2, copies_2) = ([np.array([r[k] for r in rows]) for k in ("node", "component", "copies")] for rows in (a, b))
                found = (matrix([r["x"] for r in a]) @ matrix([r["x"] for r in b]).T >= threshold) & (node[:, None] != node_2[None, :])
                links, joins = [(node, found @ copies_2)], {}
                if not same:
                    links.append((node_2, copies @ found))
                i, j = np.nonzero(found & (comp[:, None] != comp_2[None, :]))
                for u, v in zip(i.tolist(), j.tolist()):
                    joins.setdefault((comp[u], comp_2[v]), (node[u], node_2[v]))
                names, counts = (np.concatenate(c) for c in zip(*links))
                some, empty = counts > 0, [None] * len(joins)
                rows = (names[some].tolist() + empty, counts[some].tolist() + empty, *([None] * int(some.sum()) + [int(p[k]) for p in joins.values()] for k in (0, 1)))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], schema=schema)

    other = packs.select("kind", F.col("block").alias("other"), F.col("rows").alias("rows_2"))
    pairs = meet.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).join(packs.select("kind", "block", "rows"), ["kind", "block"]).join(other, ["kind", "other"])
    return pairs.select("rows", "rows_2", (F.col("block") == F.col("other")).alias("same")).mapInArrow(run, "node bigint, links bigint, a bigint, b bigint")


def lists(nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The refined neighbour lists; those of small kinds are final from the start."""
    sizes = saved(nodes.groupBy("kind").agg(F.count(F.lit(1)).alias("n")))
    small = sizes.where(F.col("n") <= SMALL)
    whole = saved(small_kinds(nodes, small))
    nodes = saved(nodes.join(small.select("kind"), "kind", "left_anti"))
    if nodes.isEmpty():
        return whole
    edges = saved(nearest(first_lists(nodes), NEIGHBOURS))
    single = nodes.withColumn("copies", F.lit(1).cast("bigint"))
    for turn in range(MOST_ROUNDS):
        edges = refined(edges, nodes)
        held = both_ways(edges.where(F.col("s") >= threshold)).groupBy("u").agg(F.count(F.lit(1)).alias("links")).withColumnRenamed("u", "node")
        if turn + 1 >= ROUNDS and audit(held, single, threshold, NEIGHBOURS) >= AIM:
            break
    return edges.unionByName(whole)


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()


def link(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    rows = saved(unit(vectors))
    nodes = saved(rows.groupBy("kind", "node", "x").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id")))
    edges = lists(nodes, threshold)
    near = saved(edges.where(F.col("s") >= threshold))
    both = both_ways(near)
    links = near.select(F.col("u").alias("a"), F.col("v").alias("b"))
    label = components(links)
    full = near.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= NEIGHBOURS)
    large = label.join(full.select(F.col("u").alias("node")), "node").select("component").distinct()
    listed = both.join(nodes.select(F.col("node").alias("v"), "copies"), "v").groupBy(F.col("u").alias("node")).agg(F.sum("copies").alias("listed"))
    members = label.join(large, "component").join(nodes.select("kind", "node", "x", "copies"), "node")
    for _ in range(2):
        compared = saved(compared_blocks(saved(members), threshold))
        joins = compared.where("a is not null").select("a", "b")
        if not joins.isEmpty():
            label = components(links.unionByName(joins))
        enlarged = compared.where("node is not null").groupBy("node").agg(F.sum("links").alias("links"))
        named = nodes.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
        first = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
        counted = saved(named.join(first, "component").join(enlarged, "node", "left").join(listed, "node", "left")
                        .select("node", "component_id", F.coalesce("links", "listed", F.lit(0)).alias("links"), "copies"))
        if audit(counted, nodes, threshold) >= AIM:
            break
        members = named.select("kind", "component", "node", "x", "copies")  # all of them: nothing is left to find after that
    per_node = counted.select("node", "component_id", (F.col("links") + F.col("copies") - 1).cast("bigint").alias("n_links"))
    found = rows.join(per_node, "node").select("vec_id", "n_links", "component_id")
    all_rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"))
    counts = rows.groupBy(F.col("vec_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy("vec_id").orderBy(F.lit(1))
    alone = (all_rows.join(counts, F.col("vec_id").eqNullSafe(F.col("_id")), "left").withColumn("_at", F.row_number().over(order)).where("_at > coalesce(_n, 0)")
             .select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")))
    return found.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
