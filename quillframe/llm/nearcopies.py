"""Near copies by SetSketch registers.

A text's set of word shingles is sketched in registers: each keeps the smallest of exponentially distributed numbers
drawn for the shingles, rounded to an exponent of BASE. Registers of a union are the larger of both, and equal
registers speak for similar sets. Runs of registers are band keys; sets that share one are candidates. From two
sketches the similarity is estimated jointly by maximum likelihood, and what may reach the threshold is confirmed on
the full sets.

Equal sets are one node from the start. Inside a band group no pairs are listed: each round links every set to the
hub that it shares most bands with, and only groups that still hold several components go on, to other hubs. At the
end, what is left with several components is compared block by block inside tasks: only members of different
components meet, only links leave the task, and one for each pair of components. So a group of thousands costs a few
tests for each member, and no link that a shared band shows is lost.

Rules: A-Z are lower-cased, words are split at ASCII white space; a text of fewer words than a shingle is one shingle;
null or empty texts have an empty set and link with nothing; null ids never name a component; repeated rows are copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillframe.llm.common import by_rows, dropped, hashed, saved, windows
from quillframe.llm.components import components

SHINGLE = 5
#: BANDS keys of BAND_SIZE registers: sets of similarity 0.85 share none with a chance of 7e-9.
BANDS, BAND_SIZE = 32, 5
REGISTERS = BANDS * BAND_SIZE
BASE, RATE, LIMIT = 1.001, 20.0, 65_534
#: Rounds of hubs before the pairs that are left.
ROUNDS = 3
#: A pair is tested if its estimate is at most this much below the threshold: five standard deviations and more.
SLACK = 0.15
#: Sets of a block in the last step.
BLOCK = 128

_rng = np.random.default_rng(20240229)
_MULTIPLY = _rng.integers(0, 1 << 63, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, REGISTERS, np.uint64) * np.uint64(2)

SKETCH = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("registers", pa.binary()), ("bands", pa.list_(pa.int64()))])


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    h, _ = hashed([text], lower=True)
    return np.unique(windows(h, min(SHINGLE, len(h)))) if len(h) else np.zeros(0, np.uint64)


def sketch(grams: np.ndarray) -> np.ndarray:
    """Registers of one set, in blocks of shingles so that memory does not follow the text."""
    low = np.full(REGISTERS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(grams), 256):
        x = grams[None, i:i + 256] * _MULTIPLY[:, None]
        x += _ADD[:, None]
        np.minimum(low, x.min(axis=1), out=low)
    uniform = (low.astype(np.float64) + 1.0) / 18446744073709551616.0
    value = np.floor(1.0 - np.log(-np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE) / np.log(BASE))
    return np.clip(value, 0, LIMIT + 1).astype("<u2")


def band_keys(registers: np.ndarray) -> list[int]:
    data = registers.tobytes()
    step = 2 * BAND_SIZE
    return [xxhash.xxh3_64_intdigest(data[i * step:(i + 1) * step], seed=i) - (1 << 63) for i in range(BANDS)]


def with_hash(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def sketches(documents: DataFrame) -> DataFrame:
    def row(doc_id, text_hash, text):
        grams = shingles(text)
        if not len(grams):
            return doc_id, text_hash, 0, None, None, None
        registers = sketch(grams)
        return doc_id, text_hash, len(grams), xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63), registers.tobytes(), band_keys(registers)

    return with_hash(documents).mapInArrow(
        by_rows(row, SKETCH, "doc_id", "text_hash", "text"), "doc_id bigint, text_hash bigint, n_shingles bigint, node bigint, registers binary, bands array<bigint>")


_GRID = np.linspace(0.0, 1.0, 201)


def estimate(a: bytes, b: bytes, n_a: int, n_b: int) -> float:
    """Similarity of largest likelihood, given how many registers are larger, equal and smaller, and the set sizes."""
    x, y = np.frombuffer(a, "<u2"), np.frombuffer(b, "<u2")
    more, less = int((x > y).sum()), int((x < y).sum())
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    j = _GRID * min(u / v, v / u)
    tiny = 1e-12

    def p(z):
        return -np.log1p(-np.clip(z, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = p(u - v * j), p(v - u * j)
    likely = more * np.log(up + tiny) + less * np.log(down + tiny) + (REGISTERS - more - less) * np.log(np.maximum(1 - up - down, tiny))
    return float(j[likely.argmax()])


def likely(more, less, n, m, at: float):
    """Whether the joint estimate of pairs reaches ``at``, from the counts of registers that are larger and smaller (arrays).

    The likelihood has one peak, so its slope at ``at`` tells on which side the peak lies; ``at`` is below min(n, m) / max(n, m).
    """
    u, v = n / (n + m), m / (n + m)
    part = (BASE - 1) / BASE

    def p(z):
        return -np.log1p(-z * part) / np.log(BASE), part / (1 - z * part) / np.log(BASE)

    (up, up_slope), (down, down_slope) = p(u - v * at), p(v - u * at)
    up_slope, down_slope = -v * up_slope, -u * down_slope
    return more * up_slope / up + less * down_slope / down - (REGISTERS - more - less) * (up_slope + down_slope) / (1 - up - down) >= 0


PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("same", pa.bool_())])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose sizes and joint estimate allow the threshold and whose full sets reach it."""

    def same(a, b, r, q, x, y):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        n, m = len(x), len(y)
        if 100 * min(n, m) < percent * max(n, m) or estimate(r, q, n, m) < percent / 100 - SLACK:
            return a, b, False
        both = len(np.intersect1d(x, y, assume_unique=True))
        return a, b, 100 * both >= percent * (n + m - both)

    one, two = (sets.select(F.col("node").alias(k), F.col("registers").alias(f"r_{k}"), F.col("grams").alias(f"g_{k}")) for k in "ab")
    tested = pairs.join(one, "a").join(two, "b").mapInArrow(by_rows(same, PAIR, "a", "b", "r_a", "r_b", "g_a", "g_b"), "a bigint, b bigint, same boolean")
    return tested.where("same").select("a", "b")


def between_components(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links a, b between different components among ``placed`` (key, node, component), the sets that still share bands.

    Sets connected by bands are one neighbourhood. Large components fill blocks of their own, small ones share blocks,
    and two blocks meet unless both hold one and the same component.
    """
    low = placed.groupBy("key").agg(F.min("node").alias("low"))
    hood = components(placed.join(low, "key").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()).withColumnRenamed("component", "hood")
    members = saved(placed.select("node", "component").distinct().join(hood, "node"))
    sizes = members.groupBy("hood", "component").agg(F.count(F.lit(1)).alias("size"))
    small = sizes.where(F.col("size") < BLOCK).groupBy(F.col("hood").alias("_hood")).agg(F.ceil(F.sum("size") / BLOCK).alias("shared"))
    block = F.expr(f"case when size < {BLOCK} then concat('s', pmod(xxhash64(component), shared)) else concat('c', component, ':', pmod(xxhash64(node, 1), ceil(size / {BLOCK}))) end")
    dealt = members.join(sizes, ["hood", "component"]).join(small, F.col("hood") == F.col("_hood"), "left").select("hood", "node", "component", block.alias("block"))
    full = dealt.join(sets, "node")
    packs = saved(full.groupBy("hood", "block").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.collect_list(F.struct("node", "component", "registers", "grams")).alias("rows")))
    other = packs.select("hood", F.col("block").alias("block_2"), F.col("lo").alias("lo_2"), F.col("hi").alias("hi_2"), F.col("rows").alias("rows_2"))
    meet = packs.join(other, "hood").where("block <= block_2 and not (lo = hi and lo_2 = hi_2 and lo = lo_2)").select("rows", "rows_2")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            out = []
            for left, right in zip(batch.column("rows").to_pylist(), batch.column("rows_2").to_pylist()):
                x, y = (np.stack([np.frombuffer(r["registers"], "<u2") for r in rows]) for rows in (left, right))
                g, h = ([np.frombuffer(r["grams"], np.uint64) for r in rows] for rows in (left, right))
                n, m = np.array([len(s) for s in g]), np.array([len(s) for s in h])
                apart = np.array([r["component"] for r in left])[:, None] != np.array([r["component"] for r in right])[None, :]
                fit = 100 * np.minimum(n[:, None], m[None, :]) >= percent * np.maximum(n[:, None], m[None, :])
                done = set()
                for i in np.flatnonzero((apart & fit).any(axis=1)).tolist():
                    near = np.flatnonzero(apart[i] & fit[i])
                    met = likely((x[i] > y[near]).sum(axis=1), (x[i] < y[near]).sum(axis=1), n[i], m[near], percent / 100 - SLACK)
                    for j in near[met].tolist():
                        key = tuple(sorted((left[i]["component"], right[j]["component"])))
                        if key not in done:
                            both = len(np.intersect1d(g[i], h[j], assume_unique=True))
                            if 100 * both >= percent * (n[i] + m[j] - both):
                                done.add(key)
                                out.append((left[i]["node"], right[j]["node"]))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in (0, 1)], schema=schema)

    return meet.mapInArrow(run, "a bigint, b bigint")


def full_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, registers, grams of the wanted nodes, the last made from the text of one document of each."""
    def row(node, registers, text):
        return node, registers, shingles(text).tobytes()

    schema = pa.schema([("node", pa.int64()), ("registers", pa.binary()), ("grams", pa.binary())])
    joined = with_hash(documents).join(wanted, (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.col("text_hash") == F.col("_hash")))
    return (joined.select("node", "registers", "text").mapInArrow(by_rows(row, schema, "node", "registers", "text"), "node bigint, registers binary, grams binary")
            .dropDuplicates(["node"]))


def linked(documents: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, component, component_id: one row per document; component is null for empty sets.

    The result is a written table; those it was made from are deleted.
    """
    sketched = saved(sketches(documents))
    some = sketched.where("node is not null")
    nodes = saved(some.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("at"), F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n_shingles"),
                                           F.first("registers").alias("registers"), F.first("bands").alias("bands")))
    keys = nodes.select("node", F.explode("bands").alias("key"))
    groups = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high").select("key")
    members = saved(keys.join(groups, "key").select("key", "node"))
    shared = saved(members.select("node").distinct())
    wanted = shared.join(nodes.select("node", "registers", F.col("at.doc_id").alias("_id"), F.col("at.text_hash").alias("_hash")), "node")
    sets = saved(full_sets(documents, wanted))
    labels = shared.select("node", F.col("node").alias("component"))
    links = None
    for turn in range(ROUNDS + 1):
        placed = members.join(labels, "node")
        mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("key")
        placed = placed.join(mixed, "key")
        if turn < ROUNDS:
            hub = placed.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("order"), "node", "component")).alias("hub"))
            met = (placed.join(hub, "key").where(F.col("component") != F.col("hub.component"))
                   .groupBy("node", F.col("hub.node").alias("hub_node")).agg(F.count(F.lit(1)).alias("shared")))
            pairs = met.groupBy("node").agg(F.max(F.struct("shared", "hub_node")).alias("best")).select(F.least("node", "best.hub_node").alias("a"), F.greatest("node", "best.hub_node").alias("b")).distinct()
            found = confirmed(pairs, sets, percent)
        else:
            found = between_components(saved(placed), sets, percent)
        found = saved(found)
        if found.isEmpty():
            continue
        links = found if links is None else links.unionByName(found)
        grouped = components(links)
        labels = saved(shared.join(grouped, "node", "left").select("node", F.coalesce("component", "node").alias("component")))
    named = (nodes.select("node", "first_id").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "component").select("node", "component", "component_id")
    columns = ["doc_id", "text_hash", "n_shingles", "component", "component_id"]
    with_text = some.join(named, "node").select(columns)
    without = sketched.where("node is null").withColumn("component", F.lit(None).cast("bigint")).withColumn("component_id", F.col("doc_id")).select(columns)
    out = saved(with_text.unionByName(without))
    dropped(sketched, nodes, members, shared, sets)
    return out


def link(documents: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document."""
    return linked(documents, percent).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_copies(documents: DataFrame, percent: int = 80) -> DataFrame:
    """The documents of which one row of each group stays, the first by doc_id (nulls last) and hash of the text.

    Rows are told apart by both, so texts that share an id, or have none, are decided each by itself. Repeated rows of
    one id and text are one, also without words; of these the smallest in the order of all columns stays.
    """
    rows = linked(documents, percent)
    first = rows.where("component is not null").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("at"))
    alone = rows.where("component is null").select("doc_id", "text_hash")
    kept = first.select("at.doc_id", "at.text_hash").unionByName(alone.distinct())
    counted = rows.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.count(F.lit(1)).alias("_rows"))
    kept = counted.join(kept, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash")), "left_semi")
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    joined = documents.join(kept, same)
    order = [f.name for f in documents.schema if "map<" not in f.dataType.simpleString()]
    one = (joined.where("_rows > 1").groupBy("_id", "_hash").agg(F.min_by(F.struct(*documents.columns), F.struct(*order)).alias("_row"))
           .select(*[F.col("_row")[c].alias(c) for c in documents.columns]))
    return joined.where("_rows = 1").select(documents.columns).unionByName(one)


def oracle(percent: int = 85) -> str:
    """The same rows in DuckDB SQL; ids are unique there."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    last = SHINGLE - 1
    return f"""
    WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    grams AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - {last} + 1), lambda i: array_to_string(w[i:i + {last}], ' '))) END) AS g FROM words),
    sizes AS (SELECT d.doc_id, count(g) AS n FROM documents d LEFT JOIN grams USING (doc_id) GROUP BY 1),
    shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM shared s JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id WHERE 100 * s.n >= {percent} * (p.n + q.n - s.n)),
    reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT s.doc_id, s.n AS n_shingles, min(r.b) AS component_id, s.doc_id = min(r.b) AS kept FROM sizes s JOIN reach r ON s.doc_id = r.a GROUP BY s.doc_id, s.n
    """
