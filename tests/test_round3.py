"""Sketch-bracketed quantiles, the two-level neighbour index, kept state, running streams, compaction by bytes."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillframe.operators import neighbours
from quillframe.plans import quantiles as Q
from quillframe.sources import sinks
from quillframe.streaming import jobs, state


def plain_quantile(xs, p, kind):
    xs = sorted(xs, key=lambda x: (math.isnan(x), x))
    n = len(xs)
    if kind == "disc":
        return xs[max(math.ceil(p * n) - 1, 0)]
    if kind == "row":
        return xs[min(math.floor(p * n), n - 1)]
    h = p * (n - 1)
    lo, hi = xs[math.floor(h)], xs[math.ceil(h)]
    return lo + (hi - lo) * (h - math.floor(h))


PS = {"a": 0.0, "b": 0.03, "c": 0.5, "d": 0.77, "e": 1.0}


@pytest.mark.parametrize("kind", ["cont", "disc", "row"])
def test_quantiles_beside_a_sort(spark, kind):
    rng = np.random.default_rng(3)
    groups = {"spread": rng.normal(size=6000).round(6), "tied": rng.integers(0, 3, 4000).astype(float), "one": [7.5], "two": [1.0, 2.0], "huge": np.exp(rng.normal(size=900) * 30)}
    rows = [(k, float(x)) for k, xs in groups.items() for x in xs] + [("spread", None), (None, 1.0), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    got = {r["k"]: r for r in Q.quantiles(df, ["k"], "x", PS, kind).collect()}
    assert set(got) == set(groups)
    for k, xs in groups.items():
        assert [got[k][c] for c in PS] == [plain_quantile([float(x) for x in xs], p, kind) for p in PS.values()]
    row = Q.quantiles(df.where("k = 'spread'"), [], "x", PS, kind).first()
    assert [row[c] for c in PS] == [got["spread"][c] for c in PS]


def test_quantiles_of_odd_columns(spark):
    df = spark.createDataFrame([(1, float("nan")), (1, 2.0), (1, 1.0), (2, float("nan")), (3, None)], "k int, x double")
    got = {r["k"]: (r["lo"], r["hi"]) for r in Q.quantiles(df, ["k"], "x", {"lo": 0.0, "hi": 1.0}, "disc").collect()}
    assert got[1][0] == 1.0 and math.isnan(got[1][1]) and math.isnan(got[2][0]) and set(got) == {1, 2}
    big = spark.createDataFrame([((1 << 60) + i,) for i in range(50)], "x bigint")
    assert Q.quantiles(big, [], "x", {"m": 0.5}, "disc").first()["m"] == (1 << 60) + 24
    days = spark.sql("select date_add(date'2024-01-01', cast(id as int)) as x from range(11)")
    assert str(Q.quantiles(days, [], "x", {"m": 0.5}, "disc").first()["m"]) == "2024-01-06"
    none = spark.createDataFrame([], "k int, x double")
    assert Q.quantiles(none, ["k"], "x", {"m": 0.5}).count() == 0
    assert Q.quantiles(none, [], "x", {"m": 0.5}).first()["m"] is None


def test_brackets_leave_few_values_to_shuffle_and_misses_are_mended(spark, monkeypatch):
    df = spark.range(200_000).select((F.xxhash64("id") % 1_000_000).cast("double").alias("_x"))
    bounds = Q.brackets(df, [], [0.5], "disc")
    counts = Q.collapsed_counts(df, [], bounds, 1)
    assert counts.count() < 200_000 * 0.03
    assert counts.agg(F.sum("n")).first()[0] == 200_000
    right = Q.quantiles(df, [], "_x", {"m": 0.5}, "disc").first()["m"]
    wrong = spark.createDataFrame([([0.0], [1.0])], "lo array<double>, hi array<double>")
    monkeypatch.setattr(Q, "brackets", lambda *a: wrong)
    assert Q.quantiles(df, [], "_x", {"m": 0.5}, "disc").first()["m"] == right


def test_approximate_quantiles(spark):
    df = spark.range(100_000).select((F.col("id") % 4).alias("k"), F.col("id").cast("double").alias("x")).unionByName(spark.createDataFrame([(9, None)], "k bigint, x double"))
    got = {r["k"]: r for r in Q.approximate_quantiles(df, ["k"], "x", {"p10": 0.1, "p90": 0.9}).collect()}
    assert got[9]["p10"] is None
    assert all(abs(got[k]["p10"] - 10_000) < 3000 and abs(got[k]["p90"] - 90_000) < 3000 for k in range(4))


def brute(vectors, k, metric):
    out = {}
    for i, a in vectors.items():
        d = sorted((float(np.abs(a - b).sum() if metric == "l1" else np.sqrt(((a - b) ** 2).sum())), j) for j, b in vectors.items() if j != i)
        out[i] = [j for _, j in d[:k]]
    return out


def clustered(spark, n, centres, dims=8, seed=5):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims)) * 50
    vectors = {i: middle[i % centres] + rng.normal(size=dims) for i in range(n)}
    return vectors, spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors.items()], "id bigint, v array<double>")


@pytest.mark.parametrize("metric", ["l2", "l1"])
def test_index_finds_the_nearest(spark, metric):
    vectors, df = clustered(spark, 600, 20)
    copies = {i: vectors[0] for i in range(600, 680)}  # a group of copies larger than a block
    vectors |= copies
    rows = df.unionByName(spark.createDataFrame([(i, [float(x) for x in v]) for i, v in copies.items()] + [(None, [1.0] * 8), (700, None)], df.schema))
    got = {}
    for r in neighbours.nearest(rows, rows, "id", "v", 3, metric, rows=32).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert got == brute(vectors, 3, metric)
    assert neighbours.nearest(rows.limit(0), rows, "id", "v", 3).count() == 0
    assert neighbours.nearest(rows, rows.limit(0), "id", "v", 3).count() == 0
    few = neighbours.nearest(df.where("id < 2"), df.where("id < 2"), "id", "v", 3, rows=1).collect()
    assert sorted((r["id"], r["neighbour"], r["rank"]) for r in few) == [(0, 1, 1), (1, 0, 1)]


def test_index_visits_grow_more_slowly_than_the_table(spark):
    seen = []
    for n in (800, 3200):
        _, df = clustered(spark, n, n // 40)
        index = neighbours.build_index(df, "id", "v", rows=40)
        found = neighbours.search_index(index, df, "id", "v", 2, rows=40)
        assert found.count() == 2 * n
        seen.append(found.agg(F.avg("visited")).first()[0])
    assert seen[1] < 2 * seen[0] and seen[1] < 0.2 * 3200 / 40


def test_index_approximate_form(spark):
    vectors, df = clustered(spark, 800, 20)
    right = brute(vectors, 5, "l2")
    found = neighbours.nearest(df, df, "id", "v", 5, rows=40, cells=4).collect()
    hits = sum(r["neighbour"] in right[r["id"]] for r in found)
    assert len(found) == 4000 and hits / 4000 >= 0.9


def shard(spark, folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w") as f:
        f.writelines(f"2024-01-01 00:00:{s:02d}.000000 {user} click {value}\n" for s, user, value in rows)
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


def test_more_than_a_hundred_triggers_are_kept(spark, tmp_path):
    for i in range(112):
        shard(spark, f"{tmp_path}/in", f"f{i:03d}.txt", [(0, i, 1.0)] * (i % 3 + 1))
    lines = jobs.stream_lines(spark, f"{tmp_path}/in", max_files=1)
    with jobs.ProgressTable(spark, f"{tmp_path}/log") as log:
        log.wait(jobs.drain(lines.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/ckpt")), 120)
    rows = log.table().where("rows > 0")
    assert rows.count() == 112 == rows.select("batch_id").distinct().count()
    assert rows.agg(F.sum("rows")).first()[0] == sum(i % 3 + 1 for i in range(112))


def test_running_query_and_state_after_a_restart(spark, tmp_path):
    inbox, out, ckpt = (f"{tmp_path}/{n}" for n in ("in", "out", "ckpt"))

    def start():
        lines = jobs.parse_actions(jobs.stream_lines(spark, inbox))
        kept = state.update_state(lines, ["user_id"], state.last_values("value", ["ts"], 3), "ts array<string>, value array<double>", "user_id bigint, recent array<double>")
        return jobs.keep_running(jobs.batch_writer(kept, lambda b: b, out, ckpt, "update"), every="300 milliseconds")

    shard(spark, inbox, "a", [(1, 7, 1.0), (2, 7, 2.0), (1, 8, 5.0)])
    running = start()
    running.processAllAvailable()
    shard(spark, inbox, "b", [(4, 7, 4.0), (3, 7, 3.0)])
    running.processAllAvailable()
    assert running.isActive
    running.stop()
    assert running.awaitTermination(10)
    shard(spark, inbox, "c", [(5, 7, 5.0), (6, 9, 9.0)])
    running = start()
    running.processAllAvailable()
    running.stop()
    got = {r["user_id"]: r["recent"] for r in jobs.latest(spark.read.parquet(out), ["user_id"], ["recent"]).collect()}
    assert got == {7: [3.0, 4.0, 5.0], 8: [5.0], 9: [9.0]}


def test_idle_keys_are_forgotten(spark, tmp_path):
    inbox, out, ckpt = (f"{tmp_path}/{n}" for n in ("in", "out", "ckpt"))
    shard(spark, inbox, "a", [(1, 7, 1.0), (2, 7, 2.0)])
    kept = state.update_state(jobs.parse_actions(jobs.stream_lines(spark, inbox)), ["user_id"], state.running_total("value"), "n bigint, total double",
                              "user_id bigint, n bigint, total double", idle_ms=500, expire=lambda key, held: [(*key, -held[0], held[1])])
    running = jobs.keep_running(jobs.batch_writer(kept, lambda b: b, out, ckpt, "update"), every="300 milliseconds")
    rows = []
    for _ in range(60):
        running.awaitTermination(1)
        rows = [tuple(r) for r in spark.read.schema("user_id bigint, n bigint, total double").option("recursiveFileLookup", "true").parquet(out).collect()] if os.path.isdir(out) else []
        if (7, -2, 3.0) in rows:
            break
    running.stop()
    assert (7, 2, 3.0) in rows and (7, -2, 3.0) in rows


def test_compaction_by_bytes(spark, tmp_path):
    rng = np.random.default_rng(1)
    want = {}
    for day in ("2024-01-01", "2024-01-02", "none"):
        os.makedirs(f"{tmp_path}/in/{day}")
        for i in range(40):
            size = int(rng.integers(1, 400)) if i else 30_000
            lines = [f"{day} {i} {j if i % 2 else 'same'}" for j in range(size // 15 + 1)]
            want.setdefault(day if day != "none" else "other", []).extend(lines)
            with open(f"{tmp_path}/in/{day}/f{i}.txt", "w") as f:
                f.write("\n".join(lines) + "\n")
    plan = sinks.compact_lines(spark, f"{tmp_path}/in", f"{tmp_path}/out", "/in/([0-9-]+)/", 4096)
    assert plan.count() == 120
    made = [os.path.join(d, f) for d, _, names in os.walk(f"{tmp_path}/out") for f in names if f.endswith(".txt")]
    assert max(map(os.path.getsize, made)) <= 4096 + 64 and len(made) < 90
    for day, lines in want.items():
        back = [r["value"] for r in spark.read.option("recursiveFileLookup", "true").text(f"{tmp_path}/out/group={day}").collect()]
        assert sorted(back) == sorted(lines)
