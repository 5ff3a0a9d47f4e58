"""Slots of the mix drawn per output shard, and small sources that come near their targets."""

import collections

from pyspark.sql import functions as F

from quillframe.llm import mixing


def sources(spark, rows):
    return spark.createDataFrame([(i, n, float(t)) for i, (n, t) in enumerate(rows)], "ordinal long, source_size long, target double")


def test_small_sources_come_near_their_targets(spark):
    rows = [(0, "a", " ".join(["x"] * 60)), (1, "b", " ".join(["y"] * 66)), (2, "a", None), (None, "b", "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = collections.Counter()
    for r in mixing.mix(df, weights=(5, 2)).collect():
        found[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert abs(found["a"] - 90) <= 1 and abs(found["b"] - 36) <= 1


def test_many_sizes_come_near_their_targets(spark):
    rows = [(10 * i + j, f"s{i:02}", " ".join(["w"] * (1 + (7 * i + 13 * j) % 29))) for i in range(30) for j in range(1 + i)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 4 and r["over"] <= 0 for r in out)


def test_drawn_counts_choose_the_slots(spark):
    table = sources(spark, [(64 * 3000, 64 * 4500), (64 * 900, 64 * 600), (500, 321)])
    few, many = (mixing.deal(table, 64, 3, n).collect() for n in (1000, 100))
    for dealt, size in ((few, 1000), (many, 100)):
        total = len(dealt)
        assert {r["shard"] for r in dealt} == set(range(-(-total // size)))
        by = collections.defaultdict(list)
        for r in dealt:
            by[r["ordinal"], r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(min(s), min(s) + len(s))) for s in by.values())  # a run per shard
        shards = total // size
        counts = [len(by[0, k]) for k in range(shards)]
        mean = sum(counts) / len(counts)
        spread = sum((c - mean) ** 2 for c in counts) / len(counts)
        assert 0.2 * mean < spread < 5 * mean  # drawn, neither fixed nor lumped
    whole = lambda dealt: sorted((r["ordinal"], r["slot"], r["block"], r["rest"]) for r in dealt)
    assert whole(few) == whole(many) and [(r["ordinal"], r["shard"], r["slot"]) for r in few] != [(r["ordinal"], r["shard"], r["slot"]) for r in many]
    slots = collections.Counter(r["ordinal"] for r in few)
    assert slots == {0: 4500, 1: 600, 2: 6} and [r["rest"] for r in few if r["rest"] is not None] == [9]
