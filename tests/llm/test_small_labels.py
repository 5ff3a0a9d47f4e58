"""Links of labels of every size, however many partitions cut them, beside brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillframe.llm import neighbours


def rows_of_labels():
    rng = np.random.default_rng(12)
    rows, label = [], 0
    for size, groups in ((1, 4), (2, 30), (3, 20), (70, 2), (300, 1)):
        for _ in range(groups):
            base = rng.normal(size=(max(1, size // 5), 12))
            rows += [(len(rows) + k, [float(x) for x in base[k % len(base)] + rng.normal(size=12) * 0.02], label) for k in range(size)]
            label += 1
    return rows


def plain(rows):
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    by_label = {}
    for i, _, label in rows:
        by_label.setdefault(label, []).append(i)
    links = {i: {j for j in by_label[label] if j != i and unit[i] @ unit[j] >= 0.98} for i, _, label in rows}
    root = {i: i for i in links}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, near in links.items():
        for j in near:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i: (len(near), find(i)) for i, near in links.items()}


@pytest.mark.parametrize("partitions", [1, 8, 60])
def test_links_of_small_and_large_labels(spark, partitions):
    rows = rows_of_labels()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(partitions)
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neighbours.link(frame).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == plain(rows)


def test_a_missed_aim_leads_to_full_comparison(spark, monkeypatch):
    rows = [(i, v, 1) for i, v, _ in rows_of_labels()][-300:]
    monkeypatch.setattr(neighbours, "lists", lambda nodes, threshold: neighbours.saved(spark.createDataFrame([], neighbours.EDGE_SQL)))
    monkeypatch.setattr(neighbours, "audit", lambda found, nodes, threshold: 0.0 if not found.where(F.col("links") > 0).count() else 1.0)
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neighbours.link(frame).collect()}
    assert got == plain(rows)
