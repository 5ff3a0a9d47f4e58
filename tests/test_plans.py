"""The building blocks under skew and different partition counts, and the plans they lead to."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillframe.operators import aggregate, binning, joins, missing, ordering, windows
from quillframe.plans.blocks import block_pairs
from quillframe.plans.ordered import PART, range_split, scan, with_group_stats
from quillframe.plans.quantiles import quantiles
from quillframe.tables import Tables


@pytest.fixture(scope="module")
def hot(spark):
    """2000 rows, more than a third of them under one key and one value, with gaps and a null key."""
    rng = np.random.default_rng(1)
    k = np.where(rng.random(2000) < 0.4, 7, rng.integers(0, 30, 2000))
    x = np.where(rng.random(2000) < 0.35, 5, rng.integers(0, 100, 2000)).astype(float)
    pdf = pd.DataFrame({"k": k, "i": rng.permutation(2000), "x": x})
    pdf["gap"] = pdf["x"].where(rng.random(2000) < 0.3)
    df = spark.createDataFrame(pdf.replace({np.nan: None}), "k int, i int, x double, gap double").withColumn(
        "k", F.when(F.col("k") != 3, F.col("k")))
    return df, pdf.assign(k=pdf["k"].where(pdf["k"] != 3))


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_scan_matches_pandas(hot, parts):
    df, pdf = hot
    got = scan(df, ["k"], ["i"], {
        "rn": ("row_number",), "s": ("sum", "x"), "t": ("total", "x"), "m": ("max", "x"), "f": ("last", "gap"),
        "b": ("next", "gap"), "lag": ("lag", "gap"), "lead": ("lead", "gap")}, parts).toPandas().sort_values("i").reset_index(drop=True)
    want = pdf.sort_values("i").reset_index(drop=True)
    g = want.groupby(want["k"].fillna(-1))
    expect = {"rn": g.cumcount() + 1, "s": g["x"].cumsum(), "t": g["x"].transform("sum"), "m": g["x"].cummax(), "f": g["gap"].ffill(),
              "b": g["gap"].bfill(), "lag": g["gap"].shift(1), "lead": g["gap"].shift(-1)}
    for name, e in expect.items():
        pd.testing.assert_series_equal(got[name].astype(float), e.astype(float), check_names=False)


def test_copies_of_a_row_spread_over_parts(spark):
    copies = spark.range(4000).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    parts = range_split(copies, ["k", "v"], 8).groupBy(PART).count().toPandas()["count"]
    assert len(parts) >= 6 and parts.max() < 1500
    assert scan(copies, ["k"], ["v"], {"rn": ("row_number",)}, 8).agg(F.count_distinct("rn")).first()[0] == 4000


def test_global_scan(hot):
    df, pdf = hot
    got = scan(df, [], ["x", "i"], {"rn": ("row_number",)}).toPandas().sort_values(["x", "i"])
    assert list(got["rn"]) == list(range(1, 2001))


def test_quantiles(hot):
    df, pdf = hot
    ps = {"a": 0.1, "b": 0.5, "c": 0.93}
    got = quantiles(df, ["k"], "x", ps).toPandas().set_index("k")
    for k, g in pdf.dropna(subset=["k"]).groupby("k"):
        np.testing.assert_allclose(got.loc[k, list(ps)].to_numpy(dtype=float), np.percentile(g["x"], [10, 50, 93]))
    step = quantiles(df, [], "x", ps, kind="disc").first()
    assert [step[c] for c in ps] == [np.percentile(pdf["x"], p * 100, method="inverted_cdf") for p in ps.values()]


def test_ranks(spark):
    s = spark.createDataFrame([(i, v) for i, v in enumerate([30, 12, 12, 55, 8, 30, 12])], "i int, v int")
    got = lambda **kw: [r["rank"] for r in windows.ranks(s, "v", **kw).orderBy("i").collect()]
    assert got() == [5.5, 3, 3, 7, 1, 5.5, 3]
    assert got(method="max", ascending=False) == [3, 6, 6, 1, 7, 3, 6]
    assert [r["rank"] for r in windows.first_come_ranks(s, "v", ["i"]).orderBy("i").collect()] == [5, 2, 3, 7, 1, 6, 4]


def test_runs_and_seen(spark):
    s = spark.createDataFrame(list(enumerate("aabbbac")), "i int, v string")
    r = windows.runs(s, [], ["i"], "v").orderBy("run").collect()
    assert [(x["v"], x["n"]) for x in r] == [("a", 2), ("b", 3), ("a", 1), ("c", 1)]
    assert [x["seen"] for x in windows.seen_before(s, ["v"], ["i"]).orderBy("i").collect()] == [False, True, False, True, True, True, False]


def test_running_product(spark):
    s = spark.createDataFrame(list(enumerate([2.0, -3.0, 4.0, 0.0, 5.0])), "i int, v double")
    r = windows.running(s, [], ["i"], {"s": "v"}, {"p": "v"}).orderBy("i").collect()
    assert [round(x["p"], 9) for x in r] == [2, -6, -24, 0, 0] and [x["s"] for x in r] == [2, -1, 3, 3, 8]


def test_three_binning_rules(spark):
    d = spark.createDataFrame([(v,) for v in (0.0, 0.5, 1.0, 1.5, 2.0)], "v double")
    r = d.select(binning.cut(F.col("v"), [0, 1, 2]).alias("c"), binning.histogram_bin(F.col("v"), [0, 1, 2]).alias("h"),
                 binning.digitize(F.col("v"), [0, 1, 2]).alias("d")).collect()
    assert [x["c"] for x in r] == [None, 0, 0, 1, 1]
    assert [x["h"] for x in r] == [0, 0, 1, 1, 1]
    assert [x["d"] for x in r] == [1, 1, 2, 2, 3]


def test_bracket_join(hot, spark):
    df, pdf = hot
    edges = [(e, f"b{e}") for e in (3, 10, 55, 90)]
    got = binning.bracket_join(df, "x", spark.createDataFrame(edges, "lo int, name string"), "lo").toPandas().sort_values("i")
    pos = np.searchsorted([e for e, _ in edges], pdf.sort_values("i")["x"], side="right") - 1
    assert len(got) == 2000
    assert [n for n in got["name"].where(got["name"].notna(), None)] == [None if p < 0 else edges[p][1] for p in pos]


def test_block_pairs_cover_every_pair(spark):
    a, b = spark.range(70), spark.range(45)

    def tally(x, y):
        return pd.DataFrame({"n": [len(x) * len(y)], "s": [int(x["id"].sum() * y["id"].sum())]})

    r = block_pairs(a, b, ["id"], ["id"], tally, "n bigint, s bigint", rows=16).agg(F.sum("n"), F.sum("s")).first()
    assert tuple(r) == (70 * 45, sum(range(70)) * sum(range(45)))


def test_smallest_per_group_and_chunks(hot):
    df, pdf = hot
    got = ordering.smallest_per_group(df.dropna(subset=["k"]), ["k"], ["x", "i"], 3).groupBy("k").count().toPandas()
    want = pdf.dropna(subset=["k"]).groupby("k").size().clip(upper=3)
    assert dict(zip(got["k"], got["count"])) == {int(k): int(v) for k, v in want.items()}
    parts = aggregate.grouped_values(df, "k", "i", chunk=50).toPandas()
    assert parts["n"].max() <= 50 and parts["n"].sum() == pdf["k"].notna().sum()


def test_level_grid_beyond_the_array_limit(spark, monkeypatch):
    df = spark.range(30).select((F.col("id") % 5).alias("a"), F.col("id").alias("b"))
    small = joins.level_grid(df, ["a", "b"])
    monkeypatch.setattr(joins, "CHUNK_LEVELS", 7)
    large = joins.level_grid(df, ["a", "b"])
    assert small.count() == large.count() == large.distinct().count() == 150


def test_group_stats_and_median_fill(spark):
    d = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None), (None, 4.0)], "g string, v double")
    assert sorted(r["m"] for r in with_group_stats(d, ["g"], {"m": F.count("v")}).collect()) == [0, 2, 2, 2]
    filled = missing.impute_group_median(d, ["g"], "v").filter("g = 'a'").collect()
    assert sorted(r["v"] for r in filled) == [1.0, 2.0, 3.0]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pushdown_and_pruning(spark):
    from quillframe.registry import load_catalog

    q = load_catalog()
    p = plan_of(q["P22_partial_date"](spark, "/root/testdata/sf0.001"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    p = plan_of(q["A02_group"](spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in p


@pytest.mark.parametrize("name", ["J14_level_product", "J15_bracket_join", "P28_minus_row", "A20_sigma_clip", "Q04_compare",
                                  "Q05_convolution", "Q10_bayes", "Q14_kernel_density", "A05_describe", "L26_mean_curve"])
def test_no_cross_join(spark, name):
    from quillframe.registry import load_catalog

    p = plan_of(load_catalog()[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in p and "NestedLoop" not in p


def test_tables_have_pinned_schemas(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    assert t.orders.schema["o_orderdate"].dataType.simpleString() == "timestamp_ntz"
