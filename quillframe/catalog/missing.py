"""Missing data."""

from pyspark.sql import functions as F

from quillframe.operators import missing
from quillframe.registry import query

# Gaps are cut into the given tables by these rules, the same on both sides.
GAPS = """(SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS a, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS b,
 CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS c FROM orders)"""
EVENT_GAPS = "(SELECT event_id, user_id, ts, CASE WHEN event_type <> 'view' THEN value END AS value FROM events)"


def gaps(t):
    return t.orders.selectExpr("o_orderkey", "CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS a",
                               "CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS b",
                               "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS c")


def event_gaps(t):
    return t.events.selectExpr("event_id", "user_id", "ts", "CASE WHEN event_type <> 'view' THEN value END AS value")


@query("M01_null_summary", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) > count({c}) AS any_missing, count(*) - count({c}) AS n_missing FROM {GAPS}"
    for c in ("o_orderkey", "a", "b", "c")))
def _(t):
    return missing.missing_summary(gaps(t))


@query("M02_drop_rows", f"""
SELECT 'any' AS rule, o_orderkey FROM {GAPS} WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL
UNION ALL SELECT 'all', o_orderkey FROM {GAPS} WHERE a IS NOT NULL OR b IS NOT NULL OR c IS NOT NULL
UNION ALL SELECT 'thresh', o_orderkey FROM {GAPS} WHERE (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT >= 2""")
def _(t):
    df, cols = gaps(t), ["a", "b", "c"]
    rules = {"any": df.dropna("any", subset=cols), "all": df.dropna("all", subset=cols), "thresh": df.dropna(thresh=2, subset=cols)}
    any_, all_, thresh = [d.select(F.lit(k).alias("rule"), "o_orderkey") for k, d in rules.items()]
    return any_.union(all_).union(thresh)


@query("M03_drop_columns", "SELECT o_orderkey FROM orders")
def _(t):
    return missing.drop_missing_columns(gaps(t), "any")


@query("M04_fill_constant", f"SELECT o_orderkey, coalesce(a, 0) AS a, coalesce(b, 0) AS b, coalesce(c, 'none') AS c FROM {GAPS}")
def _(t):
    return gaps(t).fillna({"a": 0, "b": 0.0, "c": "none"})


@query("M05_forward_fill", f"""
SELECT event_id, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM {EVENT_GAPS}""")
def _(t):
    return missing.forward_fill(event_gaps(t), ["user_id"], ["ts", "event_id"], "value").select("event_id", "value")


@query("M06_back_fill", f"""
SELECT event_id, first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM {EVENT_GAPS}""")
def _(t):
    return missing.back_fill(event_gaps(t), ["user_id"], ["ts", "event_id"], "value").select("event_id", "value")


@query("M07_fill_along_row", f"""
SELECT o_orderkey, CAST(a AS DOUBLE) AS a, coalesce(b, a) AS b, coalesce(b, a) AS d FROM (SELECT *, NULL AS d FROM {GAPS})""")
def _(t):
    df = gaps(t).select("o_orderkey", F.col("a").cast("double").alias("a"), "b", F.lit(None).cast("double").alias("d"))
    return missing.fill_along_row(df, ["a", "b", "d"])


PART_GAPS = "(SELECT p_partkey, p_brand, p_type, CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS p_size FROM part)"


@query("M08_group_median", f"""
SELECT p_partkey, round(coalesce(p_size, quantile_cont(p_size, 0.5) OVER (PARTITION BY p_brand, p_type)), 4) AS p_size FROM {PART_GAPS}""")
def _(t):
    df = t.part.selectExpr("p_partkey", "p_brand", "p_type", "CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size AS double) END AS p_size")
    return missing.impute_group_median(df, ["p_brand", "p_type"], "p_size").select("p_partkey", F.round("p_size", 4).alias("p_size"))


@query("M09_mode", f"""
SELECT o_orderkey, coalesce(c, (SELECT c FROM {GAPS} WHERE c IS NOT NULL GROUP BY c ORDER BY count(*) DESC, c LIMIT 1)) AS c FROM {GAPS}""")
def _(t):
    return missing.impute_mode(gaps(t).select("o_orderkey", "c"), "c")


@query("M10_mean_or_class_median", f"""
WITH g AS (SELECT o.o_orderstatus, g.* FROM {GAPS} g JOIN orders o USING (o_orderkey))
SELECT o_orderkey, round(coalesce(b, avg(b) OVER ()), 2) AS by_mean,
       round(coalesce(b, quantile_cont(b, 0.5) OVER (PARTITION BY o_orderstatus)), 4) AS by_class FROM g""")
def _(t):
    df = t.orders.selectExpr("o_orderkey", "o_orderstatus", "CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS b")
    df = missing.impute_mean(df.withColumn("by_mean", F.col("b")), "by_mean")
    df = missing.impute_group_median(df, ["o_orderstatus"], "b")
    return df.select("o_orderkey", F.round("by_mean", 2).alias("by_mean"), F.round("b", 4).alias("by_class"))


@query("M11_sentinels", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_quantity IN (7, 8, 9) OR l_quantity > 45 THEN NULL ELSE l_quantity END AS l_quantity FROM lineitem""")
def _(t):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return missing.sentinels_to_null(t.lineitem.select(*cols), "l_quantity", [7, 8, 9], above=45)


@query("M12_strict_reduce", f"""
WITH g AS (SELECT o.o_orderstatus, g.* FROM {GAPS} g JOIN orders o USING (o_orderkey))
SELECT o_orderstatus, round(sum(b), 2) AS skipping, CASE WHEN count(*) = count(b) THEN round(sum(b), 2) END AS strict_b,
       CASE WHEN count(*) = count(o_orderkey) THEN CAST(sum(o_orderkey) AS BIGINT) END AS strict_key,
       count(a + b) AS rows_complete FROM g GROUP BY 1""")
def _(t):
    df = t.orders.selectExpr("o_orderkey", "o_orderstatus", "CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS a",
                             "CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS b")
    return df.groupBy("o_orderstatus").agg(
        F.round(F.sum("b"), 2).alias("skipping"), F.round(missing.strict(F.sum, "b"), 2).alias("strict_b"),
        missing.strict(F.sum, "o_orderkey").alias("strict_key"),
        F.count(missing.strict_row_sum(["a", "b"])).alias("rows_complete"))


@query("M13_reindex_rows", """
SELECT n_nationkey, CAST(coalesce(n, 0) AS BIGINT) AS n FROM nation LEFT JOIN
  (SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_acctbal > 8000 GROUP BY 1) ON n_nationkey = s_nationkey""")
def _(t):
    counts = t.supplier.filter("s_acctbal > 8000").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    return missing.reindex_rows(counts, "n_nationkey", t.nation.select("n_nationkey"), {"n": 0})
