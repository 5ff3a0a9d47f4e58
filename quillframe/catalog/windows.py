"""Window functions."""

from pyspark.sql import functions as F

from quillframe.catalog.joins import DAILY, daily
from quillframe.operators import windows
from quillframe.plans.ordered import cumulative_counts, scan
from quillframe.registry import query

ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
IDS = ", ".join(ID)


def lines(t, *more):
    return t.lineitem.select(*ID, *more)


@query("W01_average_rank", f"""
SELECT {IDS}, l_quantity, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity)
  + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2 AS rank FROM lineitem""")
def _(t):
    return windows.ranks(lines(t, "l_returnflag", "l_quantity"), "l_quantity", ["l_returnflag"]).drop("l_returnflag")


@query("W02_first_rank", f"""
SELECT {IDS}, row_number() OVER (ORDER BY l_quantity, {IDS}) AS rank FROM lineitem""")
def _(t):
    return windows.first_come_ranks(lines(t, "l_quantity"), "l_quantity", ID).drop("l_quantity")


@query("W03_max_rank_desc", """
SELECT o_orderkey, rank() OVER (ORDER BY v DESC) + count(*) OVER (PARTITION BY v) - 1 AS rank FROM
  (SELECT o_orderkey, floor(o_totalprice / 1000) AS v FROM orders)""")
def _(t):
    o = t.orders.select("o_orderkey", F.floor(F.col("o_totalprice") / 1000).alias("v"))
    return windows.ranks(o, "v", method="max", ascending=False).drop("v")


@query("W04_rank_columns", """
SELECT p_partkey, rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2 AS size_rank,
       rank() OVER (ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_retailprice) - 1) / 2 AS price_rank FROM part""")
def _(t):
    p = windows.ranks(t.part.select("p_partkey", "p_size", "p_retailprice"), "p_size", out="size_rank")
    return windows.ranks(p, "p_retailprice", out="price_rank").drop("p_size", "p_retailprice")


@query("W04_rank_across", f"""
SELECT {IDS}, (l_quantity > l_linenumber)::INT + (l_quantity > l_discount * 100)::INT + ((l_quantity = l_linenumber)::INT + (l_quantity = l_discount * 100)::INT + 2) / 2 AS a_rank,
  (l_linenumber > l_quantity)::INT + (l_linenumber > l_discount * 100)::INT + ((l_linenumber = l_quantity)::INT + (l_linenumber = l_discount * 100)::INT + 2) / 2 AS b_rank,
  (l_discount * 100 > l_quantity)::INT + (l_discount * 100 > l_linenumber)::INT + ((l_discount * 100 = l_quantity)::INT + (l_discount * 100 = l_linenumber)::INT + 2) / 2 AS c_rank
FROM lineitem""")
def _(t):
    df = lines(t, F.col("l_quantity").alias("a"), F.col("l_linenumber").alias("b"), (F.col("l_discount") * 100).alias("c"))
    return df.select(*ID, *windows.rank_across(["a", "b", "c"]))


@query("W05_sample_ranks", f"""
SELECT {IDS}, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) - 1 AS rank FROM lineitem""")
def _(t):
    out = windows.first_come_ranks(lines(t), "l_extendedprice", [c for c in ID if c != "l_extendedprice"], ["l_suppkey"])
    return out.withColumn("rank", F.col("rank") - 1)


@query("W06_centred_rolling", f"""
SELECT day, CASE WHEN count(*) OVER w = 7 THEN round(avg(total) OVER w, 5) END AS mean,
       CASE WHEN count(*) OVER w = 7 THEN round(stddev_samp(total) OVER w, 5) END AS std
FROM {DAILY} WINDOW w AS (ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""")
def _(t):
    r = windows.rolling(daily(t), "day", "total", {"mean": F.avg("total"), "std": F.stddev_samp("total")}, *windows.centred(7))
    return r.select("day", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std"))


@query("W07_even_rolling", f"""
SELECT day, CASE WHEN count(*) OVER w = 8 THEN CAST(sum(n) OVER w AS BIGINT) END AS rolled FROM {DAILY}
WINDOW w AS (ORDER BY day ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING)""")
def _(t):
    return windows.rolling(daily(t), "day", "n", {"rolled": F.sum("n")}, *windows.centred(8)).select("day", "rolled")


@query("W08_gaussian_rolling", f"""
SELECT day, round(list_sum([l[i] * exp(-0.5 * pow((i - 1 - 4.5) / 2, 2)) for i in range(1, 11)]), 6) AS smooth
FROM (SELECT day, CASE WHEN count(*) OVER w = 10 THEN list(total) OVER w END AS l FROM {DAILY}
WINDOW w AS (ORDER BY day ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING))""")
def _(t):
    return windows.gaussian_rolling(daily(t), "day", "total", 10, 2.0, "smooth").select("day", F.round("smooth", 6).alias("smooth"))


@query("W09_shift", f"SELECT day, lag(total, 3) OVER (ORDER BY day) AS earlier, lead(total, 2) OVER (ORDER BY day) AS later FROM {DAILY}")
def _(t):
    s = windows.shift(daily(t), "day", "total", 3, "earlier")
    return windows.shift(s, "day", "total", -2, "later").select("day", "earlier", "later")


@query("W10_shift_key", f"SELECT CAST(day + 90 AS DATE) AS day, total FROM {DAILY}")
def _(t):
    return daily(t).select(F.date_add("day", 90).alias("day"), "total")


@query("W11_since_first", """
SELECT o_orderkey, CAST(date_diff('day', min(o_orderdate) OVER (), o_orderdate) AS INTEGER) AS days FROM orders""")
def _(t):
    first = t.orders.agg(F.min("o_orderdate")).scalar()
    return t.orders.select("o_orderkey", F.datediff("o_orderdate", first).alias("days"))


@query("W12_running", f"""
SELECT {IDS}, round(sum(l_quantity) OVER w, 2) AS running_sum,
  round(exp(sum(ln(1 - l_discount / 3)) OVER w), 8) + 0.0 AS running_product
FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, {IDS} ROWS UNBOUNDED PRECEDING)""")
def _(t):
    df = lines(t, "l_quantity", (1 - F.col("l_discount") / 3).alias("rate"))
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    out = windows.running(df, ["l_suppkey"], order, {"running_sum": "l_quantity"}, {"running_product": "rate"})
    return out.select(*ID, F.round("running_sum", 2).alias("running_sum"), F.round("running_product", 8).alias("running_product"))


@query("W13_enumerate", "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i, o_orderkey FROM orders")
def _(t):
    return windows.enumerate_rows(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"]).select("i", "o_orderkey")


@query("W13_zip", """
SELECT c_custkey, s_suppkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS i FROM customer)
JOIN (SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal, s_suppkey) AS i FROM supplier) USING (i)""")
def _(t):
    z = windows.zip_rows(t.customer.select("c_acctbal", "c_custkey"), ["c_acctbal", "c_custkey"],
                         t.supplier.select("s_acctbal", "s_suppkey"), ["s_acctbal", "s_suppkey"])
    return z.select("c_custkey", "s_suppkey")


@query("W14_next_row", "SELECT event_id, lead(event_id) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS next_id FROM events")
def _(t):
    df = t.events.select("event_type", "ts", "event_id")
    return scan(df, ["event_type"], ["ts", "event_id"], {"next_id": ("lead", "event_id")}).select("event_id", "next_id")


@query("W15_seen_before", """
SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) > 1 AS seen FROM events""")
def _(t):
    df = t.events.select("event_id", "user_id", "event_type", "ts")
    return windows.seen_before(df, ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", "seen")


@query("W16_runs", """
WITH m AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS ch FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(ch) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM m)
SELECT user_id, CAST(run AS BIGINT) AS run, event_type, count(*) AS n, min(ts) AS first, max(ts) AS last FROM r GROUP BY ALL""")
def _(t):
    return windows.runs(t.events, ["user_id"], ["ts", "event_id"], "event_type")


@query("W17_cumulative", """
SELECT DISTINCT l_extendedprice AS x, round(cume_dist() OVER (ORDER BY l_extendedprice), 12) AS p FROM lineitem""")
def _(t):
    cum = cumulative_counts(t.lineitem.select("l_extendedprice"), [], "l_extendedprice")
    return cum.select(F.col("l_extendedprice").alias("x"), F.round(F.col("cum") / F.col("total"), 12).alias("p"))
