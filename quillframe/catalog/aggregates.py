"""Aggregations."""

from pyspark.sql import functions as F

from quillframe.operators import aggregate as agg
from quillframe.operators.binning import cut, even_edges
from quillframe.plans.quantiles import quantile_edges, quantiles
from quillframe.registry import query

STATUS = ["F", "O", "P"]
PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def rnd(df, **scales):
    return df.withColumns({c: F.round(c, n) for c, n in scales.items()})


@query("A01_global", """
SELECT count(p_size) AS n, arg_min(p_retailprice, p_partkey) AS first_price, arg_max(p_retailprice, p_partkey) AS last_price,
  round(avg(p_retailprice), 6) AS mean, round(quantile_cont(p_retailprice, 0.5), 6) AS median, min(p_size) AS lo, max(p_size) AS hi,
  round(stddev_samp(p_retailprice), 6) AS std, round(var_samp(p_size), 6) AS var, CAST(sum(p_size) AS BIGINT) AS total,
  round((SELECT avg(abs(p_size - m)) FROM part, (SELECT avg(p_size) AS m FROM part)), 6) AS mad,
  round(exp(sum(ln(1 + p_size / 100000.0))), 6) AS prod FROM part""")
def _(t):
    p = t.part
    mad = agg.mean_absolute_deviation(p, "p_size")
    med = quantiles(p, [], "p_retailprice", {"m": 0.5})
    return p.agg(
        F.count("p_size").alias("n"), F.min_by("p_retailprice", "p_partkey").alias("first_price"),
        F.max_by("p_retailprice", "p_partkey").alias("last_price"), F.round(F.avg("p_retailprice"), 6).alias("mean"),
        F.round(F.max(med.scalar()), 6).alias("median"), F.min("p_size").alias("lo"), F.max("p_size").alias("hi"),
        F.round(F.stddev_samp("p_retailprice"), 6).alias("std"), F.round(F.var_samp("p_size"), 6).alias("var"),
        F.sum("p_size").alias("total"), F.round(F.max(mad.scalar()), 6).alias("mad"),
        F.round(F.product(1 + F.col("p_size") / 100000.0), 6).alias("prod"))


@query("A02_group", "SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_orderstatus").agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("n"))


@query("A03_many_aggregates", """
SELECT l_returnflag, min(l_extendedprice) AS lo, round(quantile_cont(l_extendedprice, 0.5), 6) AS median, max(l_extendedprice) AS hi FROM lineitem GROUP BY 1""")
def _(t):
    q = quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", {"lo": 0.0, "median": 0.5, "hi": 1.0})
    return rnd(q, median=6)


@query("A04_per_column", "SELECT l_returnflag, min(l_quantity) AS qty_min, max(l_extendedprice) AS price_max FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.min("l_quantity").alias("qty_min"), F.max("l_extendedprice").alias("price_max"))


DESCRIBE = """count(l_extendedprice) AS count, round(avg(l_extendedprice), 6) AS mean, round(stddev_samp(l_extendedprice), 6) AS std,
 min(l_extendedprice) AS min, max(l_extendedprice) AS max, round(quantile_cont(l_extendedprice, 0.25), 6) AS q25,
 round(quantile_cont(l_extendedprice, 0.5), 6) AS q50, round(quantile_cont(l_extendedprice, 0.75), 6) AS q75 FROM lineitem"""


@query("A05_describe", f"SELECT {DESCRIBE}")
def _(t):
    return rnd(agg.describe(t.lineitem, [], "l_extendedprice"), mean=6, std=6, q25=6, q50=6, q75=6)


@query("A05_describe_grouped", f"SELECT l_linestatus, {DESCRIBE} GROUP BY 1")
def _(t):
    return rnd(agg.describe(t.lineitem, ["l_linestatus"], "l_extendedprice"), mean=6, std=6, q25=6, q50=6, q75=6)


@query("A06_group_filter", """
SELECT o_orderkey, o_custkey FROM (SELECT *, stddev_samp(o_totalprice) OVER (PARTITION BY o_custkey) AS s FROM orders) WHERE s > 120000""")
def _(t):
    return agg.keep_groups(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey"],
                           F.stddev_samp("o_totalprice"), lambda s: s > 120000).drop("o_totalprice")


@query("A07_group_transform", """
SELECT o_orderkey, round(o_totalprice - avg(o_totalprice) OVER (PARTITION BY o_custkey), 7) + 0.0 AS centred FROM orders""")
def _(t):
    out = agg.transform_groups(t.orders, ["o_custkey"], {"m": F.avg("o_totalprice")}, {"centred": F.col("o_totalprice") - F.col("m")})
    return out.select("o_orderkey", F.round("centred", 7).alias("centred"))


@query("A08_group_apply", """
SELECT o_orderkey, round(o_totalprice / sum(o_orderkey + 1) OVER (PARTITION BY o_orderstatus), 10) AS share FROM orders""")
def _(t):
    out = agg.transform_groups(t.orders, ["o_orderstatus"], {"s": F.sum(F.col("o_orderkey") + 1)}, {"share": F.col("o_totalprice") / F.col("s")})
    return out.select("o_orderkey", F.round("share", 10).alias("share"))


@query("A09_group_keys", """
SELECT CASE WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'vehicle' ELSE 'other' END AS kind, lower(left(c_mktsegment, 1)) AS letter,
  c_nationkey % 2 = 0 AS even, count(*) AS n FROM customer GROUP BY ALL""")
def _(t):
    mapping = F.create_map(F.lit("MACHINERY"), F.lit("vehicle"), F.lit("AUTOMOBILE"), F.lit("vehicle"))
    kind = F.coalesce(F.try_element_at(mapping, F.col("c_mktsegment")), F.lit("other"))
    return t.customer.groupBy(kind.alias("kind"), F.lower(F.left("c_mktsegment", F.lit(1))).alias("letter"),
                              (F.col("c_nationkey") % 2 == 0).alias("even")).agg(F.count("*").alias("n"))


@query("A10_decade_unstack", """
SELECT o_orderstatus, """ + ", ".join(
    f"round(coalesce(sum(o_totalprice) FILTER (year(o_orderdate) // 10 * 10 = {d}), 0), 2) AS \"{d}\"" for d in (1990, 2000)) + " FROM orders GROUP BY 1")
def _(t):
    o = t.orders.withColumn("decade", F.floor(F.year("o_orderdate") / 10) * 10)
    return agg.pivot(o, ["o_orderstatus"], "decade", [1990, 2000], {"total": F.round(F.sum("o_totalprice"), 2)}, fill=0)


@query("A11_group_sizes", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))


@query("A12_pivot", "SELECT o_orderpriority, " + ", ".join(
    f"round(avg(o_totalprice) FILTER (o_orderstatus = '{s}'), 5) AS {s}" for s in STATUS) + " FROM orders GROUP BY 1")
def _(t):
    return agg.pivot(t.orders, ["o_orderpriority"], "o_orderstatus", STATUS, {"m": F.round(F.avg("o_totalprice"), 5)})


@query("A13_binned_pivot", """
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.5) AS m, min(l_extendedprice) AS lo FROM lineitem),
b AS (SELECT l_returnflag, CASE WHEN l_quantity > 0 AND l_quantity <= 18 THEN 0 WHEN l_quantity > 18 AND l_quantity <= 80 THEN 1 END AS age,
  CASE WHEN l_extendedprice <= m THEN 0 ELSE 1 END AS half, l_linestatus, l_discount FROM lineitem, q)
SELECT l_returnflag, age, """ + ", ".join(
    f"round(avg(l_discount) FILTER (half = {h} AND l_linestatus = '{s}'), 8) AS \"{h}_{s}\"" for h in (0, 1) for s in "FO") + " FROM b GROUP BY ALL")
def _(t):
    (median,) = quantile_edges(t.lineitem, "l_extendedprice", [0.5])
    half = F.when(F.col("l_extendedprice") <= median, 0).otherwise(1)
    b = t.lineitem.select("l_returnflag", cut(F.col("l_quantity"), [0, 18, 80]).alias("age"),
                          F.concat_ws("_", half, "l_linestatus").alias("column"), "l_discount")
    return agg.pivot(b, ["l_returnflag", "age"], "column", ["0_F", "0_O", "1_F", "1_O"], {"m": F.round(F.avg("l_discount"), 8)})


@query("A14_pivot_per_value", "SELECT o_orderpriority, " + ", ".join(
    f"CAST(sum(o_custkey) FILTER (o_orderstatus = '{s}') AS BIGINT) AS {s}_keys, round(avg(o_totalprice) FILTER (o_orderstatus = '{s}'), 5) AS {s}_mean"
    for s in STATUS) + " FROM orders GROUP BY 1")
def _(t):
    return agg.pivot(t.orders, ["o_orderpriority"], "o_orderstatus", STATUS,
                     {"keys": F.sum("o_custkey"), "mean": F.round(F.avg("o_totalprice"), 5)})


_MARGIN = ", ".join([*[f"round(avg(o_totalprice) FILTER (o_orderstatus = '{s}'), 5) AS {s}" for s in STATUS], 'round(avg(o_totalprice), 5) AS "All"'])


@query("A15_margins", f"SELECT o_orderpriority, {_MARGIN} FROM orders GROUP BY 1 UNION ALL SELECT 'All', {_MARGIN} FROM orders")
def _(t):
    return agg.pivot_margins(t.orders, "o_orderpriority", "o_orderstatus", STATUS, F.round(F.avg("o_totalprice"), 5))


@query("A16_crosstab", "SELECT o_orderpriority, " + ", ".join(f"count(*) FILTER (o_orderstatus = '{s}') AS {s}" for s in STATUS) + " FROM orders GROUP BY 1")
def _(t):
    return agg.crosstab(t.orders, "o_orderpriority", "o_orderstatus", STATUS)


@query("A17_crosstab_shares", """
SELECT o_orderpriority, o_orderstatus, round(n / sum(n) OVER (PARTITION BY o_orderpriority), 10) AS share FROM
(SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)""")
def _(t):
    return rnd(agg.crosstab_shares(t.orders, "o_orderpriority", "o_orderstatus"), share=10)


@query("A18_value_counts", "SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 ORDER BY n DESC, o_custkey")
def _(t):
    return agg.value_counts(t.orders, "o_custkey")


@query("A19_percentiles", """
SELECT l_shipmode, round(quantile_cont(l_extendedprice, 0.05), 6) AS p05, round(quantile_cont(l_extendedprice, 0.25), 6) AS p25,
 round(quantile_cont(l_extendedprice, 0.99), 6) AS p99 FROM (SELECT l_returnflag || l_linestatus AS l_shipmode, l_extendedprice FROM lineitem) GROUP BY 1""")
def _(t):
    df = t.lineitem.select(F.concat("l_returnflag", "l_linestatus").alias("l_shipmode"), "l_extendedprice")
    return rnd(quantiles(df, ["l_shipmode"], "l_extendedprice", {"p05": 0.05, "p25": 0.25, "p99": 0.99}), p05=6, p25=6, p99=6)


@query("A20_sigma_clip", """
WITH q AS (SELECT quantile_cont(value, 0.5) AS m, 0.74 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS s FROM events)
SELECT event_id, value FROM events, q WHERE value > m - 5 * s AND value < m + 5 * s""")
def _(t):
    return agg.sigma_clip(t.events.select("event_id", "value"), "value")


@query("A21_reduce_by_key", "SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("user_id").agg(F.count("*").alias("n"))


def _chunks(key, value):
    return f"""SELECT {key}, CAST((rn - 1) // 500 AS BIGINT) AS chunk, count(*) AS n, list({value} ORDER BY {value}) AS values FROM
  (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {value}) AS rn FROM (SELECT DISTINCT {key}, {value} FROM events)) GROUP BY ALL"""


@query("A22_group_values", _chunks("event_type", "user_id"))
def _(t):
    return agg.grouped_values(t.events, "event_type", "user_id", chunk=500)


@query("A22_group_values_reverse", _chunks("user_id", "event_type"))
def _(t):
    return agg.grouped_values(t.events, "user_id", "event_type", chunk=500)


@query("A23_count", "SELECT count(*) AS n FROM documents")
def _(t):
    return t.documents.agg(F.count("*").alias("n"))


@query("A24_typed_counters", r"""
SELECT count(*) FILTER (k = 1) AS secure, count(*) FILTER (k = 2) AS org, count(*) FILTER (k = 3) AS query, count(*) FILTER (k = 0) AS other FROM (
 SELECT CASE WHEN contains(url, 'https:') THEN 1 WHEN contains(url, '.org') THEN 2 WHEN contains(url, '?') THEN 3 ELSE 0 END AS k FROM pages)""")
def _(t):
    u = F.col("url")
    return agg.typed_counts(t.pages, [("secure", u.contains("https:")), ("org", u.contains(".org")), ("query", u.contains("?")), ("other", F.lit(True))])


@query("A25_partition_reduce", "SELECT count(*) FILTER (contains(text, 'tion')) AS hits FROM documents")
def _(t):
    per = t.documents.groupBy(F.spark_partition_id().alias("part")).agg(F.count_if(F.col("text").contains("tion")).alias("n"))
    return per.agg(F.sum("n").alias("hits"))


@query("A27_histogram", """
WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem), e AS (SELECT i, lo + (hi - lo) * i / 5 AS a,
  CASE WHEN i = 4 THEN hi ELSE lo + (hi - lo) * (i + 1) / 5 END AS b FROM r, range(5) t(i))
SELECT CAST(i AS INTEGER) AS bin, round(a, 6) AS lo, round(b, 6) AS hi, count(l_extendedprice) AS n FROM e
LEFT JOIN lineitem ON l_extendedprice >= a AND (l_extendedprice < b OR (i = 4 AND l_extendedprice = b)) GROUP BY ALL""")
def _(t):
    li = t.lineitem.select("l_extendedprice")
    return rnd(agg.histogram(li, "l_extendedprice", agg.bins_of(li, "l_extendedprice", 5)), lo=6, hi=6)


@query("A28_class_histogram", """
WITH g AS (SELECT f AS l_returnflag, i, i * 10 + 0.0 AS lo, (i + 1) * 10 + 0.0 AS hi FROM (SELECT DISTINCT l_returnflag AS f FROM lineitem), range(6) t(i)),
c AS (SELECT l_returnflag, CASE WHEN l_quantity = 60 THEN 5 ELSE CAST(floor(l_quantity / 10) AS INT) END AS i, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_returnflag, CAST(i AS INTEGER) AS bin, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, CAST(coalesce(n, 0) AS BIGINT) AS n,
 round(coalesce(n, 0) / (sum(n) OVER (PARTITION BY l_returnflag) * 10), 10) AS density FROM g LEFT JOIN c USING (l_returnflag, i)""")
def _(t):
    h = agg.histogram(t.lineitem.select("l_returnflag", "l_quantity"), "l_quantity", even_edges(0.0, 60.0, 6), ["l_returnflag"])
    return rnd(agg.density(h, ["l_returnflag"]), density=10)


@query("A29_histogram_2d", """
SELECT CAST(CASE WHEN l_quantity = 50 THEN 4 ELSE floor(l_quantity / 10) END AS INTEGER) AS x_bin,
 CAST(CASE WHEN l_extendedprice = 110000 THEN 9 ELSE floor(l_extendedprice / 11000) END AS INTEGER) AS y_bin, count(*) AS n FROM lineitem GROUP BY ALL""")
def _(t):
    return agg.histogram_2d(t.lineitem, "l_quantity", "l_extendedprice", even_edges(0.0, 50.0, 5), even_edges(0.0, 110000.0, 10))


@query("A30_hexbin", """
WITH p AS (SELECT l_quantity * 20 / 50.0 AS u, l_extendedprice * 11 / 110000.0 AS v FROM lineitem),
q AS (SELECT *, floor(u + 0.5) AS ax, floor(v + 0.5) AS ay, floor(u) + 0.5 AS bx, floor(v) + 0.5 AS cy FROM p)
SELECT CASE WHEN pow(u - ax, 2) + 3 * pow(v - ay, 2) < pow(u - bx, 2) + 3 * pow(v - cy, 2) THEN ax ELSE bx END AS hx,
 CASE WHEN pow(u - ax, 2) + 3 * pow(v - ay, 2) < pow(u - bx, 2) + 3 * pow(v - cy, 2) THEN ay ELSE cy END AS hy, count(*) AS n FROM q GROUP BY ALL""")
def _(t):
    return agg.hexbin(t.lineitem, "l_quantity", "l_extendedprice", 20, (0.0, 50.0), (0.0, 110000.0))


@query("A31_arg_extremes", """
SELECT lang, arg_max(doc_id, (n_chars, -doc_id)) AS longest, arg_min(doc_id, (n_chars, doc_id)) AS shortest FROM documents GROUP BY 1""")
def _(t):
    return t.documents.groupBy("lang").agg(F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id"))).alias("longest"),
                                           F.min_by("doc_id", F.struct("n_chars", "doc_id")).alias("shortest"))


@query("A32_row_aggregate", """
SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity + l_discount + l_tax) / 3, 6) AS mean, round(l_quantity + l_discount + l_tax, 6) AS total,
 greatest(l_quantity, l_linenumber::DOUBLE) AS hi FROM lineitem""")
def _(t):
    cells = F.array("l_quantity", "l_discount", "l_tax")
    total = F.aggregate(cells, F.lit(0.0), lambda a, x: a + x)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(total / 3, 6).alias("mean"),
                             F.round(total, 6).alias("total"), F.greatest("l_quantity", F.col("l_linenumber").cast("double")).alias("hi"))


@query("A33_ranges", """
SELECT 'p_size' AS column_name, min(p_size)::DOUBLE AS lo, max(p_size)::DOUBLE AS hi, (max(p_size) - min(p_size))::DOUBLE AS width FROM part
UNION ALL SELECT 'p_retailprice', min(p_retailprice), max(p_retailprice), round(max(p_retailprice) - min(p_retailprice), 4) FROM part""")
def _(t):
    cols = ["p_size", "p_retailprice"]
    r = t.part.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in cols])
    return r.unpivot([], cols, "column_name", "r").select("column_name", "r.lo", "r.hi", F.round(F.col("r.hi") - F.col("r.lo"), 4).alias("width"))


@query("A34_level_mean", """
SELECT year, measure, round(avg(v), 8) AS mean FROM (UNPIVOT (SELECT year(l_shipdate) AS year, l_quantity, l_discount FROM lineitem)
ON l_quantity, l_discount INTO NAME measure VALUE v) GROUP BY ALL""")
def _(t):
    long = t.lineitem.select(F.year("l_shipdate").cast("bigint").alias("year"), "l_quantity", "l_discount").unpivot(
        ["year"], ["l_quantity", "l_discount"], "measure", "v")
    return long.groupBy("year", "measure").agg(F.round(F.avg("v"), 8).alias("mean"))


@query("A35_unstack", """
SELECT l_linenumber, sum(l_quantity) FILTER (l_returnflag = 'A') AS A, sum(l_quantity) FILTER (l_returnflag = 'N') AS N,
 sum(l_quantity) FILTER (l_returnflag = 'R') AS R FROM lineitem GROUP BY 1""")
def _(t):
    return agg.pivot(t.lineitem, ["l_linenumber"], "l_returnflag", ["A", "N", "R"], {"q": F.sum("l_quantity")})


@query("A35_stack", """
SELECT l_linenumber, l_returnflag, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL""")
def _(t):
    flags = ["A", "N", "R"]
    wide = agg.pivot(t.lineitem, ["l_linenumber"], "l_returnflag", flags, {"q": F.sum("l_quantity")})
    return wide.unpivot(["l_linenumber"], flags, "l_returnflag", "qty").filter("qty IS NOT NULL")


COLOURS = ["red", "blue", "green", "small", "large"]


@query("A37_multi_hot", "SELECT p_partkey, " + ", ".join(
    f"CAST(list_contains(string_split(p_name, ' '), '{w}') AS INTEGER) AS {w}" for w in COLOURS) + " FROM part")
def _(t):
    return agg.multi_hot(t.part, ["p_partkey"], "p_name", " ", COLOURS)


@query("A38_keyword_matrix", """
SELECT doc_id, contains(lower(text), 'tion') AS tion, contains(lower(text), 'http') AS http, contains(lower(text), 'eau') AS eau FROM documents
WHERE contains(lower(text), 'tion') OR contains(lower(text), 'http')""")
def _(t):
    flags = agg.keyword_flags(t.documents.select("doc_id", "text"), "text", ["tion", "http", "eau"])
    return flags.filter("tion OR http").drop("text")


@query("A38_keyword_matrix_case", """
SELECT doc_id, contains(text, 'The') AS "The", contains(text, 'License') AS "License" FROM documents""")
def _(t):
    return agg.keyword_flags(t.documents.select("doc_id", "text"), "text", ["The", "License"], case_sensitive=True).drop("text")


@query("A39_masked_statistic", """
SELECT round(quantile_cont(o_totalprice, 0.5) FILTER (o_orderstatus = 'F'), 6) AS finished,
 round(quantile_cont(o_totalprice, 0.5) FILTER (month(o_orderdate) IN (6, 7, 8)), 6) AS summer,
 round(quantile_cont(o_totalprice, 0.5) FILTER (month(o_orderdate) IN (6, 7, 8) AND o_orderstatus = 'F'), 6) AS summer_finished FROM orders""")
def _(t):
    fin, summer = F.col("o_orderstatus") == "F", F.month("o_orderdate").isin(6, 7, 8)
    masks = {"finished": fin, "summer": summer, "summer_finished": fin & summer}
    tagged = t.orders.select("o_totalprice", F.explode(F.array(*[F.when(m, F.lit(k)) for k, m in masks.items()])).alias("mask"))
    med = quantiles(tagged, ["mask"], "o_totalprice", {"m": 0.5})
    return med.groupBy().pivot("mask", list(masks)).agg(F.round(F.first("m"), 6))


@query("A40_scatter_add", """
SELECT CAST(user_id % 10 AS BIGINT) AS bucket, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1""")
def _(t):
    return t.events.groupBy((F.col("user_id") % 10).alias("bucket")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("A41_extremes", """
(SELECT 'smallest' AS side, l_extendedprice, count(*) AS n FROM lineitem GROUP BY 2 ORDER BY 2 LIMIT 10) UNION ALL
(SELECT 'largest', l_extendedprice, count(*) FROM lineitem GROUP BY 2 ORDER BY 2 DESC LIMIT 10)""")
def _(t):
    return agg.frequency_extremes(t.lineitem, "l_extendedprice", 10)


@query("A42_contrast", """
SELECT round(avg(o_totalprice) FILTER (f), 5) AS mean_first, round(avg(o_totalprice) FILTER (NOT f), 5) AS mean_other,
 round(var_pop(o_totalprice) FILTER (f), 2) AS var_first, round(stddev_pop(o_totalprice) FILTER (NOT f), 5) AS std_other,
 count(*) FILTER (f) AS n_first, count(*) FILTER (NOT f) AS n_other,
 round(avg(o_totalprice) FILTER (f) - avg(o_totalprice) FILTER (NOT f), 5) AS difference
FROM (SELECT o_totalprice, o_orderpriority = '1-URGENT' AS f FROM orders)""")
def _(t):
    f = F.col("o_orderpriority") == "1-URGENT"
    a, b = F.when(f, F.col("o_totalprice")), F.when(~f, F.col("o_totalprice"))
    return t.orders.agg(
        F.round(F.avg(a), 5).alias("mean_first"), F.round(F.avg(b), 5).alias("mean_other"), F.round(F.var_pop(a), 2).alias("var_first"),
        F.round(F.stddev_pop(b), 5).alias("std_other"), F.count(a).alias("n_first"), F.count(b).alias("n_other"),
        F.round(F.avg(a) - F.avg(b), 5).alias("difference"))


@query("A43_rate_model", """
WITH d AS (SELECT doc_id, lang, least(n_chars // 1000, 3) AS bracket, quality FROM documents LEFT JOIN labels USING (doc_id)),
m AS (SELECT lang, bracket, CAST(avg(quality) >= 0.5 AS INTEGER) AS p FROM d WHERE quality IS NOT NULL GROUP BY ALL)
SELECT doc_id, coalesce(p, 0) AS prediction FROM d LEFT JOIN m USING (lang, bracket)""")
def _(t):
    d = t.documents.select("doc_id", "lang", F.least(F.floor(F.col("n_chars") / 1000), F.lit(3)).alias("bracket"))
    model = agg.rate_model(d.join(t.labels, "doc_id"), ["lang", "bracket"], "quality")
    return agg.apply_rate_model(d, model, ["lang", "bracket"]).select("doc_id", "prediction")


@query("A44_split_fraction", """
SELECT l_returnflag, CAST(floor(l_quantity / 10) * 10 AS INTEGER) AS decade, round(avg(1 - 2 * (l_discount * l_extendedprice) / l_extendedprice), 8) AS fraction,
 count(*) FILTER (1 - 2 * (l_discount * l_extendedprice) / l_extendedprice > 0.9) AS n FROM lineitem GROUP BY ALL""")
def _(t):
    frac = 1 - 2 * (F.col("l_discount") * F.col("l_extendedprice")) / F.col("l_extendedprice")
    return t.lineitem.groupBy("l_returnflag", (F.floor(F.col("l_quantity") / 10) * 10).cast("int").alias("decade")).agg(
        F.round(F.avg(frac), 8).alias("fraction"), F.count_if(frac > 0.9).alias("n"))


@query("A45_five_numbers", """
SELECT l_returnflag, l_linestatus, min(l_extendedprice) AS min, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1,
 round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(quantile_cont(l_extendedprice, 0.75), 6) AS q3, max(l_extendedprice) AS max
FROM lineitem GROUP BY ALL""")
def _(t):
    return rnd(agg.five_numbers(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice"), q1=6, median=6, q3=6)
