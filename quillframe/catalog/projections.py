"""Projections, filters, predicates."""

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quillframe.operators import project
from quillframe.registry import query

LINE_ID = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("P01_column_select", "SELECT c_name, c_custkey FROM customer")
def _(t):
    return t.customer.select("c_name", "c_custkey")


@query("P02_reindex_columns", "SELECT c_custkey, CAST(NULL AS DOUBLE) AS debt, c_acctbal FROM customer")
def _(t):
    return project.reindex_columns(t.customer, ["c_custkey", "debt", "c_acctbal"])


@query("P03_derived_column", f"""
SELECT {LINE_ID}, round(l_extendedprice / l_quantity, 9) AS unit_price, l_linenumber + 1 AS next_line FROM lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             F.round(F.col("l_extendedprice") / F.col("l_quantity"), 9).alias("unit_price"),
                             (F.col("l_linenumber") + 1).alias("next_line"))


@query("P04_drop_column", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def _(t):
    return t.orders.drop("o_orderstatus")


@query("P05_rename", "SELECT n_nationkey AS id, n_name AS nation, n_regionkey FROM nation")
def _(t):
    return t.nation.withColumnsRenamed({"n_nationkey": "id", "n_name": "nation"})


@query("P06_mask_filter", """
SELECT * FROM orders WHERE (o_totalprice > 100000 AND o_orderstatus = 'F') OR (o_orderpriority = '1-URGENT' AND NOT o_orderstatus = 'O')""")
def _(t):
    c = F.col
    return t.orders.filter(((c("o_totalprice") > 100000) & (c("o_orderstatus") == "F"))
                           | ((c("o_orderpriority") == "1-URGENT") & ~(c("o_orderstatus") == "O")))


@query("P07_query_string", f"""
SELECT {LINE_ID}, l_quantity, l_discount FROM lineitem
WHERE l_quantity < (SELECT avg(l_quantity) FROM lineitem) AND l_discount < (SELECT avg(l_discount) FROM lineitem)""")
def _(t):
    # The bound variables come from the same frame, so they stay subqueries of one plan.
    means = t.lineitem.agg(F.struct(F.avg("l_quantity").alias("q"), F.avg("l_discount").alias("d"))).scalar()
    return (t.lineitem.filter((F.col("l_quantity") < means["q"]) & (F.col("l_discount") < means["d"]))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount"))


@query("P07_bound_parameters", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 50000 AND 90000 AND o_orderstatus = 'O'""")
def _(t):
    return t.spark.sql("SELECT o_orderkey, o_totalprice FROM {o} WHERE o_totalprice BETWEEN :lo AND :hi AND o_orderstatus = :s",
                       args={"lo": 50000, "hi": 90000, "s": "O"}, o=t.orders)


@query("P08_expression_string", f"""
SELECT {LINE_ID}, round((l_extendedprice + l_tax) / (l_discount + 1), 4) AS d FROM lineitem""")
def _(t):
    return t.lineitem.selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                 "round((l_extendedprice + l_tax) / (l_discount + 1), 4) AS d")


@query("P09_chained_comparison", f"""
SELECT {LINE_ID} FROM lineitem
WHERE l_discount < l_tax AND l_tax <= l_quantity AND l_quantity <> l_linenumber""")
def _(t):
    return t.lineitem.filter(project.chained("l_discount", ("<", "l_tax"), ("<=", "l_quantity"), ("!=", "l_linenumber"))).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("P10_row_mean_local", f"""
SELECT {LINE_ID}, round(l_quantity + (l_quantity + l_discount + l_tax) / 3, 6) AS shifted FROM lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(
        F.col("l_quantity") + project.row_mean(["l_quantity", "l_discount", "l_tax"]), 6).alias("shifted"))


@query("P11_cell_mask", """
SELECT CASE WHEN p_partkey > 25 THEN p_partkey END AS p_partkey, p_name, p_brand, p_type,
       CASE WHEN p_size > 25 THEN p_size END AS p_size, CASE WHEN p_retailprice > 25 THEN p_retailprice END AS p_retailprice FROM part""")
def _(t):
    return project.keep_cells(t.part, lambda c: c > 25)


@query("P12_conditional_assign", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice < 1000 THEN 'F' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def _(t):
    rule = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 1000)
    return t.orders.select("o_orderkey", F.when(rule, "F").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))


@query("P13_cap", """
SELECT o_orderkey, CASE WHEN o_totalprice >= 400000 THEN 399999.0::DOUBLE ELSE o_totalprice END AS o_totalprice FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", F.when(F.col("o_totalprice") >= 400000, 399999.0).otherwise(
        F.col("o_totalprice")).alias("o_totalprice"))


@query("P14_replace", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'FINISHED' ELSE o_orderstatus END AS o_orderstatus,
       o_orderpriority FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority").replace(
        {"O": "OPEN", "F": "FINISHED"}, subset=["o_orderstatus"])


@query("P15_recode", """
SELECT c_custkey, c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS code FROM customer""")
def _(t):
    return project.ordinal_codes(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", "code")


@query("P16_cast", f"""
SELECT {LINE_ID}, CAST(trunc(l_quantity) AS INTEGER) AS q, CAST(l_linenumber AS DOUBLE) AS line,
       TRY_CAST(l_returnflag AS INTEGER) AS flag, strftime(l_shipdate, '%Y-%m-%d') AS day FROM lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("q"),
                             F.col("l_linenumber").cast("double").alias("line"),
                             F.col("l_returnflag").try_cast("int").alias("flag"),
                             F.col("l_shipdate").cast("date").cast("string").alias("day"))


@query("P17_select_by_type", "SELECT o_orderstatus, o_orderpriority FROM orders")
def _(t):
    return project.select_by_type(t.orders, StringType)


@query("P18_range_slice", "SELECT * FROM orders WHERE o_orderdate BETWEEN '1996-01-01' AND '1996-06-30'")
def _(t):
    return t.orders.filter(F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp_ntz"),
                                                        F.lit("1996-06-30").cast("timestamp_ntz")))


@query("P19_positional_slice", """
SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i FROM orders)
WHERE i >= 100 AND i < 9000 AND (i - 100) % 3 = 0""")
def _(t):
    return project.positional(t.orders.select("o_orderdate", "o_orderkey", "o_totalprice"), ["o_orderdate", "o_orderkey"],
                              100, 9000, 3).drop("o_orderdate")


@query("P20_label_lookup", """
SELECT n.* FROM nation n SEMI JOIN (SELECT DISTINCT s_nationkey FROM supplier WHERE s_acctbal > 9000) s ON n_nationkey = s_nationkey
UNION ALL SELECT * FROM nation WHERE n_name IN ('NATION_3', 'NATION_7')""")
def _(t):
    keys = t.supplier.filter("s_acctbal > 9000").select(F.col("s_nationkey").alias("n_nationkey"))
    by_frame = t.nation.join(keys, "n_nationkey", "left_semi")
    return by_frame.unionByName(t.nation.filter(F.col("n_name").isin("NATION_3", "NATION_7")))


@query("P21_partial_key", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL""")
def _(t):
    composite = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    return composite.filter(F.col("l_linestatus") == "F")


@query("P22_partial_date", "SELECT * FROM orders WHERE year(o_orderdate) = 1997")
def _(t):
    # A half-open range rather than year(): it reaches the scan and prunes row groups.
    d = F.col("o_orderdate")
    return t.orders.filter((d >= F.lit("1997-01-01").cast("timestamp_ntz")) & (d < F.lit("1998-01-01").cast("timestamp_ntz")))


@query("P23_word_list_filter", """
SELECT doc_id FROM documents WHERE contains(text, 'tion') OR contains(text, 'http') OR contains(text, 'a.b')""")
def _(t):
    return project.contains_any(t.documents, "text", ["tion", "http", "a.b"]).select("doc_id")


@query("P24_substring_count", """
SELECT lang, count(*) FILTER (contains(text, 'the')) AS with_word, count(*) FILTER (NOT contains(text, 'the')) AS without_word
FROM documents GROUP BY lang""")
def _(t):
    hit = F.col("text").contains("the")
    return t.documents.groupBy("lang").agg(F.count_if(hit).alias("with_word"), F.count_if(~hit).alias("without_word"))


@query("P25_distinct_values", "SELECT DISTINCT o_orderpriority FROM orders ORDER BY 1")
def _(t):
    return t.orders.select("o_orderpriority").distinct().orderBy("o_orderpriority")


@query("P26_any_all", """
SELECT l_returnflag, bool_or(l_quantity > 49) AS any_large, bool_and(l_quantity > 0) AS all_positive,
       count(*) FILTER (l_discount > 0 AND l_tax > 0) AS row_all, count(*) FILTER (l_discount > 0 OR l_tax > 0) AS row_any
FROM lineitem GROUP BY 1""")
def _(t):
    cells = F.array("l_discount", "l_tax")
    return t.lineitem.groupBy("l_returnflag").agg(
        F.bool_or(F.col("l_quantity") > 49).alias("any_large"), F.bool_and(F.col("l_quantity") > 0).alias("all_positive"),
        F.count_if(F.forall(cells, lambda x: x > 0)).alias("row_all"),
        F.count_if(F.exists(cells, lambda x: x > 0)).alias("row_any"))


@query("P27_transpose", """
SELECT 'r_name' AS column_name, max(CASE WHEN r_regionkey = 0 THEN r_name END) AS "0", max(CASE WHEN r_regionkey = 1 THEN r_name END) AS "1",
  max(CASE WHEN r_regionkey = 2 THEN r_name END) AS "2", max(CASE WHEN r_regionkey = 3 THEN r_name END) AS "3",
  max(CASE WHEN r_regionkey = 4 THEN r_name END) AS "4" FROM region""")
def _(t):
    return project.transpose(t.region, "r_regionkey", [0, 1, 2, 3, 4])


@query("P28_minus_row", f"""
WITH r AS (SELECT l_quantity q, l_extendedprice p FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 1)
SELECT {LINE_ID}, l_quantity - (SELECT q FROM r) AS l_quantity, round(l_extendedprice - (SELECT p FROM r), 2) + 0.0 AS l_extendedprice FROM lineitem""")
def _(t):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    first = li.orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").limit(1)
    return project.minus_row(li, first, ["l_quantity", "l_extendedprice"]).withColumn(
        "l_extendedprice", F.round("l_extendedprice", 2))


@query("P29_centre", """
SELECT p_partkey, round(p_size - avg(p_size) OVER (), 4) AS p_size, round(p_retailprice - avg(p_retailprice) OVER (), 4) + 0.0 AS p_retailprice FROM part""")
def _(t):
    c = project.centre(t.part.select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"])
    return c.select("p_partkey", F.round("p_size", 4).alias("p_size"), F.round("p_retailprice", 4).alias("p_retailprice"))
