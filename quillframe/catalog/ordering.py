"""Sort, limit, top-k, sampling."""

from pyspark.sql import functions as F

from quillframe.operators import inspect, ordering
from quillframe.registry import query

LINE = ["l_quantity", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("O01_sort", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderstatus NULLS LAST, o_totalprice NULLS LAST, o_orderkey""")
def _(t):
    return ordering.sort_values(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), ["o_orderstatus", "o_totalprice", "o_orderkey"])


@query("O02_sort_key", "SELECT * FROM nation ORDER BY n_nationkey")
def _(t):
    return t.nation.orderBy("n_nationkey")


@query("O03_sort_columns", "SELECT p_type, p_size, p_retailprice, p_partkey, p_name, p_brand FROM part")
def _(t):
    return ordering.sort_columns(t.part, ascending=False)


@query("O04_first_last", """
(SELECT 'head' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10) UNION ALL
(SELECT 'tail' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10)""")
def _(t):
    return inspect.head_tail(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 10)


@query("O05_top_users", "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 5")
def _(t):
    return t.events.groupBy("user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "user_id").limit(5)


@query("O06_arg_sort", f"SELECT {', '.join(LINE)}, row_number() OVER (ORDER BY {', '.join(LINE)}) - 1 AS position FROM lineitem")
def _(t):
    return ordering.arg_sort(t.lineitem.select(*LINE), LINE)


@query("O07_k_smallest", "SELECT l_extendedprice, l_orderkey FROM lineitem ORDER BY 1, 2 LIMIT 20")
def _(t):
    return ordering.smallest(t.lineitem.select("l_extendedprice", "l_orderkey"), ["l_extendedprice", "l_orderkey"], 20)


@query("O07_k_smallest_per_group", """
SELECT l_returnflag, l_extendedprice, l_orderkey, l_partkey, CAST(r AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice, l_orderkey, l_partkey) AS r FROM lineitem) WHERE r <= 4""")
def _(t):
    cols = ["l_extendedprice", "l_orderkey", "l_partkey"]
    return ordering.smallest_per_group(t.lineitem.select("l_returnflag", *cols), ["l_returnflag"], cols, 4)


@query("O07_k_smallest_array", """
SELECT vec_id, [round(x::DOUBLE, 6) + 0.0 for x in list_sort(embedding)[1:3]] AS smallest FROM embeddings""")
def _(t):
    return t.embeddings.select("vec_id", F.transform(
        F.slice(F.array_sort("embedding"), 1, 3), lambda x: F.round(x.cast("double"), 6)).alias("smallest"))


@query("O08_sort_by_length", "SELECT p_name, count(*) AS n FROM part GROUP BY 1 ORDER BY length(p_name), p_name")
def _(t):
    return t.part.groupBy("p_name").agg(F.count("*").alias("n")).orderBy(F.length("p_name"), "p_name")


@query("O09_sample", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('11-' || o_orderkey) LIMIT 50")
def _(t):
    return ordering.sample(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 50, seed=11)


@query("O10_shuffle", "SELECT doc_id, row_number() OVER (ORDER BY md5('5-' || doc_id)) - 1 AS position FROM documents")
def _(t):
    return ordering.shuffle(t.documents.select("doc_id"), ["doc_id"], seed=5)
