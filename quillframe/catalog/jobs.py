"""User functions and iterative jobs."""

from pyspark.sql import functions as F

from quillframe.operators import userfn
from quillframe.registry import query


@query("X01_elementwise", "SELECT p_partkey, printf('%.2f', p_retailprice) AS builtin, 2.0 * p_retailprice + 1 AS p_retailprice FROM part")
def _(t):
    p = t.part.select("p_partkey", F.format_string("%.2f", "p_retailprice").alias("builtin"), "p_retailprice")
    return userfn.map_values(p, ["p_retailprice"], lambda s: 2.0 * s + 1, "double")


@query("X02_column_row_functions", """
SELECT p_partkey, greatest(p_size::DOUBLE, p_retailprice) - least(p_size::DOUBLE, p_retailprice) AS spread,
 p_retailprice - (SELECT min(p_retailprice) FROM part) AS above_min, (SELECT max(p_size) FROM part) AS top_size FROM part""")
def _(t):
    s = t.part.agg(F.struct(F.min("p_retailprice").alias("lo"), F.max("p_size").alias("hi"))).scalar()
    a, b = F.col("p_size").cast("double"), F.col("p_retailprice")
    return t.part.select("p_partkey", (F.greatest(a, b) - F.least(a, b)).alias("spread"), (b - s["lo"]).alias("above_min"), s["hi"].alias("top_size"))


@query("X03_partition_function", "SELECT doc_id, length(text) AS n FROM documents")
def _(t):
    return userfn.map_partitions(
        t.documents.select("doc_id", "text"), "doc_id bigint, n bigint", dict,
        lambda cache, pdf: pdf[["doc_id"]].assign(n=pdf["text"].str.len()), lambda cache: cache.clear())


@query("X04_shared_intermediate", """
SELECT 'flag' AS by, l_returnflag AS key, count(*) AS n FROM lineitem GROUP BY 2
UNION ALL SELECT 'status', l_linestatus, count(*) FROM lineitem GROUP BY 2""")
def _(t):
    out = t.scratch("shared")
    with userfn.shared(t.lineitem.select("l_returnflag", "l_linestatus")) as kept:
        for by, col in (("flag", "l_returnflag"), ("status", "l_linestatus")):
            kept.groupBy(F.col(col).alias("key")).agg(F.count("*").alias("n")).select(
                F.lit(by).alias("by"), "key", "n").write.mode("append").parquet(out)
    return t.spark.read.parquet(out)


@query("X05_iterate", "SELECT o_orderkey + 20 AS o_orderkey, o_custkey FROM orders")
def _(t):
    step = lambda df: df.select((F.col("o_orderkey") + 1).alias("o_orderkey"), "o_custkey")
    return userfn.iterate(t.orders.select("o_orderkey", "o_custkey"), step, times=20, every=10)
