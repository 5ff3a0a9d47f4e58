"""Set operations and concatenation."""

from pyspark.sql import functions as F

from quillframe.operators import sets
from quillframe.registry import query


def people(t):
    c = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("suppkey"))
    return c, s


@query("U01_concat_all", """
SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL::BIGINT AS suppkey FROM customer
UNION ALL SELECT s_name, s_acctbal, NULL, s_suppkey FROM supplier""")
def _(t):
    return sets.concat_all(*people(t))


@query("U02_concat_common", "SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier")
def _(t):
    return sets.concat_common(*people(t))


@query("U03_concat_checked", "SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier")
def _(t):
    c, s = people(t)
    return sets.concat_checked("name", c.drop("segment"), s.drop("suppkey"))


@query("U04_concat_numbered", """
SELECT name, row_number() OVER (ORDER BY src, name) - 1 AS row FROM
  (SELECT 0 AS src, c_name AS name FROM customer UNION ALL SELECT 1, s_name FROM supplier)""")
def _(t):
    return sets.concat_numbered("name", *[f.select("name") for f in people(t)])


@query("U05_concat_labelled", """
SELECT 'x' AS source, c_name AS name FROM customer UNION ALL SELECT 'y', s_name FROM supplier""")
def _(t):
    c, s = people(t)
    return sets.concat_labelled({"x": c.select("name"), "y": s.select("name")})


A = "(SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 200000)"
B = "(SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000)"


def key_sets(t):
    o = t.orders.filter("o_totalprice > 200000")
    return [o.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k")) for s in "OF"]


@query("U06_set_algebra", f"""
SELECT 'union' AS op, k FROM (FROM {A} UNION FROM {B}) UNION ALL SELECT 'intersect', k FROM (FROM {A} INTERSECT FROM {B})
UNION ALL SELECT 'difference', k FROM (FROM {A} EXCEPT FROM {B})
UNION ALL SELECT 'symmetric', k FROM ((FROM {A} EXCEPT FROM {B}) UNION ALL (FROM {B} EXCEPT FROM {A}))""")
def _(t):
    a, b = key_sets(t)
    ops = {"union": a.union(b).distinct(), "intersect": a.intersect(b), "difference": a.subtract(b),
           "symmetric": sets.symmetric_difference(a, b)}
    return sets.concat_labelled(ops, "op")


@query("U07_subset", f"""
SELECT 'set' AS kind, (SELECT count(*) FROM (FROM {A} EXCEPT SELECT c_custkey FROM customer)) = 0 AS subset
UNION ALL SELECT 'multiset', (SELECT count(*) FROM (SELECT o_custkey FROM orders EXCEPT ALL SELECT c_custkey FROM customer)) = 0""")
def _(t):
    a, _b = key_sets(t)
    keys = t.customer.select(F.col("c_custkey").alias("k"))
    return sets.concat_labelled({"set": sets.is_subset(a, keys),
                                 "multiset": sets.is_subset(t.orders.select("o_custkey"), keys, multiset=True)}, "kind")


@query("U08_multiset_subtract", """
SELECT l_quantity, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END) AS BIGINT) AS n FROM lineitem
WHERE l_returnflag IN ('R', 'A') GROUP BY 1""")
def _(t):
    return sets.subtract_counts(t.lineitem.filter("l_returnflag = 'R'"), t.lineitem.filter("l_returnflag = 'A'"), "l_quantity")


@query("U09_uniqueness", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, max(n) = 1 AS is_unique, count(*) FILTER (n > 1) AS duplicates FROM (SELECT {c}, count(*) AS n FROM orders GROUP BY 1)"
    for c in ("o_orderkey", "o_custkey", "o_orderdate")))
def _(t):
    return sets.uniqueness(t.orders, ["o_orderkey", "o_custkey", "o_orderdate"])


@query("U10_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def _(t):
    return t.events.select("user_id", "event_type").dropDuplicates()


@query("U11_split_at", """
SELECT c_custkey, (i >= 300)::INT + (i >= 1000)::INT AS part FROM
  (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS i FROM customer)""")
def _(t):
    c = t.customer.select("c_custkey", "c_acctbal")
    return sets.split_at(c, ["c_acctbal", "c_custkey"], [300, 1000]).drop("c_acctbal")


@query("U11_column_blocks", "SELECT o_orderstatus, o_totalprice, o_orderdate FROM orders")
def _(t):
    return sets.column_blocks(t.orders, [2, 5])[1]
