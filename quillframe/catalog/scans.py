"""Sources and sinks."""

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from quillframe.operators import inspect
from quillframe.registry import query
from quillframe.sources import accesslog, files, fixedwidth, sinks


@query("S01_csv_scan", """
SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN NULL ELSE n_name END AS n_name, n_regionkey FROM nation""")
def _(t):
    path = t.scratch("csv")
    t.nation.withColumn("n_name", F.expr("CASE WHEN n_regionkey <> 0 THEN n_name END")).write.csv(path, header=True)
    return files.read_csv(t.spark, path, "n_nationkey int, n_name string, n_regionkey int")


@query("S02_csv_dates", "SELECT event_id, date_trunc('second', ts) AS ts, value FROM events")
def _(t):
    path = t.scratch("dates")
    t.events.select("event_id", F.date_format("ts", "dd.MM.yyyy HH:mm:ss").alias("ts"), "value").write.csv(path, header=True)
    return files.read_csv(t.spark, path, "event_id bigint, ts timestamp_ntz, value double",
                          timestamp_format="dd.MM.yyyy HH:mm:ss")


@query("S03_csv_converter", """
SELECT event_id, CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS split FROM events""")
def _(t):
    path = t.scratch("split")
    t.events.select("event_id", F.date_format("ts", "H:mm:ss").alias("split")).write.csv(path, header=True)
    raw = files.read_csv(t.spark, path, "event_id bigint, split string")
    return files.convert(raw, {"split": files.duration_seconds})


@query("S04_tsv_load", "SELECT * FROM orders")
def _(t):
    tsv, table = t.scratch("tsv"), t.scratch("loaded")
    sinks.write_csv_plain(t.orders, tsv, sep="\t")
    files.read_csv(t.spark, tsv, t.orders.schema, header=False, sep="\t").write.parquet(table)
    return t.spark.read.schema(t.orders.schema).parquet(table)


@query("S05_load_errors", """
SELECT o_orderstatus = 'P' AS rejected, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM orders GROUP BY 1""")
def _(t):
    path = t.scratch("bad")
    t.orders.select(F.concat_ws(",", "o_orderkey", F.expr(
        "CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_totalprice AS string) END"))).write.text(path)
    schema = StructType([StructField("key", LongType()), StructField("price", DoubleType())])
    good, bad = files.quarantine(t.spark, path, schema)
    key = F.split(files.CORRUPT, ",")[0].cast("bigint")
    both = good.select(F.lit(False).alias("rejected"), "key").union(bad.select(F.lit(True), key))
    return both.groupBy("rejected").agg(
        F.count("*").alias("n"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))


@query("S06_json_scan", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def _(t):
    path = t.scratch("json")
    t.events.select("event_id", F.from_json("props", "k int").alias("props")).write.json(path)
    return t.spark.read.schema("event_id bigint, props struct<k:int>").json(path).select("event_id", "props.k")


@query("S07_json_repair", """
SELECT event_type = 'error' AS broken,
       CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k, count(*) AS n
FROM events GROUP BY ALL""")
def _(t):
    path = t.scratch("jsonl")
    t.events.select(F.expr(
        "CASE WHEN event_type = 'error' THEN substring(props, 1, length(props) - 1) ELSE props END")).write.text(path)
    rows = files.read_json_lines(t.spark, path, "k int")
    return (rows.select(F.col(files.CORRUPT).isNotNull().alias("broken"), "k")
            .withColumn("k", F.expr("CASE WHEN NOT broken THEN k END"))
            .groupBy("broken", "k").agg(F.count("*").alias("n")))


@query("S08_text_glob", r"""
SELECT lang, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS lines FROM documents GROUP BY lang""")
def _(t):
    path = t.scratch("text")
    t.documents.select("text", "lang").write.partitionBy("lang").option("lineSep", "\n").text(path)
    rows = files.read_lines(t.spark, f"{path}/lang=*/*")
    return rows.groupBy(files.partition_value(F.col("path"), "lang").alias("lang")).agg(F.count("*").alias("lines"))


DICTIONARY = [
    "infile dictionary {",
    '   _column(1)   long    C_CustKey    %12f  "CUSTOMER NUMBER"',
    '   _column(13)  str22   C_Name       %22s  "NAME"',
    '   _column(35)  byte    C_NationKey  %4f   "NATION"',
    '   _column(39)  double  C_AcctBal    %14f  "BALANCE"',
    "}",
]


@query("S09_fixed_width", """
SELECT c_custkey, c_name, CAST(c_nationkey AS TINYINT) AS c_nationkey, c_acctbal FROM customer""")
def _(t):
    path = t.scratch("fixed")
    t.customer.select(F.concat(
        F.lpad(F.col("c_custkey").cast("string"), 12, " "), F.rpad("c_name", 22, " "),
        F.lpad(F.col("c_nationkey").cast("string"), 4, " "), F.lpad(F.col("c_acctbal").cast("string"), 14, " "),
    )).write.text(path)
    return fixedwidth.read_fixed_width(t.spark, path, fixedwidth.parse_dictionary(DICTIONARY))


LOG_LINE = """
concat('owner', CAST(event_id % 7 AS string), ' bucket [',
  CASE WHEN event_type = 'error' THEN 'AB/Jan/2024:00:00:00 +0000'
       ELSE date_format(ts, 'dd/MMM/yyyy:HH:mm:ss') || ' +0000' END,
  '] 10.0.0.', CAST(user_id % 250 AS string), ' user', CAST(user_id AS string), ' req', CAST(event_id AS string),
  ' REST.', upper(event_type), '.OBJECT path/file.pdf "GET /path/file.pdf HTTP/1.1" 200 - - 4000 18 - "-" "agent/',
  CAST(user_id % 3 AS string), '" tail')"""


def log_lines(t):
    """Access-log lines written from the events table and read back as text."""
    path = t.scratch("log")
    t.events.select(F.expr(LOG_LINE)).write.text(path)
    return files.read_lines(t.spark, path)


@query("S10_access_log", """
SELECT 'req' || event_id AS request_id, 'user' || user_id AS requester, 'REST.' || upper(event_type) || '.OBJECT' AS operation,
       'agent/' || (user_id % 3) AS user_agent, '200' AS status, 'GET /path/file.pdf HTTP/1.1' AS request,
       event_type <> 'error' AS ok FROM events""")
def _(t):
    return accesslog.parse(log_lines(t)).select(
        "request_id", "requester", "operation", "user_agent", "status", "request", "ok")


@query("F25_log_timestamp", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS log_date,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS log_time,
       CASE WHEN event_type <> 'error' THEN '+0000' END AS log_zone FROM events""")
def _(t):
    return accesslog.parse(log_lines(t)).select(
        F.substring("request_id", 4, 20).cast("bigint").alias("event_id"), "log_date", "log_time", "log_zone")


@query("A26_daily_requests", """
SELECT strftime(ts, '%Y-%m-%d') || ' 00:00:00' AS date_time, 'user' || user_id AS requester, 'agent/' || (user_id % 3) AS user_agent,
       'REST.' || upper(event_type) || '.OBJECT' AS operation, NULL::VARCHAR AS error_req, count(*) AS n
FROM events WHERE event_type <> 'error' GROUP BY ALL
UNION ALL SELECT NULL, NULL, NULL, NULL, 'req' || event_id, count(*) FROM events WHERE event_type = 'error' GROUP BY ALL""")
def _(t):
    rolled = accesslog.daily_requests(accesslog.parse(log_lines(t)))
    req = F.regexp_extract("error_line", r" (req\d+) ", 1)
    return rolled.withColumn("error_req", F.when(F.col("error_line").isNotNull(), req)).drop("error_line")


@query("S11_labelled_folders", r"""
SELECT lang AS class, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS label, n FROM (
  SELECT lang, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n FROM documents GROUP BY lang)""")
def _(t):
    path = t.scratch("classes")
    t.documents.select("text", "lang").write.partitionBy("lang").option("lineSep", "\n").text(path)
    # Folder names of the classes: a handful, one per language.
    classes = sorted(f"lang={r.lang}" for r in t.documents.select("lang").distinct().collect())
    rows = files.labelled_folders(t.spark, path, classes, min_rows=1)
    return rows.groupBy(F.substring_index("class", "=", -1).alias("class"), "label").agg(F.count("*").alias("n"))


STATUS_ROWS = [("O", "open"), ("F", "finished"), ("P", "pending")]
PRIORITY_RECORDS = [{"code": "1-URGENT", "days": 1}, {"code": "2-HIGH", "days": 3},
                    {"code": "3-MEDIUM"}, {"code": "5-LOW", "days": 30}]


@query("S12_local_rows", """
SELECT name, count(*) AS n FROM orders JOIN (VALUES ('O', 'open'), ('F', 'finished'), ('P', 'pending')) v(status, name)
  ON o_orderstatus = status GROUP BY name""")
def _(t):
    names = t.spark.createDataFrame(STATUS_ROWS, "status string, name string")
    counts = t.orders.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
    return counts.join(names, "status").select("name", "n")


@query("S13_records", """
SELECT code, days, count(o_orderkey) AS n
FROM (VALUES ('1-URGENT', 1), ('2-HIGH', 3), ('3-MEDIUM', NULL), ('5-LOW', 30)) v(code, days)
LEFT JOIN orders ON o_orderpriority = code GROUP BY code, days""")
def _(t):
    # A key missing from a record is null; the column order is the schema's.
    records = t.spark.createDataFrame(PRIORITY_RECORDS, "code string, days int")
    counts = t.orders.groupBy(F.col("o_orderpriority").alias("code")).agg(F.count("*").alias("n"))
    return records.join(counts, "code", "left").select("code", "days", F.coalesce("n", F.lit(0)).alias("n"))


@query("S14_csv_sink", "SELECT r_regionkey, r_name FROM region")
def _(t):
    path = t.scratch("plain")
    sinks.write_csv_plain(t.region, path)
    return files.read_csv(t.spark, path, "r_regionkey int, r_name string", header=False)


@query("S15_text_sink", "SELECT p_name AS line, count(*) AS n FROM part GROUP BY p_name")
def _(t):
    path = t.scratch("lines")
    sinks.write_text(t.part.select("p_name"), path)
    return files.read_lines(t.spark, path).groupBy("line").agg(F.count("*").alias("n"))


@query("S17_split_files", "SELECT count(*) AS n, true AS within_limit FROM orders")
def _(t):
    path = t.scratch("split")
    sinks.write_split(t.orders, path, 802)
    per_file = (t.spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f"))
                .agg(F.count("*").alias("n")))
    return per_file.agg(F.sum("n").alias("n"), F.bool_and(F.col("n") <= 802).alias("within_limit"))


@query("S18_compaction", """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1""")
def _(t):
    small, merged = t.scratch("small"), t.scratch("merged")
    day = F.date_format("ts", "yyyy-MM-dd")
    t.events.withColumn("day", day).repartition(16).write.partitionBy("day").parquet(small)
    rows = t.spark.read.parquet(small).drop("day").withColumn(
        "day_key", files.partition_value(F.col("_metadata.file_path"), "day"))
    sinks.compact(rows, merged, "day_key", rows_per_file=1_000_000)
    back = t.spark.read.schema("event_id bigint, value double, day_key string").parquet(merged)
    return back.groupBy(F.col("day_key").alias("day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("S18_compaction_by_bytes", """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, true AS within_target, true AS fewer_files FROM events GROUP BY 1""")
def _(t):
    # Uneven text files: the tasks that wrote them hold a growing share of each day.
    small, merged = t.scratch("small"), t.scratch("merged")
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    uneven = F.floor(F.pow(F.pmod(F.xxhash64("event_id"), F.lit(997)) / 997.0, F.lit(3.0)) * 24).cast("int")
    t.events.select(line.alias("value"), F.date_format("ts", "yyyy-MM-dd").alias("day"), uneven.alias("task")).write.partitionBy("day", "task").text(small)
    # Of its size with the input: files that are larger than the target can't become fewer.
    sizes = t.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(small).select("length", files.partition_value(F.col("path"), "day").alias("day"))
    day_bytes = sizes.agg(F.coalesce(F.floor(F.sum("length") / F.count_distinct("day")), F.lit(0))).first()[0]
    target = max(16_384, day_bytes // 6)
    before = sinks.compact_lines(t.spark, small, merged, "day=([0-9-]+)", target).groupBy(F.col("group").alias("day")).agg(F.count("*").alias("_before"))
    found = t.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(merged).select("path", "length")
    after = found.groupBy(files.partition_value(F.col("path"), "group").alias("day")).agg(F.max("length").alias("_most"), F.count("*").alias("_after"))
    lines = t.spark.read.option("recursiveFileLookup", "true").text(merged).groupBy(files.partition_value(F.col("_metadata.file_path"), "group").alias("day")).agg(F.count("*").alias("n"))
    both = lines.join(after, "day").join(before, "day")
    return both.select("day", "n", (F.col("_most") <= target + 256).alias("within_target"), (F.col("_after") < F.col("_before")).alias("fewer_files"))


@query("S19_table_layout", """
SELECT p_brand, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def _(t):
    paths = {n: t.scratch(n) for n in ("fact", "dim")}
    tables = {n: "t_" + p.rsplit("-", 1)[1] for n, p in paths.items()}
    buckets = sinks.buckets_for(t.lineitem, 8)
    sinks.write_bucketed(t.lineitem, tables["fact"], paths["fact"], "l_partkey", buckets, ["l_partkey", "l_shipdate"])
    sinks.write_bucketed(t.part, tables["dim"], paths["dim"], "p_partkey", buckets)
    fact, dim = t.spark.table(tables["fact"]), t.spark.table(tables["dim"])
    return (fact.join(dim, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand")
            .agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")))


@query("S20_sql_text", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 1000 AND c_mktsegment = 'MACHINERY'""")
def _(t):
    t.customer.createOrReplaceTempView("quillframe_customer")
    return t.spark.sql(
        "SELECT c_custkey, c_name, c_acctbal FROM quillframe_customer WHERE c_acctbal > :low AND c_mktsegment = :seg",
        args={"low": 1000, "seg": "MACHINERY"})


@query("S21_column_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) AS n_rows FROM orders"
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")))
def _(t):
    return inspect.column_counts(t.orders)


@query("S21_head_tail", """
(SELECT 'head' AS part, * FROM orders ORDER BY o_orderkey LIMIT 5) UNION ALL
(SELECT 'tail' AS part, * FROM orders ORDER BY o_orderkey DESC LIMIT 5)""")
def _(t):
    return inspect.head_tail(t.orders, ["o_orderkey"], 5)
