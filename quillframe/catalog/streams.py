"""Streams. The events arrive in shards; each arrival is one micro-batch, resumed from the checkpoint."""

from pyspark.sql import functions as F

from quillframe.registry import query
from quillframe.streaming import jobs, state

DAYS_PER_SHARD = 8
SHARD = f"CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // {DAYS_PER_SHARD} AS INTEGER)"


def arrivals(t):
    """Write the events as text once, split into shards, and let one shard after the other arrive in a folder.

    The folder is given out after each arrival. Shards are folders of files, so a move makes a whole one visible.
    """
    staged, path = t.scratch("staged"), t.scratch("arrivals")
    line = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "user_id", "event_type", "value")
    shard = F.floor(F.date_diff(F.to_date("ts"), t.events.agg(F.to_date(F.min("ts"))).scalar()) / DAYS_PER_SHARD)
    t.events.select(line.alias("value"), shard.alias("shard")).write.partitionBy("shard").text(staged)
    at = t.spark._jvm.org.apache.hadoop.fs.Path
    files = at(path).getFileSystem(t.spark._jsc.hadoopConfiguration())
    files.mkdirs(at(path))
    names = [f.getPath().getName() for f in files.listStatus(at(staged)) if f.isDirectory()]  # one name per shard
    for name in sorted(names, key=lambda n: int(n.partition("=")[2])):
        files.rename(at(staged, name), at(path, name))
        yield path


def actions(t, path):
    return jobs.parse_actions(jobs.stream_lines(t.spark, path))


def per_batch(t, transform):
    out, ckpt = t.scratch("batches"), t.scratch("state")
    for path in arrivals(t):
        jobs.to_batches(actions(t, path), transform, out, ckpt)
    return t.spark.read.parquet(out)


@query("D01_text_stream", "SELECT ts, user_id, event_type AS action, value FROM events")
def _(t):
    out, ckpt = t.scratch("rows"), t.scratch("state")
    for path in arrivals(t):
        jobs.to_files(actions(t, path), out, ckpt)
    return t.spark.read.parquet(out)


@query("D02_count_per_batch", f"SELECT {SHARD} AS batch_id, user_id, count(*) AS n FROM events GROUP BY ALL")
def _(t):
    return per_batch(t, jobs.count_by("user_id"))


@query("D03_top_per_batch", f"""
SELECT batch_id, user_id, n FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY n DESC, user_id) AS r FROM
 (SELECT {SHARD} AS batch_id, user_id, count(*) AS n FROM events GROUP BY ALL)) WHERE r <= 5""")
def _(t):
    return per_batch(t, jobs.top_by_count("user_id", 5))


@query("D04_file_sink", "SELECT event_type AS action, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def _(t):
    out, ckpt = t.scratch("sink"), t.scratch("state")
    for path in arrivals(t):
        jobs.to_files(actions(t, path), out, ckpt)
    return t.spark.read.parquet(out).groupBy("action").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("D05_running_total", "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def _(t):
    out, ckpt = t.scratch("updates"), t.scratch("state")
    for path in arrivals(t):
        jobs.to_batches(jobs.running_counts(actions(t, path), "user_id"), lambda b: b, out, ckpt, mode="update")
    state = jobs.latest(t.spark.read.parquet(out), ["user_id"], ["n", "total"])
    return state.withColumn("total", F.round("total", 2))


@query("D06_sliding_window", """
SELECT s AS start, s + INTERVAL 5 MINUTE AS end, user_id, count(*) AS n FROM (
 SELECT user_id, make_timestamp((epoch_us(ts) // 30000000 - i) * 30000000) AS s FROM events, range(10) r(i)) GROUP BY ALL""")
def _(t):
    out, ckpt = t.scratch("windows"), t.scratch("state")
    for path in arrivals(t):
        counts = jobs.sliding_counts(actions(t, path), "user_id", "5 minutes", "30 seconds", "10 minutes")
        jobs.to_batches(counts, lambda b: b, out, ckpt, mode="update")
    return jobs.latest(t.spark.read.parquet(out), ["start", "end", "user_id"], ["n"])


@query("D07_recovery", "SELECT event_type AS action, count(*) AS n FROM events GROUP BY 1")
def _(t):
    # Every arrival starts a new query from the same checkpoint; nothing is counted twice or lost.
    out, ckpt = t.scratch("updates"), t.scratch("state")
    for path in arrivals(t):
        for _restart in range(2):
            jobs.to_batches(jobs.running_counts(actions(t, path), "action"), lambda b: b, out, ckpt, mode="update")
    return jobs.latest(t.spark.read.parquet(out), ["action"], ["n"])


@query("D08_progress", f"SELECT {SHARD} AS batch_id, count(*) AS rows FROM events GROUP BY 1")
def _(t):
    out, ckpt = t.scratch("rows"), t.scratch("state")
    with jobs.ProgressTable(t.spark, t.scratch("progress")) as log:
        for path in arrivals(t):
            log.wait(jobs.to_files(actions(t, path), out, ckpt))
    return log.table().filter("rows > 0").select(F.col("batch_id").cast("int").alias("batch_id"), "rows")


@query("D01_running_stream", "SELECT ts, user_id, event_type AS action, value FROM events")
def _(t):
    # A query that keeps running while shards arrive; it is stopped once on the way and goes on from its checkpoint.
    out, ckpt, running = t.scratch("rows"), t.scratch("state"), None
    for i, path in enumerate(arrivals(t)):
        if running is None or i == 2:
            if running:
                running.stop()
            running = jobs.keep_running(jobs.file_writer(actions(t, path), out, ckpt), every="500 milliseconds")
        running.processAllAvailable()
    running.stop()
    return t.spark.read.parquet(out)


@query("D05_state_by_function", """
SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1""")
def _(t):
    out, ckpt = t.scratch("updates"), t.scratch("state")
    for path in arrivals(t):
        kept = state.update_state(actions(t, path), ["user_id"], state.running_total("value"), "n bigint, total double", "user_id bigint, n bigint, total double")
        jobs.to_batches(kept, lambda b: b, out, ckpt, mode="update")
    return jobs.latest(t.spark.read.parquet(out), ["user_id"], ["n", "total"]).withColumn("total", F.round("total", 2))


@query("D05_last_values", """
SELECT user_id, list(value ORDER BY ts, event_type, value)[-3:] AS recent FROM events GROUP BY 1""")
def _(t):
    out, ckpt = t.scratch("updates"), t.scratch("state")
    for path in arrivals(t):
        kept = state.update_state(actions(t, path), ["user_id"], state.last_values("value", ["ts", "action"], 3),
                                  "ts array<string>, action array<string>, value array<double>", "user_id bigint, recent array<double>")
        jobs.to_batches(kept, lambda b: b, out, ckpt, mode="update")
    return jobs.latest(t.spark.read.parquet(out), ["user_id"], ["recent"])
