"""Time-series operators."""

from pyspark.sql import functions as F

from quillframe.catalog.joins import DAILY, daily
from quillframe.flagship import daily_activity
from quillframe.operators import aggregate as agg
from quillframe.operators import timeseries as ts
from quillframe.registry import query

SPINE = """(SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM
 (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders))"""
SPARSE = """(SELECT CAST(o_orderdate AS DATE) AS day, round(sum(o_totalprice), 2) AS total FROM orders
 WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' GROUP BY 1)"""


def sparse(t):
    o = t.orders.filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    return o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


def days(t):
    return ts.spine(ts.extent(t.orders, "o_orderdate"), "interval 1 day")


@query("flagship_daily_activity", """
WITH c AS (SELECT CAST(ts AS DATE) AS day, user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY n DESC, user_id, event_type) AS rank FROM c),
d AS (SELECT day, CAST(sum(n) AS BIGINT) AS day_total FROM c GROUP BY 1),
m AS (SELECT *, CASE WHEN count(*) OVER w = 7 THEN round(avg(day_total) OVER w, 6) END AS week_mean FROM d WINDOW w AS (ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))
SELECT day, CAST(rank AS INTEGER) AS rank, user_id, event_type, n, day_total, week_mean FROM r JOIN m USING (day) WHERE rank <= 5""")
def _(t):
    return daily_activity(t.events)


@query("T01_date_spine", f"SELECT day, CAST(coalesce(n, 0) AS BIGINT) AS n FROM {SPINE} LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) USING (day)")
def _(t):
    n = t.orders.filter("o_orderstatus = 'P'").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return days(t).join(n, "day", "left").fillna({"n": 0})


@query("T01_interval_spine", """
SELECT unnest(generate_series(lo, hi, INTERVAL 150 MINUTE)) AS at FROM (SELECT date_trunc('hour', min(ts)) AS lo, max(ts) AS hi FROM events)""")
def _(t):
    bounds = t.events.agg(F.date_trunc("hour", F.min("ts")).cast("timestamp_ntz").alias("lo"), F.max("ts").alias("hi"))
    return ts.spine(bounds, "interval 2 hours 30 minutes", "at")


@query("T01_month_periods", """
SELECT CAST(unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS DATE) AS period FROM
 (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)""")
def _(t):
    b = ts.extent(t.orders, "o_orderdate").select(F.trunc("lo", "month").alias("lo"), "hi")
    return ts.spine(b, "interval 1 month", "period")


@query("T02_business_days", f"SELECT day FROM {SPINE} WHERE isodow(day) < 6")
def _(t):
    return ts.business_days(days(t))


def _last(unit):
    return f"CAST(date_trunc('{unit}', day) + INTERVAL 1 {unit.upper()} - INTERVAL 1 DAY AS DATE)"


RULES = {"BM": _last("month"), "BQ": _last("quarter"), "BA": _last("year"), "MS": "CAST(date_trunc('month', day) AS DATE)",
         "QS": "CAST(date_trunc('quarter', day) AS DATE)", "AS": "CAST(date_trunc('year', day) AS DATE)"}


@query("T02_anchors", " UNION ALL ".join(
    f"SELECT DISTINCT '{k}' AS rule, " + (f"CAST(e - CAST(greatest(isodow(e) - 5, 0) AS INTEGER) AS DATE)" if k[0] == "B" else "e") + f" AS day FROM (SELECT {v} AS e FROM {SPINE})"
    for k, v in RULES.items()))
def _(t):
    frames = [ts.anchors(days(t), k).select(F.lit(k).alias("rule"), "day") for k in RULES]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return out


@query("T03_resample", """
SELECT 'D' AS rule, CAST(ts AS DATE) AS day, round(sum(value), 2) AS v FROM events GROUP BY ALL
UNION ALL SELECT 'W', CAST(date_trunc('week', ts) + INTERVAL 6 DAY AS DATE), round(sum(value), 2) FROM events GROUP BY ALL""")
def _(t):
    total = {"v": F.round(F.sum("value"), 2)}
    return ts.resample(t.events, "ts", "D", total).select(F.lit("D").alias("rule"), "day", "v").unionAll(
        ts.resample(t.events, "ts", "W", total).select(F.lit("W").alias("rule"), "day", "v"))


@query("T03_resample_year", """
SELECT CAST(e - CAST(greatest(isodow(e) - 5, 0) AS INTEGER) AS DATE) AS day, round(avg(p), 5) AS mean FROM
 (SELECT CAST(date_trunc('year', o_orderdate) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS e, o_totalprice AS p FROM orders) GROUP BY 1""")
def _(t):
    return ts.resample(t.orders, "o_orderdate", "BA", {"mean": F.round(F.avg("o_totalprice"), 5)})


@query("T03_empty_buckets", f"""
SELECT day, coalesce(total, 0.0::DOUBLE) AS total FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM
 (SELECT CAST(min(day) AS TIMESTAMP) AS lo, CAST(max(day) AS TIMESTAMP) AS hi FROM {SPARSE})) LEFT JOIN {SPARSE} USING (day)""")
def _(t):
    return ts.fill_buckets(sparse(t), "day", "interval 1 day", {"total": 0.0})


@query("T04_asfreq", f"""
SELECT a.day, total FROM (SELECT DISTINCT CAST(e - CAST(greatest(isodow(e) - 5, 0) AS INTEGER) AS DATE) AS day FROM
 (SELECT {_last('month')} AS e FROM {SPINE})) a LEFT JOIN {SPARSE} s ON a.day = s.day""")
def _(t):
    return ts.as_freq(sparse(t), "day", ts.anchors(days(t), "BM"))




@query("T05_upsample_null", f"SELECT day, total FROM {SPINE} LEFT JOIN {SPARSE} USING (day)")
def _(t):
    return ts.as_freq(sparse(t), "day", days(t))


@query("T05_upsample_ffill", f"SELECT d.day, s.total FROM {SPINE} d ASOF LEFT JOIN {SPARSE} s ON d.day >= s.day")
def _(t):
    return ts.as_freq(sparse(t), "day", days(t), "ffill")


@query("T05_upsample_bfill", f"SELECT d.day, s.total FROM {SPINE} d ASOF LEFT JOIN {SPARSE} s ON d.day <= s.day")
def _(t):
    return ts.as_freq(sparse(t), "day", days(t), "bfill")


@query("T06_profiles", """
SELECT 'hour' AS by, hour(ts) AS slot, round(avg(value), 8) AS mean FROM events GROUP BY ALL
UNION ALL SELECT 'weekday', isodow(ts) - 1, round(avg(value), 8) FROM events GROUP BY ALL""")
def _(t):
    mean = F.round(F.avg("value"), 8).alias("mean")
    h = t.events.groupBy(F.hour("ts").cast("bigint").alias("slot")).agg(mean).select(F.lit("hour").alias("by"), "slot", "mean")
    return h.unionAll(t.events.groupBy(F.weekday("ts").cast("bigint").alias("slot")).agg(mean).select(F.lit("weekday"), "slot", "mean"))


@query("T07_weekend_profile", """
SELECT CASE WHEN isodow(ts) < 6 THEN 'Weekday' ELSE 'Weekend' END AS kind, hour(ts) AS hour, round(avg(value), 8) AS mean FROM events GROUP BY ALL""")
def _(t):
    kind = F.when(F.weekday("ts") < 5, "Weekday").otherwise("Weekend").alias("kind")
    return t.events.groupBy(kind, F.hour("ts").cast("bigint").alias("hour")).agg(F.round(F.avg("value"), 8).alias("mean"))


@query("T08_calendar_day", """
SELECT month(o_orderdate) AS month, day(o_orderdate) AS day, round(avg(o_totalprice), 6) AS mean FROM orders GROUP BY ALL""")
def _(t):
    return t.orders.groupBy(F.month("o_orderdate").cast("bigint").alias("month"), F.dayofmonth("o_orderdate").cast("bigint").alias("day")).agg(
        F.round(F.avg("o_totalprice"), 6).alias("mean"))


@query("T09_weekday_decade", "SELECT isodow(o_orderdate) - 1 AS weekday, " + ", ".join(
    f'round(avg(o_totalprice) FILTER (year(o_orderdate) // 10 * 10 = {d}), 6) AS "{d}"' for d in (1990, 2000)) + " FROM orders GROUP BY 1")
def _(t):
    o = t.orders.select(F.weekday("o_orderdate").cast("bigint").alias("weekday"), (F.floor(F.year("o_orderdate") / 10) * 10).alias("decade"), "o_totalprice")
    return agg.pivot(o, ["weekday"], "decade", [1990, 2000], {"m": F.round(F.avg("o_totalprice"), 6)})


@query("T10_lag_correlation", f"""
SELECT round(corr(x, y), 9) AS correlation FROM (SELECT total AS x, lag(total, 2) OVER (ORDER BY day) AS y FROM {DAILY}) WHERE y IS NOT NULL""")
def _(t):
    return ts.serial_correlation(daily(t), "day", "total", 2).select(F.round("correlation", 9).alias("correlation"))
