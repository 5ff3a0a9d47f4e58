"""Storage access logs: field extraction, time normalisation, daily roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The 17 logical fields of a line, in order.
FIELDS = (
    "bucket_owner", "bucket", "date_time", "ip", "requester", "request_id", "operation", "key", "request",
    "status", "error", "bytes_sent", "object_size", "total_time", "turn_around_time", "referer", "user_agent",
)
WORD, BRACKETED, QUOTED = r"(\S+)", r"\[(.*?)\]", r'("[^"]+"|-)'
LINE = " ".join([WORD, WORD, BRACKETED, *[WORD] * 5, QUOTED, *[WORD] * 6, QUOTED, QUOTED])
MARK = "\x1f"
PARTS = MARK.join(f"${i}" for i in range(1, len(FIELDS) + 1))
TIME = r"^(\d{1,2}/[A-Za-z]{3}/\d{4}):(\d{2}:\d{2}:\d{2}) ([+-]\d{4})$"


def split_fields(lines: DataFrame, line: str = "line") -> DataFrame:
    """Every logical field as a column next to the raw line, ``parsed`` telling whether it matched.

    The pattern is matched once; what it found is split at a control character, for which a line's own counts as a space.
    """
    text = F.translate(F.trim(F.col(line)), MARK, " ")
    found = F.regexp_replace(text, f"(?s)^.*?{LINE}.*$", PARTS)
    rows = lines.select(F.col(line).alias("line"), F.split(found, MARK).alias("_f"))
    hit = F.size("_f") == len(FIELDS)
    cols = [F.when(hit, F.regexp_replace(F.get("_f", F.lit(i)), r'^"|"$', "")).alias(f) for i, f in enumerate(FIELDS)]
    return rows.select("line", *cols, F.coalesce(hit & F.col("line").isNotNull(), F.lit(False)).alias("parsed"))


def clean_time(raw: Column) -> dict[str, Column]:
    """'22/Jul/2013:21:04:17 +0000' to day, date-time text and zone; all null when malformed."""
    day = F.try_to_timestamp(F.regexp_extract(raw, TIME, 1), F.lit("d/MMM/yyyy"))
    date = F.date_format(day, "yyyy-MM-dd")
    found = date.isNotNull()
    return {
        "log_date": date,
        "log_time": F.when(found, F.concat_ws(" ", date, F.regexp_extract(raw, TIME, 2))),
        "log_zone": F.when(found, F.regexp_extract(raw, TIME, 3)),
    }


def parse(lines: DataFrame, line: str = "line") -> DataFrame:
    """Fields plus normalised time; ``ok`` is false for lines that do not match or carry a bad time."""
    out = split_fields(lines, line)
    out = out.withColumns(clean_time(F.col("date_time")))
    return out.withColumn("ok", F.col("parsed") & F.col("log_date").isNotNull()).drop("parsed")


def daily_requests(parsed: DataFrame, compat: bool = False) -> DataFrame:
    """Requests per (day, requester, agent, operation), error lines counted by their raw text.

    ``compat`` puts the quoted referer where the agent belongs, as the older job laid it out.
    """
    agent = (F.when(F.col("referer") == "-", "-").otherwise(F.col("referer")) if compat
             else F.col("user_agent"))
    good = parsed.filter("ok").groupBy(
        F.concat(F.col("log_date"), F.lit(" 00:00:00")).alias("date_time"), "requester",
        agent.alias("user_agent"), "operation",
    ).agg(F.count(F.lit(1)).alias("n"))
    bad = parsed.filter(~F.col("ok")).groupBy(F.col("line").alias("error_line")).agg(F.count(F.lit(1)).alias("n"))
    return good.unionByName(bad, allowMissingColumns=True)
