"""Run registered queries beside their SQL. ``python tests/oracle.py [dir] [name-prefix ...]``"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quillframe.registry import load_catalog  # noqa: E402
from quillframe.session import build_session  # noqa: E402
from quillframe.tables import SCHEMAS  # noqa: E402


def connect(path: str):
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (list, tuple)) and not hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(sorted((k, plain(x)) for k, x in v.asDict().items()))
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return v


def canon(cols, rows):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(plain(r[i]) for i in idx) for r in rows), key=repr)


def same(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(same(x, y) for x, y in zip(a, b))
    if isinstance(a, bool) != isinstance(b, bool):
        return False
    if isinstance(a, float) or isinstance(b, float):
        return a is not None and b is not None and type(a) is type(b) and repr(a) == repr(b)
    return a == b


def compare(df, con, sql, clock=None):
    """'' when equal, else what differs."""
    rows = df.collect()
    if clock is not None:
        clock.append(time.time())
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} / {sorted(want_cols)}"
    if len(rows) != len(want):
        return f"rows {len(rows)} / {len(want)}"
    types = {d[0]: str(d[1]).lower().split("(")[0] for d in cur.description}
    names = {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "boolean": "boolean",
             "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp", "tinyint": "tinyint", "smallint": "smallint", "float": "float"}
    odd = [f"{f.name}: {f.dataType.simpleString()} / {types[f.name]}" for f in df.schema.fields
           if f.dataType.simpleString() in names and names[f.dataType.simpleString()] != types[f.name]]
    got, exp = canon(df.columns, rows), canon(want_cols, want)
    bad = [(a, b) for a, b in zip(got, exp) if not same(a, b)]
    if bad:
        return f"{len(bad)} of {len(rows)} rows, e.g. {str(bad[0])[:600]}"
    return f"types {odd}" if odd else ""


def main():
    path = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(path)
    failed = 0
    for name, q in load_catalog().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t0, clock = time.time(), []
        try:
            df = q(spark, path)
            msg = compare(df, con, q.sql, clock) if q.sql else f"no sql, {len(df.collect())} rows"
        except Exception as e:  # report and go on with the next query
            msg = f"ERROR {type(e).__name__} {str(e)[:700]}"
        dt = (clock[0] if clock else time.time()) - t0
        if msg and not msg.startswith("no sql"):
            failed += 1
        print(f"{'ok  ' if not msg or msg.startswith('no sql') else 'FAIL'} {dt:5.1f}s {name} {msg}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
