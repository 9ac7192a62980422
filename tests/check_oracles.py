"""Compare registered queries with their SQL twins in DuckDB: python tests/check_oracles.py sf [names]."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from obralake.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return float(repr(value))
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def compare(spark, con, name: str, sf_dir: str) -> str:
    df = entry.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    if name not in entry.oracle_sql():
        return f"rows only ({len(got)})"
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"COLUMNS {cols} vs {sorted(names)}"
    at = [names.index(c) for c in cols]
    want = [tuple(plain(r[i]) for i in at) for r in cur.fetchall()]
    key = lambda r: tuple((v is None, str(type(v)), str(v)) for v in r)
    got.sort(key=key)
    want.sort(key=key)
    if got == want:
        return f"ok ({len(got)})"
    only_got, only_want = list(set(got) - set(want))[:3], list(set(want) - set(got))[:3]
    return f"DIFF {len(got)} vs {len(want)}\n   spark {only_got}\n   sql   {only_want}\n   {cols}"


def main() -> None:
    sf_dir = f"/root/testdata/{sys.argv[1]}"
    wanted = sys.argv[2:] or list(entry.queries())
    spark = build_session("local[2]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    for name in wanted:
        start = time.time()
        try:
            result = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            result = "ERROR " + str(error).split("JVM stacktrace")[0][:1500]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        print(f"{name:28s} {time.time() - start:6.1f}s {result}", flush=True)


if __name__ == "__main__":
    main()
