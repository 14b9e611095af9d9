"""Run registered queries next to their oracle SQL and compare every value."""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from lakeaudit.sources.tables import TABLES  # noqa: E402


def plain(value):
    """A value in a form both engines share; numbers keep their kind."""
    if value is None:
        return ("null", "")
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, int):
        return ("int", str(value))
    if isinstance(value, float):
        return ("float", repr(value + 0.0))
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value.normalize()))
    if isinstance(value, dt.datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return ("date", value.isoformat())
    if isinstance(value, (list, tuple)) and not hasattr(value, "asDict"):
        return ("list", tuple(plain(v) for v in value))
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return ("dict", tuple(sorted((k, plain(v)) for k, v in value.items())))
    return ("text", str(value))


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(df, con, sql: str) -> str | None:
    """None when equal, else the first difference."""
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    got = df.collect()
    got_cols = df.columns
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} / oracle {sorted(want_cols)}"
    cols = sorted(got_cols)
    gi, wi = [got_cols.index(c) for c in cols], [want_cols.index(c) for c in cols]
    left = sorted(tuple(plain(r[i]) for i in gi) for r in got)
    right = sorted(tuple(plain(r[i]) for i in wi) for r in want)
    compare.rows = len(left)
    if len(left) != len(right):
        return f"rows {len(left)} / oracle {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{dict(zip(cols, a))}\n   / oracle {dict(zip(cols, b))}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from lakeaudit.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = duck(sf_dir), oracle_sql()
    names = sys.argv[1:] or list(queries())
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            diff = compare(df, con, oracles[name]) if name in oracles else f"(no oracle, {df.count()} rows)"
        except Exception as exc:  # noqa: BLE001
            diff = f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += diff is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {f'ok {compare.rows}' if diff is None else diff}", flush=True)
    print("not equal:", bad)


if __name__ == "__main__":
    main()
