"""Run a registered query and its SQL on the same tables and compare the rows.

``python tests/compare.py DIR [NAME ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(d: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{d}/{name}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql: str, d: str) -> str:
    """Empty text if equal, else what differs."""
    df = query(spark, d)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got == want:
        return "" if got else "no rows"
    extra, lost = list((got - want).items())[:2], list((want - got).items())[:2]
    return f"rows {sum(got.values())} != {sum(want.values())}; only here {extra}; only SQL {lost}"


def main(d: str, only: list[str]) -> None:
    import __spark_entry__ as entry
    from shelfline.session import build_session

    spark = build_session("local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(d)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = []
    for name in only or queries:
        start = time.time()
        try:
            if name in oracles:
                out = compare(spark, con, queries[name], oracles[name], d) or "ok"
            else:
                out = f"no SQL, {queries[name](spark, d).count()} rows"
        except Exception as e:  # noqa: BLE001
            out = f"{type(e).__name__}: {str(e)[:700]}"
        if out != "ok":
            bad.append(name)
        print(f"{name:28s} {time.time() - start:6.1f}s  {out}", flush=True)
    print("not ok:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
