"""Compare registered queries with their SQL on one scale: ``python -m tests.oracle [sf] [names...]``."""

from __future__ import annotations

import math
import sys
import time
from fnmatch import fnmatch

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else float(value)
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime().isoformat()
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).to_pydatetime().isoformat()
    if hasattr(value, "tolist"):
        return tuple(_cell(v) for v in value.tolist()) if getattr(value, "ndim", 0) else _cell(value.item())
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def compare(spark_df, con, sql) -> str | None:
    """None when equal, otherwise what differs."""
    result = con.execute(sql)
    expected = canonical([d[0] for d in result.description], result.fetchall())
    actual = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if expected[0] != actual[0]:
        return f"columns {actual[0]} != {expected[0]}"
    if len(expected[1]) != len(actual[1]):
        return f"{len(actual[1])} rows, expected {len(expected[1])}"
    for mine, theirs in zip(actual[1], expected[1]):
        if mine != theirs:
            return f"row {mine} != {theirs}"
    return None


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tidemark.session import build_session

    sf = next((a for a in argv if a.startswith("0")), "0.01")
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                 "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    if "--buckets" in argv:  # cut even small tables into many buckets
        argv.remove("--buckets")
        spark.conf.set("tidemark.rowsPerBucket", "70")
    con, bad = duck(sf_dir), 0
    wanted = [a for a in argv if not a.startswith("0")]
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and not any(fnmatch(name, a) for a in wanted):
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                note = "ok" if problem is None else f"MISMATCH {problem}"
                bad += problem is not None
                rows = len(con.execute(oracles[name]).fetchall())
            else:
                rows, note = df.count(), "rows only"
            if not rows:
                note += " EMPTY"
        except Exception as error:  # report and go on
            rows, note = -1, f"ERROR {type(error).__name__} {str(error)[:600]}"
            bad += 1
        print(f"{name:32s} {time.time() - started:6.2f}s {rows:8d} {note}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
