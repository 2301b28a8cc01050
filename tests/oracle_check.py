"""Side-by-side check of a Spark query against its DuckDB oracle.

Used by the tests and by ``python -m oracle_check``: both results
are brought to pandas, columns sorted by name, values normalised (floats to
9 significant digits, timestamps to ISO text) and compared as multisets.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb
import pandas as pd

from perkspark.sources.tables import TABLES, table_path


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{table_path(sf_dir, name)}')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    return v


def _rows(df: pd.DataFrame) -> Counter:
    cols = sorted(df.columns)
    out = Counter()
    for rec in df[cols].itertuples(index=False, name=None):
        out[tuple(_norm(x) for x in rec)] += 1
    return out


def compare(spark_df, sql: str, con) -> dict:
    t0 = time.time()
    rows = spark_df.collect()
    spark_pdf = pd.DataFrame([r.asDict() for r in rows], columns=spark_df.columns)
    t1 = time.time()
    duck_pdf = con.sql(sql).df()
    t2 = time.time()
    res = {
        "rows_spark": len(spark_pdf),
        "rows_oracle": len(duck_pdf),
        "cols_match": sorted(spark_pdf.columns) == sorted(duck_pdf.columns),
        "spark_sec": round(t1 - t0, 3),
        "oracle_sec": round(t2 - t1, 3),
    }
    if not res["cols_match"]:
        res["cols"] = (sorted(spark_pdf.columns), sorted(duck_pdf.columns))
        res["match"] = False
        return res
    a, b = _rows(spark_pdf), _rows(duck_pdf)
    res["match"] = a == b
    if not res["match"]:
        res["only_spark"] = list((a - b).items())[:3]
        res["only_oracle"] = list((b - a).items())[:3]
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry  # noqa: E402

    from perkspark.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck_connection(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            n = fn(spark, sf_dir).count()
            print(f"{name:40s} rows-only {n}")
            continue
        try:
            res = compare(fn(spark, sf_dir), sqls[name], con)
        except Exception as exc:  # report and go on
            res = {"match": False, "error": repr(exc)[:500]}
        bad += not res["match"]
        print(f"{name:40s} {'OK ' if res['match'] else 'BAD'} {res}")
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
