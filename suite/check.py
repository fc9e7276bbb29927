"""Compare registered queries with their SQL: ``python -m suite.check [folder] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    rows = []
    for row in pdf.itertuples(index=False):
        out = []
        for v in row:
            if v is None or (not isinstance(v, (list, dict)) and pd.api.types.is_scalar(v) and pd.isna(v)):
                out.append("~")
            elif isinstance(v, bool) or type(v).__name__ == "bool":
                out.append(str(bool(v)))
            elif hasattr(v, "isoformat"):
                out.append(pd.Timestamp(v).isoformat())
            elif isinstance(v, str):
                out.append(v)
            else:
                out.append(repr(float(v)))
        rows.append(tuple(out))
    return sorted(rows)


def compare(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> str | None:
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} vs {sorted(sql_pdf.columns)}"
    if len(spark_pdf) != len(sql_pdf):
        return f"rows {len(spark_pdf)} vs {len(sql_pdf)}"
    a, b = canonical(spark_pdf), canonical(sql_pdf)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, e.g. {bad[0]}" if bad else None


def main(argv: list[str]) -> int:
    from hazeline.session import build_session
    from suite import catalog

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    queries, sql = catalog()
    spark = build_session("check", "8")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(folder), 0
    for name, fn in queries.items():
        if names and not any(name == n or name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            got = fn(spark, folder).toPandas()
            spent = time.time() - start
            problem = compare(got, con.execute(sql[name]).df()) if name in sql else None
            state = "ok" if problem is None else "DIFF"
            if name not in sql:
                state = "rows"
        except Exception as e:  # report and go on with the next query
            spent, state, problem, got = time.time() - start, "ERROR", str(e)[:1500], []
        failed += state in ("DIFF", "ERROR")
        print(f"{state:5} {name:36} {len(got):7} rows {spent:6.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
