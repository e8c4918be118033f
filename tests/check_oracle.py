"""Compare registered queries with their SQL: python tests/check_oracle.py [sf] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(pdf):
    """Rows as sorted tuples, columns by name, numbers at nine digits."""
    import pandas as pd

    pdf = pdf[sorted(pdf.columns)]

    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "~"
        if isinstance(v, float):
            return f"{v:.9g}" if v else "0"
        if hasattr(v, "isoformat"):
            return v.isoformat()[:10] if v.isoformat().endswith("T00:00:00") else v.isoformat()
        return str(v)

    kinds = {c: pdf[c].dtype.kind for c in pdf.columns}
    for c, k in kinds.items():
        if k == "f" and len(pdf) and (pdf[c].dropna() % 1 == 0).all():
            pdf = pdf.assign(**{c: pdf[c].astype(float)})
    rows = []
    for row in pdf.itertuples(index=False):
        rows.append(tuple(
            cell(v) if v is None or v is pd.NA or kinds[c] not in "iuf" or v != v else cell(float(v))
            for c, v in zip(pdf.columns, row)
        ))
    return sorted(rows)


def simple_type(t: str) -> str:
    t = t.lower()
    return {"long": "bigint", "string": "varchar", "int": "integer"}.get(t, t)


def compare(spark, con, sf_dir, name, fn, sql):
    df = fn(spark, sf_dir)
    got = df.toPandas()
    if sql is None:
        return ("rows-only", len(got)) if len(got) else ("EMPTY", 0)
    rel = con.sql(sql)
    types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    mine = {c: simple_type(t) for c, t in df.dtypes}
    want = rel.df()
    if sorted(mine) != sorted(types):
        return ("COLUMNS", f"{sorted(mine)} vs {sorted(types)}")
    wrong = {c: (mine[c], types[c].lower()) for c in mine if mine[c] != types[c].lower()}
    if wrong:
        return ("TYPES", wrong)
    a, b = canonical(got), canonical(want)
    if a != b:
        sa, sb = set(a), set(b)
        return ("VALUES", f"{len(a)} vs {len(b)} rows; mine {list(sa - sb)[:3]} sql {list(sb - sa)[:3]}")
    return ("ok" if len(a) else "EMPTY", len(a))


def main(argv):
    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    import __spark_entry__ as entry
    from pricetrail.session import build_session

    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    con.execute("SET TimeZone='UTC'")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            status, detail = compare(spark, con, sf_dir, name, queries[name], oracles.get(name))
        except Exception as problem:  # noqa: BLE001
            status, detail = "ERROR", f"{type(problem).__name__}: {str(problem)[:700]}"
        fine = status in ("ok", "rows-only")
        bad += not fine
        print(f"{'  ' if fine else '!!'} {name:28s} {status:10s} {time.time() - start:6.2f}s {detail}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    raise SystemExit(1 if main(sys.argv[1:]) else 0)
