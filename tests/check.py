"""Compare registered queries with their SQL on one table folder: python -m tests.check [sf] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{root}/{name}.parquet'")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]

    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return None
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float):
            return repr(round(v, 9) + 0.0)
        if isinstance(v, bool):
            return str(v)
        return str(v)

    return sorted((tuple(cell(v) for v in row) for row in pdf.astype(object).values.tolist()), key=repr)


def compare(spark_df, sql: str, con) -> str:
    """Empty string when equal, otherwise what differs."""
    mine = spark_df.toPandas()
    theirs = con.execute(sql).df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} vs {sorted(theirs.columns)}"
    kinds = {c: (mine[c].dtype.kind, theirs[c].dtype.kind) for c in mine.columns if mine[c].dtype.kind != theirs[c].dtype.kind}
    a, b = canonical(mine), canonical(theirs)
    if a == b:
        return f"kinds {kinds}" if kinds and set(map(str, kinds.values())) - {"('O', 'f')", "('f', 'O')"} and len(mine) else ""
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"rows {len(a)} vs {len(b)}, {len(bad)} differ, first {bad[:2]}"


def main() -> None:
    from corpusflow.session import build_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    root = f"/root/testdata/{sf}"
    spark = build_session(
        "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(root)
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    for name in names:
        t0 = time.time()
        try:
            df = queries[name](spark, root)
            if name in oracle:
                out = compare(df, oracle[name], con) or "ok"
            else:
                out = f"rows-only {df.count()}"
        except Exception as e:  # report and go on to the next query
            out = f"ERROR {type(e).__name__} {str(e)[:600]}"
        print(f"{name:22s} {time.time() - t0:6.2f}s {out}", flush=True)


if __name__ == "__main__":
    main()
