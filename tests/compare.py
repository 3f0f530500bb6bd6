"""Run registered queries against DuckDB over the same parquet files.

``python tests/compare.py [sf_dir] [key …]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{path}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet')")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    """Rows as text tuples, columns sorted by name, NULL and NaN alike."""
    pdf = pdf[sorted(pdf.columns)]
    text = lambda v: "NULL" if v is None or v is pd.NA or v != v else repr(v.item() if hasattr(v, "item") else v)
    return sorted(tuple(text(v) for v in row) for row in pdf.astype(object).itertuples(index=False, name=None))


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "BOOLEAN": "boolean", "DOUBLE": "double", "VARCHAR": "string"}


def difference(spark_df, con, sql: str) -> str | None:
    """None when schema and rows agree, else a short description."""
    rel = con.sql(sql)
    want_types = {c: KINDS.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    got_types = {f.name: f.dataType.simpleString() for f in spark_df.schema}
    if want_types != got_types:
        return f"schema spark={got_types} sql={want_types}"
    got, want = canonical(spark_df.toPandas()), canonical(rel.df())
    if len(got) != len(want):
        return f"rows spark={len(got)} sql={len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}" if bad else None


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from winnow.session import get_session

    path = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, sql = entry.queries(), entry.oracle_sql()
    keys = sys.argv[2:] or list(queries)
    spark = get_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(path)
    failed = []
    for key in keys:
        start = time.time()
        try:
            df = queries[key](spark, path)
            why = difference(df, con, sql[key]) if key in sql else (None if df.count() >= 0 else "no rows")
        except Exception as e:  # noqa: BLE001 - reported per query
            why = f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{'ok  ' if why is None else 'FAIL'} {key} {time.time() - start:.1f}s {why or ''}", flush=True)
        if why:
            failed.append(key)
    print(f"{len(keys) - len(failed)}/{len(keys)} ok; failed: {' '.join(failed)}")
    spark.stop()


if __name__ == "__main__":
    main()
