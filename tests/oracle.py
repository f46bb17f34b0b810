"""Run named queries on Spark and their SQL on DuckDB and compare the rows.

Usage: python tests/oracle.py [scale folder] [query ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(df, con, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    spark_columns, spark_rows = _sorted_rows(df.columns, df.collect())
    answer = con.execute(sql)
    sql_columns, sql_rows = _sorted_rows([d[0] for d in answer.description], answer.fetchall())
    if spark_columns != sql_columns:
        return f"columns {spark_columns} / {sql_columns}"
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} / {len(sql_rows)} rows"
    bad = [(s, q) for s, q in zip(spark_rows, sql_rows) if s != q]
    if bad:
        return f"{len(bad)} of {len(spark_rows)} rows differ, first: {bad[0][0]} / {bad[0][1]}"
    kinds = [{type(v) for r in rows for v in (r[i],) if v is not None}
             for rows in (spark_rows, sql_rows) for i in range(len(spark_columns))]
    half = len(spark_columns)
    for i in range(half):
        if kinds[i] != kinds[half + i]:
            return f"types of {spark_columns[i]}: {kinds[i]} / {kinds[half + i]}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from playtide import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls, failed = entry.oracle_sql(), []
    for name, run in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(run(spark, sf_dir), con, sqls[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        if problem:
            failed.append(name)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
