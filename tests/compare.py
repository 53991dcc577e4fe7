"""Run queries on Spark and their SQL on DuckDB, and compare the rows.

    python tests/compare.py /root/testdata/sf0.01 [name prefix ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(f).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{f}'")
    return con


def _cell(v):
    return repr(v + 0.0) if isinstance(v, float) else str(v)


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None if both give the same columns and the same bag of rows."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got, want = _bag(df.columns, df.collect()), _bag(names, cur.fetchall())
    if got == want:
        return None
    return (f"rows {got.total()} vs {want.total()}; only spark {list((got - want).items())[:3]}; "
            f"only sql {list((want - got).items())[:3]}")


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from haatlake.plans.session import STATIC

    sf_dir, prefixes = sys.argv[1], tuple(sys.argv[2:]) or ("",)
    spark = (
        SparkSession.builder.master("local[8]").config(map=STATIC).config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name, build in queries().items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            why = difference(build(spark, sf_dir), con, sqls[name]) if name in sqls else "no sql"
        except Exception as e:  # noqa: BLE001
            why = f"{type(e).__name__}: {str(e)[:600]}"
        bad += why is not None
        print(f"{'ok ' if why is None else 'BAD'} {name} {time.time() - start:.2f}s {why or ''}", flush=True)
    print("bad:", bad, "missing:", set(sqls) - set(queries()))
    return bad


if __name__ == "__main__":
    sys.exit(main())
