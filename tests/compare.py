"""Runs queries and their SQL side by side: python tests/compare.py SF_DIR [NAME...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def value(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, float) and x == 0:
        return 0.0
    if hasattr(x, "asDict"):
        return tuple((k, value(v)) for k, v in x.asDict().items())
    if isinstance(x, dict):
        return tuple((k, value(v)) for k, v in x.items())
    return tuple(value(v) for v in x) if isinstance(x, (list, tuple)) else x


def differences(spark, con, name, query, sql, sf_dir) -> str:
    """What differs, empty if nothing does."""
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(value(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} and {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = Counter(value(tuple(r[k] for k in order)) for r in cursor.fetchall())
    if got == want:
        return "" if got else "no rows"
    a, b = got - want, want - got
    return f"{got.total()} and {want.total()} rows, {a.total()} and {b.total()} differ: {columns} {next(iter(a), None)} | {next(iter(b), None)}"


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    con, queries, sql = connect(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        began = time.time()
        try:
            said = differences(spark, con, name, queries[name], sql[name], sf_dir) if name in sql else f"rows {queries[name](spark, sf_dir).count()}, no SQL"
        except Exception as e:  # noqa: BLE001
            said = f"{type(e).__name__}: {str(e)[:700]}"
        bad += bool(said) and "no SQL" not in said
        print(f"{name}: {said or 'same'} ({time.time() - began:.1f} s)", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
