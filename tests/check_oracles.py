"""Run registered queries beside their SQL and report differences.

Usage: python tests/check_oracles.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

from tierwise.plans.oracles import ORACLES
from tierwise.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def canonical(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (0, "") if math.isnan(value) else (1, repr(value + 0.0))
    return (1, str(value))


def difference(spark_df, con, sql: str, exact_types: bool = False) -> str | None:
    """None when equal; otherwise what differs first."""
    left_names = sorted(spark_df.columns)
    relation = con.sql(sql)
    right_names = sorted(relation.columns)
    if left_names != right_names:
        return f"columns {left_names} / {right_names}"
    left = sorted(tuple(canonical(r[c]) for c in left_names) for r in spark_df.collect())
    at = [relation.columns.index(c) for c in right_names]
    right = sorted(tuple(canonical(float(r[i]) if type(r[i]).__name__ == "Decimal" else r[i]) for i in at) for r in relation.fetchall())
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        a, b = bad[0]
        cells = {c: (x[1], y[1]) for c, x, y in zip(left_names, a, b) if x != y}
        return f"{len(bad)} of {len(left)} rows differ, e.g. {dict(list(cells.items())[:4])}"
    kinds = {c: t for c, t in zip(relation.columns, relation.types)}
    simple = {"double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = {f.name: (f.dataType.simpleString(), str(kinds[f.name])) for f in spark_df.schema.fields if simple.get(f.dataType.simpleString(), "?") != str(kinds[f.name])}
    return f"equal, but types {odd}" if odd else None


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in names:
        started = time.time()
        try:
            df = QUERIES[name](spark, folder)
            verdict = difference(df, con, ORACLES[name]) if name in ORACLES else f"no SQL, {len(df.collect())} rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{time.time() - started:6.1f}s {name}: {verdict or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
