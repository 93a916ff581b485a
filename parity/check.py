"""Compare every query with its SQL: python -m parity.check SF [query ...]

Rows are compared as multisets, columns by name.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from parity.oracles import ORACLES
from parity.queries import REGISTRY

TESTDATA = Path("/root/testdata")


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(r[i] for i in order) for r in cur.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(r) for r in df.select(*names).collect())


def compare(spark: SparkSession, name: str, sf_dir: str) -> str | None:
    """None when the query agrees with its SQL, else what differs."""
    names, got = spark_rows(REGISTRY[name](spark, sf_dir))
    want_names, want = sql_rows(sf_dir, ORACLES[name])
    if names != want_names:
        return f"columns {names} != {want_names}"
    if got != want:
        return f"extra {list((got - want).items())[:2]} missing {list((want - got).items())[:2]}"
    return None if got else "no rows"


def main() -> int:
    sf_dir, keys = str(TESTDATA / f"sf{sys.argv[1]}"), sys.argv[2:] or sorted(REGISTRY)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in keys:
        start = time.time()
        try:
            diff = compare(spark, name, sf_dir)
        except Exception as e:  # report and go on with the next query
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {time.time() - start:6.2f}s {name} {diff or ''}", flush=True)
    print(f"{len(keys) - bad} of {len(keys)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
