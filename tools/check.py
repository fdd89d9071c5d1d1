"""Run every query on Spark and its SQL on DuckDB and compare the rows.

    python tools/check.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from querybook import all_queries  # noqa: E402
from querybook.metadata_queries import TABLES  # noqa: E402
from shelfmark.session import configure  # noqa: E402


def canonical(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(row[i]) for i in order) for row in rows)


def differences(df, folder: str, sql: str | None) -> str:
    """An empty text if a Spark result and the SQL agree, else what differs."""
    ours = rows_of(df.columns, df.collect())
    if sql is None:
        return "" if ours else "no rows"
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if ours != theirs:
        missing, extra = theirs - ours, ours - theirs
        return (
            f"{sum(ours.values())} rows vs {sum(theirs.values())}; "
            f"missing {list(missing.items())[:3]}, extra {list(extra.items())[:3]}"
        )
    return ""


def session(cores: str = "8") -> SparkSession:
    builder = configure(SparkSession.builder.master(f"local[{cores}]").appName("check"))
    builder = builder.config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false"
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, failed = session(), 0
    for name, query in all_queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = differences(query.run(spark, folder), folder, query.sql)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        kind = "sql" if query.sql else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {kind:4} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
