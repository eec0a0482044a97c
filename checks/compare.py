"""Run registered queries beside their SQL and report what differs.

    python -m checks.compare [--dir /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from collections import Counter

import duckdb

from checks.oracle import ORACLE
from checks.queries import REGISTERED
from feedwright.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


# Types that mean the same on both sides.
SAME_TYPE = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def sql_rows(sf_dir: str, sql: str) -> tuple[list[tuple[str, str]], list[tuple]]:
    """Columns with their Spark type name, and rows."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    types = [(c[0], SAME_TYPE.get(c[1], c[1])) for c in con.execute(f"DESCRIBE {sql}").fetchall()]
    return types, con.execute(sql).fetchall()


def ordered(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(r[i] for i in order) for r in rows)


def compare(spark, sf_dir: str, name: str) -> str | None:
    """None when equal, otherwise what differs."""
    got = REGISTERED[name](spark, sf_dir)
    found = ordered(got.columns, [tuple(r) for r in got.collect()])
    columns, rows = sql_rows(sf_dir, ORACLE[name])
    if sorted(columns) != sorted(got.dtypes):
        return f"columns {sorted(got.dtypes)} against {sorted(columns)}"
    wanted = ordered([c[0] for c in columns], rows)
    if found == wanted:
        return None
    extra, missing = list((found - wanted).items()), list((wanted - found).items())
    return (
        f"{sum(found.values())} rows against {sum(wanted.values())}; "
        f"only Spark {len(extra)} {extra[:2]}; only SQL {len(missing)} {missing[:2]}"
    )


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("compare", "local[8]", spark_sql_shuffle_partitions="8", spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in args.names or REGISTERED:
        started = time.time()
        if name not in ORACLE:
            print(f"{name}: no SQL")
            continue
        try:
            wrong = compare(spark, args.dir, name)
        except Exception as e:  # noqa: BLE001
            wrong = f"{type(e).__name__}: {str(e)[:600]}"
        failed += wrong is not None
        print(f"{name}: {'ok' if wrong is None else wrong} ({time.time() - started:.1f}s)", flush=True)
    print(f"{failed} of {len(args.names or REGISTERED)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main())
