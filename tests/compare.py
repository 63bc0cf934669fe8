"""Run registered queries beside their SQL and report differences."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return value + 0.0
    return value


SPARK_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP",
}


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree in columns, types, row count and values."""
    rel = con.sql(sql)
    ours, theirs = sorted(df.columns), sorted(rel.columns)
    if ours != theirs:
        return f"columns {ours} != {theirs}"
    kinds = dict(zip(rel.columns, [str(t) for t in rel.types]))
    types = {c: (SPARK_KINDS.get(t, t), kinds[c]) for c, t in df.dtypes}
    bad = {c: t for c, t in types.items() if t[0] != t[1] and t[1] != '"NULL"'}
    if bad:
        return f"types {bad}"
    order = [list(rel.columns).index(c) for c in theirs]
    right = Counter(tuple(_plain(r[i]) for i in order) for r in rel.fetchall())
    left = Counter(tuple(_plain(v) for v in r) for r in df.select(ours).collect())
    if left != right:
        extra, missing = list((left - right).items()), list((right - left).items())
        return (
            f"rows {sum(left.values())} vs {sum(right.values())}; "
            f"only ours {len(extra)}: {extra[:2]}; only theirs {len(missing)}: {missing[:2]}"
        )
    return None


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from shelfline.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name, run in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            sql = entry.oracle_sql().get(name)
            verdict = difference(df, con, sql) if sql else f"(no SQL) {len(df.collect())} rows"
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        good = verdict is None or verdict.startswith("(no SQL)")
        failed += not good
        print(f"{'ok  ' if good else 'FAIL'} {time.time() - start:6.2f}s {name} {verdict or ''}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
