"""Compare every registered query with its SQL on the same parquet tables.

    python tests/check_oracles.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9) + 0.0
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr), [names[i] for i in order]


def compare(spark, name, query, sql, folder, connection):
    start = time.time()
    df = query(spark, folder)
    got, got_names = rows_of(df.columns, df.collect())
    spark_seconds = time.time() - start
    if sql is None:
        return f"rows {len(got)} (no SQL twin) {spark_seconds:.1f}s", True
    start = time.time()
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want, want_names = rows_of(columns, result.fetchall())
    sql_seconds = time.time() - start
    text = f"rows {len(got)} / {len(want)} {spark_seconds:.1f}s / {sql_seconds:.1f}s"
    if got_names != want_names:
        return f"{text}\n   columns {got_names}\n   sql     {want_names}", False
    if got != want:
        pairs = [(a, b) for a, b in zip(got, want) if a != b][:2]
        extra = [r for r in got if r not in set(want)][:2] if len(got) < 5000 else []
        return f"{text}\n   {got_names}\n   first differences {pairs}\n   only in spark {extra}", False
    kind_map = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = [(n, t, kinds[n]) for n, t in df.dtypes if kind_map.get(t, t) != kinds[n]]
    return text + (f"  TYPES {odd}" if odd else ""), True


def main():
    from __spark_entry__ import oracle_sql, queries
    from tallyweave.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    shared = tempfile.mkdtemp(prefix="check-oracles-")
    spark = local_session(8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.checkpoint.dir": shared})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    sqls, bad = oracle_sql(), 0
    for name, query in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            text, good = compare(spark, name, query, sqls.get(name), folder, connection)
        except Exception as error:  # noqa: BLE001 - report and go on to the next query
            text, good = f"{type(error).__name__}: {str(error)[:900]}", False
        bad += not good
        print("ok  " if good else "BAD ", name, text, flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
