import random

import pytest
from pyspark.sql import functions as F

from tallyweave.operators.scan import ordered_scan


@pytest.mark.parametrize("block_rows", [1, 3, 7, 1000])
def test_scan_equals_a_loop(spark, block_rows):
    random.seed(block_rows)
    data = [
        (doc, n, random.choice([None, None, f"h{n}"]), random.randint(0, 3), random.random() < 0.15)
        for doc in range(4) for n in range(40) if random.random() < 0.8
    ]
    df = spark.createDataFrame(data, "doc int, n long, head string, v long, mark boolean")
    got = ordered_scan(
        df, ["doc"], "n", last={"latest": F.col("head")}, sums={"total": F.col("v")},
        since={"after": (F.col("v"), F.col("mark"))}, block_rows=block_rows,
    )
    out = {(r["doc"], r["n"]): (r["latest"], r["total"], r["after"]) for r in got.collect()}
    assert len(out) == len(data)
    for doc in range(4):
        latest, total, after = None, 0, None
        for d, n, head, v, mark in data:
            if d != doc:
                continue
            latest, total = head or latest, total + v
            after = 0 if mark else after + v if after is not None else None
            assert out[(doc, n)] == (latest, total, after)


def test_scan_has_no_task_per_document(spark):
    """Row windows are partitioned by document and block, never by document alone."""
    df = spark.range(1000).select(F.lit(1).alias("doc"), F.col("id").alias("n"), F.col("id").alias("v"))
    scanned = ordered_scan(df, ["doc"], "n", sums={"total": F.col("v")}, block_rows=10)
    plan = scanned._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "_in_sum" in line and "AS _in_sum" in line]
    assert windows and all("_block" in w for w in windows)
    assert scanned.agg(F.max("total")).first()[0] == 499500
