"""Ordered scans that stay parallel inside one long document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK_ROWS = 65_536
_BUCKETS = 1024


def keys_among(df: DataFrame, keys: Sequence[str]) -> Column:
    """Condition that holds for all rows whose ``keys`` occur in ``df``, and for few others.

    The keys are known by their bucket of 1,024, so what is sent to the tasks is bounded.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS))
    return F.array_contains(df.agg(F.collect_set(bucket).alias("buckets")).select("buckets").scalar(), bucket)


def in_several_blocks(df: DataFrame, keys: Sequence[str], order: str, block_rows: int = BLOCK_ROWS) -> Column:
    """Condition that holds for all rows whose ``keys`` have more than one block, and for few others."""
    block = F.floor(F.col(order) / block_rows)
    spans = df.groupBy(*keys).agg(F.min(block).alias("_first_block"), F.max(block).alias("_last_block"))
    return keys_among(spans.filter("_first_block < _last_block"), keys)


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    last: dict[str, Column] | None = None,
    sums: dict[str, Column] | None = None,
    since: dict[str, tuple[Column, Column]] | None = None,
    block_rows: int = BLOCK_ROWS,
    several: Column | None = None,
) -> DataFrame:
    """Running values per ``keys`` in ``order``, the current row included.

    ``last``   the latest non-NULL value so far
    ``sums``   the running sum
    ``since``  (count, marker): the sum of ``count`` over the rows after the latest
               marker row, NULL before the first one; counts must not be negative

    A plain window would put a whole document into one task. Here windows run on
    blocks of ``block_rows`` order numbers, one summary row per block carries the
    state across, and the two are joined: a document that holds a third of all rows
    spreads over as many tasks as it has blocks. ``order`` is a unique, roughly dense
    line number and ``keys`` are not NULL. The join keeps the partitioning of the
    windows, so the rows themselves are shuffled once. Only keys of several blocks have
    a state to carry: ``several`` is ``in_several_blocks`` of the keys, worked out here if
    it is not given, and the windows of all others run once.
    """
    last, sums, since = last or {}, sums or {}, since or {}
    keys = list(keys)
    block = "_block"
    frame = Window.unboundedPreceding
    inside = Window.partitionBy(*keys, block).orderBy(order).rowsBetween(frame, 0)
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(frame, -1)
    zero = F.lit(0)

    inputs = {f"_last_{n}": c for n, c in last.items()}
    inputs |= {f"_sum_{n}": F.coalesce(c, zero) for n, c in sums.items()}
    inputs |= {f"_cnt_{n}": F.coalesce(c, zero) for n, (c, _) in since.items()}
    inputs |= {f"_mark_{n}": m for n, (_, m) in since.items()}
    if several is None:
        several = in_several_blocks(df, keys, order, block_rows)

    local = {f"_in_last_{n}": F.last(f"_last_{n}", ignorenulls=True).over(inside) for n in last}
    local |= {f"_in_sum_{n}": F.sum(f"_sum_{n}").over(inside) for n in sums}
    local |= {f"_in_cnt_{n}": F.sum(f"_cnt_{n}").over(inside) for n in since}
    marks = {
        f"_at_{n}": F.last(F.when(F.col(f"_mark_{n}"), F.col(f"_in_cnt_{n}")), ignorenulls=True).over(inside)
        for n in since
    }

    def scanned(part: DataFrame) -> DataFrame:
        part = part.withColumns({block: F.floor(F.col(order) / block_rows), **inputs}).withColumns(local)
        return part.withColumns(marks) if marks else part

    totals: list[Column] = []
    for n in last:
        value = F.col(f"_last_{n}")
        totals.append(F.max_by(value, F.when(value.isNotNull(), F.col(order))).alias(f"_t_last_{n}"))
    totals += [F.sum(f"_sum_{n}").alias(f"_t_sum_{n}") for n in sums]
    for n in since:
        totals.append(F.sum(f"_cnt_{n}").alias(f"_t_cnt_{n}"))
        totals.append(F.max(f"_at_{n}").alias(f"_t_at_{n}"))
    blocks = scanned(df.filter(several)).groupBy(*keys, block).agg(*totals)
    carry = {f"_c_last_{n}": F.last(f"_t_last_{n}", ignorenulls=True).over(before) for n in last}
    carry |= {f"_c_sum_{n}": F.coalesce(F.sum(f"_t_sum_{n}").over(before), zero) for n in sums}
    carry |= {f"_p_cnt_{n}": F.coalesce(F.sum(f"_t_cnt_{n}").over(before), zero) for n in since}
    blocks = blocks.withColumns(carry)
    if since:
        # Prefix total at the block start less the prefix total at the latest marker.
        blocks = blocks.withColumns(
            {
                f"_c_cnt_{n}": F.col(f"_p_cnt_{n}")
                - F.last(F.col(f"_p_cnt_{n}") + F.col(f"_t_at_{n}"), ignorenulls=True).over(before)
                for n in since
            }
        )
    carried = [c for c in blocks.columns if c.startswith("_c_")]
    joined = scanned(df).join(blocks.select(*keys, block, *carried), [*keys, block], "left")
    out = {n: F.coalesce(F.col(f"_in_last_{n}"), F.col(f"_c_last_{n}")) for n in last}
    out |= {n: F.col(f"_in_sum_{n}") + F.coalesce(F.col(f"_c_sum_{n}"), zero) for n in sums}
    out |= {
        n: F.when(F.col(f"_at_{n}").isNotNull(), F.col(f"_in_cnt_{n}") - F.col(f"_at_{n}")).otherwise(
            F.col(f"_in_cnt_{n}") + F.col(f"_c_cnt_{n}")
        )
        for n in since
    }
    kept = [c for c in df.columns if c not in out]
    return joined.select(*kept, *[c.alias(n) for n, c in out.items()])


def carry_down(
    df: DataFrame, keys: Sequence[str], order: str, value: Column, out: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Latest non-NULL ``value`` at or above each row."""
    return ordered_scan(df, keys, order, last={out: value}, block_rows=block_rows)


def record_segments(
    df: DataFrame, keys: Sequence[str], order: str, starts: Column, out: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Number of records opened so far; 0 before the first start."""
    return ordered_scan(df, keys, order, sums={out: starts.cast("bigint")}, block_rows=block_rows)
