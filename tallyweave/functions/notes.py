"""Note, flag and provenance columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyweave.functions.numbers import as_col, blank_to_null


def join_notes(*notes: Column | str, separator: str = "; ") -> Column:
    """Non-blank notes joined; blank text when there is none."""
    return F.concat_ws(separator, *[blank_to_null(n) for n in notes])


def first_nonblank(*values: Column | str) -> Column:
    """First value that is neither NULL nor blank."""
    return F.coalesce(*[blank_to_null(as_col(v).cast("string")) for v in values])


def presence_flag(c: Column | str) -> Column:
    return as_col(c).isNotNull()


def add_provenance(df: DataFrame, url: str, note: str, stamp: bool = False) -> DataFrame:
    """Source columns on every row; the time stamp is opt-in because it is not repeatable."""
    columns = {"source_url": F.lit(url), "source_note": F.lit(note)}
    if stamp:
        columns["extracted_at"] = F.current_timestamp()
    return df.withColumns(columns)


def value_anomaly_flag(condition: Column, reason: str) -> Column:
    """Review reason where a value looks wrong; the value itself is not touched."""
    return F.when(condition, F.lit(reason))


def sorted_list(c: Column | str, condition: Column | None = None, separator: str = "; ") -> Column:
    """Aggregate: distinct non-blank values, sorted by code point and joined.

    ``collect_set`` drops repeats before the shuffle, so what travels is the domain
    of the column and never its rows.
    """
    value = blank_to_null(as_col(c).cast("string"))
    if condition is not None:
        value = F.when(condition, value)
    return F.array_join(F.array_sort(F.collect_set(value)), separator)
