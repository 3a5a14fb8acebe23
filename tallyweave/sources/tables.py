"""Text tables in, tables out, and the choice between candidate sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyweave import constants as K
from tallyweave.functions.numbers import blank_to_null


def read_text_table(
    spark: SparkSession, path: str, columns: Sequence[str], line_breaks_in_cells: bool = False
) -> DataFrame:
    """Header CSV in UTF-8; every column is text and blank cells are NULL.

    ``columns`` fixes the schema, so no pass over the files is spent on inference;
    a file whose header disagrees fails the read. Cells with line breaks are opt-in,
    since they keep Spark from splitting a file.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", line_breaks_in_cells)
        .option("escape", '"')
        .csv(path)
    )
    return df.select([F.when(blank_to_null(c).isNotNull(), F.col(c)).alias(c) for c in columns])


def write_table(
    df: DataFrame,
    path: str,
    fields: Sequence[str],
    file_format: str = "parquet",
    sort_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> None:
    """Write ``fields`` in this order and drop the rest; one canonical sort if asked."""
    out = df.select(*fields)
    if sort_by:
        out = out.orderBy(*sort_by)
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if file_format == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(file_format).save(path)


def choose_source(
    candidates: DataFrame,
    source: str,
    entity: str,
    priority: str,
    minimum: int = K.MIN_SOURCE_ENTITIES,
) -> DataFrame:
    """One row per source: distinct entities, whether it is chosen, and why.

    The source with the lowest ``priority`` that reaches ``minimum`` entities wins;
    when none does, the last one in line is the fallback.
    """
    counts = candidates.groupBy(source).agg(
        F.count_distinct(entity).alias("entities"), F.min(priority).alias("priority")
    )
    passing = F.col("entities") >= minimum
    best = counts.agg(
        F.coalesce(F.min(F.when(passing, F.col("priority"))), F.max("priority")).alias("best")
    )
    chosen = F.col("priority") == best.select("best").scalar()
    reason = (
        F.when(chosen & passing, F.lit("first source with enough entities"))
        .when(chosen, F.lit("fallback: no source has enough entities"))
        .when(passing, F.lit("a preferred source is complete"))
        .otherwise(F.lit("too few entities"))
    )
    return counts.select(source, "entities", "priority", chosen.alias("chosen"), reason.alias("reason"))


def rows_of_chosen(candidates: DataFrame, source: str, choice: DataFrame) -> DataFrame:
    """Rows of the chosen source; ``choice`` is small, so this is a semi join on it."""
    return candidates.join(choice.filter("chosen").select(source), source, "left_semi")


def promote_valid_records(df: DataFrame, year: str, *required: str) -> DataFrame:
    """Rows whose year is digits and whose required cells are not blank."""
    keep: Column = F.coalesce(F.col(year).cast("string").rlike("^[0-9]+$"), F.lit(False))
    for c in required:
        keep = keep & blank_to_null(c).isNotNull()
    return df.filter(keep)


def manual_review_rows(
    df: DataFrame, table: str, reason: str, identifier: Sequence[str], raw: str, *extra: str
) -> DataFrame:
    """Rows that carry a review reason, with a joined identifier and the raw text."""
    return df.filter(F.col(reason).isNotNull()).select(
        F.lit(table).alias("table"),
        *extra,
        F.concat_ws(" | ", *[F.col(c).cast("string") for c in identifier]).alias("row_identifier"),
        F.col(reason).alias("issue"),
        F.col(raw).alias("raw_text"),
    )
