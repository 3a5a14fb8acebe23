"""What the corpus operators share: input tables, written intermediate tables, small helpers."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallyweave.session import checkpoint_folder

T = TypeVar("T")

SCHEMAS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "benchmark": "item_id BIGINT, text STRING",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}

# Bytes of whole rows that a Python worker takes at once: many usual texts, or one that
# is longer than that.
BATCH_BYTES = 1_000_000
# Rows that Spark hands to a Python worker at once. The session's default of 10,000 suits
# narrow rows; whole texts of 100,000 characters would fill the worker.
ROWS_HANDED = "1000"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table under its fixed schema."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again.

    This cuts the lineage, survives lost executors, and tells the planner how large the
    table really is, so a join broadcasts it only below the session's own limit. Results
    may still read it, so it stays until ``remove_written``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[str] = []


def remove_written(spark: SparkSession) -> int:
    """Deletes the intermediate tables of this process and returns how many there were; call
    it when the results that were built on them are saved."""
    count = len(_written)
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return count


def in_small_batches(batches: Iterator[pa.RecordBatch], most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes."""
    for batch in batches:
        rows = max(1, int(most * batch.num_rows / max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_batches(
    df: DataFrame, schema: StructType | str, function: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], most: int = BATCH_BYTES
) -> DataFrame:
    """``function`` over slices of about ``most`` bytes of the rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_HANDED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_small_batches(batches, most):
            out = function(batch)
            if isinstance(out, pa.Table):
                yield from out.to_batches()
            else:
                yield out
        give_back_memory()

    return df.mapInArrow(run, schema)


def give_back_memory() -> None:
    """Returns what is free to the system: Python workers outlive tasks, and several of
    them share an executor's memory with the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_held: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], T]) -> T:
    """What ``make`` gives, kept in a Python worker until another key is asked for.

    Workers outlive stages; keeping one operator's tables at a time bounds their memory.
    """
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch, null as empty."""
    return ["" if x is None else x for x in batch.column(column).to_pylist()]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_ascii(c: Column | str) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
