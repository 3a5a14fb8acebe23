"""Session defaults, the checkpoint folder rule, and parts of a plan that are computed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call sites on every Column slow plan building and serve debugging only.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "tallyweave", **extra: str) -> SparkSession:
    """A session for tests and the bench; on a cluster, use the session that is given."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names; without one, nothing is written."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder


def shared(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` in one exchange that all its readers use.

    Spark reuses an exchange where two plans below it are equal, but it moves each reader's
    choice of columns and filters below the exchange first, which makes them differ. Nothing
    moves past the step behind this exchange, so it is computed once in a query, lazily, and
    a lost executor costs only the lost blocks.
    """
    return df.repartition(*keys).mapInArrow(_unchanged, df.schema)


def _unchanged(batches):
    return batches
