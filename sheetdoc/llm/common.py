"""Helpers that several operators share: staged tables and Arrow batch size."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetdoc.session import ensure_checkpoint_dir

#: Rows of one Arrow batch handed to Python. Texts differ widely in length, so the default of
#: 10,000 rows could be gigabytes; a session that names its own smaller value keeps it.
BATCH_ROWS = 512

_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Whether a query's shuffle files are deleted at its end, or when the driver happens to collect them.
_SHUFFLE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep a Python worker's batch small whatever the length of the texts."""
    if int(spark.conf.get(_BATCH_CONF)) > rows:
        spark.conf.set(_BATCH_CONF, str(rows))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but columnar: the files survive lost executors, are
    computed once, and give the planner their real size, so that it broadcasts a side only when
    that side has been measured to be small. The rows are in the files then, so the shuffles that
    made them leave the disk at once."""
    return Staged([df], label).rows


class Staged:
    """``parts`` (of one schema) in one staged table, written one after the other, so that no more
    than one part's shuffles are on disk. ``rows`` reads it, until ``drop`` empties it."""

    def __init__(self, parts: list[DataFrame], label: str):
        self.spark, self.schema = parts[0].sparkSession, parts[0].schema
        self.path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"
        before = self.spark.conf.get(_SHUFFLE_CONF, "false")
        self.spark.conf.set(_SHUFFLE_CONF, "true")
        try:
            for part in parts:
                part.write.mode("append").parquet(self.path)
        finally:
            self.spark.conf.set(_SHUFFLE_CONF, before)
        self.rows = self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        """Take the rows off the disk; nothing may read them any more."""
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
        self.spark.range(0, 0, 1, 1).select(*none).write.mode("overwrite").parquet(self.path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
