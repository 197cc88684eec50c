"""Session helpers.

Library code never builds its own session; callers pass one in. ``get_session`` exists for
tests, ``bench.py`` and command-line use, and only sets what is unset, so a cluster's own
configuration always wins.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints and shuffled objects serialize faster with Kryo (measured ~10% on the
    # document queries)
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # checkpoint files of collected DataFrames are removed (they are only stage boundaries)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str = "local[8]", app: str = "sheetdoc", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(_DEFAULTS)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    It must be on a file system that the driver and all executors share, so it is read from the
    session. Where it is unset, a session on a local master (tests, bench) gets a scratch folder;
    on a cluster there is no safe default and the call raises."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="sheetdoc-ckpt-", dir=os.environ.get("SHEETDOC_SCRATCH"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


MATERIALIZE_CONF = "spark.sheetdoc.materialize"


def materialize(df):
    """Cut lineage at a stage boundary by checkpointing into the shared checkpoint folder.

    Reliable checkpoint files survive executor loss (unlike cached blocks or local
    checkpoints); used where a result is read several times (scoped contexts, items/fields of a
    document, extracted cells). ``spark.sheetdoc.materialize=none`` keeps the plan lazy
    instead (recompute rather than write), for clusters where that is cheaper."""
    if df.sparkSession.conf.get(MATERIALIZE_CONF, "checkpoint") == "none":
        return df
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the checkpoint folder, whatever ``spark.sheetdoc.materialize`` says:
    for rows that may differ when they are computed again (numbers given by a range sort)."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/frames/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_all(dfs: list[DataFrame]) -> list[DataFrame]:
    """``materialize`` for several frames in one job: they are written together, each to a
    partition of its own of one Parquet table in the checkpoint folder, and read back from there.

    Frames may differ in columns; a column of the same name has the same type in all of them."""
    if len(dfs) <= 1 or dfs[0].sparkSession.conf.get(MATERIALIZE_CONF, "checkpoint") == "none":
        return [materialize(df) for df in dfs]
    spark = dfs[0].sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/frames/{uuid.uuid4().hex}"
    numbered = [df.withColumn("__frame", F.lit(i)) for i, df in enumerate(dfs)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    every.write.partitionBy("__frame").parquet(path)
    fields = [f for f in every.schema.fields if f.name != "__frame"]
    back = spark.read.schema(T.StructType([*fields, T.StructField("__frame", T.IntegerType())])).parquet(path)
    return [back.where(F.col("__frame") == i).select(*df.columns) for i, df in enumerate(dfs)]
