"""Incremental corpus runs: workbook-JSON documents landing in a folder are transformed as they
arrive, with Structured Streaming.

This is the batch transform (R2) run per micro-batch through ``foreachBatch``: each new file
is one workbook; items, fields, violations and the ordered document fragments are written under
``<output>/<table>/batch_id=<n>`` with overwrite, so a replayed batch (after a failure) rewrites
the same folder. Stream progress lives in the checkpoint folder that the caller names: it has to
outlive the process, since a stream started with an empty one numbers its batches from 0 again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.document import write_documents
from ..plans.run import run_transform
from ..sources.sinks import flat_fields
from ..sources.workbook_json import read_workbooks


def document_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming source: one row per landed file ``(workbook_id, value)`` (whole text)."""
    r = spark.readStream.format("text").option("wholetext", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(input_dir).select(F.col("_metadata.file_path").alias("workbook_id"), "value")


def start_transform_stream(spark: SparkSession, input_dir: str, spec: dict, output_dir: str,
                           checkpoint: str, workbook_key: str = "workbook",
                           available_now: bool = False, query_name: str = "sheetdoc_transform",
                           max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental transform; returns the running query."""
    def batch(df: DataFrame, batch_id: int) -> None:
        books = read_workbooks(df, workbook_key)
        res = run_transform(books.cells, spec, rows=books.rows, sheets=books.sheets, mapped=books.mapped)
        part = f"batch_id={batch_id}"
        res.items.write.mode("overwrite").parquet(f"{output_dir}/items/{part}")
        flat_fields(res.fields).write.mode("overwrite").parquet(f"{output_dir}/fields/{part}")
        res.violations.write.mode("overwrite").parquet(f"{output_dir}/violations/{part}")
        write_documents(res.fragments, f"{output_dir}/documents/{part}")

    w = document_stream(spark, input_dir, max_files_per_trigger).writeStream.foreachBatch(batch).option(
        "checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.queryName(query_name).start()
