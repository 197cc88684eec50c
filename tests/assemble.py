"""Concatenates a small document's fragments on the driver (tests only)."""

from pyspark.sql import functions as F


def assemble_small(fragments, workbook_id=None):
    own = fragments if workbook_id is None else fragments.where(F.col("workbook_id") == workbook_id)
    return "".join(r[0] for r in own.orderBy("key").select("text").collect())
