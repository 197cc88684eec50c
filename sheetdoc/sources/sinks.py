"""S4/S5 sinks: flat Parquet tables (default at scale) and the nested JSON forms written as
ordered fragments (one file set per workbook; concatenated in order they are the document)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import MAP_VALUE_KEY
from ..operators.document import value_json, write_documents

K = ["workbook_id", "sheet"]


def write_cells(cells: DataFrame, path: str) -> None:
    """Cleaned cells as Parquet, clustered by workbook/sheet/row for pruning and locality."""
    (cells.repartitionByRange("workbook_id", "sheet", "row_idx")
     .sortWithinPartitions(*K, "row_idx", "col_idx").write.mode("overwrite").parquet(path))


def flat_fields(fields: DataFrame) -> DataFrame:
    """Fields with the value as JSON text (``value_json``), exactly as the document has it."""
    return fields.withColumn("value_json", value_json()).drop("value", "first")


def write_flat(items: DataFrame, fields: DataFrame, path: str) -> None:
    """S4 flat form: ``items`` and ``fields`` Parquet (no nesting; children by ``parent_id``)."""
    items.write.mode("overwrite").parquet(f"{path}/items")
    flat_fields(fields).write.mode("overwrite").parquet(f"{path}/fields")


def _json_key(c):
    j = F.to_json(F.array(c))
    return j.substr(F.lit(2), F.length(j) - 2)


def workbook_json_fragments(cells: DataFrame, workbook_key: str = "workbook",
                            relations: DataFrame | None = None) -> DataFrame:
    """S5 nested form ``{"workbook": {sheet: [ {header: {value, annotation?}, ...} ]}}`` as
    ordered fragments ``(workbook_id, sheet, key array<bigint>, text)``.

    A row's own cells form one fragment (bounded by the column count). With ``relations``
    (J4), a key row also gets ``"__MAPPED_<sheet>": [copies of the related source rows, each
    with "__MAP_VALUE__"]``: the bracket pair per source sheet and every copy are separate
    fragments, so a key referenced by millions of rows never becomes one record. Sort key:
    ``[sheet_ord, part, row, sub, src_sheet_ord, src_row, src_col]``."""
    big = 1 << 62
    cell = F.when(F.col("annotation").isNotNull() & (F.col("annotation") != ""),
                  F.to_json(F.struct("value", "annotation"))).otherwise(F.to_json(F.struct("value")))
    kv = F.struct(F.col("col_idx"), F.concat(_json_key(F.col("header")), F.lit(":"), cell).alias("kv"))
    bodies = cells.groupBy(*K, "sheet_ord", "row_idx").agg(F.array_sort(F.collect_list(kv)).alias("kvs")).select(
        *K, "sheet_ord", "row_idx", F.array_join(F.transform("kvs", lambda x: x["kv"]), ",").alias("body"))
    first_row = bodies.groupBy(*K).agg(F.min("row_idx").alias("__fr"))

    def key(*xs):
        return F.array(*[(x if hasattr(x, "alias") else F.lit(x)).cast("bigint") for x in xs])

    r = bodies.join(first_row, K).select(
        *K, key(F.col("sheet_ord"), 1, F.col("row_idx"), 0, 0, 0, 0).alias("key"),
        F.concat(F.when(F.col("row_idx") == F.col("__fr"), "").otherwise(","), F.lit("{"), F.col("body")).alias("text"))
    r_close = bodies.select(*K, key(F.col("sheet_ord"), 1, F.col("row_idx"), 9, 0, 0, 0).alias("key"), F.lit("}").alias("text"))
    parts = [r, r_close]
    if relations is not None:
        from ..operators.relate import attach_name

        so = cells.select(*K, "sheet_ord").distinct()
        e = (relations
             .join(so.select("workbook_id", F.col("sheet").alias("target_sheet"), F.col("sheet_ord").alias("t_ord")),
                   ["workbook_id", "target_sheet"])
             .join(so.select("workbook_id", F.col("sheet").alias("source_sheet"), F.col("sheet_ord").alias("s_ord")),
                   ["workbook_id", "source_sheet"])
             .withColumn("attach", attach_name(F.col("source_sheet"))))
        # Copies of the source rows as they were before injection, plus the map value.
        src = bodies.select("workbook_id", F.col("sheet").alias("source_sheet"), F.col("row_idx").alias("source_row"), "body")
        copies = e.join(src, ["workbook_id", "source_sheet", "source_row"], "left")
        firsts = copies.groupBy("workbook_id", "target_sheet", "target_row", "s_ord").agg(
            F.min(F.struct("source_row", F.xxhash64("map_value").alias("h"))).alias("__f"))
        c = copies.join(firsts, ["workbook_id", "target_sheet", "target_row", "s_ord"])
        comma = F.when(F.struct("source_row", F.xxhash64("map_value").alias("h")) == F.col("__f"), "").otherwise(",")
        body = F.concat(F.lit("{"), F.coalesce("body", F.lit("")),
                        F.when(F.coalesce("body", F.lit("")) == "", "").otherwise(","),
                        F.lit(json.dumps(MAP_VALUE_KEY) + ":"), _json_key(F.col("map_value")), F.lit("}"))
        parts.append(c.select(F.col("workbook_id"), F.col("target_sheet").alias("sheet"),
                              key(F.col("t_ord"), 1, F.col("target_row"), 2, F.col("s_ord"), F.col("source_row"),
                                  F.xxhash64("map_value")).alias("key"),
                              F.concat(comma, body).alias("text")))
        grp = firsts.join(e.select("workbook_id", "target_sheet", "s_ord", "attach", "t_ord").distinct(),
                          ["workbook_id", "target_sheet", "s_ord"])
        parts.append(grp.select("workbook_id", F.col("target_sheet").alias("sheet"),
                                key(F.col("t_ord"), 1, F.col("target_row"), 1, F.col("s_ord"), 0, 0).alias("key"),
                                F.concat(F.lit(","), _json_key(F.col("attach")), F.lit(":[")).alias("text")))
        parts.append(grp.select("workbook_id", F.col("target_sheet").alias("sheet"),
                                key(F.col("t_ord"), 1, F.col("target_row"), 3, F.col("s_ord"), 0, 0).alias("key"),
                                F.lit("]").alias("text")))
    sheets = cells.select(*K, "sheet_ord").distinct()
    first_sheet = sheets.groupBy("workbook_id").agg(F.min("sheet_ord").alias("__fs"))
    s2 = sheets.join(first_sheet, "workbook_id")
    parts.append(s2.select(*K, key(F.col("sheet_ord"), 0, 0, 0, 0, 0, 0).alias("key"),
                           F.concat(F.when(F.col("sheet_ord") == F.col("__fs"), "").otherwise(","),
                                    _json_key(F.col("sheet")), F.lit(":[")).alias("text")))
    parts.append(s2.select(*K, key(F.col("sheet_ord"), 2, 0, 0, 0, 0, 0).alias("key"), F.lit("]").alias("text")))
    wbs = sheets.select("workbook_id").distinct()
    none = F.lit(None).cast("string").alias("sheet")
    parts.append(wbs.select("workbook_id", none, key(-1, 0, 0, 0, 0, 0, 0).alias("key"),
                            F.lit("{" + json.dumps(workbook_key) + ":{").alias("text")))
    parts.append(wbs.select("workbook_id", none, key(big, 0, 0, 0, 0, 0, 0).alias("key"), F.lit("}}").alias("text")))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


__all__ = ["write_cells", "write_flat", "flat_fields", "value_json", "write_documents", "workbook_json_fragments"]
