"""V1-V6: data-quality operators. Violations are data (a frame), raised only in strict mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

VIOLATION_COLS = ["workbook_id", "sheet", "item_id", "row_idx", "field", "reason"]


class RequiredFieldError(Exception):
    """A required field resolved to a blank value (strict mode)."""


def empty_violations(spark) -> DataFrame:
    return spark.createDataFrame(
        [], "workbook_id string, sheet string, item_id string, row_idx bigint, field string, reason string"
    )


def required_names_violations(items: DataFrame, generated: DataFrame | None, names: list[str]) -> DataFrame | None:
    """V3: every named field must be among an item's generated fields (``generated``) and be
    non-blank there; the last duplicate wins. Static fields do not count.

    One conditional aggregation per item (no cross join): ``max_by(text, fkey)`` per name. Item ids
    repeat in every workbook and sheet, so both are part of the key."""
    if not names:
        return None
    key = ["workbook_id", "sheet", "item_id"]
    it = items.select(*key, "row_idx")
    if generated is None:
        j = it.select("*", *[F.lit(None).cast("string").alias(f"__r{i}") for i in range(len(names))])
    else:
        agg = generated.groupBy(*key).agg(*[
            F.max_by(F.when(F.col("name") == n, F.col("text")), F.when(F.col("name") == n, F.col("fkey"))).alias(f"__r{i}")
            for i, n in enumerate(names)
        ])
        j = it.join(agg, key, "left")
    per = F.array(*[
        F.when(tx.is_blank(F.col(f"__r{i}")), F.struct(F.lit(n).alias("field"), F.lit("required_field_missing").alias("reason")))
        for i, n in enumerate(names)
    ])
    return j.select(*key, "row_idx", F.explode(F.filter(per, lambda x: x.isNotNull())).alias("v")).select(
        *key, "row_idx", F.col("v.field").alias("field"), F.col("v.reason").alias("reason"))


def error_values(fields: DataFrame) -> DataFrame:
    """V5: fields whose value carries the transform error sentinel."""
    return fields.where(F.col("text").startswith(tx.ERR_PREFIX))


def enforce(violations: DataFrame, strict: bool) -> None:
    """V1: in strict mode any violation aborts the run (one small action)."""
    if strict:
        first = violations.limit(1).collect()
        if first:
            r = first[0]
            raise RequiredFieldError(
                f"field {r['field']!r} of item {r['item_id']} is blank (workbook {r['workbook_id']}, sheet {r['sheet']}, row {r['row_idx']})"
            )


def workbook_check(raw: DataFrame, text_col: str = "value", workbook_key: str = "workbook") -> DataFrame:
    """V4: structure check of workbook JSON documents; one row per finding ('ok' when none).

    Order of checks as the reference: valid JSON, top-level object, has the key, key is an
    object. The key is a parameter (T21)."""
    v = tx.strict_json(F.col(text_col))
    kind = F.schema_of_variant(v)
    sub = F.try_variant_get(v, f"$['{workbook_key}']", "variant")
    status = (
        F.when(v.isNull(), F.lit("invalid_json"))
        .when(~kind.startswith("OBJECT<"), F.lit("not_an_object"))
        .when(sub.isNull(), F.lit("missing_key"))
        .when(~F.schema_of_variant(sub).startswith("OBJECT<"), F.lit("key_not_an_object"))
        .otherwise(F.lit("ok"))
    )
    return raw.withColumn("status", status)
