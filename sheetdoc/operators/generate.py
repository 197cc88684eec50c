"""Row generators (unpivot, explode, group-with-scope) and EAV dynamic fields.

All are narrow projections or one aggregation with map-side partial aggregation; none collects
a group into one row. A group's rows stay un-nested and are found again by key (G3 scope).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..model import qcol
from .project import BASE_CELL, CELL, COLUMN, RowView

NULL_CELL = "struct<value:string,annotation:string>"


def unpivot_variants(parents: DataFrame, keep: list[str], base_col: str, data_cols: list[str],
                     headers: dict[str, str]) -> DataFrame:
    """G1 ``expand_variants``: one row per ``column_data`` header with ``__column__``,
    ``__cell__``, ``__base_cell__``; ``__ord`` is the variant's position. ``headers`` maps headers
    to columns; one that the sheet lacks gives a cell with NULL value (the reference's ``{}``)."""
    def cell_of(h):
        return qcol(headers[h]) if h in headers else F.lit(None).cast(NULL_CELL)

    base = cell_of(base_col) if base_col else F.lit(None).cast(NULL_CELL)
    variants = F.array(*[
        F.struct(F.lit(h).alias(COLUMN), cell_of(h).alias(CELL)) for h in data_cols
    ]) if data_cols else F.array().cast(f"array<struct<{COLUMN}:string,{CELL}:{NULL_CELL}>>")
    return parents.select(*keep, base.alias(BASE_CELL), F.posexplode(variants).alias("__vpos", "__v")).select(
        *keep,
        F.col("__v").getField(COLUMN).alias(COLUMN),
        F.col("__v").getField(CELL).alias(CELL),
        F.col(BASE_CELL),
        F.col("__vpos").cast("bigint").alias("__ord"),
        F.lit(0).cast("bigint").alias("__sub"),
    )


def explode_parts(ctx: DataFrame, view: RowView, column: str, sep: str, out: str) -> DataFrame:
    """Split a cell on a literal delimiter, drop one leading and one trailing space from each
    part, one row per part; the part becomes cell column ``out`` and ``__sub`` its 1-based
    position. Other columns are kept."""
    parts = F.transform(
        tx.split_literal(view.value(column), sep),
        lambda p: tx.rtrimstr(tx.ltrimstr(p, " "), " "),
    )
    return (
        ctx.select("*", F.posexplode(parts).alias("__pp", "__part"))
        .withColumn(out, F.struct(F.col("__part").alias("value"), F.lit(None).cast("string").alias("annotation")))
        .withColumn("__sub", (F.col("__pp") + 1).cast("bigint"))
        .drop("__pp", "__part")
    )


def group_representatives(ctx: DataFrame, partition_by: list[str], key: Column, drop_empty: bool,
                          count_as: str | None = None) -> DataFrame:
    """One row per (context, key) - the group's first row - with ``__gkey`` = key.

    ``min_by`` is a partial aggregate, so a hot key is folded map-side before the shuffle.
    Groups order by key (the caller sorts items by ``__gkey``)."""
    cols = [c for c in ctx.columns if c not in partition_by]
    keyed = ctx.withColumn("__gkey", key)
    if drop_empty:
        keyed = keyed.where(F.coalesce(F.col("__gkey"), F.lit("")) != "")
    extra = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    rep = keyed.groupBy(*partition_by, "__gkey").agg(
        F.min_by(F.struct(*[qcol(c) for c in cols]), F.struct(F.col("__ord"), F.col("__sub"))).alias("__r"),
        *extra,
    )
    return rep.select(*partition_by, "__gkey", *[F.col("__r").getField(c).alias(c) for c in cols],
                      *([count_as] if count_as else []))


def dynamic_fields(scope: DataFrame, view: RowView, dyn: dict, n_static: int,
                   filter_col: Column | None) -> DataFrame:
    """Each scope row gives ``{name, value, type?}`` from two columns; empty names skipped.

    ``scope`` has ``__item`` (owning item id), ``__ord``, ``__sub`` plus the row's columns.
    Returns ``(workbook_id, sheet, __item, field struct, empty_required flag)``.
    """
    name = tx.py_strip(view.value(dyn.get("name_from", "")))
    value = tx.py_strip(view.value(dyn.get("value_from", "")))
    rows = scope if filter_col is None else scope.where(filter_col)
    typ = tx.resolve_type(value, dyn.get("type")) if dyn.get("type") else F.lit(None).cast("string")
    fkey = F.struct(F.lit(n_static).alias("i"), F.col("__ord").alias("r"), F.col("__sub").alias("s"))
    st = F.struct(
        name.alias("name"), value.cast("variant").alias("value"), value.alias("text"), typ.alias("type"),
        F.lit(None).cast("string").alias("relationKey"), fkey.alias("fkey"),
    )
    return rows.where(name != "").select(
        "workbook_id", "sheet", "__item", "__ipath", "row_idx", st.alias("f"),
        ((value == "") & F.lit(bool(dyn.get("required")))).alias("__empty_required"),
    )
