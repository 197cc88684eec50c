"""Cross-sheet relations from ``[MAP]`` columns to ``(Key)`` columns, and lookups.

Edges stay flat (one row per relation). The reference's nested ``__MAPPED_<sheet>`` copy (J4)
is offered as the same flat frame keyed by the attach column name; nesting would collect an
unbounded list into one cell, so it is left to the document writer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

K = ["workbook_id", "sheet"]


def key_index(cells: DataFrame) -> DataFrame:
    """Per sheet the first header (by column) containing ``(Key)``; every non-empty value
    of it -> its row, across all sheets of a workbook; a duplicate key keeps the last
    (sheet order, then row). ``cells`` needs ``sheet_ord``.

    Returns ``(workbook_id, key, sheet, row_idx)``. Both steps are partial aggregates."""
    key_cols = cells.where(F.col("header").contains(tx.KEY_SUFFIX)).groupBy(*K).agg(
        F.min_by("header", "col_idx").alias("key_header"))
    vals = cells.join(key_cols, K).where(F.col("header") == F.col("key_header")).select(
        "workbook_id", "sheet", "sheet_ord", "row_idx", tx.py_strip(F.coalesce("value", F.lit(""))).alias("key"))
    return vals.where(F.col("key") != "").groupBy("workbook_id", "key").agg(
        F.max_by(F.struct("sheet", "row_idx"), F.struct("sheet_ord", "row_idx")).alias("t")
    ).select("workbook_id", "key", F.col("t.sheet").alias("sheet"), F.col("t.row_idx").alias("row_idx"))


def map_edges(cells: DataFrame) -> DataFrame:
    """A ``[MAP]`` cell (header prefix any case) whose upper-trimmed value is not one of
    the falsy values makes an edge ``(workbook_id, source_sheet, source_row, slug, map_value)``;
    slug = header text after the 5-character prefix, trimmed."""
    m = cells.where(F.upper(F.col("header")).startswith(tx.MAP_PREFIX))
    val = F.upper(tx.py_strip(F.coalesce("value", F.lit(""))))
    return m.select(
        "workbook_id", F.col("sheet").alias("source_sheet"), F.col("row_idx").alias("source_row"),
        tx.py_strip(F.col("header").substr(F.lit(len(tx.MAP_PREFIX) + 1), F.length("header"))).alias("slug"),
        val.alias("map_value"),
    ).where(~F.col("map_value").isin(*tx.FALSY_MAP_VALUES))


def join_edges(edges: DataFrame, keys: DataFrame) -> DataFrame:
    """Every edge with the row that its slug names (case-sensitive, within a workbook) and a
    flag whether there is one: ``(workbook_id, target_sheet, target_row, source_sheet, source_row,
    map_value, target_key, matched)``. One outer join feeds relations, unmatched edges and counts.

    The key index is one row per distinct key; AQE broadcasts it when its measured size allows,
    else it is a shuffled join; a hot key is split by AQE skew join."""
    return edges.join(keys.withColumnRenamed("key", "slug"), ["workbook_id", "slug"], "left").select(
        "workbook_id", F.col("sheet").alias("target_sheet"), F.col("row_idx").alias("target_row"),
        "source_sheet", "source_row", "map_value", F.col("slug").alias("target_key"), F.col("sheet").isNotNull().alias("matched"))


def match_edges(edges: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(relations, unmatched edges)."""
    return split_edges(join_edges(edges, keys))


def split_edges(joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(relations, unmatched edges) of joined edges."""
    unmatched = joined.where(~F.col("matched")).select("workbook_id", F.col("target_key").alias("slug"), "source_sheet", "source_row", "map_value")
    return joined.where("matched").drop("matched"), unmatched


def attach_name(source_sheet: Column) -> Column:
    """The ``__MAPPED_<sheet>`` attach column (non-alphanumerics -> ``_``)."""
    return F.concat(F.lit(tx.MAPPED_PREFIX), F.regexp_replace(source_sheet, "[^a-zA-Z0-9]", "_"))


def relation_report(joined: DataFrame) -> DataFrame:
    """V6: per workbook counts of edges, matched and unmatched ones, in one pass."""
    return joined.groupBy("workbook_id").agg(
        F.count("*").alias("edges"), F.count_if("matched").alias("matched"), F.count_if(~F.col("matched")).alias("unmatched"))


def lookup(rows: DataFrame, other: DataFrame, left_on: str | Column, right_on: str, take: dict[str, str],
           order_col: str = "row_idx", how: str = "left") -> DataFrame:
    """For each row, the first row of ``other`` (by ``order_col``) whose ``right_on``
    equals ``left_on``; ``take`` maps output name -> column of ``other``.

    The right side is first reduced to one row per key (partial aggregate), so the join never
    multiplies rows; ``how='left_semi'``/``'left_anti'`` give existence tests."""
    first = other.groupBy(right_on).agg(
        F.min_by(F.struct(*[F.col(c).alias(o) for o, c in take.items()]), order_col).alias("__m"))
    lk = first.select(F.col(right_on).alias("__lk"), *[F.col(f"__m.{o}").alias(o) for o in take])
    cond = (tx.col_(left_on) == F.col("__lk"))
    if how in ("left_semi", "left_anti"):
        return rows.join(lk, cond, how)
    return rows.join(lk, cond, how).drop("__lk")
