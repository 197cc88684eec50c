"""The extraction run - raw grids of a corpus of workbooks -> cleaned ``cells`` with merged
ranges filled and vertical merge groups collapsed, plus cross-sheet relations (J1-J3, V6).

Input ``grid``: ``(workbook_id, sheet, sheet_ord, row, col, text, comment, comment_author)``
with row 1 the header row; ``merges``: ``(workbook_id, sheet, min_row, max_row, min_col,
max_col)`` in grid numbering. One lazy plan for every workbook at once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clean, relate
from ..operators.segment import DEFAULT_BLOCK_ROWS
from ..session import materialize

K = ["workbook_id", "sheet"]


@dataclass
class ExtractResult:
    cells: DataFrame
    relations: DataFrame
    unmatched: DataFrame
    report: DataFrame


def run_extract(grid: DataFrame, merges: DataFrame | None = None,
                block_rows: int | None = DEFAULT_BLOCK_ROWS) -> ExtractResult:
    # Sheets with fewer than 2 grid rows produce nothing (no data row joins a header).
    # Stage boundaries: the cleaned cells feed grouping, collapse and the column index; the
    # final cells feed both relation passes and the sink. Checkpointing cuts the lineage there.
    raw = materialize(clean.build_cells(grid.drop("sheet_ord"), merges, block_rows))
    if merges is not None:
        # Only multi-row ranges group rows; data-row numbering = grid row - 2.
        m = merges.select(*K, (F.col("min_row") - 2).alias("min_row"), (F.col("max_row") - 2).alias("max_row"))
        m = m.where(F.col("max_row") >= 0).withColumn("min_row", F.greatest("min_row", F.lit(0)))
        islands = clean.merge_islands(m, block_rows)
        grouped = clean.row_groups(raw, islands, block_rows)
    else:
        grouped = raw.withColumn("group_id", F.col("row_idx"))
    # C8/C9 apply to every group, single rows included ("nan" -> "", values stripped).
    collapsed = clean.collapse_groups(grouped)
    cols = raw.select(*K, "row_idx", "header", "col_idx")
    order = grid.select(*K, "sheet_ord").distinct()
    cells = (collapsed.join(cols, [*K, "row_idx", "header"], "left")
             .join(order, K)
             .select(*K, "sheet_ord", "row_idx", F.coalesce("col_idx", F.lit(0)).alias("col_idx"), "header", "value",
                     "annotation"))
    cells = materialize(cells)
    # one outer join, read three times
    joined = materialize(relate.join_edges(relate.map_edges(cells), relate.key_index(cells)))
    return ExtractResult(cells, *relate.split_edges(joined), relate.relation_report(joined))
