"""Extraction-side cleaning of a raw grid into the ``cells`` table.

Inputs are long tables (one row per cell), keyed by ``(workbook_id, sheet)``:

* grid  ``(workbook_id, sheet, row, col, text, comment, comment_author)``; row 1 is the header row
* merged ranges  ``(workbook_id, sheet, min_row, max_row, min_col, max_col)``

Nothing is collected per sheet and no range is expanded to its rows: merged ranges and row groups
are intervals, and a running cover (a blocked prefix scan over interval starts and rows together)
tells which one a row lies in. Groups collapse by two aggregations, the first per value, so a hot
group is folded map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .segment import DEFAULT_BLOCK_ROWS, prefix_max

K = ["workbook_id", "sheet"]

# Possessive quantifiers: no backtracking on long runs of groups; the result cannot change
# because whitespace never matches "(" and "[^)]" never matches ")".
_TRAILING_PARENS = f"(?:[{tx.WS}]*+\\([^)]*+\\))++[{tx.WS}]*+$"


def _strip_parens(h: Column) -> Column:
    """Remove every trailing ``(...)`` group (the reference's fixed-point loop), then strip."""
    return tx.py_strip(F.regexp_replace(h, _TRAILING_PARENS, ""))


def normalize_header(h) -> Column:
    """Trim; drop trailing ``(...)`` groups; keep a header ending in ``(Key)`` whole (T1);
    for ``[MAP]`` headers (any case) clean only the slug and rebuild ``prefix slug``;
    ``Unnamed*`` and empty headers are returned as they are (stripped); NULL stays NULL."""
    raw = tx.col_(h)
    s = tx.py_strip(raw)
    is_map = F.upper(s).startswith(tx.MAP_PREFIX)
    br = F.instr(s, "]")
    prefix = s.substr(F.lit(1), br)
    slug = _strip_parens(tx.py_strip(s.substr(br + 1, F.length(s))))
    map_h = F.when(slug == "", prefix).otherwise(tx.py_strip(F.concat(prefix, F.lit(" "), slug)))
    return (
        F.when(raw.isNull(), F.lit(None).cast("string"))
        .when((s == "") | s.startswith(tx.UNNAMED_PREFIX), s)
        .when(is_map, map_h)
        .when(s.rlike(tx.quote_literal(tx.KEY_SUFFIX) + f"[{tx.WS}]*$"), s)
        .otherwise(_strip_parens(s))
    )


def keep_header(h: Column) -> Column:
    """Headers that are NULL, empty or start with ``Unnamed`` are dropped."""
    return h.isNotNull() & (h != "") & ~h.startswith(tx.UNNAMED_PREFIX)


def clean_headers(h: Column) -> Column:
    """S2 + C1 to be exploded: the normalized header, or nothing if it is dropped. The array keeps
    the optimizer from running the normalization again in each test of the result."""
    return F.filter(F.array(normalize_header(h)), keep_header)


def build_cells(grid: DataFrame, merges: DataFrame | None = None,
                block_rows: int | None = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """S2 + C3 + C4 + C5 + C6 + C2: grid -> cells ``(workbook_id, sheet, row_idx, col_idx,
    header, value, annotation, is_merged)``; ``row_idx`` = grid row - 2 (first data row = 0).

    Sheets with fewer than 2 rows give nothing. Header row joined on (workbook, sheet, col):
    a plain equi-join that AQE may broadcast after measuring it.
    """
    headers = grid.where(F.col("row") == 1).select(*K, "col", F.explode(clean_headers(F.col("text"))).alias("header"))
    ann = F.when(F.coalesce(F.col("comment"), F.lit("")) != "",
                 tx.parse_annotation(F.col("comment"), F.col("comment_author")))
    cells = grid.select(*K, "row", "col", tx.clean_value(F.col("text")).alias("value"), ann.alias("annotation"))
    if merges is not None:
        cells = fill_merged(cells, merges, block_rows)
    else:
        cells = cells.withColumn("is_merged", F.lit(False))
    # a range that begins in the header row copies the header's text, so that row leaves only now
    j = cells.where(F.col("row") >= 2).join(headers, [*K, "col"])
    out = j.select(*K, (F.col("row") - 2).cast("bigint").alias("row_idx"), F.col("col").cast("int").alias("col_idx"),
                   "header", "value", "annotation", "is_merged")
    return resolve_duplicate_headers(out)


def running_cover(rows: DataFrame, spans: DataFrame, by: list[str], at: str, out: str,
                  block_rows: int | None = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``out``: the span (a struct that begins with ``start`` and ``end``, both
    included) of ``spans`` that covers their position ``at``, or NULL.

    Spans of one key may not overlap. Their starts are put among the rows, just before the row at
    the same position, and the last one at or before a row is carried to it: a row is covered if that
    span has not ended. No interval is expanded and no range is joined."""
    order = F.col(at).cast("bigint") * 2
    starts = spans.select(*by, (F.col(f"{out}.start").cast("bigint") * 2).alias("__o"), F.col(out).alias("__span"))
    marked = rows.withColumn("__o", order + 1).withColumn("__row", F.lit(True)).unionByName(starts, allowMissingColumns=True)
    filled = prefix_max(marked, F.col("__span"), by, "__o", "__last", True, block_rows)
    return filled.where(F.col("__row")).withColumn(
        out, F.when(F.col(at) <= F.col("__last.end"), F.col("__last"))).drop("__o", "__row", "__span", "__last")


def column_spans(merges: DataFrame, top_left: DataFrame, block_rows: int | None = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Merged ranges as spans of rows that do not overlap, per column: ``(workbook_id, sheet, col,
    span(start, end, value, annotation))``.

    A range is put into each column it covers (a sheet's width, not its height). Ranges of one
    column that overlap - not possible in a real workbook - are cut at each other's ends; each piece
    goes to the range with the greatest (min_row, min_col)."""
    own = merges.join(top_left, [*K, "min_row", "min_col"], "left")
    per_col = own.select(*K, F.explode(F.sequence("min_col", "max_col")).alias("col"),
                         F.struct("min_row", "min_col").alias("prio"), "min_row", "max_row", "value", "annotation")
    by = [*K, "col"]
    # pieces: islands of ranges that overlap; nearly always one range each
    ends = per_col.groupBy(*by, "min_row").agg(F.max("max_row").alias("e"))
    before = prefix_max(ends, F.col("e"), by, "min_row", "__prev", False, block_rows)
    starts = before.withColumn("__new", F.when(F.col("__prev").isNull() | (F.col("min_row") > F.col("__prev")), F.col("min_row")))
    island = prefix_max(starts, F.col("__new"), by, "min_row", "island", True, block_rows).select(*by, "min_row", "island")
    placed = per_col.join(island, [*by, "min_row"])
    cuts = placed.select(*by, "island", F.explode(F.array(F.col("min_row"), F.col("max_row") + 1)).alias("start")).distinct()
    after = F.lead("start").over(Window.partitionBy(*by, "island").orderBy("start"))
    pieces = cuts.withColumn("end", after - 1).where(F.col("end").isNotNull())
    best = pieces.join(placed, [*by, "island"]).where((F.col("min_row") <= F.col("start")) & (F.col("start") <= F.col("max_row")))
    return best.groupBy(*by, "start", "end").agg(F.max_by(F.struct("value", "annotation"), "prio").alias("w")).select(
        *by, F.struct("start", "end", F.col("w.value").alias("value"), F.col("w.annotation").alias("annotation")).alias("span"))


def fill_merged(cells: DataFrame, merges: DataFrame, block_rows: int | None = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Every data cell a merged range covers takes the range's top-left cell.

    ``cells`` has the header row, which is read but never filled; positions outside the grid are
    ignored (a grid carries every position, blanks included). Per column the ranges are spans of
    rows, found by a running cover. Overlapping ranges (not possible in a real workbook) resolve to
    the range with the greatest (min_row, min_col)."""
    top_left = cells.select(*K, F.col("row").alias("min_row"), F.col("col").alias("min_col"), "value", "annotation")
    spans = column_spans(merges, top_left, block_rows)
    j = running_cover(cells, spans, [*K, "col"], "row", "span", block_rows)
    merged = F.col("span").isNotNull() & (F.col("row") >= 2)
    return j.select(
        *K, "row", "col",
        F.when(merged, F.coalesce(F.col("span.value"), F.lit(""))).otherwise(F.col("value")).alias("value"),
        F.when(merged, F.col("span.annotation")).otherwise(F.col("annotation")).alias("annotation"),
        merged.alias("is_merged"),
    )


def resolve_duplicate_headers(cells: DataFrame) -> DataFrame:
    """Two columns with the same header after C1 -> the later dict write wins: the
    rightmost plain cell, then any merged cell over it (T2). One partial aggregate."""
    return cells.groupBy(*K, "row_idx", "header").agg(
        F.max_by(F.struct("value", "annotation", "col_idx"), F.struct("is_merged", "col_idx")).alias("w")
    ).select(*K, "row_idx", F.col("w.col_idx").alias("col_idx"), "header",
             F.col("w.value").alias("value"), F.col("w.annotation").alias("annotation"))


def header_collisions(headers: DataFrame) -> DataFrame:
    """C2 report: ``(workbook_id, sheet, header, n_cols, winner_col)`` for clean headers that
    more than one raw column maps to. ``headers``: ``(workbook_id, sheet, col_idx, header)``."""
    return headers.groupBy(*K, "header").agg(
        F.count("*").alias("n_cols"), F.max("col_idx").alias("winner_col")
    ).where(F.col("n_cols") > 1)


def merge_islands(merges: DataFrame, block_rows: int | None = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Rows covered by one multi-row range share a group; overlapping ranges chain into one
    connected interval (T4). Returns ``(workbook_id, sheet, island_start, island_end, n_ranges)``
    with rows in data-row numbering as given.

    Gaps-and-islands with blocked prefix scans: ranges fold per start row (partial aggregate),
    an exclusive running max of ends finds island starts, a forward fill names the island."""
    multi = merges.where(F.col("max_row") > F.col("min_row"))
    starts = multi.groupBy(*K, "min_row").agg(F.max("max_row").alias("max_row"), F.count("*").alias("n"))
    prev = prefix_max(starts, F.col("max_row"), K, "min_row", "__prev_end", inclusive=False, block_rows=block_rows)
    is_start = F.col("__prev_end").isNull() | (F.col("min_row") > F.col("__prev_end"))
    named = prefix_max(prev, F.when(is_start, F.col("min_row")), K, "min_row", "island_start",
                       inclusive=True, block_rows=block_rows)
    return named.groupBy(*K, "island_start").agg(F.max("max_row").alias("island_end"), F.sum("n").alias("n_ranges"))


def row_groups(rows: DataFrame, islands: DataFrame, block_rows: int | None = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``group_id`` per row = its island start, or the row itself: a running cover of the
    islands, which do not overlap."""
    spans = islands.select(*K, F.struct(F.col("island_start").cast("bigint").alias("start"), F.col("island_end").cast("bigint").alias("end")).alias("__island"))
    covered = running_cover(rows, spans, K, "row_idx", "__island", block_rows)
    return covered.withColumn("group_id", F.coalesce(F.col("__island.start"), F.col("row_idx"))).drop("__island")


def collapse_groups(cells: DataFrame, group_col: str = "group_id", order_col: str = "row_idx") -> DataFrame:
    """C8 + C9: one row per group and header: unique non-empty, non-``nan`` values joined with
    ``", "`` in first-seen order; the first non-empty annotation; ``row_idx`` = first row.

    Two levels: first one partial per value (its first row, its first annotation and where), then
    one per group. The list of a group holds only distinct values - the size of the output cell
    itself - and nothing is joined back."""
    noted = F.coalesce(F.col("annotation"), F.lit("")) != ""
    keyed = cells.withColumn("__v", tx.py_strip(F.coalesce(F.col("value"), F.lit(""))))
    values = keyed.groupBy(*K, group_col, "header", "__v").agg(
        F.min(order_col).alias("__first"), F.min(F.when(noted, F.struct(F.col(order_col).alias("at"), "annotation"))).alias("__note"))
    shown = F.when(~F.col("__v").isin(*tx.COLLAPSE_SKIP), F.struct("__first", "__v"))
    return values.groupBy(*K, group_col, "header").agg(
        F.min("__first").alias(order_col), F.min("__note").alias("__note"), F.array_sort(F.collect_list(shown)).alias("__vs"),
    ).select(*K, group_col, order_col, "header",
             F.array_join(F.transform("__vs", lambda x: x["__v"]), tx.COLLAPSE_SEP).alias("value"), F.col("__note.annotation").alias("annotation"))
