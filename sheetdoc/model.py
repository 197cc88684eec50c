"""Data model: cells, sheet frames and the key columns every operator carries.

* ``cells``  long table ``(workbook_id, sheet, sheet_ord, row_idx, col_idx, header, value,
  annotation)``: the storage form for a corpus of spreadsheets.
* sheet frame  one row per sheet row: ``workbook_id, sheet, row_idx`` plus one column per
  header holding a ``struct<value:string, annotation:string>`` cell. NULL cell = header absent.

Order is explicit: nothing relies on file order; ``row_idx`` is a bigint that sorts rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .session import materialize_all

WB, SHEET, ROW = "workbook_id", "sheet", "row_idx"
KEY = [WB, SHEET]

CELL_TYPE = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("annotation", T.StringType()),
])

CELLS_SCHEMA = T.StructType([
    T.StructField(WB, T.StringType()),
    T.StructField(SHEET, T.StringType()),
    T.StructField("sheet_ord", T.IntegerType()),
    T.StructField(ROW, T.LongType()),
    T.StructField("col_idx", T.IntegerType()),
    T.StructField("header", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("annotation", T.StringType()),
])


def qcol(name: str) -> Column:
    """Column by exact name (headers may hold dots, spaces or backticks)."""
    return F.col("`" + name.replace("`", "``") + "`")


def cell(value, annotation=None) -> Column:
    """Build a cell struct from a value (Column or literal) and optional annotation."""
    v = value if isinstance(value, Column) else F.lit(value)
    a = annotation if isinstance(annotation, Column) else F.lit(annotation)
    return F.struct(v.cast("string").alias("value"), a.cast("string").alias("annotation"))


def empty_cell() -> Column:
    return cell(F.lit(""), F.lit(None))


def as_sheet(df: DataFrame, workbook_id, sheet, row_idx, cells: dict) -> DataFrame:
    """Turn any table into a sheet frame.

    ``cells`` maps header -> Column (value) or ``(value, annotation)`` pair. Values are cast to
    text; NULL values become '' as the extractor writes them.
    """
    cols = [
        (workbook_id if isinstance(workbook_id, Column) else F.lit(workbook_id)).cast("string").alias(WB),
        (sheet if isinstance(sheet, Column) else F.lit(sheet)).cast("string").alias(SHEET),
        (row_idx if isinstance(row_idx, Column) else F.col(row_idx)).cast("bigint").alias(ROW),
    ]
    for h, spec in cells.items():
        v, a = spec if isinstance(spec, tuple) else (spec, None)
        v = F.col(v) if isinstance(v, str) else v
        a = F.col(a) if isinstance(a, str) else a
        cols.append(cell(F.coalesce(v.cast("string"), F.lit("")), a).alias(h))
    return df.select(*cols)


def sheet_to_cells(sheet_df: DataFrame, headers: list[str], sheet_ord: Column | int = 0) -> DataFrame:
    """Wide sheet frame -> long ``cells`` (one row per non-NULL cell), via ``unpivot``. Columns are
    told apart by position: headers may differ in case only or equal a key column's name."""
    at = {h: i for i, h in enumerate(sheet_df.columns)}
    plain = sheet_df.toDF(*[f"x{i}" for i in range(len(sheet_df.columns))])
    tagged = plain.select(
        *[F.col(f"x{sheet_df.columns.index(k)}").alias(k) for k in (WB, SHEET, ROW)],
        *[F.struct(F.lit(i + 1).alias("col_idx"), F.lit(h).alias("header"), F.col(f"x{at[h]}").alias("c")).alias(f"c{i}")
          for i, h in enumerate(headers)],
    )
    long = tagged.unpivot([WB, SHEET, ROW], [f"c{i}" for i in range(len(headers))], "k", "x")
    so = sheet_ord if isinstance(sheet_ord, Column) else F.lit(sheet_ord)
    return long.where(F.col("x.c").isNotNull()).select(
        WB, SHEET, so.cast("int").alias("sheet_ord"), ROW,
        F.col("x.col_idx").alias("col_idx"), F.col("x.header").alias("header"),
        F.col("x.c.value").alias("value"), F.col("x.c.annotation").alias("annotation"),
    )


def cells_to_sheet(cells: DataFrame, headers: list[str], rows: DataFrame | None = None) -> DataFrame:
    """Long ``cells`` -> wide sheet frame over *only* the given headers.

    One aggregation keyed by (workbook, sheet, row): each row's own cells of these headers are
    gathered (as many as the row has columns), and each header reads its own; where a header
    occurs twice the last column wins. The cost is per cell, whatever the number of headers. Rows
    with no referenced cell still appear; ``rows`` (workbook_id, sheet, row_idx) adds those that
    have no cell at all.
    """
    return _gathered(cells, headers, rows).select(
        WB, SHEET, ROW, *[F.element_at("__m", F.lit(h)).alias(h) for h in headers])


def cells_to_sheets(cells: DataFrame, headers: dict[str, list[str]], rows: DataFrame | None = None) -> dict[str, DataFrame]:
    """The sheet frames of several sheet names (sheet -> headers), from one pass over ``cells``.

    Cells are gathered per row once for all sheets; each sheet's frame reads its own headers."""
    names = sorted(headers)
    listed = F.col(SHEET).isin(*names)
    gathered = _gathered(cells.where(listed), sorted({h for hs in headers.values() for h in hs}), rows.where(listed) if rows is not None else None)
    frames = {s: gathered.where(F.col(SHEET) == s) for s in names}
    done = materialize_all([frames[s] for s in names]) if len(names) > 1 else list(frames.values())
    return {s: frame.select(WB, SHEET, ROW, *[F.element_at("__m", F.lit(h)).alias(h) for h in headers[s]]) for s, frame in zip(names, done, strict=True)}


def _gathered(cells: DataFrame, headers: list[str], rows: DataFrame | None) -> DataFrame:
    """Per row, a map ``__m`` of its cells of these headers."""
    c = F.struct(F.col("value"), F.col("annotation"))
    own = F.when(F.col("header").isin(*headers), F.struct("col_idx", "header", c.alias("c"))) if headers else F.lit(None).cast("struct<col_idx:int,header:string,c:struct<value:string,annotation:string>>")
    base = cells.select(WB, SHEET, ROW, own.alias("__c"))
    if rows is not None:
        base = base.unionByName(rows.select(WB, SHEET, ROW), allowMissingColumns=True)
    got = base.groupBy(WB, SHEET, ROW).agg(F.array_sort(F.collect_list("__c")).alias("__cs"))
    heads = F.transform("__cs", lambda e: e["header"])
    last = F.transform(F.array_distinct(heads), lambda h: F.element_at(F.filter("__cs", lambda e: e["header"] == h), -1))
    once = F.when(F.size(F.array_distinct(heads)) == F.size(heads), F.col("__cs")).otherwise(last)
    m = F.map_from_entries(F.transform(once, lambda e: F.struct(e["header"].alias("key"), e["c"].alias("value"))))
    return got.select(WB, SHEET, ROW, m.alias("__m"))
