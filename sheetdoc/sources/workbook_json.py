"""Workbook-JSON documents -> long ``cells``, ``rows``, ``sheets`` and attached relations.

A document is ``{"<workbook_key>": {<sheet>: [ {<header>: {"value": .., "annotation"?: ..}}, ..]}}``.
If the key is absent the top object itself is the workbook; a top-level list serves as the rows
of every sheet the caller asks for. Each level is parsed on its own from the text of the level
above, so an odd part (a sheet that is no list, a row that is no object, a cell of another shape)
affects only itself. Order is kept; of a repeated key the last value counts, at the place of the
first, as in a Python dict.

Rows without cells and sheets without rows have no cells, so they are frames of their own. An array
under a ``__MAPPED_<sheet>`` key (the related rows that extraction attaches) becomes ``mapped``.

A corpus is many documents, so by default each document is parsed by one task. ``split=True`` spreads
large documents: their text is cut wherever an object follows another in a list (one regular
expression pass in the task that holds the document), and the pieces are dealt over all tasks. Each
piece is summed up for both states it can begin in (inside a string or not): its quotes, its depth and
how far it falls. Prefix sums over these numbers, in blocks and without any text, tell at which
cuts a row of a sheet ends. Rows in between are parsed where they lie; what is left of the document,
with a stand-in for every run of rows, is a small document that is parsed as before and gives the
rows their places. A document that no task could hold is read as ordered fragments (``order``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import MAPPED_PREFIX, quote_literal
from ..model import CELLS_SCHEMA
from ..session import materialize, written

OBJECT, LIST, CELL = "map<string,string>", "array<string>", "struct<value:string,annotation:string>"
POSITION = ["workbook_id", "sheet", "sheet_ord", "row_idx"]


@dataclass
class Workbooks:
    """``cells``; ``rows`` (workbook_id, sheet, sheet_ord, row_idx) and ``sheets`` (workbook_id,
    sheet, sheet_ord) with the blank and empty ones; ``mapped`` (workbook_id, sheet, row_idx,
    attach, ord, header, value, annotation): cells of related rows, in order."""

    cells: DataFrame
    rows: DataFrame
    sheets: DataFrame
    mapped: DataFrame


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file: ``(workbook_id, value)`` with the whole text."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.input_file_name().alias("workbook_id"), "value")


def _opens(text: Column, bracket: str) -> Column:
    return F.coalesce(F.ltrim(text).startswith(bracket), F.lit(False))


def _members(text: Column) -> Column:
    """``array<struct<key, value>>`` of a JSON object's members with the text of each value (of a
    string its content); NULL if it is no object. Of a repeated key the last value stays."""
    entries = F.map_entries(F.from_json(F.when(_opens(text, "{"), text), OBJECT))
    keys = F.transform(entries, lambda e: e["key"])
    last = F.transform(
        F.array_distinct(keys),
        lambda k: F.struct(k.alias("key"), F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"].alias("value")),
    )
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(last)


def _elements(text: Column) -> Column:
    return F.from_json(F.when(_opens(text, "["), text), LIST)


def _cell(text: Column) -> Column:
    """A cell object's value and annotation; any other value is the text of a plain cell. A JSON
    boolean reads as Python writes it."""
    whole = _opens(text, "{") & F.from_json(text, OBJECT).isNotNull()
    obj = F.from_json(F.when(whole, text), CELL)
    boolean = obj["value"].isin("true", "false") & text.rlike(r'(?<!\\)"value"\s*:\s*(true|false)\s*[,}]')
    value = F.when(boolean, F.initcap(obj["value"])).otherwise(obj["value"])
    return F.struct(
        F.coalesce(F.when(whole, F.coalesce(value, F.lit(""))), text, F.lit("")).alias("value"),
        obj["annotation"].alias("annotation"),
    )


def read_workbooks(docs: DataFrame, workbook_key: str = "workbook", text_col: str = "value",
                   list_sheets: list[str] | None = None, split: bool = False, order: list[str] | None = None) -> Workbooks:
    """Parse documents ``(workbook_id, <text_col>)`` into the frames of ``Workbooks``. ``split``
    spreads large documents over tasks (those that begin with the workbook key; others are parsed
    whole); ids must then be unique, unless ``order`` names columns: then a document is its rows' texts in
    this order, and it is never one value. Such a fragment may end anywhere but within an escape; the
    workbook's opening brace must be in the first one for the document to be spread."""
    if order and not split:
        raise ValueError("fragments are only read with split")
    if not split:
        parsed, rows = _sheet_rows(docs, workbook_key, text_col, list_sheets)
        return _parsed_rows(parsed, rows)
    own = [f"__order{i}" for i in range(len(order or []))]
    fragments = docs.select("workbook_id", *(F.col(c).alias(o) for c, o in zip(order or [], own, strict=True)), F.col(text_col).alias("value"))
    whole, inner = _taken_apart(fragments, own, workbook_key)
    parsed, rows = _sheet_rows(whole, workbook_key, "value", list_sheets)
    return _parsed_rows(materialize(parsed.drop("list")), materialize(_put_back(rows, inner)))


#: Key of a row that stands for a run of rows of a document that was taken apart.
_STAND_IN = "\ue000rows"
#: Depth of a sheet's rows: the document, the workbook, the sheet's list.
_ROW_DEPTH = 3
#: Low bits of a piece's number that name its place in a block.
BLOCK_BITS = 14


def _brackets(text: Column) -> Column:
    """Of a text without strings: its depth change, the lowest depth that a bracket closes to, and how
    many do (``struct<d, low, hits>``)."""
    only = F.regexp_replace(text, r"[^\[\]{}]", "")
    zero = F.struct(F.lit(0).alias("d"), F.lit(1 << 30).alias("low"), F.lit(0).alias("hits"))

    def step(acc: Column, c: Column) -> Column:
        closes = c.isin("}", "]")
        d = acc["d"] + F.when(c.isin("{", "["), 1).when(closes, -1).otherwise(0)
        lower, level = closes & (d < acc["low"]), closes & (d == acc["low"])
        return F.struct(d.alias("d"), F.when(lower, d).otherwise(acc["low"]).alias("low"),
                        F.when(lower, 1).when(level, acc["hits"] + 1).otherwise(acc["hits"]).alias("hits"))

    return F.aggregate(F.split(only, ""), zero, step)


def _taken_apart(docs: DataFrame, order: list[str], workbook_key: str) -> tuple[DataFrame, DataFrame]:
    """Documents without the rows inside their sheets (``workbook_id, value``; a stand-in row takes
    each run's place), and those rows: ``workbook_id, run, at, text``.

    ``docs`` has the fragments of documents (``workbook_id``, ``order``, ``value``). Pieces are numbered
    by one range sort; what goes on from piece to piece is summed up inside blocks of these numbers,
    and only the blocks' totals are put in a row for each document."""
    # after an object, before a comma and the next one: such cuts lose nothing of the text
    cuts = F.split("value", r"(?<=\})(?=\s*,\s*\{)")
    cut = docs.select("workbook_id", *order, F.posexplode(cuts).alias("sub", "piece"))
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = ["workbook_id", *order, "sub"]
    in_order = cut.repartitionByRange(tasks, *by).sortWithinPartitions(*by)
    pieces = written(in_order.select("workbook_id", F.monotonically_increasing_id().alias("pos"), "piece"))
    bare = F.regexp_replace("piece", r"(?s)\\.", "")  # without escapes
    rest = F.regexp_replace(bare, '^[^"]*("|$)', "")
    here, in_row = ["workbook_id", "block"], Window.partitionBy("workbook_id").orderBy("block")
    in_block, earlier = Window.partitionBy(*here).orderBy("pos"), in_row.rowsBetween(Window.unboundedPreceding, -1)
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)

    def sum_of(c: Column | str, over) -> Column:
        return F.coalesce(F.sum(c).over(over), F.lit(0))

    # written, so that brackets are counted once
    sums = written(pieces.select(
        "workbook_id", "pos", F.shiftright("pos", BLOCK_BITS).alias("block"),
        (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))).alias("quotes"),
        _brackets(F.regexp_replace(bare, '"[^"]*("|$)', "")).alias("outside"), _brackets(F.regexp_replace(rest, '"[^"]*("|$)', "")).alias("inside"),
        F.col("piece").rlike(r'^\s*\{\s*"' + quote_literal(workbook_key) + r'"\s*:\s*\{').alias("head"),
        F.col("piece").rlike(r"^\s*,\s*\{").alias("starts"), F.col("piece").rlike(r"\}\s*$").alias("ends")))
    # for both states that a block can begin in: 0 outside of strings, 1 inside
    odd = sums.withColumn("odd", sum_of("quotes", before) % 2 == 1)
    both = odd.withColumn("d0", F.when(F.col("odd"), F.col("inside.d")).otherwise(F.col("outside.d"))).withColumn(
        "d1", F.when(F.col("odd"), F.col("outside.d")).otherwise(F.col("inside.d")))
    local = written(both.withColumn("depth0", sum_of("d0", before)).withColumn("depth1", sum_of("d1", before)).withColumn(
        "after", F.lag("ends").over(in_block)))
    totals = local.groupBy(*here).agg(F.sum("quotes").alias("q"), F.sum("d0").alias("t0"), F.sum("d1").alias("t1"),
                                      F.max_by("ends", "pos").alias("last"), F.min_by("head", "pos").alias("head"))
    begun = totals.withColumn("begun", sum_of("q", earlier) % 2 == 1)
    starts = begun.select(*here, "begun", sum_of(F.when(F.col("begun"), F.col("t1")).otherwise(F.col("t0")), earlier).alias("depth"),
                          F.lag("last").over(in_row).alias("brace"), F.first("head").over(in_row).alias("usual"))
    state = local.drop("head").join(starts, here).withColumn("open", F.col("odd") != F.col("begun")).withColumn(
        "depth", F.col("depth") + F.when(F.col("begun"), F.col("depth1")).otherwise(F.col("depth0"))).withColumn(
        "own", F.when(F.col("open"), F.col("inside")).otherwise(F.col("outside")))
    # a fragment may begin anywhere, so not every piece is a cut
    is_cut = F.col("starts") & F.coalesce("after", "brace", F.lit(False))
    ends_row = (~F.col("open") & (F.col("depth") == _ROW_DEPTH) & is_cut).cast("int")
    low = F.col("depth") + F.col("own.low")
    rows = written(state.select(
        *here, "pos", "usual", low.alias("low"), F.when(low == _ROW_DEPTH, F.col("own.hits")).otherwise(0).alias("hits"),
        F.sum(ends_row).over(in_block).alias("rows")))
    rows_before = rows.groupBy(*here).agg(F.max("rows").alias("n")).select(*here, sum_of("n", earlier).alias("rows_before"))
    grouped = rows.join(rows_before, here).withColumn("grp", F.col("rows_before") + F.col("rows"))
    # the pieces of one row (its text may hold cuts): it stays in the list and closes once, at its end
    row = Window.partitionBy("workbook_id", "grp")
    one = (F.min("low").over(row) == _ROW_DEPTH) & (F.sum("hits").over(row) == 1)
    inner = grouped.select(*here, "pos", "grp", (F.col("usual") & (F.col("grp") > 0) & one).alias("inner"), (F.col("pos") == F.min("pos").over(row)).alias("first"))
    # pieces that stay, rows inside, and how many of those there were at the last piece that stays
    counted = inner.withColumn("stay", F.sum((~F.col("inner")).cast("int")).over(in_block)).withColumn(
        "taken", F.sum((F.col("inner") & F.col("first")).cast("int")).over(in_block))
    counted = written(counted.withColumn("since", F.max(F.when(~F.col("inner"), F.col("taken"))).over(in_block)))
    totals = counted.groupBy(*here).agg(F.max("stay").alias("s"), F.max("taken").alias("t"), F.max("since").alias("c")).select(
        *here, sum_of("s", earlier).alias("stay_before"), sum_of("t", earlier).alias("taken_before"), "c")
    totals = totals.select(*here, "stay_before", "taken_before", F.max(F.col("taken_before") + F.col("c")).over(earlier).alias("since_before"))
    taken = F.col("taken_before") + F.col("taken")
    since = F.coalesce(F.col("taken_before") + F.col("since"), "since_before", F.lit(0))
    placed = counted.join(totals, here).select(
        "workbook_id", "pos", "grp", "inner", "first", (F.col("stay_before") + F.col("stay")).alias("run"), (taken - since - 1).alias("at"))
    texts = written(pieces.join(placed, ["workbook_id", "pos"]))

    def joined(of: DataFrame, by: list[str]) -> DataFrame:
        parts = F.array_sort(F.collect_list(F.struct("pos", "piece")))
        return of.groupBy(*by).agg(F.array_join(F.transform(parts, lambda p: p["piece"]), "").alias("text"))

    inside = joined(texts.where("inner"), ["workbook_id", "run", "grp", "at"]).select(
        "workbook_id", "run", "at", F.regexp_replace("text", r"^\s*,\s*", "").alias("text"))
    stand_in = F.concat(F.lit(',{"' + _STAND_IN + '":{"value":"'), F.col("run").cast("string"), F.lit('"}}'))
    left = texts.where(~F.col("inner")).select("workbook_id", "pos", "piece").unionByName(
        texts.where("inner AND first AND at = 0").select("workbook_id", "pos", stand_in.alias("piece")))
    return joined(left, ["workbook_id"]).withColumnRenamed("text", "value"), inside


def _put_back(rows: DataFrame, inner: DataFrame) -> DataFrame:
    """``rows`` of what was left of documents, with their runs of rows in the stand-ins' places."""
    run = F.regexp_extract("text", r'^\{"' + _STAND_IN + r'":\{"value":"(\d+)"\}\}$', 1)
    marked = rows.withColumn("run", F.when(run != "", run.cast("bigint")))
    sizes = inner.groupBy("workbook_id", "run").agg(F.count("*").alias("n"))
    sized = marked.join(sizes, ["workbook_id", "run"], "left")
    before = Window.partitionBy("workbook_id", "sheet_ord").orderBy("row_idx").rowsBetween(Window.unboundedPreceding, -1)
    moved = sized.withColumn("row_idx", F.col("row_idx") + F.coalesce(F.sum(F.coalesce("n", F.lit(1)) - 1).over(before), F.lit(0)))
    back = moved.where("n IS NOT NULL").drop("text").join(inner, ["workbook_id", "run"])
    return moved.where("n IS NULL").select(*POSITION, "text").unionByName(
        back.select("workbook_id", "sheet", "sheet_ord", (F.col("row_idx") + F.col("at")).alias("row_idx"), "text"))


def _sheet_rows(docs: DataFrame, workbook_key: str, text_col: str, list_sheets: list[str] | None) -> tuple[DataFrame, DataFrame]:
    """Sheets (``workbook_id, sheet, sheet_ord, list``) and their rows (POSITION, text)."""
    text = F.col(text_col)
    top = _members(text)
    keyed = F.filter(top, lambda e: e["key"] == workbook_key)
    of_key = _members(F.element_at(F.transform(keyed, lambda e: e["value"]), 1))
    book = F.when(F.size(keyed) > 0, of_key).otherwise(top)
    if list_sheets:
        listed = F.array(*[F.struct(F.lit(s).alias("key"), text.alias("value")) for s in list_sheets])
        book = F.when(_opens(text, "["), listed).otherwise(book)
    found = docs.select("workbook_id", F.posexplode(book).alias("sheet_ord", "e"))
    parsed = found.select("workbook_id", F.col("e.key").alias("sheet"), F.col("sheet_ord").cast("int").alias("sheet_ord"),
                          _elements(F.col("e.value")).alias("list")).where("list IS NOT NULL")
    rows = parsed.select("workbook_id", "sheet", "sheet_ord", F.posexplode("list").alias("row_idx", "text"))
    return parsed, rows.withColumn("row_idx", F.col("row_idx").cast("bigint"))


def _parsed_rows(parsed: DataFrame, rows: DataFrame) -> Workbooks:
    """Cells, rows, sheets and related rows of rows of text."""
    members = rows.select(*POSITION, F.posexplode(_members(F.col("text"))).alias("col_idx", "c")).select(
        *POSITION, (F.col("col_idx") + 1).cast("int").alias("col_idx"), F.col("c.key").alias("header"), F.col("c.value").alias("text"))
    is_list = _opens(F.col("text"), "[") & _elements(F.col("text")).isNotNull()
    attached = F.col("header").startswith(MAPPED_PREFIX) & is_list
    cells = members.where(~is_list).withColumn("cell", _cell(F.col("text"))).select(
        *POSITION, "col_idx", "header", "cell.value", "cell.annotation")
    related = members.where(attached).select(
        "workbook_id", "sheet", "row_idx", F.col("header").alias("attach"), F.posexplode(_elements(F.col("text"))).alias("ord", "text"))
    mapped = related.select("workbook_id", "sheet", "row_idx", "attach", "ord", F.explode(_members(F.col("text"))).alias("c")).select(
        "workbook_id", "sheet", "row_idx", "attach", "ord", F.col("c.key").alias("header"), _cell(F.col("c.value")).alias("cell"),
    ).select("workbook_id", "sheet", "row_idx", "attach", "ord", "header", "cell.value", "cell.annotation")
    return Workbooks(cells, rows.select(*POSITION), parsed.select("workbook_id", "sheet", "sheet_ord"), mapped)


def documents_to_cells(docs: DataFrame, workbook_key: str = "workbook", text_col: str = "value",
                       list_sheets: list[str] | None = None) -> DataFrame:
    """The ``cells`` of ``read_workbooks``."""
    return read_workbooks(docs, workbook_key, text_col, list_sheets).cells


def cells_from_python(spark: SparkSession, workbook: dict, workbook_id: str = "wb") -> DataFrame:
    """Small in-memory workbook dict -> cells (tests and fixtures)."""
    out = []
    for s_ord, (sheet, rows) in enumerate(workbook.items()):
        for r_idx, row in enumerate(rows):
            for c_idx, (h, c) in enumerate(row.items()):
                if isinstance(c, dict):
                    out.append((workbook_id, sheet, s_ord, r_idx, c_idx + 1, h, str(c.get("value", "")), c.get("annotation")))
                elif not isinstance(c, list):
                    out.append((workbook_id, sheet, s_ord, r_idx, c_idx + 1, h, "" if c is None else str(c), None))
    return spark.createDataFrame(out, CELLS_SCHEMA)
