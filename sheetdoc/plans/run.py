"""R2: the multi-sheet transform run and S3 sheet selection.

``run_transform(cells, spec)`` builds one lazy plan per selected sheet definition over the
shared ``cells`` table (a corpus: many workbooks at once), and returns flat ``items`` /
``fields`` / ``violations`` frames plus the document fragments (S4) and a selection report.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPEC_CONFIG_KEY
from ..model import cells_to_sheets
from ..operators import document as doc
from ..operators import quality as qa
from ..operators.segment import DEFAULT_BLOCK_ROWS
from ..session import materialize
from .pipeline import FIELDS_DDL, ITEMS_DDL, SheetSpecRunner, run_levels
from .spec import referenced_headers, require_spec


@dataclass
class RunResult:
    items: DataFrame
    fields: DataFrame
    violations: DataFrame
    fragments: DataFrame
    sheets: DataFrame
    report: DataFrame
    warnings: list[str] = field(default_factory=list)


def select_sheets(cells: DataFrame, spec: dict, sheets: DataFrame | None = None) -> tuple[list[str], DataFrame, DataFrame, dict[str, int]]:
    """S3: sheets to process in listed order (default: all spec sheets).

    Returns (spec sheet names to run, ``sheets(workbook_id, sheet, sheet_ord)`` present in the
    data, report ``(workbook_id, sheet, status)`` for sheets skipped: no definition, or missing
    from a workbook), and each run sheet's position. A sheet listed twice runs once. ``sheets``
    (workbook_id, sheet) names the sheets there are, with those that have no cells.
    """
    spark = cells.sparkSession
    defs = spec.get("sheets", {}) or {}
    listed = (spec.get("input", {}) or {}).get("sheets", list(defs.keys()))
    order, seen = [], set()
    for s in listed:
        if s not in seen:
            seen.add(s)
            order.append(s)
    wanted = spark.createDataFrame([(s, i, s in defs) for i, s in enumerate(order)],
                                   "sheet string, sheet_ord int, has_def boolean")
    present = (cells if sheets is None else sheets).select("workbook_id", "sheet").distinct()
    # The listed-sheet frame is bounded by the spec: broadcasting it is safe.
    sheets = present.join(F.broadcast(wanted.where("has_def")), "sheet").select("workbook_id", "sheet", "sheet_ord")
    # Report per workbook without a cross join: the set of sheets a workbook has is small
    # (its sheet count), the listed names are spec literals.
    have = present.groupBy("workbook_id").agg(F.collect_set("sheet").alias("__have"))
    with_def = F.array(*[F.lit(x) for x in order if x in defs]).cast("array<string>")
    without = F.array(*[F.lit(x) for x in order if x not in defs]).cast("array<string>")
    no_def = have.select("workbook_id", F.explode(without).alias("sheet"), F.lit("no_definition").alias("status"))
    missing = have.select("workbook_id", F.explode(F.array_except(with_def, F.col("__have"))).alias("sheet"),
                          F.lit("missing_sheet").alias("status"))
    return [s for s in order if s in defs], sheets, no_def.unionByName(missing), {
        s: i for i, s in enumerate(order) if s in defs}


def run_transform(cells: DataFrame, spec: dict, strict: bool = False,
                  block_rows: int | None = DEFAULT_BLOCK_ROWS, relations: DataFrame | None = None,
                  rows: DataFrame | None = None, sheets: DataFrame | None = None,
                  mapped: DataFrame | None = None) -> RunResult:
    """R2 over a corpus of workbooks. ``relations`` (from ``plans.extract.run_extract``) or
    ``mapped`` (from ``sources.workbook_json.read_workbooks``) enables
    ``dynamic_fields.source: "__MAPPED_<sheet>"``. ``rows`` and ``sheets`` name the rows and sheets
    there are, so that blank rows and empty sheets count; without them a row or sheet exists where
    it has cells."""
    spark = cells.sparkSession
    require_spec(spec)
    names, chosen_sheets, report, ords = select_sheets(cells, spec, sheets)
    defs = spec.get("sheets", {}) or {}
    frames = cells_to_sheets(cells, {s: referenced_headers(defs[s] or {}) for s in names}, rows) if names else {}
    runners = {}
    for s in names:
        frame, top = frames[s], (defs[s] or {}).get("items", []) or []
        if len(names) == 1 and (len(top) > 1 or any(d.get("scope_children") or d.get("templateKey") == "group" for d in top)):
            # Several definitions (or a checkpointed scope and its items) read the same widened
            # sheet: widen once. Several sheets have been written together already.
            frame = materialize(frame)
        runners[s] = SheetSpecRunner(defs[s], block_rows, True, cells, relations, mapped)
        runners[s].start(frame)
    run_levels(list(runners.values()))
    results = {s: r.result() for s, r in runners.items()}
    items, fields, viols = ([getattr(r, part) for r in results.values()] for part in ("items", "fields", "violations"))
    warnings = [f"[{s}] {w}" for s, r in results.items() for w in r.warnings]
    open_first = any(r.open_first for r in results.values())
    u = lambda xs, ddl: reduce(lambda a, b: a.unionByName(b), xs) if xs else spark.createDataFrame([], ddl)
    it, fl = u(items, ITEMS_DDL), u(fields, FIELDS_DDL)
    vi = reduce(lambda a, b: a.unionByName(b), viols) if viols else qa.empty_violations(spark)
    qa.enforce(vi, strict)
    # items/fields feed several aggregates and joins of the document writer: materialize once.
    it, fl = materialize(it), materialize(fl)
    frags = doc.document_fragments(it, fl, chosen_sheets, {s: (defs[s] or {}).get(SPEC_CONFIG_KEY, {}) for s in names},
                                   sheet_ords=ords, open_first=open_first)
    return RunResult(it, fl, vi, frags, chosen_sheets, report, warnings)
