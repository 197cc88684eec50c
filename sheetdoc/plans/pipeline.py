"""Run a declarative sheet spec as one lazy Spark plan per sheet definition.

The spec keeps the reference's keys (``items``, ``filter``, ``scope_children``,
``expand_variants``, ``fields``, ``dynamic_fields``, ``children``, ``name``/``name_static``/
``name_slug``, ``branchKey``/``templateKey``, ``source_structure``, the config block), but
``filter`` and ``condition`` hold **Spark SQL boolean expressions** over the row's cell columns
(``NOT (Category.value <=> '')``), and ``transform`` is a regex (first group) or a list of steps
(see ``functions.text.jq_text``). The jq idioms for head rows, multi-value explode and group
with scope are spec keys: ``head_only: true``, ``explode: {column, sep, as}``,
``group_by: {column, drop_empty}``.

The recursion is over the *spec* (static depth), on the driver, level by level: the definitions of
one level, of all sheets of a run, hand over the rows that must be cut from their lineage together,
and one job writes them. So the number of jobs is that of the levels, whatever the number of sheets
and definitions.
Output is flat: ``items`` and ``fields`` frames keyed by ``item_id`` with explicit ordering
paths, so no item's children or fields are ever collected into one row. ``operators.document``
turns them into the nested JSON document as ordered fragments.
"""

from __future__ import annotations

import logging
from collections.abc import Generator
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import MAP_VALUE_KEY, MAPPED_PREFIX
from ..model import KEY, ROW, SHEET, WB, cells_to_sheet, qcol
from ..operators import generate as gen
from ..operators import project as pj
from ..operators import quality as qa
from ..operators.segment import DEFAULT_BLOCK_ROWS, forward_fill
from ..session import materialize_all

log = logging.getLogger(__name__)

PATH_EL = "struct<k:int,d:int,g:string,r:bigint,s:bigint>"
BLOCK_ROWS_CONF = "spark.sheetdoc.scan.blockRows"


def path_el(kind: int, d: int, g: Column, r: Column, s: Column) -> Column:
    return F.struct(F.lit(kind).alias("k"), F.lit(d).alias("d"), g.cast("string").alias("g"),
                    r.cast("bigint").alias("r"), s.cast("bigint").alias("s"))


def physical_frame(rows: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``rows`` with generated column names, and the headers they stand for.

    A sheet frame starts with its three key columns; what follows are headers, told apart by
    position, so two may differ in case only or equal a key column's name."""
    if rows.columns[:3] != [*KEY, ROW]:
        rows = rows.select(*KEY, ROW, *[qcol(c) for c in rows.columns if c not in (*KEY, ROW)])
    heads = rows.columns[3:]
    columns = [pj.header_column(i) for i in range(len(heads))]
    return rows.toDF(*KEY, ROW, *columns), dict(zip(heads, columns, strict=True))


@dataclass
class SheetResult:
    items: DataFrame
    fields: DataFrame
    violations: DataFrame
    warnings: list[str] = field(default_factory=list)
    # items with their static fields still as an array column ``static_fields``
    items_static: DataFrame | None = None
    # by definition: items with a column ``__f<i>`` for each static field, and the fields' names
    items_wide: list[tuple[DataFrame, list[str]]] = field(default_factory=list)
    has_dynamic: bool = False
    # some fields do not know yet whether they open their item's list (``first`` is NULL)
    open_first: bool = False


class SheetSpecRunner:
    """Build the items/fields/violations plan of one sheet definition."""

    def __init__(self, sheet_spec: dict, block_rows: int | None = DEFAULT_BLOCK_ROWS,
                 materialize_scopes: bool = True, cells: DataFrame | None = None,
                 relations: DataFrame | None = None, mapped: DataFrame | None = None):
        self.spec = sheet_spec or {}
        cols = self.spec.get("source_structure", {}) or {}
        self.base_col = cols.get("column_base", "") or ""
        self.data_cols = list(cols.get("column_data", []) or [])
        self.block_rows = block_rows
        # Checkpoint each scoped level's tagged rows once: items, fields, dynamic fields and the
        # children's context all read them (a stage boundary that also cuts the lineage).
        self.materialize_scopes = materialize_scopes
        # Relation-sourced dynamic fields read flat relation edges and the source rows.
        self.cells = cells
        self.relations = relations
        self.mapped = mapped
        self.warnings: list[str] = []
        self._items: list[DataFrame] = []
        self._items_static: list[DataFrame] = []
        self._items_wide: list[tuple[DataFrame, list[str]]] = []
        self._has_dynamic = False
        self._open_first = False
        self._fields: list[DataFrame] = []
        self._viol: list[DataFrame] = []
        self._req_names: list[tuple[list[str], DataFrame, DataFrame | None]] = []
        # definitions of the next level, as generators (see ``_definition``)
        self.pending: list[Generator[DataFrame, DataFrame, None]] = []

    # -- entry -------------------------------------------------------------------------
    def start(self, rows: DataFrame) -> None:
        """``rows``: sheet frame (workbook_id, sheet, row_idx, <header cells>) of this sheet."""
        self.spark = rows.sparkSession
        if self.block_rows == DEFAULT_BLOCK_ROWS:
            # A cluster may size the scan blocks without code changes.
            self.block_rows = int(rows.sparkSession.conf.get(BLOCK_ROWS_CONF, str(DEFAULT_BLOCK_ROWS)))
        frame, headers = physical_frame(rows)
        # Every row also exposes its base cell as ``__base_cell__`` (conditions may use it).
        base = qcol(headers[self.base_col]) if self.base_col in headers else F.lit(None).cast(gen.NULL_CELL)
        ctx = frame.select(
            "*",
            base.alias(pj.BASE_CELL),
            F.lit("").alias("__parent"),
            F.array().cast(f"array<{PATH_EL}>").alias("__ppath"),
            F.col(ROW).alias("__ord"),
            F.lit(0).cast("bigint").alias("__sub"),
        )
        view = pj.RowView(headers=headers, base_col=self.base_col)
        self._level(ctx, view, self.spec.get("items", []) or [], depth=1, parents=None, generated=False)

    def result(self) -> SheetResult:
        """The result, once all levels are through."""
        spark = self.spark
        items = _union(self._items) if self._items else None
        fields = _union(self._fields) if self._fields else None
        if items is None:
            items = spark.createDataFrame([], ITEMS_DDL)
            fields = spark.createDataFrame([], FIELDS_DDL)
        viols = list(self._viol)
        for names, of_items, generated_fields in self._req_names:
            v = qa.required_names_violations(of_items, generated_fields, names)
            if v is not None:
                viols.append(v)
        violations = _union(viols) if viols else qa.empty_violations(spark)
        items_static = _union(self._items_static) if self._items_static else None
        return SheetResult(items, fields, violations, self.warnings, items_static, self._items_wide, self._has_dynamic, self._open_first)

    # -- one level of the spec ---------------------------------------------------------
    def _level(self, ctx: DataFrame, view: pj.RowView, defs: list, depth: int,
               parents: DataFrame | None, generated: bool) -> None:
        for d_idx, idef in enumerate(defs):
            self.pending.append(self._definition(ctx, view, idef, d_idx, depth, parents, generated))

    def _definition(self, ctx: DataFrame, view: pj.RowView, idef: dict, d_idx: int, depth: int,
                    parents: DataFrame | None, generated: bool) -> Generator[DataFrame, DataFrame, None]:
        """One item definition. Rows to be cut from their lineage are yielded and sent back."""
        if not idef.get("branchKey") and not idef.get("templateKey"):
            raise ValueError(f"an item definition needs a branchKey or a templateKey: {idef.get('name', idef)}")
        part = [WB, SHEET, "__parent"]

        # 1. input: the context, or the parent row's variants (G1).
        if idef.get("expand_variants"):
            if parents is None:
                # Top level: the reference expands an empty parent row -> all-empty variants.
                parents = ctx.select(WB, SHEET).distinct().select(
                    WB, SHEET, F.lit("").alias("__parent"), F.array().cast(f"array<{PATH_EL}>").alias("__ppath"))
                src_headers: dict[str, str] = {}
            else:
                src_headers = view.headers
            inp = gen.unpivot_variants(parents, [WB, SHEET, "__parent", "__ppath", ROW] if ROW in parents.columns else
                                       [WB, SHEET, "__parent", "__ppath"], self.base_col, self.data_cols, src_headers)
            if ROW not in inp.columns:
                inp = inp.withColumn(ROW, F.lit(None).cast("bigint"))
            iview = pj.RowView(headers={}, variant=True, base_col=self.base_col)
            generated_in = False
        else:
            inp, iview, generated_in = ctx, view, generated

        # 2. generators (jq idioms made explicit).
        gkey = F.lit("")
        grouped = None
        if idef.get("explode"):
            ex = idef["explode"]
            out = ex.get("as", ex["column"])
            wider, column = iview.with_column(out)
            inp, iview = gen.explode_parts(inp, iview, ex["column"], ex.get("sep", "|"), column), wider
            generated_in = True
        if idef.get("group_by"):
            g = idef["group_by"]
            gcol = g["column"] if isinstance(g, dict) else g
            key = iview.cell(gcol).getField("value") if iview.cell(gcol) is not None else F.lit(None).cast("string")
            grouped = (inp, key)
            inp = gen.group_representatives(inp, part, key, bool(g.get("drop_empty", False)) if isinstance(g, dict) else False)
            gkey = F.col("__gkey")
            generated_in = True

        # 3. filter (F1-F5); a filter that fails to resolve selects nothing (T7, as reference).
        if idef.get("head_only"):
            # the first row of each context in its full order: group key, row, part
            order = F.struct(gkey.cast("string"), F.col("__ord"), F.col("__sub"))
            inp = inp.groupBy(*part).agg(F.min_by(F.struct(*[qcol(c) for c in inp.columns if c not in part]), order).alias("__head"))
            inp = inp.select(*part, "__head.*")
        sel = self._filter(inp, idef.get("filter"), iview)

        scope = bool(idef.get("scope_children")) or idef.get("templateKey") == "group"
        if scope and generated_in:
            raise ValueError("scope_children over generated rows (explode/group_by) is not supported (T9)")

        item_id = F.concat_ws("/", F.col("__parent"), F.concat(F.lit(f"{d_idx}:"), F.col("__ord").cast("string"),
                                                                   F.lit("."), F.col("__sub").cast("string")))
        path = F.concat(F.col("__ppath"), F.array(path_el(3, d_idx, gkey, F.col("__ord"), F.col("__sub"))))

        if scope:
            tagged = forward_fill(inp.withColumn("__sel", sel), F.col("__sel"), part, "__ord", "__seg", self.block_rows)
            if self.materialize_scopes and (idef.get("children") or idef.get("dynamic_fields") is not None):
                tagged = yield tagged.where(F.col("__seg").isNotNull())
            chosen = tagged.where(F.col("__sel"))
        else:
            tagged = None
            chosen = inp.where(sel)
        chosen = chosen.withColumn("__item", item_id).withColumn("__path", path)

        # 4. items, static fields, violations: one select over the chosen rows.
        fdefs = idef.get("fields", []) or []
        chosen, fdefs, fview = self._lookups(chosen, fdefs, iview)
        fstructs, fviols = [], []
        for i, f in enumerate(fdefs):
            st, viol = pj.static_field(chosen, fview, f, i)
            fstructs.append(st)
            if viol is not None:
                fviols.append(F.when(viol, F.lit(f["name"])))
        name = pj.item_name(iview, idef)
        item = [
            F.col(WB), F.col(SHEET), F.col("__item").alias("item_id"), F.col("__parent").alias("parent_id"),
            F.lit(depth).alias("depth"), F.col("__path").alias("path"), F.col(ROW).alias(ROW),
            name.alias("name"), F.lit(idef.get("branchKey")).cast("string").alias("branch_key"),
            F.lit(idef.get("templateKey")).cast("string").alias("template_key"),
        ]
        base = chosen.select(
            *item,
            (F.array(*fstructs) if fstructs else F.array().cast(f"array<{pj.FIELD_TYPE}>")).alias("__fields"),
            (F.array(*fviols) if fviols else F.array().cast("array<string>")).alias("__viol"),
        )
        self._items.append(base.drop("__fields", "__viol"))
        self._items_static.append(base.drop("__viol").withColumn(
            "static_fields", F.filter("__fields", lambda x: x.isNotNull())).drop("__fields"))
        wide = chosen.select(*item, *[st.alias(f"__f{i}") for i, st in enumerate(fstructs)])
        self._items_wide.append((wide, [str(f["name"]) for f in fdefs]))
        self._fields.append(base.select(
            WB, SHEET, "item_id", "path", F.posexplode(F.filter("__fields", lambda x: x.isNotNull())).alias("__pos", "f"),
        ).select(WB, SHEET, "item_id", "path", "f.*", (F.col("__pos") == 0).alias("first")))
        if fviols:
            self._viol.append(base.select(
                WB, SHEET, "item_id", ROW, F.explode(F.filter("__viol", lambda x: x.isNotNull())).alias("field"),
            ).select(WB, SHEET, "item_id", ROW, "field", F.lit("required_field_missing").alias("reason")))

        # 5. the rows each item scopes (children context and dynamic-field rows).
        if scope:
            scoped = tagged.where(F.col("__seg").isNotNull()).withColumn(
                "__item", F.concat_ws("/", F.col("__parent"), F.concat(F.lit(f"{d_idx}:"), F.col("__seg").cast("string"), F.lit(".0"))))
            # The segment's item path follows from its header key: no join back to the items.
            scoped = scoped.withColumn("__ipath", F.concat(F.col("__ppath"), F.array(
                path_el(3, d_idx, F.lit(""), F.col("__seg"), F.lit(0)))))
        else:
            scoped = chosen.withColumn("__ipath", F.col("__path"))

        dyn = idef.get("dynamic_fields")
        if dyn is not None:
            self._has_dynamic = True
            self._dynamic(idef, dyn, len(fdefs), chosen, scoped, grouped, iview, base)

        children = idef.get("children", []) or []
        if children:
            child_ctx = scoped.drop("__parent", "__ppath", "__sel", "__seg", "__first", "__path").withColumnRenamed(
                "__item", "__parent").withColumnRenamed("__ipath", "__ppath")
            child_ctx = child_ctx.drop("__gkey") if "__gkey" in child_ctx.columns else child_ctx
            parents_next = chosen.drop("__parent", "__ppath").withColumnRenamed("__item", "__parent").withColumnRenamed(
                "__path", "__ppath")
            self._level(child_ctx, iview, children, depth + 1, parents_next, generated_in)

    def _lookups(self, chosen: DataFrame, fdefs: list, view: pj.RowView):
        """J5 / F6 in a spec: ``lookup: {sheet, key, take, on | equals}`` reads ``take`` from the
        first row (sheet order) of another sheet whose ``key`` cell equals this row's ``on``
        value (a column or token) or the literal ``equals``; no match gives ''. The other sheet
        is reduced to one row per key (partial aggregate) before a left join, so rows never
        multiply; a catalog-sized side is broadcast by AQE."""
        if not any(f.get("lookup") for f in fdefs):
            return chosen, fdefs, view
        if self.cells is None:
            raise ValueError("lookup fields need the cells table (run_transform / run_sheet(cells=...))")
        out, extra = [], {}
        for i, f in enumerate(fdefs):
            lk = f.get("lookup")
            if not lk:
                out.append(f)
                continue
            col = f"__lk{i}"
            c = self.cells.where((F.col(SHEET) == lk["sheet"]) & F.col("header").isin(lk["key"], lk["take"]))
            per_row = c.groupBy(WB, ROW).agg(
                F.max(F.when(F.col("header") == lk["key"], F.col("value"))).alias("__k"),
                F.max(F.when(F.col("header") == lk["take"], F.col("value"))).alias("__t"))
            first = per_row.where(F.col("__k").isNotNull()).groupBy(WB, "__k").agg(
                F.min_by("__t", ROW).alias(col))
            probe = F.lit(lk["equals"]) if "equals" in lk else pj.token_value(view, lk["on"])
            chosen = chosen.withColumn("__probe", probe).join(
                first.withColumnRenamed("__k", "__probe"), [WB, "__probe"], "left").drop("__probe")
            token = f"$lookup:{i}"
            out.append({k: v for k, v in f.items() if k != "lookup"} | {"value": token})
            extra[token] = col
        return chosen, out, pj.RowView(view.headers, view.variant, view.base_col, view.extra | extra)

    def _mapped_rows(self, src: str, dyn: dict, chosen: DataFrame) -> tuple[DataFrame, dict[str, str]]:
        """Rows of the source sheets related to each chosen row (``__MAPPED_<sheet>``),
        in source-row order, each with its ``__MAP_VALUE__`` cell; and their headers."""
        from ..operators.relate import attach_name
        from ..plans.spec import referenced_headers

        edges = self.relations.where(attach_name(F.col("source_sheet")) == src)
        heads = [h for h in referenced_headers({"items": [dyn]}) if h not in (MAP_VALUE_KEY, src)]
        src_cells = self.cells.join(
            edges.select(WB, F.col("source_sheet").alias(SHEET)).distinct(), [WB, SHEET], "left_semi")
        src_rows, names = physical_frame(cells_to_sheet(src_cells, heads))
        items = chosen.select(WB, F.col(SHEET).alias("target_sheet"), F.col(ROW).alias("target_row"), "__item",
                              F.col("__path").alias("__ipath"))
        j = edges.join(items, [WB, "target_sheet", "target_row"]).join(
            src_rows.withColumnRenamed(SHEET, "source_sheet").withColumnRenamed(ROW, "source_row"),
            [WB, "source_sheet", "source_row"], "left")
        names[MAP_VALUE_KEY] = pj.header_column(len(names))
        return j.select(
            WB, F.col("target_sheet").alias(SHEET), F.col("source_row").alias(ROW), "__item", "__ipath",
            F.col("source_row").alias("__ord"), F.lit(0).cast("bigint").alias("__sub"),
            *[c for h, c in names.items() if h != MAP_VALUE_KEY],
            F.struct(F.col("map_value").alias("value"), F.lit(None).cast("string").alias("annotation")).alias(names[MAP_VALUE_KEY]),
        ), names

    def _attached_rows(self, src: str, dyn: dict, chosen: DataFrame) -> tuple[DataFrame, dict[str, str]]:
        """G5 from workbook JSON: the related rows that the document itself carries, and their
        headers."""
        from ..plans.spec import referenced_headers

        heads = sorted({*referenced_headers({"items": [dyn]}), MAP_VALUE_KEY} - {src})
        names = {h: pj.header_column(i) for i, h in enumerate(heads)}
        c = F.struct("value", "annotation")
        rows = self.mapped.where(F.col("attach") == src).groupBy(WB, SHEET, ROW, "ord").agg(
            *[F.max(F.when(F.col("header") == h, c)).alias(name) for h, name in names.items()])
        items = chosen.select(WB, SHEET, ROW, "__item", F.col("__path").alias("__ipath"))
        return items.join(rows, [WB, SHEET, ROW]).withColumn("__ord", F.col("ord").cast("bigint")).withColumn(
            "__sub", F.lit(0).cast("bigint")).drop("ord"), names

    def _filter(self, inp: DataFrame, expr, view: pj.RowView) -> Column:
        if expr is None or (isinstance(expr, str) and expr.strip() in ("", ".")):
            return F.lit(True)
        c = pj.condition_column(inp, expr, view)
        if c is None:
            self.warnings.append(f"filter {expr!r} failed; definition selects no rows")
            return F.lit(False)
        return c

    def _dynamic(self, idef, dyn, n_static, chosen, scoped, grouped, iview, base) -> None:
        part = [WB, SHEET, "__parent"]
        src = dyn.get("source")
        if src == "__scope__" and grouped is not None:
            rows, key = grouped
            scope_rows = rows.withColumn("__gkey", key).join(
                chosen.select(*part, "__gkey", "__item", F.col("__path").alias("__ipath")), [*part, "__gkey"])
        elif src and src.startswith(MAPPED_PREFIX) and (self.mapped is not None or (self.relations is not None and self.cells is not None)):
            scope_rows, names = self._attached_rows(src, dyn, chosen) if self.mapped is not None else self._mapped_rows(src, dyn, chosen)
            iview = pj.RowView(headers=names)
        elif src:
            scope_rows = None  # a source key the row lacks -> no rows
        else:
            scope_rows = scoped
        generated = None
        if scope_rows is not None:
            fcol = None
            if dyn.get("filter"):
                fcol = pj.condition_column(scope_rows, dyn["filter"], iview)
                if fcol is None:
                    self.warnings.append(f"dynamic_fields filter {dyn['filter']!r} failed; no rows")
                    fcol = F.lit(False)
            df = gen.dynamic_fields(scope_rows, iview, dyn, n_static, fcol)
            # a static field that is always there comes first
            known = any(not f.get("omit_if_false") for f in idef.get("fields") or [])
            self._open_first |= not known
            generated = df.select(WB, SHEET, F.col("__item").alias("item_id"), F.col("__ipath").alias("path"), "f.*",
                                  F.lit(False if known else None).cast("boolean").alias("first"))
            self._fields.append(generated)
            if dyn.get("required"):
                self._viol.append(df.where("__empty_required").select(
                    WB, SHEET, F.col("__item").alias("item_id"), ROW, F.col("f.name").alias("field"),
                    F.lit("required_dynamic_value").alias("reason")))
        if dyn.get("required_fields"):
            self._req_names.append((list(dyn["required_fields"]), base.select(WB, SHEET, "item_id", ROW), generated))


ITEMS_DDL = (f"workbook_id string, sheet string, item_id string, parent_id string, depth int, "
             f"path array<{PATH_EL}>, row_idx bigint, name string, branch_key string, template_key string")
FIELDS_DDL = (f"workbook_id string, sheet string, item_id string, path array<{PATH_EL}>, name string, value variant, text string, "
              f"type string, relationKey string, fkey struct<i:int,r:bigint,s:bigint>, first boolean")


def _union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def run_levels(runners: list[SheetSpecRunner]) -> None:
    """Run all started sheets level by level; each level's cuts are one job."""
    while any(r.pending for r in runners):
        level = [d for r in runners for d in r.pending]
        for r in runners:
            r.pending = []
        waiting = []
        for definition in level:
            try:
                waiting.append((definition, next(definition)))
            except StopIteration:
                pass
        for (definition, _), rows in zip(waiting, materialize_all([rows for _, rows in waiting]), strict=True):
            try:
                definition.send(rows)
            except StopIteration:
                pass


def run_sheet(rows: DataFrame, sheet_spec: dict, block_rows: int | None = DEFAULT_BLOCK_ROWS,
              strict: bool = False, materialize_scopes: bool = True, cells: DataFrame | None = None,
              relations: DataFrame | None = None, mapped: DataFrame | None = None) -> SheetResult:
    """R1 for one sheet definition over the sheet frame ``rows``."""
    runner = SheetSpecRunner(sheet_spec, block_rows, materialize_scopes, cells, relations, mapped)
    runner.start(rows)
    run_levels([runner])
    res = runner.result()
    qa.enforce(res.violations, strict)
    return res
