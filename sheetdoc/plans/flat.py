"""Flat views of a pipeline run: items with chosen fields as columns (for reports/queries)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pipeline import SheetResult, run_sheet


def pivot_fields(res, names: list[str], what: str = "text",
                 extra: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Items of a ``SheetResult``/``RunResult`` with one column per field name (last duplicate
    by field order wins); ``extra``
    adds ``alias -> (field name, attribute)`` columns such as a field's ``type``.

    Static-only specs read the fields that are asked for, and of those only what is asked for (a
    projection: nothing else of a field is computed); with dynamic fields it is one conditional
    aggregation per item (partial aggregates) and one join on the item's key."""
    cols = [(n, n, what) for n in names] + [(a, n, w) for a, (n, w) in (extra or {}).items()]
    if not cols:
        return res.items
    if not getattr(res, "has_dynamic", True) and getattr(res, "items_wide", None):
        types = {f.name: f.dataType for f in res.items_static.schema["static_fields"].dataType.elementType}

        def last(own: list[str], n: str, w: str):
            out = F.lit(None).cast(types[w])
            for i, name in enumerate(own):
                if name == n:  # a field that is omitted is null as a whole
                    out = F.when(F.col(f"__f{i}").isNotNull(), F.col(f"__f{i}")[w]).otherwise(out)
            return out

        return reduce(DataFrame.unionByName, [
            wide.select(*res.items.columns, *[last(own, n, w).alias(a) for a, n, w in cols]) for wide, own in res.items_wide])
    agg = res.fields.groupBy("workbook_id", "sheet", "item_id").agg(*[
        F.max_by(F.when(F.col("name") == n, F.col(w)), F.when(F.col("name") == n, F.col("fkey"))).alias(a)
        for a, n, w in cols
    ])
    return res.items.join(agg, ["workbook_id", "sheet", "item_id"], "left")


def run_flat(rows: DataFrame, spec: dict, names: list[str], block_rows=None,
             extra: dict[str, tuple[str, str]] | None = None) -> tuple[DataFrame, SheetResult]:
    kw = {} if block_rows is None else {"block_rows": block_rows}
    res = run_sheet(rows, spec, **kw)
    return pivot_fields(res, names, extra=extra), res
