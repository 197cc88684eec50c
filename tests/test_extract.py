"""R3 extraction run end to end on a hand-made grid, then G5 relation-sourced fields."""

import json
import tempfile

from assemble import assemble_small
from sheetdoc.plans.extract import run_extract
from sheetdoc.plans.run import run_transform
from sheetdoc.sources.sinks import workbook_json_fragments, write_cells

GRID_DDL = ("workbook_id string, sheet string, sheet_ord int, row int, col int, text string, "
            "comment string, comment_author string")


def test_extract_then_transform_with_relations(spark):
    g = [
        # sheet herbs: key column with a hint that normalisation keeps (ends in (Key))
        ("w", "herbs", 0, 1, 1, "Herb (Key)", None, None), ("w", "herbs", 0, 1, 2, "Name (drop)", None, None),
        ("w", "herbs", 0, 2, 1, "basil", None, None), ("w", "herbs", 0, 2, 2, " Green ", "Ann:\nnice", "Ann"),
        ("w", "herbs", 0, 3, 1, "thyme", None, None), ("w", "herbs", 0, 3, 2, "Grey", None, None),
        # sheet dishes: rows 2-3 are one vertical merge group over column 1
        ("w", "dishes", 1, 1, 1, "Dish", None, None), ("w", "dishes", 1, 1, 2, "[MAP] basil (link)", None, None),
        ("w", "dishes", 1, 1, 3, "[MAP] thyme", None, None),
        ("w", "dishes", 1, 2, 1, "Soup", None, None), ("w", "dishes", 1, 2, 2, "YES", None, None),
        ("w", "dishes", 1, 2, 3, "", None, None),
        ("w", "dishes", 1, 3, 1, None, None, None), ("w", "dishes", 1, 3, 2, "x", None, None),
        ("w", "dishes", 1, 3, 3, "nan", None, None),
        ("w", "dishes", 1, 4, 1, "Stew", None, None), ("w", "dishes", 1, 4, 2, "no", None, None),
        ("w", "dishes", 1, 4, 3, "y", None, None),
    ]
    grid = spark.createDataFrame(g, GRID_DDL)
    merges = spark.createDataFrame([("w", "dishes", 2, 3, 1, 1)],
                                   "workbook_id string, sheet string, min_row int, max_row int, min_col int, max_col int")
    ex = run_extract(grid, merges, block_rows=1 << 10)
    cells = {(c.sheet, c.row_idx, c.header): (c.value, c.annotation) for c in ex.cells.collect()}
    assert cells[("herbs", 0, "Name")] == ("Green", "nice")
    assert cells[("dishes", 0, "Dish")] == ("Soup", None)           # merged group rows 0-1 collapsed
    assert cells[("dishes", 0, "[MAP] basil")] == ("YES, x", None)  # distinct ordered concat
    assert cells[("dishes", 0, "[MAP] thyme")] == ("", None)        # "" and "nan" dropped
    assert ("dishes", 1, "Dish") not in cells
    rel = sorted((r.target_key, r.source_row, r.map_value) for r in ex.relations.collect())
    assert rel == [("basil", 0, "YES, X"), ("thyme", 2, "Y")]
    assert [tuple(r) for r in ex.report.select("edges", "matched", "unmatched").collect()] == [(2, 2, 0)]

    out = tempfile.mkdtemp(prefix="sheetdoc-cells-", dir="/tmp")
    write_cells(ex.cells, out)
    assert spark.read.parquet(out).count() == ex.cells.count()

    doc = json.loads(assemble_small(workbook_json_fragments(ex.cells)))
    assert list(doc["workbook"]) == ["herbs", "dishes"]
    assert doc["workbook"]["herbs"][0] == {"Herb (Key)": {"value": "basil"},
                                            "Name": {"value": "Green", "annotation": "nice"}}

    doc = json.loads(assemble_small(workbook_json_fragments(ex.cells, relations=ex.relations)))
    assert doc["workbook"]["herbs"][0]["__MAPPED_dishes"] == [
        {"Dish": {"value": "Soup"}, "[MAP] basil": {"value": "YES, x"}, "[MAP] thyme": {"value": ""},
         "__MAP_VALUE__": "YES, X"}]
    assert [r["Dish"]["value"] for r in doc["workbook"]["herbs"][1]["__MAPPED_dishes"]] == ["Stew"]
    assert "__MAPPED_dishes" not in doc["workbook"]["dishes"][0]

    spec = {"sheets": {"herbs": {"items": [{
        "templateKey": "herb", "filter": ".", "name": {"field": "Herb (Key)"},
        "dynamic_fields": {"source": "__MAPPED_dishes", "name_from": "Dish", "value_from": "__MAP_VALUE__"}}]}}}
    res = run_transform(ex.cells, spec, relations=ex.relations)
    items = json.loads(assemble_small(res.fragments))[0]["items"]
    assert [(i["name"], [(f["name"], f["value"]) for f in i["fields"]]) for i in items] == [
        ("basil", [("Soup", "YES, X")]), ("thyme", [("Stew", "Y")])]


def test_extract_job_entry_point(spark, tmp_path):
    from sheetdoc.__main__ import main

    g = [("w", "k", 0, 1, 1, "ID (Key)", None, None), ("w", "k", 0, 2, 1, "K1", None, None),
         ("w", "s", 1, 1, 1, "Item", None, None), ("w", "s", 1, 1, 2, "[MAP] K1", None, None),
         ("w", "s", 1, 2, 1, "A", None, None), ("w", "s", 1, 2, 2, "yes", None, None)]
    spark.createDataFrame(g, GRID_DDL).write.parquet(str(tmp_path / "grid"))
    assert main(["extract", "--grid", str(tmp_path / "grid"), "--out", str(tmp_path / "out")]) == 0
    rel = spark.read.parquet(str(tmp_path / "out" / "relations")).collect()
    assert [(r.target_key, r.source_sheet, r.map_value) for r in rel] == [("K1", "s", "YES")]
    assert spark.read.parquet(str(tmp_path / "out" / "cells")).count() == 3
