"""sheetdoc - ordered spreadsheet-like tables to typed, hierarchical documents on Spark.

Main entry points:

* ``plans.extract.run_extract(grid, merges)``: raw grids -> cleaned ``cells`` + relations (R3)
* ``plans.run.run_transform(cells, spec)``: a declarative spec -> items, fields, violations and
  the nested documents as ordered JSON fragments (R1, R2)
* ``sources.workbook_json.documents_to_cells``: workbook-JSON documents -> ``cells`` (S1)
* ``operators.*`` / ``functions.*``: the individual DataFrame operators and Column functions
* ``python -m sheetdoc extract|transform``: the two commands as Spark jobs
"""
