"""Job entry points (run with ``spark-submit`` or ``python -m sheetdoc``).

  extract    grid Parquet (+ merged ranges) -> cells, relations (Parquet), workbook JSON parts
  transform  cells Parquet or workbook-JSON documents + YAML spec -> items, fields,
             violations (Parquet) and the documents (ordered JSON parts per workbook)

The session comes from the submit configuration (``getOrCreate``); outputs go to the given
paths; ``--strict`` stops on the first required-field violation (exit code 2).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _extract(spark: SparkSession, a) -> int:
    from .plans.extract import run_extract
    from .sources.sinks import workbook_json_fragments, write_cells
    from .operators.document import write_documents

    grid = spark.read.parquet(a.grid)
    merges = spark.read.parquet(a.merges) if a.merges else None
    ex = run_extract(grid, merges)
    write_cells(ex.cells, f"{a.out}/cells")
    ex.relations.write.mode("overwrite").parquet(f"{a.out}/relations")
    ex.report.write.mode("overwrite").parquet(f"{a.out}/relation_report")
    write_documents(workbook_json_fragments(ex.cells, relations=ex.relations), f"{a.out}/workbooks")
    return 0


def _transform(spark: SparkSession, a) -> int:
    from .operators.document import write_documents
    from .operators.quality import RequiredFieldError
    from .plans.run import run_transform
    from .plans.spec import load_spec
    from .sources.sinks import write_flat
    from .sources.workbook_json import read_documents, read_workbooks

    spec = load_spec(a.spec)
    books = None
    if a.cells:
        cells = spark.read.parquet(a.cells)
    else:
        from .operators.quality import workbook_check

        key = (spec.get("input", {}) or {}).get("workbook_key", "workbook")
        docs = read_documents(spark, a.documents)
        # V4: the structure of every input document, reported next to the outputs.
        workbook_check(docs, "value", key).select("workbook_id", "status").write.mode("overwrite").parquet(
            f"{a.out}/document_report")
        books = read_workbooks(docs, key, split=a.split)
        cells = books.cells
    relations = spark.read.parquet(a.relations) if a.relations else None
    try:
        own = {} if books is None else {"rows": books.rows, "sheets": books.sheets}
        if books is not None and relations is None:
            own["mapped"] = books.mapped
        res = run_transform(cells, spec, strict=a.strict, relations=relations, **own)
    except RequiredFieldError as e:
        print(str(e), file=sys.stderr)
        return 2
    write_flat(res.items, res.fields, a.out)
    res.violations.write.mode("overwrite").parquet(f"{a.out}/violations")
    res.report.write.mode("overwrite").parquet(f"{a.out}/sheet_report")
    write_documents(res.fragments, f"{a.out}/documents")
    for w in res.warnings:
        print("warning:", w, file=sys.stderr)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sheetdoc")
    sub = p.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("extract")
    e.add_argument("--grid", required=True)
    e.add_argument("--merges")
    e.add_argument("--out", required=True)
    t = sub.add_parser("transform")
    src = t.add_mutually_exclusive_group(required=True)
    src.add_argument("--cells")
    src.add_argument("--documents")
    t.add_argument("--spec", required=True)
    t.add_argument("--relations")
    t.add_argument("--out", required=True)
    t.add_argument("--strict", action="store_true")
    t.add_argument("--split", action="store_true", help="cut large documents at their rows' ends")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"sheetdoc-{a.cmd}").getOrCreate()
    from .session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return _extract(spark, a) if a.cmd == "extract" else _transform(spark, a)


if __name__ == "__main__":
    sys.exit(main())
