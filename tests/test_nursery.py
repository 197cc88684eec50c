"""The nursery workbook end to end: from cells, and as a job from workbook JSON."""

import glob
import json

from assemble import assemble_small
from fixtures import NURSERY, NURSERY_DOCUMENTS, SPEC_FILE

from sheetdoc.plans.run import run_transform
from sheetdoc.plans.spec import load_spec
from sheetdoc.sources.workbook_json import cells_from_python


def test_documents_from_cells(spark):
    res = run_transform(cells_from_python(spark, NURSERY), load_spec(SPEC_FILE))
    assert json.loads(assemble_small(res.fragments)) == NURSERY_DOCUMENTS


def test_transform_job_entry_point(spark, tmp_path):
    from sheetdoc.__main__ import main

    (tmp_path / "wb.json").write_text(json.dumps({"workbook": NURSERY}))
    assert main(["transform", "--documents", str(tmp_path / "wb.json"), "--spec", SPEC_FILE, "--out", str(tmp_path / "out")]) == 0
    parts = sorted(glob.glob(str(tmp_path / "out" / "documents" / "workbook_id=*" / "part-*")))
    assert json.loads("".join(open(p).read().replace("\n", "") for p in parts)) == NURSERY_DOCUMENTS
    count = sum(1 + len(i.get("children", [])) for d in NURSERY_DOCUMENTS for i in d["items"])
    assert spark.read.parquet(str(tmp_path / "out" / "items")).count() == count
    values = {r.value_json for r in spark.read.parquet(str(tmp_path / "out" / "fields")).collect()}
    assert {'"17"', '""', '"one is blunt"'} <= values
    assert [r.status for r in spark.read.parquet(str(tmp_path / "out" / "document_report")).collect()] == ["ok"]
