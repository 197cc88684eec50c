"""The incremental transform over a landing folder (availableNow trigger)."""

import glob
import json
import os
import tempfile

from fixtures import NURSERY, SPEC_FILE

from sheetdoc.plans.spec import load_spec

from sheetdoc.streaming.corpus import start_transform_stream


def test_stream_transforms_landed_workbooks(spark):
    base = tempfile.mkdtemp(prefix="sheetdoc-stream-", dir="/tmp")
    land, out = os.path.join(base, "in"), os.path.join(base, "out")
    os.makedirs(land)
    small = {name: NURSERY[name] for name in ("beds", "orders")}
    for name in ("a", "b"):
        with open(os.path.join(land, f"{name}.json"), "w") as fh:
            json.dump({"workbook": small}, fh)
    whole = load_spec(SPEC_FILE)
    spec = {"input": {"sheets": ["beds", "orders"]}, "sheets": {k: whole["sheets"][k] for k in ("beds", "orders")}}
    q = start_transform_stream(spark, land, spec, out, checkpoint=os.path.join(base, "ckpt"), available_now=True)
    q.awaitTermination(300)
    items = spark.read.parquet(os.path.join(out, "items"))
    assert items.select("workbook_id").distinct().count() == 2
    assert items.where("depth = 1 AND sheet = 'beds'").count() == 4
    # each workbook's document parts, concatenated in order, are the JSON document
    for wb_dir in glob.glob(os.path.join(out, "documents", "batch_id=*", "workbook_id=*")):
        text = "".join(open(f).read().replace("\n", "") for f in sorted(glob.glob(os.path.join(wb_dir, "part-*"))))
        docs = json.loads(text)
        assert [len(d["items"]) for d in docs] == [2, 2]
