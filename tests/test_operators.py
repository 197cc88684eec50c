"""Operator units: relations, cleaning, segmentation, sources and plan shape."""

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from sheetdoc.model import CELLS_SCHEMA
from sheetdoc.operators import clean, relate
from sheetdoc.operators.quality import workbook_check
from sheetdoc.operators.segment import forward_fill
from sheetdoc.plans.run import run_transform
from sheetdoc.sources.workbook_json import cells_from_python, documents_to_cells, read_workbooks


def test_matrix_relations_golden(spark):
    wb = {
        "herbs": [{"Herb (Key)": {"value": "basil"}, "Name": {"value": "Green"}},
                   {"Herb (Key)": {"value": "thyme"}, "Name": {"value": "Grey"}}],
        "dishes": [{"Dish": {"value": "Soup"}, "[MAP] basil": {"value": "YES"}, "[MAP] thyme": {"value": ""}},
                 {"Dish": {"value": "Stew"}, "[MAP] basil": {"value": "YES"}, "[MAP] thyme": {"value": "YES"}}],
    }
    cells = cells_from_python(spark, wb)
    rel, un = relate.match_edges(relate.map_edges(cells), relate.key_index(cells))
    got = sorted((r.target_key, r.target_sheet, r.target_row, r.source_sheet, r.source_row, r.map_value)
                 for r in rel.collect())
    assert got == [("basil", "herbs", 0, "dishes", 0, "YES"), ("basil", "herbs", 0, "dishes", 1, "YES"),
                   ("thyme", "herbs", 1, "dishes", 1, "YES")]
    assert un.count() == 0
    joined = relate.join_edges(relate.map_edges(cells), relate.key_index(cells))
    assert [tuple(r) for r in relate.relation_report(joined).collect()] == [(cells.first().workbook_id, 3, 3, 0)]
    assert spark.range(1).select(relate.attach_name(F.lit("my source"))).first()[0] == "__MAPPED_my_source"


def test_matrix_cells_that_count_and_unmatched(spark):
    marks = {"no ": False, "n": False, " 0": False, "False": False, "  ": False, "00": True, "y": True, "see note": True, "-": True}
    book = {"rooms": [{"Room (Key)": {"value": "attic"}}],
            "lamps": [{"Lamp": {"value": f"lamp {i}"}, "[MAP] attic": {"value": m}} for i, m in enumerate(marks)],
            "fans": [{"Fan": {"value": "small"}, "[map] cellar": {"value": "x"}}]}
    cells = cells_from_python(spark, book)
    rel, un = relate.match_edges(relate.map_edges(cells), relate.key_index(cells))
    assert sorted(r.map_value for r in rel.collect()) == sorted(m.strip().upper() for m, counts in marks.items() if counts)
    assert [(r.slug, r.source_sheet) for r in un.collect()] == [("cellar", "fans")]


def test_key_index_last_wins(spark):
    wb = {"a": [{"ID (Key)": {"value": "K"}, "n": {"value": "1"}}],
          "b": [{"Code (Key)": {"value": "K"}}, {"Code (Key)": {"value": "K"}}, {"Code (Key)": {"value": ""}}]}
    ki = relate.key_index(cells_from_python(spark, wb)).collect()
    assert [(r.key, r.sheet, r.row_idx) for r in ki] == [("K", "b", 1)]


def test_collapse_and_merge_cells(spark):
    rows = [("wb", "s", 0, 1, 0, "Cat", "A", None), ("wb", "s", 0, 1, 1, "Cat", "A", "first"),
            ("wb", "s", 0, 1, 2, "Cat", "nan", "second"), ("wb", "s", 0, 1, 3, "Cat", "B", None),
            ("wb", "s", 0, 1, 4, "Cat", "", None), ("wb", "s", 0, 2, 5, "Cat", "nan", None)]
    cells = spark.createDataFrame(rows, "workbook_id string, sheet string, x int, group_id bigint, row_idx bigint, "
                                        "header string, value string, annotation string")
    out = {r.group_id: (r.value, r.annotation, r.row_idx) for r in clean.collapse_groups(cells).collect()}
    assert out == {1: ("A, B", "first", 0), 2: ("", None, 5)}


def test_merge_islands_and_fill(spark):
    merges = spark.createDataFrame(
        [("w", "s", 2, 4, 1, 1), ("w", "s", 4, 6, 2, 2), ("w", "s", 8, 9, 1, 1), ("w", "s", 11, 11, 1, 3),
         ("w", "s", 7, 7, 2, 2)],
        "workbook_id string, sheet string, min_row int, max_row int, min_col int, max_col int")
    isl = sorted(tuple(r) for r in clean.merge_islands(merges, block_rows=1 << 10).select(
        "island_start", "island_end", "n_ranges").collect())
    assert isl == [(2, 6, 2), (8, 9, 1)]
    grid = spark.createDataFrame(
        [("w", "s", r, c, f"v{r}{c}", None) for r in range(2, 12) for c in (1, 2, 3)],
        "workbook_id string, sheet string, row int, col int, value string, annotation string")
    filled = {(r.row, r.col): r.value for r in clean.fill_merged(grid, merges).where("is_merged").collect()}
    assert filled[(3, 1)] == "v21" and filled[(6, 2)] == "v42" and filled[(11, 3)] == "v111"
    assert (5, 1) not in filled


def test_merge_that_begins_in_the_header_row(spark):
    grid = spark.createDataFrame(
        [("w", "s", r, c, t, None, None) for r, c, t in ((1, 1, " Size (cm)"), (1, 2, "Kind"), (2, 1, None), (2, 2, "x"), (3, 1, "9"), (3, 2, "y"))],
        "workbook_id string, sheet string, row int, col int, text string, comment string, comment_author string")
    merges = spark.createDataFrame([("w", "s", 1, 2, 1, 1)], "workbook_id string, sheet string, min_row int, max_row int, min_col int, max_col int")
    got = {(c.row_idx, c.header): c.value for c in clean.build_cells(grid, merges).collect()}
    assert got == {(0, "Size"): "Size (cm)", (0, "Kind"): "x", (1, "Size"): "9", (1, "Kind"): "y"}


def test_build_cells_from_grid(spark):
    grid = spark.createDataFrame([
        ("w", "s", 1, 1, "Name (hint)", None, None), ("w", "s", 1, 2, "Unnamed: 1", None, None),
        ("w", "s", 1, 3, "Name", None, None), ("w", "s", 2, 1, "  left ", "Bob:\nnote", "Bob"),
        ("w", "s", 2, 2, "x", None, None), ("w", "s", 2, 3, "right", None, None),
        ("w", "t", 1, 1, "Only header", None, None),
    ], "workbook_id string, sheet string, row int, col int, text string, comment string, comment_author string")
    cells = clean.build_cells(grid).collect()
    # duplicate header after normalisation: the rightmost column wins (T2); Unnamed dropped
    assert [(c.sheet, c.row_idx, c.header, c.value, c.col_idx) for c in cells] == [("s", 0, "Name", "right", 3)]


def test_blocked_scan_equals_window_and_is_order_invariant(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "user_id", "event_type")
    hdr = F.col("event_type") == "signup"
    ref = forward_fill(ev, hdr, ["user_id"], "event_id", "s", block_rows=None)
    shuffled = ev.repartition(7, F.rand(3))
    blk = forward_fill(shuffled, hdr, ["user_id"], "event_id", "s", block_rows=256)
    giant = forward_fill(shuffled, hdr, [], "event_id", "s", block_rows=64, key_bits=18)
    w = Window.orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    giant_ref = ev.withColumn("s", F.max(F.when(hdr, F.col("event_id"))).over(w))
    key = lambda df: sorted(tuple(r) for r in df.select("event_id", "s").collect())
    assert key(ref) == key(blk)
    assert key(giant) == key(giant_ref)


def test_scan_of_sparse_keys_in_bounded_blocks(spark):
    """Keys that lie anywhere in 62 bits: every level's windows stay within a block."""
    import random

    r = random.Random(3)
    keys = sorted(r.sample(range(1 << 62), 400))
    rows = spark.createDataFrame([(k, r.random() < 0.1) for k in keys], "k long, h boolean").repartition(5)
    got = {x.k: x.s for x in forward_fill(rows, F.col("h"), [], "k", "s", block_rows=1 << 9, key_bits=63).collect()}
    last, want = None, {}
    for x in sorted(rows.collect()):
        last = x.k if x.h else last
        want[x.k] = last
    assert got == want


def test_merge_over_ten_million_rows(spark):
    """A tall merge costs no more than its two ends: nothing is expanded to rows."""
    ddl = "workbook_id string, sheet string, row int, col int, value string, annotation string"
    at = [1, 2, 3, 5_000_000, 10_000_001, 10_000_002]
    cells = spark.createDataFrame([("w", "s", x, c, f"v{x}-{c}", "note" if x == 2 else None) for x in at for c in (1, 2)], ddl)
    merges = spark.createDataFrame([("w", "s", 2, 10_000_001, 1, 1)], "workbook_id string, sheet string, min_row int, max_row int, min_col int, max_col int")
    got = {(c.row, c.col): (c.value, c.annotation, c.is_merged) for c in clean.fill_merged(cells, merges).collect()}
    assert len(got) == 12 and {x for x, c in got if got[x, c][2]} == {2, 3, 5_000_000, 10_000_001}
    assert got[5_000_000, 1] == ("v2-1", "note", True) and got[5_000_000, 2] == ("v5000000-2", None, False)
    rows = cells.select("workbook_id", "sheet", (F.col("row") - 2).cast("long").alias("row_idx")).where("row_idx >= 0").distinct()
    islands = clean.merge_islands(merges.withColumn("min_row", F.col("min_row") - 2).withColumn("max_row", F.col("max_row") - 2))
    groups = {x.row_idx: x.group_id for x in clean.row_groups(rows, islands).collect()}
    assert groups == {0: 0, 1: 0, 4_999_998: 0, 9_999_999: 0, 10_000_000: 10_000_000}


def test_overlapping_merges_give_each_row_to_the_last_range(spark):
    """Not possible in a workbook, but defined: the greatest (min_row, min_col) that covers a row."""
    import random

    r = random.Random(5)
    ranges = {(a, a + r.randrange(9), c, c + r.randrange(3)) for a, c in ((r.randrange(2, 40), r.randrange(1, 5)) for _ in range(25))}
    ranges = list({(a, c): (a, b, c, d) for a, b, c, d in ranges}.values())
    cells = spark.createDataFrame([("w", "s", x, c, f"{x}-{c}", None) for x in range(1, 55) for c in range(1, 8)],
                                  "workbook_id string, sheet string, row int, col int, value string, annotation string")
    merges = spark.createDataFrame([("w", "s", *x) for x in ranges], "workbook_id string, sheet string, min_row int, max_row int, min_col int, max_col int")
    got = {(c.row, c.col): c.value for c in clean.fill_merged(cells, merges).collect()}
    for x in range(1, 55):
        for c in range(1, 8):
            over = [(a, lo) for a, b, lo, hi in ranges if a <= x <= b and lo <= c <= hi]
            assert got[x, c] == ("%d-%d" % max(over) if over and x >= 2 else f"{x}-{c}")


def test_workbook_json_source_and_check(spark):
    doc = {"workbook": {"s2": [{"B": {"value": "1"}, "A": {"value": "x", "annotation": "n"}}],
                        "s1": [{"C": {"value": ""}}, {"C": {"value": "z"}, "__MAP_VALUE__": "YES",
                                                      "__MAPPED_s2": [{"B": {"value": "1"}}]}]}}
    docs = spark.createDataFrame([("d1", json.dumps(doc))], "workbook_id string, value string")
    cells = documents_to_cells(docs).orderBy("sheet_ord", "row_idx", "col_idx").collect()
    assert [(c.sheet, c.sheet_ord, c.row_idx, c.col_idx, c.header, c.value, c.annotation) for c in cells] == [
        ("s2", 0, 0, 1, "B", "1", None), ("s2", 0, 0, 2, "A", "x", "n"), ("s1", 1, 0, 1, "C", "", None),
        ("s1", 1, 1, 1, "C", "z", None), ("s1", 1, 1, 2, "__MAP_VALUE__", "YES", None)]
    texts = ["not json", "[1]", '{"other": {}}', '{"workbook": []}', '{"workbook": {}}', '{"workbook": null}']
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    assert [r.status for r in workbook_check(raw).collect()] == [
        "invalid_json", "not_an_object", "missing_key", "key_not_an_object", "ok", "key_not_an_object"]


def test_plans_stay_native(spark):
    """Every query of the reference's operators: no Python evaluation, no cartesian product, no
    nested-loop join. Stage boundaries stay lazy here, so the plans reach down to the scans."""
    from sheetdoc.plans.queries import QUERIES

    spark.conf.set("spark.sheetdoc.materialize", "none")
    try:
        for name, fn in QUERIES.items():
            plan = fn(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
            assert "FileScan parquet" in plan, name
            assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    finally:
        spark.conf.unset("spark.sheetdoc.materialize")


def test_pipeline_invariant_to_input_order_and_partitions(spark):
    """Same items and fields whatever the input order and partitioning (row keys carry order)."""
    from sheetdoc.plans import queries as Q
    from sheetdoc.plans.pipeline import run_sheet

    sheet = Q._hierarchy_sheet(spark, "/root/testdata/sf0.001")

    def result(df, block_rows):
        res = run_sheet(df, Q.HIERARCHY_SPEC, block_rows=block_rows)
        items = sorted((r.item_id, r.name, r.depth) for r in res.items.collect())
        fields = sorted((r.item_id, r.name, r.text) for r in res.fields.collect())
        return items, fields

    base = result(sheet, None)
    assert base == result(sheet.repartition(5, F.rand(7)), 1 << 20)
    assert base == result(sheet.repartition(3, F.rand(11)), 1 << 30)


def test_split_documents_give_the_same_frames(spark):
    """Large documents cut at row ends: odd texts, strings that look like rows, nested lists."""
    import random

    r = random.Random(2)

    def row(i):
        v = r.choice(["x", "},{", '"},{"', "a\\\\", '\\\\"', "},\\n {", "[", "]", "{", "é\U0001f600"]) + str(i)
        out = {"A": {"value": v}, "B": {"value": str(i), "annotation": "n},{"}}
        if r.random() < 0.2:
            out["__MAPPED_s"] = [{"K": {"value": v}, "__MAP_VALUE__": "Y"}, {"K": {"value": "},{"}, "__MAP_VALUE__": "N"}]
        return r.choice([out, out, out, {}, out | {"L": [{"a": 1}, {"b": [2]}]}])

    books = {}
    for k in range(6):
        sheets = {f"s{j}": [row(i) for i in range(r.choice([0, 1, 2, 3, 30]))] for j in range(r.randrange(1, 6))}
        sheets |= {"odd": {"x": [{"a": {}}, {"b": {}}]}, "mixed": [1, {"A": {"value": "1"}}, [], {"A": {"value": "2"}}, {}, {"A": {"value": "3"}}, None], "word": "oops"}
        books[f"b{k}"] = json.dumps({"workbook": sheets, "more": [{"a": 1}, {"b": 2}, {"c": 3}]}, indent=r.choice([None, 1]), ensure_ascii=bool(k % 2))
    books |= {"bare": json.dumps({"s": [row(i) for i in range(9)]}), "late": json.dumps({"m": [{}, {}, {}], "workbook": {"s": [row(i) for i in range(9)]}}),
              "list": "[{},{},{}]", "bad": '{"workbook":{"s":[{"A":{"value":"1"}},{"A"', "none": None, "blank": " "}
    docs = spark.createDataFrame(list(books.items()), "workbook_id string, value string")
    whole, parts = read_workbooks(docs), read_workbooks(docs, split=True)
    for name in ("cells", "rows", "sheets", "mapped"):
        a, b = (sorted(map(str, getattr(w, name).collect())) for w in (whole, parts))
        assert a == b, name
    assert whole.cells.count() > 200 and whole.mapped.count() > 20


def test_fragments_of_documents_give_the_frames_of_whole_ones(spark, monkeypatch):
    """Documents cut anywhere but within an escape, over several blocks, in columns that order them."""
    import random
    import re

    from sheetdoc.sources import workbook_json

    monkeypatch.setattr(workbook_json, "BLOCK_BITS", 2)
    r = random.Random(5)
    row = lambda i: {"A": {"value": r.choice(["x", "},{", '"},{"', '\\\\"', "[", "é"]) + str(i)}, "L": [{"a": {}}, {"b": 1}]}
    books = {f"b{k}": json.dumps({"workbook": {"s": [row(i) for i in range(25)], "t": [row(i) for i in range(k)], "odd": [1, {}, [], {}]}}) for k in range(3)}
    books |= {"other": json.dumps({"s": [row(i) for i in range(5)]}), "bad": '{"workbook":{"s":[{"A":{"value":"1"}},{"A"'}
    rows = []
    for k, text in books.items():
        parts, at = re.findall(r"(?s)\\u....|\\.|.", text), 0
        while at < len(parts):  # the first one has the workbook's opening brace; some end where a row does
            n = 20 if not at else r.choice([1, 3, 40, 90])
            rows.append((k, at // 100, at % 100, "".join(parts[at : at + n])))
            at += n
    r.shuffle(rows)
    whole = read_workbooks(spark.createDataFrame(list(books.items()), "workbook_id string, value string"))
    docs = spark.createDataFrame(rows, "workbook_id string, page int, line int, value string")
    parts = read_workbooks(docs, split=True, order=["page", "line"])
    for name in ("cells", "rows", "sheets", "mapped"):
        a, b = (sorted(map(str, getattr(w, name).collect())) for w in (whole, parts))
        assert a == b, name
    assert whole.cells.count() > 70


def test_json_booleans_read_as_python_writes_them(spark):
    row = '{"a":{"value":true},"b":{"value":"true"},"c":{"annotation":"x \\"value\\": true,","value":"false"},"d":{"value": false ,"annotation":"n"},"e":{"value":1.50}}'
    docs = spark.createDataFrame([("d", '{"workbook":{"s":[' + row + "]}}")], "workbook_id string, value string")
    got = {c.header: c.value for c in documents_to_cells(docs).collect()}
    assert got == {"a": "True", "b": "true", "c": "false", "d": "False", "e": "1.5"}


def test_workbook_json_bare_and_list_documents(spark):
    bare = json.dumps({"s": [{"A": {"value": "1"}}]})
    lst = json.dumps([{"A": {"value": "x"}}, {"A": {"value": "y"}}])
    docs = spark.createDataFrame([("bare", bare), ("list", lst)], "workbook_id string, value string")
    got = sorted((c.workbook_id, c.sheet, c.row_idx, c.value)
                 for c in documents_to_cells(docs, list_sheets=["s1", "s2"]).collect())
    assert got == [("bare", "s", 0, "1"), ("list", "s1", 0, "x"), ("list", "s1", 1, "y"),
                   ("list", "s2", 0, "x"), ("list", "s2", 1, "y")]


def test_cells_to_sheet_any_number_of_headers(spark):
    import sheetdoc.model as M

    for n in (1, 33, 200):
        rows = [("w", "s", 0, r, c + 1, f"h{c}", f"v{r}.{c}", None) for r in range(3) for c in range(n) if n == 1 or (r + c) % 3]
        rows += [("w", "s", 0, 3, 1, "other", "x", None),  # a row with no selected header
                 ("w", "s", 0, 4, 1, "h0", "z", None), ("w", "s", 0, 4, 2, "h0", "a", None),  # the last one counts
                 ("w", "s", 0, 4, 3, "H0", "other case", None)]
        cells = spark.createDataFrame(rows, CELLS_SCHEMA)
        blank = spark.createDataFrame([("w", "s", 9)], "workbook_id string, sheet string, row_idx long")
        got = {r["row_idx"]: r for r in M.cells_to_sheet(cells, [f"h{c}" for c in range(n)], blank).collect()}
        assert sorted(got) == [0, 1, 2, 3, 4, 9]
        for _, _, _, r, _, h, v, _ in rows[:-4]:
            assert got[r][h].value == v
        assert got[4]["h0"].value == "a" and got[3]["h0"] is None and got[9]["h0"] is None


def test_workbook_json_odd_parts_stay_alone(spark):
    docs = {
        "odd": '{"workbook":{"a":[{"H":{"value":"1"}}],"b":"oops","c":{"x":1}}}',
        "extra": '{"meta":"x","a":[{"H":{"value":"1"}}]}',
        "twice": '{"workbook":{"a":[{"H":{"value":"1"},"G":{"value":"2"},"H":{"value":"3"}}]}}',
        "blank": '{"workbook":{"a":[{},{"H":{"value":"1"}},{}],"e":[]}}',
        "broken": "{",
    }
    frame = spark.createDataFrame(list(docs.items()), "workbook_id string, value string")
    books = read_workbooks(frame)
    cells = sorted((c.workbook_id, c.sheet, c.row_idx, c.header, c.value) for c in books.cells.collect())
    assert cells == [("blank", "a", 1, "H", "1"), ("extra", "a", 0, "H", "1"), ("odd", "a", 0, "H", "1"),
                     ("twice", "a", 0, "G", "2"), ("twice", "a", 0, "H", "3")]
    rows = sorted((r.workbook_id, r.sheet, r.row_idx) for r in books.rows.collect() if r.workbook_id == "blank")
    assert rows == [("blank", "a", 0), ("blank", "a", 1), ("blank", "a", 2)]
    assert ("blank", "e") in {(r.workbook_id, r.sheet) for r in books.sheets.collect()}


def test_blank_rows_empty_sheets_and_attached_rows_reach_the_documents(spark):
    from assemble import assemble_small

    text = json.dumps({"workbook": {
        "a": [{}, {"H": {"value": "1"}, "__MAPPED_b": [{"N": {"value": "p"}, "V": {"value": "q"}, "__MAP_VALUE__": "YES"}]}, {}],
        "e": [],
    }})
    books = read_workbooks(spark.createDataFrame([("w", text)], "workbook_id string, value string"))
    item = {"templateKey": "t", "filter": ".", "name": {"field": "H"}, "fields": []}
    spec = {"sheets": {
        "a": {"items": [item | {"dynamic_fields": {"source": "__MAPPED_b", "name_from": "N", "value_from": "V"}}]},
        "e": {"items": [item]},
    }}
    res = run_transform(books.cells, spec, rows=books.rows, sheets=books.sheets, mapped=books.mapped)
    got = json.loads(assemble_small(res.fragments))
    assert len(got) == 2 and got[1]["items"] == []
    assert [i["name"] for i in got[0]["items"]] == ["", "1", ""]
    assert got[0]["items"][1]["fields"] == [{"name": "p", "value": "q"}]


def test_pushdown_and_pruning_reach_the_scan(spark):
    from sheetdoc.plans.queries import QUERIES

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = QUERIES["merge_islands"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan.split("PushedFilters:")[1]
    plan = QUERIES["computed_field"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    scan = [l for l in plan.splitlines() if "FileScan parquet" in l][0]
    assert "o_orderdate" not in scan and "o_custkey" not in scan and "o_totalprice" in scan
