"""Registered queries of the extraction run, sparse scans and the expression vocabulary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import as_sheet, sheet_to_cells
from ..operators import relate
from ..operators.segment import forward_fill
from ..sources.sinks import workbook_json_fragments
from ..sources.workbook_json import read_workbooks
from .extract import run_extract
from .flat import run_flat
from .queries import REGION_SQL, _region_grid, _region_workbooks, _t, query
from .run import run_transform


@query("scope_sparse_keys", """
SELECT event_id, hdr FROM (
  SELECT event_id, MAX(CASE WHEN event_type = 'signup' THEN event_id END)
                     OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hdr FROM events) t
WHERE hdr IS NOT NULL
""")
def scope_sparse_keys(spark, sf):
    """W1 over one giant context whose order keys lie billions apart: the blocks' summaries are
    scanned in blocks themselves."""
    apart = 4_000_000_007
    e = _t(spark, sf, "events").select("event_id", "event_type", (F.col("event_id") * F.lit(apart)).alias("key"))
    out = forward_fill(e, F.col("event_type") == "signup", [], "key", "hdr", block_rows=1 << 16, key_bits=63)
    return out.where(F.col("hdr").isNotNull()).select("event_id", F.expr(f"hdr DIV {apart}L").alias("hdr"))


def _part_grid(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Workbooks of 500 parts each, a row per part: every fifth part's brand cell is merged with
    the two below; every fifth, from the third on, has its size and note merged. Sizes divisible by
    four have a comment."""
    p = _t(spark, sf, "part").select("p_partkey", "p_brand", "p_size", "p_type").withColumn(
        "workbook_id", F.concat(F.lit("b"), F.expr("p_partkey DIV 500").cast("string")))
    none = F.lit(None).cast("string")

    def cell(col, text, comment=none):
        return F.struct(F.lit(col).alias("col"), text.cast("string").alias("text"), comment.alias("comment"),
                        F.when(comment.isNotNull(), F.lit("Ann")).alias("comment_author"))

    note = F.when(F.col("p_size") % 4 == 0, F.concat(F.lit("Ann:\nnote "), F.col("p_size").cast("string"), F.lit(" ")))
    body = p.select("workbook_id", (F.col("p_partkey") + 2).cast("int").alias("row"), F.explode(F.array(
        cell(1, F.col("p_brand")), cell(2, F.col("p_size"), note), cell(3, F.col("p_type")))).alias("c"))
    head = p.select("workbook_id").distinct().select("workbook_id", F.lit(1).alias("row"), F.explode(F.array(
        cell(1, F.lit("Brand (hint)")), cell(2, F.lit(" Size")), cell(3, F.lit("Note")))).alias("c"))
    grid = head.unionByName(body).select("workbook_id", F.lit("parts").alias("sheet"), F.lit(0).alias("sheet_ord"), "row", "c.*")
    row, kind = (F.col("p_partkey") + 2).cast("int"), F.col("p_partkey") % 5
    merges = p.where(kind.isin(0, 3)).select(
        "workbook_id", F.lit("parts").alias("sheet"), row.alias("min_row"), F.when(kind == 0, row + 2).otherwise(row).alias("max_row"),
        F.when(kind == 0, 1).otherwise(2).alias("min_col"), F.when(kind == 0, 1).otherwise(3).alias("max_col"))
    return grid, merges


@query("extract_merged", """
WITH p AS (SELECT *, CASE WHEN p_partkey % 5 IN (1, 2) THEN p_partkey - p_partkey % 5 ELSE p_partkey END AS g, CAST(p_size AS VARCHAR) AS size,
                  CASE WHEN p_size % 4 = 0 THEN 'note ' || p_size END AS note FROM part),
c AS (
  SELECT p.g, p.p_partkey AS r, 'Brand' AS header, t.p_brand AS v, CAST(NULL AS VARCHAR) AS a FROM p JOIN part t ON t.p_partkey = p.g
  UNION ALL SELECT g, p_partkey, 'Size', size, note FROM p
  UNION ALL SELECT g, p_partkey, 'Note', CASE WHEN p_partkey % 5 = 3 THEN size ELSE p_type END, CASE WHEN p_partkey % 5 = 3 THEN note END FROM p),
v AS (SELECT g, header, v, min(r) AS r FROM c GROUP BY g, header, v),
j AS (SELECT g, header, string_agg(v, ', ' ORDER BY r) AS value FROM v GROUP BY g, header),
n AS (SELECT g, header, min(r) AS row_idx, arg_min(a, r) FILTER (WHERE a IS NOT NULL) AS annotation FROM c GROUP BY g, header)
SELECT 'b' || (g // 500) AS workbook_id, row_idx, header, value, annotation FROM j JOIN n USING (g, header)
""")
def extract_merged(spark, sf):
    """R3 with merged ranges and comments: C4-C9 on whole grids, row groups collapsed."""
    return run_extract(*_part_grid(spark, sf)).cells.select("workbook_id", "row_idx", "header", "value", "annotation")


@query("relation_report", REGION_SQL + """
SELECT r_name AS workbook_id, 2 * count(*) - count(*) FILTER (WHERE bal > 2500 AND bal <= 5000) + count(*) FILTER (WHERE bal < 0) AS edges,
       2 * count(*) - count(*) FILTER (WHERE bal > 2500 AND bal <= 5000) AS matched, count(*) FILTER (WHERE bal < 0) AS unmatched
FROM cn GROUP BY r_name
""")
def relation_report(spark, sf):
    """J3 + V6: one outer join of edges to keys, counted per workbook."""
    cells = _region_workbooks(spark, sf)
    return relate.relation_report(relate.join_edges(relate.map_edges(cells), relate.key_index(cells)))


@query("mapped_fields", """
SELECT r_name AS workbook_id, n_name AS nation, c_name AS field, 'X' AS value, 'string' AS type
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT r_name, n_name, 'Region', r_name, NULL FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def mapped_fields(spark, sf):
    """Fields of a nation from the customer rows that relate to it."""
    ex = run_extract(_region_grid(spark, sf))
    spec = {"sheets": {"Nations": {"items": [{
        "templateKey": "nation", "filter": ".", "name": {"field": "Nation (Key)"}, "fields": [{"name": "Region", "value": "Region"}],
        "dynamic_fields": {"source": "__MAPPED_Customers", "name_from": "Customer", "value_from": "__MAP_VALUE__", "type": "getType"}}]}}}
    res = run_transform(ex.cells, spec, relations=ex.relations)
    key = ["workbook_id", "sheet", "item_id"]
    named = res.items.select(*key, F.col("name").alias("nation"))
    return res.fields.join(named, key).select("workbook_id", "nation", F.col("name").alias("field"), F.col("text").alias("value"), "type")


@query("workbook_json_doc", """
WITH nr AS (SELECT n_nationkey AS nk, n_name AS nn, r_name AS wb FROM nation JOIN region ON n_regionkey = r_regionkey),
cn AS (SELECT c_custkey AS ck, c_name AS cname, c_nationkey AS own, wb FROM customer JOIN nr ON nk = c_nationkey),
cb AS (SELECT cn.wb, ck, own, '"Customer":{"value":"' || any_value(cname) || '"}' ||
              string_agg(',"[MAP] ' || nn || '":{"value":"' || CASE WHEN nk = own THEN 'x' ELSE '' END || '"}', '' ORDER BY nk) AS body
       FROM cn JOIN nr ON nr.wb = cn.wb GROUP BY cn.wb, ck, own),
nb AS (SELECT wb, nk, '"Nation (Key)":{"value":"' || nn || '"},"Region":{"value":"' || wb || '"}' AS body,
              nk = min(nk) OVER (PARTITION BY wb) AS first FROM nr),
wbs AS (SELECT DISTINCT wb FROM nr), cwbs AS (SELECT DISTINCT wb FROM cn), with_c AS (SELECT DISTINCT wb, own FROM cn)
SELECT wb AS workbook_id, '-1.0.0.0.0.0' AS frag_key, '{"workbook":{' AS text FROM wbs
UNION ALL SELECT wb, '4611686018427387904.0.0.0.0.0', '}}' FROM wbs
UNION ALL SELECT wb, '0.0.0.0.0.0', '"Nations":[' FROM wbs UNION ALL SELECT wb, '0.2.0.0.0.0', ']' FROM wbs
UNION ALL SELECT wb, '1.0.0.0.0.0', ',"Customers":[' FROM cwbs UNION ALL SELECT wb, '1.2.0.0.0.0', ']' FROM cwbs
UNION ALL SELECT wb, '0.1.' || nk || '.0.0.0', CASE WHEN first THEN '' ELSE ',' END || '{' || body FROM nb
UNION ALL SELECT wb, '0.1.' || nk || '.9.0.0', '}' FROM nb
UNION ALL SELECT wb, '1.1.' || ck || '.0.0.0', CASE WHEN ck = min(ck) OVER (PARTITION BY wb) THEN '' ELSE ',' END || '{' || body FROM cb
UNION ALL SELECT wb, '1.1.' || ck || '.9.0.0', '}' FROM cb
UNION ALL SELECT wb, '0.1.' || own || '.1.1.0', ',"__MAPPED_Customers":[' FROM with_c
UNION ALL SELECT wb, '0.1.' || own || '.3.1.0', ']' FROM with_c
UNION ALL SELECT wb, '0.1.' || own || '.2.1.' || ck, CASE WHEN ck = min(ck) OVER (PARTITION BY wb, own) THEN '' ELSE ',' END || '{' || body || ',"__MAP_VALUE__":"X"}' FROM cb
""")
def workbook_json_doc(spark, sf):
    """S5 + J4: the extracted workbooks as nested JSON with copies of related rows, in fragments."""
    ex = run_extract(_region_grid(spark, sf))
    frags = workbook_json_fragments(ex.cells, relations=ex.relations)
    return frags.select("workbook_id", F.array_join(F.slice("key", 1, 6).cast("array<string>"), ".").alias("frag_key"), "text")


@query("expr_vocabulary", r"""
SELECT event_id AS row_idx, regexp_replace(event_type, '[aeiou]', '$*', 'g') AS gsub, upper(event_type) AS up, '/' || event_type || '!' AS affix,
       CASE WHEN event_type LIKE 's%' THEN substr(event_type, 2) ELSE event_type END AS ltrim,
       CASE WHEN event_type LIKE '%w' THEN substr(event_type, 1, length(event_type) - 1) ELSE event_type END AS rtrim,
       CASE WHEN event_type LIKE 's%' THEN 'True' ELSE 'False' END AS test, CAST(length(event_type) AS VARCHAR) AS len, '2' AS parts, '' AS nul,
       '["' || event_type || '"]' AS wrap, CAST(event_id AS VARCHAR) AS last, '#ERR:ValueError' AS beyond,
       json_extract_string(props, '$.k') AS got, '' AS missing, CAST(json(props) AS VARCHAR) AS whole, '#ERR:ValueError' AS bad
FROM events
""")
def expr_vocabulary(spark, sf):
    """§2.7: the step vocabulary on one sheet, errors and empty results included."""
    e = _t(spark, sf, "events").select("event_id", "event_type", "props")
    sheet = as_sheet(e, "wb", "events", "event_id", {
        "T": "event_type", "P": "props", "L": F.concat_ws("/", "event_type", F.col("event_id").cast("string"))})
    steps = {
        "gsub": ("T", [["gsub", "[aeiou]", "$*"]]), "up": ("T", [["ascii_downcase"], ["ascii_upcase"]]),
        "affix": ("T", [["prefix", "/"], ["suffix", "!"]]), "ltrim": ("T", [["ltrimstr", "s"]]), "rtrim": ("T", [["rtrimstr", "w"]]),
        "test": ("T", [["test", "^s"]]), "len": ("T", [["length"]]), "parts": ("L", [["split", "/"], ["length"]]), "nul": ("T", [["null"]]),
        "wrap": ("T", [["wrap"]]), "last": ("L", [["split", "/"], ["index", -1]]), "beyond": ("L", [["split", "/"], ["index", 5], ["ascii_upcase"]]),
        "got": ("P", [["fromjson"], ["get", "$.k"]]), "missing": ("P", [["fromjson"], ["get", "$.none"]]), "whole": ("P", [["fromjson"]]),
        "bad": ("T", [["fromjson"]]),
    }
    spec = {"items": [{"templateKey": "e", "filter": ".", "name": "e", "fields": [
        {"name": n, "value": c, "transform": t} for n, (c, t) in steps.items()]}]}
    return run_flat(sheet, spec, list(steps))[0].select("row_idx", *steps)


@query("corpus_transform", """
WITH nr AS (SELECT n_nationkey AS nk, n_name AS nn FROM nation),
o AS (SELECT 'w' || c_nationkey AS wb, o_orderkey AS r, o_orderpriority AS pr, o_orderstatus AS st, o_totalprice AS price FROM orders JOIN customer ON o_custkey = c_custkey),
seg AS (SELECT *, max(CASE WHEN pr = '1-URGENT' THEN r END) OVER (PARTITION BY wb ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS h FROM o)
SELECT 'w' || c_nationkey AS workbook_id, 'customers' AS sheet, 1 AS depth, c_custkey AS row_idx, c_name AS name,
       CASE WHEN c_acctbal > 5000 THEN 2 ELSE 1 END AS n_fields, c_mktsegment AS first_field FROM customer
UNION ALL SELECT 'w' || s_nationkey, 'suppliers', 1, s_suppkey, s_name, 2, nn FROM supplier JOIN nr ON nk = s_nationkey WHERE s_suppkey % 3 <> 0
UNION ALL SELECT wb, 'orders', 1, r, 'urgent ' || r, 1, st FROM o WHERE pr = '1-URGENT'
UNION ALL SELECT wb, 'orders', 2, r, 'final ' || r, 1, pr FROM seg WHERE h IS NOT NULL AND st = 'F'
""")
def corpus_transform(spark, sf):
    """R2 over a corpus: a workbook per nation with four sheets of different shapes, run together;
    the jobs are those of the levels, not of the sheets."""
    wb = lambda c: F.concat(F.lit("w"), F.col(c).cast("string"))
    c, n = _t(spark, sf, "customer"), _t(spark, sf, "nation")
    o = _t(spark, sf, "orders").join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    sheets = [
        as_sheet(c, wb("c_nationkey"), "customers", "c_custkey", {"Name": "c_name", "Segment": "c_mktsegment", "Balance": "c_acctbal"}),
        as_sheet(_t(spark, sf, "supplier"), wb("s_nationkey"), "suppliers", "s_suppkey", {
            "Name": "s_name", "Nation": "s_nationkey", "Kind": (F.col("s_suppkey") % 3).cast("string")}),
        as_sheet(n, wb("n_nationkey"), "nations", "n_nationkey", {"Nation (Key)": "n_nationkey", "Title": "n_name"}),
        as_sheet(o, wb("c_nationkey"), "orders", "o_orderkey", {
            "Priority": "o_orderpriority", "Status": "o_orderstatus", "Key": "o_orderkey", "Urgent": F.concat(F.lit("urgent "), F.col("o_orderkey").cast("string")),
            "Final": F.concat(F.lit("final "), F.col("o_orderkey").cast("string"))}),
    ]
    cells = reduce(DataFrame.unionByName, [sheet_to_cells(s, s.columns[3:], i) for i, s in enumerate(sheets)])
    spec = {"input": {"sheets": ["orders", "suppliers", "customers", "absent"]}, "sheets": {
        "customers": {"items": [{"templateKey": "customer", "filter": ".", "name": {"field": "Name"}, "fields": [
            {"name": "First", "value": "Segment"},
            {"name": "Rich", "computed": True, "condition": "Balance.value > 5000.0", "value": True, "omit_if_false": True}]}]},
        "suppliers": {"items": [{"templateKey": "supplier", "filter": "Kind.value <> '0'", "name": {"field": "Name"}, "fields": [
            {"name": "First", "lookup": {"sheet": "nations", "key": "Nation (Key)", "take": "Title", "on": "Nation"}}, {"name": "Kind", "value": "Kind"}]}]},
        "orders": {"items": [{"templateKey": "urgent", "filter": "Priority.value = '1-URGENT'", "scope_children": True, "name": {"field": "Urgent"},
                              "fields": [{"name": "First", "value": "Status"}],
                              "children": [{"templateKey": "final", "filter": "Status.value = 'F'", "name": {"field": "Final"},
                                            "fields": [{"name": "First", "value": "Priority"}]}]}]},
        "absent": {"items": [{"templateKey": "x", "filter": "."}]}}}
    res = run_transform(cells, spec)
    key = ["workbook_id", "sheet", "item_id"]
    of_item = res.fields.groupBy(*key).agg(F.count("*").cast("int").alias("n_fields"), F.max(F.when(F.col("name") == "First", F.col("text"))).alias("first_field"))
    return res.items.join(of_item, key, "left").select("workbook_id", "sheet", "depth", "row_idx", "name", "n_fields", "first_field")


@query("workbook_json_split", """
WITH r AS (SELECT o_orderkey, (row_number() OVER (PARTITION BY o_custkey % 3 ORDER BY o_orderkey)) - 1 AS row_idx, o_custkey % 3 AS b, o_orderstatus, o_orderpriority FROM orders)
SELECT 'b' || b AS workbook_id, 'orders' AS sheet, row_idx, 'Key' AS header, CAST(o_orderkey AS VARCHAR) AS value FROM r
UNION ALL SELECT 'b' || b, 'orders', row_idx, 'Note', o_orderstatus || '},{' || o_orderpriority FROM r
UNION ALL SELECT 'b' || (n_nationkey % 3), 'nations', (row_number() OVER (PARTITION BY n_nationkey % 3 ORDER BY n_nationkey)) - 1, 'Name', n_name FROM nation
""")
def workbook_json_split(spark, sf):
    """S1 over three large workbooks: each document, in ordered fragments, is cut at its rows' ends and
    parsed by all tasks."""
    o, n = _t(spark, sf, "orders"), _t(spark, sf, "nation")
    text = lambda c: F.concat(F.lit('{"value":"'), c, F.lit('"}'))
    note = F.concat_ws("},{", "o_orderstatus", "o_orderpriority")
    row = F.concat(F.lit('{"Key":'), text(F.col("o_orderkey").cast("string")), F.lit(',"Note":'), text(note), F.lit("}"))
    orders = o.select((F.col("o_custkey") % 3).alias("b"), F.col("o_orderkey").cast("long").alias("k"), row.alias("r"))
    nations = n.select((F.col("n_nationkey") % 3).alias("b"), F.col("n_nationkey").cast("long").alias("k"),
                       F.concat(F.lit('{"Name":'), text(F.col("n_name")), F.lit("}")).alias("r"))
    # a null row is left out; the first of a list has no comma before it
    firsts = [s.groupBy("b").agg(F.min(F.when(F.col("r").isNotNull(), F.struct("k", "r"))).alias(f)) for s, f in ((orders, "f1"), (nations, "f3"))]
    books = firsts[0].join(firsts[1], "b")

    def listed(rows, part):
        each = rows.where("r IS NOT NULL").groupBy("b", "k", "r").count().select("b", "k", "r", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("i"))
        is_first = F.struct("k", "r").eqNullSafe(F.col(f"f{part}")) & (F.col("i") == 1)
        return each.join(books, "b").select("b", F.lit(part).alias("part"), "k", "i", F.when(is_first, F.col("r")).otherwise(F.concat(F.lit(", "), "r")).alias("value"))

    around = F.explode(F.array(*(F.struct(F.lit(p).alias("part"), F.lit(t).alias("value")) for p, t in ((0, '{"workbook":{"orders":['), (2, '],"nations":['), (4, "]}}")))))
    around = books.select("b", around.alias("e")).select("b", "e.part", F.lit(None).cast("long").alias("k"), F.lit(1).alias("i"), "e.value")
    docs = around.unionByName(listed(orders, 1)).unionByName(listed(nations, 3)).withColumn("workbook_id", F.concat(F.lit("b"), F.col("b").cast("string")))
    # the first row's text lacks its comma, so texts are compared from their braces on
    docs = docs.withColumn("r", F.regexp_replace("value", "^, ", ""))
    return read_workbooks(docs, split=True, order=["part", "k", "r", "i"]).cells.select("workbook_id", "sheet", "row_idx", "header", "value")
