"""Registered queries: every operator family of the blueprint run over the given tables.

Each query reads whole tables (no row caps, no id subsets) from ``sf_dir`` and returns flat,
aliased scalar columns. ``ORACLE`` holds the equivalent DuckDB SQL over the same tables.
Tables are read as the engine would read a corpus: parquet scans with pruning/pushdown.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import xl
from ..model import as_sheet, sheet_to_cells
from ..operators import clean, generate as gen, quality as qa, relate
from ..operators.segment import forward_fill
from .flat import pivot_fields, run_flat
from .pipeline import run_sheet
from .run import run_transform, select_sheets
from ..session import materialize
from ..sources.workbook_json import read_workbooks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Item ids repeat in every workbook and sheet.
ITEM_KEY = ["workbook_id", "sheet", "item_id"]


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- SQL snippets shared by the oracles (DuckDB / RE2) ----------------------------------------
# Python's white space, as a character class of RE2
WS = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def S_STRIP(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def S_GETTYPE(x: str) -> str:
    v = S_STRIP(x)
    return (f"CASE WHEN coalesce({v}, '') = '' THEN 'string' "
            f"WHEN regexp_full_match(replace({v}, ',', ''), '-?[0-9]+(\\.[0-9]+)?') THEN 'number' "
            f"WHEN lower({v}) IN ('yes','no','true','false','✓','✗') THEN 'boolean' ELSE 'string' END")


def S_SLUG(x: str) -> str:
    v = f"lower({S_STRIP(x)})"
    v = f"regexp_replace({v}, '[^\\pL\\pN_{WS}-]', '', 'g')"
    v = f"regexp_replace({v}, '[{WS}_-]+', '-', 'g')"
    return f"regexp_replace({v}, '^-+|-+$', '', 'g')"


NOT_BLANK = "NOT ({}.value <=> '')"


def _path_r(i: int) -> Column:
    return F.col("path")[i].getField("r")


# ============================================================================================
# W1-W3 segmentation
# ============================================================================================
@query("scope_segments", """
SELECT event_id, user_id, seg_start FROM (
  SELECT event_id, user_id,
         MAX(CASE WHEN event_type = 'signup' THEN event_id END)
           OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg_start
  FROM events) t
WHERE seg_start IS NOT NULL
""")
def scope_segments(spark, sf):
    """Each user's event stream is a sheet; ``signup`` rows open segments."""
    ev = _t(spark, sf, "events").select("event_id", "user_id", "event_type")
    out = forward_fill(ev, F.col("event_type") == "signup", ["user_id"], "event_id", "seg_start")
    return out.where(F.col("seg_start").isNotNull()).select("event_id", "user_id", "seg_start")


@query("scope_prefix_scan", """
SELECT o_orderkey, hdr AS hdr_orderkey FROM (
  SELECT o_orderkey,
         MAX(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END)
           OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hdr
  FROM orders) t
WHERE hdr IS NOT NULL
""")
def scope_prefix_scan(spark, sf):
    """W1 over one giant context (the whole orders table as one sheet): blocked prefix scan."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    out = forward_fill(o, F.col("o_orderstatus") == "P", [], "o_orderkey", "hdr", block_rows=1 << 12)
    return out.where(F.col("hdr").isNotNull()).select("o_orderkey", F.col("hdr").alias("hdr_orderkey"))


def _orders_scope_sheet(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return as_sheet(o, "orders", "orders", "o_orderkey", {
        "Priority": "o_orderpriority", "Status": "o_orderstatus", "Key": F.col("o_orderkey").cast("string")})


@query("scope_nested", """
WITH a AS (SELECT o_orderkey AS r, o_orderstatus,
                  MAX(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END)
                    OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS top_row FROM orders),
b AS (SELECT *, MAX(CASE WHEN o_orderstatus = 'F' THEN r END)
                  OVER (PARTITION BY top_row ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mid_row
      FROM a WHERE top_row IS NOT NULL)
SELECT top_row, mid_row, r AS row_idx FROM b WHERE mid_row IS NOT NULL
""")
def scope_nested(spark, sf):
    """Urgent orders scope the rows after them; inside, 'F' orders scope the rest."""
    spec = {"items": [{
        "templateKey": "urgent", "filter": "Priority.value = '1-URGENT'", "scope_children": True,
        "name": {"field": "Key"},
        "children": [{
            "templateKey": "final", "filter": "Status.value = 'F'", "scope_children": True,
            "name": {"field": "Key"},
            "children": [{"templateKey": "order", "filter": ".", "name": {"field": "Key"}}],
        }],
    }]}
    res = run_sheet(_orders_scope_sheet(spark, sf), spec, block_rows=1 << 12)
    leaf = res.items.where(F.col("depth") == 3)
    return leaf.select(_path_r(0).alias("top_row"), _path_r(1).alias("mid_row"), _path_r(2).alias("row_idx"))


# ============================================================================================
# G1-G4 generators
# ============================================================================================
def _part_sheet(spark, sf, annotations: bool = False) -> DataFrame:
    p = _t(spark, sf, "part")
    if annotations:
        name_ann = F.when(F.col("p_size") < 5, F.col("p_brand"))
        brand_ann = F.when(F.col("p_size") > 40, F.col("p_type"))
    else:
        name_ann = brand_ann = F.lit(None)
    return as_sheet(p, "part", "parts", "p_partkey", {
        "p_name": (F.col("p_name"), name_ann), "p_brand": (F.col("p_brand"), brand_ann),
        "p_type": "p_type", "p_size": F.col("p_size").cast("string"),
    })


VARIANT_FILTER = ("__cell__.value LIKE 'Brand#1%' OR __cell__.value IN ('SMALL', 'LARGE') "
                  "OR __cell__.value IN ('1', '2', '3')")


@query("expand_variants", """
SELECT p_partkey, CAST(variant_pos AS BIGINT) AS variant_pos, variant_col, variant_value, p_name AS base_value FROM (
  SELECT p_partkey, p_name, 0 AS variant_pos, 'p_brand' AS variant_col, p_brand AS variant_value FROM part
  UNION ALL SELECT p_partkey, p_name, 1, 'p_type', p_type FROM part
  UNION ALL SELECT p_partkey, p_name, 2, 'p_size', CAST(p_size AS VARCHAR) FROM part) v
WHERE variant_value LIKE 'Brand#1%' OR variant_value IN ('SMALL', 'LARGE') OR variant_value IN ('1', '2', '3')
""")
def expand_variants(spark, sf):
    """G1 + F5: one variant row per ``column_data`` header, filtered on the variant cell."""
    spec = {
        "source_structure": {"column_base": "p_name", "column_data": ["p_brand", "p_type", "p_size", "p_color"]},
        "items": [{"templateKey": "part", "filter": ".", "name": {"field": "p_name"},
                   "children": [{"templateKey": "variant", "expand_variants": True, "filter": VARIANT_FILTER,
                                 "fields": [{"name": "V", "value": "$variant"}, {"name": "B", "value": "$base"}]}]}],
    }
    flat, _ = run_flat(_part_sheet(spark, sf), spec, ["V", "B"])
    return flat.where(F.col("depth") == 2).select(
        _path_r(0).alias("p_partkey"), _path_r(1).alias("variant_pos"), F.col("name").alias("variant_col"),
        F.col("V").alias("variant_value"), F.col("B").alias("base_value"))


@query("explode_multi", """
SELECT page_id, CAST(i AS BIGINT) AS part_idx,
       regexp_replace(regexp_replace(string_split(url, '/')[i], '^ ', ''), ' $', '') AS part
FROM pages, LATERAL generate_series(1, len(string_split(url, '/'))) g(i)
""")
def explode_multi(spark, sf):
    """Split a cell on a literal delimiter, one item per part (empty parts kept, T11)."""
    pages = _t(spark, sf, "pages").select("page_id", "url")
    sheet = as_sheet(pages, "pages", "urls", "page_id", {"url": "url"})
    spec = {"items": [{"templateKey": "part", "explode": {"column": "url", "sep": "/", "as": "Part"},
                       "filter": ".", "fields": [{"name": "P", "value": "Part"}]}]}
    flat, _ = run_flat(sheet, spec, ["P"])
    return flat.select(_path_r(0).alias("page_id"), F.col("path")[0].getField("s").alias("part_idx"),
                       F.col("P").alias("part"))


@query("group_scope", """
SELECT o_custkey, o_orderpriority AS gkey, MIN(o_orderkey) AS rep_orderkey,
       arg_min(o_orderstatus, o_orderkey) AS rep_status, COUNT(*) AS n_rows
FROM orders WHERE o_orderpriority <> '' GROUP BY o_custkey, o_orderpriority
""")
def group_scope(spark, sf):
    """Rows grouped by a column per context (customer); representative = first row."""
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus").withColumns(
        {"__ord": F.col("o_orderkey"), "__sub": F.lit(0).cast("bigint")})
    reps = gen.group_representatives(o, ["o_custkey"], F.col("o_orderpriority"), drop_empty=True, count_as="n_rows")
    return reps.select("o_custkey", "__gkey", "o_orderkey", "o_orderstatus", "n_rows").toDF(
        "o_custkey", "gkey", "rep_orderkey", "rep_status", "n_rows")


def _eav_sheet(spark, sf) -> DataFrame:
    s = _t(spark, sf, "supplier")
    n = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    sn = s.join(n, s.s_nationkey == n.n_nationkey, "left")
    attrs = F.array(
        F.struct(F.lit(0).alias("i"), F.lit("Name").alias("a"), F.col("s_name").alias("v")),
        F.struct(F.lit(1).alias("i"), F.lit("Nation").alias("a"), F.col("n_name").alias("v")),
        F.struct(F.lit(2).alias("i"), F.lit("Balance").alias("a"), F.col("s_acctbal").cast("string").alias("v")),
        F.struct(F.lit(3).alias("i"), F.lit("Negative").alias("a"), F.when(F.col("s_acctbal") < 0, F.lit("yes")).otherwise(F.lit("")).alias("v")),
        F.struct(F.lit(4).alias("i"), F.lit("").alias("a"), F.lit("ignored").alias("v")),
        F.struct(F.lit(5).alias("i"), F.lit("Verified").alias("a"), F.when(F.col("s_suppkey") % 3 == 0, F.lit("TRUE")).otherwise(F.lit("no")).alias("v")),
    )
    eav = sn.select("s_suppkey", F.explode(attrs).alias("x"))
    return as_sheet(eav, "suppliers", "eav", F.col("s_suppkey") * 8 + F.col("x.i"), {
        "Component": F.col("s_suppkey").cast("string"), "Attribute Name": F.col("x.a"), "Value": F.col("x.v")})


EAV_SQL = """
WITH sn AS (SELECT s.s_suppkey, s.s_acctbal, s.s_name, n.n_name FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
eav AS (
  SELECT s_suppkey, 0 AS i, 'Name' AS a, s_name AS v FROM sn
  UNION ALL SELECT s_suppkey, 1, 'Nation', n_name FROM sn
  UNION ALL SELECT s_suppkey, 2, 'Balance', CAST(s_acctbal AS VARCHAR) FROM sn
  UNION ALL SELECT s_suppkey, 3, 'Negative', CASE WHEN s_acctbal < 0 THEN 'yes' ELSE '' END FROM sn
  UNION ALL SELECT s_suppkey, 4, '', 'ignored' FROM sn
  UNION ALL SELECT s_suppkey, 5, 'Verified', CASE WHEN s_suppkey % 3 = 0 THEN 'TRUE' ELSE 'no' END FROM sn)
"""


def _eav_spec(required: bool) -> dict:
    dyn = {"source": "__scope__", "filter": "NOT (`Attribute Name`.value <=> '')",
           "name_from": "Attribute Name", "value_from": "Value", "type": "getType"}
    if required:
        dyn.update({"required": True, "required_fields": ["Name", "Rating"]})
    return {"items": [{"templateKey": "supplier", "group_by": {"column": "Component", "drop_empty": True},
                       "filter": ".", "name": {"field": "Component"}, "dynamic_fields": dyn}]}


@query("dynamic_fields", EAV_SQL + f"""
SELECT s_suppkey, CAST(i AS BIGINT) AS attr_idx, a AS name, {S_STRIP('coalesce(v, \'\')')} AS value,
       {S_GETTYPE(S_STRIP("coalesce(v, '')"))} AS type
FROM eav WHERE a <> ''
""")
def dynamic_fields(spark, sf):
    """G3 + G4: suppliers as entity-attribute-value rows -> one item per entity, one field per
    attribute row (empty names skipped, ``getType`` inferred)."""
    res = run_sheet(_eav_sheet(spark, sf), _eav_spec(False))
    f = res.fields.join(res.items.select(*ITEM_KEY, F.col("name").alias("item_name")), ITEM_KEY)
    return f.select(F.col("item_name").cast("bigint").alias("s_suppkey"), (F.col("fkey.r") % 8).alias("attr_idx"),
                    "name", F.col("text").alias("value"), "type")


@query("dynamic_required", EAV_SQL + """
SELECT s_suppkey, a AS field, 'required_dynamic_value' AS reason FROM eav WHERE a <> '' AND coalesce(v, '') = ''
UNION ALL
SELECT DISTINCT s_suppkey, 'Rating', 'required_field_missing' FROM eav
""")
def dynamic_required(spark, sf):
    """V2 + V3: empty dynamic values and required field names missing per item."""
    res = run_sheet(_eav_sheet(spark, sf), _eav_spec(True))
    v = res.violations.join(res.items.select(*ITEM_KEY, "name"), ITEM_KEY)
    return v.select(F.col("name").cast("bigint").alias("s_suppkey"), "field", "reason")


CORPUS_SQL = """
WITH attr AS (
  SELECT c_mktsegment AS wb, c_nationkey AS comp, c_custkey AS r,
         CASE c_custkey % 3 WHEN 0 THEN 'Code' WHEN 1 THEN 'Level' ELSE 'Note' END AS a,
         CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'v' || CAST(c_custkey AS VARCHAR) END AS v
  FROM customer),
item AS (SELECT DISTINCT wb, comp FROM attr),
want AS (SELECT 'Code' AS f UNION ALL SELECT 'Level' UNION ALL SELECT 'Static'),
last AS (SELECT wb, comp, a, arg_max(v, r) AS v FROM attr GROUP BY wb, comp, a)
"""


@query("dynamic_required_corpus", CORPUS_SQL + """
SELECT item.wb AS workbook_id, CAST(item.comp AS BIGINT) AS component, want.f AS field
FROM item CROSS JOIN want LEFT JOIN last ON last.wb = item.wb AND last.comp = item.comp AND last.a = want.f
WHERE coalesce(last.v, '') = ''
""")
def dynamic_required_corpus(spark, sf):
    """V3 over several workbooks whose sheets share row numbers: each item is checked on its own
    generated fields; a static field of a required name does not count."""
    c = _t(spark, sf, "customer").select("c_mktsegment", "c_nationkey", "c_custkey")
    attr = F.when(F.col("c_custkey") % 3 == 0, "Code").when(F.col("c_custkey") % 3 == 1, "Level").otherwise("Note")
    val = F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.concat(F.lit("v"), F.col("c_custkey").cast("string")))
    sheet = as_sheet(c, F.col("c_mktsegment"), "attrs", "c_custkey", {
        "Component": F.col("c_nationkey").cast("string"), "Attribute": attr, "Value": val})
    spec = {"items": [{
        "templateKey": "nation", "group_by": {"column": "Component"}, "filter": ".", "name": {"field": "Component"},
        "fields": [{"name": "Static", "value": "Component"}],
        "dynamic_fields": {"source": "__scope__", "name_from": "Attribute", "value_from": "Value",
                           "required_fields": ["Code", "Level", "Static"]}}]}
    res = run_sheet(sheet, spec)
    v = res.violations.join(res.items.select(*ITEM_KEY, "name"), ITEM_KEY)
    return v.select("workbook_id", F.col("name").cast("bigint").alias("component"), "field")


# ============================================================================================
# C1-C9 cleaning
# ============================================================================================
@query("collapse_groups", """
WITH c AS (
  SELECT o_custkey g, o_orderkey r, 'status' h, o_orderstatus v,
         CASE WHEN o_totalprice > 400000 THEN 'big ' || CAST(o_orderkey AS VARCHAR) END a FROM orders
  UNION ALL SELECT o_custkey, o_orderkey, 'priority', o_orderpriority, NULL FROM orders),
d AS (SELECT g, h, v, MIN(r) r FROM c WHERE v <> '' AND v <> 'nan' GROUP BY g, h, v),
j AS (SELECT g, h, string_agg(v, ', ' ORDER BY r) s FROM d GROUP BY g, h),
an AS (SELECT g, h, arg_min(a, r) FILTER (WHERE a IS NOT NULL AND a <> '') ann, MIN(r) first_row FROM c GROUP BY g, h)
SELECT an.g AS o_custkey, MIN(an.first_row) AS first_row,
       MAX(CASE WHEN an.h = 'status' THEN coalesce(j.s, '') END) AS statuses,
       MAX(CASE WHEN an.h = 'priority' THEN coalesce(j.s, '') END) AS priorities,
       MAX(CASE WHEN an.h = 'status' THEN an.ann END) AS status_annotation
FROM an LEFT JOIN j ON an.g = j.g AND an.h = j.h GROUP BY an.g
""")
def collapse_groups(spark, sf):
    """C8 + C9: one row per merge group (customer) - distinct values in first-seen order."""
    o = _t(spark, sf, "orders")
    ann = F.when(F.col("o_totalprice") > 400000, F.concat(F.lit("big "), F.col("o_orderkey").cast("string")))
    cells = o.select(F.lit("orders").alias("workbook_id"), F.lit("orders").alias("sheet"),
                     F.col("o_custkey").alias("group_id"), F.col("o_orderkey").alias("row_idx"),
                     F.explode(F.array(
                         F.struct(F.lit("status").alias("header"), F.col("o_orderstatus").alias("value"), ann.alias("annotation")),
                         F.struct(F.lit("priority").alias("header"), F.col("o_orderpriority").alias("value"), F.lit(None).cast("string").alias("annotation")),
                     )).alias("c")).select("workbook_id", "sheet", "group_id", "row_idx", "c.*")
    col = clean.collapse_groups(cells)
    return col.groupBy(F.col("group_id").alias("o_custkey")).agg(
        F.min("row_idx").alias("first_row"),
        F.max(F.when(F.col("header") == "status", F.col("value"))).alias("statuses"),
        F.max(F.when(F.col("header") == "priority", F.col("value"))).alias("priorities"),
        F.max(F.when(F.col("header") == "status", F.col("annotation"))).alias("status_annotation"))


def _order_merges(o: DataFrame) -> DataFrame:
    """Merged ranges derived from urgent orders: a vertical range over the next few rows."""
    u = o.where(F.col("o_orderpriority") == "1-URGENT")
    return u.select(F.lit("orders").alias("workbook_id"), F.lit("orders").alias("sheet"),
                    (F.col("o_orderkey") + 2).alias("min_row"), (F.col("o_orderkey") + 2 + F.col("o_custkey") % 4).alias("max_row"),
                    (F.col("o_orderkey") % 2 + 1).cast("int").alias("min_col"), (F.col("o_orderkey") % 2 + 1).cast("int").alias("max_col"))


@query("merge_islands", """
WITH r AS (SELECT o_orderkey AS min_row, o_orderkey + o_custkey % 4 AS max_row FROM orders
           WHERE o_orderpriority = '1-URGENT' AND o_custkey % 4 > 0),
m AS (SELECT min_row, MAX(max_row) max_row, COUNT(*) n FROM r GROUP BY min_row),
p AS (SELECT *, MAX(max_row) OVER (ORDER BY min_row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) prev FROM m),
s AS (SELECT *, SUM(CASE WHEN prev IS NULL OR min_row > prev THEN 1 ELSE 0 END) OVER (ORDER BY min_row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) grp FROM p)
SELECT MIN(min_row) AS island_start, MAX(max_row) AS island_end, CAST(SUM(n) AS BIGINT) AS n_ranges FROM s GROUP BY grp
""")
def merge_islands(spark, sf):
    """Connected multi-row merged ranges -> row groups (gaps and islands, blocked scans)."""
    m = _order_merges(_t(spark, sf, "orders")).select(
        "workbook_id", "sheet", (F.col("min_row") - 2).alias("min_row"), (F.col("max_row") - 2).alias("max_row"))
    isl = clean.merge_islands(m, block_rows=1 << 12)
    return isl.select("island_start", "island_end", F.col("n_ranges").cast("bigint").alias("n_ranges"))


@query("merged_fill", """
WITH r AS (SELECT o_orderkey AS min_row, o_orderkey + o_custkey % 4 AS max_row, 1 + o_orderkey % 2 AS col,
                  CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE o_orderpriority END AS v
           FROM orders WHERE o_orderpriority = '1-URGENT'),
c AS (SELECT r.min_row, r.col, r.v, g.row_idx FROM r, LATERAL (SELECT unnest(generate_series(r.min_row, r.max_row)) AS row_idx) g),
w AS (SELECT row_idx, col, arg_max(v, min_row) AS v FROM c GROUP BY row_idx, col)
SELECT w.row_idx, CAST(w.col AS INTEGER) AS col_idx, w.v AS value FROM w JOIN orders o ON o.o_orderkey = w.row_idx
""")
def merged_fill(spark, sf):
    """Every cell a merged range covers takes the range's top-left value."""
    o = _t(spark, sf, "orders")
    grid = o.select(F.lit("orders").alias("workbook_id"), F.lit("orders").alias("sheet"),
                    (F.col("o_orderkey") + 2).alias("row"),
                    F.explode(F.array(F.struct(F.lit(1).alias("col"), F.col("o_orderstatus").alias("value")),
                                      F.struct(F.lit(2).alias("col"), F.col("o_orderpriority").alias("value")))).alias("c")).select(
        "workbook_id", "sheet", "row", "c.col", "c.value", F.lit(None).cast("string").alias("annotation"))
    filled = clean.fill_merged(grid, _order_merges(o))
    return filled.where("is_merged").select((F.col("row") - 2).alias("row_idx"), F.col("col").cast("int").alias("col_idx"), "value")


def _raw_headers(p: DataFrame) -> Column:
    k = F.col("p_size") % 6
    return (F.when(k == 0, F.concat(F.col("p_brand"), F.lit(" (Key)")))
            .when(k == 1, F.concat(F.col("p_name"), F.lit(" ("), F.col("p_type"), F.lit(") (drop)")))
            .when(k == 2, F.concat(F.lit("[map] "), F.col("p_brand"), F.lit(" (hint)")))
            .when(k == 3, F.concat(F.lit("  "), F.col("p_name"), F.lit(" (Key) (note)  ")))
            .when(k == 4, F.concat(F.lit("Unnamed: "), F.col("p_partkey").cast("string")))
            .otherwise(F.concat(F.col("p_type"), F.lit(" (x (y)"))))


S_RAW_HEADER = """CASE p_size % 6
  WHEN 0 THEN p_brand || ' (Key)'
  WHEN 1 THEN p_name || ' (' || p_type || ') (drop)'
  WHEN 2 THEN '[map] ' || p_brand || ' (hint)'
  WHEN 3 THEN '  ' || p_name || ' (Key) (note)  '
  WHEN 4 THEN 'Unnamed: ' || CAST(p_partkey AS VARCHAR)
  ELSE p_type || ' (x (y)' END"""


def S_NORMALIZE(h: str) -> str:
    s = S_STRIP(h)
    parens = f"([{WS}]*\\([^)]*\\)[{WS}]*)+$"
    strip_p = lambda x: S_STRIP(f"regexp_replace({x}, '{parens}', '', 'g')")
    br = f"strpos({s}, ']')"
    prefix = f"substr({s}, 1, {br})"
    slug = strip_p(S_STRIP(f"substr({s}, {br} + 1)"))
    return (f"CASE WHEN {h} IS NULL THEN NULL WHEN {s} = '' OR starts_with({s}, 'Unnamed') THEN {s} "
            f"WHEN starts_with(upper({s}), '[MAP]') THEN CASE WHEN {slug} = '' THEN {prefix} ELSE {S_STRIP(prefix + ' || \' \' || ' + slug)} END "
            f"WHEN regexp_matches({s}, '\\(Key\\)[{WS}]*$') THEN {s} ELSE {strip_p(s)} END")


@query("header_normalize", f"""
SELECT p_partkey, raw_header, {S_NORMALIZE('raw_header')} AS clean_header FROM (SELECT p_partkey, {S_RAW_HEADER} AS raw_header FROM part) t
""")
def header_normalize(spark, sf):
    """Header normalization on headers derived from part rows."""
    p = _t(spark, sf, "part")
    h = p.select("p_partkey", _raw_headers(p).alias("raw_header"))
    return h.select("p_partkey", "raw_header", clean.normalize_header(F.col("raw_header")).alias("clean_header"))


@query("header_collisions", f"""
SELECT sheet, header, COUNT(*) AS n_cols, MAX(col_idx) AS winner_col FROM (
  SELECT p_brand AS sheet, p_partkey AS col_idx, {S_NORMALIZE('raw_header')} AS header
  FROM (SELECT p_partkey, p_brand, {S_RAW_HEADER} AS raw_header FROM part) t) h
WHERE header IS NOT NULL AND header <> '' AND NOT starts_with(header, 'Unnamed')
GROUP BY sheet, header HAVING COUNT(*) > 1
""")
def header_collisions(spark, sf):
    """Each brand is a sheet whose header row holds its parts; report clean headers that
    several columns share and the column that wins (rightmost)."""
    p = _t(spark, sf, "part")
    h = p.select(F.lit("part").alias("workbook_id"), F.col("p_brand").alias("sheet"), F.col("p_partkey").alias("col_idx"),
                 F.explode(clean.clean_headers(_raw_headers(p))).alias("header"))
    return clean.header_collisions(h).select("sheet", "header", "n_cols", "winner_col")


@query("cell_clean", f"""
SELECT doc_id, CAST(length(c) AS BIGINT) AS n_clean, md5(c) AS md5_clean FROM (
  SELECT doc_id, coalesce({S_STRIP('text')}, '') AS c FROM documents) t
""")
def cell_clean(spark, sf):
    """Python-exact strip of whole document texts (Unicode whitespace incl. FS..US)."""
    d = _t(spark, sf, "documents").select("doc_id", tx.clean_value(F.col("text")).alias("c"))
    return d.select("doc_id", F.length("c").cast("bigint").alias("n_clean"), F.md5("c").alias("md5_clean"))


def _comment(c: DataFrame) -> Column:
    nl = F.lit("\n")
    k = F.col("turn") % 3
    return (F.when(k == 0, F.concat(F.col("role"), F.lit(":"), nl, F.col("text")))
            .when(k == 1, F.concat(F.lit("======"), nl, F.lit("ID#"), F.col("conv_id").cast("string"), nl,
                                   F.col("role"), F.lit("  (2024-01-0"), (F.col("turn") % 9 + 1).cast("string"),
                                   F.lit(" 10:00)"), nl, F.col("text")))
            .otherwise(F.col("text")))


def S_PARSE_COMMENT() -> str:
    t = f"coalesce({S_STRIP('cm')}, '')"
    stamp = f"^.+[{WS}]{{2,}}\\([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}"
    threaded = (f"array_to_string(list_filter(string_split({t}, chr(10)), lambda l: NOT (starts_with(l, '======') "
                f"OR starts_with(l, 'ID#') OR regexp_matches(l, '{stamp}'))), chr(10))")
    plain = f"CASE WHEN role <> '' AND starts_with({t}, role || ':' || chr(10)) THEN substr({t}, length(role) + 3) ELSE {t} END"
    return S_STRIP(f"CASE WHEN strpos({t}, '======') > 0 THEN {threaded} ELSE {plain} END")


@query("annotation_parse", f"""
SELECT conv_id, turn, CAST(length(p) AS BIGINT) AS n, md5(p) AS md5_body FROM (
  SELECT conv_id, turn, {S_PARSE_COMMENT()} AS p FROM (
    SELECT conv_id, turn, role,
      CASE turn % 3 WHEN 0 THEN role || ':' || chr(10) || text
                    WHEN 1 THEN '======' || chr(10) || 'ID#' || CAST(conv_id AS VARCHAR) || chr(10) || role || '  (2024-01-0'
                                || CAST(turn % 9 + 1 AS VARCHAR) || ' 10:00)' || chr(10) || text
                    ELSE text END AS cm
    FROM conversations) a) b
""")
def annotation_parse(spark, sf):
    """Comment bodies of conversation turns with spreadsheet comment metadata removed."""
    c = _t(spark, sf, "conversations")
    p = c.select("conv_id", "turn", tx.parse_annotation(_comment(c), F.col("role")).alias("p"))
    return p.select("conv_id", "turn", F.length("p").cast("bigint").alias("n"), F.md5("p").alias("md5_body"))


# ============================================================================================
# J1-J6 relations
# ============================================================================================
def _region_workbooks(spark, sf) -> DataFrame:
    """Cells of one workbook per region: Segments and Nations key sheets, a Customers sheet
    with ``[MAP]`` columns (own segment, every nation of the region, an unmatched slug)."""
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation")
    r = _t(spark, sf, "region")
    nr = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "n_regionkey", "r_name")
    cn = c.join(nr, c.c_nationkey == nr.n_nationkey).select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal", "n_nationkey", "n_regionkey", "r_name")
    wb = F.col("r_name")
    seg_val = (F.when(F.col("c_acctbal") > 5000, "YES").when(F.col("c_acctbal") > 2500, "N").otherwise("y"))
    own = cn.select(wb.alias("workbook_id"), F.lit("Customers").alias("sheet"), F.lit(2).alias("sheet_ord"),
                    F.col("c_custkey").alias("row_idx"), F.explode(F.array(
                        F.struct(F.lit(1).alias("col_idx"), F.lit("Customer").alias("header"), F.col("c_name").alias("value")),
                        F.struct(F.lit(2).alias("col_idx"), F.concat(F.lit("[MAP] "), F.col("c_mktsegment")).alias("header"),
                                 seg_val.alias("value")),
                        F.struct(F.lit(3).alias("col_idx"), F.lit("[MAP] Atlantis").alias("header"),
                                 F.when(F.col("c_acctbal") < 0, "y").otherwise("FALSE").alias("value")),
                    )).alias("x")).select("workbook_id", "sheet", "sheet_ord", "row_idx", "x.*")
    # one cell per (customer, nation of the customer's region): equi-join on region
    per_nation = cn.join(nr.select(F.col("n_nationkey").alias("nk"), F.col("n_name").alias("nn"),
                                   F.col("n_regionkey").alias("rk")), F.col("n_regionkey") == F.col("rk")).select(
        wb.alias("workbook_id"), F.lit("Customers").alias("sheet"), F.lit(2).alias("sheet_ord"),
        F.col("c_custkey").alias("row_idx"), (F.col("nk") + 10).cast("int").alias("col_idx"),
        F.concat(F.lit("[MAP] "), F.col("nn")).alias("header"),
        F.when(F.col("nk") == F.col("n_nationkey"), "x").otherwise("0").alias("value"))
    nations = nr.select(F.col("r_name").alias("workbook_id"), F.lit("Nations").alias("sheet"), F.lit(1).alias("sheet_ord"),
                        F.col("n_nationkey").cast("bigint").alias("row_idx"), F.lit(1).alias("col_idx"),
                        F.lit("Nation (Key)").alias("header"), F.col("n_name").alias("value"))
    segs = cn.groupBy("r_name", "c_mktsegment").agg(F.min("c_custkey").alias("row_idx")).select(
        F.col("r_name").alias("workbook_id"), F.lit("Segments").alias("sheet"), F.lit(0).alias("sheet_ord"),
        "row_idx", F.lit(1).alias("col_idx"), F.lit("Segment (Key)").alias("header"), F.col("c_mktsegment").alias("value"))
    cells = own.unionByName(per_nation).unionByName(nations).unionByName(segs)
    return cells.withColumn("annotation", F.lit(None).cast("string"))


REGION_SQL = """
WITH cn AS (SELECT c.c_custkey, c.c_mktsegment seg, c.c_acctbal bal, n.n_name, r.r_name
            FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
"""


@query("matrix_map", REGION_SQL + """
SELECT r_name AS workbook_id, 'Nations' AS target_sheet, n_name AS target_key, c_custkey AS source_row, 'X' AS map_value FROM cn
UNION ALL
SELECT r_name, 'Segments', seg, c_custkey, CASE WHEN bal > 5000 THEN 'YES' ELSE 'Y' END FROM cn WHERE NOT (bal > 2500 AND bal <= 5000)
""")
def matrix_map(spark, sf):
    """Key index, matrix edges, equi-join of slug to key within each workbook."""
    cells = _region_workbooks(spark, sf)
    rel, _ = relate.match_edges(relate.map_edges(cells), relate.key_index(cells))
    return rel.select("workbook_id", "target_sheet", "target_key", "source_row", "map_value")


@query("matrix_unmatched", REGION_SQL + """
SELECT r_name AS workbook_id, 'Atlantis' AS slug, COUNT(*) AS n_edges FROM cn WHERE bal < 0 GROUP BY r_name
""")
def matrix_unmatched(spark, sf):
    """V6: edges whose slug matches no key, counted per workbook and slug."""
    cells = _region_workbooks(spark, sf)
    _, un = relate.match_edges(relate.map_edges(cells), relate.key_index(cells))
    return un.groupBy("workbook_id", "slug").agg(F.count("*").alias("n_edges"))


@query("cross_sheet_lookup", """
SELECT s.s_suppkey, n.n_name AS nation, r.r_name AS region
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def cross_sheet_lookup(spark, sf):
    """First-match lookups supplier -> nation -> region."""
    s = _t(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    n = _t(spark, sf, "nation")
    r = _t(spark, sf, "region")
    x = relate.lookup(s, n, "s_nationkey", "n_nationkey", {"nation": "n_name", "nrk": "n_regionkey"}, order_col="n_nationkey")
    x = relate.lookup(x, r, "nrk", "r_regionkey", {"region": "r_name"}, order_col="r_regionkey")
    return x.select("s_suppkey", "nation", "region")


# ============================================================================================
# F1-F6 filters
# ============================================================================================
@query("row_filter_nullsafe", """
SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS DISTINCT FROM 1
""")
def row_filter_nullsafe(spark, sf):
    """two-valued comparison - a missing label passes ``quality != 1``."""
    d = _t(spark, sf, "documents").select("doc_id", "lang")
    lab = _t(spark, sf, "labels").select("doc_id", "quality")
    sheet = as_sheet(d.join(lab, "doc_id", "left"), F.lit("wb"), "docs", "doc_id",
                     {"lang": "lang", "quality": F.col("quality").cast("string")})
    spec = {"items": [{"templateKey": "doc", "filter": "NOT (quality.value <=> '1')", "name": {"field": "lang"}}]}
    return run_sheet(sheet, spec).items.select(F.col("row_idx").alias("doc_id"), F.col("name").alias("lang"))


@query("head_guard", """
SELECT source, doc_id FROM (SELECT source, MIN(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM documents GROUP BY source) t
WHERE lang = 'en'
""")
def head_guard(spark, sf):
    """the first row of each context (documents per source), only if it passes P."""
    d = _t(spark, sf, "documents").select("doc_id", "source", "lang")
    sheet = as_sheet(d, F.col("source"), "docs", "doc_id", {"doc": F.col("doc_id").cast("string"), "lang": "lang"})
    spec = {"items": [{"templateKey": "head", "head_only": True, "filter": "lang.value = 'en'", "name": {"field": "doc"}}]}
    res = run_sheet(sheet, spec)
    return res.items.select(F.col("workbook_id").alias("source"), F.col("row_idx").alias("doc_id"))


@query("head_guard_generated", """
SELECT o_orderpriority AS workbook_id, arg_min(o_orderstatus, (o_orderstatus, o_orderkey)) AS first_group
FROM orders GROUP BY o_orderpriority
""")
def head_guard_generated(spark, sf):
    """F3 after ``group_by``: the head is the first group by key, not that of the first row."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    sheet = as_sheet(o, F.col("o_orderpriority"), "orders", "o_orderkey", {"status": "o_orderstatus"})
    spec = {"items": [{"templateKey": "g", "group_by": {"column": "status"}, "head_only": True, "filter": ".",
                       "name": {"field": "status"}}]}
    return run_sheet(sheet, spec).items.select("workbook_id", F.col("name").alias("first_group"))


@query("filter_missing_column", """
SELECT n_nationkey AS row_idx, n_name AS name FROM nation
""")
def filter_missing_column(spark, sf):
    """F1 on a column that no sheet has: its cell is empty, so ``!= ''`` is true for each row."""
    n = _t(spark, sf, "nation")
    cells = sheet_to_cells(as_sheet(n, F.lit("wb"), F.lit("nations"), "n_nationkey", {"Name": "n_name"}), ["Name"])
    spec = {"sheets": {"nations": {"items": [{"templateKey": "n", "filter": "NOT (Nope.value <=> '')", "name": {"field": "Name"}}]}}}
    return run_transform(cells, spec).items.select("row_idx", "name")


@query("computed_tolerant", """
SELECT doc_id AS row_idx, CASE WHEN coalesce(TRY_CAST(mixed AS DOUBLE) > 100, FALSE) THEN 'big' ELSE 'other' END AS size_class
FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE CAST(n_chars AS VARCHAR) END AS mixed FROM documents) t
""")
def computed_tolerant(spark, sf):
    """A condition that fails on one row is false for that row; the others are decided."""
    d = _t(spark, sf, "documents").select("doc_id", "source", "n_chars")
    mixed = F.when(F.col("doc_id") % 3 == 0, F.col("source")).otherwise(F.col("n_chars").cast("string"))
    sheet = as_sheet(d, F.lit("wb"), "docs", "doc_id", {"Mixed": mixed, "Big": F.lit("big"), "Other": F.lit("other")})
    spec = {"items": [{"templateKey": "d", "filter": ".", "name": "d", "fields": [
        {"name": "Size", "computed": True, "condition": "CAST(Mixed.value AS DOUBLE) > 100", "value": "Big", "else_value": "Other"}]}]}
    return run_flat(sheet, spec, ["Size"])[0].select("row_idx", F.col("Size").alias("size_class"))


@query("condition_errors", """
WITH t AS (SELECT o_orderkey AS row_idx, CASE o_orderkey % 5 WHEN 0 THEN '5x' WHEN 1 THEN '0' WHEN 2 THEN CAST(o_orderkey AS VARCHAR)
                    WHEN 3 THEN '1996-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS x FROM orders)
SELECT row_idx, CASE WHEN coalesce(TRY_CAST(x AS INTEGER) > 500, FALSE) THEN 'y' ELSE 'n' END AS by_function,
       CASE WHEN coalesce(TRY_CAST(x AS INTEGER) > 500, FALSE) THEN 'y' ELSE 'n' END AS by_cast,
       CASE WHEN coalesce(TRY_CAST(x AS BIGINT) > 500, FALSE) THEN 'y' ELSE 'n' END AS by_number,
       CASE WHEN coalesce(10 / nullif(TRY_CAST(x AS DOUBLE), 0) < 0.01, FALSE) THEN 'y' ELSE 'n' END AS by_division,
       CASE WHEN coalesce(CASE WHEN regexp_full_match(x, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(x AS DATE) END > DATE '1995-01-01', FALSE) THEN 'y' ELSE 'n' END AS by_date,
       CASE WHEN coalesce(TRY_CAST(x AS BIGINT) * 1000000 BETWEEN 1 AND 2147483647, FALSE) THEN 'y' ELSE 'n' END AS by_overflow
FROM t WHERE row_idx % 5 = 4 OR coalesce(TRY_CAST(x AS BIGINT) >= 0, FALSE)
""")
def condition_errors(spark, sf):
    """Whatever fails in a condition (casts, comparisons with numbers, divisions, dates,
    overflows) makes its own row false; a filter drops that row alone."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey") % 5
    x = (F.when(k == 0, "5x").when(k == 1, "0").when(k == 2, F.col("o_orderkey").cast("string")).when(k == 3, "1996-02-30")
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    sheet = as_sheet(o, "wb", "orders", "o_orderkey", {"X": x, "K": k.cast("string"), "Y": F.lit("y"), "N": F.lit("n")})
    tests = {
        "by_function": "int(X.value) > 500", "by_cast": "X.value::int > 500", "by_number": "X.value > 500",
        "by_division": "10 / X.value < 0.01", "by_date": "to_date(X.value, 'yyyy-MM-dd') > DATE'1995-01-01'",
        "by_overflow": "int(X.value) * 1000000 > 0",
    }
    spec = {"items": [{"templateKey": "o", "filter": "CASE WHEN K.value = '4' THEN true ELSE X.value >= 0 END", "name": "o", "fields": [
        {"name": n, "computed": True, "condition": c, "value": "Y", "else_value": "N"} for n, c in tests.items()]}]}
    return run_flat(sheet, spec, list(tests))[0].select("row_idx", *tests)


@query("header_case_names", """
SELECT doc_id AS row_idx, lang AS upper_item, coalesce(source, '') AS lower_item, 's' || doc_id AS of_sheet, CAST(coalesce(n_chars, 0) AS VARCHAR) AS of_row,
       'w' || doc_id AS of_book, 'x' || doc_id AS of_hidden, 'p' || doc_id AS of_price, CASE WHEN coalesce(source, '') < 'src5' THEN 'low' ELSE 'high' END AS half
FROM documents WHERE lang IN ('en', 'de')
""")
def header_case_names(spark, sf):
    """Headers that differ in case only, equal a key column's name or look like internal names
    are all read, in fields, filters and conditions."""
    d = _t(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    tag = lambda t: F.concat(F.lit(t), F.col("doc_id").cast("string"))
    cells = {"Item": F.col("lang"), "item": F.col("source"), "sheet": tag("s"), "row_idx": F.coalesce("n_chars", F.lit(0)), "workbook_id": tag("w"),
             "__x": tag("x"), "$price": tag("p"), "Low": F.lit("low"), "High": F.lit("high")}
    long = sheet_to_cells(as_sheet(d, "wb", "docs", "doc_id", cells), list(cells))
    read = {"upper_item": "Item", "lower_item": "item", "of_sheet": "sheet", "of_row": "row_idx", "of_book": "workbook_id", "of_hidden": "__x", "of_price": "$price"}
    spec = {"sheets": {"docs": {"items": [{
        "templateKey": "d", "name": "d",
        "filter": "Item.value IN ('en', 'de') AND sheet.value LIKE 's%' AND `$price`.value <> '' AND __x.value <> workbook_id.value",
        "fields": [{"name": n, "value": h} for n, h in read.items()] + [
            {"name": "half", "computed": True, "condition": "item.value < 'src5'", "value": "Low", "else_value": "High"}]}]}}}
    return pivot_fields(run_transform(long, spec), [*read, "half"]).select("row_idx", *read, "half")


WORKBOOK_SQL = """
WITH e AS (SELECT * FROM events),
row_cells AS (
  SELECT user_id, event_id, 'type' AS header, event_type AS value FROM e WHERE event_id % 4 <> 0
  UNION ALL SELECT user_id, event_id, 'n', CASE WHEN event_id % 4 = 1 THEN 'second' ELSE CAST(event_id AS VARCHAR) END FROM e WHERE event_id % 4 <> 0)
"""


@query("workbook_json_cells", WORKBOOK_SQL + """
SELECT CAST(user_id AS VARCHAR) AS workbook_id, CAST(o.pos AS BIGINT) AS row_idx, header, value
FROM row_cells JOIN (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos FROM e) o USING (event_id)
""")
def workbook_json_cells(spark, sf):
    """A workbook document per user with blank rows (every fourth event), repeated keys (the
    last one counts), a sheet that is no list and an empty one; odd parts stay alone."""
    e = _t(spark, sf, "events").select("user_id", "event_id", "event_type")
    quote = lambda c: F.concat(F.lit('{"value":"'), c, F.lit('"}'))
    first = F.when(F.col("event_id") % 4 == 1, F.concat(F.lit('"n":'), quote(F.lit("first")), F.lit(","))).otherwise("")
    last = F.when(F.col("event_id") % 4 == 1, F.lit("second")).otherwise(F.col("event_id").cast("string"))
    row = F.when(F.col("event_id") % 4 == 0, F.lit("{}")).otherwise(
        F.concat(F.lit("{"), first, F.lit('"type":'), quote(F.col("event_type")), F.lit(',"n":'), quote(last), F.lit("}")))
    rows = e.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", row.alias("r")))).alias("rs"))
    text = F.concat(F.lit('{"workbook":{"odd":{"x":1},"log":['), F.array_join(F.transform("rs", lambda x: x["r"]), ","),
                    F.lit('],"none":[],"word":"oops"}}'))
    docs = rows.select(F.col("user_id").cast("string").alias("workbook_id"), text.alias("value"))
    return read_workbooks(docs).cells.select("workbook_id", "row_idx", "header", "value")


@query("workbook_json_rows", """
SELECT CAST(user_id AS VARCHAR) AS workbook_id, CAST(count(*) AS BIGINT) AS n_rows FROM events GROUP BY user_id
""")
def workbook_json_rows(spark, sf):
    """Rows without cells are rows."""
    e = _t(spark, sf, "events").select("user_id", "event_id")
    row = F.when(F.col("event_id") % 2 == 0, F.lit("{}")).otherwise(F.lit('{"a":{"value":"1"}}'))
    rows = e.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", row.alias("r")))).alias("rs"))
    text = F.concat(F.lit('{"workbook":{"log":['), F.array_join(F.transform("rs", lambda x: x["r"]), ","), F.lit("]}}"))
    docs = rows.select(F.col("user_id").cast("string").alias("workbook_id"), text.alias("value"))
    return read_workbooks(docs).rows.groupBy("workbook_id").agg(F.count(F.lit(1)).alias("n_rows"))


# ============================================================================================
# P1-P13 projection
# ============================================================================================
@query("tokens_base_variant", """
SELECT p_partkey, variant_col, v, va, p_name AS b, coalesce(CASE WHEN p_size < 5 THEN p_brand END, '') AS ba,
       variant_col AS col, '' AS ann FROM (
  SELECT p_partkey, p_name, p_size, p_brand, 'p_brand' AS variant_col, p_brand AS v,
         coalesce(CASE WHEN p_size > 40 THEN p_type END, '') AS va FROM part
  UNION ALL SELECT p_partkey, p_name, p_size, p_brand, 'p_type', p_type, '' FROM part) t
""")
def tokens_base_variant(spark, sf):
    """``$variant``, ``$variant_annotation``, ``$base``, ``$base_annotation``,
    ``__column__`` and ``$annotation:<col>`` (not visible in a variant row, T10)."""
    spec = {
        "source_structure": {"column_base": "p_name", "column_data": ["p_brand", "p_type"]},
        "items": [{"templateKey": "part", "filter": ".", "name": {"field": "p_name"},
                   "children": [{"templateKey": "variant", "expand_variants": True, "filter": ".", "fields": [
                       {"name": "v", "value": "$variant"}, {"name": "va", "value": "$variant_annotation"},
                       {"name": "b", "value": "$base"}, {"name": "ba", "value": "$base_annotation"},
                       {"name": "col", "value": "__column__"}, {"name": "ann", "value": "$annotation:p_brand"}]}]}],
    }
    names = ["v", "va", "b", "ba", "col", "ann"]
    flat, _ = run_flat(_part_sheet(spark, sf, annotations=True), spec, names)
    return flat.where(F.col("depth") == 2).select(_path_r(0).alias("p_partkey"), F.col("name").alias("variant_col"), *names)


def _doc_label_sheet(spark, sf) -> DataFrame:
    d = _t(spark, sf, "documents").select("doc_id")
    lab = _t(spark, sf, "labels").select("doc_id", "quality", "toxic")
    return as_sheet(d.join(lab, "doc_id", "left"), "docs", "labels", "doc_id",
                    {"Quality": F.col("quality").cast("string"), "Toxic": F.col("toxic").cast("string")})


@query("default_value", """
SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), 'unknown') AS quality, coalesce(CAST(l.toxic AS VARCHAR), 'False') AS toxic,
       CASE WHEN l.toxic IS NULL THEN 'boolean' ELSE 'number' END AS toxic_type
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def default_value(spark, sf):
    """Defaults replace blank values, literal defaults may be non-strings."""
    spec = {"items": [{"templateKey": "doc", "filter": ".", "fields": [
        {"name": "Quality", "value": "Quality", "default": "unknown"},
        {"name": "Toxic", "value": "Toxic", "default": False, "type": "getType"}]}]}
    flat, _ = run_flat(_doc_label_sheet(spark, sf), spec, ["Quality", "Toxic"], extra={"toxic_type": ("Toxic", "type")})
    return flat.select(F.col("row_idx").alias("doc_id"), F.col("Quality").alias("quality"),
                       F.col("Toxic").alias("toxic"), "toxic_type")


ORDER_COMPUTED = [
    {"name": "Flag", "computed": True, "condition": "o_orderstatus.value = 'F'", "value": True,
     "else_value": False, "type": "getType"},
    {"name": "Price", "computed": True, "condition": "o_orderpriority.value LIKE '1-%'", "value": "o_totalprice",
     "transform": "^([0-9]+)", "else_value": "o_orderpriority"},
    {"name": "Pending", "computed": True, "omit_if_false": True, "condition": "o_orderstatus.value = 'P'",
     "value": "o_orderstatus"},
]


def _orders_sheet(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return as_sheet(o, "orders", "orders", "o_orderkey", {
        "o_orderstatus": "o_orderstatus", "o_orderpriority": "o_orderpriority",
        "o_totalprice": F.col("o_totalprice").cast("string")})


@query("computed_field", f"""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END AS flag, 'boolean' AS flag_type,
       CASE WHEN o_orderpriority LIKE '1-%' THEN {S_STRIP("regexp_extract(CAST(o_totalprice AS VARCHAR), '^([0-9]+)', 1)")}
            ELSE o_orderpriority END AS price
FROM orders
""")
def computed_field(spark, sf):
    """The condition picks ``value`` (+transform) or ``else_value``; booleans stay booleans."""
    spec = {"items": [{"templateKey": "order", "filter": ".", "fields": ORDER_COMPUTED}]}
    flat, _ = run_flat(_orders_sheet(spark, sf), spec, ["Flag", "Price"], extra={"flag_type": ("Flag", "type")})
    return flat.select(F.col("row_idx").alias("o_orderkey"), F.col("Flag").alias("flag"), "flag_type",
                       F.col("Price").alias("price"))


@query("omit_if_false", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 3 ELSE 2 END AS n_fields FROM orders
""")
def omit_if_false(spark, sf):
    """A computed field whose condition is false is absent."""
    spec = {"items": [{"templateKey": "order", "filter": ".", "fields": ORDER_COMPUTED}]}
    res = run_sheet(_orders_sheet(spark, sf), spec)
    return res.items_static.select(F.col("row_idx").alias("o_orderkey"),
                                   F.size("static_fields").cast("int").alias("n_fields"))


EMAIL = "([a-z0-9._%+-]+)@[a-z0-9.-]+"


@query("regex_capture", f"""
SELECT doc_id, CAST(length(r) AS BIGINT) AS n, md5(r) AS md5_r FROM (
  SELECT doc_id, CASE WHEN regexp_matches(text, '{EMAIL}') THEN {S_STRIP(f"regexp_extract(text, '{EMAIL}', 1)")}
                      ELSE {S_STRIP('text')} END AS r FROM documents) t
""")
def regex_capture(spark, sf):
    """First capture group of the first match, else the whole (stripped) text."""
    d = _t(spark, sf, "documents").select("doc_id", tx.regex_capture(F.col("text"), EMAIL).alias("r"))
    return d.select("doc_id", F.length("r").cast("bigint").alias("n"), F.md5("r").alias("md5_r"))


@query("expr_transform", f"""
SELECT page_id,
  CASE WHEN len(string_split(url, '/')) >= 3 THEN {S_STRIP("lower(string_split(url, '/')[3])")} ELSE '#ERR:ValueError' END AS host,
  CASE WHEN len(string_split(url, '?')) >= 2 THEN {S_STRIP("upper(string_split(url, '?')[2])")} ELSE '#ERR:ValueError' END AS query,
  CASE WHEN len(string_split(url, '?')) >= 2 THEN 0 ELSE 1 END AS is_err
FROM pages
""")
def expr_transform(spark, sf):
    """P5 + V5: step programs ``split | .[n] | ascii_*``; a step on NULL gives the error sentinel."""
    pages = _t(spark, sf, "pages").select("page_id", "url")
    sheet = as_sheet(pages, "pages", "urls", "page_id", {"url": "url"})
    spec = {"items": [{"templateKey": "page", "filter": ".", "fields": [
        {"name": "host", "value": "url", "transform": [["split", "/"], ["index", 2], ["ascii_downcase"]]},
        {"name": "query", "value": "url", "transform": [["split", "?"], ["index", 1], ["ascii_upcase"]]}]}]}
    flat, res = run_flat(sheet, spec, ["host", "query"])
    errs = qa.error_values(res.fields).groupBy(*ITEM_KEY).agg(F.count("*").alias("is_err"))
    return flat.join(errs, ITEM_KEY, "left").select(
        F.col("row_idx").alias("page_id"), "host", "query", F.coalesce("is_err", F.lit(0)).cast("int").alias("is_err"))


@query("infer_type", f"""
SELECT event_id, {S_GETTYPE('CAST(value AS VARCHAR)')} AS t_value, {S_GETTYPE('event_type')} AS t_type,
       {S_GETTYPE('props')} AS t_props, {S_GETTYPE("CAST(user_id AS VARCHAR) || ',5'")} AS t_user,
       {S_GETTYPE("CASE WHEN event_id % 4 = 0 THEN 'YES' WHEN event_id % 4 = 1 THEN '1e5' WHEN event_id % 4 = 2 THEN '-' || CAST(user_id AS VARCHAR) ELSE ' ' END")} AS t_mixed
FROM events
""")
def infer_type(spark, sf):
    """Number / boolean / string inference (commas removed first, T18)."""
    e = _t(spark, sf, "events")
    k = F.col("event_id") % 4
    mixed = (F.when(k == 0, F.lit("YES")).when(k == 1, F.lit("1e5"))
             .when(k == 2, F.concat(F.lit("-"), F.col("user_id").cast("string"))).otherwise(F.lit(" ")))
    return e.select("event_id", tx.get_type(F.col("value").cast("string")).alias("t_value"),
                    tx.get_type(F.col("event_type")).alias("t_type"), tx.get_type(F.col("props")).alias("t_props"),
                    tx.get_type(F.concat(F.col("user_id").cast("string"), F.lit(",5"))).alias("t_user"),
                    tx.get_type(mixed).alias("t_mixed"))


@query("json_promote", """
SELECT event_id,
  CASE WHEN regexp_matches(s, '^\\s*[\\[{]') AND json_valid(s) THEN lower(json_type(s)) ELSE 'string' END AS kind,
  CASE WHEN regexp_matches(s, '^\\s*[\\[{]') AND json_valid(s) THEN CAST(json(s) AS VARCHAR) ELSE s END AS json_text
FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '[' || props || ']' WHEN event_id % 7 = 0 THEN substr(props, 2) ELSE props END AS s
      FROM events) t
""")
def json_promote(spark, sf):
    """Text holding a JSON array/object becomes native; scalars and broken JSON stay text."""
    e = _t(spark, sf, "events")
    s = (F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("["), F.col("props"), F.lit("]")))
         .when(F.col("event_id") % 7 == 0, F.col("props").substr(F.lit(2), F.length("props"))).otherwise(F.col("props")))
    v = e.select("event_id", s.alias("s")).withColumn("v", tx.json_promote(F.col("s")))
    kind = F.schema_of_variant("v")
    k = F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").otherwise("string")
    return v.select("event_id", k.alias("kind"),
                    F.when(k == "string", F.col("s")).otherwise(F.to_json("v")).alias("json_text"))


@query("slugify", f"""
SELECT p_partkey, {S_SLUG("p_name || ' - ' || p_type || ' & ' || p_brand || '!!'")} AS slug FROM part
""")
def slugify(spark, sf):
    """URL/name-safe slugs (Unicode letters and digits kept)."""
    p = _t(spark, sf, "part")
    src = F.concat(F.col("p_name"), F.lit(" - "), F.col("p_type"), F.lit(" & "), F.col("p_brand"), F.lit("!!"))
    return p.select("p_partkey", tx.slugify(src).alias("slug"))


@query("item_names", f"""
SELECT p_partkey, CASE WHEN p_size <= 10 THEN 0 WHEN p_size <= 20 THEN 1 WHEN p_size <= 30 THEN 2 ELSE 3 END AS def,
  CASE WHEN p_size <= 10 THEN 'Static' WHEN p_size <= 20 THEN 'Literal'
       WHEN p_size <= 30 THEN CASE WHEN regexp_matches(p_name, '^([a-z]+)') THEN {S_STRIP("regexp_extract(p_name, '^([a-z]+)', 1)")} ELSE {S_STRIP('p_name')} END
       ELSE {S_SLUG('p_type')} END AS name
FROM part
""")
def item_names(spark, sf):
    """Name precedence - static, literal, field (+transform), slug."""
    spec = {"items": [
        {"templateKey": "a", "filter": "CAST(p_size.value AS INT) <= 10", "name_static": "Static"},
        {"templateKey": "b", "filter": "CAST(p_size.value AS INT) BETWEEN 11 AND 20", "name": "Literal"},
        {"templateKey": "c", "filter": "CAST(p_size.value AS INT) BETWEEN 21 AND 30",
         "name": {"field": "p_name", "transform": "^([a-z]+)"}},
        {"templateKey": "d", "filter": "CAST(p_size.value AS INT) > 30", "name_slug": {"field": "p_type"}},
    ]}
    res = run_sheet(_part_sheet(spark, sf), spec)
    return res.items.select(F.col("row_idx").alias("p_partkey"), F.col("path")[0].getField("d").alias("def"), "name")


@query("required_violations", """
SELECT d.doc_id, 'Quality' AS field FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def required_violations(spark, sf):
    """V1: a required field that resolves blank is a violation (strict mode raises)."""
    spec = {"items": [{"templateKey": "doc", "filter": ".",
                       "fields": [{"name": "Quality", "value": "Quality", "required": True}]}]}
    res = run_sheet(_doc_label_sheet(spark, sf), spec)
    return res.violations.select(F.col("row_idx").alias("doc_id"), "field")


@query("workbook_check", """
SELECT event_id, CASE WHEN NOT json_valid(d) THEN 'invalid_json'
                      WHEN json_type(d) <> 'OBJECT' THEN 'not_an_object'
                      WHEN json_extract(d, '$.workbook') IS NULL THEN 'missing_key'
                      WHEN json_type(d, '$.workbook') <> 'OBJECT' THEN 'key_not_an_object'
                      ELSE 'ok' END AS status
FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '{"workbook": ' || props || '}' WHEN 1 THEN props
                                         WHEN 2 THEN '[' || props || ']' WHEN 3 THEN '{"workbook": [' || props || ']}'
                                         ELSE substr(props, 2) END AS d FROM events) t
""")
def workbook_check(spark, sf):
    """V4: structure check of workbook JSON documents (valid, object, key, key is object)."""
    e = _t(spark, sf, "events")
    k = F.col("event_id") % 5
    d = (F.when(k == 0, F.concat(F.lit('{"workbook": '), F.col("props"), F.lit("}"))).when(k == 1, F.col("props"))
         .when(k == 2, F.concat(F.lit("["), F.col("props"), F.lit("]")))
         .when(k == 3, F.concat(F.lit('{"workbook": ['), F.col("props"), F.lit("]}")))
         .otherwise(F.col("props").substr(F.lit(2), F.length("props"))))
    return qa.workbook_check(e.select("event_id", d.alias("d")), "d").select("event_id", "status")


SELECTION_SPEC = {"input": {"sheets": ["signup", "purchase", "refund", "view", "purchase"]},
                  "sheets": {"signup": {"items": []}, "purchase": {"items": []}, "refund": {"items": []}}}


@query("sheet_selection", """
WITH p AS (SELECT 'wb' || CAST(user_id % 4 AS VARCHAR) AS workbook_id, event_type AS sheet, COUNT(*) AS n FROM events GROUP BY 1, 2),
w AS (SELECT DISTINCT workbook_id FROM p),
spec(sheet, sheet_ord, has_def) AS (VALUES ('signup', 0, true), ('purchase', 1, true), ('refund', 2, true), ('view', 3, false))
SELECT p.workbook_id, p.sheet, 'selected' AS status, spec.sheet_ord, p.n AS n_rows FROM p JOIN spec ON p.sheet = spec.sheet AND spec.has_def
UNION ALL SELECT w.workbook_id, spec.sheet, 'no_definition', -1, 0 FROM w, spec WHERE NOT spec.has_def
UNION ALL SELECT w.workbook_id, spec.sheet, 'missing_sheet', -1, 0 FROM w, spec
          WHERE spec.has_def AND NOT EXISTS (SELECT 1 FROM p WHERE p.workbook_id = w.workbook_id AND p.sheet = spec.sheet)
""")
def sheet_selection(spark, sf):
    """S3: listed sheets in order, once each; undefined and missing sheets reported."""
    e = _t(spark, sf, "events").select(
        F.concat(F.lit("wb"), (F.col("user_id") % 4).cast("string")).alias("workbook_id"), F.col("event_type").alias("sheet"))
    _, sheets, report, _ = select_sheets(e, SELECTION_SPEC)
    counts = e.groupBy("workbook_id", "sheet").agg(F.count("*").alias("n_rows"))
    sel = sheets.join(counts, ["workbook_id", "sheet"]).select(
        "workbook_id", "sheet", F.lit("selected").alias("status"), "sheet_ord", "n_rows")
    rep = report.select("workbook_id", "sheet", "status", F.lit(-1).alias("sheet_ord"), F.lit(0).cast("bigint").alias("n_rows"))
    return sel.unionByName(rep)


# ============================================================================================
# Hierarchy through the full pipeline
# ============================================================================================
def _hierarchy_sheet(spark, sf) -> DataFrame:
    r = _t(spark, sf, "region")
    n = _t(spark, sf, "nation")
    c = _t(spark, sf, "customer")
    R = lambda rk: F.col(rk).cast("bigint") * F.lit(1 << 41)
    N = lambda nk: (F.col(nk).cast("bigint") + 1) * F.lit(1 << 35)
    cells = {"Region": "reg", "Nation": "nat", "Customer": "cus", "Balance": "bal", "Segment": "seg"}
    e = F.lit("")
    regions = r.select(R("r_regionkey").alias("ri"), F.col("r_name").alias("reg"), e.alias("nat"), e.alias("cus"),
                       e.alias("bal"), e.alias("seg"))
    nations = n.select((R("n_regionkey") + N("n_nationkey")).alias("ri"), e.alias("reg"), F.col("n_name").alias("nat"),
                       e.alias("cus"), e.alias("bal"), e.alias("seg"))
    cn = c.join(n.select("n_nationkey", "n_regionkey"), c.c_nationkey == n.n_nationkey)
    custs = cn.select((R("n_regionkey") + N("n_nationkey") + F.col("c_custkey") + 1).alias("ri"), e.alias("reg"),
                      e.alias("nat"), F.col("c_name").alias("cus"), F.col("c_acctbal").cast("string").alias("bal"),
                      F.col("c_mktsegment").alias("seg"))
    rows = regions.unionByName(nations).unionByName(custs)
    return as_sheet(rows, "geo", "hierarchy", "ri", cells)


HIERARCHY_SPEC = {
    tx.SPEC_CONFIG_KEY: {"rootPath": "/geo", "dictionaries": {"templates": {"region": "{R}", "nation": "{N}", "customer": "{C}"}}},
    "items": [{
        "templateKey": "region", "filter": NOT_BLANK.format("Region"), "scope_children": True,
        "name": {"field": "Region"}, "fields": [{"name": "Label", "value": "Region"}],
        "children": [{
            "templateKey": "nation", "filter": NOT_BLANK.format("Nation"), "scope_children": True,
            "name": {"field": "Nation"}, "fields": [{"name": "Label", "value": "Nation"}],
            "children": [{
                "templateKey": "customer", "filter": NOT_BLANK.format("Customer"), "name_slug": {"field": "Customer"},
                "fields": [{"name": "Balance", "value": "Balance", "type": "getType"},
                           {"name": "Segment", "value": "Segment", "relationKey": "segments"},
                           {"name": "Rich", "computed": True, "condition": "CAST(Balance.value AS DOUBLE) > 9000",
                            "value": True, "else_value": False, "omit_if_false": True}],
            }],
        }],
    }],
}


@query("hierarchy_items", f"""
SELECT 1 AS depth, r_name AS name, CAST(NULL AS VARCHAR) AS parent_name, 'region' AS template_key, CAST(1 AS BIGINT) AS n_fields FROM region
UNION ALL
SELECT 2, n.n_name, r.r_name, 'nation', 1 FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
UNION ALL
SELECT 3, {S_SLUG('c.c_name')}, n.n_name, 'customer', CASE WHEN c.c_acctbal > 9000 THEN 3 ELSE 2 END
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def hierarchy_items(spark, sf):
    """R1 + P13 + W3: region -> nation -> customer items from one ordered sheet."""
    res = run_sheet(_hierarchy_sheet(spark, sf), HIERARCHY_SPEC)
    n = res.fields.groupBy(*ITEM_KEY).agg(F.count("*").alias("n_fields"))
    par = res.items.select("workbook_id", "sheet", F.col("item_id").alias("parent_id"), F.col("name").alias("parent_name"))
    return res.items.join(n, ITEM_KEY, "left").join(par, ["workbook_id", "sheet", "parent_id"], "left").select(
        "depth", "name", "parent_name", "template_key", F.coalesce("n_fields", F.lit(0)).cast("bigint").alias("n_fields"))


def _hierarchy_doc_sql() -> str:
    cfg = '{"rootPath": "/geo", "importStrategy": {}, "backupStrategy": {}, "templates": {"region": "{R}", "nation": "{N}", "customer": "{C}"}}'
    rel = "{}"
    R, N = 1 << 41, 1 << 35
    el = lambda k, i=0: f"{k}.{i}..0.0"
    parts = [
        f"SELECT 'geo' AS workbook_id, '{el(0)}' AS frag_key, '[' AS text",
        f"SELECT 'geo', '{el(4)}', ']'",
        f"SELECT 'geo', '{el(3)}|{el(0)}', '{{\"{tx.DOC_CONFIG_KEY}\":{cfg},\"relations\":{rel},\"items\":['".replace('\\"', '"'),
        f"SELECT 'geo', '{el(3)}|{el(4)}', ']}}'",
    ]
    for lvl, tpl in (("RP", "region"), ("NP", "nation")):
        parts += [
            f"SELECT 'geo', p || '|{el(0)}', CASE WHEN first THEN '' ELSE ',' END || '{{\"name\":\"' || nm || '\",\"fields\":[' FROM {lvl}",
            f"SELECT 'geo', p || '|{el(1)}', '{{\"name\":\"Label\",\"value\":\"' || nm || '\"}}' FROM {lvl}",
            f"SELECT 'geo', p || '|{el(2)}', '],\"templateKey\":\"{tpl}\"' FROM {lvl}",
            f"SELECT 'geo', p || '|{el(2, 1)}', ',\"children\":[' FROM {lvl} WHERE has",
            f"SELECT 'geo', p || '|{el(3, (1 << 31) - 1)}', ']' FROM {lvl} WHERE has",
            f"SELECT 'geo', p || '|{el(4)}', '}}' FROM {lvl}",
        ]
    parts += [
        f"SELECT 'geo', p || '|{el(0)}', CASE WHEN first THEN '' ELSE ',' END || '{{\"name\":\"' || nm || '\",\"fields\":[' FROM CP",
        f"SELECT 'geo', p || '|{el(1, 0)}', '{{\"name\":\"Balance\",\"value\":\"' || CAST(bal AS VARCHAR) || '\",\"type\":\"' || {S_GETTYPE('CAST(bal AS VARCHAR)')} || '\"}}' FROM CP",
        f"SELECT 'geo', p || '|{el(1, 1)}', ',{{\"name\":\"Segment\",\"value\":\"' || seg || '\",\"relationKey\":\"segments\"}}' FROM CP",
        f"SELECT 'geo', p || '|{el(1, 2)}', ',{{\"name\":\"Rich\",\"value\":true}}' FROM CP WHERE bal > 9000",
        f"SELECT 'geo', p || '|{el(2)}', '],\"templateKey\":\"customer\"' FROM CP",
        f"SELECT 'geo', p || '|{el(4)}', '}}' FROM CP",
    ]
    body = "\nUNION ALL ".join(parts).replace('\\"', '"')
    return f"""
WITH R AS (SELECT r_regionkey AS rk, r_name AS nm, CAST(r_regionkey AS BIGINT) * {R} AS ri FROM region),
N AS (SELECT n_nationkey AS nk, n_name AS nm, n_regionkey AS rk,
             CAST(n_regionkey AS BIGINT) * {R} + (CAST(n_nationkey AS BIGINT) + 1) * {N} AS ri FROM nation),
C AS (SELECT c.c_custkey AS ck, {S_SLUG('c.c_name')} AS nm, c.c_acctbal AS bal, c.c_mktsegment AS seg,
             n.ri + c.c_custkey + 1 AS ri, n.nk FROM customer c JOIN N n ON c.c_nationkey = n.nk),
RP AS (SELECT R.*, '{el(3)}|3.0..' || CAST(ri AS VARCHAR) || '.0' AS p, ri = (SELECT MIN(ri) FROM R) AS first,
              EXISTS (SELECT 1 FROM N WHERE N.rk = R.rk) AS has FROM R),
NP AS (SELECT N.nk, N.nm, N.ri, RP.p || '|3.0..' || CAST(N.ri AS VARCHAR) || '.0' AS p,
              N.ri = MIN(N.ri) OVER (PARTITION BY N.rk) AS first,
              EXISTS (SELECT 1 FROM C WHERE C.nk = N.nk) AS has FROM N JOIN RP ON N.rk = RP.rk),
CP AS (SELECT C.nm, C.bal, C.seg, NP.p || '|3.0..' || CAST(C.ri AS VARCHAR) || '.0' AS p,
              C.ri = MIN(C.ri) OVER (PARTITION BY C.nk) AS first FROM C JOIN NP ON C.nk = NP.nk)
{body}
"""


@query("hierarchy_doc")
def hierarchy_doc(spark, sf):
    """J6 + S4 + S6: the nested document as ordered JSON fragments (flagship output)."""
    from ..operators.document import document_fragments

    res = run_sheet(_hierarchy_sheet(spark, sf), HIERARCHY_SPEC)
    sheets = spark.createDataFrame([("geo", "hierarchy", 0)], "workbook_id string, sheet string, sheet_ord int")
    frags = document_fragments(materialize(res.items), materialize(res.fields), sheets,
                               {"hierarchy": HIERARCHY_SPEC[tx.SPEC_CONFIG_KEY]}, sheet_ords={"hierarchy": 0}, open_first=res.open_first)
    key_txt = F.array_join(F.transform("key", lambda e: F.concat_ws(".", e.k, e.d, e.g, e.r, e.s)), "|")
    return frags.select("workbook_id", key_txt.alias("frag_key"), "text")


# ============================================================================================
# X1-X8 spreadsheet text functions
# ============================================================================================
@query("text_substitute", """
SELECT p_partkey, replace(p_name, 'e', 'E') AS s_all,
  CASE WHEN len(string_split(p_name, 'e')) - 1 >= 2
       THEN array_to_string(string_split(p_name, 'e')[1:2], 'e') || '3' || array_to_string(string_split(p_name, 'e')[3:], 'e')
       ELSE p_name END AS s_2nd
FROM part
""")
def text_substitute(spark, sf):
    p = _t(spark, sf, "part")
    return p.select("p_partkey", xl.substitute(F.col("p_name"), "e", "E").alias("s_all"),
                    xl.substitute(F.col("p_name"), "e", "3", 2).alias("s_2nd"))


@query("text_search", """
SELECT p_partkey,
  CASE WHEN regexp_matches(substr(p_name, 2), '(?i)r.n') THEN CAST(length(regexp_extract(substr(p_name, 2), '(?is)^(.*?)r.n', 1)) + 2 AS BIGINT) END AS pos_rn,
  CASE WHEN regexp_matches(p_name, '(?i).*G') THEN CAST(1 AS BIGINT) END AS pos_g
FROM part
""")
def text_search(spark, sf):
    p = _t(spark, sf, "part")
    return p.select("p_partkey", xl.search("r?n", F.col("p_name"), 2).cast("bigint").alias("pos_rn"),
                    xl.search("*G", F.col("p_name")).cast("bigint").alias("pos_g"))


@query("text_format", """
SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS t_money, printf('%.0f', o_totalprice) AS t_int,
       printf('%.2f', (o_totalprice / 1000000) * 100) || '%' AS t_pct, o_orderstatus AS t_text
FROM orders
""")
def text_format(spark, sf):
    o = _t(spark, sf, "orders")
    price = F.col("o_totalprice").cast("string")
    return o.select("o_orderkey", xl.text(price, "#,##0.00").alias("t_money"), xl.text(price, "0").alias("t_int"),
                    xl.text((F.col("o_totalprice") / 1000000).cast("string"), "0.00%").alias("t_pct"),
                    xl.text(F.col("o_orderstatus"), "0.00").alias("t_text"))


@query("text_value", """
SELECT o_orderkey, TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS v_money,
       CAST(NULL AS DOUBLE) AS v_text, CAST(o_custkey AS DOUBLE) AS v_int
FROM orders
""")
def text_value(spark, sf):
    o = _t(spark, sf, "orders")
    money = F.concat(F.lit("$"), F.col("o_totalprice").cast("string"), F.lit("%"))
    cust = F.concat(F.lit(" "), F.format_number(F.col("o_custkey"), 0), F.lit(" "))
    return o.select("o_orderkey", xl.value(money).alias("v_money"), xl.value(F.col("o_orderpriority")).alias("v_text"),
                    xl.value(cust).alias("v_int"))


@query("text_join", """
SELECT o_orderkey, o_orderstatus || '-' || o_orderpriority AS j_skip, o_orderstatus || '||' || o_orderpriority AS j_keep FROM orders
""")
def text_join(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", xl.textjoin("-", True, F.col("o_orderstatus"), F.lit(""), F.col("o_orderpriority")).alias("j_skip"),
                    xl.textjoin("|", "no", F.col("o_orderstatus"), F.lit(""), F.col("o_orderpriority")).alias("j_keep"))


def S_PROPER(x: str) -> str:
    cased = "\\p{Lu}\\p{Ll}\\p{Lt}"
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '([{cased}]+|[^{cased}]+)', 1), "
            f"lambda r: CASE WHEN regexp_matches(r, '^[{cased}]') THEN upper(substring(r, 1, 1)) || lower(substring(r, 2)) "
            f"ELSE r END), '')")


@query("text_proper", f"""
SELECT c_custkey, {S_PROPER("c_name || ' ' || c_mktsegment || ' they''re o-k'")} AS proper_name FROM customer
""")
def text_proper(spark, sf):
    c = _t(spark, sf, "customer")
    src = F.concat(F.col("c_name"), F.lit(" "), F.col("c_mktsegment"), F.lit(" they're o-k"))
    return c.select("c_custkey", xl.proper(src).alias("proper_name"))


@query("text_char", """
SELECT p_partkey, chr(CAST(p_size + 60 AS INTEGER)) AS c_ascii,
  CASE WHEN (p_partkey * 37) % 70000 BETWEEN 55296 AND 57343 THEN '' ELSE chr(CAST((p_partkey * 37) % 70000 AS INTEGER)) END AS c_wide,
  '' AS c_neg
FROM part
""")
def text_char(spark, sf):
    p = _t(spark, sf, "part")
    return p.select("p_partkey", xl.char(F.col("p_size") + 60).alias("c_ascii"),
                    xl.char((F.col("p_partkey") * 37) % 70000).alias("c_wide"), xl.char(-F.col("p_size") - 1).alias("c_neg"))


@query("text_clean", """
SELECT page_id, CAST(length(c) AS BIGINT) AS n, md5(c) AS md5_c FROM (SELECT page_id, regexp_replace(html, '[\\x00-\\x1F]', '', 'g') AS c FROM pages) t
""")
def text_clean(spark, sf):
    p = _t(spark, sf, "pages").select("page_id", xl.clean(F.col("html")).alias("c"))
    return p.select("page_id", F.length("c").cast("bigint").alias("n"), F.md5("c").alias("md5_c"))


ORACLE["hierarchy_doc"] = _hierarchy_doc_sql().strip()


# ============================================================================================
# The extraction run end to end on raw grids derived from the tables
# ============================================================================================
def _region_grid(spark, sf) -> DataFrame:
    """One workbook per region. ``Nations``: header row + one row per nation. ``Customers``:
    header row with ``[MAP] <nation> (link)`` for each nation of the region, then one row per
    customer with ``x`` under its own nation and ``""`` under the others."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = _t(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _t(spark, sf, "region").select("r_regionkey", "r_name")
    nr = n.join(r, n.n_regionkey == r.r_regionkey)
    none = F.lit(None).cast("string")

    def g(wb, sheet, ordv, row, col, text):
        return [wb.alias("workbook_id"), F.lit(sheet).alias("sheet"), F.lit(ordv).alias("sheet_ord"),
                row.cast("int").alias("row"), col.cast("int").alias("col"), text.cast("string").alias("text"),
                none.alias("comment"), none.alias("comment_author")]

    wb = F.col("r_name")
    nat_head = r.select(F.col("r_name"), F.explode(F.array(
        F.struct(F.lit(1).alias("col"), F.lit("Nation (Key)").alias("text")),
        F.struct(F.lit(2).alias("col"), F.lit("Region (info)").alias("text")))).alias("h")).select(
        *g(wb, "Nations", 0, F.lit(1), F.col("h.col"), F.col("h.text")))
    nat_rows = nr.select(F.col("r_name"), F.col("n_nationkey"), F.explode(F.array(
        F.struct(F.lit(1).alias("col"), F.col("n_name").alias("text")),
        F.struct(F.lit(2).alias("col"), F.col("r_name").alias("text")))).alias("h")).select(
        *g(wb, "Nations", 0, F.col("n_nationkey") + 2, F.col("h.col"), F.col("h.text")))
    cus_head = r.select("r_name").select(*g(wb, "Customers", 1, F.lit(1), F.lit(1), F.lit("Customer")))
    map_head = nr.select(*g(wb, "Customers", 1, F.lit(1), F.col("n_nationkey") + 2,
                            F.concat(F.lit("[MAP] "), F.col("n_name"), F.lit(" (link)"))))
    cn = c.join(nr.select(F.col("n_nationkey").alias("own"), F.col("n_regionkey").alias("rk"), "r_name"),
                c.c_nationkey == F.col("own"))
    cus_name = cn.select(*g(wb, "Customers", 1, F.col("c_custkey") + 2, F.lit(1), F.col("c_name")))
    per_nation = cn.join(n.select(F.col("n_nationkey").alias("nk"), F.col("n_regionkey").alias("nrk")),
                         F.col("rk") == F.col("nrk"))
    cus_map = per_nation.select(*g(wb, "Customers", 1, F.col("c_custkey") + 2, F.col("nk") + 2,
                                   F.when(F.col("nk") == F.col("own"), F.lit("x")).otherwise(F.lit(""))))
    return (nat_head.unionByName(nat_rows).unionByName(cus_head).unionByName(map_head)
            .unionByName(cus_name).unionByName(cus_map))


@query("extract_relations", """
SELECT r.r_name AS workbook_id, n.n_name AS target_key, 'Nations' AS target_sheet, c.c_custkey AS source_row,
       'X' AS map_value
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def extract_relations(spark, sf):
    """Raw grids -> normalized headers, cleaned cells, collapsed rows -> key index and
    matrix relations, one plan for all region workbooks."""
    from .extract import run_extract

    ex = run_extract(_region_grid(spark, sf))
    return ex.relations.select("workbook_id", "target_key", "target_sheet", "source_row", "map_value")


@query("spec_lookup", f"""
SELECT s.s_suppkey, coalesce(n.n_name, '') AS nation, coalesce(CAST(n.n_regionkey AS VARCHAR), '-') AS region_key,
       CASE WHEN n.n_regionkey IS NULL THEN 'string' ELSE 'number' END AS region_key_type
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
""")
def spec_lookup(spark, sf):
    """R2 + J5 in a spec: a suppliers sheet reads nation fields from a nations key sheet of the
    same workbook through ``lookup`` fields (first match; default when missing)."""
    from ..model import sheet_to_cells
    from .flat import pivot_fields
    from .run import run_transform

    s = _t(spark, sf, "supplier")
    n = _t(spark, sf, "nation")
    sup = as_sheet(s, "geo", "suppliers", "s_suppkey", {"Supplier": "s_name", "NationKey": "s_nationkey"})
    nat = as_sheet(n, "geo", "nations", "n_nationkey", {"Nation ID (Key)": "n_nationkey", "Name": "n_name",
                                                         "Region": "n_regionkey"})
    cells = sheet_to_cells(sup, ["Supplier", "NationKey"], 0).unionByName(
        sheet_to_cells(nat, ["Nation ID (Key)", "Name", "Region"], 1))
    look = {"sheet": "nations", "key": "Nation ID (Key)", "on": "NationKey"}
    spec = {"sheets": {"suppliers": {
        "source_structure": {"columns": ["Supplier", "NationKey"]},
        "items": [{"templateKey": "supplier", "filter": ".", "name": {"field": "Supplier"}, "fields": [
            {"name": "Nation", "lookup": {**look, "take": "Name"}},
            {"name": "RegionKey", "lookup": {**look, "take": "Region"}, "default": "-", "type": "getType"}]}]}}}
    res = run_transform(cells, spec)
    flat = pivot_fields(res, ["Nation", "RegionKey"], extra={"region_key_type": ("RegionKey", "type")})
    return flat.select(F.col("row_idx").alias("s_suppkey"), F.col("Nation").alias("nation"),
                       F.col("RegionKey").alias("region_key"), "region_key_type")


from . import queries_extract  # noqa: E402, F401  (registers its queries here)
