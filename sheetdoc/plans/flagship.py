"""The flagship query: an event stream turned into nested sheet documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..model import as_sheet
from ..operators.document import document_fragments
from ..session import materialize
from .pipeline import run_sheet

EVENTS_SPEC = {
    tx.SPEC_CONFIG_KEY: {"rootPath": "/events", "dictionaries": {"templates": {"session": "{S}", "event": "{E}"}}},
    "items": [{
        "templateKey": "session", "filter": "event_type.value = 'signup'", "scope_children": True,
        "name_slug": {"field": "label"},
        "fields": [{"name": "Value", "value": "value", "type": "getType"},
                   {"name": "Big", "computed": True, "condition": "CAST(value.value AS DOUBLE) > 250",
                    "value": True, "else_value": False, "type": "getType"}],
        "children": [{
            "templateKey": "event", "filter": "event_type.value <> 'signup'", "name_slug": {"field": "label"},
            "fields": [{"name": "Value", "value": "value", "type": "getType"},
                       {"name": "Props", "value": "props"}],
        }],
    }],
}


def events_sheet(spark: SparkSession, sf: str) -> DataFrame:
    e = spark.read.parquet(f"{sf}/events.parquet")
    label = F.concat(F.col("event_type"), F.lit(" #"), F.col("event_id").cast("string"))
    return as_sheet(e, F.col("user_id").cast("string"), "events", "event_id", {
        "event_type": "event_type", "value": F.col("value").cast("string"), "props": "props", "label": label})


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    res = run_sheet(events_sheet(spark, sf), EVENTS_SPEC)
    items, fields = materialize(res.items), materialize(res.fields)
    sheets = items.select("workbook_id", "sheet").distinct().withColumn("sheet_ord", F.lit(0))
    frags = document_fragments(items, fields, sheets, {"events": EVENTS_SPEC[tx.SPEC_CONFIG_KEY]},
                               sheet_ords={"events": 0}, open_first=res.open_first)
    key_txt = F.array_join(F.transform("key", lambda e: F.concat_ws(".", e.k, e.d, e.g, e.r, e.s)), "|")
    return frags.select("workbook_id", key_txt.alias("frag_key"), "text")


def flagship_oracle_sql() -> str:
    """DuckDB SQL producing the same fragments straight from ``events``."""
    from .queries import S_GETTYPE, S_SLUG

    cfg = '{"rootPath": "/events", "importStrategy": {}, "backupStrategy": {}, "templates": {"session": "{S}", "event": "{E}"}}'
    rel = "{}"
    el = lambda k, i=0: f"{k}.{i}..0.0"
    name = S_SLUG("event_type || ' #' || CAST(event_id AS VARCHAR)")
    value_field = ("'{\"name\":\"Value\",\"value\":\"' || v || '\",\"type\":\"' || "
                   + S_GETTYPE("v") + " || '\"}'")
    open_item = "CASE WHEN first THEN '' ELSE ',' END || '{\"name\":\"' || nm || '\",\"fields\":['"
    parts = [
        f"SELECT wb AS workbook_id, '{el(0)}' AS frag_key, '[' AS text FROM W",
        f"SELECT wb, '{el(4)}', ']' FROM W",
        f"SELECT wb, '{el(3)}|{el(0)}', '{{\"{tx.DOC_CONFIG_KEY}\":{cfg},\"relations\":{rel},\"items\":[' FROM W",
        f"SELECT wb, '{el(3)}|{el(4)}', ']}}' FROM W",
        f"SELECT wb, p || '|{el(0)}', {open_item} FROM S",
        f"SELECT wb, p || '|{el(1, 0)}', {value_field} FROM S",
        f"SELECT wb, p || '|{el(1, 1)}', ',{{\"name\":\"Big\",\"value\":' || CASE WHEN value > 250 THEN 'true' ELSE 'false' END || ',\"type\":\"boolean\"}}' FROM S",
        f"SELECT wb, p || '|{el(2)}', '],\"templateKey\":\"session\"' FROM S",
        f"SELECT wb, p || '|{el(2, 1)}', ',\"children\":[' FROM S WHERE has",
        f"SELECT wb, p || '|{el(3, (1 << 31) - 1)}', ']' FROM S WHERE has",
        f"SELECT wb, p || '|{el(4)}', '}}' FROM S",
        f"SELECT wb, p || '|{el(0)}', {open_item} FROM C",
        f"SELECT wb, p || '|{el(1, 0)}', {value_field} FROM C",
        f"SELECT wb, p || '|{el(1, 1)}', ',{{\"name\":\"Props\",\"value\":' || trim(props) || '}}' FROM C",
        f"SELECT wb, p || '|{el(2)}', '],\"templateKey\":\"event\"' FROM C",
        f"SELECT wb, p || '|{el(4)}', '}}' FROM C",
    ]
    body = "\nUNION ALL ".join(parts).replace('\\"', '"')
    return f"""
WITH e AS (SELECT event_id, CAST(user_id AS VARCHAR) AS wb, event_type, value, CAST(value AS VARCHAR) AS v, props,
                  {name} AS nm,
                  MAX(CASE WHEN event_type = 'signup' THEN event_id END)
                    OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg
           FROM events),
S AS (SELECT e.*, '{el(3)}|3.0..' || CAST(event_id AS VARCHAR) || '.0' AS p,
             event_id = MIN(event_id) OVER (PARTITION BY wb) AS first,
             EXISTS (SELECT 1 FROM e c WHERE c.wb = e.wb AND c.seg = e.event_id AND c.event_type <> 'signup') AS has
      FROM e WHERE event_type = 'signup'),
C AS (SELECT e.*, '{el(3)}|3.0..' || CAST(seg AS VARCHAR) || '.0|3.0..' || CAST(event_id AS VARCHAR) || '.0' AS p,
             event_id = MIN(event_id) OVER (PARTITION BY wb, seg) AS first
      FROM e WHERE seg IS NOT NULL AND event_type <> 'signup'),
W AS (SELECT DISTINCT wb FROM S)
{body}
""".strip()
