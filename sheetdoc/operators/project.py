"""Fields, tokens, transforms, computed values, type tags and item names.

Everything here returns Columns over a *context frame*, so one ``select`` computes all of an
item definition's static fields inside one whole-stage-codegen span. A context is either an
ordinary sheet context (one column per header, each a cell struct) or a variant context made by
``expand_variants`` (only ``__column__``, ``__cell__``, ``__base_cell__`` are visible, T10).
"""

from __future__ import annotations

import json
import logging
import re
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..model import qcol

log = logging.getLogger(__name__)

COLUMN, CELL, BASE_CELL = "__column__", "__cell__", "__base_cell__"

FIELD_TYPE = (
    "struct<name:string,value:variant,text:string,type:string,relationKey:string,"
    "fkey:struct<i:int,r:bigint,s:bigint>>"
)


def header_column(i: int) -> str:
    """Generated name of the column that holds the ``i``-th header's cells."""
    return f"__h{i}"


@dataclass
class RowView:
    """What a row exposes to a spec: headers, or the three variant keys.

    ``headers`` maps each header, exactly as it is spelled, to the generated column that holds its
    cells, so headers may differ in case only or equal a key column or an internal name."""

    headers: dict[str, str]
    variant: bool = False
    base_col: str = ""
    extra: dict[str, str] = field(default_factory=dict)  # tokens of plain string columns (lookups)

    def cell(self, name: str) -> Column | None:
        if self.variant:
            if name in (CELL, BASE_CELL):
                return F.col(name)
            return None
        if name in self.headers:
            return qcol(self.headers[name])
        if name == BASE_CELL:
            return self.cell(self.base_col) if self.base_col else None
        return None

    def with_column(self, name: str) -> tuple[RowView, str]:
        """This view with ``name`` as one more header, and the column for its cells."""
        column = self.headers.get(name) or header_column(len(self.headers))
        return RowView({**self.headers, name: column}, self.variant, self.base_col, self.extra), column

    def value(self, name: str) -> Column:
        """Value of a column; missing -> ''; a plain (non-cell) column -> its text."""
        if (self.variant and name == COLUMN) or name in self.extra:
            return F.coalesce(qcol(self.extra.get(name, name)).cast("string"), F.lit(""))
        c = self.cell(name)
        return F.lit("") if c is None else F.coalesce(c.getField("value"), F.lit(""))

    def annotation(self, name: str) -> Column:
        c = self.cell(name)
        return F.lit("") if c is None else F.coalesce(c.getField("annotation"), F.lit(""))


def token_value(view: RowView, token: str) -> Column:
    """P1 + P2: resolve ``$base``-style tokens or a column reference to text."""
    if token == "$base":
        return view.value(BASE_CELL)
    if token == "$base_annotation":
        return view.annotation(BASE_CELL)
    if token == "$variant":
        return view.value(CELL) if view.variant else F.lit("")
    if token == "$variant_annotation":
        return view.annotation(CELL) if view.variant else F.lit("")
    if token.startswith("$annotation:"):
        return view.annotation(token[len("$annotation:"):])
    return view.value(token)


def apply_transform(value: Column, transform) -> Column:
    """A ``str`` is a regex capture; a ``list`` (or ``{"steps": [...]}``) is an
    expression program over the §2.7 step vocabulary."""
    if transform is None:
        return value
    if isinstance(transform, dict):
        transform = transform.get("steps", [])
    if isinstance(transform, (list, tuple)):
        steps = [tuple(s) if isinstance(s, (list, tuple)) else (s,) for s in transform]
        # YAML reads a bare ``null`` step as None.
        steps = [("null", *s[1:]) if s and s[0] is None else s for s in steps]
        return tx.jq_text(value, steps)
    return tx.regex_capture(value, str(transform))


def _lit_variant(v) -> Column:
    if isinstance(v, bool):
        return F.lit(v).cast("variant")
    return F.lit(str(v)).cast("variant")


def _py_text(v) -> str:
    return str(v)  # Python spelling: True/False


#: A quoted text, or a name: in backquotes or plain.
_NAME = re.compile(r"""('(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*")|`((?:[^`]|``)+)`|(?<!\w)([^\W\d]\w*)""")
#: Words of SQL, which name a header only in backquotes or before a dot.
_WORDS = frozenset("and or not in is null like rlike between case when then else end true false as cast".split())
#: Comparisons of cells with texts: nothing in them can fail.
_PLAIN = re.compile(
    r"""(?:\s|'(?:[^'\\]|'')*'|`(?:[^`]|``)+`\.(?:value|annotation)\b|<=>|<>|!=|==?|[(),]|\b(?:and|or|not|in|is|null)\b)*""", re.IGNORECASE)


def physical_names(condition: str, headers: dict[str, str]) -> str:
    """``condition`` with every header that it names replaced by the column that holds its cells.
    Names match headers exactly, case included; texts, functions and parts after a dot stay."""
    def column(m: re.Match) -> str:
        name = m[2].replace("``", "`") if m[2] else m[3]
        if m[1] or name not in headers or condition[: m.start()].rstrip().endswith("."):
            return m[0]
        after = condition[m.end():].lstrip()[:1]
        if m[3] and (after == "(" or (after != "." and m[3].lower() in _WORDS)):
            return m[0]
        return f"`{headers[name]}`"

    return _NAME.sub(column, condition)


def contained(condition: Column) -> Column:
    """``condition`` as true or false: one that fails on a row (a cast of a bad cell, a division by
    zero, an overflow, a date that does not exist, ...) is false for that row and no other.

    ``try_to_binary`` gives NULL where anything below it raises, whatever the operation; the
    condition's text goes through it, so nothing has to be known about the parts it is made of. It
    stands in a lambda function because Spark computes a part that several expressions of a
    projection share once, ahead of them all and so outside of what contains it, but never a part
    of a lambda function."""
    text = F.transform(F.array(F.lit(0)), lambda _: F.try_to_binary(condition.cast("string"), F.lit("utf-8")))
    return F.coalesce(F.get(text, F.lit(0)) == F.encode(F.lit("true"), "utf-8"), F.lit(False))


def condition_column(df: DataFrame, condition, view: RowView) -> Column | None:
    """Parse a Spark SQL condition against the context. An unparsable or unresolvable condition
    counts as false (warning logged), one that fails on a row is false for that row, as in the
    reference."""
    if isinstance(condition, Column):
        return contained(condition)
    text = physical_names(condition, view.headers)
    try:
        c = F.expr(text).cast("boolean")
        df.select(c).schema  # force analysis
    except (AnalysisException, ParseException) as e:
        log.warning("condition %r failed to resolve: %s", condition, e)
        return None
    # what cannot fail stays bare, so that Catalyst can push it down to the scan
    return F.coalesce(c, F.lit(False)) if _PLAIN.fullmatch(text) else contained(c)


def static_field(df: DataFrame, view: RowView, f: dict, idx: int) -> tuple[Column, Column | None]:
    """One field definition -> (nullable field struct, required-violation flag or None).

    A NULL struct means the field is omitted (P7).
    """
    name = F.lit(f["name"])
    type_name = f.get("type")
    rel = F.lit(f.get("relationKey")).cast("string")
    fkey = F.struct(F.lit(idx).alias("i"), F.lit(0).cast("bigint").alias("r"), F.lit(0).cast("bigint").alias("s"))
    required = bool(f.get("required"))

    if f.get("computed"):
        cond_src = f.get("condition", "")
        if not cond_src:
            # No condition -> value '' with no type and no relationKey.
            return _field(name, F.lit("").cast("variant"), F.lit(""), F.lit(None).cast("string"),
                          F.lit(None).cast("string"), fkey), None
        cond = condition_column(df, cond_src[3:].strip() if cond_src.startswith("jq:") else cond_src, view)
        matched = cond if cond is not None else F.lit(False)

        def branch(raw, transform):
            if isinstance(raw, bool):
                return _lit_variant(raw), F.lit(_py_text(raw))
            t = apply_transform(token_value(view, str(raw)), transform)
            return t.cast("variant"), t

        tv, tt = branch(f["value"], f.get("transform"))
        ev, et = branch(f.get("else_value", ""), None)
        value = F.when(matched, tv).otherwise(ev)
        txt = F.when(matched, tt).otherwise(et)
        typ = tx.resolve_type(txt, type_name) if "type" in f else F.lit(None).cast("string")
        relc = rel if "relationKey" in f else F.lit(None).cast("string")
        st = _field(name, value, txt, typ, relc, fkey)
        if f.get("omit_if_false"):
            st = F.when(matched, st)
        viol = tx.is_blank(txt) if required else None
        if viol is not None and f.get("omit_if_false"):
            viol = matched & viol
        return st, viol

    txt = apply_transform(token_value(view, f["value"]), f.get("transform"))
    if "default" in f:
        # The default replaces a blank resolved value and may be non-string.
        d = f["default"]
        if isinstance(d, str):
            dv, dt = tx.json_promote(F.lit(d)), F.lit(d)
        elif isinstance(d, (bool, int, float)):
            dv, dt = F.lit(d).cast("variant"), F.lit(str(d))
        else:
            dv, dt = F.parse_json(F.lit(json.dumps(d))), F.lit(json.dumps(d))
        blank = py_blank(txt)
        value = F.when(blank, dv).otherwise(tx.json_promote(txt))
        txt = F.when(blank, dt).otherwise(txt)
    else:
        value = tx.json_promote(txt)
    typ = tx.resolve_type(txt, type_name) if "type" in f else F.lit(None).cast("string")
    relc = rel if "relationKey" in f else F.lit(None).cast("string")
    viol = tx.is_blank(txt) if required else None
    return _field(name, value, txt, typ, relc, fkey), viol


def py_blank(c: Column) -> Column:
    return tx.py_strip(c) == F.lit("")


def _field(name, value, txt, typ, rel, fkey) -> Column:
    return F.struct(
        name.alias("name"), value.alias("value"), txt.alias("text"), typ.alias("type"),
        rel.alias("relationKey"), fkey.alias("fkey"),
    )


def item_name(view: RowView, item_def: dict) -> Column:
    """name_static -> literal name -> name.field (+transform) -> name_slug -> variant
    column -> 'unnamed' (T19)."""
    if item_def.get("name_static"):
        return F.lit(item_def["name_static"])
    name = item_def.get("name")
    if name:
        if isinstance(name, str):
            return F.lit(name)
        v = tx.py_strip(view.value(name["field"]))
        if name.get("transform"):
            v = apply_transform(v, name["transform"])
        return v
    slug = item_def.get("name_slug")
    if slug:
        return tx.slugify(view.value(slug["field"]))
    if view.variant:
        return F.coalesce(F.col(COLUMN), F.lit(""))
    return F.lit(tx.UNNAMED_ITEM)
