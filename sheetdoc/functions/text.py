"""Cell-level text semantics as native Spark Columns (no Python UDFs).

Every function takes and returns ``pyspark.sql.Column`` objects so Catalyst keeps them inside
whole-stage code generation. Arguments that are plain ``str`` are column *names* unless the
parameter says it is a literal/pattern.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------------------
# The characters Python's ``str.strip()`` / ``str.isspace()`` treat as whitespace, written as
# a Java regex character class body: TAB, LF, VT, FF, CR, FS, GS, RS, US, SPACE, NEL, NBSP,
# OGHAM SPACE MARK, EN QUAD..HAIR SPACE, LINE SEPARATOR, PARAGRAPH SEPARATOR,
# NARROW NBSP, MEDIUM MATHEMATICAL SPACE, IDEOGRAPHIC SPACE.
WS = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
# Values a type inference reads as boolean (compared after lower-casing).
BOOL_WORDS = ("yes", "no", "true", "false", "✓", "✗")
# Map-cell values that do not make a relation edge (compared after upper-casing and trimming).
FALSY_MAP_VALUES = ("", "0", "FALSE", "NO", "N")
# Error sentinel prefix carried by a failed expression transform.
ERR_PREFIX = "#ERR:"
# Header conventions: a header ending in this suffix is a key column and is kept whole; a
# header starting with this prefix (any case) is a relation column; these headers are dropped.
KEY_SUFFIX = "(Key)"
MAP_PREFIX = "[MAP]"
UNNAMED_PREFIX = "Unnamed"
# Relation copies: attach-column prefix and the key holding the map cell's value.
MAPPED_PREFIX = "__MAPPED_"
MAP_VALUE_KEY = "__MAP_VALUE__"
# Spreadsheet comment metadata: a thread marker line, an id line prefix, and a line made of the
# author, two or more spaces and an opening "(yyyy-mm-dd" date; else a leading "author:" line.
COMMENT_MARKER = "======"
COMMENT_ID_PREFIX = "ID#"
# Merged-group collapse: values dropped before joining, and the separator.
COLLAPSE_SKIP = ("", "nan")
COLLAPSE_SEP = ", "
# Name of an item whose definition resolves no name.
UNNAMED_ITEM = "unnamed"
# Keys of the target format: the spec's per-sheet config block and the document's copy of it.
SPEC_CONFIG_KEY = "sitecore_config"
DOC_CONFIG_KEY = "sitecoreConfig"
# ---------------------------------------------------------------------------------------------

# The same set as literal characters, for ``btrim`` (strips only at the ends, linear time).
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# Python's Unicode ``\w`` approximated by letters, numbers and underscore.
_WORD = r"\p{L}\p{N}_"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def py_strip(c) -> Column:
    """``str.strip()`` with Python's whitespace set (Spark ``trim`` removes only U+0020)."""
    return F.btrim(col_(c), F.lit(WS_CHARS))


def clean_value(c) -> Column:
    """NULL -> '', otherwise the stripped text."""
    return F.coalesce(py_strip(F.col(c).cast("string") if isinstance(c, str) else c.cast("string")), F.lit(""))


def is_blank(c) -> Column:
    """True when the value is NULL or only whitespace (Python ``not str(v).strip()``)."""
    return F.coalesce(py_strip(col_(c)) == F.lit(""), F.lit(True))


def slugify(c) -> Column:
    """Strip, lower, drop non-word characters, collapse ``[\\s_-]+`` to '-', trim '-'."""
    v = F.lower(py_strip(col_(c)))
    v = F.regexp_replace(v, f"[^{_WORD}{WS}-]", "")
    v = F.regexp_replace(v, f"[{WS}_-]+", "-")
    return F.regexp_replace(v, "^-+|-+$", "")


def get_type(c) -> Column:
    """P8: 'number' | 'boolean' | 'string' for a resolved text value."""
    v = py_strip(col_(c).cast("string"))
    digits = F.replace(v, F.lit(","), F.lit(""))
    return (
        F.when(F.coalesce(v, F.lit("")) == "", F.lit("string"))
        .when(digits.rlike(r"^-?\p{Nd}+(\.\p{Nd}+)?\z"), F.lit("number"))
        .when(F.lower(v).isin(*BOOL_WORDS), F.lit("boolean"))
        .otherwise(F.lit("string"))
    )


def resolve_type(value: Column, type_name: str | None) -> Column:
    """P10 / P8 dispatch: ``getType`` infers, any other tag is copied, None -> NULL."""
    if type_name is None:
        return F.lit(None).cast("string")
    if type_name == "getType":
        return get_type(value)
    return F.lit(type_name)


def check_pattern(pattern: str) -> None:
    """A capture transform needs at least one group (T13); fail when building the plan."""
    if re.compile(pattern).groups < 1:
        raise ValueError(f"regex transform needs a capture group: {pattern!r}")


def java_pattern(pattern: str) -> str:
    """Python ``re`` spellings Java lacks: ``(?P<n>..)`` -> ``(?<n>..)``, ``(?P=n)`` -> ``\\k<n>``."""
    p = re.sub(r"\(\?P<([A-Za-z][A-Za-z0-9]*)>", r"(?<\1>", pattern)
    return re.sub(r"\(\?P=([A-Za-z][A-Za-z0-9]*)\)", r"\\k<\1>", p)


def regex_capture(c, pattern: str) -> Column:
    """First group of the first match, stripped; no match -> the whole value stripped.

    ``(?d)`` makes ``.`` and ``$`` treat only LF as a line end, as Python does.
    """
    check_pattern(pattern)
    p = "(?d)" + java_pattern(pattern)
    v = F.coalesce(col_(c).cast("string"), F.lit(""))
    return F.when(v.rlike(p), py_strip(F.regexp_extract(v, p, 1))).otherwise(py_strip(v))


def strict_json(c) -> Column:
    """Parse JSON text to a variant, NULL unless the *whole* text is one JSON value.

    Spark's parsers stop after the first value and ignore what follows. So the text has to parse
    both as the only element of an array and as the only member of an object: whatever follows a
    first value could end one of the two, never both."""
    t = col_(c).cast("string")
    in_list = F.json_array_length(F.concat(F.lit("["), t, F.lit("]"))) == 1
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), t, F.lit("}"))).isNotNull()
    return F.when(in_list & in_object, F.try_parse_json(t))


def json_promote(c) -> Column:
    """Text that parses to a JSON array/object becomes a native variant; else text."""
    v = col_(c).cast("string")
    parsed = F.when(v.rlike(f"^[{WS}]*[\\[{{]"), strict_json(v))
    return F.coalesce(parsed, v.cast("variant"))


def quote_literal(s: str) -> str:
    """Quote a literal for use as a Java regex (split / replace on a literal)."""
    return re.escape(s)


def split_literal(c, sep: str) -> Column:
    """jq ``split(s)``: split on a literal, keeping empty parts."""
    return F.split(col_(c), quote_literal(sep), -1)


def ascii_upcase(c) -> Column:
    return F.translate(col_(c), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def ascii_downcase(c) -> Column:
    return F.translate(col_(c), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ltrimstr(c, s: str) -> Column:
    """Remove one leading occurrence of a literal."""
    v = col_(c)
    return F.when(v.startswith(s), v.substr(F.lit(len(s) + 1), F.length(v))).otherwise(v)


def rtrimstr(c, s: str) -> Column:
    """Remove one trailing occurrence of a literal."""
    v = col_(c)
    return F.when(v.endswith(s), v.substr(F.lit(1), F.length(v) - F.lit(len(s)))).otherwise(v)


def jq_text(value: Column, steps: list) -> Column:
    """P5 over the §2.7 step vocabulary with the reference's error semantics.

    ``steps`` is a list of ``(name, *args)``. A string step that receives NULL turns the whole
    result into ``#ERR:ValueError``; a final NULL renders as ''. Arrays render as JSON text
    (P9 re-parses them). Supported steps: split, index, ascii_upcase, ascii_downcase, gsub,
    ltrimstr, rtrimstr, prefix, suffix, test, length, null, wrap (``[.]``), fromjson and get
    (a JSON path into the parsed value).
    """
    v = value
    err = F.lit(False)
    kind = "str"
    for step in steps:
        name, args = step[0], list(step[1:])
        if name == "null":
            v, kind = F.lit(None).cast("string"), "str"
        elif name == "split":
            err = err | v.isNull()
            v, kind = split_literal(v, args[0]), "arr"
        elif name == "index":
            # jq ``.[n]``: 0-based, negative from the end, out of range -> null.
            n = int(args[0])
            v, kind = F.try_element_at(v, F.lit(n + 1 if n >= 0 else n)), "str"
        elif name in ("ascii_upcase", "ascii_downcase", "gsub", "ltrimstr", "rtrimstr", "test", "length"):
            # jq raises on NULL for the string builtins; ltrimstr/rtrimstr pass it through
            # and ``null | length`` is 0.
            if kind == "str" and name not in ("ltrimstr", "rtrimstr", "length"):
                err = err | v.isNull()
            if name == "ascii_upcase":
                v = ascii_upcase(v)
            elif name == "ascii_downcase":
                v = ascii_downcase(v)
            elif name == "gsub":
                v = F.regexp_replace(v, args[0], args[1].replace("\\", "\\\\").replace("$", "\\$"))
            elif name == "ltrimstr":
                v = ltrimstr(v, args[0])
            elif name == "rtrimstr":
                v = rtrimstr(v, args[0])
            elif name == "test":
                v, kind = v.rlike(args[0]), "bool"
            elif name == "length":
                v = F.coalesce(F.size(v) if kind == "arr" else F.length(v), F.lit(0)).cast("string")
                kind = "str"
        elif name == "prefix":
            v = F.concat(F.lit(args[0]), F.coalesce(v, F.lit("")))
        elif name == "suffix":
            v = F.concat(F.coalesce(v, F.lit("")), F.lit(args[0]))
        elif name == "wrap":
            v, kind = F.array(v), "arr"
        elif name == "fromjson":
            # jq raises on null or invalid JSON text.
            parsed = strict_json(v)
            err = err | parsed.isNull()
            v, kind = parsed, "json"
        elif name == "get":
            # ``.a.b`` / ``.[n]`` on a parsed value, as a JSON path ("$.a.b", "$[0]").
            v = F.try_variant_get(v if kind == "json" else F.try_parse_json(v), args[0], "variant")
            kind = "json"
        else:
            raise ValueError(f"unknown transform step {name!r}")
        if kind == "json" and name not in ("fromjson", "get"):
            raise ValueError(f"step {name!r} after fromjson/get is not supported")
    if kind == "arr":
        # json.dumps spacing: ", " between elements (P9 re-parses the text for plain fields).
        def elem(x):
            j = F.to_json(F.array(x))
            return j.substr(F.lit(2), F.length(j) - 2)
        out = F.concat(F.lit("["), F.array_join(F.transform(v, elem), ", "), F.lit("]"))
    elif kind == "bool":
        out = F.when(v, F.lit("True")).when(~v, F.lit("False"))
    elif kind == "json":
        # containers render as JSON text, scalars as their text; JSON null as ''
        shape = F.schema_of_variant(v)
        out = F.when(shape.rlike("^(OBJECT|ARRAY)"), F.to_json(v)).otherwise(
            py_strip(F.try_variant_get(v, "$", "string")))
    else:
        out = py_strip(v)
    return F.when(err, F.lit(ERR_PREFIX + "ValueError")).otherwise(F.coalesce(out, F.lit("")))


def parse_annotation(text, author) -> Column:
    """Strip spreadsheet comment metadata and return the body.

    With a ``======`` marker: drop lines starting ``======`` or ``ID#`` or that look like
    ``author  (yyyy-mm-dd``; otherwise drop a leading ``author:`` line. Then strip.
    """
    t = py_strip(F.coalesce(col_(text), F.lit("")))
    a = F.coalesce(col_(author), F.lit(""))
    stamp = f"(?d)^.+[{WS}]{{2,}}\\([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}"
    threaded = F.array_join(
        F.filter(
            F.split(t, "\n", -1),
            lambda l: ~(l.startswith(COMMENT_MARKER) | l.startswith(COMMENT_ID_PREFIX) | l.rlike(stamp)),
        ),
        "\n",
    )
    prefix = F.concat(a, F.lit(":\n"))
    plain = F.when((a != "") & t.startswith(prefix), t.substr(F.length(prefix) + 1, F.length(t))).otherwise(t)
    return py_strip(F.when(t.contains(COMMENT_MARKER), threaded).otherwise(plain))
