"""Spec loading and argument checks (driver-side; the spec is small and static)."""

from __future__ import annotations

import re


class SpecError(ValueError):
    """The transform spec is not usable."""


def check_spec(spec) -> list[str]:
    """Problems with a transform spec, in the reference validator's order (empty = usable)."""
    if not isinstance(spec, dict):
        return ["spec must be a mapping at the top level"]
    if "sheets" not in spec:
        return ["spec is missing the required 'sheets' key"]
    sheets = spec["sheets"]
    if not isinstance(sheets, dict) or not sheets:
        return ["'sheets' must be a non-empty mapping of sheet definitions"]
    return [f"sheet {name!r} must be a mapping" for name, d in sheets.items() if not isinstance(d, dict)]


def require_spec(spec) -> dict:
    errors = check_spec(spec)
    if errors:
        raise SpecError("; ".join(errors))
    return spec


def load_spec(path: str) -> dict:
    """Load a YAML spec file (``yaml.safe_load``) and check it."""
    import yaml

    with open(path, encoding="utf-8") as fh:
        return require_spec(yaml.safe_load(fh))


#: A cell of a SQL expression: a name, plain or in backquotes, with one of its parts.
_CELL_IN_SQL = re.compile(r"(`(?:[^`]|``)+`|[A-Za-z_]\w*)\s*\.\s*(?:value|annotation)\b")
_QUOTED = re.compile(r"`((?:[^`]|``)+)`")

#: Tokens that stand for something else than a header of their name.
_TOKENS = {"$base", "$base_annotation", "$variant", "$variant_annotation", "__column__", "__cell__", "__base_cell__", "__scope__"}
#: Keys of a definition under which texts name columns.
_NAMING = {"field", "value", "else_value", "column", "columns", "group_by", "name_from", "value_from", "on", "column_base", "column_data"}


def referenced_headers(sheet_spec: dict) -> list[str]:
    """Every header that a sheet definition can read, from the spec alone.

    The texts in its item definitions that name columns, the cells that filters and conditions
    mention, the base and data columns, exactly as they are spelled. A name that a sheet lacks only
    gives empty cells."""
    found: set[str] = set()

    def sql(text: str) -> None:
        found.update(n.strip("`").replace("``", "`") for n in _CELL_IN_SQL.findall(text))
        found.update(n.replace("``", "`") for n in _QUOTED.findall(text))

    def walk(part, named: bool = False) -> None:
        if isinstance(part, dict):
            for key, value in part.items():
                if key in ("filter", "condition"):
                    sql(str(value))
                else:
                    walk(value, key in _NAMING)
        elif isinstance(part, (list, tuple)):
            for value in part:
                walk(value, named)
        elif named and isinstance(part, str):
            found.add(part.removeprefix("$annotation:"))

    structure = sheet_spec.get("source_structure", {}) or {}
    walk(sheet_spec.get("items", []))
    walk({k: structure.get(k) for k in ("column_base", "column_data", "columns")})
    return sorted(h for h in found if h and h not in _TOKENS)
