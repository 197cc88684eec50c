"""A small workbook of a plant nursery, its spec, and the documents it should give."""

from __future__ import annotations

import os

SPEC_FILE = os.path.join(os.path.dirname(__file__), "..", "examples", "nursery.yaml")


def _row(**cells):
    return {h: {"value": c} if isinstance(c, str) else {"value": c[0], "annotation": c[1]} for h, c in cells.items()}


NURSERY = {
    # one reading of each inferred type
    "readings": [_row(Reading=v) for v in ("17", "-0.5", "1,250", "False", "✗", "damp", " ")],
    # rows under header rows: a bed, then the plants in it
    "beds": [
        _row(Bed="North wall", Plant="", Height=""),
        _row(Bed="", Plant="Ivy", Height="300 cm"),
        _row(Bed="Pond", Plant="", Height=""),
        _row(Bed="", Plant="Iris", Height="80 cm"),
        _row(Bed="", Plant="Reed", Height=""),
    ],
    # which tool is on which shelf, with notes
    "shelves": [
        _row(Tool="Spade", Left=("2", "one is blunt"), Right=""),
        _row(Tool="Rake", Left="", Right=("5", "new")),
        _row(Tool="Hose", Left="1", Right="1"),
    ],
    # conditions that hold, fail, or cannot be read
    "orders": [_row(Customer="Ada", Paid="yes"), _row(Customer="Bo", Paid="no")],
}


def _item(name, template, *fields, children=None):
    made = {"name": name, "fields": [dict(zip(("name", "value", "type"), f, strict=False)) for f in fields], "templateKey": template}
    return made | ({"children": children} if children else {})


def _document(root, templates, *items):
    block = {"rootPath": root, "importStrategy": {}, "backupStrategy": {}, "templates": templates}
    return {"sitecoreConfig": block, "relations": {}, "items": list(items)}


#: Worked out by hand from the rules of the spec.
NURSERY_DOCUMENTS = [
    _document("/nursery/readings", {"reading": "r-1"}, *[
        _item("unnamed", "reading", ("Kind", value, kind))
        for value, kind in (("17", "number"), ("-0.5", "number"), ("1,250", "number"), ("False", "boolean"), ("✗", "boolean"), ("damp", "string"), (" ", "string"))
    ]),
    _document(
        "/nursery/beds", {"bed": "b-1", "plant": "p-1"},
        _item("North wall", "bed", ("Title", "North wall"), children=[_item("Ivy", "plant", ("Height", "300 cm"))]),
        _item("Pond", "bed", ("Title", "Pond"), children=[_item("Iris", "plant", ("Height", "80 cm")), _item("Reed", "plant", ("Height", ""))]),
    ),
    _document(
        "/nursery/shelves", {"tool": "t-1", "place": "s-1"},
        _item("Spade", "tool", children=[_item("Left", "place", ("Count", "2"), ("Remark", "one is blunt"))]),
        _item("Rake", "tool", children=[_item("Right", "place", ("Count", "5"), ("Remark", "new"))]),
        _item("Hose", "tool", children=[_item("Left", "place", ("Count", "1"), ("Remark", "")), _item("Right", "place", ("Count", "1"), ("Remark", ""))]),
    ),
    _document(
        "/nursery/orders", {"order": "o-1"},
        _item("Ada", "order", ("Ship", "Ada"), ("Unread", "yes"), ("Always blank", ""), ("Emptied", "")),
        _item("Bo", "order", ("Ship", "no"), ("Unread", "no"), ("Always blank", ""), ("Emptied", "")),
    ),
]
