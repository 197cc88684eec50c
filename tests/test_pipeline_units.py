"""Transform-spec units: one cell sheets, group/EAV sheets, names, config, sheet selection."""

import json

import pytest

from assemble import assemble_small
from sheetdoc.operators.quality import RequiredFieldError
from sheetdoc.plans.run import run_transform
from sheetdoc.sources.workbook_json import cells_from_python

TPL = {"dictionaries": {"templates": {"item": "{G}"}}}


def run(spark, sheets_rows, items, strict=False, cfg=TPL, extra=None):
    wb = {"s1": sheets_rows}
    spec = {"sheets": {"s1": {"sitecore_config": cfg, "items": items, **(extra or {})}}}
    res = run_transform(cells_from_python(spark, wb), spec, strict=strict)
    return json.loads(assemble_small(res.fragments)), res


def one(spark, fields, row=None, **kw):
    row = row or {"Col": {"value": "  hello  "}, "Flag": {"value": "yes"}, "Label": {"value": ""}}
    docs, _ = run(spark, [row], [{"templateKey": "item", "filter": ".", "fields": fields, **kw}])
    return docs[0]["items"][0]


def test_defaults_transforms_and_types(spark):
    it = one(spark, [
        {"name": "Empty", "value": "Label", "default": "fallback"},
        {"name": "Bool", "value": "Label", "default": True},
        {"name": "Keep", "value": "Col", "default": "unused"},
        {"name": "Re", "value": "Col", "transform": "(h\\w+)"},
        {"name": "Miss", "value": "Nope", "default": "d"},
        {"name": "Json", "value": "Label", "default": '["a", 1]'},
        {"name": "Err", "value": "Label", "transform": [["split", "/"], ["index", 3], ["ascii_upcase"]],
         "default": "never"},
        {"name": "T", "value": "Flag", "type": "getType"}, {"name": "Tag", "value": "Flag", "type": "custom"},
        {"name": "Rel", "value": "Flag", "relationKey": "rk"},
    ])
    f = {x["name"]: x for x in it["fields"]}
    assert f["Empty"]["value"] == "fallback" and f["Bool"]["value"] is True
    assert f["Keep"]["value"] == "  hello  " and f["Re"]["value"] == "hello"
    assert f["Miss"]["value"] == "d" and f["Json"]["value"] == ["a", 1]
    assert f["Err"]["value"] == "#ERR:ValueError"  # T12: default does not replace the sentinel
    assert f["T"]["type"] == "boolean" and f["Tag"]["type"] == "custom" and f["Rel"]["relationKey"] == "rk"
    assert "type" not in f["Empty"]


def test_computed_fields(spark):
    it = one(spark, [
        {"name": "B", "computed": True, "condition": "Flag.value = 'yes'", "value": True, "else_value": False,
         "type": "getType"},
        {"name": "C", "computed": True, "condition": "Flag.value = 'no'", "value": "Col", "else_value": "Flag"},
        {"name": "O", "computed": True, "condition": "Flag.value = 'no'", "value": "Col", "omit_if_false": True},
        {"name": "X", "computed": True, "condition": "no such ((", "value": "Col", "else_value": "Flag"},
        {"name": "T", "computed": True, "condition": "true", "value": "Col", "transform": "(l+)"},
    ])
    f = {x["name"]: x for x in it["fields"]}
    assert f["B"] == {"name": "B", "value": True, "type": "boolean"}
    assert f["C"]["value"] == "yes" and "O" not in f and f["X"]["value"] == "yes" and f["T"]["value"] == "ll"


def test_required_strict_raises_and_violations(spark):
    with pytest.raises(RequiredFieldError):
        run(spark, [{"Col": {"value": " "}}],
            [{"templateKey": "item", "filter": ".", "fields": [{"name": "R", "value": "Col", "required": True}]}],
            strict=True)
    _, res = run(spark, [{"Col": {"value": ""}}, {"Col": {"value": "ok"}}],
                 [{"templateKey": "item", "filter": ".", "fields": [{"name": "R", "value": "Col", "required": True}]}])
    assert [(v.field, v.row_idx) for v in res.violations.collect()] == [("R", 0)]


def test_tokens_on_plain_rows(spark):
    row = {"Base": {"value": "B1", "annotation": "bn"}, "Col": {"value": "c", "annotation": "ca"}}
    docs, _ = run(spark, [row], [{"templateKey": "item", "filter": ".", "fields": [
        {"name": "b", "value": "$base"}, {"name": "ba", "value": "$base_annotation"},
        {"name": "v", "value": "$variant"}, {"name": "a", "value": "$annotation:Col"},
        {"name": "m", "value": "$annotation:Missing"}]}], extra={"source_structure": {"column_base": "Base"}})
    assert [f["value"] for f in docs[0]["items"][0]["fields"]] == ["B1", "bn", "", "ca", ""]


EAV = [{"Component": {"value": c}, "Attribute Name": {"value": a}, "Value": {"value": v}}
       for c, a, v in [("Auth", "Tipo", "Service"), ("Auth", "Version", "1.0"), ("Auth", "", "skip"),
                       ("", "Orphan", "x"), ("Api", "Count", "42")]]


def test_group_with_dynamic_fields(spark):
    items = [{"templateKey": "item", "group_by": {"column": "Component", "drop_empty": True}, "filter": ".",
              "name": {"field": "Component"},
              "dynamic_fields": {"source": "__scope__", "filter": "NOT (`Attribute Name`.value <=> '')",
                                 "name_from": "Attribute Name", "value_from": "Value", "type": "getType"}}]
    docs, _ = run(spark, EAV, items)
    got = [(i["name"], [(f["name"], f["value"], f["type"]) for f in i["fields"]]) for i in docs[0]["items"]]
    # groups sorted by key; rows of each group in sheet order
    assert got == [("Api", [("Count", "42", "number")]),
                   ("Auth", [("Tipo", "Service", "string"), ("Version", "1.0", "number")])]


def test_dynamic_required_and_required_fields(spark):
    items = [{"templateKey": "item", "filter": ".", "fields": [],
              "dynamic_fields": {"name_from": "Attribute Name", "value_from": "Value", "required": True,
                                 "required_fields": ["Tipo", "Mandatory"]}}]
    _, res = run(spark, [{"Attribute Name": {"value": "Tipo"}, "Value": {"value": ""}}], items)
    assert sorted((v.field, v.reason) for v in res.violations.collect()) == [
        ("Mandatory", "required_field_missing"), ("Tipo", "required_dynamic_value"), ("Tipo", "required_field_missing")]


def test_scoping_names_and_head_guard(spark):
    rows = [{"Cat": {"value": v}, "Item": {"value": i}} for v, i in
            [("", "orphan"), ("My Cat!", ""), ("", "a"), ("Two", ""), ("", "b"), ("", "c")]]
    items = [{"templateKey": "group", "filter": "NOT (Cat.value <=> '')", "name_slug": {"field": "Cat"},
              "children": [{"templateKey": "item", "filter": "NOT (Item.value <=> '')", "name": {"field": "Item"}}]},
             {"templateKey": "first", "head_only": True, "filter": "Cat.value = ''", "name_static": "Head"},
             {"templateKey": "lit", "filter": "Item.value = 'c'", "name": "Literal"}]
    docs, _ = run(spark, rows, items)
    got = [(i["name"], [c["name"] for c in i.get("children", [])]) for i in docs[0]["items"]]
    assert got == [("my-cat", ["a"]), ("two", ["b", "c"]), ("Head", []), ("Literal", [])]
    assert "children" not in docs[0]["items"][2]


def test_config_block_and_branch_keys(spark):
    cfg = {"rootPath": "/r", "importStrategy": {"mode": "m"}, "layoutPostProcess": {"x": 1},
           "dictionaries": {"templates": {"t": "1"}, "relations": {"r": "2"}, "branches": {"b": "3"}}}
    docs, _ = run(spark, [{"A": {"value": "x"}}], [{"branchKey": "b", "filter": "."}], cfg=cfg)
    d = docs[0]
    assert d["relations"] == {"r": "2"}
    assert list(d["sitecoreConfig"]) == ["rootPath", "importStrategy", "backupStrategy", "templates", "branches",
                                         "layoutPostProcess"]
    assert d["items"] == [{"name": "unnamed", "fields": [], "branchKey": "b"}]
    with pytest.raises(ValueError):
        run(spark, [{"A": {"value": "x"}}], [{"filter": "."}])


def test_sheet_selection_and_missing(spark):
    wb = {"a": [{"X": {"value": "1"}}], "b": [{"X": {"value": "2"}}]}
    spec = {"input": {"sheets": ["b", "zzz", "a", "nodef", "b"]},
            "sheets": {"a": {"items": [{"templateKey": "t", "filter": "."}]},
                       "b": {"items": [{"templateKey": "t", "filter": "."}]},
                       "zzz": {"items": [{"templateKey": "t", "filter": "."}]}}}
    res = run_transform(cells_from_python(spark, wb), spec)
    docs = json.loads(assemble_small(res.fragments))
    assert len(docs) == 2 and docs[0]["items"][0]["name"] == "unnamed"
    assert sorted((r.sheet, r.status) for r in res.report.collect()) == [("nodef", "no_definition"),
                                                                         ("zzz", "missing_sheet")]


def test_bad_specs_rejected():
    from sheetdoc.plans.spec import SpecError, check_spec, require_spec

    bad = [(["not", "a", "mapping"], "mapping at the top level"), ({"input": {}}, "missing the required 'sheets'"),
           ({"sheets": {}}, "non-empty mapping"), ({"sheets": {"s1": ["x"]}}, "'s1' must be a mapping")]
    for spec, msg in bad:
        assert msg in check_spec(spec)[0]
        with pytest.raises(SpecError):
            require_spec(spec)
    assert check_spec({"sheets": {"s1": {"items": []}}}) == []


def test_scope_over_generated_rows_rejected(spark):
    items = [{"templateKey": "item", "explode": {"column": "A", "sep": "|"}, "scope_children": True, "filter": "."}]
    with pytest.raises(ValueError):
        run(spark, [{"A": {"value": "a|b"}}], items)


def test_odd_header_names(spark):
    row = {"Ver. 1.0": {"value": "x"}, "we`ird": {"value": "y"}, "sp ace": {"value": "z"}}
    it = one(spark, [{"name": "a", "value": "Ver. 1.0"}, {"name": "b", "value": "we`ird"},
                     {"name": "c", "value": "sp ace"}], row=row, name={"field": "we`ird"})
    assert [f["value"] for f in it["fields"]] == ["x", "y", "z"] and it["name"] == "y"


def test_lookup_fields(spark):
    wb = {
        "bap_powertrains": [{"Powertrain ID (Key)": {"value": "eng-001"}, "Title": {"value": "2.0 Turbo"}},
                            {"Powertrain ID (Key)": {"value": "eng-002"}, "Title": {"value": "Hybrid"}},
                            {"Powertrain ID (Key)": {"value": "eng-001"}, "Title": {"value": "later dup"}}],
        "models": [{"Model": {"value": "A"}, "Powertrain": {"value": "eng-002"}},
                   {"Model": {"value": "B"}, "Powertrain": {"value": "none"}}],
    }
    look = {"sheet": "bap_powertrains", "key": "Powertrain ID (Key)", "take": "Title"}
    spec = {"sheets": {"models": {"items": [{
        "templateKey": "model", "filter": ".", "name": {"field": "Model"},
        "fields": [{"name": "Engine", "lookup": {**look, "on": "Powertrain"}, "default": "?"},
                   {"name": "Fixed", "lookup": {**look, "equals": "eng-001"}, "transform": "(\\d\\.\\d)"}]}]}}}
    res = run_transform(cells_from_python(spark, wb), spec)
    items = json.loads(assemble_small(res.fragments))[0]["items"]
    assert [(i["name"], [f["value"] for f in i["fields"]]) for i in items] == [
        ("A", ["Hybrid", "2.0"]), ("B", ["?", "2.0"])]


def test_materialize_switch_keeps_results(spark):
    from sheetdoc.session import MATERIALIZE_CONF

    rows = [{"Cat": {"value": v}, "Item": {"value": i}} for v, i in [("A", ""), ("", "a"), ("B", ""), ("", "b")]]
    items = [{"templateKey": "g", "filter": "NOT (Cat.value <=> '')", "scope_children": True, "name": {"field": "Cat"},
              "children": [{"templateKey": "i", "filter": "NOT (Item.value <=> '')", "name": {"field": "Item"}}]}]
    with_ckpt, _ = run(spark, rows, items)
    spark.conf.set(MATERIALIZE_CONF, "none")
    try:
        lazy, _ = run(spark, rows, items)
    finally:
        spark.conf.unset(MATERIALIZE_CONF)
    assert with_ckpt == lazy


def test_top_level_variants_are_empty(spark):
    items = [{"templateKey": "v", "expand_variants": True, "filter": ".",
              "fields": [{"name": "val", "value": "$variant"}, {"name": "base", "value": "$base"}]}]
    docs, _ = run(spark, [{"A": {"value": "x"}, "B": {"value": "y"}}], items,
                  extra={"source_structure": {"column_base": "A", "column_data": ["A", "B"]}})
    got = [(i["name"], [f["value"] for f in i["fields"]]) for i in docs[0]["items"]]
    assert got == [("A", ["", ""]), ("B", ["", ""])]


def test_scoped_dynamic_fields_and_empty_head_guard(spark):
    rows = [{"Comp": {"value": c}, "Attr": {"value": a}, "Val": {"value": v}} for c, a, v in
            [("Auth", "", ""), ("", "Tipo", "Service"), ("", "Ver", "1.0"), ("Api", "", ""), ("", "Count", "42")]]
    items = [{"templateKey": "c", "filter": "NOT (Comp.value <=> '')", "scope_children": True,
              "name": {"field": "Comp"},
              "dynamic_fields": {"name_from": "Attr", "value_from": "Val", "type": "getType"}},
             {"templateKey": "h", "head_only": True, "filter": "Comp.value = 'nobody'"}]
    docs, _ = run(spark, rows, items)
    got = [(i["name"], [(f["name"], f["value"], f["type"]) for f in i["fields"]]) for i in docs[0]["items"]]
    assert got == [("Auth", [("Tipo", "Service", "string"), ("Ver", "1.0", "number")]),
                   ("Api", [("Count", "42", "number")])]


def test_explode_literal_split_and_single_space_trim(spark):
    items = [{"templateKey": "k", "explode": {"column": "Keys", "sep": "|", "as": "Key"}, "filter": ".",
              "name": {"field": "Comp"}, "fields": [{"name": "Key", "value": "Key"}]}]
    docs, _ = run(spark, [{"Comp": {"value": "C"}, "Keys": {"value": " a |  b|c  |"}}], items)
    assert [i["fields"][0]["value"] for i in docs[0]["items"]] == ["a", " b", "c ", ""]


def test_group_by_keeps_empty_key_and_sorts_by_key(spark):
    items = [{"templateKey": "g", "group_by": {"column": "Component"}, "filter": ".", "name": {"field": "Component"},
              "dynamic_fields": {"source": "__scope__", "name_from": "Attribute Name", "value_from": "Value"}}]
    docs, _ = run(spark, EAV, items)
    got = [(i["name"], [f["name"] for f in i["fields"]]) for i in docs[0]["items"]]
    assert got == [("", ["Orphan"]), ("Api", ["Count"]), ("Auth", ["Tipo", "Version"])]


def test_promoted_json_is_written_as_it_stands(spark):
    texts = ['[1.0, {"b": 1, "a": 12345678901234567890123456789012345678901234567890}]', "[1]] [[2]", '{"a":1}} {"b":2', "[2", " {} "]
    docs, res = run(spark, [{"J": {"value": t}} for t in texts], [{"templateKey": "item", "filter": ".", "fields": [{"name": "J", "value": "J"}]}])
    got = [i["fields"][0]["value"] for i in docs[0]["items"]]
    assert got == [json.loads(texts[0]), *texts[1:4], {}]
    assert '"b": 1, "a": 12345678901234567890123456789012345678901234567890' in assemble_small(res.fragments)


def test_condition_errors_are_false_for_their_row(spark):
    rows = [{"A": {"value": v}} for v in ("7", "abc", "3", "")]
    fields = [{"name": "F", "computed": True, "condition": "CAST(A.value AS DOUBLE) > 5", "value": True, "else_value": False}]
    docs, _ = run(spark, rows, [{"templateKey": "item", "filter": ".", "fields": fields}])
    assert [i["fields"][0]["value"] for i in docs[0]["items"]] == [True, False, False, False]
    docs, _ = run(spark, rows, [{"templateKey": "item", "filter": "cast(A.value as int) > 2", "name": {"field": "A"}}])
    assert [i["name"] for i in docs[0]["items"]] == ["7", "3"]


def test_head_only_after_generators(spark):
    rows = [{"K": {"value": "z|b"}}, {"K": {"value": "a|c"}}]
    head = {"templateKey": "item", "head_only": True, "filter": ".", "name": {"field": "K"}}
    docs, _ = run(spark, rows, [head | {"explode": {"column": "K", "sep": "|"}}])
    assert [i["name"] for i in docs[0]["items"]] == ["z"]
    docs, _ = run(spark, rows, [head | {"group_by": {"column": "K"}}])
    assert [i["name"] for i in docs[0]["items"]] == ["a|c"]


def test_conditions_contain_every_failure(spark):
    """Casts, comparisons with numbers, divisions, dates, overflows and indexes that fail are false
    for their row; texts, names and functions in a condition are left alone."""
    cells = ["5x", "0", "7", "", "1996-02-30", "1996-02-28", "99999999999999999999"]
    tests = {
        "int(A.value) > 5": {"7"}, "A.value::int > 5": {"7"}, "A.value > 5": {"7"}, "10 / A.value > 1": {"7"},
        "to_date(A.value) > DATE'1990-01-01'": {"1996-02-28"}, "int(A.value) * 1000000000 > 0": set(),
        "split(A.value, '-')[1] = '02'": {"1996-02-30", "1996-02-28"}, "length(A.value) = 1 AND A.value <> 'A.value'": {"0", "7"},
        "A.value IN ('7', 'A')": {"7"}, "NOT (A.value <=> '') AND int(A.value) >= 0": {"0", "7"}, "raise_error(A.value)": set(),
    }
    rows = [{"A": {"value": v}, "Y": {"value": "y"}, "N": {"value": "n"}} for v in cells]
    fields = [{"name": f"t{i}", "computed": True, "condition": c, "value": "Y", "else_value": "N"} for i, c in enumerate(tests)]
    docs, _ = run(spark, rows, [{"templateKey": "item", "filter": ".", "name": {"field": "A"}, "fields": fields}])
    for i, (c, want) in enumerate(tests.items()):
        got = {it["name"] for it in docs[0]["items"] if it["fields"][i]["value"] == "y"}
        assert got == want, c
    for c, want in tests.items():
        docs, _ = run(spark, rows, [{"templateKey": "item", "filter": c, "name": {"field": "A"}}])
        assert {it["name"] for it in docs[0]["items"]} == want, c


def test_any_header_name(spark):
    names = ["Item", "item", "ITEM", "sheet", "workbook_id", "row_idx", "__x", "__h0", "__ord", "$p", "a.b", "a`b", "and", "value", "é"]
    row = {n: {"value": f"v{i}", "annotation": f"n{i}"} for i, n in enumerate(names)}
    fields = [{"name": f"f{i}", "value": n} for i, n in enumerate(names)] + [
        {"name": f"a{i}", "value": f"$annotation:{n}"} for i, n in enumerate(names)] + [
        {"name": f"c{i}", "computed": True, "condition": f"`{n.replace('`', '``')}`.value = 'v{i}' AND `{n.replace('`', '``')}`.annotation RLIKE '^n'",
         "value": True, "else_value": False} for i, n in enumerate(names)] + [
        {"name": "plain", "computed": True, "condition": "Item.value = 'v0' and item.value = 'v1' and sheet.value = 'v3' and __x.value = 'v6' and value.value = 'v13'",
         "value": True, "else_value": False}]
    docs, _ = run(spark, [row], [{"templateKey": "item", "filter": "item.value = 'v1' AND Item.value <> 'item.value'", "name": {"field": "item"}, "fields": fields}])
    (it,) = docs[0]["items"]
    got = {f["name"]: f["value"] for f in it["fields"]}
    for i in range(len(names)):
        assert (got[f"f{i}"], got[f"a{i}"], got[f"c{i}"]) == (f"v{i}", f"n{i}", True), names[i]
    assert got["plain"] is True and it["name"] == "v1"


def test_nested_values_keep_their_text_in_both_sinks(spark):
    from sheetdoc.sources.sinks import flat_fields

    texts = ['{"b":1,"a":1.50}', ' [1.0, 2] ', "plain", "42", '{"a":1,"a":2}']
    docs, res = run(spark, [{"A": {"value": t}} for t in texts], [{"templateKey": "item", "filter": ".", "fields": [{"name": "A", "value": "A"}]}])
    flat = [r.value_json for r in flat_fields(res.fields).orderBy("item_id").collect()]
    assert flat == ['{"b":1,"a":1.50}', "[1.0, 2]", '"plain"', '"42"', json.dumps(texts[4])]
    assert [it["fields"][0]["value"] for it in docs[0]["items"]] == [{"b": 1, "a": 1.5}, [1.0, 2], "plain", "42", texts[4]]


def test_first_field_is_known_or_found(spark):
    """Commas between fields: static fields that may be left out, and dynamic ones after them."""
    rows = [{"K": {"value": k}, "N": {"value": n}, "V": {"value": v}} for k, n, v in (("a", "x", "1"), ("a", "y", "2"), ("b", "", ""), ("c", "z", "3"))]
    maybe = [{"name": "S", "computed": True, "condition": "K.value = 'c'", "value": True, "omit_if_false": True}]
    items = [{"templateKey": "g", "group_by": {"column": "K"}, "filter": ".", "name": {"field": "K"}, "fields": maybe,
              "dynamic_fields": {"source": "__scope__", "name_from": "N", "value_from": "V"}}]
    docs, _ = run(spark, rows, items)
    assert [(i["name"], [f["name"] for f in i["fields"]]) for i in docs[0]["items"]] == [("a", ["x", "y"]), ("b", []), ("c", ["S", "z"])]
    items[0]["fields"] = [{"name": "T", "value": "K"}, *maybe]
    docs, _ = run(spark, rows, items)
    assert [(i["name"], [f["name"] for f in i["fields"]]) for i in docs[0]["items"]] == [("a", ["T", "x", "y"]), ("b", ["T"]), ("c", ["T", "S", "z"])]


def test_flat_view_computes_only_what_is_asked_for(spark):
    """A field's text alone is computed, once; the last field of a name that is there wins."""
    from sheetdoc.plans.flat import run_flat

    cell = "struct<value:string,annotation:string>"
    rows = spark.createDataFrame(
        [("w", "s", 0, ("a", None), ("{}", None)), ("w", "s", 1, ("b", None), ("", None))], f"workbook_id string, sheet string, row_idx bigint, T {cell}, P {cell}")
    first = {"templateKey": "x", "filter": "T.value = 'a'", "fields": [
        {"name": "A", "value": "T"}, {"name": "B", "value": "P", "transform": [["fromjson"]]}, {"name": "A", "value": "T", "transform": [["prefix", "2"]]},
        {"name": "A", "computed": True, "condition": "T.value = 'zz'", "value": "P", "omit_if_false": True}]}
    second = {"templateKey": "y", "filter": "T.value = 'b'", "fields": [{"name": "C", "value": "T", "type": "t"}]}
    flat, _ = run_flat(rows, {"items": [first, second]}, ["A"], extra={"kind": ("C", "type")})
    got = {r.row_idx: (r.A, r.kind) for r in flat.select("row_idx", "A", "kind").collect()}
    assert got == {0: ("2a", None), 1: (None, "t")}
    plan = flat.select("row_idx", "A")._jdf.queryExecution().optimizedPlan().toString()
    assert "parse_json" not in plan and "filter(" not in plan.lower()
