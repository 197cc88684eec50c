"""Column-function units: cases retyped from the reference's tests plus edge cases
(FIXTURES.md §3). Many expressions are evaluated in one job per test."""

from pyspark.sql import functions as F

from sheetdoc.functions import text as tx
from sheetdoc.functions import xl
from sheetdoc.operators.clean import normalize_header


def ev(spark, cols):
    return list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).collect()[0])


def test_substitute(spark):
    cases = [(("aaa", "a", "b"), "bbb"), (("hello world", "world", "there"), "hello there"),
             (("aaa", "a", "b", 2), "aba"), (("aaa", "a", "b", 1), "baa"), (("hello", "", "x"), "hello"),
             (("hello", "z", "x"), "hello"), (("ab", "a", "x", 5), "ab"), (("a.b.c", ".", "-", 2), "a.b-c"),
             (("aaa", "a", "b", 0), "aaa")]
    got = ev(spark, [xl.substitute(*args) for args, _ in cases])
    assert got == [e for _, e in cases]


def test_search(spark):
    cases = [(("world", "hello world"), 7), (("HELLO", "hello world"), 1), (("o", "hello world", 6), 8),
             (("xyz", "hello world"), None), (("h*o", "hello"), 1), (("h?llo", "hello"), 1),
             (("a.b", "xxa.b"), 3), (("É", "café"), 4)]
    got = ev(spark, [xl.search(*args) for args, _ in cases])
    assert got == [e for _, e in cases]


def test_text_format(spark):
    cases = [(("hello", "@"), "hello"), ((1234, "0"), "1234"), ((1234.5, "0.00"), "1234.50"),
             ((1234567.89, "#,##0.00"), "1,234,567.89"), ((0.5, "0%"), "50%"), ((0.1234, "0.00%"), "12.34%"),
             (("not a number", "0.00"), "not a number"), ((0.125, "0.00"), "0.12"), ((0.375, "0.00"), "0.38"),
             (("1,234.5", "0.0"), "1234.5")]
    got = ev(spark, [xl.text(F.lit(v), f) for (v, f), _ in cases])
    assert got == [e for _, e in cases]


def test_value(spark):
    cases = [("42", 42.0), ("3.14", 3.14), ("1,234", 1234.0), ("$99.99", 99.99), ("50%", 50.0),
             ("not a number", None), ("10.0", 10.0), ("1d", None), (" 7 ", 7.0)]
    got = ev(spark, [xl.value(F.lit(v)) for v, _ in cases])
    assert got == [e for _, e in cases]


def test_textjoin_proper_char_clean(spark):
    got = ev(spark, [
        xl.textjoin(", ", True, "a", "b", "c"), xl.textjoin(", ", True, "a", "", "c"),
        xl.textjoin(", ", False, "a", "", "c"), xl.textjoin("", True, "a", "b", "c"), xl.textjoin("-", True, "only"),
        xl.textjoin(", ", True, "", "", ""), xl.textjoin(", ", "TRUE", "a", "", "c"),
        xl.proper(F.lit("hello world")), xl.proper(F.lit("HELLO")), xl.proper(F.lit("hElLo WoRlD")),
        xl.proper(F.lit("integra")), xl.proper(F.lit("they're o-k 2nd")),
        xl.char(F.lit(65)), xl.char(F.lit(97)), xl.char(F.lit(10)), xl.char(F.lit(32)), xl.char(F.lit("abc")),
        xl.char(F.lit(0x1F600)), xl.char(F.lit(-1)), xl.char(F.lit(0xD800)),
        xl.clean(F.lit("hello\x01world")), xl.clean(F.lit("a\x00b")), xl.clean(F.lit("normal text")),
        xl.clean(F.lit("\x01\x02clean\x1f")),
    ])
    assert got == ["a, b, c", "a, c", "a, , c", "abc", "only", "", "a, c",
                   "Hello World", "Hello", "Hello World", "Integra", "They'Re O-K 2Nd",
                   "A", "a", "\n", " ", "", "\U0001F600", "", "",
                   "helloworld", "ab", "normal text", "clean"]


def test_headers(spark):
    cases = [("Powertrain ID (Key)", "Powertrain ID (Key)"), ("Revision Date (this is a hint)", "Revision Date"),
             ("Name (hint1) (hint2)", "Name"), ("(hint) Revision Date", "(hint) Revision Date"),
             ("Type (Drop)", "Type"), ("Details (Modal Copy)", "Details"),
             ("Net weight (as sold) (kg)", "Net weight"), ("[MAP] basil (fresh only)", "[MAP] basil"),
             ("[MAP] thyme", "[MAP] thyme"), ("[MAP] bay-leaf (dried)", "[MAP] bay-leaf"),
             (None, None), ("Unnamed: 0", "Unnamed: 0"), ("Engine", "Engine"), ("Color ID (Key)", "Color ID (Key)"),
             # A hint after (Key) strips both
             ("X (Key) (hint)", "X"), ("[map] a (b) (c)", "[map] a"), ("[MAP] (only)", "[MAP]"),
             ("A (b", "A (b"), ("  spaced  ", "spaced")]
    got = ev(spark, [normalize_header(F.lit(h).cast("string")) for h, _ in cases])
    assert got == [e for _, e in cases]


def test_annotation_parse(spark):
    cases = [(("======\nID#ABC123\nAlexander Wong  (2026-01-01)\nActual comment body", "Alexander Wong"), "Actual comment body"),
             (("John:\nThe real content", "John"), "The real content"), (("plain text", ""), "plain text"),
             (("", ""), ""), (("  x  ", None), "x")]
    got = ev(spark, [tx.parse_annotation(F.lit(t), F.lit(a).cast("string")) for (t, a), _ in cases])
    assert got == [e for _, e in cases]


def test_clean_value_and_strip(spark):
    got = ev(spark, [tx.clean_value(F.lit(None).cast("string")), tx.clean_value(F.lit("  hello  ")),
                     tx.clean_value(F.lit(42)), tx.clean_value(F.lit(" x\x1c　")), tx.clean_value(F.lit("a b"))])
    assert got == ["", "hello", "42", "x", "a b"]


def test_slugify(spark):
    cases = [("Hello World", "hello-world"), ("My Model Name!", "my-model-name"), ("A   B", "a-b"),
             ("Hello   World--Test", "hello-world-test"), ("  - hello - ", "hello"), ("Model 3", "model-3"),
             ("my-slug", "my-slug"), ("", ""), ("Café Crème", "café-crème"), ("a_b", "a-b")]
    got = ev(spark, [tx.slugify(F.lit(v)) for v, _ in cases])
    assert got == [e for _, e in cases]


def test_get_type(spark):
    cases = [("", "string"), ("42", "number"), ("3.14", "number"), ("yes", "boolean"), ("✓", "boolean"),
             ("hello", "string"), ("1,2,3", "number"), (",5", "number"), ("1e5", "string"), ("+5", "string"),
             (".5", "string"), ("5.", "string"), ("50%", "string"), ("-7", "number"), ("TRUE", "boolean"),
             ("  no ", "boolean"), ("1,234.50", "number")]
    got = ev(spark, [tx.get_type(F.lit(v)) for v, _ in cases])
    assert got == [e for _, e in cases]


def test_regex_capture(spark):
    got = ev(spark, [tx.regex_capture(F.lit("Size: 42 cm"), r"(\d+)"), tx.regex_capture(F.lit("  none  "), r"(\d+)"),
                     tx.regex_capture(F.lit("ab"), r"(x)?b"), tx.regex_capture(F.lit("a\nb"), r"(a.b)")])
    assert got == ["42", "none", "", "a\nb"]


def test_jq_steps(spark):
    url = F.lit("https://Ex.COM/a?q=1")
    got = ev(spark, [
        tx.jq_text(url, [("split", "/"), ("index", 2), ("ascii_downcase",)]),
        tx.jq_text(F.lit("a"), [("split", "?"), ("index", 1), ("ascii_upcase",)]),
        tx.jq_text(F.lit("hello"), [("null",)]),
        tx.jq_text(F.lit("a|b"), [("split", "|")]),
        tx.jq_text(F.lit(" x "), [("ltrimstr", " "), ("rtrimstr", " ")]),
        tx.jq_text(F.lit("abc"), [("test", "b")]),
        tx.jq_text(F.lit("v"), [("wrap",)]),
        tx.jq_text(F.lit("a/b/c"), [("split", "/"), ("index", -1)]),
        tx.jq_text(F.lit("a/b"), [("split", "/"), ("index", 5)]),
    ])
    assert got == ["ex.com", "#ERR:ValueError", "", '["a", "b"]', "x", "True", '["v"]', "c", ""]


def test_json_promote_and_strict(spark):
    vals = ['{"a": 1}', '[1, 2]', '[bad', '42', 'true', '{"k": 1} trailing', '  {"x": [1]}']
    got = ev(spark, [F.to_json(F.struct(tx.json_promote(F.lit(v)).alias("v"))) for v in vals])
    assert got == ['{"v":{"a":1}}', '{"v":[1,2]}', '{"v":"[bad"}', '{"v":"42"}', '{"v":"true"}',
                   '{"v":"{\\"k\\": 1} trailing"}', '{"v":{"x":[1]}}']


def test_python_named_groups(spark):
    got = ev(spark, [tx.regex_capture(F.lit("ID 2024-2024"), r"(?P<y>\d{4})-(?P=y)")])
    assert got == ["2024"]


def test_plan_time_checks(spark):
    import pytest

    with pytest.raises(ValueError):
        tx.regex_capture(F.lit("x"), r"\d+")  # no capture group (T13)
    assert ev(spark, [xl.value(F.lit("inf")), xl.value(F.lit("nan")), xl.value(F.lit("1e3"))]) == [None, None, 1000.0]


def test_fromjson_steps(spark):
    doc = F.lit('{"k": 69, "a": {"b": "x"}, "l": [1, 2]}')
    got = ev(spark, [
        tx.jq_text(doc, [("fromjson",), ("get", "$.k")]),
        tx.jq_text(doc, [("fromjson",), ("get", "$.a.b")]),
        tx.jq_text(doc, [("fromjson",), ("get", "$.l")]),
        tx.jq_text(doc, [("fromjson",), ("get", "$.missing")]),
        tx.jq_text(F.lit("{bad"), [("fromjson",)]),
    ])
    assert got == ["69", "x", "[1,2]", "", "#ERR:ValueError"]
