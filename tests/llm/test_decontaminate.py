import re

from llm_rows import ODD, frame

from sheetdoc.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[a : a + n]), set()).update([] if i is None else [i])
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in windows:
                    hit.update(range(a, a + n))
                    found |= windows[tuple(w[a : a + n])]
        out.append((i, t, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def test_against_brute_force(spark, documents):
    long = documents[0][1] or documents[1][1]
    items = [(1, long), (2, "one"), (3, " ".join(long.split()[3:30])), (3, "a b c"), (4, None), (5, "..."), (None, "ß é"), (6, "ONE two")]
    rows = documents + ODD + [(800, "x-one, TWO! onetwo"), (801, "Ünï " + long + ". end")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for part in (decontaminate.PART_CHARS, 100):  # one automaton, and several
        got = decontaminate.find_benchmark(frame(spark, rows), bench, part_chars=part).collect()
        mine = sorted(((r.doc_id, r.text, r.benchmark_hits.n_words, r.benchmark_hits.n_hit, list(r.benchmark_hits.items)) for r in got), key=repr)
        assert mine == brute(rows, items)
        for r in got:
            covered = set()
            for s in r.benchmark_hits.spans:
                covered.update(range(s.start, s.end))
            inside = sum(1 for m in WORD.finditer(re.sub("[A-Z]", "a", r.text or "")) if m.start() in covered and m.end() - 1 in covered)
            assert inside == r.benchmark_hits.n_hit


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.find_benchmark(frame(spark, [(1, "a b")]), none).collect()
    assert got[0].benchmark_hits.n_hit == 0 and got[0].benchmark_hits.n_words == 2
    assert decontaminate.find_benchmark(frame(spark, []), none).collect() == []


def test_rule(spark):
    rows = [(1, " ".join(["w"] * 19) + " hit"), (2, " ".join(["w"] * 20) + " hit")]
    bench = spark.createDataFrame([(1, "hit")], "item_id long, text string")
    got = decontaminate.find_benchmark(frame(spark, rows), bench).select("doc_id", decontaminate.is_contaminated().alias("c")).collect()
    assert {r.doc_id: r.c for r in got} == {1: True, 2: False}
