import numpy as np

from sheetdoc.llm import embedding_dedup as E


def brute(rows, least=0.9):
    unit = []
    for _, v in rows:
        a = None if v is None or not len(v) or any(c is None for c in v) else np.array(v, np.float64)
        unit.append(a / np.linalg.norm(a) if a is not None and np.isfinite(a).all() and a.any() else None)
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least:
                n[a] += 1
                n[b] += 1
                root[max(find(a), find(b))] = min(find(a), find(b))
    name = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            name[find(a)] = min(name.get(find(a), i), i)
    return [(i, n[a], name.get(find(a))) for a, (i, _) in enumerate(rows)]


def vectors():
    r = np.random.default_rng(5)
    rows = []
    for c in range(12):
        centre = r.normal(size=24)
        for m in range([1, 2, 30][c % 3]):
            rows.append((centre + r.normal(size=24) * 0.08).tolist())
    rows += [r.normal(size=24).tolist() for _ in range(150)]
    rows += [rows[0]] * 4 + [r.normal(size=7).tolist()] * 2
    rows += [None, [], [0.0] * 24, [float("nan")] * 24, [1.0, float("inf")] * 12, [None] + [1.0] * 23]
    return [(i, v) for i, v in enumerate(rows)] + [(None, rows[0]), (3, rows[3]), (None, None)]


def test_against_brute_force(spark, monkeypatch):
    rows = vectors()
    frame = spark.createDataFrame([(i, v, "l", "b") for i, v in rows], "vec_id long, embedding array<float>, label string, bucket string")
    narrow = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    want = brute(narrow)
    for block in (1024, 8):  # whole buckets, and buckets dealt into blocks
        monkeypatch.setattr(E, "BLOCK", block)
        got = E.near_duplicates(frame).collect()
        assert len(got) == len(rows)
        assert sum(r.n_links for r in got) >= 0.98 * sum(n for _, n, _ in want)
        exact = sorted((repr((r.vec_id, r.n_links, r.component_id)) for r in got))
        assert len(set(exact) & set(map(repr, want))) >= 0.97 * len(set(exact))
        assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_no_links_below_the_threshold(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.9, 0.43588989435]), (3, [0.89, 0.455960525])]
    got = {r.vec_id: r.n_links for r in E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: 1, 2: 2, 3: 1} or got == {1: 0, 2: 1, 3: 1}
    assert E.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_buckets_do_not_depend_on_how_many_vectors_there_are(spark, monkeypatch):
    """However few or many objects there are, the same vectors meet: no size names the hash settings."""
    rows = [(i, v) for i, v in vectors() if i is not None]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    functions = []
    probes = E._coder
    monkeypatch.setattr(E, "_coder", lambda *settings: functions.append(settings) or probes(*settings))
    want = sorted(map(repr, E.near_duplicates(frame).collect()))
    monkeypatch.setattr(E, "TWO_FUNCTIONS", 1, raising=False)  # objects beyond which other settings were taken
    assert sorted(map(repr, E.near_duplicates(frame).collect())) == want
    assert functions[0] == functions[1] == (E.FUNCTIONS, E.TABLES, E.LOOKED)


def test_hadamard_is_orthonormal():
    x = np.random.default_rng(0).normal(size=(5, 32))
    y = E._hadamard(x)
    assert np.allclose(x @ x.T, y @ y.T) and np.allclose(E._hadamard(y), x)
