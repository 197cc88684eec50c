import hashlib

from pyspark.sql import functions as F

from sheetdoc.llm import mixing


def brute(rows):
    """(id, source, text) -> {(id, text): (source size, target, copies)} by one queue in memory."""
    size = lambda t: len((t or "").encode().split())
    names = sorted({s for _, s, _ in rows if s is not None}) + [None] * any(s is None for _, s, _ in rows)
    total = sum(size(t) for *_, t in rows)
    own = {n: sum(size(t) for _, s, t in rows if s == n) for n in names}
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, open_ = {}, list(names)
    while open_:
        level = (total - sum(target.values())) / sum(weight[n] for n in open_)
        full = [n for n in open_ if 3 * own[n] <= level * weight[n]]
        if not full:
            target |= {n: level * weight[n] for n in open_}
            break
        target |= {n: 3.0 * own[n] for n in full}
        open_ = [n for n in open_ if n not in full]
    copies = []
    for n in names:
        done = 0
        queue = {}
        for i, s, t in rows:
            if s == n:
                queue.setdefault(hashlib.md5("|".join(["mix", *([str(i)] if i is not None else []), *([t] if t is not None else [])]).encode()).hexdigest(), []).append((i, t))
        for key in sorted(queue):
            done += sum(size(t) for _, t in queue[key])
            for e in range(3):
                copies.append(((done + e * own[n]) / weight[n], names.index(n), key, queue[key]))
    taken, spent = {}, 0
    for *_, group in sorted(copies, key=lambda c: c[:3]):
        spent += sum(size(t) for _, t in group)
        if spent > total:
            break
        for i, t in group:
            taken[i, t] = taken.get((i, t), 0) + (1 if size(t) else 0)
    return {(i, t): (own[s], target[s], min(3, taken.get((i, t), 0))) for i, s, t in rows}


def run(spark, rows):
    docs = spark.createDataFrame([(i, s, t, "old", 1.5) for i, s, t in rows], "doc_id long, source string, text string, block string, mix_finish double")
    sized = docs.withColumn("size", mixing.word_count()).withColumn("key", mixing.shuffle_key())
    return mixing.mix(sized)


def test_against_one_queue(spark, documents):
    rows = [(i, ["a", "b", "c", "a", "a", None, "z"][(i or 0) % 7], t) for i, t in documents]
    rows += [(None, "a", "no id here"), (None, None, None), (5000, "d", None), (5001, "e", "tiny")]
    got = run(spark, rows).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        source_size, target, copies = want[r.doc_id, r.text]
        assert r.mix_source_size == source_size and abs(r.mix_target - target) < 1e-6
        assert r.mix_copies == copies, r.doc_id
    assert [r.block for r in got] == ["old"] * len(rows)


def test_order_repeats_and_empty(spark):
    rows = [(i, "ab"[i % 2], "w " * (1 + i % 5)) for i in range(60)] + [(3, "b", "same same")] * 3
    mixed = run(spark, rows)
    first = mixing.in_mix_order(mixed).select("doc_id", "mix_finish").collect()
    assert [r.mix_finish for r in first] == sorted(r.mix_finish for r in first)
    again = mixing.in_mix_order(run(spark, rows[::-1])).select("doc_id", "mix_finish").collect()
    assert sorted(first) == sorted(again)
    assert len(run(spark, rows).where(F.col("doc_id") == 3).collect()) == 4
    assert run(spark, []).collect() == []
    assert {r.mix_copies for r in run(spark, [(1, "a", None), (2, None, "")]).collect()} == {0}


def test_rows_are_shuffled_once_before_the_sort(spark):
    """The window and the join of whole rows share a shuffle, whatever the planner can broadcast."""
    docs = spark.createDataFrame([(i, "ab"[i % 2] if i % 5 else None, "w " * i) for i in range(40)], "doc_id long, source string, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mixed = mixing.mix(docs.withColumn("size", mixing.word_count()).withColumn("key", mixing.shuffle_key()))
        lines = mixed._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [i for i, line in enumerate(lines) if "SortMergeJoin" in line]
    # the rows are the left side of the first join: from there down to the right side
    right = next(i for i in range(joins[0] + 1, len(lines)) if lines[i].lstrip(" :").startswith("+- Sort") and lines[i].index("+-") == lines[joins[0]].index("+-") + 3)
    assert sum("Exchange hashpartitioning" in line for line in lines[joins[0] : right]) == 1
