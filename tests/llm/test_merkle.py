import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sheetdoc.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, root string, leaf long, pos int, tree string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded) of each row, by recursion on lists."""
    def written(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return h("".join(map(written, (*r[:4], text))))

    def climb(nodes):
        """Root, and each node's steps: (siblings before, siblings after)."""
        steps, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
        while len(level) > 1:
            runs = [level[i : i + 16] for i in range(0, len(level), 16)]
            for k, i in enumerate(at):
                steps[k].append((runs[i // 16][: i % 16], runs[i // 16][i % 16 + 1 :]))
                at[k] = i // 16
            level = [h("".join(r)) for r in runs]
        return (level[0] if level else None), steps

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0], leaf(r, r[4]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: climb([x[1] for x in groups[s]]) for s in names}
    root, above = climb([trees[s][0] for s in names])
    out = []
    for s, upper in zip(names, above, strict=True):
        for (key, own, r), steps in zip(groups[s], trees[s][1], strict=True):
            low = r[4] is not None and key is not None and zlib.crc32(str(key).encode()) % 5 == 0
            d = leaf(r, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])) if low else own
            proof = ""
            for before, after in steps + upper:
                d = h("".join(before) + d + "".join(after))
                proof += "".join(before + after)
            out.append((key, own, trees[s][0], root, h(proof), d, d == root))
    return out


def proved(spark, rows, **kw):
    full = [(*r, "x", 1, 2, "t") for r in rows]
    docs = spark.createDataFrame(full, SCHEMA)
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    m = merkle.build(docs, changed={"text": F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, low)})
    return merkle.prove(m, **kw)


def key(r):
    return tuple((x is not None, x) for x in r)


ODD = [
    (None, None, None, None, None), (None, "b", "de", 1, "A"), (3, "b", "de", 1, "A"), (3, "b", "de", 1, "A"), (3, "b", None, 1, "Z"),
    (4, "", "", 0, ""), (5, "", None, None, None), (6, "é", "fr", 9, "É ABC" * 30_000), (2**60 + 1, "b", "x", 2, "Q"),
]


@pytest.mark.parametrize("size", [0, 1, 9, 40, 9000])
def test_equals_plain_recursion(spark, size):
    r = random.Random(size)
    rows = [] if size == 0 else ODD[:1] if size == 1 else list(ODD)
    for i in range(size - len(rows)):
        rows.append((i, "hot" if i % 3 else r.choice(["a", "b", "c", None]), r.choice(["de", None]), i, r.choice(["Ab c", "x", ""]) + str(i) if i % 7 else None))
    r.shuffle(rows)
    got = [tuple(x)[:1] + tuple(x)[2:] for x in proved(spark, rows).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_many_groups(spark):
    rows = [(i, f"s{i % 4500:05d}", "de", i, f"T{i}") for i in range(4600)]
    got = [tuple(x)[:1] + tuple(x)[2:] for x in proved(spark, rows).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_siblings_fold_to_the_root(spark):
    rows = [(i, "ab"[i % 2], "de", i, f"T {i}") for i in range(600)]
    for x in proved(spark, rows, siblings=True).collect():
        assert merkle.fold(x.leaf, x.at, x.beside) == x.root
        assert h("".join(x.beside)) == x.proof_sha256


def test_query_is_registered():
    from sheetdoc.llm.queries import ORACLE, QUERIES

    assert "op11_merkle_manifest" in QUERIES and "op11_merkle_manifest" in ORACLE
