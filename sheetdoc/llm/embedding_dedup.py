"""Embedding near-duplicates by cross-polytope hashing.

A vector is padded to a power of two, rotated by three rounds of random signs and a fast Hadamard
transform, and hashed to the signed axis that it lies nearest to. FUNCTIONS such hashes make a
table's bucket; besides its own bucket a vector probes the next most likely ones. Vectors that meet
(one's own bucket is the other's own or probed bucket) are compared by cosine in double precision,
and only pairs at or above the threshold count. A pair is counted in the first table and bucket in
which it meets, so nothing has to be made distinct afterwards.

Equal vectors are one object with a weight. A bucket with many objects is dealt into blocks, and
every two blocks of it meet in a task of bounded size. Tasks return link counts and a spanning set
of links, never all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetdoc.llm.common import stage
from sheetdoc.llm.graph import components

#: Hash functions of a table, tables, and buckets looked at in each: the same for every input, so
#: whether two vectors meet depends on them alone. Simulated recall of pairs at cosine 0.9 in 64
#: dimensions: 0.998; more above.
FUNCTIONS, TABLES, LOOKED = 2, 8, 3
#: Ranks of each function's axes that probes are combined from.
RANKS = 4
#: Objects of a block of a large bucket, and placed rows (about) that one task group holds.
BLOCK, GROUP_ROWS = 1024, 20_000


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised fast Hadamard transform of each row; the length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate((x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]), axis=2)
        h *= 2
    return x.reshape(n, d) / math.sqrt(d)


def probes(x: np.ndarray, functions: int, tables: int, looked: int) -> np.ndarray:
    """Bucket numbers of each row of ``x``: ``tables`` times ``looked``, the own bucket first."""
    n, d = x.shape
    width = 1 << max(1, (d - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - d)))
    combos = np.stack(np.meshgrid(*[np.arange(RANKS)] * functions, indexing="ij"), -1).reshape(-1, functions)
    out = np.empty((n, tables, looked), np.int64)
    for t in range(tables):
        cost, code = np.zeros((n, len(combos))), np.full((n, len(combos)), t, np.int64)
        for f in range(functions):
            signs = np.random.default_rng([d, t, f]).choice([-1.0, 1.0], (3, width))
            y = x
            for s in signs:
                y = _hadamard(y * s)
            both = np.concatenate((y, -y), axis=1)
            near = np.argsort(-both, axis=1, kind="stable")[:, :RANKS]
            value = np.take_along_axis(both, near, axis=1)
            cost += ((value[:, :1] - value) ** 2)[:, combos[:, f]]
            code = code * (2 * width) + near[:, combos[:, f]]
        first = np.argsort(cost, axis=1, kind="stable")[:, :looked]
        out[:, t] = np.take_along_axis(code, first, axis=1)
    return out.reshape(n, tables * looked)


def _coder(functions: int, tables: int, looked: int):
    @F.pandas_udf("unit binary, codes array<long>")
    def code(vectors: pd.Series) -> pd.DataFrame:
        units, codes = [b""] * len(vectors), [[]] * len(vectors)
        sizes = np.array([len(v) for v in vectors])
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            x = np.array([vectors.iloc[i] for i in at], np.float64)
            x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow of squares
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            for i, u, c in zip(at, x, probes(x, functions, tables, looked), strict=True):
                units[i], codes[i] = u.tobytes(), c.tolist()
        return pd.DataFrame({"unit": units, "codes": codes})

    return code


def _first_meeting(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table and bucket in which the pairs of code rows (pairs, tables, looked) meet first; of two
    buckets in that table the one with the smaller number."""
    own_a, own_b = a[:, :, :1], b[:, :, :1]
    at_a, at_b = (own_a == b).any(axis=2), (own_b == a).any(axis=2)
    table = (at_a | at_b).argmax(axis=1)
    rows = np.arange(len(a))
    most = np.iinfo(np.int64).max
    bucket = np.minimum(
        np.where(at_a[rows, table], a[rows, table, 0], most), np.where(at_b[rows, table], b[rows, table, 0], most),
    )
    return table, bucket


def _compare(tables: int, looked: int, least: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["dim", "bucket"], kind="stable")
        bucket, dim = rows["bucket"].to_numpy(), rows["dim"].to_numpy()
        cuts = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(dim) != 0)) + 1
        x, weight, home, block = (rows[c].to_numpy() for c in ("x", "copies", "home", "block"))
        table, codes, units = rows["table"].to_numpy(), rows["codes"].to_numpy(), rows["unit"].to_numpy()
        crossing = rows["first"].iloc[0] != rows["second"].iloc[0]
        out: list[tuple] = []
        for lo, hi in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            if hi - lo < 2 or not home[lo:hi].any():
                continue
            unit = np.frombuffer(b"".join(units[lo:hi]), np.float64).reshape(hi - lo, -1)
            close = np.triu(unit @ unit.T >= least, 1) & (home[lo:hi, None] | home[None, lo:hi])
            if crossing:
                close &= block[lo:hi, None] != block[None, lo:hi]
            i, j = np.nonzero(close)
            if not len(i):
                continue
            own = np.stack(codes[lo:hi]).reshape(hi - lo, tables, looked)
            keep = np.zeros(len(i), bool)
            for s in range(0, len(i), 50_000):
                part = slice(s, s + 50_000)
                t, b = _first_meeting(own[i[part]], own[j[part]])
                keep[part] = (t == table[lo]) & (b == bucket[lo])
            i, j = i[keep], j[keep]
            n = np.bincount(i, weight[lo:hi][j], hi - lo) + np.bincount(j, weight[lo:hi][i], hi - lo)
            out += [(int(x[lo + k]), None, int(n[k])) for k in np.flatnonzero(n)]
            label = np.arange(hi - lo)
            while True:  # least position reachable: one link from each object to its own
                before = label.copy()
                both = np.minimum(label[i], label[j])
                np.minimum.at(label, i, both)
                np.minimum.at(label, j, both)
                if (before == label).all():
                    break
            out += [(int(x[lo + k]), int(x[lo + label[k]]), 0) for k in np.flatnonzero(label != np.arange(hi - lo))]
        return pd.DataFrame({
            "a": pd.array([o[0] for o in out], "Int64"), "b": pd.array([o[1] for o in out], "Int64"), "n": pd.array([o[2] for o in out], "Int64"),
        })

    return run


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.9) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row: how many other rows have a cosine of
    at least ``least`` with it, the least id that links lead to (its own included), and whether
    that is its own.

    A null, empty or zero vector and one with null or non-finite components links with nothing.
    Vectors of different lengths do not link. Repeated rows link with each other. Rows without an
    id take part; a component takes its name from the ids that are there. No rows give no rows."""
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    sound = F.coalesce((F.size("v") > 0) & ~bad & F.exists("v", lambda c: c != 0.0), F.lit(False))
    rows = rows.withColumn("key", F.when(sound, F.md5(F.col("v").cast("string"))))
    classes = rows.where("key IS NOT NULL").groupBy("key").agg(
        F.first("v").alias("v"), F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"),
    ).withColumn("x", F.monotonically_increasing_id())
    classes = stage(classes, "vectors")
    tables, looked = TABLES, LOOKED
    coded = stage(
        classes.select("x", "copies", F.size("v").alias("dim"), _coder(FUNCTIONS, tables, looked)("v").alias("c"))
        .select("x", "copies", "dim", "c.unit", "c.codes"), "vector-codes",
    )
    placed = coded.select("*", F.posexplode("codes").alias("slot", "bucket")).select(
        "*", (F.col("slot") % looked == 0).alias("home"), F.floor(F.col("slot") / looked).cast("int").alias("table"),
    )
    sizes = placed.groupBy("dim", "bucket").agg(F.sum(F.col("home").cast("long")).alias("homes"), F.count(F.lit(1)).alias("all")).where("homes > 0 AND all > 1")
    sizes = stage(sizes.select("dim", "bucket", F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"), "all"), "vector-buckets")
    rows_there = sizes.agg(F.sum("all")).first()[0] or 0
    groups = max(1, rows_there // GROUP_ROWS)
    dealt = (
        placed.join(sizes, ["dim", "bucket"])
        .withColumn("block", F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other"))
        .withColumn("grp", F.pmod(F.xxhash64("bucket"), F.lit(groups)))
        .select("grp", "first", "second", "dim", "bucket", "table", "home", "block", "x", "copies", "unit", "codes")
    )
    found = stage(dealt.groupBy("grp", "first", "second").applyInPandas(_compare(tables, looked, least), "a long, b long, n long"), "vector-links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("x")).agg(F.sum("n").alias("n"))
    comps = components(found.where("b IS NOT NULL")).withColumnRenamed("node", "x")
    named = classes.select("key", "x", "id", "copies").join(comps, "x", "left").join(counts, "x", "left").withColumn("component", F.coalesce("component", "x"))
    ids = named.groupBy("component").agg(F.min("id").alias("component_id"))
    of_class = named.join(ids, "component").select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = rows.where("key IS NOT NULL").select("id", "key").join(of_class, "key").select("id", "n_links", "component_id")
    alone = rows.where("key IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionAll(alone).select(
        F.col("id").alias(vec_id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
