"""Hard negatives by inner product, found in cover trees over norm-augmented candidates.

Rows are (id, label, whole-number vector). An anchor's positives are its ``positives`` highest
scoring other rows of its label; for each, the ``negatives`` highest scoring rows of other labels
whose score lies in a window given by the positive's score. Ties go to the smaller id.

A candidate x gets one more coordinate, sqrt(M^2 - |x|^2), so that all candidates lie on a sphere of
radius M and the highest inner product with q = (q, 0) is the smallest angle. Candidates are dealt
into blocks by a hash, whatever their labels, so a frequent label burdens no task. Each block is a
cover tree: a node's children are chosen greedily with the next smaller covering radius, so that they
cover all its points and keep that far apart.
A node knows the centre c and the covering radius of its points, as an angle rho. With theta
the angle of q and c, every point below scores between |q| M cos(theta + rho) and
|q| M cos(theta - rho). A search descends best bound first, for all anchors of a chunk
at once; an anchor leaves a node when the node's bounds lie outside its windows or below what it has
found. Leaves are verified with exact whole-number scores and by label, so results do not depend on
the tree.

Every block of candidates meets every chunk of anchors in a task of its own (a stated query set
against all rows); trees are built once and staged. Results of blocks are merged by rank limits that
Spark applies before and after the shuffle.

Rows with a null id, label or vector or with a null or non-finite component take no part; equal rows
count once. Scores of vectors of unequal lengths are not defined, so these never meet. Rows of the
same id with other labels or vectors are rows of their own; ties between them go by a hash of the
row. Components of 2^500 and more after scaling take no part either, and pairs whose score does not fit
64 bits do not count. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetdoc.llm.common import bound_batches, stage

#: Candidates of a block, about, and anchors of a chunk, about.
BLOCK, CHUNK = 8192, 2048
#: Points that a node needs to be divided, and the step from a covering radius to the next.
LEAF, SHRINK = 48, 0.8
#: Sums of whole numbers below this are exact in doubles; greater components than HUGE take no part.
EXACT, HUGE = 2.0**53, 2.0**500


@dataclass
class CoverTree:
    """Points in the order of their leaves. Node k has points ``lo[k]:hi[k]``, a ``centre`` (the
    place of one of them), a covering radius ``rho`` (an angle), and children ``first[k]:last[k]``
    (none in a leaf)."""

    points: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    ties: np.ndarray
    radius: float
    centre: np.ndarray
    rho: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @classmethod
    def build(cls, points: np.ndarray, labels: np.ndarray, ids: np.ndarray, ties: np.ndarray) -> CoverTree:
        n = len(points)
        scale = float(np.abs(points).max(initial=0)) or 1.0
        x = points / scale
        squares = (x * x).sum(axis=1)
        radius = float(np.sqrt(squares.max(initial=0))) or 1.0
        unit = np.concatenate((x, np.sqrt(np.maximum(radius * radius - squares, 0))[:, None]), axis=1) / radius
        order = np.arange(n)
        nodes: list[list] = []  # centre, rho, lo, hi, first, last

        def add(lo: int, hi: int, centre: int) -> int:
            far = np.arccos(np.clip(unit[order[lo:hi]] @ unit[centre], -1, 1))
            nodes.append([centre, float(far.max()), lo, hi, 0, 0])
            return len(nodes) - 1

        todo = [add(0, n, 0)] if n else []
        while todo:
            k = todo.pop()
            _, rho, lo, hi, _, _ = nodes[k]
            if hi - lo <= LEAF or rho < 1e-7:
                continue
            cover = rho * SHRINK
            # greedy cover: the first point not covered yet becomes a centre and takes what it covers
            mine, left, parts = order[lo:hi], np.arange(hi - lo), []
            while len(left):
                centre = mine[left[0]]
                near = unit[mine[left]] @ unit[centre] >= np.cos(cover)
                near[0] = True
                parts.append((centre, mine[left[near]]))
                left = left[~near]
            if len(parts) == 1:  # rounding: nothing was divided
                continue
            order[lo:hi] = np.concatenate([p for _, p in parts])
            nodes[k][4], at = len(nodes), lo
            # neighbouring small parts of one level share a node around the first of their centres
            run: list[tuple[int, np.ndarray]] = []
            for part in [*parts, None]:
                if part is not None and (not run or sum(len(p) for _, p in run) + len(part[1]) <= LEAF):
                    run.append(part)
                    continue
                size = sum(len(p) for _, p in run)
                todo.append(add(at, at + size, run[0][0]))
                at += size
                run = [part] if part is not None else []
            nodes[k][5] = len(nodes)
            if nodes[k][5] - nodes[k][4] == 1:  # one child is the node itself
                nodes[k][4] = nodes[k][5] = 0
                todo.pop()
                nodes.pop()
        centre, *rest = (np.array([node[i] for node in nodes]) for i in range(6))
        narrow = np.int16 if scale < 2**15 else np.float64  # as it travels; scores are exact either way
        return cls(points[order].astype(narrow), labels[order], ids[order], ties[order], radius * scale,
                   np.argsort(order)[centre] if n else centre, *rest)

    def bounds(self, units: np.ndarray, norms: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible scores of anchors (rows) with the points of ``nodes``."""
        centres = self.points[self.centre[nodes]].astype(np.float64) / self.radius
        theta = np.arccos(np.clip(units @ centres.T, -1, 1))
        reach = (norms * self.radius)[:, None]
        slack = reach * 1e-6 + 1e-6  # rounding
        high = reach * np.cos(np.maximum(theta - self.rho[nodes], 0)) + slack
        low = reach * np.cos(np.minimum(theta + self.rho[nodes], np.pi)) - slack
        return low, high


def exact_scores(anchors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly: in doubles where they fit, else in integers."""
    most = float(np.abs(anchors).max(initial=0)) * float(np.abs(points).max(initial=0)) * max(1, points.shape[1])
    if most < EXACT:
        return anchors @ points.T
    whole = np.vectorize(int, otypes=[object])
    return whole(anchors) @ whole(points).T if anchors.size and points.size else np.zeros((len(anchors), len(points)))


class Best:
    """The ``k`` highest scores of each slot, ties by smaller id, then tie number."""

    def __init__(self, slots: int, k: int) -> None:
        self.k = k
        self.slot, self.score, self.id, self.tie = (np.empty(0, t) for t in (np.int64, object, np.int64, np.int64))
        self.least = np.full(slots, -np.inf)  # scores from here on can enter a slot

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, ties: np.ndarray) -> None:
        touched = np.isin(self.slot, slot)
        s, v = np.concatenate((self.slot[touched], slot)), np.concatenate((self.score[touched], score))
        i, t = np.concatenate((self.id[touched], ids)), np.concatenate((self.tie[touched], ties))
        by = np.lexsort((t, i, -v, s))
        s, v, i, t = s[by], v[by], i[by], t[by]
        rank = np.arange(len(s)) - np.searchsorted(s, s)
        keep = rank < self.k
        last = rank == self.k - 1
        self.least[s[last]] = np.nextafter(v[last].astype(float), -np.inf)  # at most the k-th score
        rest = ~touched
        self.slot, self.score = np.concatenate((self.slot[rest], s[keep])), np.concatenate((self.score[rest], v[keep]))
        self.id, self.tie = np.concatenate((self.id[rest], i[keep])), np.concatenate((self.tie[rest], t[keep]))


def search(tree: CoverTree, anchors: np.ndarray, labels: np.ndarray, own: np.ndarray, lows: np.ndarray, highs: np.ndarray, k: int, same: bool) -> Best:
    """The ``k`` best points for every anchor and window (slot = anchor * windows + window), of the
    anchor's label (``same``; its own row, by tie number, left out) or of any other. ``lows`` and
    ``highs`` (anchors x windows) are the windows' ends, both included."""
    m, windows = lows.shape
    best = Best(m * windows, k)
    if not m or not len(tree.ids):
        return best
    norms = np.sqrt((anchors * anchors).sum(axis=1))
    units = anchors / np.maximum(norms, 1e-300)[:, None]

    def wanted(who: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Anchors for which a node with these bounds can still hold a result."""
        least = np.maximum(lows[who], best.least.reshape(m, windows)[who])
        return ((high[:, None] >= least) & (low[:, None] <= highs[who])).any(axis=1)

    everyone = np.arange(m)
    low, high = tree.bounds(units, norms, np.array([0]))
    queue = [(-float(high.max()), 0, everyone, low[:, 0], high[:, 0])]
    while queue:
        _, node, who, low, high = heapq.heappop(queue)
        on = wanted(who, low, high)
        who = who[on]
        if not len(who):
            continue
        if tree.last[node] > tree.first[node]:
            children = np.arange(tree.first[node], tree.last[node])
            lo, hi = tree.bounds(units[who], norms[who], children)
            for j, child in enumerate(children):
                on = wanted(who, lo[:, j], hi[:, j])
                if on.any():
                    heapq.heappush(queue, (-float(hi[on, j].max()), int(child), who[on], lo[on, j], hi[on, j]))
            continue
        a, b = tree.lo[node], tree.hi[node]
        score = exact_scores(anchors[who], tree.points[a:b].astype(np.float64))
        least = np.maximum(lows[who], best.least.reshape(m, windows)[who])
        eligible = (tree.labels[a:b][None, :] == labels[who][:, None]) == same
        if same:
            eligible &= tree.ties[a:b][None, :] != own[who][:, None]
        fits = eligible[:, None, :] & (score[:, None, :] >= least[:, :, None]) & (score[:, None, :] <= highs[who][:, :, None])
        r, w, p = np.nonzero(fits)
        if len(r):
            best.add(who[r] * windows + w, score[r, p], tree.ids[a:b][p], tree.ties[a:b][p])
    return best


# --- Spark ---------------------------------------------------------------------------------------

def prepare(rows: DataFrame, label: Column, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """Rows that take part: id, label, vector (components floor(scale * x), as doubles) and a tie
    number; equal rows once."""
    scaled = F.transform(F.col(f"`{vector}`").cast("array<double>"), lambda x: x * F.lit(float(scale)))
    fit = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(HUGE)))
    # from 2^53 on doubles are whole
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < F.lit(EXACT), F.floor(x).cast("double")).otherwise(x))
    out = rows.select(F.col(f"`{key}`").cast("long").alias("id"), label.cast("long").alias("label"), F.when(fit, whole).alias("vector"))
    out = out.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").distinct()
    return out.withColumn("tie", F.xxhash64("id", "label", "vector"))


_KEYS = ["dim", "block", "chunk"]
_LONG = np.nextafter(2.0**63, 0)


def _vectors(part: pd.DataFrame) -> np.ndarray:
    return np.array(part["vector"].tolist(), np.float64).reshape(len(part), int(part["dim"].iloc[0]))


def _whole(part: pd.DataFrame, column: str) -> np.ndarray:
    return part[column].to_numpy(np.int64)


def _trees(rows: DataFrame) -> DataFrame:
    """A pickled cover tree for each block (dim, block) of ``rows``."""
    def plant(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["id", "tie"])
        tree = CoverTree.build(_vectors(part), *(_whole(part, c) for c in ("label", "id", "tie")))
        return pd.DataFrame({"dim": part["dim"].iloc[:1], "block": part["block"].iloc[:1], "chunks": part["chunks"].iloc[:1], "tree": [pickle.dumps(tree)]})

    return rows.groupBy("dim", "block").applyInPandas(plant, "dim int, block long, chunks long, tree binary")


def _meet(trees: DataFrame, anchors: DataFrame, run: Callable[[CoverTree, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``run`` on each tree with each chunk of anchors of the same length."""
    grown = trees.select("dim", "block", F.explode(F.expr("sequence(0L, chunks - 1)")).alias("chunk"), "tree").where("chunks > 0")
    asked = anchors.withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))

    def task(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):  # a chunk number that no anchor has
            return pd.DataFrame({c.split()[0]: np.empty(0, np.int64) for c in schema.split(", ")})
        return run(pickle.loads(left["tree"].iloc[0]), right)

    return grown.groupBy(*_KEYS).cogroup(asked.groupBy(*_KEYS)).applyInPandas(task, schema)


def _table(best: Best, extra: dict[str, np.ndarray]) -> pd.DataFrame:
    """Results with ``extra`` columns by slot."""
    return pd.DataFrame({**{k: v[best.slot] for k, v in extra.items()}, "other": best.id, "other_tie": best.tie,
                         "score": np.array([int(s) for s in best.score], np.int64)})


def _top(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """The ``k`` best rows of each key, ranked from 1; Spark limits ranks before the shuffle, too."""
    best = Window.partitionBy(*by).orderBy(F.desc("score"), "other", "other_tie")
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95) -> DataFrame:
    """Hard negatives for the anchors among ``rows`` (as ``prepare`` returns them): anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score, where
    ``least * positive_score <= 100 * negative_score <= most * positive_score``."""
    spark = rows.sparkSession
    bound_batches(spark)
    rows = stage(rows.withColumn("dim", F.size("vector")).withColumn("is_anchor", F.coalesce(is_anchor, F.lit(False))), "negatives-rows")
    # one row for each length of vectors: bounded by the longest
    sizes = rows.groupBy("dim").agg(
        F.ceil(F.count("*") / F.lit(BLOCK)).cast("long").alias("blocks"), F.ceil(F.count_if("is_anchor") / F.lit(CHUNK)).cast("long").alias("chunks"))
    dealt = rows.join(F.broadcast(sizes), "dim")
    trees = stage(_trees(dealt.withColumn("block", F.pmod(F.xxhash64("tie"), F.col("blocks"))).drop("blocks", "is_anchor")), "negatives-trees")
    anchors = stage(dealt.where("is_anchor").withColumn("chunk", F.pmod(F.xxhash64("tie"), F.col("chunks"))).drop("chunks", "is_anchor"), "negatives-anchors")

    def find_positives(tree: CoverTree, part: pd.DataFrame) -> pd.DataFrame:
        ends, who = np.full((len(part), 1), _LONG), _whole(part, "tie")
        return _table(search(tree, _vectors(part), _whole(part, "label"), who, -ends, ends, positives, True), {"anchor": who})

    found = _meet(trees, anchors, find_positives, "anchor long, other long, other_tie long, score long")
    pairs = stage(_top(found, ["anchor"], positives), "negatives-positives")
    windows = pairs.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("positives"))  # at most ``positives`` each
    asked = stage(anchors.join(windows, anchors["tie"] == windows["anchor"]).drop("anchor"), "negatives-asked")

    def find_negatives(tree: CoverTree, part: pd.DataFrame) -> pd.DataFrame:
        lows, highs = np.full((len(part), positives), np.inf), np.full((len(part), positives), -np.inf)
        if any(abs(int(p["score"])) >= EXACT for row in part["positives"] for p in row):
            lows, highs = lows.astype(object), highs.astype(object)
        for i, row in enumerate(part["positives"]):
            for j, p in enumerate(row):  # ends as whole numbers
                lows[i, j], highs[i, j] = -(-least * int(p["score"]) // 100), most * int(p["score"]) // 100
        who = _whole(part, "tie")
        best = search(tree, _vectors(part), _whole(part, "label"), who, lows, highs, negatives, False)
        return _table(best, {"anchor": np.repeat(who, positives), "positive": np.tile(np.arange(1, positives + 1), len(part))})

    hits = _top(_meet(trees, asked, find_negatives, "anchor long, positive long, other long, other_tie long, score long"), ["anchor", "positive"], negatives)
    of = pairs.select("anchor", F.col("rank").cast("long").alias("positive"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    return hits.join(of, ["anchor", "positive"]).join(anchors.select(F.col("tie").alias("anchor"), F.col("id").alias("anchor_id")), "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
