"""Merkle manifest of a dataset: digests of rows, folded to one root per group and one over all.

A row's *leaf* is the SHA-256 of its fields, each written as its UTF-8 byte count, ``:`` and its
value, or ``-`` if null. Within a group leaves ascend by id; every 16 neighbours (the last run may
be shorter, even one) become the SHA-256 of their digests, written as hex text, until one node is
left: the group's *subroot* (a lone leaf is its own). The subroots, by group, give the *root* in the
same way.

Positions come from one range sort: each task's rows are numbered where they lie, and the counts
per task and group (never more rows than tasks plus groups) say how many lie before them. A tree is
cut into *superblocks* of three levels (4,096 leaves), so a hot group is many superblocks:

* upwards, each superblock is reduced in a task of its own; its top is a leaf of the next, 4,096
  times smaller, tree, until every group has one node; the subroots are one more tree;
* downwards, the nodes that a superblock needs from outside (the siblings of its top on the way to
  the root, a few kilobytes) are cogrouped with its leaves. One ``applyInPandas`` then reduces the
  superblock again, joins inner and outer siblings into each leaf's proof, and folds it.

No task holds more than a superblock and nothing but the greatest tree size comes to the driver.

Rows: a null id comes first in its group; equal ids ascend by leaf, and equal rows are separate
leaves. Null and empty fields are told apart (``-`` and ``0:``). An empty table has no rows in any
result. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetdoc.llm.common import bound_batches, stage

#: Children of a node, levels of a superblock, and so leaves of one.
FANOUT, LEVELS = 16, 3
SUPERBLOCK = FANOUT**LEVELS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: A sibling step: how many siblings lie to the left, and the digests of all of them as one text.
_STEPS = "at array<int>, beside array<string>"


@dataclass
class Manifest:
    """``leaves`` (id, grp, leaf, other, tree, pos, n), ``subroots`` (tree, leaf, pos, n) and the
    outer nodes ``outer`` (tree, block, at, beside, subroot, root) of every superblock of leaves."""

    leaves: DataFrame
    subroots: DataFrame
    outer: DataFrame


def digest(*values: Column) -> Column:
    """Lower-case hex SHA-256 of values written with their UTF-8 byte counts; null is ``-``."""
    def written(v: Column) -> Column:
        text = v.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(written, values)), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _up(nodes: list[str]) -> list[str]:
    return [_hash("".join(nodes[i : i + FANOUT])) for i in range(0, len(nodes), FANOUT)]


def _levels(size: int) -> int:
    """Levels of a superblock in a tree of ``size`` leaves."""
    done = 0
    while size > 1 and done < LEVELS:
        size, done = -(-size // FANOUT), done + 1
    return done


def _reduced(leaves: list[str], size: int) -> list[list[str]]:
    """The levels of one superblock, its leaves first, its top last."""
    levels = [leaves]
    for _ in range(_levels(size)):
        levels.append(_up(levels[-1]))
    return levels


def _siblings(levels: list[list[str]], i: int) -> tuple[list[int], list[str]]:
    """Steps from leaf ``i`` of a superblock to its top."""
    at, beside = [], []
    for nodes in levels[:-1]:
        first = i - i % FANOUT
        at.append(i - first)
        beside.append("".join(nodes[first:i]) + "".join(nodes[i + 1 : first + FANOUT]))
        i //= FANOUT
    return at, beside


def fold(leaf: str, at: Sequence[int], beside: Sequence[str]) -> str:
    """The root that ``leaf`` gives with these siblings."""
    for i, nodes in zip(at, beside, strict=True):
        leaf = _hash(nodes[: 64 * i] + leaf + nodes[64 * i :])
    return leaf


def _placed(nodes: DataFrame, label: str, *order: str) -> DataFrame:
    """``nodes`` with ``pos`` (from 0, within ``tree`` by ``order``) and ``n`` (rows of the tree).

    Rows are spread by a number of their own as well, so that many equal rows do not meet in one
    task; which of two equal rows comes first makes no difference."""
    numbered = stage(nodes.withColumn("spread", F.monotonically_increasing_id()), f"{label}-rows")
    keys = ["tree", *order, "spread"]
    sorted_ = stage(numbered.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .withColumn("spot", F.monotonically_increasing_id()).drop("spread"), f"{label}-sorted")
    part = F.shiftright("spot", 33).alias("part")
    counts = sorted_.groupBy("tree", part).agg(F.min("spot").alias("first"), F.count("*").alias("here"))
    of_tree = Window.partitionBy("tree")
    offsets = counts.select(
        "tree", "part",
        (F.coalesce(F.sum("here").over(of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("here").over(of_tree).alias("n"),
    )
    return sorted_.withColumn("part", part).join(offsets, ["tree", "part"]).withColumn("pos", F.col("spot") + F.col("shift")).drop("spot", "shift", "part")


def _block() -> Column:
    return F.floor(F.col("pos") / SUPERBLOCK).cast("long").alias("block")


def _tops(nodes: DataFrame) -> DataFrame:
    """The top of every superblock, as leaves (tree, leaf, pos, n) of the next tree."""
    def reduce(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        size = int(part["n"].iloc[0])
        top = _reduced(part["leaf"].tolist(), size)[-1]
        return pd.DataFrame({"tree": part["tree"].iloc[:1], "leaf": top, "pos": part["block"].iloc[:1], "n": -(-size // SUPERBLOCK)})

    keyed = nodes.select("tree", "leaf", "pos", "n", _block())
    return keyed.groupBy("tree", "block").applyInPandas(reduce, "tree string, leaf string, pos long, n long")


def _pyramid(leaves: DataFrame, label: str) -> list[DataFrame]:
    """``leaves`` and the trees of tops above them, until every tree has one node."""
    out = [leaves]
    while (most := out[-1].agg(F.max("n")).first()[0]) is not None and most > 1:
        out.append(stage(_tops(out[-1]), f"{label}-tops"))
    return out


def _handed_down(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """Outer nodes of every node of ``nodes``, from those of its superblock: (tree, block, at,
    beside, subroot, root), where ``block`` is the node's position: that of a superblock below."""
    def join(own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("pos")
        levels = _reduced(own["leaf"].tolist(), int(own["n"].iloc[0]))
        up = above.iloc[0]
        steps = [_siblings(levels, i) for i in range(len(own))]
        return pd.DataFrame({
            "tree": own["tree"].to_numpy(), "block": own["pos"].to_numpy(),
            "at": [[*a, *up["at"]] for a, _ in steps], "beside": [[*b, *up["beside"]] for _, b in steps],
            "subroot": up["subroot"], "root": up["root"],
        })

    keyed = nodes.select("tree", "leaf", "pos", "n", _block())
    return keyed.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(
        join, f"tree string, block long, {_STEPS}, subroot string, root string")


def _descend(pyramid: list[DataFrame], outer: DataFrame, label: str) -> DataFrame:
    """Outer nodes of the superblocks of the lowest of ``pyramid``, from those of its top."""
    for nodes in reversed(pyramid[1:]):
        outer = stage(_handed_down(nodes, outer), f"{label}-outer")
    return outer


def build(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "source",
          changed: dict[str, Column] | None = None) -> Manifest:
    """Reduce ``docs`` to a manifest of ``fields``, in groups of column ``group`` by ``key``.

    ``changed`` maps fields to other values of theirs (null keeps the row as it is): the leaves of
    a changed copy of the rows, to be folded with the siblings of the original ones."""
    spark = docs.sparkSession
    bound_batches(spark)
    leaf = digest(*(F.col(f"`{f}`") for f in fields))
    other = F.lit(None).cast("string")
    if changed:
        touched = None
        for c in changed.values():
            touched = c.isNotNull() if touched is None else touched | c.isNotNull()
        other = F.when(touched, digest(*(F.coalesce(changed[f], F.col(f"`{f}`")) if f in changed else F.col(f"`{f}`") for f in fields)))
    grp = F.col(f"`{group}`").cast("string")
    rows = docs.select(
        F.col(f"`{key}`").alias("id"), grp.alias("grp"), leaf.alias("leaf"), other.alias("other"),
        F.coalesce(F.concat(F.lit("="), grp), F.lit("")).alias("tree"),  # null before all texts
    )
    leaves = stage(_placed(rows, "merkle-leaves", "id", "leaf"), "merkle-leaves")
    groups = _pyramid(leaves, "merkle")

    # the subroots are the leaves of the tree over groups, in the order of their tree names
    subs = groups[-1].select(F.col("tree").alias("name"), "leaf", F.lit("groups").alias("tree"))
    placed = stage(_placed(subs, "merkle-groups", "name"), "merkle-groups")
    upper = _pyramid(placed.select("tree", "leaf", "pos", "n"), "merkle-groups")
    none = "cast(array() as array<{}>)"
    top = upper[-1].select("tree", F.lit(0).cast("long").alias("block"), F.expr(none.format("int")).alias("at"),
                           F.expr(none.format("string")).alias("beside"), F.lit(None).cast("string").alias("subroot"), F.col("leaf").alias("root"))
    # down to the superblocks of subroots, then to each subroot: the outer nodes of its whole tree
    # (the last tree of a pyramid has one node, which adds no siblings)
    each = _handed_down(upper[0], _descend(upper[:-1] or upper, top, "merkle-groups"))
    named = placed.select(F.col("pos").alias("block"), F.col("name").alias("tree"), F.col("leaf").alias("subroot"))
    own = each.select("block", "at", "beside", "root").join(named, "block").withColumn("block", F.lit(0).cast("long"))
    outer = stage(own.select("tree", "block", "at", "beside", "subroot", "root"), "merkle-outer")
    return Manifest(leaves, placed, _descend(groups[:-1] or groups, outer, "merkle"))


def prove(manifest: Manifest, siblings: bool = False) -> DataFrame:
    """Per row (id, grp, leaf, subroot, root, proof_sha256, folded_root, verified): the digest of
    its proof (all siblings up to the root, level by level, left to right), the root that its
    changed (else its own) leaf folds to with them, and whether that is the root.
    ``siblings`` adds the proof itself: ``at`` (siblings to the left) and ``beside`` per level."""
    def finish(own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("pos")
        levels = _reduced(own["leaf"].tolist(), int(own["n"].iloc[0]))
        up = above.iloc[0]
        up_at, up_beside, up_text = list(up["at"]), list(up["beside"]), "".join(up["beside"])
        proofs, folded, steps_at, steps_beside = [], [], [], []
        for i, (leaf, other) in enumerate(zip(own["leaf"], own["other"], strict=True)):
            at, beside = _siblings(levels, i)
            proofs.append(_hash("".join(beside) + up_text))
            folded.append(fold(other if isinstance(other, str) else leaf, at + up_at, beside + up_beside))
            if siblings:
                steps_at.append(at + up_at)
                steps_beside.append(beside + up_beside)
        out = {"id": own["id"].to_numpy(), "grp": own["grp"].to_numpy(), "leaf": own["leaf"].to_numpy(), "subroot": up["subroot"],
               "root": up["root"], "proof_sha256": proofs, "folded_root": folded, "verified": [f == up["root"] for f in folded]}
        if siblings:
            out |= {"at": steps_at, "beside": steps_beside}
        return pd.DataFrame(out)

    leaves = manifest.leaves
    schema = "id string, grp string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    # ids travel as text: pandas has no whole numbers beside nulls
    keyed = leaves.select("tree", F.col("id").cast("string").alias("id"), "grp", "leaf", "other", "pos", "n", _block())
    proved = keyed.groupBy("tree", "block").cogroup(manifest.outer.groupBy("tree", "block")).applyInPandas(
        finish, schema + (f", {_STEPS}" if siblings else ""))
    return proved.withColumn("id", F.col("id").cast(leaves.schema["id"].dataType))
