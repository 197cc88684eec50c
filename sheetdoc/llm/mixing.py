"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only).

Each source is a queue of its documents in a shuffled order that depends on their content alone,
repeated for as many epochs as allowed. A copy's virtual finish time is the cumulative size of its
source up to and including it, divided by the source's weight. All copies, sorted by that time,
are the mix; it is truncated where the total size reaches the budget.

No queue is walked in one task: cumulative sizes are running sums inside blocks of the shuffle
hash plus a prefix over the block totals. The truncation needs no sort of all copies either: up
to the virtual time at which the targets are met every copy fits, so only the few copies that
finish just after it are put in order to find the last one that is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetdoc.llm.common import stage

#: Weights by the rank of a source's name, repeating.
WEIGHTS = (5, 2, 1)
#: Passes over a source that its target allows at most.
EPOCHS = 3
#: Columns that ``mix`` adds.
ADDED = ("mix_source_size", "mix_target", "mix_copies", "mix_finish")
#: Leading hex digits of the shuffle hash that name a block: 16**3 blocks in each source.
BLOCK_DIGITS = 3


def word_count(text: str = "text") -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def shuffle_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A row's place in its source's queue: a hash of the id and the text."""
    return F.md5(F.concat_ws("|", F.lit("mix"), F.col(doc_id).cast("string"), F.col(text)))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """One row per source of ``sized`` (columns ``source``, ``size``): ``source_size``, ``rank``
    (by code point, null last), ``weight``, ``target``, ``level`` (the virtual time at which the
    targets are met) and ``total`` (the budget: the size of all sources).

    Shares are in proportion to weight, but no target exceeds ``epochs`` times its source's size;
    what is left over is shared again by weight. In order of ``cap / weight`` the level with the
    first k sources at their caps is ``(total - their caps) / (weight of the others)``; it rises
    as long as sources that reach their caps are set aside and falls after, so the level is its
    maximum."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("fill", "rank")
    everything = Window.partitionBy()
    per = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.max("size").alias("largest"))
        .withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") - 1) % len(weights) + 1).cast("long"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("largest", F.max("largest").over(everything))
        .withColumn("cap", F.col("source_size") * epochs)
        .withColumn("fill", F.col("cap") / F.col("weight"))
    )
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    return (
        per.withColumn("_level", level)
        .withColumn("level", F.max("_level").over(everything))
        .withColumn("target", F.when(F.col("fill") <= F.col("level"), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight")))
        .select("source", "source_size", "rank", "weight", "target", "level", "total", "largest")
    )


def mix(
    docs: DataFrame, source: str = "source", size: str = "size", key: str = "key",
    weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS,
) -> DataFrame:
    """``docs`` with ``mix_source_size``, ``mix_target``, ``mix_copies`` (how often the document is
    in the mix, 0 to ``epochs``) and ``mix_finish`` (virtual finish time of its first copy).

    ``size`` is a column of non-negative integers and ``key`` one that orders a source's queue;
    rows of one source with the same key (repeated rows) stand at one place and are taken or left
    together. A null source is a source of its own, last in rank. Documents of size 0 take up no
    room and are in the mix 0 times. No documents give no rows; extra columns stay
    (those named like the four results are replaced)."""
    cols = [c for c in docs.columns if c.lower() not in ADDED]
    queue = docs.select(
        F.col(source).alias("source"), F.col(size).cast("long").alias("size"), F.col(key).alias("key"),
        F.substring(F.col(key), 1, BLOCK_DIGITS).alias("block"), F.struct(*(F.col(f"`{c}`") for c in cols)).alias("row"),
    )
    sizes = stage(queue.select("source", "size", "key", "block"), "mix-sizes")
    per = stage(targets(sizes, weights, epochs), "mix-targets")
    # a name without nulls: the window and the join of the rows then share one shuffle
    place = ["name", "unnamed", "block"]

    def named(rows: DataFrame) -> DataFrame:
        return rows.withColumn("name", F.coalesce("source", F.lit(""))).withColumn("unnamed", F.col("source").isNull())

    in_order = Window.partitionBy("name", "unnamed").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = named(sizes).groupBy(*place).agg(F.sum("size").alias("block_size")).select(
        *place, F.coalesce(F.sum("block_size").over(in_order), F.lit(0)).alias("before"),
    ).join(named(per).drop("source"), ["name", "unnamed"])

    def finish(rows: DataFrame) -> DataFrame:
        """Virtual finish time of each row's first copy; a later epoch adds a round."""
        here = Window.partitionBy(*place).orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
        running = named(rows).withColumn("within", F.sum("size").over(here))
        return running.join(blocks, place).withColumn("done", F.col("before") + F.col("within")).drop("before")

    def at(epoch) -> Column:
        return (F.col("done") + F.lit(epoch) * F.col("source_size")) / F.col("weight")

    # copies that end after the level, but no later than each source's next two documents could
    late = (
        finish(sizes).where("size > 0")
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
        .withColumn("finish", (F.col("done") + F.col("epoch") * F.col("source_size")) / F.col("weight"))
    )
    taken = late.where("finish <= level").agg(F.sum("size").alias("spent"))
    rest = late.where(f"finish > level AND finish <= level + {2 * max(weights)} * largest").crossJoin(F.broadcast(taken))
    in_time = Window.orderBy("finish", "rank", "key").rangeBetween(Window.unboundedPreceding, 0)
    last = stage(
        rest.withColumn("running", F.coalesce("spent", F.lit(0)) + F.sum("size").over(in_time))
        .where("running <= total").agg(F.max(F.struct("finish", "rank", "key")).alias("last")),
        "mix-end",
    )
    end = F.coalesce(F.col("last"), F.struct(F.col("level").alias("finish"), F.lit(2**31 - 1).alias("rank"), F.lit("").alias("key")))
    fits = [F.struct(at(e).alias("finish"), F.col("rank"), F.col("key")) <= end for e in range(epochs)]
    copies = sum((f.cast("int") for f in fits[1:]), fits[0].cast("int"))
    mixed = finish(queue).crossJoin(F.broadcast(last))
    return mixed.select(
        "row.*", F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
        F.when(F.col("size") > 0, copies).otherwise(0).alias("mix_copies"), at(0).alias("mix_finish"),
    )


def in_mix_order(mixed: DataFrame) -> DataFrame:
    """The documents of the mix, globally range-sorted by the virtual finish time of their first
    copy; ``mix_copies`` says how often each is to be read."""
    return mixed.where("mix_copies > 0").orderBy("mix_finish")
