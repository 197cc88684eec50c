"""Ordered segmentation under header rows.

A *segment* starts at every selected (header) row and runs to the next one or to the end of
its context, the header included; rows before the first header belong to no segment.
``forward_fill`` gives every row the order key of the last header at or before it.

One context can be a whole sheet (top level of a spec) and so one huge window partition. With
``block_rows`` set, the scan never puts more than one block of rows in a window:

1. the order key without its lowest bits is the block: at most ``block_rows`` rows share one,
   since keys are unique in a context. A running max is taken within each block;
2. the blocks' maxima (one row per block) are scanned in the same way, their block numbers being
   the keys, until ``key_bits`` bits are used up; each row takes the carry of its block.

Dense keys need few summary rows. Sparse ones give up to a row per block, but each summary level is
cut into blocks itself, so its windows stay as small. Nothing is sampled or counted while planning,
and a recomputed task gets the same blocks. The result is the same as the single window (tested).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK_ROWS = 1 << 20
#: Bits of a row's position in its sheet; callers whose order keys are other numbers give 63.
POSITION_BITS = 40


def prefix_max(
    df: DataFrame,
    value: Column,
    partition_by: list[str],
    order_col: str,
    out: str,
    inclusive: bool = True,
    block_rows: int | None = DEFAULT_BLOCK_ROWS,
    key_bits: int = POSITION_BITS,
) -> DataFrame:
    """Add ``out`` = running max of ``value`` over rows ordered by ``order_col`` (an integral
    key; rows of equal keys count as one), including the current row or not.

    Keys of more than ``key_bits`` bits are scanned correctly, but their highest blocks meet in one
    window."""
    hi = 0 if inclusive else -1
    bits = block_rows.bit_length() - 1 if block_rows else 0
    if not block_rows or key_bits <= 0:
        w = Window.partitionBy(*partition_by).orderBy(order_col).rowsBetween(Window.unboundedPreceding, hi)
        return df.withColumn(out, F.max(value).over(w))
    if bits < 1:
        raise ValueError("a block needs two rows at least")

    blk, val, run, top, carry = (f"__{n}{key_bits}" for n in ("blk", "val", "run", "top", "carry"))
    tagged = df.withColumn(val, value).withColumn(blk, F.shiftright(F.col(order_col).cast("bigint"), bits))
    w_in = Window.partitionBy(*partition_by, blk).orderBy(order_col).rowsBetween(Window.unboundedPreceding, hi)
    local = tagged.withColumn(run, F.max(val).over(w_in))
    # Derived from the windowed rows, which are already partitioned by (partition, block): no
    # second scan and no extra shuffle of the big side.
    blocks = local.groupBy(*partition_by, blk).agg(F.max(val).alias(top))
    rest = key_bits - bits
    carried = prefix_max(blocks, F.col(top), partition_by, blk, carry, False, block_rows if rest > bits else None, rest)
    joined = local.join(carried.select(*partition_by, blk, carry), [*partition_by, blk], "left")
    return joined.withColumn(out, F.greatest(F.col(run), F.col(carry))).drop(val, run, carry, blk)


def forward_fill(
    df: DataFrame,
    is_header: Column,
    partition_by: list[str],
    order_col: str,
    out: str,
    block_rows: int | None = DEFAULT_BLOCK_ROWS,
    key_bits: int = POSITION_BITS,
) -> DataFrame:
    """Add ``out`` = value of ``order_col`` on the most recent header row (NULL before any)."""
    hdr = F.when(F.coalesce(is_header, F.lit(False)), F.col(order_col))
    return prefix_max(df, hdr, partition_by, order_col, out, True, block_rows, key_bits)
