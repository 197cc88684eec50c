"""Rows of numbers that travel packed: rows of one bucket are the bytes of one row.

Where a step is numpy work on many short rows, Spark deals out and sorts buckets, and a task takes
the rows of a bucket as arrays. Columns are stored byte by byte of equal weight and compressed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows that a task gathers before it packs them, and rows of one packed row, at most.
GATHERED, TOGETHER = 1 << 19, 1 << 14

Columns = dict[str, np.ndarray]


def gathered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames of at least GATHERED rows but the last, so that the packed rows made of one are worth it."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        held.append(frame)
        if sum(map(len, held)) >= GATHERED:
            yield pd.concat(held, ignore_index=True)
            held = []
    if held:
        yield pd.concat(held, ignore_index=True)


class Packed:
    """Packed rows with columns of the given numpy types, in ``many`` buckets."""

    schema = "bucket int, n int, packed binary"

    def __init__(self, many: int, **types: str):
        self.many, self.types = many, {c: np.dtype(t) for c, t in types.items()}
        self.width = sum(t.itemsize for t in self.types.values())

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        """A bucket for each 64-bit key."""
        mixed = (keys.view(np.uint64) ^ (keys.view(np.uint64) >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(32)) % np.uint64(self.many)).astype(np.int64)

    def rows(self, bucket: np.ndarray, cols: Columns) -> pd.DataFrame:
        order = np.argsort(bucket.astype(np.uint16) if self.many <= 1 << 16 else bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(self.many + 1)).tolist()
        sides = [(np.asarray(cols[c], t)[order], t.itemsize) for c, t in self.types.items()]
        out = []
        for b, (start, end) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            for lo in range(start, end, TOGETHER):
                hi = min(end, lo + TOGETHER)
                raw = b"".join([x[lo:hi].view(np.uint8).reshape(-1, size).T.tobytes() for x, size in sides])
                out.append((b, hi - lo, pa.compress(raw, "zstd", asbytes=True)))
        return pd.DataFrame(out, columns=["bucket", "n", "packed"])

    def columns(self, ns: list[int], packed: list[bytes]) -> Columns:
        parts: dict[str, list[np.ndarray]] = {c: [] for c in self.types}
        for n, p in zip(ns, packed, strict=True):
            raw, at = np.frombuffer(pa.decompress(p, n * self.width, "zstd"), np.uint8), 0
            for c, t in self.types.items():
                parts[c].append(raw[at : at + n * t.itemsize].reshape(t.itemsize, n).T.ravel().view(t))
                at += n * t.itemsize
        return {c: np.concatenate(x) if len(x) != 1 else x[0] for c, x in parts.items()}

    def packed(self, each: Iterator[Columns], key: str) -> Iterator[pd.DataFrame]:
        """Packed rows in the buckets of column ``key``."""
        for rows in gathered(pd.DataFrame({c: cols[c] for c in self.types}) for cols in each):
            yield self.rows(self.bucket(rows[key].to_numpy()), rows)

    def buckets(self, batches: Iterator[pd.DataFrame]) -> Iterator[Columns]:
        """The columns of each bucket, from batches sorted by bucket."""
        now, ns, packed = None, [], []
        for batch in batches:
            for b, n, p in zip(batch["bucket"].tolist(), batch["n"].tolist(), batch["packed"], strict=True):
                if b != now and ns:
                    yield self.columns(ns, packed)
                    ns, packed = [], []
                now = b
                ns.append(n)
                packed.append(p)
        if ns:
            yield self.columns(ns, packed)

    def dealt(self, rows: DataFrame, work: Callable[[Iterator[Columns]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
        """``work`` on the buckets of ``rows``."""
        return rows.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(lambda batches: work(self.buckets(batches)), schema)
