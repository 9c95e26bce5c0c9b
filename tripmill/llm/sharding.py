"""Reproducible shuffle into shards by a Feistel permutation of global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.numbering import numbered
from tripmill.plans.staging import staged

ROUNDS = 6
WORD = (1 << 32) - 1


def mixed(value, key: int):
    """A 32-bit mix of ``value`` (numpy uint64 below 2^32) under a round key."""
    x = value ^ np.uint64(key)
    x = ((x ^ (x >> np.uint64(16))) * np.uint64(0x85EBCA6B)) & np.uint64(WORD)
    x = ((x ^ (x >> np.uint64(13))) * np.uint64(0xC2B2AE35)) & np.uint64(WORD)
    return x ^ (x >> np.uint64(16))


class Permutation:
    """A seeded permutation of 0 to ``n`` - 1 that is computed, not stored.

    A balanced Feistel network permutes the numbers of twice ``half`` bits, fewer than four times
    ``n``. Results of ``n`` or more are put through it again until they fall below ``n`` (cycle
    walking), which keeps the map a permutation. ``inverse`` finds the row of a position.
    """

    def __init__(self, n: int, seed: int, rounds: int = ROUNDS):
        self.n = n
        self.half = max(1, ((max(n, 1) - 1).bit_length() + 1) // 2)
        steps = np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B9)
        self.keys = [int(k) for k in mixed((steps + np.uint64(seed & WORD)) & np.uint64(WORD), 0)]

    def _network(self, x, keys):
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for key in keys:
            left, right = right, left ^ (mixed(right, key) & mask)
        return left, right

    def _walk(self, numbers, step):
        x = step(np.asarray(numbers, dtype=np.uint64))
        outside = np.flatnonzero(x >= self.n)
        while outside.size:
            x[outside] = step(x[outside])
            outside = outside[x[outside] >= self.n]
        return x.astype(np.int64)

    def _once(self, x):
        left, right = self._network(x, self.keys)
        return (left << np.uint64(self.half)) | right

    def _back(self, x):
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        right, left = self._network(((x & mask) << half) | (x >> half), self.keys[::-1])
        return (left << half) | right

    def forward(self, rows) -> np.ndarray:
        return self._walk(rows, self._once)

    def inverse(self, positions) -> np.ndarray:
        return self._walk(positions, self._back)


def shard_rows(docs: DataFrame, shards: int, seed: int, id_col: str = "doc_id", text_col: str = "text"):
    """Shard and slot of every row: ``id, size, text_crc32, row_number, shard, slot``.

    Rows are numbered in ascending order of id, size and checksum, the permutation gives each a
    position, and position ``p`` is slot ``p div shards`` of shard ``p mod shards``: shards differ
    by one row at most and slots have no gaps. Number, shard and slot follow from the id order, the
    row count and the seed alone.

    ``size`` is the text's UTF-8 bytes plus 1. A null text counts as no bytes (size 1, checksum 0).
    Null ids come first in the numbering. Repeated rows each get a slot of their own. An empty table
    gives an empty result. Other columns are not read.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    narrow = staged(
        docs.select(
            F.col(f"`{id_col}`").alias(id_col),
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
        )
    )
    permutation = Permutation(narrow.count(), seed)

    @F.pandas_udf("bigint")
    def position(rows: pd.Series) -> pd.Series:
        return pd.Series(permutation.forward(rows.to_numpy()))

    placed = numbered(narrow, [id_col, "size", "text_crc32"], "row_number")
    return placed.withColumn("position", position("row_number")).select(
        id_col,
        "size",
        "text_crc32",
        "row_number",
        (F.col("position") % shards).cast("int").alias("shard"),
        F.expr(f"position div {shards}").alias("slot"),
    )


def documents_in_shard(docs: DataFrame, placed: DataFrame, shard: int, id_col: str = "doc_id"):
    """The rows of one shard in slot order; ids must be unique."""
    wanted = placed.where(F.col("shard") == shard).select(id_col, F.col("slot").alias("_slot"))
    return docs.join(wanted, id_col).orderBy("_slot").drop("_slot")
