"""Joins whose keys may have very unequal numbers of rows.

A shuffle sends all rows of a key to one task. :func:`heavy_keys` finds the keys that are too large for
that, in one pass with buffers of fixed size; :func:`spread_join` cuts their rows into several parts by a
salt and repeats the other side's rows of these keys, and of no others, once per part. It needs neither
adaptive execution nor a broadcast of the other side, and does not go by bytes, so rows that compress well
are spread too.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts per shuffle partition. A key with more than one part's rows is cut into parts of that size.
PARTS = 32
#: Items that the frequency sketch may track, in parts; it counts with an error of 3.5 / items of all rows.
TRACKED = 8
MOST_TRACKED = 1_000_000


@dataclass(frozen=True)
class HeavyKeys:
    """Keys of one column with the number of parts to cut each into; at most ``PARTS`` a shuffle partition."""

    rows: DataFrame
    n_keys: int

    @classmethod
    def of(cls, found: Sequence[tuple], like: DataFrame, column: str) -> HeavyKeys:
        kind = like.schema[column].dataType.simpleString()
        return cls(like.sparkSession.createDataFrame(list(found), f"_heavy {kind}, _copies int"), len(found))

    def copies_beside(self, rows: DataFrame, key: Column) -> DataFrame:
        """``rows`` with ``_copies``, null for keys that are not heavy. The list has a fixed bound."""
        return rows.join(F.broadcast(self.rows), key.eqNullSafe(F.col("_heavy")), "left").drop("_heavy")


def heavy_keys(rows: DataFrame, columns: Sequence[str], parts: int | None = None) -> dict[str, HeavyKeys]:
    """The keys of each column that more than one in ``parts`` rows have, null included.

    One pass with a mergeable sketch of frequent items per column: nothing is shuffled but the sketches.
    It misses no key above that share; counts may be off by a fraction of it.
    """
    spark = rows.sparkSession
    parts = parts or PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = min(parts, MOST_TRACKED // TRACKED)
    top = [F.expr(f"approx_top_k(`{c}`, {parts}, {parts * TRACKED})").alias(f"top{i}") for i, c in enumerate(columns)]
    total, *found = rows.agg(F.count(F.lit(1)), *top).first()
    heavy = {}
    for column, items in zip(columns, found, strict=True):
        shares = [(i["item"], -(-i["count"] * parts // total)) for i in items or ()]
        heavy[column] = HeavyKeys.of([(item, n) for item, n in shares if n > 1], rows, column)
    return heavy


def spread_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[tuple[str, str]],
    heavy: HeavyKeys | None,
    spread_by: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """``rows`` joined with ``table`` on pairs of columns; ``heavy`` has the heavy keys of the first pair.

    ``how`` is ``inner`` or ``left``. Rows of a heavy key are dealt out by a hash of ``spread_by``, which
    should tell them apart; a rerun deals them alike. Without heavy keys this is a plain join.
    """
    matched = [F.col(left) == F.col(right) for left, right in on]
    if heavy is None or not heavy.n_keys:
        return rows.join(table, matched, how)
    left, right = on[0]
    part = F.pmod(F.xxhash64(*spread_by, F.lit(0)), F.col("_copies")).cast("int")
    dealt = heavy.copies_beside(rows, F.col(left)).withColumn("_part", F.coalesce(part, F.lit(0))).drop("_copies")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1))
    repeated = heavy.copies_beside(table, F.col(right)).withColumn("_part_of", every).drop("_copies")
    matched.append(F.col("_part") == F.col("_part_of"))
    return dealt.join(repeated, matched, how).drop("_part", "_part_of")
