"""Dense global row numbers, without bringing all rows to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.plans.staging import staged

PLACE_BITS = 33  # monotonically_increasing_id: partition above, place in it below


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add the column ``name``, the 0-based position of each row in ascending ``order``.

    Nulls come first. Rows that agree in all of ``order`` get consecutive numbers, spread over
    several range partitions by their place in the input; which of them gets which number is open.
    The rows are range-partitioned and sorted once, written to the shared folder with their
    partition and place, and every partition's starting number is added: a table of one row per
    partition, the only thing that is broadcast.
    """
    keyed = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order)],
        F.monotonically_increasing_id().alias("tie"),
    )
    keys = [*[f"k{i}" for i in range(len(order))], "tie"]
    placed = staged(
        keyed.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("row", F.monotonically_increasing_id().alias("place"))
    )
    located = placed.select(
        "row",
        F.shiftright("place", PLACE_BITS).alias("part"),
        F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("place"),
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        located.groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    return located.join(F.broadcast(starts), "part").select(
        "row.*", (F.col("start") + F.col("place")).alias(name)
    )
