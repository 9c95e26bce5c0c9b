"""Page numbers over an ordered result, without pulling it through one task.

A global ``row_number`` would sort the whole result in a single partition. Here a fixed-size sample
of the order keys gives cut points, every row finds its bucket by comparing with them, rows are
numbered inside their bucket, and the bucket's starting position is added. Cut points, bucket counts
and starting positions are arrays of at most ``BUCKETS`` + 1 entries, read as scalar subqueries. The
numbering is exact for any choice of cut points; they only decide how evenly the work is spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.plans.staging import staged

SAMPLE = 4096
BUCKETS = 256


def _cut_points(keyed: DataFrame, buckets: int) -> DataFrame:
    """At most ``buckets`` evenly spaced keys of the sample with the smallest key hashes.

    Taking small hashes is a uniform sample of bounded size that any re-run draws again.
    """
    hashed = F.shiftrightunsigned(F.xxhash64("_key"), 1).cast("double") / float(1 << 63)
    total = keyed.agg(F.count(F.lit(1))).scalar()
    # About twice as many as needed have so small a hash; only they meet to be sorted.
    few = keyed.where(hashed * total <= 2.0 * SAMPLE).select("_key")
    sample = few.orderBy(F.xxhash64("_key"), "_key").limit(SAMPLE)
    ordered = sample.agg(F.sort_array(F.collect_list("_key")).alias("keys"))
    stride = F.ceil(F.size("keys") / F.lit(buckets))
    return ordered.select(F.filter("keys", lambda _, i: (i + 1) % stride == 0).alias("cuts"))


def _cuts_below(cuts: str, key: str, buckets: int) -> Column:
    """Number of entries of the sorted array ``cuts`` below ``key``, by halving steps.

    A position past the end reads null, which compares as not below.
    """
    strides = F.array(*[F.lit(1 << i) for i in range(buckets.bit_length() - 1, -1, -1)])

    def advance(found: Column, stride: Column) -> Column:
        ahead = F.get(cuts, found + stride - 1) < F.col(key)
        return F.when(ahead, found + stride).otherwise(found)

    return F.aggregate(strides, F.lit(0), advance)


def _bucket_starts(bucketed: DataFrame, buckets: int) -> DataFrame:
    """Array whose entry ``b`` is the number of rows in the buckets below ``b``."""
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    gathered = counts.agg(F.collect_list(F.struct("_bucket", "n")).alias("counts"))

    def rows_below(bucket: Column) -> Column:
        below = F.filter("counts", lambda c: c["_bucket"] < bucket)
        return F.aggregate(below, F.lit(0).cast("bigint"), lambda total, c: total + c["n"])

    every = F.sequence(F.lit(0), F.lit(buckets))
    return gathered.select(F.transform(every, rows_below).alias("starts"))


def ranked(rows: DataFrame, order: Sequence[Column], buckets: int = BUCKETS) -> DataFrame:
    """Add ``rank``, the 1-based position of each row in ascending ``order``.

    ``order`` must tell all rows apart; for a rollup, end it with the group key. ``rows`` is read
    three times (sample, bucket counts, result), so pass a staged frame.
    """
    parts = [c.alias(f"k{i}") for i, c in enumerate(order)]
    keyed = rows.withColumn("_key", F.struct(*parts))
    bucketed = (
        keyed.withColumn("_cuts", _cut_points(keyed, buckets).scalar())
        .withColumn("_bucket", _cuts_below("_cuts", "_key", buckets))
        .drop("_cuts", "_key")
    )
    # The start is looked up ahead of the window, so the shuffle carries one number per row.
    started = (
        bucketed.withColumn("_starts", _bucket_starts(bucketed, buckets).scalar())
        .withColumn("_start", F.get("_starts", F.col("_bucket")))
        .drop("_starts")
    )
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    return started.withColumn("rank", F.col("_start") + position).drop("_bucket", "_start")


def with_pages(
    rows: DataFrame, order: Sequence[Column], page_size: int, buckets: int = BUCKETS, scope: Sequence[str] = ()
) -> DataFrame:
    """Split staged rows into pages: adds ``page_no`` and ``row_in_page``, both from 1.

    With a ``scope``, whose columns are never null, each of its values has pages of its own: all rows are
    ranked together by scope and ``order``, and ranks count from the first of their scope.
    """
    numbered = ranked(rows, [*[F.col(c) for c in scope], *order], buckets)
    zero_based = F.col("rank") - 1
    if scope:
        firsts = numbered.groupBy(*scope).agg(F.min("rank").alias("_first"))
        numbered = numbered.join(firsts, list(scope))
        zero_based = F.col("rank") - F.col("_first")
    return (
        numbered.withColumn("page_no", F.floor(zero_based / page_size) + 1)
        .withColumn("row_in_page", zero_based % page_size + 1)
        .drop("rank", "_first")
    )


def paginate(
    rows: DataFrame, order: Sequence[Column], page_size: int, buckets: int = BUCKETS
) -> DataFrame:
    """Stage ``rows`` and split them into pages; ``buckets`` bounds the parallel tasks."""
    return with_pages(staged(rows), order, page_size, buckets)


def ranking(rollup: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Stage a rollup and add ``rank`` by unrounded total, largest first, equal totals by key."""
    return ranked(staged(rollup), [-F.col("volume"), F.col(key)], buckets)
