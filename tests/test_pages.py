"""Page numbers against a plain global row number."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripmill.operators import pages
from tripmill.plans.staging import staged


def groups(spark, n):
    """Half of the groups share one total."""
    return spark.range(n).select(
        F.concat(F.lit("k"), F.lpad(F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("string"), 9, "0"), F.col("id").cast("string")).alias("key"),
        F.when(F.col("id") % 2 == 0, 0.0).otherwise((F.xxhash64("id", F.lit(1)) % 50).cast("double")).alias("volume"),
    )


@pytest.mark.parametrize(
    ("n", "buckets"), [(0, 4), (1, 4), (37, 4), (38, 1), (39, 256), (5000, 1), (5000, 4), (5000, 256)]
)
def test_same_as_global_row_number(spark, n, buckets):
    rows = staged(groups(spark, n))
    found = pages.with_pages(rows, [-F.col("volume"), F.col("key")], 38, buckets).collect()
    everything = Window.orderBy(F.desc("volume"), "key")
    expected = rows.withColumn("rn", F.row_number().over(everything)).collect()
    assert {r.key: (r.page_no, r.row_in_page) for r in found} == {
        r.key: ((r.rn - 1) // 38 + 1, (r.rn - 1) % 38 + 1) for r in expected
    }


def test_null_keys_have_a_place(spark):
    rows = staged(spark.createDataFrame([(None,), ("b",), ("a",)], "key string"))
    found = pages.ranked(rows, [F.col("key")], 2).orderBy("rank").collect()
    assert [(r.key, r["rank"]) for r in found] == [(None, 1), ("a", 2), ("b", 3)]


def test_rows_are_spread_over_buckets(spark):
    """Half the rows tie on the total, and still no bucket holds more than a few percent."""
    keyed = groups(spark, 20000).withColumn("_key", F.struct(-F.col("volume"), F.col("key")))
    keyed = staged(keyed)
    bucketed = keyed.withColumn("_cuts", pages._cut_points(keyed, 256).scalar()).withColumn(
        "_bucket", pages._cuts_below("_cuts", "_key", 256)
    )
    largest = bucketed.groupBy("_bucket").count().agg(F.max("count")).first()[0]
    assert largest < 20000 * 0.05
