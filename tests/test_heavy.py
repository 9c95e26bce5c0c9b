"""Joins on unequal keys."""

import pytest
from pyspark.sql import functions as F

from compare import plan
from tripmill.checks.bindings import crowded_star, star_tables
from tripmill.operators.heavy import PARTS, heavy_keys, spread_join

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled(spark):
    """Neither broadcasts nor adaptive execution; eight partitions."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield 8
    for k, v in before.items():
        spark.conf.set(k, v)


def crowd(spark, n=24_000):
    """A third of the rows on one key, a third without a key, the others with keys of their own."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") + 10)
    return spark.range(0, n, 1, 4).select("id", key.alias("key"))


def test_heavy_keys_are_found_with_their_parts(spark, shuffled):
    found = heavy_keys(crowd(spark), ["key", "id"])
    copies = {r["_heavy"]: r["_copies"] for r in found["key"].rows.collect()}
    assert set(copies) == {7, None}
    assert all(PARTS * shuffled // 4 < n < PARTS * shuffled // 2 for n in copies.values())
    assert found["id"].n_keys == 0
    assert heavy_keys(crowd(spark).limit(0), ["key"])["key"].n_keys == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_the_plain_one(spark, how):
    rows = crowd(spark, 3000)
    table = spark.createDataFrame([(7, "a"), (7, "b"), (11, "c"), (14, "d"), (None, "e")], "k long, name string")
    heavy = heavy_keys(rows, ["key"])["key"]
    assert heavy.n_keys == 2
    spread = spread_join(rows, table, [("key", "k")], heavy, ["id"], how)
    expected = rows.join(table, rows.key == table.k, how)
    assert spread.columns == expected.columns
    assert sorted(map(repr, spread.collect())) == sorted(map(repr, expected.collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_no_task_has_twice_the_mean(spark, shuffled, how):
    rows = crowd(spark)
    table = spark.range(0, 40_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("value"))
    heavy = heavy_keys(rows, ["key"])["key"]

    def largest_share(joined):
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        return max(sizes) * shuffled / sum(sizes)

    assert largest_share(rows.join(table, rows.key == table.k, how)) > 2.5
    assert largest_share(spread_join(rows, table, [("key", "k")], heavy, ["id"], how)) < 2


def test_only_heavy_keys_are_repeated(spark, shuffled):
    rows = crowd(spark)
    table = spark.range(0, 40_000).select(F.col("id").alias("k"), F.lit(1).alias("value"))
    heavy = heavy_keys(rows, ["key"])["key"]
    text = plan(spread_join(rows, table, [("key", "k")], heavy, ["id"]))
    assert "SortMergeJoin" in text and text.count("BroadcastHashJoin") == 2
    repeated = heavy.copies_beside(table, F.col("k")).selectExpr("sum(coalesce(_copies, 1)) AS n").first()["n"]
    assert repeated < 40_000 + PARTS * shuffled


def test_star_joins_stay_the_same(spark, shuffled):
    star = crowded_star(spark, FOLDER)
    balanced = star.balanced()
    assert all(balanced.heavy[c].n_keys for c in ("tag", "reader", "entry"))
    for join in ("with_vehicle", "with_site", "with_driver"):
        plain, spread = getattr(star, join)(star.loads), getattr(balanced, join)(star.loads)
        assert sorted(plain.columns) == sorted(spread.columns)
        assert spread.exceptAll(plain.select(*spread.columns)).count() == 0
        assert plain.select(*spread.columns).exceptAll(spread).count() == 0


def test_even_keys_are_joined_plainly(spark):
    star = star_tables(spark, FOLDER).balanced()
    driver = star.heavy["l_orderkey"]
    assert driver.n_keys == 0
    assert "xxhash64" not in plan(star.with_driver(star.loads))
