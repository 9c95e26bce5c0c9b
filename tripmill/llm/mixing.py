"""Mixing sources to target weights, with DataFrame functions only.

1. Every source gets a target of words: its share by weight, at most a number of passes over it.
2. Its documents are put in a random order and the mix takes whole passes and a part of one more.
3. The taken words of a source are cut into blocks, and a tree that halves the set of shards splits
   the block quotas of all sources: at every node the left half draws half of the blocks without
   replacement (multivariate hypergeometric), first from buckets of sources and then from the sources
   of each bucket.
4. A shard takes as many of a source's blocks as it drew, from the source's permuted blocks, and
   orders its documents by a hash. What it takes is the mix: the words taken from a document are those
   of the blocks that shards drew.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.numbering import numbered
from tripmill.plans.staging import staged

WORDS = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
PASSES = 3
LEVELS = 4
BLOCKS_PER_SHARD = 256


def word_count(text: Column) -> Column:
    """Number of words, without a list of them: each becomes one letter, and blanks go."""
    letters = F.translate(F.regexp_replace(text, WORDS, "x"), BLANKS, "")
    return F.coalesce(F.length(letters), F.lit(0)).cast("bigint")


def source_key(source: Column) -> Column:
    """A key that is never null and tells a null source from every text."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source.cast("string")))


def targets(sources: DataFrame, weights: Sequence[int], passes: int = PASSES) -> DataFrame:
    """``target`` words of each source (``key, source, source_size``).

    Sources in code point order, null last, take the ``weights`` in turn. They share the sum of all
    sizes by weight; who would get more than ``passes`` times its size stops there, and the excess
    goes to the others by weight until nobody is above. Only sums come to the driver, once a round.
    """
    ordered = numbered(
        sources.withColumn("_last", F.col("source").isNull()), ["_last", "source"], "_rank"
    )
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    known = staged(
        ordered.select("key", "source", "source_size", turn.cast("double").alias("weight"))
        .withColumn("most", F.col("source_size") * float(passes))
    )
    whole = known.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words, share, by = float(whole["words"] or 0), float(whole["words"] or 0), whole["weight"] or 1.0
    while True:
        above = F.col("most") < F.col("weight") * F.lit(share) / F.lit(by)
        found = known.agg(
            F.sum(F.when(above, F.col("most"))).alias("stopped"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
        ).first()
        left, weight = words - (found["stopped"] or 0.0), found["weight"]
        if weight is None or (left, weight) == (share, by):
            break
        share, by = left, weight
    target = F.least("most", F.col("weight") * F.lit(share) / F.lit(by))
    return known.select("key", "source", "source_size", target.alias("target"))


def _in_order(rows: DataFrame) -> DataFrame:
    """Words of the same source before each row (``before``) in the random order.

    A source can hold most rows, so its order is cut into buckets of hash values, about as many as
    a bucket has rows; rows are summed within a bucket and buckets within a source.
    """
    bits = max(1, rows.count().bit_length() // 2)
    high = F.conv(F.hex(F.substring("order", 1, 4)), 16, 10).cast("bigint")
    bucketed = rows.withColumn("bucket", F.shiftright(high, 32 - min(bits, 31)))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy("key", "bucket")
        .agg(F.sum("size").alias("words"))
        .select("key", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
    )
    within = (
        Window.partitionBy("key", "bucket")
        .orderBy("order", "size", "row_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = bucketed.withColumn("sum", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return summed.join(starts, ["key", "bucket"]).select(
        *rows.columns, (F.col("start") + F.col("sum")).alias("before")
    )


def copies(rows: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """Documents the mix takes, one row per copy: ``row_id, key, size, copy, offset``.

    ``rows`` has ``row_id`` (unique), ``doc_id``, ``key`` and ``size``. A source is passed over
    ``floor(target / size)`` times. Of the next pass the mix takes documents in random order while
    they fit in the rest, and then the one further document whose size is nearest to what is still
    missing, if that brings the sum nearer. ``offset`` counts the source's taken words before the
    copy. Documents without words are not taken.
    """
    ordered = rows.withColumn(
        "order", F.unhex(_digest(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    )
    placed = staged(_in_order(ordered))
    plan = wanted.where("source_size > 0").select(
        "key",
        "source_size",
        F.floor(F.col("target") / F.col("source_size")).alias("full"),
    ).withColumn("full", F.col("full").cast("bigint"))
    plan = plan.join(wanted.select("key", "target"), "key").withColumn(
        "rest", F.col("target") - F.col("full") * F.col("source_size")
    )
    fits = F.col("before") + F.col("size") <= F.col("rest")
    joined = staged(placed.where("size > 0").join(plan.drop("target"), "key").withColumn("fits", fits))
    upto = F.max(F.when(F.col("fits"), F.col("before") + F.col("size")))
    filled = staged(joined.groupBy("key").agg(F.coalesce(upto, F.lit(0)).alias("filled")))
    gap = F.col("rest") - F.col("filled")
    nearest = (
        joined.where(~F.col("fits"))
        .join(filled, "key")
        .where(F.abs(F.col("size") - gap) < gap)
        .groupBy("key")
        .agg(F.min(F.struct(F.abs(F.col("size") - gap).alias("miss"), "order", "size", "row_id")).alias("n"))
        .select("key", F.col("n.row_id").alias("nearest"))
    )
    whole = joined.where("full > 0").select(
        "row_id", "key", "size", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("copy"),
        "before", "source_size",
    )
    part = joined.where("fits").select(
        "row_id", "key", "size", F.col("full").alias("copy"), "before", "source_size"
    )
    last = (
        joined.join(nearest, "key").where("row_id = nearest").join(filled, "key")
        .select("row_id", "key", "size", F.col("full").alias("copy"), F.col("filled").alias("before"), "source_size")
    )
    return whole.unionByName(part).unionByName(last).select(
        "row_id", "key", "size", "copy",
        (F.col("copy") * F.col("source_size") + F.col("before")).alias("offset"),
    )


def _digest(seed: int, *parts: Column | str) -> Column:
    """A hash that SQL engines agree on."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(p) if isinstance(p, str) else p for p in parts]))


def _drawn(quotas: Column, node: Column, take: Column, total: Column, seed: int) -> Column:
    """Blocks of each source that ``take`` draws without replacement get out of ``total``.

    The blocks with the smallest hashes are drawn: exactly ``take``, all sets of as many alike, so the
    numbers by source follow the multivariate hypergeometric law.
    """
    none = F.array().cast("array<struct<hash:string,key:string>>")

    def blocks(quota: Column) -> Column:
        numbers = F.sequence(F.lit(1).cast("bigint"), F.greatest(quota["n"], F.lit(1)))
        named = F.transform(
            numbers,
            lambda i: F.struct(
                _digest(seed, node.cast("string"), quota["key"], i.cast("string")).alias("hash"), quota["key"].alias("key")
            ),
        )
        return F.when(quota["n"] > 0, named).otherwise(none)

    chosen = F.slice(F.array_sort(F.flatten(F.transform(quotas, blocks))), F.lit(1), take.cast("int"))

    def hits(quota: Column) -> Column:
        n = F.size(F.filter(chosen, lambda b: b["key"] == quota["key"])).cast("bigint")
        return F.struct(quota["key"].alias("key"), F.when(take >= total, quota["n"]).otherwise(n).alias("n"))

    return F.transform(quotas, hits)


def _sum(quotas: str) -> Column:
    return F.aggregate(quotas, F.lit(0).cast("bigint"), lambda s, q: s + q["n"])


def split_quotas(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """Blocks that every shard gets of every source: ``shard, key, n``.

    Sources lie in buckets, about as many as each has sources, and a row holds the quotas of a node and
    bucket. At each level a node draws its left half from the totals of the buckets, and every bucket
    then draws what fell to it from its sources. No row holds more than about the square root of the
    number of sources. Shards get equal numbers of blocks, to within one.
    """
    buckets = math.isqrt(max(0, quotas.count() - 1)) + 1
    code = F.conv(F.substring(F.md5("key"), 1, 8), 16, 10).cast("bigint") % buckets
    entry = F.struct("key", F.col("n").cast("bigint").alias("n"))
    nodes = (
        quotas.groupBy(code.cast("string").alias("bucket"))
        .agg(F.sort_array(F.collect_list(entry)).alias("quotas"))
        .select(F.lit(1).cast("bigint").alias("node"), "bucket", "quotas", _sum("quotas").alias("n"))
    )
    for _ in range(levels):
        sums = nodes.groupBy("node").agg(
            F.sort_array(F.collect_list(F.struct(F.col("bucket").alias("key"), "n"))).alias("buckets"),
            F.sum("n").alias("total"),
        )
        left = _drawn(F.col("buckets"), F.col("node"), F.expr("total div 2"), F.col("total"), seed)
        shares = sums.select("node", F.inline(left)).select("node", F.col("key").alias("bucket"), F.col("n").alias("take"))
        drawn = nodes.join(shares, ["node", "bucket"]).withColumn(
            "left", _drawn(F.col("quotas"), F.col("node"), F.col("take"), F.col("n"), seed)
        )
        rest = F.zip_with("quotas", "left", lambda q, d: F.struct(q["key"].alias("key"), (q["n"] - d["n"]).alias("n")))
        halves = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quotas"), F.col("take").alias("n")),
            F.struct((F.col("node") * 2 + 1).alias("node"), rest.alias("quotas"), (F.col("n") - F.col("take")).alias("n")),
        )
        halved = drawn.select("bucket", F.explode(halves).alias("half")).select("half.node", "bucket", "half.quotas", "half.n")
        nodes = staged(halved)
    return nodes.select((F.col("node") - (1 << levels)).alias("shard"), F.inline("quotas"))


def deal(taken: DataFrame, levels: int = LEVELS, blocks_per_shard: int = BLOCKS_PER_SHARD, seed: int = 1) -> DataFrame:
    """Give every copy a ``block``, a ``shard`` and a ``local_order`` in the shard.

    There are 2^``levels`` shards of about ``blocks_per_shard`` blocks. The number of blocks does
    not depend on the data; their size in words does. Sort a shard by ``local_order`` to shuffle it.
    """
    words = taken.agg(F.sum("size")).first()[0] or 0
    width = max(1, -(-words // (blocks_per_shard << levels)))
    blocked = taken.withColumn("block", F.expr(f"offset div {width}"))
    blocks = staged(blocked.select("key", "block").distinct())
    quotas = blocks.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    shares = split_quotas(quotas, levels, seed).where("n > 0")
    earlier = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    places = shares.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select(
        "key", "shard", F.explode(F.expr("sequence(start, start + n - 1)")).alias("place")
    )
    shuffled = Window.partitionBy("key").orderBy(_digest(seed, "key", F.col("block").cast("string")), "block")
    permuted = blocks.withColumn("place", (F.row_number().over(shuffled) - 1).cast("bigint"))
    owners = permuted.join(places, ["key", "place"]).select("key", "block", "shard")
    return blocked.join(owners, ["key", "block"]).withColumn(
        "local_order", F.xxhash64(F.lit(seed), "row_id", "copy")
    )


def rows_to_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"):
    """One narrow row per document: ``row_id, doc_id, source, key, size``; stage before use."""
    source = F.col(f"`{source_col}`").cast("string")
    return docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(f"`{id_col}`").alias("doc_id"),
        source.alias("source"),
        source_key(source).alias("key"),
        word_count(F.col(f"`{text_col}`")).alias("size"),
    )


def mix(rows: DataFrame, weights: Sequence[int], seed: int = 1, levels: int = LEVELS):
    """The mix of staged ``rows`` (see ``rows_to_mix``) and its targets, as two DataFrames.

    The first has one row per taken copy: ``row_id, key, size, copy, offset, block, shard,
    local_order``; the second ``key, source, source_size, target``. A null text has size 0; null and
    empty sources are sources of their own. Repeated rows are separate documents: each is taken at
    most ``PASSES`` times. An empty table gives an empty mix. Rerunning on the same rows gives the
    same result; among documents equal in id and size the choice is open.
    """
    sources = rows.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    wanted = staged(targets(sources, weights))
    taken = staged(copies(rows, wanted, seed))
    return deal(taken, levels, seed=seed), wanted


def shards_of(taken: DataFrame) -> DataFrame:
    """``row_id, taken, shards``: words that the shards drew of a document, and ``shard:words`` by copy."""
    copy = F.struct("copy", F.concat_ws(":", F.col("shard").cast("string"), F.col("size").cast("string")).alias("text"))
    texts = F.transform(F.sort_array(F.collect_list(copy)), lambda c: c["text"])
    return taken.groupBy("row_id").agg(F.sum("size").alias("taken"), F.array_join(texts, " ").alias("shards"))


def mixed_documents(docs: DataFrame, weights: Sequence[int], seed: int = 1) -> DataFrame:
    """Rows of ``docs`` in the mix, as often as they are taken, with all their columns.

    They come shard by shard, each in its local order, cut into ranges of even size. The documents are
    written once with a row id, so that copies find their row whatever its id.
    """
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc")
    kept = staged(docs.select(row, F.monotonically_increasing_id().alias("row_id")))
    source = F.col("doc.source").cast("string")
    rows = staged(
        kept.select(
            "row_id",
            F.col("doc.doc_id").alias("doc_id"),
            source.alias("source"),
            source_key(source).alias("key"),
            word_count(F.col("doc.text")).alias("size"),
        )
    )
    taken, _ = mix(rows, weights, seed)
    place = staged(taken.select("row_id", "shard", "local_order", "copy"))
    ordered = kept.join(place, "row_id").repartitionByRange("shard", "local_order", "row_id", "copy")
    return ordered.sortWithinPartitions("shard", "local_order", "row_id", "copy").select("doc.*")
