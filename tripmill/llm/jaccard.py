"""Exact n-gram Jaccard join by prefix lists that skip what set relations already decide.

Only shingles that two different sets share can be in an intersection, and a set is kept by its rarest
ones first, so three steps come before any pair is looked at:

1. Sets are identified by a hash; equal texts are one set from here on.
2. Shingles are dealt out by hash to tasks that count the sets of each and return, to every set, its
   shared shingles with their counts. Shingles that many sets share are found beforehand and dealt out
   salted. A set that shares too few of its shingles to reach the threshold with anybody is done.
3. The rarest shared shingles of the others form index lists, in which a set has a position.

Candidates are taken from the lists by skipping, in place of all pairs of a list:

* by position: of two sets in a list, the shorter must stand within its index prefix, and the shingles
  that are left from both positions must suffice for the overlap (index-level skipping);
* by size: lists are cut into blocks of sizes, and a block meets only blocks it can match;
* by answers: a list's most central set is compared with the rest of the list first. Sets that end up
  in one component need no further comparison, and two sets whose distances from the central one differ
  by more than the threshold cannot be linked (answer-level skipping). Only what is still open between
  components is compared pair by pair, after several such rounds.

Every comparison is exact, by intersecting the lists of shared shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm import tokens
from tripmill.llm.components import components
from tripmill.plans.staging import staged

SHINGLE = 5
#: A shingle that more sets share than this share of all, and this number, is dealt out salted.
HOT_SHARE = 0.001
HOT_SETS = 1000
#: Star rounds go on while the pairs between components of a list are more than so many times the entries.
OPEN_FACTOR = 100.0
STAR_ROUNDS = 6
_LOW = np.uint64(16)


def _sets(batch: pa.RecordBatch, shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a batch whose second column is the text."""
    words = tokens.words(batch.column(1))
    hashes = words.hashes
    found = []
    for start, end in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        length = min(shingle, end - start)
        if length == 0:
            found.append(np.zeros(0, dtype=np.uint64))
            continue
        seeded = tokens.runs(hashes[start:end], int(length))
        if length < shingle:  # a short sequence as a whole, never equal to a shingle
            seeded = tokens.mix(seeded + np.uint64(length))
        found.append(np.unique(seeded))
    return found


def _set_id(members: np.ndarray) -> int:
    """Hash of a set, by a sum that does not depend on order."""
    total = int(np.add.reduce(tokens.mix(members + np.uint64(1)), dtype=np.uint64))
    return int(tokens.mix(np.array([total ^ (len(members) * 0x9E3779B97F4A7C15 % (1 << 64))], np.uint64))[0])


def _signed(values) -> np.ndarray:
    return np.asarray(values, dtype=np.uint64).view(np.int64)


def sets_of(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, sid, often``: size and identity of the shingle set of every row.

    ``sid`` is a 64-bit hash of the set; it is null for an empty set. The first row of a slice of texts
    carries, in ``often``, the shingles that half of HOT_SHARE of the slice's different sets have.
    """
    kept = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = kept.schema.fields[0].dataType.simpleString()
    entry = pa.list_(pa.struct([("shingle", pa.int64()), ("n", pa.int64())]))

    def run(batches):
        for batch in batches:
            for part in tokens.slices(batch, 1):
                sets = _sets(part, shingle)
                ids = _signed([_set_id(s) for s in sets])
                empty = np.array([len(s) == 0 for s in sets], dtype=bool)
                different = {i: s for i, s in zip(ids, sets, strict=True) if len(s)}
                values, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *different.values()]), return_counts=True)
                common = counts >= max(2, HOT_SHARE / 2 * len(different))
                often = [{"shingle": int(v), "n": int(n)} for v, n in zip(_signed(values[common]), counts[common], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(ids, pa.int64(), mask=empty),
                        pa.array([often] + [None] * (len(part) - 1), entry),
                    ],
                    names=["doc_id", "n_shingles", "sid", "often"],
                )

    return kept.mapInArrow(
        run, f"doc_id {schema}, n_shingles bigint, sid bigint, often array<struct<shingle: bigint, n: bigint>>"
    )


def _distinct_sets(part: pa.RecordBatch, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different sets of a slice: their ids and sizes, all members, and the set of each member."""
    sets = {_set_id(s): s for s in _sets(part, shingle) if len(s)}
    sizes = np.array([len(s) for s in sets.values()], dtype=np.uint32)
    members = np.concatenate(list(sets.values())) if sets else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
    return np.fromiter(sets.keys(), np.uint64, len(sets)), sizes, members, owner


def hot_shingles(rows: DataFrame) -> np.ndarray:
    """Shingles that about HOT_SHARE of all sets and HOT_SETS sets or more have, sorted.

    ``rows`` is staged ``sets_of``. A shingle is counted in the slices that list it; the counts add up to
    half of HOT_SHARE at least for every shingle above it. As sets have a mean number of shingles, there
    are at most 2 * mean / HOT_SHARE hot ones, whatever the number of texts.
    """
    n_sets = rows.agg(F.approx_count_distinct("sid")).first()[0]
    floor = max(HOT_SETS, HOT_SHARE * n_sets) / 2
    counted = rows.select(F.explode("often").alias("o")).groupBy("o.shingle").agg(F.sum("o.n").alias("n"))
    found = counted.where(F.col("n") >= floor).select("shingle").toPandas()["shingle"].to_numpy(dtype=np.int64)
    return np.sort(found.view(np.uint64))


def shared_shingles(docs: DataFrame, shingle: int, shards: int, hot: np.ndarray, text_col: str = "text") -> DataFrame:
    """Blobs of shared shingles by set bucket: ``bucket, sets, sizes, members, counts``.

    A shingle is identified by its shard and its upper 48 bits. ``counts`` is the number of different
    sets that share it, 2 or more; hot ones count as the largest number.
    """
    texts = docs.select(F.lit(0).alias("_"), F.col(f"`{text_col}`").alias("text"))
    known = texts.sparkSession.sparkContext.broadcast(hot)

    def deal(batches):
        hot = known.value
        for batch in batches:
            for part in tokens.slices(batch, 1):
                ids, sizes, members, owner = _distinct_sets(part, shingle)
                if not len(ids):
                    continue
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, members), len(hot) - 1)
                    is_hot = hot[at] == members
                else:
                    is_hot = np.zeros(len(members), dtype=bool)
                shard = ((members & np.uint64(0xFFFF)) * np.uint64(shards)) >> _LOW
                token = ((members >> _LOW) << _LOW) | shard
                shard[is_hot] = tokens.mix(ids)[owner[is_hot]] % np.uint64(shards)
                order = np.lexsort((token, is_hot, shard))
                token, owner, is_hot, shard = token[order], owner[order], is_hot[order], shard[order]
                cuts = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
                for s in np.flatnonzero(np.diff(cuts)):
                    here = slice(cuts[s], cuts[s + 1])
                    cold = int((~is_hot[here]).sum())
                    mine, local = np.unique(owner[here], return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(s)], pa.int32()),
                            pa.array([cold], pa.int64()),
                            pa.array([tokens.pack(ids[mine])], pa.binary()),
                            pa.array([tokens.pack(sizes[mine])], pa.binary()),
                            pa.array([tokens.pack_steps(token[here])], pa.binary()),
                            pa.array([tokens.pack(local.astype(np.uint32))], pa.binary()),
                        ],
                        names=["shard", "cold", "sets", "sizes", "tokens", "owners"],
                    )

    def count(table: pa.Table) -> pa.Table:
        ids, sizes, token, cold = [], [], [], []
        for row in table.to_pylist():
            owner = tokens.unpack(row["owners"], np.uint32)
            ids.append(tokens.unpack(row["sets"])[owner])
            sizes.append(tokens.unpack(row["sizes"], np.uint32)[owner])
            token.append(tokens.unpack_steps(row["tokens"]))
            cold.append(np.arange(len(owner)) < row["cold"])
        ids, sizes, token, cold = (np.concatenate(x) for x in (ids, sizes, token, cold))
        order = np.lexsort((ids, token))
        ids, sizes, token, cold = ids[order], sizes[order], token[order], cold[order]
        first = np.ones(len(ids), dtype=bool)
        first[1:] = (ids[1:] != ids[:-1]) | (token[1:] != token[:-1])
        ids, sizes, token, cold = ids[first], sizes[first], token[first], cold[first]
        start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        lengths = np.diff(np.append(start, len(token)))
        n = np.repeat(lengths, lengths).astype(np.uint32)
        n[~cold] = np.iinfo(np.uint32).max
        kept = n >= 2
        ids, sizes, token, n = ids[kept], sizes[kept], token[kept], n[kept]
        bucket = tokens.mix(ids) % np.uint64(shards)
        order = np.lexsort((ids, bucket))
        ids, sizes, token, n, bucket = ids[order], sizes[order], token[order], n[order], bucket[order]
        cuts = np.searchsorted(bucket, np.arange(shards + 1, dtype=np.uint64))
        full = np.flatnonzero(np.diff(cuts))
        parts = [slice(cuts[b], cuts[b + 1]) for b in full]
        return pa.table(
            {
                "bucket": pa.array(full.astype(np.int32)),
                "sets": pa.array([tokens.pack_steps(ids[p]) for p in parts], pa.binary()),
                "sizes": pa.array([tokens.pack(sizes[p]) for p in parts], pa.binary()),
                "members": pa.array([tokens.pack(token[p]) for p in parts], pa.binary()),
                "counts": pa.array([tokens.pack(n[p]) for p in parts], pa.binary()),
            }
        )

    dealt = texts.mapInArrow(deal, "shard int, cold bigint, sets binary, sizes binary, tokens binary, owners binary")
    return dealt.groupBy("shard").applyInArrow(
        count, "bucket int, sets binary, sizes binary, members binary, counts binary"
    )


def candidates(shared: DataFrame, percent: int) -> DataFrame:
    """``sid, n, members``: the sets that share enough shingles to be linked at all.

    ``members`` are a set's shared shingles, the rarest first and ties by value, which is one order for
    all sets. The unshared ones would come before them. A set of n shingles needs an overlap of
    ceil(percent / 100 * n) with a partner.
    """

    def gather(table: pa.Table) -> pa.Table:
        parts = [
            (tokens.unpack_steps(r["sets"]), tokens.unpack(r["sizes"], np.uint32), tokens.unpack(r["members"]),
             tokens.unpack(r["counts"], np.uint32))
            for r in table.to_pylist()
        ]
        ids, sizes, token, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((token, n, ids))
        ids, sizes, token = ids[order], sizes[order], token[order]
        start = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        end = np.append(start[1:], len(ids))
        size = sizes[start].astype(np.int64)
        enough = 100 * (end - start) >= percent * size
        lists = [_signed(token[a:b]) for a, b in zip(start[enough], end[enough], strict=True)]
        return pa.table(
            {
                "sid": pa.array(_signed(ids[start[enough]])),
                "n": pa.array(size[enough]),
                "members": pa.array(lists, pa.list_(pa.int64())),
            }
        )

    return shared.groupBy("bucket").applyInArrow(gather, "sid bigint, n bigint, members array<bigint>")


def index_lists(sets: DataFrame, percent: int) -> DataFrame:
    """``token, sid, n, rest``: entries of the prefix lists.

    ``rest`` counts the shingles of the set from this one on; the position in the list's order is
    n - rest. The prefix of a set is its first n - ceil(percent / 100 * n) + 1 shingles.
    """
    length = F.size("members")
    prefix = F.expr(f"n - (({percent} * n + 99) div 100) + 1 - (n - size(members))").cast("int")
    first = F.slice("members", F.lit(1), F.least(prefix, length))
    return sets.select("sid", "n", length.alias("shared"), F.posexplode(first).alias("at", "token")).select(
        "token", "sid", "n", (F.col("shared") - F.col("at")).cast("bigint").alias("rest")
    )


def _may_link(n1: str, rest1: str, n2: str, rest2: str, percent: int) -> Column:
    """Whether size and position leave room for the overlap percent / (100 + percent) * (n1 + n2)."""
    size = 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)
    return size & ((100 + percent) * F.least(rest1, rest2) >= percent * (F.col(n1) + F.col(n2)))


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b, overlap, union, linked`` of distinct pairs of sets, by intersecting their lists."""
    left = sets.select(F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("members").alias("m_a"))
    right = sets.select(F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("members").alias("m_b"))
    joined = pairs.join(right, "b").join(left, "a")
    overlap = F.size(F.array_intersect("m_a", "m_b")).cast("bigint")
    counted = joined.select("a", "b", overlap.alias("overlap"), (F.col("n_a") + F.col("n_b")).alias("both"))
    union = F.col("both") - F.col("overlap")
    return counted.select("a", "b", "overlap", union.alias("union"), (100 * F.col("overlap") >= percent * union).alias("linked"))


def _stars(entries: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Central set of each list, and the pairs (``a`` the central set, ``b``) that may link.

    The central set has the fewest rarer shingles before the list's own. It is found by partial minima.
    """
    central = entries.groupBy("token").agg(
        F.min(F.struct((F.col("n") - F.col("rest")).alias("before"), "sid", "n", "rest")).alias("c")
    ).select("token", F.col("c.sid").alias("center"), F.col("c.n").alias("center_n"), F.col("c.rest").alias("center_rest"))
    joined = entries.join(central, "token").where("sid <> center")
    pairs = joined.where(_may_link("n", "rest", "center_n", "center_rest", percent))
    return central, pairs.select(F.col("center").alias("a"), F.col("sid").alias("b")).distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def useful(entries: DataFrame, percent: int) -> DataFrame:
    """Entries that size and position leave a possible partner in their list.

    The shorter set of a linked pair (any of two equal ones) stands within its index prefix: what is
    left of it from its position on must suffice for a partner of its own size. An entry is useful if it
    is of that kind, or if the shortest of that kind in the list is short enough for it.
    """
    index = (100 + percent) * F.col("rest") >= 2 * percent * F.col("n")
    room = (100 + percent) * F.col("rest") - percent * F.col("n")
    shortest = (
        entries.groupBy("token")
        .agg(F.min(F.when(index, F.col("n"))).alias("least"), F.count(F.lit(1)).alias("m"))
        .where("least is not null and m > 1")
        .select("token", "least")
    )
    return entries.join(shortest, "token").where(index | (room >= percent * F.col("least"))).drop("least")


def links(sets: DataFrame, percent: int) -> DataFrame:
    """Component of every set that is linked: ``sid, comp``. ``sets`` is staged ``candidates``."""
    entries = staged(useful(index_lists(sets, percent), percent))
    total = entries.count()
    linked, first_central = None, None
    done: list[DataFrame] = []
    open_entries = entries
    for star in range(STAR_ROUNDS):
        central, pairs = _stars(open_entries, percent)
        central = staged(central)
        first_central = first_central or central
        fresh = _ordered(pairs)
        for old in done:
            fresh = fresh.join(old.select("a", "b"), ["a", "b"], "left_anti")
        result = staged(compared(fresh, sets, percent))
        done.append(result)
        found = result.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
        linked = found if linked is None else linked.union(found)
        comps = staged(components(linked))
        undecided = staged(_undecided(entries, comps, percent))
        if star + 1 == STAR_ROUNDS or _cross_pairs(undecided) <= OPEN_FACTOR * total:
            break
        # Of a list that holds several components, the next star starts from another one than the last.
        last = undecided.join(central.select("token", F.col("center").alias("sid")), ["token", "sid"]).select(
            "token", F.col("comp").alias("last")
        )
        away = undecided.join(last, "token", "left").where(F.col("last").isNull() | (F.col("comp") != F.col("last")))
        open_entries = staged(away.select("token", "sid", "n", "rest"))
    rest = _open_pairs(_with_distance(undecided, first_central, done[0]), done, percent)
    final = staged(compared(rest, sets, percent).where("linked"))
    if final.isEmpty():
        return comps.select(F.col("node").alias("sid"), F.col("component").alias("comp"))
    found = final.select(F.col("a").alias("u"), F.col("b").alias("v"))
    return components(comps.select(F.col("node").alias("u"), F.col("component").alias("v")).union(found)).select(
        F.col("node").alias("sid"), F.col("component").alias("comp")
    )


def _cross_pairs(undecided: DataFrame) -> int:
    """Pairs of entries of one list from different components, before size and position rule any out."""
    parts = undecided.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
    lists = parts.groupBy("token").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("own"))
    return lists.agg(F.sum((F.col("m") * F.col("m") - F.col("own")) / 2)).first()[0] or 0


def _undecided(entries: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Entries, with their component, of lists that hold several components."""
    placed = entries.join(comps, entries["sid"] == comps["node"], "left").select(
        "token", "sid", "n", "rest", F.coalesce("component", "sid").alias("comp")
    )
    split = placed.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    return useful(placed.join(split.select("token"), "token"), percent)


def _with_distance(undecided: DataFrame, central: DataFrame, answers: DataFrame) -> DataFrame:
    """Add ``distance``, the Jaccard distance from the list's first central set where it was compared."""
    known = answers.select("a", "b", (1 - F.col("overlap") / F.col("union")).alias("found"))
    paired = undecided.join(central, "token", "left").withColumn("a", F.least("sid", "center")).withColumn(
        "b", F.greatest("sid", "center")
    )
    distance = F.when(F.col("sid") == F.col("center"), F.lit(0.0)).otherwise(F.col("found"))
    return paired.join(known, ["a", "b"], "left").select(*undecided.columns, distance.alias("distance"))


def _open_pairs(undecided: DataFrame, done: list[DataFrame], percent: int) -> DataFrame:
    """Pairs of a list from different components that no rule decides, each once.

    By the triangle inequality, distances from one set that differ by more than the threshold rule a
    pair out. Lists are cut into blocks of sizes in steps of 100 / percent: a set meets its own block and the
    next larger one.
    """
    block = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent))).cast("int")
    shorter = undecided.select(
        "token", F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("rest").alias("rest_a"),
        F.col("comp").alias("comp_a"), F.col("distance").alias("d_a"), F.explode(F.array(block - 1, block, block + 1)).alias("block"),
    ).where((100 + percent) * F.col("rest_a") >= 2 * percent * F.col("n_a"))  # within the index prefix
    longer = undecided.select(
        "token", F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("rest").alias("rest_b"),
        F.col("comp").alias("comp_b"), F.col("distance").alias("d_b"), block.alias("block"),
    )
    apart = F.coalesce(F.abs(F.col("d_a") - F.col("d_b")), F.lit(0.0))
    met = shorter.join(longer, ["token", "block"]).where(
        (F.col("comp_a") != F.col("comp_b"))
        & ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b"))))
        & _may_link("n_a", "rest_a", "n_b", "rest_b", percent)
        & (apart <= 1 - percent / 100 + 1e-9)
    )
    pairs = _ordered(met.select("a", "b"))
    for old in done:
        pairs = pairs.join(old.select("a", "b"), ["a", "b"], "left_anti")
    return pairs


def join(docs: DataFrame, percent: int = 75, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Two rows are linked if their shingle sets have a Jaccard similarity of ``percent`` or more;
    ``component_id`` is the smallest id that a row reaches by links, its own included. A null, empty or
    blank text has an empty set and is linked with nothing. Texts of fewer words than a shingle are one
    shingle. Repeated rows are linked with each other. Null ids are never the smallest; a component
    of null ids alone has a null one. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    shards = max(1, min(1 << 16, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = staged(sets_of(docs, shingle, id_col, text_col))
    hot = hot_shingles(rows)
    sets = staged(candidates(shared_shingles(docs, shingle, shards, hot, text_col), percent))
    comps = staged(links(sets, percent))
    classes = rows.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("least"))
    members = classes.join(comps, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    smallest = members.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = staged(members.join(smallest, "comp").select("sid", "component_id"))
    return rows.join(named, "sid", "left").select(
        "doc_id", "n_shingles", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def without_copies(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id, and all columns.

    Of rows that agree in id and text one stays. Rows of one id and different texts count as one
    document; rows with a null id cannot be told apart and stay.
    """
    joined = join(docs, percent, id_col=id_col, text_col=text_col)
    gone = staged(joined.where("doc_id <> component_id").select(F.col("doc_id").alias(id_col)).distinct())
    left = docs.join(gone, id_col, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    same = Window.partitionBy(F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text_col}`"))).orderBy(F.lit(0))
    first = F.row_number().over(same)
    packed = left.select(F.struct("*").alias("row"), first.alias("place"))
    return packed.where("place = 1 or row.`%s` is null" % id_col).select("row.*")
