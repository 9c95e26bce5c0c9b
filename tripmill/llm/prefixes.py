"""A z-fast trie of conversations: which ones start alike, and how far.

Every prefix of a conversation has a 128-bit hash, the exclusive or of the hashes of its turns and their
positions. The trie is compacted: one row per branching or ending node, with the turns of the edge above
it. A node is found by its handle, the hash at the two-fattest depth of its edge (the depth divisible by
the largest power of two). A conversation finds the node at which it leaves the trie by a fat binary
search over depths: every probe is a join of one hash per conversation with the handles, and a
conversation of n turns needs at most log2(n) + 1 of them.

Conversations are inserted in batches. All that are not in the trie yet locate their exit node; the edges
that they leave are split; and of those that leave at the same place with the same turn, one is inserted
with all its remaining turns. The others find more of their turns in the trie the next time. As that one is
chosen by its hash, the number of batches grows with the logarithm of the number of conversations.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.operators.heavy import HeavyKeys, heavy_keys, spread_join
from tripmill.plans.staging import staged, staging_run

IDS_IN_CHUNK = 4096
TURN = "struct<x1: bigint, x2: bigint, n: int>"
NODES = ("x1", "x2", "top", "y1", "y2", "edge")


def turns_in_order(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, d, r1, r2, n``: place from 1, two hashes and code points of every turn.

    Only hashes go through the shuffle. A null role or text is empty, and very long texts are hashed whole.
    Null turn numbers come first; turns of one number, repeated rows among them, are ordered by their
    hashes. Rows without a conversation are left out. An empty table gives an empty result. Other columns
    are not read.
    """
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_col, text_col))
    hashed = rows.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("r1"),
        F.xxhash64(F.lit(2), role, text).alias("r2"),
        F.length(text).alias("n"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "r1", "r2")
    return hashed.select("conv_id", F.row_number().over(order).alias("d"), "r1", "r2", "n")


def sequences(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """``conv_id, path``: the prefix hashes and last code points by depth, for every conversation.

    ``turns`` has ``conv_id, d, r1, r2, n`` with d ascending from 1, gaps allowed; conversations without
    turns get an empty path. A conversation's turns pass one task as a sorted stream; its path is a row of
    24 bytes a turn.
    """
    none = F.lit(None).cast("bigint")
    marked = turns.select("conv_id", "d", "r1", "r2", "n").unionByName(
        conversations.select("conv_id", F.lit(0).alias("d"), none.alias("r1"), none.alias("r2"), F.lit(0).alias("n"))
    )
    order = Window.partitionBy("conv_id").orderBy("d")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    depth = F.row_number().over(order) - 1
    placed = marked.withColumn("depth", depth)

    def prefix(salt: int) -> Column:
        return F.bit_xor(F.when(F.col("depth") > 0, F.xxhash64(F.lit(salt), "depth", "r1", "r2")).otherwise(0)).over(so_far)

    hashed = placed.select("conv_id", "depth", prefix(3).alias("x1"), prefix(4).alias("x2"), "n")
    entry = F.when(F.col("depth") > 0, F.struct("depth", F.struct("x1", "x2", "n").alias("turn")))
    listed = hashed.groupBy("conv_id").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    return listed.select("conv_id", F.transform("entries", lambda e: e["turn"]).cast(f"array<{TURN}>").alias("path"))


def _at(path: str, depth: Column, field: str) -> Column:
    """Hash of the prefix of that depth; 0 at the root."""
    return F.coalesce(F.get(path, depth - 1)[field], F.lit(0).cast("bigint"))


def two_fattest(low: str, high: str) -> Column:
    """The number in (``low``, ``high``] that the largest power of two divides."""
    bits = f"cast(length(bin({low} ^ {high})) AS int) - 1"
    return F.expr(f"cast({high} & shiftleft(-1, {bits}) AS int)")


def no_nodes(like: DataFrame) -> DataFrame:
    """The trie of nothing: the root alone, which is in no table."""
    empty = like.limit(0)
    number = F.lit(0).cast("bigint")
    return empty.select(
        number.alias("x1"), number.alias("x2"), F.lit(0).alias("top"), number.alias("y1"), number.alias("y2"), F.col("path").alias("edge")
    )


def located(rest: DataFrame, nodes: DataFrame, longest: int, common: HeavyKeys | None = None) -> DataFrame:
    """``rest`` (``x1, x2, path, a``) with the node whose edge each conversation leaves, and how deep it gets.

    ``a`` is a depth at which the conversation is known to stand in a node. The search keeps the deepest
    such node in ``a`` and the depth that it cannot pass in ``b``. A handle found there moves ``a`` to its
    node if that node's last prefix is the conversation's too; if not, the conversation leaves on this
    node's edge, and ``b`` drops to where that edge starts. No handle moves ``b`` below the probed depth.
    At the end the edge is found by its first turn, and the turns that agree on it are counted. ``common``
    has the prefixes that very many conversations ask for, whose joins are spread.
    """
    deepest = F.col("top") + F.size("edge")
    fat = nodes.withColumn("deep", deepest).withColumn("f", two_fattest("top", "deep"))
    handles = fat.select(
        F.col("f").alias("hf"),
        F.get("edge", F.col("f") - F.col("top") - 1)["x1"].alias("h1"),
        F.get("edge", F.col("f") - F.col("top") - 1)["x2"].alias("h2"),
        F.col("top").alias("from"),
        F.col("deep").alias("to"),
        F.col("x1").alias("e1"),
        F.col("x2").alias("e2"),
    )
    kept = ["x1", "x2", "path", "a", "b"]
    state = rest.select("x1", "x2", "path", "a", F.size("path").alias("b"))
    for _ in range(longest.bit_length()):
        open_ = F.col("a") < F.col("b")
        # A finished search probes depth 0 with its own hash, which is no handle and spreads evenly.
        probe = state.withColumn("f", F.when(open_, two_fattest("a", "b")).otherwise(0))
        probe = probe.select(
            *kept,
            "f",
            F.when(open_, _at("path", F.col("f"), "x1")).otherwise(F.col("x1")).alias("p1"),
            F.when(open_, _at("path", F.col("f"), "x2")).otherwise(F.col("x2")).alias("p2"),
        )
        hit = spread_join(probe, handles, [("p1", "h1"), ("p2", "h2"), ("f", "hf")], common, ["x1", "x2"], "left")
        through = (F.col("to") <= F.size("path")) & (_at("path", F.col("to"), "x1") == F.col("e1")) & (_at("path", F.col("to"), "x2") == F.col("e2"))
        found = F.col("hf").isNotNull()
        a = F.when(found, F.when(through, F.col("to")).otherwise(F.col("from"))).otherwise(F.col("a"))
        b = F.when(found, F.when(through, F.col("b")).otherwise(F.col("from"))).when(open_, F.col("f") - 1).otherwise(F.col("b"))
        state = hit.select("x1", "x2", "path", a.alias("a"), b.alias("b"))
    names = nodes.select(
        F.col("top").alias("top"),
        F.get("edge", F.lit(0))["x1"].alias("n1"),
        F.get("edge", F.lit(0))["x2"].alias("n2"),
        F.col("x1").alias("v1"),
        F.col("x2").alias("v2"),
        "edge",
    )
    more = F.col("a") < F.size("path")
    asked = state.select(
        "x1",
        "x2",
        "path",
        "a",
        F.when(more, F.col("a")).otherwise(-1).alias("at"),
        F.when(more, _at("path", F.col("a") + 1, "x1")).otherwise(F.col("x1")).alias("p1"),
        F.when(more, _at("path", F.col("a") + 1, "x2")).otherwise(F.col("x2")).alias("p2"),
    )
    left = spread_join(asked, names, [("p1", "n1"), ("p2", "n2"), ("at", "top")], common, ["x1", "x2"], "left")
    agree = F.size(
        F.filter(
            F.arrays_zip(F.col("edge"), F.slice("path", F.col("a") + 1, F.greatest(F.size("edge"), F.lit(0))).alias("own")),
            lambda z: (z["edge"]["x1"] == z["own"]["x1"]) & (z["edge"]["x2"] == z["own"]["x2"]),
        )
    )
    depth = F.when(F.col("edge").isNull(), F.col("a")).otherwise(F.col("a") + agree)
    inside = F.col("edge").isNotNull() & (depth < F.col("a") + F.size("edge"))
    return left.select(
        "x1", "x2", "path", depth.alias("depth"), F.when(inside, F.col("v1")).alias("v1"), F.when(inside, F.col("v2")).alias("v2")
    )


def split(nodes: DataFrame, places: DataFrame) -> DataFrame:
    """``nodes`` with edges cut where a conversation ends or leaves inside them."""
    cuts = places.where("v1 IS NOT NULL").groupBy("v1", "v2", "depth").agg(F.count(F.lit(1)).alias("n"))
    cuts = cuts.groupBy("v1", "v2").agg(F.sort_array(F.collect_list("depth")).alias("cuts"))
    joined = nodes.join(cuts, (F.col("x1") == F.col("v1")) & (F.col("x2") == F.col("v2")), "left")
    end = F.col("top") + F.size("edge")
    none = F.array().cast("array<int>")
    bounds = F.concat(F.array("top"), F.coalesce("cuts", none), F.array(end))
    pieces = F.transform(
        F.sequence(F.lit(1), F.size("bounds") - 1),
        lambda i: F.struct(F.get("bounds", i - 1).alias("low"), F.get("bounds", i).alias("high")),
    )
    cut = joined.withColumn("bounds", bounds).select("top", "y1", "y2", "edge", F.inline(pieces))
    above = F.get("edge", F.col("low") - F.col("top") - 1)
    last = F.get("edge", F.col("high") - F.col("top") - 1)
    first = F.col("low") == F.col("top")
    return cut.select(
        last["x1"].alias("x1"),
        last["x2"].alias("x2"),
        F.col("low").alias("top"),
        F.when(first, F.col("y1")).otherwise(above["x1"]).alias("y1"),
        F.when(first, F.col("y2")).otherwise(above["x2"]).alias("y2"),
        F.slice("edge", F.col("low") - F.col("top") + 1, F.col("high") - F.col("low")).alias("edge"),
    )


def build(paths: DataFrame) -> DataFrame:
    """The compacted trie of distinct ``paths`` (``x1, x2, path``), staged: a row per node but the root.

    ``x1, x2`` identify a node by the hash of its prefix, ``y1, y2`` its parent (0, 0 is the root), ``top``
    is the parent's depth, and ``edge`` has hash and last code points of every prefix below it.
    """
    rest = paths.where(F.size("path") > 0).select("x1", "x2", "path", F.lit(0).alias("a"))
    nodes = no_nodes(paths)
    common = heavy_keys(paths.select(F.inline("path")).select("x1"), ["x1"])["x1"]
    longest, left = paths.agg(F.coalesce(F.max(F.size("path")), F.lit(0)), F.count(F.when(F.size("path") > 0, 1))).first()
    first = True
    while left:
        # The first batch meets an empty trie, and leaves it at the root.
        none = F.lit(None).cast("bigint")
        places = rest.select("x1", "x2", "path", F.lit(0).alias("depth"), none.alias("v1"), none.alias("v2"))
        if not first:
            places = staged(located(rest, nodes, longest, common))
        leaving = places.where(F.col("depth") < F.size("path"))
        name = [_at("path", F.col("depth") + 1, f).alias(f"next{f}") for f in ("x1", "x2")]
        chosen = leaving.groupBy("depth", *name).agg(F.min(F.struct("x1", "x2", "path")).alias("one"))
        chosen = staged(chosen.select("depth", "one.*"))
        leaves = chosen.select(
            "x1",
            "x2",
            F.col("depth").alias("top"),
            _at("path", F.col("depth"), "x1").alias("y1"),
            _at("path", F.col("depth"), "x2").alias("y2"),
            F.slice("path", F.col("depth") + 1, F.size("path")).alias("edge"),
        )
        old = nodes if first else split(nodes, places)
        nodes = staged(old.select(*NODES).unionByName(leaves))
        rest = leaving.join(chosen.select("x1", "x2"), ["x1", "x2"], "left_anti")
        rest = staged(rest.select("x1", "x2", "path", F.col("depth").alias("a")))
        left, first = rest.count(), False
    return nodes


def _to_parent(rows: DataFrame, up: DataFrame, p1: str, p2: str) -> DataFrame:
    """``rows`` joined with the row ``a1, a2`` of ``up`` that they name; those of a node with very many
    children are spread."""
    return spread_join(rows, up, [(p1, "a1"), (p2, "a2")], heavy_keys(rows, [p1])[p1], ["x1", "x2"])


def ancestors(nodes: DataFrame) -> list[DataFrame]:
    """Staged tables (``x1, x2, u1, u2``) of every node's ancestor 1, 2, 4, 8 ... nodes up, where it has one
    below the root."""
    level = staged(nodes.select("x1", "x2", F.col("y1").alias("u1"), F.col("y2").alias("u2")).where("u1 <> 0 OR u2 <> 0"))
    levels = []
    while level.limit(1).count():
        levels.append(level)
        up = level.select(F.col("x1").alias("a1"), F.col("x2").alias("a2"), F.col("u1").alias("w1"), F.col("u2").alias("w2"))
        further = _to_parent(level, up, "u1", "u2").select("x1", "x2", F.col("w1").alias("u1"), F.col("w2").alias("u2"))
        level = staged(further)
    return levels


def below(values: DataFrame, levels: list[DataFrame], merges: dict[str, str]) -> DataFrame:
    """``values`` (``x1, x2`` and columns) merged over all nodes of each subtree, its top included.

    In step i every node hands what it has to its ancestor 2^i nodes up, and so holds what lies less than
    2^(i+1) nodes below it: as many steps as the height of the trie has bits, each a grouping with partial
    sums. ``merges`` names ``sum`` or ``min`` for each column.
    """
    both = {"sum": lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0)), "min": F.least}
    for level in levels:
        parts = [F.expr(f"{how}({c})").alias(f"more_{c}") for c, how in merges.items()]
        handed = values.join(level, ["x1", "x2"]).groupBy("u1", "u2").agg(*parts)
        handed = handed.withColumnsRenamed({"u1": "x1", "u2": "x2"})
        merged = [both[how](c, f"more_{c}").alias(c) for c, how in merges.items()]
        values = staged(values.join(handed, ["x1", "x2"], "left").select("x1", "x2", *merged))
    return values


def ends_hashes(ends: DataFrame) -> DataFrame:
    """``x1, x2, ends_sha256``: the hash over the ids of the conversations that end in each node, ascending.

    Ids of one node are sorted over as many tasks as it takes and joined to chunks of ``IDS_IN_CHUNK``;
    the hash of a node, which cannot be split, is taken over the chunks one by one.
    """
    keyed = ends.select("x1", "x2", "conv_id").repartitionByRange("x1", "x2", "conv_id").sortWithinPartitions("x1", "x2", "conv_id")
    kind = ends.schema["conv_id"].dataType.simpleString()

    def join(batches):
        for batch in batches:
            rows, last = [], None
            for x1, x2, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last == (x1, x2) and len(rows[-1][3]) < IDS_IN_CHUNK:
                    rows[-1][3].append(str(conv))
                else:
                    rows.append((x1, x2, conv, [str(conv)]))
                last = (x1, x2)
            x1, x2, first, ids = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x1, pa.int64()), pa.array(x2, pa.int64()), pa.array(first, batch.schema.field("conv_id").type), pa.array([",".join(i) for i in ids], pa.string())],
                names=["x1", "x2", "first", "ids"],
            )

    chunks = keyed.mapInArrow(join, f"x1 bigint, x2 bigint, first {kind}, ids string")
    in_order = chunks.repartition("x1", "x2").sortWithinPartitions("x1", "x2", "first")

    def digest(batches):
        node, found = None, None
        for batch in batches:
            done = []
            for x1, x2, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if node != (x1, x2):
                    if found is not None:
                        done.append((*node, found.hexdigest()))
                    node, found = (x1, x2), hashlib.sha256(ids.encode())
                else:
                    found.update(b"," + ids.encode())
            yield _digests(done)
        if found is not None:
            yield _digests([(*node, found.hexdigest())])

    return in_order.mapInArrow(digest, "x1 bigint, x2 bigint, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    x1, x2, ends = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(x1, pa.int64()), pa.array(x2, pa.int64()), pa.array(ends, pa.string())], names=["x1", "x2", "ends_sha256"]
    )


def trie_nodes(conversations: DataFrame) -> DataFrame:
    """Every node of the trie of ``conversations`` (``conv_id, path``), one row per distinct prefix.

    Columns: ``conv_id`` (smallest conversation that starts with it), ``depth``, ``parent_conv_id`` (the
    parent's), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of the subtree),
    ``saved_tokens`` (code points that storing each prefix once saves in the subtree) and ``ends_sha256``
    (hash of the ids that end here). No conversations give no nodes; the root is a node of depth 0.
    """
    spark = conversations.sparkSession
    with staging_run(spark):
        last = [F.coalesce(F.get("path", F.size("path") - 1)[x], F.lit(0).cast("bigint")).alias(x) for x in ("x1", "x2")]
        hashed = staged(conversations.select("conv_id", *last, "path"))
        ended = F.count(F.lit(1)).alias("n_ends"), F.min("conv_id").alias("least"), F.first("path").alias("path")
        paths = staged(hashed.groupBy("x1", "x2").agg(*ended))
        ends = staged(ends_hashes(hashed.select("x1", "x2", "conv_id")))
        return staged(_described(build(paths.select("x1", "x2", "path")), paths, ends), outlives=True)


def _described(nodes: DataFrame, paths: DataFrame, ends: DataFrame) -> DataFrame:
    """The nodes of all depths, from the compacted ones with what lies below each."""
    kind = paths.schema["least"].dataType.simpleString()
    zero = F.lit(0).cast("bigint")
    children = nodes.groupBy(F.col("y1").alias("x1"), F.col("y2").alias("x2")).agg(F.count(F.lit(1)).alias("n_children"))
    levels = ancestors(nodes)
    counted = staged(
        nodes.select("x1", "x2")
        .join(paths.select("x1", "x2", "n_ends", "least"), ["x1", "x2"], "left")
        .join(children, ["x1", "x2"], "left")
        .select(
            "x1",
            "x2",
            F.coalesce("n_ends", zero).alias("n_convs"),
            F.col("least").alias("conv_id"),
            F.coalesce("n_children", zero).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("n_leaves"),
        )
    )
    merged = below(
        counted.select("x1", "x2", "n_convs", "conv_id", "n_leaves"), levels, {"n_convs": "sum", "conv_id": "min", "n_leaves": "sum"}
    )
    held = F.aggregate("edge", zero, lambda total, t: total + t["n"])
    saved = nodes.join(merged.select("x1", "x2", "n_convs"), ["x1", "x2"]).select(
        "x1", "x2", ((F.col("n_convs") - 1) * held).alias("saved")
    )
    saved = below(staged(saved), levels, {"saved": "sum"})
    about = staged(
        nodes.join(merged, ["x1", "x2"])
        .join(saved, ["x1", "x2"])
        .join(counted.select("x1", "x2", "n_children"), ["x1", "x2"])
        .join(ends, ["x1", "x2"], "left")
    )
    nothing = F.sha2(F.lit(""), 256)
    whole = ("n_convs", "conv_id", "n_children", "n_leaves", "saved", "ends_sha256")
    none = F.lit(None).cast("string").alias("ends_sha256")
    tops = about.where("y1 = 0 AND y2 = 0").withColumn("ends_sha256", none).withColumn("n_children", F.lit(1))
    at_root = paths.where("x1 = 0 AND x2 = 0").select(
        F.col("n_ends").alias("n_convs"), F.col("least").alias("conv_id"), *[F.lit(0).alias(c) for c in whole[2:5]], none
    )
    root_hash = ends.where("x1 = 0 AND x2 = 0").select(
        F.lit(0).alias("n_convs"), F.lit(None).cast(kind).alias("conv_id"), *[F.lit(0).alias(c) for c in whole[2:5]], "ends_sha256"
    )
    parts = tops.select(*whole).unionByName(at_root).unionByName(root_hash)
    root = staged(
        parts.agg(
            F.min("conv_id").alias("conv_id"),
            F.lit(0).cast("bigint").alias("depth"),
            F.lit(None).cast(kind).alias("parent_conv_id"),
            F.sum("n_convs").cast("bigint").alias("n_convs"),
            F.sum("n_children").cast("bigint").alias("n_children"),
            F.greatest(F.sum("n_leaves"), F.lit(1)).cast("bigint").alias("n_leaves"),
            F.sum("saved").cast("bigint").alias("saved_tokens"),
            F.coalesce(F.max("ends_sha256"), nothing).alias("ends_sha256"),
        ).where("n_convs > 0")
    )
    first = root.select("conv_id").first()
    of_parent = about.select(F.col("x1").alias("a1"), F.col("x2").alias("a2"), F.col("conv_id").alias("above"))
    inner = _to_parent(about.where("y1 <> 0 OR y2 <> 0"), of_parent.drop("edge"), "y1", "y2")
    columns = [c for c in about.columns if c not in ("y1", "y2")] + ["above"]
    from_root = about.where("y1 = 0 AND y2 = 0").withColumn("above", F.lit(first and first["conv_id"]).cast(kind))
    edges = from_root.select(*columns).unionByName(inner.select(*columns))
    last = F.col("i") == F.size("edge") - 1
    before = F.aggregate(F.slice("edge", 1, F.col("i")), zero, lambda total, t: total + t["n"])
    expanded = edges.select("*", F.posexplode("edge").alias("i", "t")).select(
        "conv_id",
        (F.col("top") + F.col("i") + 1).cast("bigint").alias("depth"),
        F.when(F.col("i") == 0, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("n_children")).otherwise(1).cast("bigint").alias("n_children"),
        "n_leaves",
        (F.col("saved") - (F.col("n_convs") - 1) * before).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", nothing)).otherwise(nothing).alias("ends_sha256"),
    )
    return root.unionByName(expanded)


def with_shared_starts(turns: DataFrame, most: int, group: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the start of another: ``turns`` and ``conversations``.

    Conversation c starts with the first h turns of c - c % ``group``, where h is crc32 of c modulo
    ``most`` + 1 (all of them if there are fewer, none if that conversation does not exist), and goes on
    with its own turns after its first h. At most ``group`` conversations take from one.
    """
    start = F.crc32(F.col("conv_id").cast("string")) % (most + 1)
    conversations = turns.select("conv_id").distinct()
    takers = conversations.select(
        F.col("conv_id").alias("taker"), start.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("conv_id")
    )
    heads = turns.where(F.col("d") <= most).join(takers, "conv_id").where("d <= h")
    own = turns.where(F.col("d") > start)
    rebuilt = own.select("conv_id", "d", "r1", "r2", "n").unionByName(heads.select(F.col("taker").alias("conv_id"), "d", "r1", "r2", "n"))
    return rebuilt, conversations
