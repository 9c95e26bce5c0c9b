"""Centroid clustering over a VA-file: small cell codes for most decisions, full vectors where they overlap.

Every component of a vector is an integer, and its range is cut into a few cells. A round of the clustering
reads only the cell codes: tables of the least and largest squared difference between a cell and a
centroid's component give an interval for the distance to each centroid (less the distance to one point,
the same for all). Where one interval lies below all others, the centroid is known. Full vectors are fetched, by row number, for the rows whose intervals
overlap and for those that move to another cluster: the sums behind the centroids are carried on by what
moved, in exact integers. All bounds are exact integers too, so the result is that of comparing everything.

The full vectors lie in a table bucketed by row number. A round shuffles row numbers with candidates to it,
never the vectors.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from contextlib import closing
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.plans.staging import staged, staging_run

SCALE = 1024
BITS = 8  # of a component; in data without clear clusters 13 % of rows are fetched a round, 54 % at 6 bits
SPREAD = 3.0  # inner cells cover so many standard deviations on both sides of the mean
BUCKET_ROWS = 500_000

OPENED = "rid bigint, cells binary, was int, candidates array<int>"
FETCHED = "rid bigint, cells binary, was int, cluster int, full array<int>"
ASSIGNED = "vec_id {kind}, cluster int, distance bigint"


def largest(width: int) -> int:
    """The largest integer component whose squared distances a long holds."""
    return min(1 << 27, math.isqrt(((1 << 63) - 1) // width) // 2)


def usable(vectors: DataFrame, vector_col: str, width: int) -> DataFrame:
    """Rows whose vector has ``width`` components, none null, non-finite or beyond :func:`largest`."""
    value = F.col(f"`{vector_col}`")
    limit = largest(width) / SCALE
    # NaN is above every number in Spark, so the comparison excludes it too.
    sound = F.forall(value, lambda x: F.coalesce(x.cast("double").between(-limit, limit), F.lit(False)))
    return vectors.where(F.coalesce((F.size(value) == width) & sound, F.lit(False)))


@dataclass(frozen=True)
class Cells:
    """The cells of every component: ``edges[d]`` has the first integer of each cell, ``low`` and ``high``
    the least and largest integers that occur."""

    edges: np.ndarray
    low: np.ndarray
    high: np.ndarray
    bits: int

    @classmethod
    def spread(cls, low, high, mean, deviation, bits: int) -> Cells:
        """Even cells around the mean; the outermost reach as far as the data do."""
        steps = np.linspace(-SPREAD, SPREAD, (1 << bits) - 1)
        inner = np.floor(mean[:, None] + deviation[:, None] * steps[None, :]).astype(np.int64)
        return cls(np.concatenate([low[:, None], np.clip(inner, low[:, None], high[:, None] + 1)], axis=1), low, high, bits)

    def codes(self, full: np.ndarray) -> np.ndarray:
        """The cell number of each component, a byte each."""
        found = np.empty(full.shape, dtype=np.uint8)
        for d in range(full.shape[1]):
            found[:, d] = np.searchsorted(self.edges[d, 1:], full[:, d], side="right")
        return found

    def packed(self, codes: np.ndarray) -> list[bytes]:
        """``bits`` of each cell number, one after the other."""
        bits = np.unpackbits(codes[:, :, None], axis=2)[:, :, 8 - self.bits :]
        return [row.tobytes() for row in np.packbits(bits.reshape(len(codes), -1), axis=1)]

    def unpacked(self, packed: pa.Array, width: int) -> np.ndarray:
        size = (width * self.bits + 7) // 8
        raw = np.frombuffer(b"".join(packed.to_pylist()), dtype=np.uint8)
        bits = np.unpackbits(raw.reshape(len(packed), size), axis=1)[:, : width * self.bits].reshape(len(packed), width, self.bits)
        return np.packbits(np.concatenate([np.zeros((*bits.shape[:2], 8 - self.bits), np.uint8), bits], axis=2), axis=2)[:, :, 0]

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest squared difference by component, cell and centroid, less that to a point
        amid the centroids.

        The point is the same for all centroids, so the order of distances stays. What is left is linear in
        the component, and its interval is as wide as the centroid is far from the point in that component,
        not as far as the vector is.
        """
        first = self.edges[:, :, None]
        last = np.concatenate([self.edges[:, 1:] - 1, self.high[:, None]], axis=1)[:, :, None]
        middle = centroids.sum(axis=0) // max(1, len(centroids))
        slope = (-2 * (centroids - middle)).T[:, None, :]
        rest = (centroids**2 - middle**2).T[:, None, :]
        ends = first * slope + rest, last * slope + rest
        return np.minimum(*ends), np.maximum(*ends)


def candidates(codes: np.ndarray, least: np.ndarray, most: np.ndarray, first_equal: np.ndarray) -> np.ndarray:
    """Whether each centroid may be the nearest, by row. Centroids equal to an earlier one never are."""
    low = np.zeros((len(codes), least.shape[2]), dtype=np.int64)
    high = np.zeros_like(low)
    for d in range(codes.shape[1]):
        low += least[d][codes[:, d]]
        high += most[d][codes[:, d]]
    return (low <= high.min(axis=1, keepdims=True)) & first_equal[None, :]


def nearest(full: np.ndarray, centroids: np.ndarray, possible: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest possible centroid, the smaller of equals, and the squared distance to it."""
    best = np.full(len(full), np.iinfo(np.int64).max)
    cluster = np.zeros(len(full), dtype=np.int32)
    for k, centroid in enumerate(centroids):
        rows = np.flatnonzero(possible[:, k])
        distance = ((full[rows] - centroid) ** 2).sum(axis=1)
        closer = distance < best[rows]
        best[rows[closer]], cluster[rows[closer]] = distance[closer], k
    return cluster, best


def _distinct(centroids: np.ndarray) -> np.ndarray:
    """True at the first of equal centroids."""
    flags = np.zeros(len(centroids), dtype=bool)
    flags[np.unique(centroids, axis=0, return_index=True)[1]] = True
    return flags


def _matrix(lists, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _lists(flat, lengths, kind) -> pa.ListArray:
    bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, kind))


class VectorFile:
    """The bucketed table of full vectors with their cell codes, and the joins that fetch from it."""

    def __init__(self, rows: DataFrame, width: int, bits: int, folder: str):
        self.width = width
        self.rows = rows
        spark = rows.sparkSession
        self.count, self.cells = self._cells(bits)
        self.table = f"va_{uuid.uuid4().hex}"
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-self.count // BUCKET_ROWS))
        coded = rows.mapInArrow(self._coder(), rows.selectExpr("*", "cast(null as binary) AS cells").schema)
        (
            coded.repartition(buckets, "rid")
            .write.bucketBy(buckets, "rid")
            .option("path", f"{folder}/{self.table}")
            .saveAsTable(self.table)
        )
        self.full = spark.table(self.table)

    def close(self) -> None:
        """Forget the table's name; its files stay as long as the folder."""
        self.full.sparkSession.sql(f"DROP TABLE IF EXISTS {self.table}")

    def _cells(self, bits: int) -> tuple[int, Cells]:
        parts = [F.count(F.lit(1))]
        for d in range(self.width):
            x = F.get("full", F.lit(d))
            parts += [F.min(x), F.max(x), F.avg(x), F.stddev_pop(x)]
        n, *found = self.rows.agg(*[p.alias(f"a{i}") for i, p in enumerate(parts)]).first()
        low, high, mean, deviation = (np.array([v or 0 for v in found[i::4]]) for i in range(4))
        return n, Cells.spread(low.astype(np.int64), high.astype(np.int64), mean, deviation, bits)

    def _coder(self):
        cells, width = self.cells, self.width

        def code(batches):
            for batch in batches:
                packed = cells.packed(cells.codes(_matrix(batch.column("full"), width)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(packed, pa.binary())], names=[*batch.schema.names, "cells"])

        return code

    def opened(self, state: DataFrame, centroids: np.ndarray) -> DataFrame:
        """``state`` (``rid, cells, cluster``) with the centroids that may be nearest, by cell codes alone."""
        cells, width, first_equal = self.cells, self.width, _distinct(centroids)
        least, most = cells.tables(centroids)

        def bound(batches):
            for batch in batches:
                possible = candidates(cells.unpacked(batch.column(1), width), least, most, first_equal)
                found = np.nonzero(possible)[1].astype(np.int32)
                lists = _lists(found, possible.sum(axis=1), pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["rid", "cells", "was", "candidates"])

        return state.mapInArrow(bound, OPENED)

    def fetched(self, needed: DataFrame, centroids: np.ndarray) -> DataFrame:
        """The rows of ``needed`` with their full vectors and their exact nearest centroid."""
        joined = needed.select("rid", "was", "candidates").join(self.full.select("rid", "cells", "full"), "rid")
        width, k = self.width, len(centroids)

        def settle(batches):
            for batch in batches:
                full = _matrix(batch.column(4), width)
                lists = batch.column(2)
                possible = np.zeros((len(full), k), dtype=bool)
                possible[np.repeat(np.arange(len(full)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = True
                cluster = pa.array(nearest(full, centroids, possible)[0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(3), batch.column(1), cluster, batch.column(4)],
                    names=["rid", "cells", "was", "cluster", "full"],
                )

        return joined.select("rid", "was", "candidates", "cells", "full").mapInArrow(settle, FETCHED)

    def moved(self, fetched: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
        """What the rows that changed cluster add to the sums and counts of the clusters."""
        changes = F.array(F.struct(F.col("cluster").alias("to"), F.lit(1).alias("sign")), F.struct(F.col("was").alias("to"), F.lit(-1).alias("sign")))
        moves = fetched.where("cluster <> was").select("full", F.inline(changes)).where("to >= 0")
        parts = [F.sum(F.col("sign") * F.get("full", F.lit(d)).cast("bigint")).alias(f"s{d}") for d in range(self.width)]
        sums, counts = np.zeros((k, self.width), dtype=object), np.zeros(k, dtype=object)
        for row in moves.groupBy("to").agg(F.sum("sign").alias("n"), *parts).collect():
            counts[row["to"]] = row["n"]
            sums[row["to"]] = [row[f"s{d}"] for d in range(self.width)]
        return sums, counts

    def assigned(self, centroids: np.ndarray, kind: str) -> DataFrame:
        """``vec_id, cluster, distance`` of every row: bounds first, then distances to what is left."""
        cells, width, first_equal = self.cells, self.width, _distinct(centroids)
        least, most = cells.tables(centroids)

        def settle(batches):
            for batch in batches:
                possible = candidates(cells.unpacked(batch.column(1), width), least, most, first_equal)
                cluster, distance = nearest(_matrix(batch.column(2), width), centroids, possible)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(cluster), pa.array(distance)], names=["vec_id", "cluster", "distance"]
                )

        return self.full.select("vec_id", "cells", "full").mapInArrow(settle, ASSIGNED.format(kind=kind))


def _start(rows: DataFrame, k: int, seed: int, width: int) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest hashes under ``seed``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = rows.select(F.sha2(text, 256).alias("hash"), "full").orderBy("hash", "full").limit(k)
    return np.array([r["full"] for r in first.collect()], dtype=np.int64).reshape(-1, width)


def _centroid_hash(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    seed: int = 3,
    width: int = 64,
    bits: int = BITS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Cluster of every usable vector: ``id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Components become ``floor(1024 * x)``. Centroids start as the ``k`` vectors whose ids, after the seed
    and a colon, have the smallest SHA-256; each round assigns every vector to the nearest (the smaller
    number of equals) and replaces every centroid that has vectors by the floor of their mean. One more
    assignment gives the result; distances are squared.

    Left out are vectors that are null, have another number of components, or have one that is null, not
    finite or beyond 131,072, whose squared distances a long does not hold. Fewer vectors than ``k`` give
    as many centroids. A null id counts as empty text; repeated rows and ids each count. An empty table
    gives an empty result. Other columns are not read.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    whole = F.transform(f"`{vector_col}`", lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    kept = usable(vectors, vector_col, width).select(
        F.col(f"`{id_col}`").alias("vec_id"), whole.alias("full"), F.monotonically_increasing_id().alias("rid")
    )
    with staging_run(vectors.sparkSession) as folder:
        rows = staged(kept)
        centroids = _start(rows, k, seed, width)
        with closing(VectorFile(rows, width, bits, folder)) as file:
            centroids = _moved_centroids(file, centroids, rounds)
            found = staged(file.assigned(centroids, kind), outlives=True)
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"))
    by_cluster = {r["cluster"]: int(r["inertia"]) for r in sums.collect()}
    about = [(c, _in_long(x), _in_long(sum(by_cluster.values())), _centroid_hash(centroids[c])) for c, x in by_cluster.items()]
    shape = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    per_cluster = F.broadcast(vectors.sparkSession.createDataFrame(about, shape))
    return found.join(per_cluster, "cluster").select(
        F.col("vec_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _moved_centroids(file: VectorFile, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """The centroids after all rounds. The state is the cluster of every row, kept beside its cell codes."""
    k = len(centroids)
    state = file.full.select("rid", "cells", F.lit(-1).alias("cluster"))
    sums, counts = np.zeros((k, file.width), dtype=object), np.zeros(k, dtype=object)
    for _ in range(rounds if k else 0):
        opened = staged(file.opened(state, centroids))
        stays = (F.size("candidates") == 1) & (F.get("candidates", F.lit(0)) == F.col("was"))
        fetched = staged(file.fetched(opened.where(~stays), centroids))
        more, members = file.moved(fetched, k)
        sums, counts = sums + more, counts + members
        filled = counts > 0
        centroids = centroids.copy()
        centroids[filled] = (sums[filled] // counts[filled, None]).astype(np.int64)
        settled = opened.where(stays).select("rid", "cells", F.col("was").alias("cluster"))
        state = settled.union(fetched.select("rid", "cells", "cluster"))
    return centroids


def _in_long(value: int) -> int:
    return min(value, (1 << 63) - 1)
