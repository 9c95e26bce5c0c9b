import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import plan
from tripmill.llm import vafile
from tripmill.plans.staging import staged, staging_run

SCHEMA = "vec_id bigint, embedding array<double>, label int, rid int, cluster string, cells string, full int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "c", "x", 2) for i, v in rows], SCHEMA).repartition(3)


def brute(rows, k, rounds, width, seed=3):
    """Every distance computed, in Python integers."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            whole = [math.floor(1024 * x) for x in v]
            if all(-vafile.largest(width) <= 1024 * x <= vafile.largest(width) for x in v):
                kept.append((i, whole))
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def assign():
        found = []
        for i, v in kept:
            distances = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            found.append((i, v, distances.index(min(distances)), min(distances)))
        return found

    for _ in range(rounds):
        members = {}
        for _, v, c, _ in assign():
            members.setdefault(c, []).append(v)
        for c, vs in members.items():
            centroids[c] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    found = assign()
    total = sum(d for *_, d in found)
    inertia = {c: sum(d for *_, e, d in found if e == c) for _, _, c, _ in found}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, c, d, inertia[c], total, digest[c]) for i, _, c, d in found], key=repr)


def result(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def blobs(n, width, seed, noise=0.4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    return [(i, [x + rng.gauss(0, noise) for x in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize(("noise", "bits"), [(0.1, 6), (2.0, 6), (0.4, 1), (0.4, 8)])
def test_same_as_comparing_everything(spark, noise, bits):
    rows = blobs(150, 8, 5, noise)
    rows += [(1000 + i, rows[3][1]) for i in range(60)]
    found = vafile.cluster(vectors_of(spark, rows), k=5, rounds=4, width=8, bits=bits)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert result(found) == brute(rows, 5, 4, 8)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None),
        (2, []),
        (3, [1.0, 2.0]),
        (4, [1.0, None, 2.0]),
        (5, [1.0, nan, 2.0]),
        (6, [1.0, inf, 2.0]),
        (7, [1e30, 0.0, 0.0]),
        (8, [-0.0, 0.0005, -0.0005]),
        (9, [131072.0, -131072.0, 0.0]),
        (9, [131072.0, -131072.0, 0.0]),
        (None, [1.0, 1.0, 1.0]),
        (None, [2.0, 1.0, 1.0]),
        (10, [1.0, 1.0, 1.0]),
        (10, [1.0, 1.0, 1.0]),
    ]
    assert result(vafile.cluster(vectors_of(spark, rows), k=4, rounds=3, width=3)) == brute(rows, 4, 3, 3)
    one = vafile.cluster(vectors_of(spark, rows[-1:]), k=4, rounds=3, width=3)
    assert result(one) == brute(rows[-1:], 4, 3, 3)


def test_no_usable_vector(spark):
    for rows in ([], [(1, None)]):
        found = vafile.cluster(vectors_of(spark, rows), k=4, rounds=2, width=3)
        assert found.collect() == [] and found.columns[0] == "vec_id"


def test_intervals_hold_every_distance():
    rng = np.random.default_rng(4)
    full = rng.integers(-900, 900, (400, 16))
    full[0] = 1 << 26
    cells = vafile.Cells.spread(full.min(0), full.max(0), full.mean(0), full.std(0), 4)
    centroids = full[5:11]
    least, most = cells.tables(centroids)
    codes = cells.codes(full)
    assert codes.max() < 16
    packed = pa.array(cells.packed(codes), pa.binary())
    assert len(packed[0].as_py()) == 8
    assert (cells.unpacked(packed, 16) == codes).all()
    middle = centroids.sum(0) // len(centroids)
    exact = ((full[:, None, :] - centroids[None]) ** 2).sum(2) - ((full - middle) ** 2).sum(1)[:, None]
    low = sum(least[d][codes[:, d]] for d in range(16))
    high = sum(most[d][codes[:, d]] for d in range(16))
    assert (low <= exact).all() and (exact <= high).all()


def test_few_rows_are_fetched_and_vectors_stay_where_they_are(spark):
    rows = vectors_of(spark, blobs(600, 16, 9, 0.2)).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x * 1024).cast("int")).alias("full"), F.monotonically_increasing_id().alias("rid")
    )
    with staging_run(spark) as folder:
        file = vafile.VectorFile(staged(rows), 16, 6, folder)
        first = vafile._start(file.rows, 5, 3, 16)
        after = vafile._moved_centroids(file, first, 6)
        state = file.assigned(after, "bigint")
        settled = file.full.join(state, "vec_id").select("rid", "cells", "cluster")
        opened = file.opened(settled, vafile._moved_centroids(file, first, 7))
        needed = opened.where((F.size("candidates") > 1) | (F.get("candidates", F.lit(0)) != F.col("was")))
        assert needed.count() < 200
        limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            text = plan(file.fetched(staged(needed), after))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        file.close()
    assert text.count("Exchange hashpartitioning(rid") == 1
