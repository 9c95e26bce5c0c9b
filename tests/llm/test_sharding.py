import zlib
from collections import Counter

import numpy as np
import pytest

from tripmill.llm.sharding import Permutation, shard_rows


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_permutation_is_one_to_one_and_reversible(n):
    permutation = Permutation(n, seed=5)
    there = permutation.forward(np.arange(n))
    assert sorted(there) == list(range(n))
    assert (permutation.inverse(there) == np.arange(n)).all()


def test_seeds_and_rows_are_mixed():
    a, b = (Permutation(1000, seed).forward(np.arange(1000)) for seed in (1, 2))
    assert (a == b).sum() < 20
    assert np.abs(np.corrcoef(a, np.arange(1000))[0, 1]) < 0.15


def test_odd_rows(odd, empty):
    rows = shard_rows(odd, 4, 7).collect()
    assert len(rows) == odd.count()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    texts = Counter((r["doc_id"], r["text"]) for r in odd.collect())
    expected = Counter(
        {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())): 0 for i, t in texts}
    )
    for (i, t), n in texts.items():
        expected[(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))] += n
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    assert shard_rows(empty, 4, 7).count() == 0


def test_same_result_however_the_rows_are_dealt(odd):
    known = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    a = sorted(map(tuple, shard_rows(known, 4, 7).collect()))
    assert a == sorted(map(tuple, shard_rows(known.repartition(5), 4, 7).collect()))
