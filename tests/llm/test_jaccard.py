import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmill.llm import jaccard
from tripmill.llm.components import components

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """Number of shingles and smallest reachable id of rows with distinct ids, by all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    order = sorted(sets)
    for k, a in enumerate(order):
        for b in order[:k]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    p, q = find(a), find(b)
                    top[max(p, q)] = min(p, q)
    return sorted((i, len(sets[i]), find(i)) for i in sets)


def families(seed):
    """Groups of near copies at distances around the threshold, chains, shared passages and copies."""
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = random.choices(vocabulary, k=50)
    texts = []
    for _ in range(6):
        base = random.choices(vocabulary, k=random.randint(6, 120))
        for _ in range(random.randint(1, 14)):
            changed = list(base)
            for _ in range(random.randint(0, max(1, len(base) // 18))):
                changed[random.randrange(len(changed))] = random.choice(vocabulary)
            texts.append(changed)
        chain = list(base)
        for _ in range(6):
            chain = chain[2:] + random.choices(vocabulary, k=2)
            texts.append(chain)
    texts += [passage + random.choices(vocabulary, k=random.randint(5, 20)) for _ in range(25)]
    texts += [random.choices(vocabulary, k=random.randint(0, 7)) for _ in range(20)]
    random.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", range(3))
def test_components_are_those_of_all_pairs(spark, seed):
    rows = families(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert sorted(map(tuple, jaccard.join(docs).collect())) == brute(rows)


def test_salted_shingles_and_more_stars_change_nothing(spark, monkeypatch):
    rows = families(7)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    monkeypatch.setattr(jaccard, "HOT_SETS", 6)
    monkeypatch.setattr(jaccard, "OPEN_FACTOR", 0.0)
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 2)
    assert sorted(map(tuple, jaccard.join(docs).collect())) == brute(rows)


def test_real_texts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, jaccard.join(docs).collect())) == brute(rows)


def test_odd_rows(odd, empty):
    known = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = [(r["doc_id"], r["text"]) for r in known.collect()]
    assert sorted(map(tuple, jaccard.join(known).collect())) == brute(rows)
    found = jaccard.join(odd).collect()
    assert len(found) == odd.count()
    assert {(r["n_shingles"], r["component_id"]) for r in found if r["doc_id"] is None} == {(1, 5), (0, None)}
    assert jaccard.join(empty).count() == 0


def test_one_document_of_each_component_stays(odd, empty):
    left = jaccard.without_copies(odd)
    assert left.columns == odd.columns
    ids = sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None)
    components_of = {r["doc_id"]: r["component_id"] for r in jaccard.join(odd).collect() if r["doc_id"] is not None}
    assert ids == sorted(i for i, c in components_of.items() if i == c)
    assert left.where("doc_id is null").count() == 2
    assert jaccard.without_copies(empty).count() == 0


def test_connected_components(spark):
    random.seed(3)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(random.randint(200, 260), random.randint(200, 260)) for _ in range(50)]
    frame = spark.createDataFrame(links + [(300, 300)], "u bigint, v bigint")
    found = {r["node"]: r["component"] for r in components(frame).collect()}
    top = {n: n for pair in links for n in pair}
    for _ in range(70):
        for u, v in links:
            top[u] = top[v] = min(top[u], top[v])
    assert found == {n: c for n, c in top.items() if any(n in p and p[0] != p[1] for p in links)}
    assert components(frame.where(F.lit(False))).count() == 0


def test_packing():
    values = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000, dtype=np.uint64))
    assert (jaccard.tokens.unpack_steps(jaccard.tokens.pack_steps(values)) == values).all()
    none = np.zeros(0, dtype=np.uint64)
    assert len(jaccard.tokens.unpack(jaccard.tokens.pack(none))) == 0
