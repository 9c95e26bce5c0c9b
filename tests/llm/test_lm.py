import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmill.llm import eliasfano, lm
from tripmill.llm.eliasfano import EliasFano, PairTrie

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


@pytest.mark.parametrize(("n", "top"), [(0, 10), (1, 1), (1, 2**40), (10, 3), (1000, 2000), (1000, 10**9), (5000, 2**47)])
def test_elias_fano(n, top):
    random = np.random.default_rng(n + 1)
    values = np.sort(random.integers(0, top, n, dtype=np.uint64))
    sequence, _ = EliasFano.from_buffer(EliasFano.of(values).to_bytes(), 0)
    assert (sequence.access(np.arange(n)) == values).all()
    asked = np.concatenate([values, random.integers(0, 2 * top, 300, dtype=np.uint64)])
    place, equal = sequence.find(asked)
    assert (equal == np.isin(asked, values)).all()
    assert (place[equal] == np.searchsorted(values, asked)[equal]).all()


@pytest.mark.parametrize(("n", "words"), [(0, 3), (1, 5), (300, 20), (5000, 50), (3000, 10**6)])
def test_trie(n, words):
    random = np.random.default_rng(n)
    pairs = np.unique(random.integers(0, words, (n, 2)), axis=0).astype(np.uint64)
    codes = random.integers(1, 60_000, len(pairs))
    trie = PairTrie.mapped(PairTrie.levels(pairs[:, 0], pairs[:, 1], codes))
    known = {(int(a), int(b)): int(c) for (a, b), c in zip(pairs, codes, strict=True)}
    asked = np.concatenate([pairs, random.integers(0, words + 5, (200, 2)).astype(np.uint64)])
    context, of = np.unique(asked[:, 0], return_inverse=True)
    found = trie.lookup(context, of, asked[:, 1])
    assert found.tolist() == [known.get((int(a), int(b)), 0) for a, b in asked]


def test_trie_of_a_file(tmp_path):
    pairs = np.array([[1, 2], [1, 5], [4, 1]], dtype=np.uint64)
    (tmp_path / "part").write_bytes(PairTrie.levels(pairs[:, 0], pairs[:, 1], np.array([7, 8, 9])))
    trie = PairTrie.from_file(str(tmp_path / "part"))
    asked = np.array([2, 5, 1, 9], dtype=np.uint64)
    assert trie.lookup(np.array([1, 4], dtype=np.uint64), np.array([0, 0, 1, 1]), asked).tolist() == [7, 8, 9, 0]


def brute(rows, held_out):
    """Counts, base score and model score of each row by dictionaries."""
    tokens = [(t or "").encode().translate(LOWER).split() + [b"\n"] for _, t in rows]
    training = [t for t, out in zip(tokens, held_out, strict=True) if not out]
    c = Counter(w for t in training for w in t)
    pairs = Counter(p for t in training for p in zip([b"\n", *t[:-1]], t, strict=True))
    n, v = sum(c.values()), len(c)
    results = []
    for (i, _), out, t in zip(rows, held_out, tokens, strict=True):
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        score = 0.0
        for u, w in zip([b"\n", *t[:-1]], t, strict=True):
            if n:
                weight = lm.MOST * c[u] / (c[u] + lm.HALF)
                single = (c[w] - lm.DISCOUNT) / n if c[w] else lm.DISCOUNT * v / n
                score += math.log10((weight * pairs[u, w] / c[u] if c[u] else 0) + (1 - weight) * single)
        results.append((i, out, len(t), sum(c[w] > 0 for w in t), n, base, score))
    return results


def agree(found, expected):
    def order(r):
        return (r[0] is not None, r[0] or 0, r[1], r[2], round(r[5], 3))

    found, expected = sorted(map(tuple, found), key=order), sorted(expected, key=order)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    for a, b in zip(found, expected, strict=True):
        assert abs(a[5] - b[5]) < 1e-6 * max(1, a[2])
        assert abs(a[6] - b[6]) < 2e-4 * a[2]


def test_scores_of_real_texts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = lm.scored(docs, out).collect()
    agree(found, brute(rows, [zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]))
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    agree(lm.scored(odd, F.col("doc_id") % 3 == 0).collect(), brute(rows, [i is not None and i % 3 == 0 for i, _ in rows]))
    agree(lm.scored(odd, F.lit(True)).collect(), brute(rows, [True] * len(rows)))
    assert lm.scored(empty, F.lit(False)).count() == 0


def test_the_probabilities_of_a_context_add_up_to_one():
    counts = {"a": 5, "b": 3, "c": 2}
    total, after_a = 10, {"a": 1, "b": 3, "c": 1}
    first = np.full(4, 5.0)
    second = np.array([5.0, 3.0, 2.0, 0.0])
    codes = np.append(lm.to_codes(np.full(3, 5.0), np.array([after_a[w] for w in counts], float)), 0).astype(np.uint16)
    assert abs((10 ** lm.token_scores(first, second, codes, total, 3)).sum() - 1) < 1e-3


def test_stored_tries_answer_like_the_fused_pass(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    batches = lm.encoded(docs, F.lit(False)).cache()
    words = lm.word_answers(batches, 3).cache()
    requests = lm.pair_requests(batches, words, 3).cache()
    tries = {r["shard"]: PairTrie.mapped(bytes(r["levels"])) for r in lm.tries(requests).collect()}
    answers = {(r["shard"], r["batch"]): bytes(r["pair_codes"]) for r in lm.pair_answers(requests).collect()}
    for r in requests.collect():
        row = r.asDict()
        found = tries[r["shard"]].lookup(*lm._expanded(row))
        assert lm.tokens.pack(found) == answers[r["shard"], r["batch"]]
        assert (found > 0).all()
    for frame in (batches, words, requests):
        frame.unpersist()


@pytest.mark.parametrize("share", [0.0, 0.02, 0.5, 0.98, 1.0])
def test_select_over_ones_and_zeros(share, monkeypatch):
    monkeypatch.setattr(eliasfano, "AT_ONCE", 100)
    rng = np.random.default_rng(5)
    bits = (rng.random(64 * eliasfano.BLOCK * 7) < share).astype(np.uint8)
    vector = eliasfano.Bits(np.packbits(bits, bitorder="little").view(np.uint64))
    ones, zeros = np.flatnonzero(bits), np.flatnonzero(bits == 0)
    assert (vector.one(np.arange(len(ones))) == ones).all()
    assert (vector.zero(np.arange(len(zeros))) == zeros).all()
    assert vector.n_zeros == len(zeros)


def test_an_open_sequence_holds_little_beside_its_buffer():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 40, 200_000)).astype(np.uint64)
    opened, _ = eliasfano.EliasFano.from_buffer(eliasfano.EliasFano.of(values).to_bytes(), 0)
    assert (opened.access(np.arange(len(values))) == values).all()
    held = opened.bits.ones_before.nbytes + opened.bits.zeros_before.nbytes
    assert held * 8 < len(values) * 3 and held < opened.high.nbytes / 6


def test_groups_grow_with_the_staged_table(spark):
    from tripmill.llm.tables import groups_of
    from tripmill.plans.staging import staged

    table = staged(spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("hash")))
    assert groups_of(table) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert groups_of(table, 1 << 16) > 15
