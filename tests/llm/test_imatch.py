import math
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa

from tripmill.llm import imatch

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text):
    return set((text or "").encode().translate(LOWER).split())


def neighbours(rows):
    order = sorted(rows, key=lambda r: -r[0])
    for k, (i, t) in enumerate(order):
        text, following = t or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        yield i, text, text[: len(text) - third] + following[:third], following


def check(docs, rows):
    found = {r["doc_id"]: r for r in imatch.fingerprints(docs).collect()}
    assert len(found) == len(rows)
    counts = Counter(w for _, t in rows for w in words(t))
    low, high = (len(rows) * math.exp(-x) for x in imatch.IDF_BAND[::-1])
    band = {w for w, n in counts.items() if low <= n <= high}
    by_terms = {}
    for i, text, changed, following in neighbours(rows):
        r = found[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), sha256(changed.encode()).hexdigest())
        for value, source in ((r["fingerprint"], text), (r["edited_fingerprint"], changed)):
            assert by_terms.setdefault(frozenset(words(source) & band), value) == value
        for near, other in ((r["near_edited"], r["edited_fingerprint"]), (r["near_next"], by_terms.get(frozenset(words(following) & band)))):
            if other is not None:
                a, b = (np.frombuffer(bytes.fromhex(x), ">u2").reshape(1, -1) for x in (r["fingerprint"], other))
                assert near == imatch.likeness(a, b)[0]
    return found


def test_real_texts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(5)
    found = check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()]).values()
    assert sum(r["near_edited"] for r in found) > 5 * sum(r["near_next"] for r in found)


def test_odd_rows(spark, odd, empty):
    known = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check(known, [(r["doc_id"], r["text"]) for r in known.collect()])
    found = imatch.fingerprints(odd).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in found) == sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in odd.collect())
    assert imatch.fingerprints(empty).count() == 0
    one = spark.createDataFrame([(4, "abcdef")], "doc_id bigint, text string")
    assert imatch.fingerprints(one).first()["edited_sha256"] == sha256(b"abcdab").hexdigest()
    no_id = spark.createDataFrame([(None, "abc"), (None, None)], "doc_id bigint, text string")
    assert imatch.fingerprints(no_id).count() == 2


def test_hashes_do_not_depend_on_order_or_repeats():
    terms = np.sort(imatch.tokens.words(pa.array([" ".join(f"t{i}" for i in range(400))])).distinct_hashes)
    maker = imatch.Fingerprinter(terms)
    text = [f"t{i}" for i in range(200)]
    a, b, c, d = maker.hashes(pa.array([" ".join(text), " ".join(text[::-1] * 2), " ".join(text[:150]), None]))
    assert (a == b).all() and not (a == c).all() and (d == 0).all()
    assert 0 < imatch.likeness(a[None], c[None])[0] < 1
    assert imatch.likeness(d[None], d[None])[0] == 1
    sizes = [m.mean() for m in maker.members]
    assert all(abs(s - r) < 0.15 for s, r in zip(sizes, imatch.SUBSETS, strict=True))


def test_copies_do_not_push_their_terms_out_of_the_lexicon(spark):
    own = " ".join(f"copied{i}" for i in range(300))
    texts = ["common " + " ".join(f"t{(7 * i + j) % 50 + 50 * (j % 20)}" for j in range(100)) for i in range(100)]
    rows = list(enumerate(texts + texts[:5] + [own] * 70 + [None, "", ""]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    different = {t or "" for _, t in rows}
    counts = Counter(w for t in different for w in words(t))
    band = {w for w, n in counts.items() if len(different) * math.exp(-imatch.IDF_BAND[1]) <= n <= len(different) / 5}
    assert words(own) <= band and len(band) < len(counts)
    known = imatch.tokens.words(pa.array([b" ".join(sorted(band)).decode()])).distinct_hashes
    assert imatch.lexicon(docs).tolist() == np.sort(known).tolist()
    found = {r["doc_id"]: r for r in imatch.fingerprints(docs).collect()}
    copies = [found[i] for i, t in rows if t == own]
    assert len({r["fingerprint"] for r in copies}) == 1
    assert copies[0]["fingerprint"] != found[len(rows) - 1]["fingerprint"]
