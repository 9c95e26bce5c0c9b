import gc
import random
from hashlib import sha256

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tripmill.llm import bpe


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={})


def ids(encoder, text):
    return [i for run in encoder.encode(text) for i in run]


def test_perfect_hash_fills_all_slots(vocabulary):
    tokens = list(vocabulary.ranks)
    assert sorted(map(vocabulary.hash.slot, tokens)) == list(range(len(tokens)))
    assert all(vocabulary.whole(t) == r for t, r in vocabulary.ranks.items())
    assert vocabulary.whole(b"no such token in it") is None


def test_same_ids_as_the_library(vocabulary, library):
    encoder = bpe.Encoder(vocabulary)
    random.seed(2)
    alphabet = "ab cd\n\t\x1c\x85   'stréß漢字🙂!?.,0123٣​́"
    for _ in range(3000):
        text = "".join(random.choice(alphabet) for _ in range(random.randint(0, 40)))
        assert ids(encoder, text) == library.encode_ordinary(text)
        assert encoder.decode(ids(encoder, text)) == text.encode()


def test_every_way_of_merging(vocabulary, library, monkeypatch):
    encoder = bpe.Encoder(vocabulary)
    long_word = "abcdething" * 500
    assert ids(encoder, long_word) == library.encode_ordinary(long_word)
    monkeypatch.setattr(bpe, "STREAM_CHARS", 10)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    text = "Streams of text, cut piece by piece; " * 50
    assert ids(encoder, text) == library.encode_ordinary(text)


def test_odd_rows(odd, empty, vocabulary, library):
    texts = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in odd.collect())
    expected = sorted(
        (real, i, len(known := library.encode_ordinary(t)), sha256(",".join(map(str, known)).encode()).hexdigest(),
         sha256(t.encode()).hexdigest())
        for real, i, t in texts
    )
    found = bpe.digests(odd, vocabulary, with_ids=True).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found) == expected
    assert all(len(r["ids"]) == r["n_tokens"] for r in found)
    assert bpe.digests(empty, vocabulary).count() == 0


def test_columns_round_trip(odd, vocabulary):
    known = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    data = bpe.decode(bpe.encode(known, vocabulary), vocabulary).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in known.collect()}
    assert {r["doc_id"]: bytes(r["data"]) for r in data} == texts


def test_a_large_vocabulary_file_is_refused(tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_VOCABULARY_BYTES", 10)
    (tmp_path / "v").write_bytes(b"x" * 11)
    with pytest.raises(ValueError, match="more than 10 bytes"):
        bpe.Vocabulary.read(str(tmp_path / "v"), ".")


def test_workers_drop_what_they_remember_with_the_vocabulary(spark, odd, vocabulary):
    bpe.digests(odd, vocabulary, remembered=100).collect()

    def encoders(batches):
        for batch in batches:
            n = sum(isinstance(o, bpe.Encoder) for o in gc.get_objects())
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(batch), pa.int32())], names=["n"])

    found = spark.range(0, 64, 1, 16).mapInArrow(encoders, "n int").collect()
    assert len(found) == 64
    assert {r["n"] for r in found} == {0}
