import corpus_pipeline
import pytest

from tripmill.plans.staging import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_every_stage_takes_odd_and_empty_tables(spark, small, odd, empty, kind):
    docs = (odd if kind == "odd" else empty).select(*COLUMNS)
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, small))
        sizes[name] = (docs.count(), after.count())
        if name == "encode":
            assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"} == set(after.columns)
        else:
            assert after.columns == COLUMNS
            assert [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
            docs = after
    if kind == "empty":
        assert set(sizes.values()) == {(0, 0)}
    else:
        assert sizes["toxicity"][1] == odd.count()
        assert 0 < sizes["near_copies"][1] < odd.count()
        assert sizes["passages"][0] == sizes["passages"][1]
        assert sizes["encode"][0] == sizes["encode"][1] > 0


def test_rows_without_an_id_or_words_stay_until_the_mix(spark, small, odd):
    docs = odd.select(*COLUMNS)
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = staged(stage(spark, docs, small))
    kept = docs.collect()
    assert sum(r["doc_id"] is None for r in kept) == 2
    assert sum(r["doc_id"] is not None and not (r["text"] or "").strip() for r in kept) >= 3
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in kept)
