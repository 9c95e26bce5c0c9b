import random

import numpy as np
import pytest

from tripmill.llm import spans


def brute(rows):
    """Texts without the sentences of later equal runs, by a dictionary of first occurrences."""
    parts = {i: spans.sentences(t) for i, t in rows if t is not None}
    runs = {}
    for i, p in parts.items():
        words = [s.split() for s in p]
        for start in range(len(p)):
            for end in range(start + spans.RUN, len(p) + 1):
                if sum(map(len, words[start:end])) >= spans.LEAST_WORDS:
                    key = tuple(tuple(w) for w in words[start:end])
                    runs.setdefault(key, []).append((i, start, end))
                    break
    covered = {i: set() for i in parts}
    for places in runs.values():
        for i, start, end in sorted(places)[1:]:
            covered[i] |= set(range(start, end))
    return {
        i: (None, 0, 0) if t is None else ("".join(s for k, s in enumerate(parts[i]) if k not in covered[i]), len(parts[i]), len(covered[i]))
        for i, t in rows
    }


def texts(seed):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(3000)]

    def sentence():
        return " ".join(random.choices(vocabulary, k=random.choice([1, 2, 5, 9, 14, 30]))) + random.choice([". ", "! ", "?\n", ", "])

    shared = ["".join(sentence() for _ in range(8)) for _ in range(4)]
    rows = []
    for i in range(60):
        pieces = [sentence() for _ in range(random.randint(0, 12))]
        for _ in range(random.choice([0, 0, 1, 2])):
            pieces.insert(random.randint(0, len(pieces)), random.choice(shared))
        rows.append((i, "".join(pieces)))
    return rows + [(100 + i, rows[5][1]) for i in range(4)]


@pytest.mark.parametrize("text", ["", "\n\n", " a. b! c?\n\nd", "no end", "A.B. c... d", "x " * 100, "漢字。é. \x85y. z"])
def test_sentences_join_to_the_text(text):
    assert "".join(spans.sentences(text)) == text
    assert all(spans.sentences(text))


def result(docs):
    return {r["doc_id"]: (r["text"], r["n_sentences"], r["n_removed"]) for r in spans.deduplicated(docs).collect()}


@pytest.mark.parametrize("hot", [10**9, 3])
def test_same_as_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(spans, "HOT_TEXTS", hot)
    rows = texts(4)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert result(docs) == brute(rows)


def test_a_passage_inside_a_sentence_goes(spark):
    random.seed(8)
    passage = [f"p{i}" + ("." if i % 17 == 16 else "") for i in range(60)]
    rows = [(i, " ".join([f"a{i}{k}" for k in range(30)] + passage + [f"b{i}{k}" for k in range(20)])) for i in range(3)]
    found = result(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert found[0][0] == rows[0][1]
    for i in (1, 2):
        assert sum(p in found[i][0].split() for p in passage) < 20
        assert all(f"a{i}{k}" in found[i][0] for k in range(20))


def test_odd_rows(odd, empty):
    known = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    assert result(known) == brute([(r["doc_id"], r["text"]) for r in known.collect()])
    found = spans.deduplicated(odd)
    assert found.columns == [*odd.columns, "n_sentences", "n_removed"]
    assert found.count() == odd.count()
    assert spans.deduplicated(empty).count() == 0


def test_runs_of_no_text():
    assert all(len(x) == 0 for x in spans.span_hashes([]))
    assert all(len(x) == 0 for x in spans.span_hashes([[], ["a. "]]))
    assert spans.span_hashes([["a b c d e. ", "f g h i j. ", "k l m n o."]])[2].tolist() == [3]
    assert np.unique(spans.span_hashes([["a. "] * 40])[3]).size == 1
