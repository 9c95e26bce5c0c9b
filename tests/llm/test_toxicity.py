import random

from pyspark.sql import functions as F

from tripmill.llm import toxicity


def labelled(spark, seed=1):
    """Toxic sentences mention one group often; neutral ones seldom do, as in biased samples."""
    random.seed(seed)
    filler = [f"{a}{b}" for a in ("lor", "ips", "dol", "sit", "con", "adi") for b in ("em", "um", "or", "amet", "elit")]
    rows = []
    for i in range(600):
        words = random.choices(filler, k=12)
        toxic = i % 4 == 0
        if toxic:
            words[3] = random.choice(["scumbags", "idiots", "morons"])
            if random.random() < 0.6:
                words[7] = "muslims"
        elif random.random() < 0.02:
            words[7] = "muslims"
        rows.append((i, " ".join(words) + ".", int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")


def test_neutral_mentions_score_lower_with_the_penalty(spark):
    frame = labelled(spark)
    plain = toxicity.train(frame, frame, counterfactual=0.0)
    fair = toxicity.train(frame, frame, counterfactual=20.0)
    neutral, swapped = "lorem ipsum muslims dolor sitamet conelit.", "lorem ipsum people dolor sitamet conelit."
    toxic = "lorem ipsum idiots dolor sitamet conelit."
    assert plain.score(neutral) > 2 * plain.score(swapped)
    assert abs(fair.score(neutral) - fair.score(swapped)) < 0.02
    assert fair.score(neutral) < 0.3 < fair.score(toxic)


def test_mentions_are_counted_by_sentence():
    text = "Women and men met. The women spoke! No-one else.\nWOMEN"
    assert toxicity.identity_mentions(text) == {"women": 3, "men": 1}
    assert toxicity.identity_mentions("") == {}


def test_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    part = F.crc32(F.col("doc_id").cast("string")) % 4
    model = toxicity.train(docs, labels.where(part != 2))
    rows = toxicity.scored(docs, model).join(labels.where(part == 2), "doc_id").select("score", "toxic").collect()
    caught = sum(r["score"] >= 0.3 for r in rows if r["toxic"]) / sum(r["toxic"] for r in rows)
    wrong = sum(r["score"] >= 0.3 for r in rows if not r["toxic"]) / sum(not r["toxic"] for r in rows)
    assert caught > 0.85
    assert wrong < 0.01


def test_odd_rows(spark, odd, empty):
    model = toxicity.Model(-2.0, {"one$": 3.0, "wor": -1.0})
    rows = toxicity.scored(odd, model).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    by_text = {t: model.score(t) for t in ("", "one", "ONE")}
    assert by_text["one"] == by_text["ONE"] > 0.7 > by_text[""]
    kept = toxicity.without_toxic(odd, model)
    assert kept.columns == odd.columns
    assert kept.count() == odd.count() - 2
    assert toxicity.scored(empty, model).count() == 0
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.train(odd, none).score("anything") == 0.5
    nulls = spark.createDataFrame([(None, 1), (3, None), (4, 1), (4, 0), (5, 0)], "doc_id bigint, toxic int")
    assert 0 < toxicity.train(odd, nulls).score("one") < 1
    one_class = spark.createDataFrame([(3, 1), (4, 1)], "doc_id bigint, toxic int")
    assert toxicity.train(odd, one_class).score("anything") > 0.5


def test_same_model_again(spark):
    frame = labelled(spark)
    first, second = toxicity.train(frame, frame), toxicity.train(frame.repartition(7), frame.repartition(3))
    assert first.weights.keys() == second.weights.keys()
    assert all(abs(first.weights[f] - second.weights[f]) < 1e-9 for f in first.weights)


def test_swapped_sentences_against_swapping_the_words():
    """Every change is the difference between the features of two real sentences."""
    from collections import Counter

    random.seed(4)
    terms = sorted(toxicity._SWAPS)
    for _ in range(200):
        sentence = random.choices(["women", "womanly", "musketeer", "men", "mention", "x", *terms], k=6)
        text = " ".join(sentence) + ". " + "none here."
        expected = Counter()
        for term in set(sentence) & set(terms):
            for other in toxicity._SWAPS[term]:
                swapped = [other if w == term else w for w in sentence]
                before, after = ({f for w in s for f in toxicity.features_of(w)} for s in (sentence, swapped))
                change = " ".join(sorted(after - before)), " ".join(sorted(before - after))
                if change != ("", ""):
                    expected[change] += 1
        assert toxicity.swapped_sentences(text) == expected


def test_the_penalty_is_the_mean_squared_change_of_swapped_sentences():
    """The fitted weights come near the least stated sum: small steps away from them gain next to nothing,
    and without the penalty swapped sentences change more."""
    import math

    import numpy as np

    random.seed(2)
    texts = [" ".join(random.choices(["good", "bad", "awful", "women", "men", "people", "wo"], k=5)) + "." for _ in range(60)]
    labels = np.array([float("awful" in t or ("women" in t and random.random() < 0.5)) for t in texts])
    names = sorted({f for t in texts for w in toxicity.words(t) for f in toxicity.features_of(w)})
    swaps = sum((toxicity.swapped_sentences(t) for t in texts), toxicity.Counter())
    names += sorted({f for c in swaps for part in c for f in part.split()} - set(names))
    index = {f: i for i, f in enumerate(names)}
    lists = [np.array(sorted({index[f] for w in toxicity.words(t) for f in toxicity.features_of(w)})) for t in texts]
    model = toxicity.fit(lists, labels, index, swaps, 3.0)

    def penalty(weights):
        parts = lambda names: sum(weights.get(f, 0.0) for f in names.split())
        return sum(n * (parts(more) - parts(less)) ** 2 for (more, less), n in swaps.items()) / sum(swaps.values())

    def cost(weights, bias):
        score = lambda features: bias + sum(weights.get(names[i], 0.0) for i in features)
        loss = sum((3.0 if y else 1.0) * math.log1p(math.exp(-s if y else s)) for s, y in zip(map(score, lists), labels)) / len(texts)
        return loss + toxicity.L1 * sum(map(abs, weights.values())) + 3.0 * penalty(weights)

    best = cost(model.weights, model.bias)
    for name in names:
        for step in (-0.05, 0.05):
            assert cost(model.weights | {name: model.weights.get(name, 0.0) + step}, model.bias) > best - 1e-4
    assert penalty(model.weights) < penalty(toxicity.fit(lists, labels, index, swaps, 0.0).weights) / 20
