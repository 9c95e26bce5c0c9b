"""Toxicity classifier with counterfactual regularisation.

A logistic model over the words of a text and their beginnings is fitted to labelled rows. Identity
terms in labelled sentences are swapped for other terms of their list, and the change of the score is
penalised, so that a group that toxic texts often mention does not make its mention toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.plans.staging import staged

# Each list holds terms for groups of people and, first, a neutral one.
IDENTITY_LISTS = (
    ("people", "women", "men", "muslims", "christians", "jews", "hindus", "immigrants", "refugees", "blacks",
     "whites", "asians", "gays", "lesbians"),
    ("person", "woman", "man", "muslim", "christian", "jew", "hindu", "immigrant", "refugee"),
    ("human", "female", "male", "muslim", "christian", "jewish", "black", "white", "asian", "gay", "lesbian",
     "transgender", "disabled", "blind", "deaf", "old", "young"),
    ("personnes", "femmes", "hommes", "musulmans", "juifs", "immigrés", "noirs", "blancs", "homosexuels"),
    ("menschen", "frauen", "männer", "muslime", "christen", "juden", "migranten", "schwarze", "weiße"),
    ("personas", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "negros", "blancos"),
)

#: Bounds of the fit: labelled rows, characters of one of them, and features.
MAX_ROWS = 10_000
MAX_CHARS = 1_000_000
MAX_FEATURES = 20_000
LEAST_TEXTS = 4
PREFIXES = (3, 4, 5, 6, 7)
L1 = 2e-4
#: Toxic rows are few; each counts as so many.
TOXIC_WEIGHT = 3.0
COUNTERFACTUAL = 1.0
STEPS = 400
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")
_SWAPS = {term: tuple(t for l in IDENTITY_LISTS if term in l for t in l if t != term) for l in IDENTITY_LISTS for term in l}


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(word: str) -> list[str]:
    """The whole word, marked by an end sign, and its beginnings."""
    return [word + "$", *(word[:k] for k in PREFIXES if len(word) >= k)]


def mentions(text: str) -> Iterator[tuple[str, set[str]]]:
    """Each identity term of each sentence, with all words of the sentence."""
    for sentence in _SENTENCE.findall(text.lower()):
        found = set(_WORD.findall(sentence))
        for term in sorted(_SWAPS.keys() & found):
            yield term, found


def identity_mentions(text: str) -> Counter:
    """Sentences of the text that mention each identity term."""
    return Counter(term for term, _ in mentions(text))


def swapped_sentences(text: str) -> Counter:
    """What swapping an identity term changes in the features of a sentence, and how many swaps do so.

    Every mention is swapped for every other term of its lists. A change is the features that the swapped
    sentence has more and those that it has no longer: a beginning that another word of the sentence has
    too is neither.
    """
    changes: Counter = Counter()
    for term, sentence in mentions(text):
        others = {f for word in sentence if word != term for f in features_of(word)}
        before = set(features_of(term)) - others
        for other in _SWAPS[term]:
            after = set() if other in sentence else set(features_of(other)) - others
            change = " ".join(sorted(after - before)), " ".join(sorted(before - after))
            if change != ("", ""):
                changes[change] += 1
    return changes


@dataclass
class Model:
    """Bias and the weights that are not zero; at most MAX_FEATURES of them."""

    bias: float
    weights: dict[str, float]

    def score(self, text: str) -> float:
        hit: set[str] = set()
        for word in words(text):
            hit.update(self._known(word))
        return 1.0 / (1.0 + math.exp(-max(-500.0, self.bias + math.fsum(self.weights[f] for f in hit))))

    def __post_init__(self):
        self._cache: dict[str, tuple[str, ...]] = {}

    def _known(self, word: str) -> tuple[str, ...]:
        known = self._cache.get(word)
        if known is None:
            known = tuple(f for f in features_of(word) if f in self.weights)
            if len(word) <= 64:
                if len(self._cache) > 100_000:
                    self._cache.clear()
                self._cache[word] = known
        return known

    def __getstate__(self):
        return {"bias": self.bias, "weights": self.weights}

    def __setstate__(self, state):
        self.__init__(**state)


def fit(lists: list[np.ndarray], labels: np.ndarray, index: dict[str, int], swaps: Counter,
        counterfactual: float = COUNTERFACTUAL) -> Model:
    """Fit to the sorted feature numbers of each text, its labels, and the changes that swaps make.

    Minimises weighted mean log loss + L1 + counterfactual * mean squared score change over all swaps, by
    accelerated proximal gradient steps. Without both labels there is only a bias.
    """
    n, positive = len(lists), float(labels.sum())
    prior = math.log((positive + 0.5) / (n - positive + 0.5))
    if positive in (0.0, float(n)) or not index:
        return Model(prior, {})
    columns = np.concatenate(lists)
    lines = np.repeat(np.arange(n), [len(x) for x in lists])
    size = len(index)
    # One row per change of features; it counts as often as a swapped sentence makes it.
    pairs = sorted(swaps)
    times = np.array([swaps[p] for p in pairs], dtype=np.float64)
    times /= max(1.0, times.sum())
    moved = [
        (k, index[f], sign)
        for k, change in enumerate(pairs)
        for sign, part in zip((1.0, -1.0), change, strict=True)
        for f in part.split()
    ]
    pair_of = np.array([m[0] for m in moved], dtype=np.int64)
    column_of = np.array([m[1] for m in moved], dtype=np.int64)
    sign_of = np.array([m[2] for m in moved])

    def forward(w):
        return np.bincount(lines, weights=w[columns], minlength=n)

    def changes(w):
        return np.bincount(pair_of, weights=sign_of * w[column_of], minlength=len(pairs))

    def back(residual, pull):
        g = np.bincount(columns, weights=residual[lines], minlength=size)
        if len(pairs):
            g += np.bincount(column_of, weights=sign_of * pull[pair_of], minlength=size)
        return g

    def curvature() -> float:
        v = np.ones(size) / math.sqrt(size)
        norm = 1.0
        for _ in range(30):
            u = back(forward(v) * 0.25 * TOXIC_WEIGHT / n, 2 * counterfactual * times * changes(v) if len(pairs) else None)
            norm = float(np.linalg.norm(u)) or 1.0
            v = u / norm
        return 1.1 * norm + 0.25 * TOXIC_WEIGHT

    step = 1.0 / curvature()
    importance = np.where(labels > 0, TOXIC_WEIGHT, 1.0)
    w, b = np.zeros(size), prior
    ahead_w, ahead_b, momentum = w, b, 1.0
    for _ in range(STEPS):
        p = 1.0 / (1.0 + np.exp(-np.clip(forward(ahead_w) + ahead_b, -30, 30)))
        residual = importance * (p - labels) / n
        pull = 2 * counterfactual * times * changes(ahead_w) if len(pairs) else None
        raw = ahead_w - step * back(residual, pull)
        new_w = np.sign(raw) * np.maximum(np.abs(raw) - step * L1, 0.0)
        new_b = ahead_b - step * float(residual.sum())
        after = (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead_w = new_w + (momentum - 1) / after * (new_w - w)
        ahead_b = new_b + (momentum - 1) / after * (new_b - b)
        w, b, momentum = new_w, new_b, after
    return Model(b, {f: float(w[i]) for f, i in index.items() if w[i]})


def _sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int):
    """Words, label and swapped sentences of at most ``rows`` labelled rows, chosen by a hash of the id.

    Of several texts with one id, the first in code point order is taken.
    """
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    # At most ``rows`` rows of an id and a label are broadcast.
    found = texts.join(F.broadcast(chosen), "_id").where(F.length("_text") <= MAX_CHARS)
    found = found.groupBy("_id", "_label").agg(F.min("_text").alias("_text")).select("_text", "_label")

    def run(batches):
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([sorted(words(t)) for t in texts], pa.list_(pa.string())),
                    batch.column("_label"),
                    pa.array([[("|".join(c), n) for c, n in swapped_sentences(t).items()] for t in texts], pa.map_(pa.string(), pa.int32())),
                ],
                names=["words", "label", "swaps"],
            )

    return found.mapInArrow(run, "words array<string>, label int, swaps map<string, int>")


def _strongest(sample: DataFrame, n: int, positive: int) -> list[str]:
    """The MAX_FEATURES features whose share differs most between the labels."""

    def count(batches):
        for batch in batches:
            seen, toxic = Counter(), Counter()
            for found, label in zip(batch.column(0), batch.column(1), strict=True):
                features = {f for word in found.as_py() for f in features_of(word)}
                seen.update(features)
                if label.as_py():
                    toxic.update(features)
            names = list(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([seen[f] for f in names], pa.int64()),
                 pa.array([toxic[f] for f in names], pa.int64())],
                names=["feature", "n", "toxic"],
            )

    counts = sample.select("words", "label").mapInArrow(count, "feature string, n bigint, toxic bigint")
    total = counts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    share = F.col("n") / n
    spread = F.sqrt(share * (1 - share) * (1 / max(1, positive) + 1 / max(1, n - positive)) + 1e-12)
    gap = F.abs(F.col("toxic") / max(1, positive) - (F.col("n") - F.col("toxic")) / max(1, n - positive))
    strongest = total.where(F.col("n") >= LEAST_TEXTS).orderBy((gap / spread).desc(), "feature").limit(MAX_FEATURES)
    return [r["feature"] for r in strongest.select("feature").collect()]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", rows: int = MAX_ROWS, counterfactual: float = COUNTERFACTUAL) -> Model:
    """Fit on a bounded sample: ``rows`` labelled rows, of at most MAX_CHARS characters each.

    The driver gets the chosen features, the changes that swapped sentences make to them and, for each
    row, the numbers of those it has. Rows without a label, an id or a text do not count, nor do longer
    texts; an id with several labels has the largest. Without any labelled row, as in an empty table, the
    score is 0.5 for every text. Other columns are not read.
    """
    sample = staged(_sampled(docs, labels, id_col, text_col, label_col, rows))
    whole = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive")).first()
    if not whole["n"]:
        return Model(0.0, {})
    changes = sample.select(F.explode("swaps").alias("change", "times")).groupBy("change").agg(F.sum("times").alias("times"))
    # As many as pairs of terms, times what other words of a sentence leave of their dozen features.
    swaps = Counter({tuple(r["change"].split("|")): r["times"] for r in changes.collect()})
    chosen = _strongest(sample, whole["n"], whole["positive"])
    extra = sorted({f for change in swaps for part in change for f in part.split()} - set(chosen))
    index = {f: i for i, f in enumerate([*chosen, *extra])}
    shared = sample.sparkSession.sparkContext.broadcast(index)

    def number(batches):
        numbers = shared.value
        for batch in batches:
            found = [
                sorted({numbers[f] for word in words.as_py() for f in features_of(word) if f in numbers})
                for words in batch.column(0)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), batch.column(1)], names=["numbers", "label"]
            )

    numbered = sample.select("words", "label").mapInArrow(number, "numbers array<int>, label int").toArrow()
    lists = [np.asarray(x.values, dtype=np.int64) for x in numbered["numbers"]]
    labels_of = numbered["label"].to_numpy().astype(np.float64)
    # The order in which tasks deliver rows must not change the sums.
    order = sorted(range(len(lists)), key=lambda i: (labels_of[i], lists[i].tobytes()))
    return fit([lists[i] for i in order], labels_of[order], index, swaps, counterfactual)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of every row from its whole text alone, however long.

    A null text counts as empty. Null and repeated ids are rows like any other; an empty table gives an
    empty result; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("_text"))
    schema = T.StructType([kept.schema.fields[0], T.StructField("score", T.DoubleType())])

    def run(batches):
        fitted = shared.value
        for batch in batches:
            found = pa.array([fitted.score(t.as_py() or "") for t in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=schema.names)

    return kept.mapInArrow(run, schema)


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` whose text scores below ``threshold``, with all their columns.

    A null text counts as empty; repeated rows stay or go alike. An empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches):
        fitted = shared.value
        for batch in batches:
            clean = [fitted.score(t.as_py() or "") < threshold for t in batch.column(place)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
