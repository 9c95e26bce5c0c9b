"""Quality rules from tokeniser fertility, with rejection bands per language.

Public vocabularies measure every text: characters per token of a byte-level and of a byte-fallback
vocabulary, the share of byte-fallback tokens, and the entropy of its tokens relative to the largest
that its length allows. Ordinary prose of a language lies in a narrow band of each; symbol noise,
capitals, word lists and endless repeats lie outside. The bands come from all texts of the language, and
of no other; the fewer they are, the wider is the band.
"""

from __future__ import annotations

import base64
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.plans.staging import staged

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
REPEAT_PERCENT = 50
#: Bands reach so many interquartile ranges beyond the quartiles, and are widened for texts shorter
#: than the reference length by sampling noise.
BAND_RANGES = 3.0
#: Least range of each metric; the fallback tokens of a text are few, so their share scatters.
LEAST_RANGE = {"byte_chars": 0.04, "piece_chars": 0.04, "fallback_share": 0.01, "entropy": 0.05}
REFERENCE_TOKENS = 600
#: Quartiles of n texts scatter with 1 / sqrt(n): bands are wider by so many times that share. So few
#: ordinary texts lie outside (0.5 % at most of normal values), however few there are.
SCATTER = 2.0
#: Bins of the histograms that quartiles are read from, per unit of a metric.
BINS = 500
METRICS = ("byte_chars", "piece_chars", "fallback_share", "entropy")
#: A text is tokenised in pieces of at most so many characters, cut at white space if there is any.
PIECE_CHARS = 100_000


def base_measures(text: str) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text."""
    words = text.encode().split()  # bytes.split cuts at exactly the six ASCII white-space bytes
    word_chars = len(text) - sum(map(text.count, SPACES))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = Counter(text.split("\n"))
    n_dup_lines = sum(n - 1 for line, n in lines.items() if n > 1 and line.encode().split())
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    n_repeat = 0
    if len(counts) < len(windows):
        covered = 0  # end of the last repeated window
        for i, window in enumerate(windows):
            if counts[window] > 1:
                n_repeat += i + 3 - max(i, covered)
                covered = i + 3
    return len(words), word_chars, n_symbols, n_dup_lines, n_repeat


def pieces(text: str):
    start = 0
    while len(text) - start > PIECE_CHARS:
        cut = max(text.rfind(" ", start + 1, start + PIECE_CHARS), text.rfind("\n", start + 1, start + PIECE_CHARS))
        cut = cut if cut > start else start + PIECE_CHARS
        yield text[start:cut]
        start = cut
    yield text[start:]


class Fertility:
    """The two vocabularies as measuring instruments."""

    def __init__(self, ranks_file: bytes, piece_model: bytes, pattern: str):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        self.by_bytes = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.by_pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        size = self.by_pieces.vocab_size()
        self.fallback = np.array([self.by_pieces.is_byte(i) for i in range(size)])

    def measure(self, text: str) -> tuple[int, float, float, float, float]:
        """``n_tokens`` and the METRICS; all 0 for a text without tokens."""
        size = len(self.fallback)
        counts, by_bytes = np.zeros(size, dtype=np.int64), 0
        for piece in pieces(text):
            counts += np.bincount(self.by_pieces.encode(piece), minlength=size)
            by_bytes += len(self.by_bytes.encode_ordinary(piece))
        n = int(counts.sum())
        if n == 0 or by_bytes == 0:
            return 0, 0.0, 0.0, 0.0, 0.0
        p = counts[counts > 0] / n
        # Adding 0.0 turns the negative zero of a text of one token into zero.
        entropy = float(-(p * np.log2(p)).sum()) / math.log2(max(2, n)) + 0.0
        return n, len(text) / by_bytes, len(text) / n, int(counts[self.fallback].sum()) / n, entropy


_instruments: dict[tuple, Fertility] = {}

FEATURES = (
    [T.StructField("text_hash", T.LongType())]
    + [T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")]
    + [T.StructField(c, T.DoubleType()) for c in METRICS]
)


def features(docs: DataFrame, ranks_path: str, model_path: str, pattern: str,
             id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id, lang`` and all measures of every whole text."""
    with open(ranks_path, "rb") as a, open(model_path, "rb") as b:
        files = (a.read(), b.read(), pattern)
    shared = docs.sparkSession.sparkContext.broadcast(files)
    kept = docs.select(
        F.col(f"`{id_col}`"), F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text")
    )
    schema = T.StructType([*kept.schema.fields[:2], *FEATURES])

    def run(batches):
        key = tuple(xxhash.xxh3_64_intdigest(f) for f in shared.value)
        if key not in _instruments:
            _instruments[key] = Fertility(*shared.value)
        fertility = _instruments[key]
        for batch in batches:
            rows = []
            for value in batch.column(2):
                text = value.as_py() or ""
                hashed = xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)
                rows.append((hashed, *base_measures(text), *fertility.measure(text)))
            columns = list(zip(*rows, strict=True)) or [()] * len(FEATURES)
            types = [pa.int64()] * 7 + [pa.float64()] * 4
            made = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=schema.names)

    return kept.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def quartiles(measured: DataFrame) -> DataFrame:
    """``key, metric, texts, q1, q3`` over the distinct texts of a language that pass the base rules.

    Each distinct text counts once, so a text copied over and over does not narrow the bands. Quartiles
    are exact for binned values: counts of bins add up in any order, so reruns agree.
    """
    texts = measured.where(~base_failed()).select("key", "text_hash", "n_tokens", *METRICS).dropDuplicates()
    bins = [F.struct(F.lit(m).alias("metric"), F.floor(F.col(m) * BINS).alias("bin")) for m in METRICS]
    binned = texts.select("key", F.explode(F.array(*bins)).alias("m")).select("key", "m.metric", "m.bin")
    counts = binned.groupBy("key", "metric", "bin").agg(F.count(F.lit(1)).alias("n"))
    one = Window.partitionBy("key", "metric")
    running = counts.withColumn("upto", F.sum("n").over(one.orderBy("bin"))).withColumn("texts", F.sum("n").over(one))
    middle = (F.col("bin") + 0.5) / BINS

    def at(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= share * F.col("texts"), middle))

    return running.groupBy("key", "metric").agg(
        F.max("texts").alias("texts"), at(0.25).alias("q1"), at(0.75).alias("q3")
    )


def language_key(lang: Column) -> Column:
    return F.when(lang.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), lang))


def judge(measured: DataFrame) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to staged ``features``.

    A text that passes the base rules is kept if every metric lies in the band of its language, at any
    number of texts; the only text of a language is always kept. A null language is a language of its
    own. Texts without tokens fail the base rules. With no text to take bands from, nothing passes the
    base rules, and nothing is kept.
    """
    keyed = measured.withColumn("key", language_key(F.col("lang")))
    bands = (
        staged(quartiles(keyed))
        .groupBy("key")
        .pivot("metric", list(METRICS))
        .agg(F.first(F.struct("q1", "q3", "texts")))
    )
    joined = keyed.join(bands.select("key", *[F.col(m).alias(f"band_{m}") for m in METRICS]), "key", "left")
    inside = F.lit(True)
    noise = F.greatest(F.lit(1.0), F.sqrt(F.lit(float(REFERENCE_TOKENS)) / F.greatest("n_tokens", F.lit(1))))
    for m in METRICS:
        q1, q3, texts = (F.col(f"band_{m}.{c}") for c in ("q1", "q3", "texts"))
        few = F.lit(1.0) + F.lit(SCATTER) / F.sqrt(texts)
        reach = F.lit(BAND_RANGES) * noise * few * F.greatest(q3 - q1, F.lit(LEAST_RANGE[m]))
        inside = inside & (F.col(m) >= q1 - reach) & (F.col(m) <= q3 + reach)
    return joined.select(*measured.columns, base_failed().alias("base_failed"), (~base_failed() & inside).alias("kept"))


def quality(docs: DataFrame, ranks_path: str, model_path: str, pattern: str, **columns: str) -> DataFrame:
    """Measures and verdict of every row of ``docs``.

    A null text counts as one without words. Repeated rows are judged alike. Only id, text and
    language are read, so extra columns cannot clash.
    """
    return judge(staged(features(docs, ranks_path, model_path, pattern, **columns)))
