"""I-Match fingerprints of documents, with randomised lexicons.

The lexicon holds the terms whose inverse document frequency lies in a band: common enough to stand in
many texts, rare enough to tell texts apart. Random subsets of it give one hash each: that of the sorted
distinct terms that a text shares with the subset. Subsets keep a term with different chances, so that
short and long texts both have hashes that a change of some words leaves alone. The likeness of two
texts is the share of their hashes that agree.
"""

from __future__ import annotations

import math
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm import tokens
from tripmill.llm.numbering import numbered
from tripmill.plans.staging import staged

#: Band of the natural logarithm of distinct texts / document frequency: terms of 0.2 % to 20 % of them.
IDF_BAND = (math.log(5), math.log(500))
#: Chance of a term to be in a subset, for each subset.
SUBSETS = (2 / 3,) * 4 + (1 / 16,) * 12 + (1 / 64,) * 16 + (1 / 256,) * 32
#: A larger lexicon is refused. There are at most (mean distinct terms of a text) * exp(upper idf) terms.
MAX_LEXICON = 8_000_000
#: Texts with copies are marked in a map of 2 ** PLACE_BITS bits; a task remembers so many of them at most.
PLACE_BITS = 26
MOST_SEEN = 500_000


def repeated_places(hashes: DataFrame) -> np.ndarray:
    """Bit map of 2 ** PLACE_BITS places; a hash that stands in several rows has the bit of its place.

    However many hashes repeat, the map is as large; a full one only sends more texts to be compared.
    """
    place = F.shiftrightunsigned("hash", 64 - PLACE_BITS)
    bits = F.bit_or(F.expr("shiftleft(1L, int(place & 63))")).alias("bits")
    words = hashes.where("n > 1").select(place.alias("place")).groupBy(F.expr("place >> 6").alias("word")).agg(bits).toPandas()
    found = np.zeros(1 << (PLACE_BITS - 6), dtype=np.int64)
    found[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return found


def lexicon(docs: DataFrame, text_col: str = "text", band: tuple[float, float] = IDF_BAND) -> np.ndarray:
    """Sorted hashes of the terms in the band, from the document frequencies of all distinct texts.

    A term of the band stands in exp(-upper idf) of the distinct texts at least, which bounds the number
    of terms by the mean number of distinct terms of a text, however many there are. Texts that may have
    copies are brought together by hash, one per task, and counted once; all others are counted where
    they are read. Null texts count as empty, which is one text.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    texts = docs.select(F.xxhash64(text).alias("hash"), text.alias("text"))
    hashes = staged(texts.groupBy("hash").agg(F.count(F.lit(1)).alias("n")))
    known = docs.sparkSession.sparkContext.broadcast(repeated_places(hashes))

    def repeats(batch: pa.RecordBatch) -> np.ndarray:
        place = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - PLACE_BITS)
        word = known.value[(place >> np.uint64(6)).astype(np.int64)].view(np.uint64)
        return (word >> (place & np.uint64(63))) & np.uint64(1) == 1

    def count(batch: pa.RecordBatch):
        for part in tokens.slices(batch, 1):
            words = tokens.words(part.column(1))
            row = np.repeat(np.arange(len(part)), np.diff(words.bounds))
            pairs = np.unique(row * np.int64(max(1, len(words.distinct))) + words.codes)
            found = np.bincount(pairs % max(1, len(words.distinct)), minlength=len(words.distinct))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.distinct_hashes.view(np.int64)), pa.array(found[: len(words.distinct)].astype(np.int64))],
                names=["term", "n"],
            )

    def count_others(batches):
        for batch in batches:
            yield from count(batch.filter(pa.array(~repeats(batch))))

    def repeated(batches):
        seen: set[int] = set()
        for batch in batches:
            fresh = repeats(batch)
            for i in np.flatnonzero(fresh):
                value = batch.column(0)[int(i)].as_py()
                fresh[i] = value not in seen
                if len(seen) >= MOST_SEEN:
                    seen.clear()
                seen.add(value)
            yield batch.filter(pa.array(fresh))

    def count_first(batches):
        last = None
        for batch in batches:
            values = batch.column(0).to_numpy()
            if not len(values):
                continue
            fresh = np.append(last is None or values[0] != last, values[1:] != values[:-1])
            last = values[-1]
            yield from count(batch.filter(pa.array(fresh)))

    schema = "term bigint, n bigint"
    together = texts.mapInArrow(repeated, texts.schema).repartition("hash").sortWithinPartitions("hash")
    counts = texts.mapInArrow(count_others, schema).unionAll(together.mapInArrow(count_first, schema))
    rows = hashes.count()
    low, high = rows * math.exp(-band[1]), rows * math.exp(-band[0])
    summed = counts.groupBy("term").agg(F.sum("n").alias("n"))
    terms = staged(summed.where((F.col("n") >= low) & (F.col("n") <= high)).select("term"))
    if (size := terms.count()) > MAX_LEXICON:
        raise ValueError(f"{size} terms are in the band; lower its upper idf")
    return np.sort(terms.toPandas()["term"].to_numpy(dtype=np.int64).view(np.uint64))


class Fingerprinter:
    """Hashes of texts for a lexicon: one row of 16-bit hashes per text, 0 for no terms."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        spread = [tokens.mix(terms + np.uint64(i + 1)) for i in range(len(SUBSETS))]
        self.members = [s < np.uint64(int(rate * (1 << 64))) for s, rate in zip(spread, SUBSETS, strict=True)]
        self.mixed = tokens.mix(terms)

    def hashes(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros((len(texts), len(SUBSETS)), dtype=np.uint16)
        words = tokens.words(texts)
        if not len(self.terms) or not len(words.codes):
            return out
        place = np.minimum(np.searchsorted(self.terms, words.distinct_hashes), len(self.terms) - 1)
        place = np.where(self.terms[place] == words.distinct_hashes, place, -1)
        of = place[words.codes]
        row = np.repeat(np.arange(len(texts)), np.diff(words.bounds))[of >= 0]
        # Distinct terms of every text, sorted.
        pairs = np.unique(row * np.int64(len(self.terms)) + of[of >= 0])
        row, term = pairs // len(self.terms), pairs % len(self.terms)
        for k, members in enumerate(self.members):
            inside = members[term]
            mine, mine_terms = row[inside], term[inside]
            if not len(mine):
                continue
            start = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
            total = tokens.mix(np.add.reduceat(self.mixed[mine_terms], start) + np.uint64(k))
            out[mine[start], k] = np.maximum(total >> np.uint64(48), 1).astype(np.uint16)
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of the subsets of which either text has terms where the hashes agree; 1 if neither has any."""
    used = (a > 0) | (b > 0)
    agree = ((a == b) & used).sum(axis=1)
    n = used.sum(axis=1)
    return np.where(n > 0, agree / np.maximum(n, 1), 1.0)


def as_text(hashes: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in hashes]


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the beginning of the next text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def in_descending_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows in buckets of ids, each sorted by descending id and followed by the next bucket's first row.

    Every row is dealt out once by cut points of the ids; only the row with the largest id of a bucket
    also goes to the end of the bucket above (``copy`` 1), and the very first one to the end of the last
    (``copy`` 2). Cut points and largest ids are lists as long as the number of buckets. Rows of one id
    are ordered by a hash of their text; null ids come last.
    """
    buckets = 2 * max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ids = staged(docs.select(F.col(f"`{id_col}`").alias("id")))
    ranked = numbered(ids.where("id is not null"), ["id"], "number")
    step = max(1, -(-ids.count() // buckets))
    starts = ranked.where((F.col("number") % step == 0) & (F.col("number") > 0)).select("id").distinct()
    cuts = np.array(sorted(r["id"] for r in starts.collect()))

    @F.pandas_udf("int")
    def bucket_of(values: pd.Series) -> pd.Series:
        found = np.zeros(len(values), dtype=np.int32)
        real = values.notna().to_numpy()
        if len(cuts):
            found[real] = np.searchsorted(cuts, values[real].to_numpy().astype(cuts.dtype), side="right")
        return pd.Series(found)

    largest = staged(ids.select("id", bucket_of("id").alias("bucket")).groupBy("bucket").agg(F.max("id").alias("top")))
    ends = largest.orderBy(F.col("bucket").desc()).limit(1).select("top").collect()
    lowest = largest.agg(F.min("bucket")).first()[0]
    # One row per bucket: its largest id, and the bucket above it.
    tops = F.broadcast(largest.withColumn("up", F.lead("bucket").over(Window.orderBy("bucket"))))
    placed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).withColumn(
        "bucket", bucket_of("id")
    )
    is_top, is_first = F.col("id").eqNullSafe(F.col("top")), F.col("id").eqNullSafe(F.lit(ends[0]["top"] if ends else None))
    places = F.array(
        F.struct("bucket", F.lit(0).alias("copy")),
        F.when(is_top & F.col("up").isNotNull(), F.struct(F.col("up").alias("bucket"), F.lit(1).alias("copy"))),
        F.when(is_first, F.struct(F.lit(lowest).cast("int").alias("bucket"), F.lit(2).alias("copy"))),
    )
    dealt = (
        placed.join(tops, "bucket", "left")
        .select("id", "text", F.explode(F.array_compact(places)).alias("p"))
        .select("p.bucket", "p.copy", "id", "text")
    )
    return dealt.repartition(buckets, "bucket").sortWithinPartitions(
        "bucket", "copy", F.col("id").desc_nulls_last(), F.xxhash64("text")
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """Fingerprint of every row and of its text after an edit, and their likeness.

    ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``: the edit
    replaces the last third of the text by the beginning of the next one in descending order of ids,
    the first one after the last. ``near_edited`` is the likeness to the edited text, ``near_next`` to
    the next one. Null texts count as empty; without terms of the band all hashes are 0. Repeated rows
    are separate documents, but count once for the band; equal texts have equal fingerprints. An empty table gives an empty result.
    """
    known = docs.sparkSession.sparkContext.broadcast(lexicon(docs, text_col, band))
    ordered = in_descending_order(docs, id_col, text_col)
    fields = [ordered.schema["id"]] + [T.StructField("n_chars", T.LongType())]
    fields += [T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    schema = T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next")])

    def run(batches):
        maker = Fingerprinter(known.value)
        last = None  # the row before, which waits for its next one
        for batch in batches:
            for part in tokens.slices(batch, 3):
                rows = part if last is None else pa.concat_batches([last, part])
                last = rows.slice(len(rows) - 1)
                bucket, copy = (rows.column(i).to_numpy() for i in (0, 1))
                here = np.flatnonzero((copy[:-1] == 0) & (bucket[:-1] == bucket[1:]))
                if not len(here):
                    continue
                texts = [t.as_py() or "" for t in rows.column(3)]
                changed = [edited(texts[i], texts[i + 1]) for i in here]
                own = maker.hashes(rows.column(3))
                theirs = maker.hashes(pa.array(changed, pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(2).take(pa.array(here)),
                        pa.array([len(texts[i]) for i in here], pa.int64()),
                        pa.array([sha256(t.encode()).hexdigest() for t in changed]),
                        pa.array(as_text(own[here])),
                        pa.array(as_text(theirs)),
                        pa.array(likeness(own[here], theirs)),
                        pa.array(likeness(own[here], own[here + 1])),
                    ],
                    names=schema.names,
                )

    return ordered.mapInArrow(run, schema).withColumnRenamed("id", id_col)
