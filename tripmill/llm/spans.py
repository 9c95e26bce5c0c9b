"""Removal of repeated passages by sliding sentence spans.

From every sentence of every text, a run of RUN consecutive sentences or more is hashed, and equal
runs are joined across all texts. The first occurrence, by id and place, stays; sentences that any other occurrence covers are
removed. A sentence ends at ``.``, ``!`` or ``?`` before white space, or at a line end. Longer ones are
cut after words that their own hash picks, so that a passage is cut alike wherever it stands, even in
the middle of another sentence.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm import tokens
from tripmill.plans.staging import staged

RUN = 3
#: Runs go on to this number of words; shorter ones are too common by chance to mean a passage.
LEAST_WORDS = 13
#: Sentences of more words are cut after every word whose checksum is divisible by CUT.
LONG_SENTENCE = 12
CUT = 4
#: Runs that more texts have than this share of all, and this number, are settled without dealing them out.
HOT_SHARE = 0.001
HOT_TEXTS = 1000
_END = re.compile(r"[.!?][ \t\n\r\x0b\x0c]+|\n[ \t\n\r\x0b\x0c]*")
_WORD = re.compile(r"[^ \t\n\r\x0b\x0c]+[ \t\n\r\x0b\x0c]*")


def sentences(text: str) -> list[str]:
    """Consecutive parts of ``text``, each with the white space after it; joined they give the text."""
    found: list[str] = []
    ends = [m.end() for m in _END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    start = 0
    for end in ends:
        sentence = text[start:end]
        start = end
        if len(sentence) <= 2 * LONG_SENTENCE or len(words := _WORD.findall(sentence)) <= LONG_SENTENCE:
            found.append(sentence)
            continue
        at, cut = len(sentence) - sum(map(len, words)), 0
        for word in words:
            at += len(word)
            if xxhash.xxh32_intdigest(word.rstrip()) % CUT == 0:
                found.append(sentence[cut:at])
                cut = at
        if cut < len(sentence):
            found.append(sentence[cut:])
    return found if text else []


def span_hashes(texts: list[list[str]]) -> tuple[np.ndarray, ...]:
    """Text, place, length in sentences and hash of the runs of several texts.

    From every sentence, the run is the shortest that has RUN sentences and LEAST_WORDS words; near the
    end of a text there may be none. The kind and amount of white space does not count.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    hashes = np.zeros(int(sizes.sum()), dtype=np.uint64)
    counts = np.zeros(len(hashes), dtype=np.int64)
    for i, part in enumerate(chain.from_iterable(texts)):
        words = part.split()
        counts[i] = len(words)
        hashes[i] = xxhash.xxh3_64_intdigest(" ".join(words))
    upto = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(texts)), sizes)
    stop = np.cumsum(sizes)[text]
    starts = np.arange(len(hashes))
    ends = np.maximum(np.searchsorted(upto, upto[:-1] + LEAST_WORDS, "left"), starts + RUN)
    real = ends <= stop
    text, starts, lengths = text[real], starts[real], (ends - starts)[real]
    found = np.zeros(len(starts), dtype=np.uint64)
    for length in np.unique(lengths):
        mine = np.flatnonzero(lengths == length)
        total = np.full(len(mine), length, dtype=np.uint64)
        for i in range(int(length)):
            total = tokens.mix(total) + hashes[starts[mine] + i]
        found[mine] = tokens.mix(total)
    return text, starts - (np.cumsum(sizes) - sizes)[text], lengths, found


def coded_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of a slice of texts in one row: its ids, and packed columns sorted by run, text and place.

    ``again`` marks a run seen before in the same text. Rows with a null id are left out.
    """
    kept = docs.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")
    )
    kind = kept.schema.fields[0].dataType.simpleString()

    def find(batches):
        for batch in batches:
            for part in tokens.slices(batch, 1):
                row, place, length, run = span_hashes([sentences(t.as_py() or "") for t in part.column(1)])
                order = np.lexsort((place, row, run))
                row, place, length, run = row[order], place[order], length[order], run[order]
                again = np.zeros(len(run), dtype=np.uint8)
                again[1:] = (row[1:] == row[:-1]) & (run[1:] == run[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column(0)),
                        pa.array([tokens.pack_steps(run)], pa.binary()),
                        pa.array([tokens.pack(row.astype(np.uint32))], pa.binary()),
                        pa.array([tokens.pack(place.astype(np.uint32))], pa.binary()),
                        pa.array([tokens.pack(length.astype(np.uint32))], pa.binary()),
                        pa.array([tokens.pack(again)], pa.binary()),
                    ],
                    names=["ids", "runs", "rows", "places", "lengths", "again"],
                )

    return kept.mapInArrow(find, f"ids array<{kind}>, runs binary, rows binary, places binary, lengths binary, again binary")


def _opened(row: dict):
    """Runs of a packed row: hash, text, place, length and whether seen before in the text."""
    numbers = (tokens.unpack(row[c], np.uint32).astype(np.int64) for c in ("rows", "places", "lengths"))
    return tokens.unpack_steps(row["runs"]), *numbers, tokens.unpack(row["again"], np.uint8).astype(bool)


def frequent_runs(coded: DataFrame) -> np.ndarray:
    """Runs that about HOT_SHARE of all texts and HOT_TEXTS texts or more have, sorted.

    A run is counted in the slices where at least half of that share of the texts has it. There are at
    most 2 * (mean runs of a text) / HOT_SHARE of them.
    """

    def count(batches):
        for batch in batches:
            for row in batch.to_pylist():
                run, _, _, _, again = _opened(row)
                values, counts = np.unique(run[~again], return_counts=True)
                often = counts >= max(2, HOT_SHARE / 2 * len(row["ids"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[often].view(np.int64)), pa.array(counts[often].astype(np.int64))], names=["run", "n"]
                )

    texts = coded.agg(F.sum(F.size("ids"))).first()[0] or 0
    counted = coded.mapInArrow(count, "run bigint, n bigint").groupBy("run").agg(F.sum("n").alias("n"))
    found = counted.where(F.col("n") >= max(HOT_TEXTS, HOT_SHARE * texts) / 2).select("run").toPandas()["run"]
    return np.sort(found.to_numpy(dtype=np.int64).view(np.uint64))


def _is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


_LISTS = "bucket int, ids array<{kind}>, covered array<array<struct<first: int, last: int>>>"


def _merged(text: np.ndarray, place: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
    """Texts that have spans, and the first and last sentences of theirs, merged where they meet."""
    if not len(text):
        pair = pa.struct([("first", pa.int32()), ("last", pa.int32())])
        return text, pa.array([], pa.list_(pair))
    order = np.lexsort((place, text))
    text, place, length = text[order], place[order], length[order]
    # No span of a text reaches the places of the next one.
    offset = text * (int((place + length).max()) + 1)
    reach = np.maximum.accumulate(offset + place + length)
    start = np.flatnonzero(np.concatenate([[True], (offset + place)[1:] > reach[:-1]]))
    end = np.append(start[1:], len(text)) - 1
    mine, counts = np.unique(text[start], return_counts=True)
    last = reach[end] - offset[start] - 1
    pair = pa.StructArray.from_arrays(
        [pa.array(place[start].astype(np.int32)), pa.array(last.astype(np.int32))], names=["first", "last"]
    )
    return mine, pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pair)


def _by_bucket(ids: pa.Array, covered: pa.ListArray, buckets: int) -> list[pa.Array]:
    """Texts and their spans in one row for each bucket of ids."""
    bucket = hash_array(ids.to_numpy(zero_copy_only=False)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
    full = np.flatnonzero(np.diff(cuts))
    bounds = pa.array(np.append(cuts[full], len(order)).astype(np.int32))
    taken = pa.array(order)
    return [
        pa.array(full.astype(np.int32)),
        pa.ListArray.from_arrays(bounds, ids.take(taken)),
        pa.ListArray.from_arrays(bounds, covered.take(taken)),
    ]


def _gathered(table: pa.Table) -> pa.Table:
    """One row for each id of a bucket, with its spans from everywhere."""
    ids = table["ids"].combine_chunks().flatten()
    lists = table["covered"].combine_chunks().flatten()
    _, first, owner = np.unique(ids.to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
    of_span = np.repeat(owner, lists.value_lengths().to_numpy(zero_copy_only=False))
    spans = lists.flatten().take(pa.array(np.argsort(of_span, kind="stable")))
    bounds = np.concatenate([[0], np.cumsum(np.bincount(of_span, minlength=len(first)))])
    return pa.table([ids.take(pa.array(first)), pa.ListArray.from_arrays(bounds.astype(np.int32), spans)], names=["id", "covered"])


def repeats(coded: DataFrame, shards: int) -> DataFrame:
    """``id, covered``: first and last sentence of all runs that are not the first of their hash.

    ``coded`` is staged. Runs are dealt out by hash, and the first text of each is found among its own.
    Runs that many texts have are not: the smallest id of each is found by partial minima, and as they
    are few, these go to all tasks.
    """
    context = coded.sparkSession.sparkContext
    kind = coded.schema["ids"].dataType.elementType.simpleString()
    frequent = frequent_runs(coded)
    known = context.broadcast(frequent)

    def smallest(batches):
        for batch in batches:
            for row in batch.to_pylist():
                run, text, _, _, _ = _opened(row)
                mine = _is_in(run, known.value)
                least: dict[int, object] = {}
                for r, t in zip(run[mine].tolist(), text[mine].tolist(), strict=True):
                    least[r] = min(least.get(r, row["ids"][t]), row["ids"][t])
                signed = np.fromiter(least.keys(), np.uint64, len(least)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed), pa.array(list(least.values()), batch.schema.field("ids").type.value_type)],
                    names=["run", "id"],
                )

    first_of = {}
    if len(frequent):
        minima = coded.mapInArrow(smallest, f"run bigint, id {kind}").groupBy("run").agg(F.min("id").alias("id"))
        first_of = {r["run"] % (1 << 64): r["id"] for r in minima.collect()}
    firsts = context.broadcast(first_of)

    def settle_frequent(batches):
        for batch in batches:
            for ids, row in zip(batch.column(0), batch.to_pylist(), strict=True):
                run, text, place, length, again = _opened(row)
                mine = np.flatnonzero(_is_in(run, known.value))
                later = [i for i in mine if again[i] or firsts.value[int(run[i])] != row["ids"][text[i]]]
                taken = np.array(later, dtype=np.int64)
                mine, covered = _merged(text[taken], place[taken], length[taken])
                found = _by_bucket(ids.values.take(pa.array(mine)), covered, shards)
                yield pa.RecordBatch.from_arrays(found, names=["bucket", "ids", "covered"])

    def deal(batches):
        for batch in batches:
            for ids, row in zip(batch.column(0), batch.to_pylist(), strict=True):
                run, text, place, length, again = _opened(row)
                shard = ((run >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
                rare = ~_is_in(run, known.value)
                run, text, place, length, again, shard = (x[rare] for x in (run, text, place, length, again, shard))
                cuts = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
                for s in np.flatnonzero(np.diff(cuts)):
                    here = slice(cuts[s], cuts[s + 1])
                    mine, local = np.unique(text[here], return_inverse=True)
                    taken = ids.values.take(pa.array(mine))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(s)], pa.int32()),
                            pa.ListArray.from_arrays(pa.array([0, len(taken)], pa.int32()), taken),
                            pa.array([tokens.pack_steps(run[here])], pa.binary()),
                            pa.array([tokens.pack(local.astype(np.uint32))], pa.binary()),
                            pa.array([tokens.pack(place[here].astype(np.uint32))], pa.binary()),
                            pa.array([tokens.pack(length[here].astype(np.uint32))], pa.binary()),
                            pa.array([tokens.pack(again[here].astype(np.uint8))], pa.binary()),
                        ],
                        names=["shard", "ids", "runs", "rows", "places", "lengths", "again"],
                    )

    def settle(table: pa.Table) -> pa.Table:
        lists = table["ids"].combine_chunks()
        ids, starts = lists.flatten(), np.cumsum([0, *lists.value_lengths().to_pylist()])
        rank = np.unique(ids.to_numpy(zero_copy_only=False), return_inverse=True)[1]
        parts = [_opened(row) for row in table.drop_columns(["ids"]).to_pylist()]
        run, place, length, again = (np.concatenate([p[i] for p in parts]) for i in (0, 2, 3, 4))
        text = np.concatenate([p[1] + start for p, start in zip(parts, starts[:-1], strict=True)])
        order = np.argsort(run, kind="stable")
        run, text, place, length, again = (x[order] for x in (run, text, place, length, again))
        start = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        first = np.repeat(np.minimum.reduceat(rank[text], start), np.diff(np.append(start, len(run))))
        later = np.flatnonzero(again | (rank[text] != first))
        mine, covered = _merged(text[later], place[later], length[later])
        return pa.table(_by_bucket(ids.take(pa.array(mine)), covered, shards), names=["bucket", "ids", "covered"])

    lists = _LISTS.format(kind=kind)
    dealt = coded.mapInArrow(
        deal, f"shard int, ids array<{kind}>, runs binary, rows binary, places binary, lengths binary, again binary"
    )
    later = dealt.groupBy("shard").applyInArrow(settle, lists)
    if len(frequent):
        later = later.union(coded.mapInArrow(settle_frequent, lists))
    return later.groupBy("bucket").applyInArrow(_gathered, f"id {kind}, covered array<struct<first: int, last: int>>")


def without(text: str, spans) -> tuple[str, int, int]:
    """``text`` without the sentences that ``spans`` cover; the number of sentences and of removed ones."""
    parts = sentences(text)
    covered = {i for span in spans for i in range(span["first"], span["last"] + 1)}
    if not covered:
        return text, len(parts), 0
    return "".join(s for i, s in enumerate(parts) if i not in covered), len(parts), len(covered)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text without repeated passages, and ``n_sentences`` and ``n_removed``.

    The text keeps what is left as it was; a text that repeats others altogether becomes empty. Rows of
    one id are taken for one document and lose the same places. Rows with a null id stay as they are and
    are no first occurrence for others; a null text stays null and has no sentences. An empty table gives an empty
    result. All other columns are kept.
    """
    names = docs.columns
    shards = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = staged(repeats(staged(coded_runs(docs, id_col, text_col)), shards))
    packed = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.struct(*[F.col(f"`{c}`") for c in names if c != text_col]).alias("rest"),
        F.col(f"`{text_col}`").alias("text"),
    )
    joined = packed.join(found, "id", "left").select("rest", "text", "covered")
    schema = T.StructType(
        [
            joined.schema["rest"],
            T.StructField("text", T.StringType()),
            T.StructField("n_sentences", T.LongType()),
            T.StructField("n_removed", T.LongType()),
        ]
    )

    def rewrite(batches):
        for batch in batches:
            rows = []
            for text, covered in zip(batch.column(1), batch.column(2), strict=True):
                known = text.as_py()
                rows.append((None, 0, 0) if known is None else without(known, covered.as_py() or ()))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            made = [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=schema.names)

    rest = [F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in names]
    return joined.mapInArrow(rewrite, schema).select(*rest, "n_sentences", "n_removed")
