"""Word bigram model in Elias-Fano tries, trained and applied in one pass over batches of texts.

Words and pairs of words are dealt out to tasks by hash; neither counts nor tries ever meet in one
place. With texts in batches of some megabytes, each exchange moves a distinct word or pair once per
batch:

1. A batch is coded by its distinct words and written to the shared folder.
2. Word tasks add up the training counts and number the words; batches get both back.
3. Pair tasks add up the training counts of the pairs they are asked for and build their part of the
   trie: contexts, pointers to their successors, and a quantised probability of each. They look up all
   pairs that batches ask for in it and return the codes.
4. A batch combines codes and counts to the probability of each of its tokens.

The probability of a word v after u is ``a(u, v) + (1 - w(u)) * p(v)``. ``a`` is ``w(u) * c(u v) / c(u)``,
which the trie holds as a 16-bit logarithm; the weight ``w(u) = MOST * c(u) / (c(u) + HALF)`` trusts
frequent contexts more. ``p`` takes DISCOUNT from the count of every known word and gives the sum to the
unknown word, so the probabilities of all words and the unknown one add up to 1, but for rounding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm import tokens
from tripmill.llm.eliasfano import PairTrie
from tripmill.llm.tables import groups_of
from tripmill.plans.staging import staged

MOST = 0.4
HALF = 20.0
DISCOUNT = 0.75
#: Bytes of text in a batch; the larger it is, the fewer words and pairs are asked for twice.
BATCH_BYTES = 12 << 20
#: Codes of a probability per power of ten; 0 means not in the trie.
CODES = 4096
#: Text end, which also comes before the first word. No word has this hash but by chance.
END = xxhash.xxh3_64_intdigest(b"\n")

_BATCH = "batch bigint, ids array<{kind}>, held_out array<boolean>, lengths binary, words binary, trained binary, codes binary"


def encoded(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Batches of texts: distinct word hashes, their training counts, and the texts as word places."""
    kept = docs.select(
        F.col(f"`{id_col}`").alias("id"), held_out.alias("held_out"), F.col(f"`{text_col}`").alias("text")
    )
    kind = kept.schema.fields[0].dataType.simpleString()

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in tokens.slices(batch, 2, BATCH_BYTES):
                number += 1
                words = tokens.words(part.column(2))
                lengths = np.diff(words.bounds) + 1
                ends = np.cumsum(lengths) - 1
                all_codes = np.empty(int(lengths.sum()), dtype=np.int64)
                is_end = np.zeros(len(all_codes), dtype=bool)
                is_end[ends] = True
                all_codes[is_end] = len(words.distinct_hashes)
                all_codes[~is_end] = words.codes
                hashes = np.append(words.distinct_hashes, np.uint64(END))
                ordered, place = np.unique(hashes, return_inverse=True)
                codes = place[all_codes].astype(np.uint32)
                out = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                training = codes[np.repeat(~out, lengths)]
                trained = np.bincount(training, minlength=len(ordered)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column(0)),
                        pa.array([out.tolist()], pa.list_(pa.bool_())),
                        pa.array([tokens.pack(lengths.astype(np.uint32))], pa.binary()),
                        pa.array([tokens.pack_steps(ordered)], pa.binary()),
                        pa.array([tokens.pack(trained)], pa.binary()),
                        pa.array([tokens.pack(codes)], pa.binary()),
                    ],
                    names=["batch", "ids", "held_out", "lengths", "words", "trained", "codes"],
                )

    return kept.mapInArrow(run, _BATCH.format(kind=kind))


def _parts(shard: np.ndarray, shards: int):
    """Shards in use with the bounds of their entries; ``shard`` is ascending."""
    cuts = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
    return [(int(s), slice(cuts[s], cuts[s + 1])) for s in np.flatnonzero(np.diff(cuts))]


def _word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard by the upper bits, so that ascending hashes have ascending shards."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def word_answers(batches: DataFrame, shards: int) -> DataFrame:
    """For every batch and word shard, ids and training counts of the words in their order.

    A row without a batch has the shard's totals: words, their count, and how many were seen.
    """

    def ask(parts):
        for part in parts:
            for batch, words, trained in zip(*part.columns, strict=True):
                hashes, counts = tokens.unpack_steps(words.as_py()), tokens.unpack(trained.as_py(), np.uint32)
                for shard, here in _parts(_word_shard(hashes, shards), shards):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([shard], pa.int32()),
                            pa.array([batch.as_py()], pa.int64()),
                            pa.array([tokens.pack_steps(hashes[here])], pa.binary()),
                            pa.array([tokens.pack(counts[here])], pa.binary()),
                        ],
                        names=["shard", "batch", "words", "trained"],
                    )

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        asked = [tokens.unpack_steps(r["words"]) for r in rows]
        counts = np.concatenate([tokens.unpack(r["trained"], np.uint32) for r in rows]).astype(np.uint64)
        known, place = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.zeros(len(known), dtype=np.uint64)
        np.add.at(total, place, counts)
        ids = np.arange(len(known), dtype=np.uint64) * np.uint64(shards) + np.uint64(rows[0]["shard"])
        bounds = np.cumsum([0, *map(len, asked)])
        spans = [place[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return pa.table(
            {
                "shard": pa.array([rows[0]["shard"]] * (len(rows) + 1), pa.int32()),
                "batch": pa.array([r["batch"] for r in rows] + [None], pa.int64()),
                "ids": pa.array([tokens.pack_steps(ids[s]) for s in spans] + [None], pa.binary()),
                "counts": pa.array([tokens.pack(total[s]) for s in spans] + [None], pa.binary()),
                "total": pa.array([None] * len(rows) + [int(total.sum())], pa.int64()),
                "distinct": pa.array([None] * len(rows) + [int((total > 0).sum())], pa.int64()),
            }
        )

    asked = batches.select("batch", "words", "trained").mapInArrow(ask, "shard int, batch bigint, words binary, trained binary")
    return asked.groupBy("shard").applyInArrow(
        answer, "shard int, batch bigint, ids binary, counts binary, total bigint, distinct bigint"
    )


def _known_words(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and counts of a batch's words, from the answers of all shards."""
    ordered = sorted(rows, key=lambda r: r["shard"])
    ids = np.concatenate([tokens.unpack_steps(r["ids"]) for r in ordered])
    return ids, np.concatenate([tokens.unpack(r["counts"]) for r in ordered])


def _pairs(row: dict, ids: np.ndarray, shards: int):
    """Distinct pairs of a batch in the order of shard and ids, and which pair every token is.

    Returns local places of context and successor, shard, and the pair of each token.
    """
    codes = tokens.unpack(row["codes"], np.uint32).astype(np.int64)
    hashes = tokens.unpack_steps(row["words"])
    end = int(np.searchsorted(hashes, np.uint64(END)))
    before = np.concatenate([[end], codes[:-1]])
    n = np.int64(len(hashes))
    keys, of_token = np.unique(before * n + codes, return_inverse=True)
    first, second = keys // n, keys % n
    shard = tokens.mix(tokens.mix(ids[first]) + ids[second]) % np.uint64(shards)
    order = np.lexsort((ids[second], ids[first], shard))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return first[order], second[order], shard[order], rank[of_token], codes


def pair_requests(batches: DataFrame, answers: DataFrame, shards: int) -> DataFrame:
    """Every distinct pair of a batch, grouped by context, with context count and training count."""

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            ids, counts = _known_words(right.to_pylist())
            first, second, shard, of_token, _ = _pairs(row, ids, shards)
            lengths = tokens.unpack(row["lengths"], np.uint32)
            training = of_token[np.repeat(~np.array(row["held_out"], dtype=bool), lengths)]
            trained = np.bincount(training, minlength=len(first)).astype(np.uint32)
            for s, here in _parts(shard, shards):
                context = first[here]
                start = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
                out.append(
                    {
                        "shard": s,
                        "batch": row["batch"],
                        "contexts": tokens.pack_steps(ids[context[start]]),
                        "context_counts": tokens.pack(counts[context[start]]),
                        "widths": tokens.pack(np.diff(np.append(start, len(context))).astype(np.uint32)),
                        "successors": tokens.pack(ids[second[here]]),
                        "trained": tokens.pack(trained[here]),
                    }
                )
        kinds = [("shard", pa.int32()), ("batch", pa.int64())] + [
            (c, pa.binary()) for c in ("contexts", "context_counts", "widths", "successors", "trained")
        ]
        return pa.Table.from_pylist(out, schema=pa.schema(kinds))

    words = answers.where("batch is not null").select("batch", "shard", "ids", "counts")
    return (
        batches.groupBy("batch")
        .cogroup(words.groupBy("batch"))
        .applyInArrow(
            ask,
            "shard int, batch bigint, contexts binary, context_counts binary, widths binary, successors binary, trained binary",
        )
    )


def weight(counts: np.ndarray) -> np.ndarray:
    return MOST * counts / (counts + HALF)


def to_codes(context_counts: np.ndarray, pair_counts: np.ndarray) -> np.ndarray:
    share = weight(context_counts) * pair_counts / np.maximum(context_counts, 1)
    return np.clip(1 + np.rint(-np.log10(np.maximum(share, 1e-300)) * CODES), 1, 65535).astype(np.uint16)


def from_codes(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** (-(codes.astype(np.float64) - 1) / CODES), 0.0)


def _expanded(row: dict):
    widths = tokens.unpack(row["widths"], np.uint32).astype(np.int64)
    contexts = tokens.unpack_steps(row["contexts"])
    return contexts, np.repeat(np.arange(len(contexts)), widths), tokens.unpack(row["successors"])


def _trie_levels(rows: list[dict]) -> bytes:
    """The trie of the pairs that a shard's requests have training counts for."""
    context, successor, trained, of_context = [], [], [], []
    for row in rows:
        contexts, of, successors = _expanded(row)
        counts = tokens.unpack(row["trained"], np.uint32)
        seen = counts > 0
        context.append(contexts[of[seen]])
        successor.append(successors[seen])
        trained.append(counts[seen].astype(np.float64))
        of_context.append(tokens.unpack(row["context_counts"]).astype(np.float64)[of[seen]])
    context, successor, trained, of_context = map(np.concatenate, (context, successor, trained, of_context))
    order = np.lexsort((successor, context))
    context, successor, trained, of_context = context[order], successor[order], trained[order], of_context[order]
    fresh = np.ones(len(context), dtype=bool)
    fresh[1:] = (context[1:] != context[:-1]) | (successor[1:] != successor[:-1])
    start = np.flatnonzero(fresh)
    counts = np.add.reduceat(trained, start) if len(start) else trained
    return PairTrie.levels(context[start], successor[start], to_codes(of_context[start], counts))


def tries(requests: DataFrame) -> DataFrame:
    """``shard, levels``: the model's trie, one part per shard; open a part with ``PairTrie.mapped``."""

    def build(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        return pa.table({"shard": pa.array([rows[0]["shard"]], pa.int32()), "levels": pa.array([_trie_levels(rows)], pa.binary())})

    return requests.groupBy("shard").applyInArrow(build, "shard int, levels binary")


def pair_answers(requests: DataFrame) -> DataFrame:
    """For every request, the codes of its pairs in the shard's part of the trie."""

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        trie = PairTrie.mapped(_trie_levels(rows))
        found = [tokens.pack(trie.lookup(*_expanded(row))) for row in rows]
        return pa.table(
            {
                "shard": pa.array([r["shard"] for r in rows], pa.int32()),
                "batch": pa.array([r["batch"] for r in rows], pa.int64()),
                "pair_codes": pa.array(found, pa.binary()),
            }
        )

    return requests.groupBy("shard").applyInArrow(answer, "shard int, batch bigint, pair_codes binary")


def token_scores(first_counts, second_counts, pair_codes, total: int, distinct: int) -> np.ndarray:
    """log10 probability of each token after its context, from counts and codes."""
    if total == 0:
        return np.zeros(len(second_counts))
    unknown = DISCOUNT * distinct / total
    single = np.where(second_counts > 0, (second_counts - DISCOUNT) / total, unknown)
    return np.log10(from_codes(pair_codes) + (1 - weight(first_counts)) * single)


def combined(batches: DataFrame, words: DataFrame, pairs: DataFrame, total: int, distinct: int, shards: int) -> DataFrame:
    """Scores of every text from the answers to its batch."""
    kind = batches.schema["ids"].dataType.elementType.simpleString()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        (row,) = left.to_pylist()
        answers = right.to_pylist()
        ids, counts = _known_words([r for r in answers if r["ids"] is not None])
        by_shard = sorted((r for r in answers if r["pair_codes"] is not None), key=lambda r: r["shard"])
        found = np.concatenate([tokens.unpack(r["pair_codes"], np.uint16) for r in by_shard])
        first, second, _, of_token, codes = _pairs(row, ids, shards)
        counts = counts.astype(np.float64)
        by_pair = token_scores(counts[first], counts[second], found, total, distinct)
        base = np.log10((counts + 0.1) / (total + 0.1 * (distinct + 1)))
        lengths = tokens.unpack(row["lengths"], np.uint32).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        known = np.add.reduceat((counts[codes] > 0).astype(np.int64), starts)
        n = len(lengths)
        return pa.table(
            {
                "id": left.column("ids").combine_chunks().flatten(),
                "held_out": pa.array(row["held_out"], pa.bool_()),
                "n_tokens": pa.array(lengths),
                "n_known": pa.array(known),
                "train_tokens": pa.array([total] * n, pa.int64()),
                "base_score": pa.array(np.add.reduceat(base[codes], starts)),
                "score": pa.array(np.add.reduceat(by_pair[of_token], starts)),
            }
        )

    none = F.lit(None).cast("binary")
    both = words.where("batch is not null").select("batch", "shard", "ids", "counts", none.alias("pair_codes")).unionByName(
        pairs.select("batch", "shard", none.alias("ids"), none.alias("counts"), "pair_codes")
    )
    return (
        batches.groupBy("batch")
        .cogroup(both.groupBy("batch"))
        .applyInArrow(
            score,
            f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
        )
    )


def scored(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every whole text.

    The model is trained on the rows that are not ``held_out`` and scores all rows. Tokens are words in
    lower-case A-Z and one end per text. A null text has the end only. Repeated rows all count. Without
    training rows no token is known and all scores are 0. An empty table gives an empty result. Words
    are told apart by 64-bit hashes.
    """
    batches = staged(encoded(docs, F.coalesce(held_out, F.lit(False)), id_col, text_col))
    shards = groups_of(batches)
    words = staged(word_answers(batches, shards))
    sums = words.agg(F.sum("total").alias("n"), F.sum("distinct").alias("v")).first()
    total, distinct = sums["n"] or 0, sums["v"] or 0
    pairs = staged(pair_answers(pair_requests(batches, words, shards)))
    return combined(batches, words, pairs, total, distinct, shards).withColumnRenamed("id", id_col)
