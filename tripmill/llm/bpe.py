"""Byte-level BPE encoding and decoding with a two-tier lookup.

A pre-token that is a token as a whole is found by a minimal perfect hash over the vocabulary. Any
other one is merged from its bytes: they form a linked list, and a heap holds the possible merges by
rank and place. Every merge takes the lowest rank, the leftmost of several, until none is left.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The vocabulary goes to every executor; a larger file is refused.
MAX_VOCABULARY_BYTES = 64 << 20
#: Pre-tokens that a Python worker remembers in each of two generations (about 270 bytes each), and the
#: longest remembered one. Fewer take less memory and more time, and change no result.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 64
#: A text of more characters is cut into pre-tokens piecewise, so that they are never all in memory.
STREAM_CHARS = 2_000_000

_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _spread(value: int, displacement: int) -> int:
    x = ((value ^ (displacement * _GOLDEN)) * 0xBF58476D1CE4E5B9) & _MASK
    return x ^ (x >> 31)


class PerfectHash:
    """Minimal perfect hash: ``n`` keys to the slots 0 to ``n`` - 1, by displaced buckets.

    Keys fall into buckets; the largest buckets first look for a displacement that puts all their
    keys into free slots, and buckets of one key take what is left. A key that is not in the set
    also gets a slot, so the caller compares it with the key there.
    """

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.buckets = max(1, self.n // 3)
        groups: dict[int, list[int]] = {}
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            groups.setdefault(h % self.buckets, []).append(i)
        owner = [-1] * self.n
        self.displacement = [0] * self.buckets
        ordered = sorted(groups.items(), key=lambda g: (-len(g[1]), g[0]))
        free = None
        for bucket, members in ordered:
            if len(members) == 1:
                free = free or iter([s for s in range(self.n) if owner[s] < 0])
                slot = next(free)
                owner[slot] = members[0]
                self.displacement[bucket] = -slot - 1
                continue
            d = 1
            while True:
                slots = [_spread(hashes[i], d) % self.n for i in members]
                if len(set(slots)) == len(slots) and all(owner[s] < 0 for s in slots):
                    break
                d += 1
            for s, i in zip(slots, members, strict=True):
                owner[s] = i
            self.displacement[bucket] = d
        #: Index of the key in each slot.
        self.owner = owner

    def slot(self, key: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(key)
        d = self.displacement[h % self.buckets]
        return -d - 1 if d < 0 else _spread(h, d) % self.n


class Vocabulary:
    """Tokens by rank, read from a file of base64 tokens and ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        ordered = sorted(ranks, key=ranks.get)
        self.hash = PerfectHash(ordered)
        self.in_slot = [ordered[i] for i in self.hash.owner]
        self.rank_in_slot = [ranks[t] for t in self.in_slot]

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as file:
            content = file.read(MAX_VOCABULARY_BYTES + 1)
        if len(content) > MAX_VOCABULARY_BYTES:
            raise ValueError(f"{path} has more than {MAX_VOCABULARY_BYTES} bytes")
        pairs = (line.split() for line in content.splitlines() if line)
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def whole(self, token: bytes) -> int | None:
        """Rank of ``token`` if it is in the vocabulary."""
        slot = self.hash.slot(token)
        return self.rank_in_slot[slot] if self.in_slot[slot] == token else None

    def merged(self, data: bytes) -> list[int]:
        """Ids of ``data`` by merging its bytes in rank order."""
        rank_of = self.ranks.get
        end = len(data)
        following = list(range(1, end + 1))  # where the part that starts here ends
        previous = list(range(-1, end - 1))
        alive = [True] * end
        heap = [
            (rank, i, i + 2)
            for i in range(end - 1)
            if (rank := rank_of(data[i : i + 2])) is not None
        ]
        heapq.heapify(heap)
        while heap:
            _, left, stop = heapq.heappop(heap)
            right = following[left] if alive[left] else end
            # The entry holds only while both its parts are still those it was made for.
            if right >= end or following[right] != stop:
                continue
            alive[right] = False
            following[left] = stop
            if stop < end:
                previous[stop] = left
                if (rank := rank_of(data[left : following[stop]])) is not None:
                    heapq.heappush(heap, (rank, left, following[stop]))
            before = previous[left]
            if before >= 0 and (rank := rank_of(data[before:stop])) is not None:
                heapq.heappush(heap, (rank, before, stop))
        ids, at = [], 0
        while at < end:
            ids.append(self.ranks[data[at : following[at]]])
            at = following[at]
        return ids


class Encoder(dict):
    """What becomes of each pre-token: the decimals of its ids joined by commas, and the bytes they decode to.

    What is not remembered is looked up in the two tiers, and decoded from its ids. When a generation of
    remembered pre-tokens is full, it becomes the older one; what is still in use moves on from there.
    It is broadcast as its vocabulary alone. A worker remembers in the copy that it gets, for all tasks of the
    broadcast, and drops both together when it takes up other work.
    """

    def __init__(self, vocabulary: Vocabulary, remembered: int | None = None):
        super().__init__()
        self.vocabulary = vocabulary
        self.remembered = remembered
        self.pattern = regex.compile(vocabulary.pattern)
        self.decimal = {rank: str(rank) for rank in vocabulary.tokens}
        self.older: dict[str, tuple[str, bytes]] = {}

    def __reduce__(self):
        return Encoder, (self.vocabulary, self.remembered)

    def __missing__(self, pretoken: str) -> tuple[str, bytes]:
        found = self.older.get(pretoken)
        if found is None:
            data = pretoken.encode()
            rank = self.vocabulary.whole(data)
            ids = (rank,) if rank is not None else self.vocabulary.merged(data)
            found = ",".join(map(self.decimal.__getitem__, ids)), self.decode(ids)
        if len(pretoken) <= LONGEST_REMEMBERED:
            if len(self) >= (self.remembered or REMEMBERED):
                self.older = dict(self)
                self.clear()
            self[pretoken] = found
        return found

    def runs(self, text: str) -> Iterator[tuple[str, bytes]]:
        """Decimal ids and decoded bytes of ``text`` in runs; a text of ordinary length is one run."""
        if len(text) <= STREAM_CHARS:
            pieces = iter([self.pattern.findall(text)])
        else:
            matches = (m.group() for m in self.pattern.finditer(text))
            pieces = iter(lambda: list(islice(matches, 100_000)), [])
        for piece in pieces:
            if piece:
                run = list(map(self.__getitem__, piece))
                yield ",".join([d for d, _ in run]), b"".join([b for _, b in run])

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids of ``text`` in runs."""
        for decimals, _ in self.runs(text):
            yield list(map(int, decimals.split(",")))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


def _mapped(docs: DataFrame, columns: list[str], encoder: Encoder, row, added: list[T.StructField]) -> DataFrame:
    """Apply ``row(encoder, value)`` to the last of ``columns``; the others are kept."""
    shared = docs.sparkSession.sparkContext.broadcast(encoder)
    kept = docs.select(*[F.col(f"`{c}`") for c in columns])
    schema = T.StructType([*kept.schema.fields[:-1], *added])

    def run(batches):
        encoder = shared.value
        for batch in batches:
            results = [row(encoder, value.as_py()) for value in batch.column(batch.num_columns - 1)]
            new = [pa.array([r[i] for r in results], arrow_types[i]) for i in range(len(added))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=schema.names)

    arrow_types = [_ARROW[field.dataType.simpleString()] for field in added]
    return kept.mapInArrow(run, schema)


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "binary": pa.binary()}


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids``: the token ids of every whole text. A null or empty text has no ids."""

    def row(encoder: Encoder, text: str | None):
        return (np.fromiter(chain.from_iterable(encoder.encode(text or "")), dtype=np.int32),)

    return _mapped(docs, [id_col, text_col], Encoder(vocabulary), row, [T.StructField("ids", T.ArrayType(T.IntegerType()))])


def decode(tokens: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id, data``: the bytes of every list of ids; null ids count as none."""

    def row(encoder: Encoder, ids):
        return (encoder.decode(ids or ()),)

    return _mapped(tokens, [id_col, ids_col], Encoder(vocabulary), row, [T.StructField("data", T.BinaryType())])


def digests(
    docs: DataFrame,
    vocabulary: Vocabulary,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    remembered: int | None = None,
) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` of every whole text, and ``ids`` if asked for.

    The first hash is over the decimal ids joined by commas, the second over the bytes the ids
    decode to. Encoding, decoding and hashing go run by run, so a long text needs little memory. A
    null text counts as empty: no ids, hashes of nothing. ``remembered`` sets how many pre-tokens a worker
    remembers where executors have little memory to spare. Repeated rows and null ids are rows like
    any other; an empty table gives an empty result; other columns are not read.
    """

    def row(encoder: Encoder, text: str | None):
        n, listed, decoded, kept = 0, sha256(), sha256(), []
        for decimals, data in encoder.runs(text or ""):
            if n:
                listed.update(b",")
            n += decimals.count(",") + 1
            listed.update(decimals.encode())
            decoded.update(data)
            if with_ids:
                kept.append(np.fromstring(decimals, dtype=np.int32, sep=","))
        found = n, listed.hexdigest(), decoded.hexdigest()
        return (*found, np.concatenate(kept or [np.zeros(0, np.int32)])) if with_ids else found

    added = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    if with_ids:
        added.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    return _mapped(docs, [id_col, text_col], Encoder(vocabulary, remembered), row, added)
