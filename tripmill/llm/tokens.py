"""Words of Arrow text columns as numpy arrays, and packed integer columns for shuffles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard

#: UTF-8 bytes of text that a task works on at a time; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20

_GOLDEN = 0x9E3779B97F4A7C15


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(batch: pa.RecordBatch, text_column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``limit`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text_column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if len(sizes) > start:
        yield batch.slice(start)


@dataclass
class Words:
    """Words of several texts: ``hashes`` of all in order, and the bounds of each text."""

    codes: np.ndarray
    bounds: np.ndarray
    distinct: pa.Array
    distinct_hashes: np.ndarray

    @property
    def hashes(self) -> np.ndarray:
        return self.distinct_hashes[self.codes]


def words(texts: pa.Array) -> Words:
    """Lower-case A-Z and cut at ASCII white space; a null text has no words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, lengths = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    real = pc.not_equal(flat, "")
    if pc.sum(real).as_py() != len(flat):  # white space at an end leaves an empty string there
        kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
        bounds = kept[bounds]
        flat = flat.filter(real)
    encoded = flat.dictionary_encode()
    distinct = encoded.dictionary
    hashes = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in distinct.cast(pa.binary()).to_pylist()), np.uint64, len(distinct)
    )
    return Words(encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds, distinct, hashes)


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each ``length`` consecutive entries."""
    n = max(0, len(hashes) - length + 1)
    found = np.zeros(n, dtype=np.uint64)
    for i in range(length):
        found = mix(found + np.uint64(_GOLDEN * (i + 1) % (1 << 64))) + hashes[i : i + n]
    return mix(found)


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes; ascending ones are best packed as steps."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(packed: bytes, kind=np.uint64) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).reshape(-1)


def pack_steps(ascending: np.ndarray) -> bytes:
    return pack(np.diff(ascending, prepend=ascending.dtype.type(0)))


def unpack_steps(packed: bytes, kind=np.uint64) -> np.ndarray:
    return np.cumsum(unpack(packed, kind), dtype=kind)
