"""Arrow and numpy helpers that the map tasks share: whole texts to word codes without a Python loop over words.

Texts are cut at bytes below 128 only, so cutting the UTF-8 bytes gives the same words as cutting the characters.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

SPACE = 32
CHUNK_BYTES = 8_000_000


def byte_table(separators: Iterable[int], lower: bool) -> np.ndarray:
    """What each byte becomes before a text is cut: a space for separators, lower case for A-Z if asked for."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[list(separators)] = SPACE
    return table


BLANKS = [SPACE, *range(0x09, 0x0E)]
KEEP_CASE = byte_table(BLANKS, lower=False)
LOWER = byte_table(BLANKS, lower=True)
#: letters, digits and everything beyond ASCII, after lower-casing
LOWER_ALNUM = byte_table([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)], lower=True)


class Words(NamedTuple):
    """Words of some texts: those of text ``i`` are ``codes[starts[i]:starts[i + 1]]``, places in ``vocab``.

    ``flat`` holds the bytes of all words in turn, word ``k`` from ``ends[k]`` to ``ends[k + 1]``.
    """

    starts: np.ndarray
    codes: np.ndarray
    vocab: pa.BinaryArray
    flat: np.ndarray
    ends: np.ndarray

    def spaced(self) -> tuple[np.ndarray, np.ndarray]:
        """All words in turn, each with a space behind it, and where each begins (and the last ends)."""
        count = self.codes.size
        out = np.full(self.flat.size + count, SPACE, np.uint8)
        out[np.arange(self.flat.size) + np.repeat(np.arange(count), np.diff(self.ends))] = self.flat
        return out, self.ends.astype(np.int64) + np.arange(count + 1)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string column; null counts as empty."""
    texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw[at[0]:at[-1]]


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that a piece holds about ``most`` bytes of text, or one text."""
    for batch in batches:
        offsets, _ = text_bytes(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
            yield batch.slice(first, min(last, batch.num_rows) - first)
            first = last


def runs(flags: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end place of each run of set flags; no run crosses an offset."""
    inner = offsets[(offsets > 0) & (offsets < flags.size)]
    first, last = flags.copy(), flags.copy()
    first[1:] &= ~flags[:-1]
    last[:-1] &= ~flags[1:]
    first[inner] = flags[inner]
    last[inner - 1] = flags[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def split_words(texts: pa.Array, table: np.ndarray) -> Words:
    offsets, data = text_bytes(texts)
    data = table[data]
    inside = data != SPACE
    first, last = runs(inside, offsets)
    ends = np.concatenate([[0], np.cumsum(last - first)]).astype(np.int32)
    flat = data[inside]
    words = pa.Array.from_buffers(pa.binary(), first.size, [None, pa.py_buffer(ends), pa.py_buffer(flat)])
    coded = words.dictionary_encode()
    return Words(np.searchsorted(first, offsets), coded.indices.to_numpy(), coded.dictionary, flat, ends)


def hash_words(vocab: pa.BinaryArray | list[str]) -> np.ndarray:
    """64-bit hash of each word."""
    words = vocab if isinstance(vocab, list) else vocab.to_pylist()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a one-to-one map."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive word hashes; empty if there are fewer words."""
    count = words.size - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(count, size, np.uint64)
    for k in range(size):
        out = mix(out) + words[k:k + count]
    return mix(out)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of several runs, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if ends.size else 0)


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
