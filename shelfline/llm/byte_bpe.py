"""Byte-level BPE over padded numpy matrices.

Texts are cut into pieces at the start of a blank that follows an ASCII character, where every match of the pattern
ends anyway; each distinct piece of a batch is matched once, and each distinct match is merged once. Matches of like
length form a matrix of token ids. In every round each row merges its leftmost pair of minimum rank: the ranks are
looked up in a hash table of pairs when a pair comes into being, and the row is moved together over the gap.
A round costs a row its width, so the merges of a match of more than ``WIDE`` bytes come from a heap by rank and place.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, types as T

from shelfline.llm.arrays import BLANKS, chunks, list_array, mix, ragged, text_bytes

NO_RANK = np.int32(2 ** 31 - 1)
MATRIX_CELLS = 2_000_000
WIDE = 512
IS_BLANK = np.isin(np.arange(256), BLANKS)
#: after these a blank starts a new piece: ASCII characters that are no white space in any reading
BEFORE_CUT = (np.arange(256) < 128) & ~IS_BLANK & ~np.isin(np.arange(256), np.arange(0x1C, 0x20))


class Vocabulary:
    """Token bytes, single-byte ids and the open-addressing table of mergeable pairs, all from the rank file."""

    def __init__(self, content: bytes):
        pairs = (line.split() for line in content.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        tokens = sorted(self.ranks.items(), key=lambda item: item[1])
        self.flat = np.frombuffer(b"".join(t for t, _ in tokens), np.uint8)
        size = tokens[-1][1] + 1
        self.lengths = np.zeros(size, np.int64)
        self.lengths[[r for _, r in tokens]] = [len(t) for t, _ in tokens]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.single = np.full(256, -1, np.int32)
        for byte in range(256):
            self.single[byte] = self.ranks.get(bytes([byte]), -1)
        if (self.single < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        left, right, rank = [], [], []
        for token, merged in tokens:
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(merged)
        self._build(self._key(np.array(left, np.int64), np.array(right, np.int64)), np.array(rank, np.int32))

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _build(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        self.mask = np.uint64((1 << max(4, int(keys.size * 3).bit_length())) - 1)
        self.empty = np.uint64(2 ** 64 - 1)
        self.keys = np.full(int(self.mask) + 1, self.empty, np.uint64)
        self.values = np.full(int(self.mask) + 1, NO_RANK, np.int32)
        slots, waiting = mix(keys) & self.mask, np.arange(keys.size)
        while waiting.size:
            free = waiting[self.keys[slots[waiting]] == self.empty]
            self.keys[slots[free]] = keys[free]  # of several keys for one slot the last stays
            held = self.keys[slots[waiting]] == keys[waiting]
            self.values[slots[waiting[held]]] = ranks[waiting[held]]
            waiting = waiting[~held]
            slots[waiting] = (slots[waiting] + np.uint64(1)) & self.mask

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_RANK where it merges to nothing or one side is padding (-1)."""
        out = np.full(left.shape, NO_RANK, np.int32)
        real = (left >= 0) & (right >= 0)
        keys = self._key(left[real], right[real])
        slots, found = mix(keys) & self.mask, np.full(keys.size, NO_RANK, np.int32)
        open_ = np.arange(keys.size)
        while open_.size:
            held = self.keys[slots[open_]]
            hit = held == keys[open_]
            found[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (held != self.empty)]
            slots[open_] = (slots[open_] + np.uint64(1)) & self.mask
        out[real] = found
        return out

    def merge_rows(self, ids: np.ndarray) -> np.ndarray:
        """Merge every row of a padded matrix to its end; returns the matrix padded with -1."""
        ids = ids.copy()
        done = np.full_like(ids, -1)
        row = np.arange(len(ids))
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        while row.size:
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(row.size, np.int64)
            best = ranks[np.arange(row.size), at] if ranks.shape[1] else np.full(row.size, NO_RANK)
            ended = best == NO_RANK
            done[row[ended], :ids.shape[1]] = ids[ended]
            go = ~ended
            row, ids, ranks, at, best = row[go], ids[go], ranks[go], at[go], best[go]
            if not row.size:
                break
            own = np.arange(row.size)
            beyond = np.arange(ids.shape[1] - 1)[None, :] > at[:, None]
            ids = np.where(beyond, ids[:, 1:], ids[:, :-1])
            ids[own, at] = best
            ranks = np.where(beyond[:, :-1], ranks[:, 1:], ranks[:, :-1])
            right = at < ranks.shape[1]
            ranks[own[right], at[right]] = self.pair_ranks(ids[own[right], at[right]], ids[own[right], at[right] + 1])
            left = at > 0
            ranks[own[left], at[left] - 1] = self.pair_ranks(ids[own[left], at[left] - 1], ids[own[left], at[left]])
        return done

    def merge_long(self, match: bytes) -> np.ndarray:
        """Ids of one long match: the same merges in the same order, the next one from a heap.

        Parts are known by their first byte; an entry of the heap is void once its pair has another rank, as a pair only
        grows. Time is n log n, and memory some 70 bytes for each byte of the match.
        """
        size, none, rank_of = len(match), int(NO_RANK), self.ranks.get
        after, before = array("q", range(1, size + 1)), array("q", range(-1, size - 1))
        now = array("q", (rank_of(match[k:k + 2], none) for k in range(size - 1)))
        now.append(none)
        heap = [rank << 40 | k for k, rank in enumerate(now) if rank != none]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            at = entry & (1 << 40) - 1
            if now[at] != entry >> 40:
                continue
            gone = after[at]
            now[gone] = none
            after[at] = after[gone]
            if after[at] < size:
                before[after[at]] = at
            for place in (at, before[at]):
                if place >= 0 and after[place] < size:
                    now[place] = rank_of(match[place:after[after[place]]], none)
                    if now[place] != none:
                        heappush(heap, now[place] << 40 | place)
                elif place >= 0:
                    now[place] = none
        ids, at = array("i"), 0
        while at < size:
            ids.append(self.ranks[match[at:after[at]]])
            at = after[at]
        return np.array(ids, np.int32)

    def encode_matches(self, matches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the matches and the number of ids of each."""
        whole = np.fromiter((self.ranks.get(m, -1) for m in matches), np.int64, len(matches))
        sizes = np.fromiter(map(len, matches), np.int64, len(matches))
        counts = np.where(whole >= 0, 1, 0)
        todo = np.flatnonzero(whole < 0)
        parts: list[tuple[np.ndarray, np.ndarray]] = [(np.flatnonzero(whole >= 0), whole[whole >= 0].astype(np.int32)[:, None])]
        flat = np.frombuffer(b"".join(matches), np.uint8)
        begins = np.cumsum(sizes) - sizes
        for k in todo[sizes[todo] > WIDE]:
            ids = self.merge_long(matches[k])
            counts[k] = ids.size
            parts.append((np.array([k]), ids[None, :]))
        todo = todo[sizes[todo] <= WIDE]
        width = 2
        while todo.size:
            fits = todo[sizes[todo] <= width]
            todo = todo[sizes[todo] > width]
            step = max(1, MATRIX_CELLS // width)
            for k in range(0, fits.size, step):
                some = fits[k:k + step]
                cells = begins[some][:, None] + np.arange(width)[None, :]
                inside = np.arange(width)[None, :] < sizes[some][:, None]
                ids = np.where(inside, self.single[flat[np.minimum(cells, flat.size - 1)]], -1).astype(np.int32)
                merged = self.merge_rows(ids)
                counts[some] = (merged >= 0).sum(axis=1)
                parts.append((some, merged[:, :max(1, int(counts[some].max()))]))
            width *= 2
        ends = np.cumsum(counts)
        out = np.zeros(ends[-1] if ends.size else 0, np.int32)
        for some, ids in parts:
            real = ids >= 0
            places = (ends[some] - counts[some])[:, None] + np.arange(ids.shape[1])[None, :]
            out[places[real]] = ids[real]
        return out, counts


@lru_cache(maxsize=2)
def _vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def cut_pieces(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Pieces of the texts, dictionary-coded, and where those of each text start."""
    offsets, data = text_bytes(texts)
    starts = np.zeros(data.size, bool)
    starts[1:] = IS_BLANK[data[1:]] & BEFORE_CUT[data[:-1]]
    starts[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    first = np.flatnonzero(starts)
    ends = np.append(first, data.size).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), first.size, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    return np.searchsorted(first, offsets), pieces.dictionary_encode()


def encode_texts(texts: pa.Array, vocabulary: Vocabulary, pattern: regex.Pattern) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of all texts and the offsets of each text in them."""
    starts, pieces = cut_pieces(texts)
    known: dict[str, int] = {}
    codes, per_piece = [], []
    for piece in pieces.dictionary.to_pylist():
        found = pattern.findall(piece.decode("utf-8", "replace"))
        codes.extend([known.setdefault(m, len(known)) for m in found])
        per_piece.append(len(found))
    flat, counts = vocabulary.encode_matches([m.encode() for m in known])
    match_starts = np.cumsum(counts) - counts
    codes_, per_piece_ = np.array(codes, np.int64), np.array(per_piece, np.int64)
    piece_ids = flat[ragged(match_starts[codes_], counts[codes_])] if codes_.size else np.zeros(0, np.int32)
    match_piece = np.repeat(np.arange(per_piece_.size), per_piece_)
    piece_counts = np.bincount(match_piece, counts[codes_], per_piece_.size).astype(np.int64) if codes_.size else np.zeros(per_piece_.size, np.int64)
    piece_starts = np.cumsum(piece_counts) - piece_counts
    order = pieces.indices.to_numpy()
    ids = piece_ids[ragged(piece_starts[order], piece_counts[order])] if order.size else np.zeros(0, np.int32)
    ends = np.concatenate([[0], np.cumsum(piece_counts[order])])
    return ids, ends[starts]


def _with_column(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def _appended(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    kept = [c for c in batch.schema.names if c != name]
    return pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [column], kept + [name])


def encode(docs: DataFrame, vocabulary_path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text`` as array<int>; a column named ``out`` is replaced.

    Each match of ``pattern`` is encoded on its own, as a single token if it is one, else by merges of least rank,
    leftmost first. Null and empty texts give an empty array. No row is moved: the plan has no shuffle. The rank
    file (about 1 MB) is read on the driver and sent to the executors with the code that uses it.
    """
    with open(vocabulary_path, "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, matcher = _vocabulary(content.value), regex.compile(pattern)
        for batch in chunks(batches, text):
            ids, offsets = encode_texts(batch.column(text), vocabulary, matcher)
            yield _appended(batch, out, list_array(ids, offsets, pa.int32()))

    return docs.mapInArrow(run, _with_column(docs, out, T.ArrayType(T.IntegerType())))


def decode(encoded: DataFrame, vocabulary_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its ids; null ids give no bytes. An id outside the vocabulary is an error."""
    with open(vocabulary_path, "rb") as file:
        content = encoded.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(content.value)
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                some = batch.slice(k, 1000)
                column = some.column(ids)
                tokens = column.flatten().to_numpy(zero_copy_only=False)
                counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
                sizes = vocabulary.lengths[tokens]
                data = vocabulary.flat[ragged(vocabulary.starts[tokens], sizes)]
                at = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
                decoded = pa.Array.from_buffers(pa.binary(), some.num_rows, [None, pa.py_buffer(at), pa.py_buffer(data)])
                yield _appended(some, out, decoded)

    return encoded.mapInArrow(run, _with_column(encoded, out, T.BinaryType()))
