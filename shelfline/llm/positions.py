"""Distributed positional inverted index, and exact phrase and proximity search in it.

The index is cut by documents: a segment holds all postings of some documents, sorted by term, so every match of a
document is found inside one segment and nothing is shuffled. A phrase is found by intersecting the position lists of
its terms, each moved by the term's offset, from the rarest list on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from shelfline.llm.arrays import LOWER_ALNUM, chunks, list_array, split_words
from shelfline.plans.staging import Stage, WrittenTables

SEGMENT_BYTES = 4_000_000
BLOCK_BYTES = 8_000_000
INDEX = "docs array<long>, starts array<int>, terms array<binary>, ends array<int>, positions binary"
FOUND = "segment long, place int, doc_id long, n_words long, items array<string>, spans array<int>"


def _segments(table: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in chunks(batches, most=SEGMENT_BYTES):
            words = split_words(batch.column("text"), table)
            positions = np.argsort(words.codes, kind="stable").astype("<i4")
            ends = np.concatenate([[0], np.cumsum(np.bincount(words.codes, minlength=len(words.vocab)))])
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            yield pa.RecordBatch.from_arrays([
                one(batch.column("doc_id")), one(pa.array(words.starts, pa.int32())), one(words.vocab),
                one(pa.array(ends, pa.int32())), pa.array([squeeze.compress(positions.tobytes())], pa.binary()),
            ], ["docs", "starts", "terms", "ends", "positions"])
    return run


def build_index(docs: DataFrame, table: np.ndarray = LOWER_ALNUM, stage: Stage | None = None) -> DataFrame:
    """Written index of the whole texts of ``docs`` (doc_id, text): one row per segment, in one pass, without shuffle.

    Words are the runs of bytes that ``table`` does not turn into a blank. Null and empty texts have no postings
    but stay in their segment, so searches return a row for them too.
    """
    stage = stage or WrittenTables(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    index = rows.mapInArrow(_segments(table), INDEX)
    return stage(index.withColumn("segment", F.monotonically_increasing_id()), "positions")


class Segment:
    """Postings of one row of the index."""

    def __init__(self, row: dict):
        self.docs, self.starts, self.terms = row["docs"].values, row["starts"].values.to_numpy(), row["terms"].values
        self.ends = row["ends"].values.to_numpy()
        self.positions = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["positions"].as_py()), "<i4")
        self.n_words = np.diff(self.starts)

    def codes(self, terms: pa.Array) -> np.ndarray:
        """Place of each term in this segment, -1 if it is absent."""
        return pc.fill_null(pc.index_in(terms, value_set=self.terms), -1).to_numpy()

    def postings(self, code: int) -> np.ndarray:
        return self.positions[self.ends[code]:self.ends[code + 1]]

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1

    def phrase(self, codes: np.ndarray) -> np.ndarray:
        """First positions of the terms in a row in one document: lists are intersected from the shortest on."""
        order = np.argsort(self.ends[codes + 1] - self.ends[codes], kind="stable")
        at = self.postings(codes[order[0]]) - order[0]
        for k in order[1:]:
            own = self.postings(codes[k])
            found = np.searchsorted(own, at + k)
            at = at[own[np.minimum(found, own.size - 1)] == at + k]
            if not at.size:
                return at
        at = at[at >= 0]
        return at[self.doc_of(at) == self.doc_of(at + codes.size - 1)]

    def near(self, codes: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """Spans of at most ``within`` words of one document that hold all terms: from each place where one stands, the
        shortest. Only places near the rarest term are looked at."""
        lists = sorted((self.postings(c) for c in codes), key=len)
        rare, places = lists[0], np.unique(np.concatenate(lists))
        nearest = np.searchsorted(rare, places)
        places = places[(nearest < rare.size) & (rare[np.minimum(nearest, rare.size - 1)] < places + within)]
        last = places.copy()
        for own in lists:
            found = np.searchsorted(own, places)
            here = np.where(found < own.size, own[np.minimum(found, own.size - 1)], np.iinfo(np.int32).max)
            last = np.maximum(last, here)
        good = last.astype(np.int64) < places.astype(np.int64) + within
        places, last = places[good], last[good]
        same = self.doc_of(places) == self.doc_of(last)
        return places[same], last[same]


class Phrases:
    """Windows of the items of one block, as places in the list of their distinct terms."""

    def __init__(self, rows: list[tuple[str, str]], window: int, table: np.ndarray):
        words = split_words(pa.array([t for _, t in rows], pa.string()), table)
        self.items, self.terms = [i for i, _ in rows], words.vocab
        found = {}
        for item, (first, last) in enumerate(zip(words.starts[:-1], words.starts[1:], strict=True)):
            size = min(window, last - first)
            for k in range(first, last - size + 1 if size else first):
                found.setdefault(tuple(words.codes[k:k + size].tolist()), set()).add(item)
        self.windows = [(np.array(w, np.int64), sorted(own)) for w, own in found.items()]
        self.width = max((w.size for w, _ in self.windows), default=1)
        self.matrix = np.full((len(self.windows), self.width), -1, np.int64)
        for k, (w, _) in enumerate(self.windows):
            self.matrix[k, :w.size] = w

    def search(self, segment: Segment) -> tuple[np.ndarray, list[set[int]]]:
        """For every word of the segment whether a window covers it; for every document the items found."""
        cover = np.zeros(segment.starts[-1] + 1, np.int64)
        items: list[set[int]] = [set() for _ in range(len(segment.docs))]
        codes = np.append(segment.codes(self.terms), 0)  # the last place is padding and always there
        for k in np.flatnonzero((codes[self.matrix] >= 0).all(axis=1)):
            window, own = self.windows[k]
            at = segment.phrase(codes[window])
            if at.size:
                np.add.at(cover, at, 1)
                np.add.at(cover, at + window.size, -1)
                for doc in np.unique(segment.doc_of(at)).tolist():
                    items[doc].update(own)
        return np.cumsum(cover[:-1]) > 0, items


def _search(phrases: Phrases) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k] for name in batch.schema.names}
                segment = Segment(row)
                hit, items = phrases.search(segment)
                edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
                inner = segment.starts[(segment.starts > 0) & (segment.starts < hit.size)]
                split = inner[hit[inner] & hit[inner - 1]] if inner.size else inner  # a run does not cross documents
                first = np.sort(np.concatenate([np.flatnonzero(edge == 1), split]))
                last = np.sort(np.concatenate([np.flatnonzero(edge == -1), split]))
                owner = segment.doc_of(first)
                runs = (np.stack([first, last], axis=1) - segment.starts[owner][:, None]).reshape(-1)
                n = len(segment.docs)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["segment"].as_py()] * n, pa.int64()), pa.array(np.arange(n), pa.int32()), segment.docs,
                    pa.array(segment.n_words, pa.int64()),
                    pa.array([sorted({phrases.items[i] for i in own}) for own in items], pa.list_(pa.string())),
                    list_array(runs, np.searchsorted(owner, np.arange(n + 1)) * 2, pa.int32()),
                ], ["segment", "place", "doc_id", "n_words", "items", "spans"])
    return run


def _merge_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping spans of a document, found in several blocks of items, as one."""
    for batch in batches:
        merged = []
        for spans in batch.column("spans").to_pylist():
            out: list[int] = []
            for first, last in sorted(zip(spans[::2], spans[1::2], strict=True)):
                if out and first <= out[-1]:
                    out[-1] = max(out[-1], last)
                else:
                    out += [first, last]
            merged.append(out)
        at = batch.schema.names.index("spans")
        yield batch.set_column(at, "spans", pa.array(merged, pa.list_(pa.int32())))


def phrase_matches(index: DataFrame, items: DataFrame, window: int = 10, table: np.ndarray = LOWER_ALNUM,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, items (sorted distinct item_ids as text) and spans for every document of the index.

    A window is ``window`` consecutive words of an item (item_id, text); an item of fewer words, but not none, is one
    window. ``spans`` are the covered words as [first, past the last, ...]. The items are taken in blocks of about
    ``block_bytes`` of text, dealt by a hash; a block is sent to all tasks, and each block reads the index once.
    Items without an item_id or without words match nothing. ``item_id`` values that repeat are one item.
    """
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where(
        "item_id is not null and text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // block_bytes + 1
    found = None
    for k in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        phrases = Phrases([tuple(r) for r in own.collect()], window, table)
        part = index.mapInArrow(_search(phrases), FOUND)
        found = part if found is None else found.union(part)
    if blocks > 1:
        found = (found.groupBy("segment", "place").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.flatten(F.collect_list("spans")).alias("spans")).mapInArrow(_merge_spans, FOUND))
    return found.select("doc_id", "n_words", "items", "spans")


def proximity_matches(index: DataFrame, words: list[str], within: int, table: np.ndarray = LOWER_ALNUM) -> DataFrame:
    """doc_id, first and last word of each span of at most ``within`` words that holds all ``words``, in any order.

    From every place where one of the words stands, the shortest span that begins there. No words match nothing.
    """
    terms = split_words(pa.array([" ".join(words)]), table).vocab

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                segment = Segment({name: batch.column(name)[k] for name in batch.schema.names})
                codes = segment.codes(terms)
                if not codes.size or (codes < 0).any():
                    continue
                first, last = segment.near(codes, within)
                doc = segment.doc_of(first)
                yield pa.RecordBatch.from_arrays([
                    segment.docs.take(pa.array(doc)), pa.array(first - segment.starts[doc], pa.int32()),
                    pa.array(last - segment.starts[doc], pa.int32())], ["doc_id", "first", "last"])
    return index.mapInArrow(run, "doc_id long, first int, last int")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, stage: Stage | None = None) -> DataFrame:
    """``phrase_matches`` of the index of ``docs``, with n_hit (covered words), n_items and contaminated."""
    found = phrase_matches(build_index(docs, stage=stage), items, window)
    # spans alternate first and end, so the covered words are the ends less the firsts
    signed = F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    n_hit = F.aggregate(signed, F.lit(0).cast("long"), lambda total, x: total + x)
    return found.withColumns({"n_hit": n_hit, "n_items": F.size("items").cast("long"), "contaminated": F.size("items") > 0})
