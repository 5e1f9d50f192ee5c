"""Exact removal of repeated word windows by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document. Its minimiser is the smallest hash of the ``MINI``-word
pieces in it, so equal windows have equal minimisers wherever they stand. Consecutive windows that share a minimiser
travel as one packed string to the bucket of that minimiser, where sorting brings equal windows together. Pieces
that are common in the corpus come last in the order of minimisers, so a common line does not draw a large part of
all windows to one bucket; windows that repeat inside a batch are settled there and do not travel at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfline.llm.arrays import KEEP_CASE, Words, chunks, hash_words, list_array, mix, ragged, shingle_hashes, split_words
from shelfline.plans.sizing import plan_bytes
from shelfline.plans.staging import Stage, WrittenTables

WINDOW, MINI = 20, 4
#: a piece with more than this share of all pieces is common; so there are at most as many common pieces
COMMON = 50_000
BUCKET_BYTES = 16_000_000
#: packed strings take about three times their text, and Parquet files about half of it
GROWTH = 6
NEWLINE = 10
MOVED = "bucket int, blob binary, doc_id long, row int, runs array<int>"
MARKS = "doc_id long, row int, runs array<int>"


def repeats(hashes: np.ndarray, codes: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Which of the windows that begin at ``codes[at]`` equal an earlier one, by sorting; ``at`` ascends.

    Equal hashes are only a hint: windows are compared word by word with the first of their hash.
    """
    out = np.zeros(at.size, bool)
    order = np.argsort(hashes, kind="stable")
    in_order = hashes[order]
    new = np.concatenate([[True], in_order[1:] != in_order[:-1]]) if order.size else np.zeros(0, bool)
    first = order[np.maximum.accumulate(np.where(new, np.arange(order.size), 0))]
    later, ref = order[~new], first[~new]
    odd: list[int] = []
    for k in range(0, later.size, 200_000):
        a, b = later[k:k + 200_000], ref[k:k + 200_000]
        same = np.ones(a.size, bool)
        for j in range(window):
            same &= codes[at[a] + j] == codes[at[b] + j]
        out[a[same]] = True
        odd.extend(b[~same])
    for reference in set(odd):  # different windows with one hash: told apart by their words
        seen = set()
        for place in np.sort(np.flatnonzero(hashes == hashes[reference])):
            words = codes[at[place]:at[place] + window].tobytes()
            out[place] = words in seen
            seen.add(words)
    return out


def _windows(starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of every window, and the text it is in, for texts whose words start at ``starts``."""
    counts = np.maximum(0, np.diff(starts) - window + 1)
    return ragged(starts[:-1], counts), np.repeat(np.arange(counts.size), counts)


def _pieces(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and piece hashes at every place; pieces across a text's end are never part of a window."""
    hashes = hash_words(words.vocab)[words.codes]
    return hashes, shingle_hashes(hashes, MINI)


def _ranks(pieces: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Order of minimisers: rare pieces by hash, then common ones."""
    ranks = pieces >> np.uint64(1)
    if common.size:
        found = common[np.minimum(np.searchsorted(common, pieces), common.size - 1)] == pieces
        ranks[found] |= np.uint64(1 << 63)
    return ranks


def _minimisers(ranks: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    """Smallest of the ``span`` ranks from each place on."""
    width, best = 1, ranks
    while 2 * width <= span:
        best = np.minimum(best[:best.size - width], best[width:])
        width *= 2
    return np.minimum(best[at], best[at + span - width])


def _count_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces that may be common, with their counts, and under a null key the number of all pieces."""
    for batch in chunks(batches):
        words = split_words(batch.column("text"), KEEP_CASE)
        _, pieces = _pieces(words)
        at, _ = _windows(words.starts, MINI)
        keys, counts = np.unique(pieces[at], return_counts=True) if at.size else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        may = counts * 2 * COMMON >= max(at.size, 16 * COMMON)
        yield pa.RecordBatch.from_arrays([
            pa.array([None, *keys[may].view(np.int64).tolist()], pa.int64()),
            pa.array([at.size, *counts[may].tolist()], pa.int64())], ["piece", "n"])


def common_pieces(docs: DataFrame, stage: Stage) -> np.ndarray:
    """Hashes of pieces that hold more than 1 / COMMON of all pieces: at most COMMON of them."""
    counts = stage(docs.select("text").mapInArrow(_count_pieces, "piece long, n long")
                   .groupBy("piece").agg(F.sum("n").alias("n")), "piece_counts")
    total = counts.where("piece is null").agg(F.max("n")).first()[0] or 0
    rows = counts.where(F.col("piece").isNotNull() & (F.col("n") * COMMON > total)).select("piece").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def _marks(docs: np.ndarray, rows: np.ndarray, owner: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Windows to remove as runs of consecutive starts [first, last, ...] for each document; owners ascend."""
    new_owner = np.concatenate([[True], owner[1:] != owner[:-1]]) if owner.size else np.zeros(0, bool)
    new_run = new_owner.copy()
    new_run[1:] |= starts[1:] != starts[:-1] + 1
    firsts = np.flatnonzero(new_run)
    lasts = np.append(firsts[1:], starts.size) - 1 if firsts.size else firsts
    runs = np.stack([starts[firsts], starts[lasts]], axis=1).reshape(-1)
    at = np.flatnonzero(new_owner[firsts])
    own = owner[firsts[at]]
    return (pa.array(docs[own], pa.int64()), pa.array(rows[own], pa.int32()),
            list_array(runs, np.append(at, firsts.size) * 2, pa.int32()))


def _pack(common: np.ndarray, buckets: int, window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [x.split()[0] for x in MOVED.split(", ")]

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in chunks(batches):
            batch = batch.take(pc.sort_indices(pa.table([batch.column("doc_id"), batch.column("row")], ["a", "b"]),
                                                       [("a", "ascending"), ("b", "ascending")]))
            docs, rows = (batch.column(c).to_numpy() for c in ("doc_id", "row"))
            words = split_words(batch.column("text"), KEEP_CASE)
            at, owner = _windows(words.starts, window)
            if not at.size:
                continue
            hashes, pieces = _pieces(words)
            mini = _minimisers(_ranks(pieces, common), at, window - MINI + 1)
            # repeated rows are one document: a window at the same place of the same document is no earlier one
            again = repeats(shingle_hashes(hashes, window)[at], words.codes, at, window)
            start = at - words.starts[owner]
            twin = np.concatenate([[False], (docs[1:] == docs[:-1]) & (rows[1:] == rows[:-1])])
            if twin.any():
                again &= ~twin[owner]
            if again.any():
                ids, row, runs = _marks(docs, rows, owner[again], start[again])
                n = len(ids)
                bucket = pa.array((mix(ids.to_numpy().view(np.uint64)) % np.uint64(buckets)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([bucket, pa.nulls(n, pa.binary()), ids, row, runs], names)
            go = ~again & ~twin[owner]
            at, owner, start, mini = at[go], owner[go], start[go], mini[go]
            if not at.size:
                continue
            new = np.concatenate([[True], (mini[1:] != mini[:-1]) | (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])])
            first = np.flatnonzero(new)
            last = np.append(first[1:], at.size) - 1
            bucket = (mix(mini[first]) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            text, begins = words.spaced()
            text = memoryview(text)
            cuts = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1]]))
            left, right = begins[at[first]], begins[at[last] + window] - 1
            keys, blobs = [], []
            for some in np.split(order, cuts[1:]):
                head = np.concatenate([docs[owner[first[some]]].astype("<i8").view(np.uint8),
                                       rows[owner[first[some]]].astype("<i4").view(np.uint8),
                                       start[first[some]].astype("<i4").view(np.uint8)]).tobytes()
                body = b"\n".join([text[a:b] for a, b in zip(left[some].tolist(), right[some].tolist(), strict=True)])
                keys.append(int(bucket[some[0]]))
                blobs.append(squeeze.compress(len(some).to_bytes(4, "little") + head + body))
            n = len(keys)
            empty = pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary()), *empty], names)
    return run


def _count(window: int) -> Callable[[pa.Table], pa.Table]:
    """Windows of one bucket, sorted: all but the first of equal ones are marked."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        passed = table.filter(table["runs"].is_valid()).select(["doc_id", "row", "runs"])
        heads, bodies = ([], [], []), []
        unpack = zstandard.ZstdDecompressor()
        for blob in table["blob"].drop_null().to_pylist():
            raw = unpack.decompress(blob)
            n = int.from_bytes(raw[:4], "little")
            for k, (kind, begin, width) in enumerate((("<i8", 4, 8), ("<i4", 4 + 8 * n, 4), ("<i4", 4 + 12 * n, 4))):
                heads[k].append(np.frombuffer(raw, kind, n, begin))
            bodies.extend(raw[4 + 16 * n:].split(b"\n"))
        if not bodies:
            return passed
        docs, rows, starts = map(np.concatenate, heads)
        order = np.lexsort((starts, rows, docs))
        docs, rows, starts = docs[order], rows[order], starts[order]
        strings = pa.array([bodies[k] for k in order.tolist()], pa.binary())
        words = split_words(strings.cast(pa.string(), safe=False), KEEP_CASE)
        at, owner = _windows(words.starts, window)
        hashes = shingle_hashes(hash_words(words.vocab)[words.codes], window)[at]
        start = starts[owner] + at - words.starts[owner]
        again = repeats(hashes, words.codes, at, window)
        if again.any():  # the same window of the same document, sent twice for a repeated row, is no earlier one
            again &= ~_same_place(hashes, docs[owner], rows[owner], start)
        found = _marks(docs, rows, _document(docs, rows)[owner[again]], start[again])
        own = pa.table(found, ["doc_id", "row", "runs"])
        return pa.concat_tables([passed.cast(own.schema), own])
    return run


def _document(docs: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each string the first string of the same document; strings are in order of documents."""
    new = np.concatenate([[True], (docs[1:] != docs[:-1]) | (rows[1:] != rows[:-1])])
    return np.maximum.accumulate(np.where(new, np.arange(docs.size), 0))


def _same_place(hashes: np.ndarray, docs: np.ndarray, rows: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Windows whose hash first stands at this very place, of a row that came twice."""
    order = np.argsort(hashes, kind="stable")
    new = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])
    first = order[np.maximum.accumulate(np.where(new, np.arange(order.size), 0))]
    out = np.zeros(hashes.size, bool)
    out[order] = ~new & (docs[order] == docs[first]) & (rows[order] == rows[first]) & (start[order] == start[first])
    return out


def _keep(window: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in chunks(batches):
            words = split_words(batch.column("text"), KEEP_CASE)
            change = np.zeros(words.codes.size + 1, np.int64)
            runs = batch.column("runs")
            counts = pc.fill_null(pc.list_value_length(runs), 0).to_numpy() // 2
            flat = runs.flatten().to_numpy().reshape(-1, 2) + np.repeat(words.starts[:-1], counts)[:, None]
            np.add.at(change, flat[:, 0], 1)
            np.add.at(change, flat[:, 1] + window, -1)
            kept = np.cumsum(change[:-1]) == 0
            text, begins = words.spaced()
            mask = np.repeat(kept, np.diff(begins))
            total = np.concatenate([[0], np.cumsum(kept)])
            n_kept = np.diff(total[words.starts])
            places = np.flatnonzero(kept)
            mask[begins[places[total[words.starts[1:]][n_kept > 0] - 1] + 1] - 1] = False  # no space at the end
            ends = np.concatenate([[0], np.cumsum(mask)])[begins[words.starts]].astype(np.int32)
            column = pa.Array.from_buffers(pa.string(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(text[mask])])
            n_words = np.diff(words.starts)
            made = {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_words - n_kept, pa.int64()), "kept_text": column}
            yield pa.RecordBatch.from_arrays([made.get(n) if n in made else batch.column(n) for n in names], names)
    return run


def _buckets(spark: SparkSession, docs: DataFrame) -> int:
    """Enough buckets that the packed strings of one fit in a task, by the size of the table."""
    return max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), plan_bytes(docs) * GROWTH // BUCKET_BYTES)


def remove_repeats(docs: DataFrame, window: int = WINDOW, stage: Stage | None = None) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text for each row of ``docs`` (doc_id, text; other columns are ignored).

    Words are cut at ASCII blanks. A word goes if any window of ``window`` words that covers it also starts earlier:
    in a smaller doc_id, or before in the same document. Kept words are joined by one space. Null and empty texts
    have no words and an empty kept_text. Of rows with one doc_id, those with the same text are one document (no
    repeats of each other); different texts are ordered by a hash of the text. A null doc_id comes before all others.
    """
    stage = stage or WrittenTables(docs.sparkSession)
    lowest = F.lit(-2 ** 63)
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), lowest).alias("doc_id"),
                       F.hash(F.col("text").cast("string")).alias("row"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    buckets = _buckets(docs.sparkSession, docs)
    moved = base.mapInArrow(_pack(common_pieces(base, stage), buckets, window), MOVED)
    marks = stage(moved.groupBy("bucket").applyInArrow(_count(window), MARKS), "marks")
    by_doc = marks.groupBy("doc_id", "row").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    marked = base.join(by_doc, ["doc_id", "row"], "left").select("doc_id", "text", "runs")
    names = ["doc_id", "n_words", "n_removed", "kept_text"]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    out = marked.mapInArrow(_keep(window, names), schema)
    return out.withColumn("doc_id", F.nullif("doc_id", lowest))
