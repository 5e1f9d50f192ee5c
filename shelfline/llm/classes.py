"""Language-model scores from Brown classes: exchange clustering of words, class transitions and word emissions.

Texts are cut into words twice: to count them, and to write each text as the places of its words in the list of frequent words,
with the hashes of its other words beside them. All else reads these codes. The ``WORDS`` most frequent words and ``ENDINGS``
groups of all others, by their ending, are clustered word by word on the driver; that gives every word a class to begin with.
Then the frequent words are exchanged by the classes of their neighbours, a share of them at a time, so that a share sees where the
others have gone; a share's moves stand only if they make the corpus likelier. Last, every other word of the vocabulary, however
rare, moves to the class that its own neighbours make likeliest, under the same condition. Only the frequent words, of
which there are fewer than ``FREQUENT``, and tables of classes are gathered; the number of classes grows with the vocabulary. The probability of a text
is the product of class transitions and of emissions P(word | class), with the end of the text as a token of its own that also
stands before the first word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from shelfline.llm.arrays import LOWER, Words, chunks, hash_words, list_array, split_words
from shelfline.llm.groups import whole
from shelfline.plans.staging import Stage, WrittenTables

WORDS, ENDINGS, ROUNDS = 384, 128, 6
UNITS = WORDS + ENDINGS
#: sweeps over the frequent words at most, and shares of them that move together
SWEEPS, SHARES = 2, 2
#: words with more than this share of all tokens are sent to all tasks; so there are fewer of them
FREQUENT = 3_000_000
#: counts held by a task before they are joined, and tokens handled at a time
HELD, PIECE = 16_000_000, 4_000_000
#: no word holds a line break, so the end of a text has a key that no word has
END = int(hash_words(["\n"]).view(np.int64)[0])
BACKOFF = 10.0

Batches = Iterator[pa.RecordBatch]


def class_count(words: int) -> int:
    """Classes for a vocabulary: its 0.3rd power, between 16 and 255, which a byte holds."""
    return min(255, max(16, round(words ** 0.3)))


def _endings(words: Words) -> np.ndarray:
    """Ending group of each word of the vocabulary, by its last two bytes."""
    vocab = words.vocab.to_pylist()
    ends = np.cumsum(np.fromiter(map(len, vocab), np.int64, len(vocab)))
    flat = np.frombuffer(b"".join(vocab), np.uint8).astype(np.int64)
    if not ends.size:
        return ends
    starts = np.concatenate([[0], ends[:-1]])
    return (flat[ends - 1] * 31 + flat[np.maximum(ends - 2, starts)] * 7) % ENDINGS


def _count(batches: Batches) -> Batches:
    """Tokens of the texts to learn from: key, ending group and count."""
    for batch in chunks(batches, most=32_000_000):
        words = split_words(batch.column("text"), LOWER)
        keys, n = hash_words(words.vocab).view(np.int64), np.bincount(words.codes, minlength=len(words.vocab))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.append(keys, END)), pa.array(np.append(_endings(words), 0).astype(np.int16)), pa.array(np.append(n, batch.num_rows))], ["h", "e", "n"])


def _find(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Place of each key in sorted keys, -1 if it is not among them."""
    at = np.minimum(np.searchsorted(keys, asked), keys.size - 1)
    return np.where(keys[at] == asked, at, -1)


def _packed(values: np.ndarray, offsets: np.ndarray) -> pa.BinaryArray:
    """Runs of numbers as binary values."""
    ends = (offsets * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), offsets.size - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(column: pa.BinaryArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and numbers of a column of ``_packed``."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    size = np.dtype(kind).itemsize
    if data is None or at[-1] == at[0]:
        return (at - at[0]) // size, np.zeros(0, kind)
    return (at - at[0]) // size, np.frombuffer(data, kind, (at[-1] - at[0]) // size, at[0])


CODED = "train boolean, at long, codes binary, rare binary, ends binary"


def _code(keys: np.ndarray, names: list[str]) -> Callable[[Batches], Batches]:
    """Each text as ``codes`` (int32): the place of a frequent word among ``keys``, or their number and the place in the row's own ``rare``
    words (int64 keys, with their ending groups in ``ends``). The end of the text comes last."""
    def run(batches):
        for batch in chunks(batches):
            words = split_words(batch.column("text"), LOWER)
            vocab = np.append(hash_words(words.vocab).view(np.int64), END)
            ends = np.append(_endings(words), 0).astype(np.uint8)
            offsets = words.starts + np.arange(words.starts.size)
            at = np.insert(words.codes.astype(np.int64), words.starts[1:], vocab.size - 1)
            codes = _find(keys, vocab)[at]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            rare = np.flatnonzero(codes < 0)
            pair, place = np.unique(owner[rare] * vocab.size + at[rare], return_inverse=True)
            first = np.searchsorted(pair, np.arange(batch.num_rows + 1) * vocab.size)
            codes[rare] = keys.size + place - first[owner[rare]]
            made = {"codes": _packed(codes.astype(np.int32), offsets), "rare": _packed(vocab[pair % vocab.size], first),
                    "ends": _packed(ends[pair % vocab.size], first)}
            yield pa.RecordBatch.from_arrays([made[x] if x in made else batch.column(x) for x in names], names)
    return run


class Piece(NamedTuple):
    """Some rows of coded texts: tokens as places among the frequent words and then among ``rare``, by ``offsets`` and ``firsts``."""

    rows: pa.RecordBatch
    codes: np.ndarray
    offsets: np.ndarray
    rare: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray


def _pieces(batches: Batches, words: int) -> Iterator[Piece]:
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("codes")).to_numpy().astype(np.int64) // 4)
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + PIECE, side="right")))
            rows = batch.slice(first, last - first)
            first = last
            offsets, codes = _unpacked(rows.column("codes"), np.int32)
            firsts, rare = _unpacked(rows.column("rare"), np.int64)
            codes = codes.astype(np.int64)
            beyond = codes >= words
            codes[beyond] += np.repeat(firsts[:-1], np.diff(offsets))[beyond]
            yield Piece(rows, codes, offsets, rare, _unpacked(rows.column("ends"), np.uint8)[1], firsts)


class Classes(NamedTuple):
    """Classes of the frequent words, and those of all others by their ending."""

    frequent: np.ndarray
    endings: np.ndarray

    def of(self, piece: Piece) -> np.ndarray:
        return np.concatenate([self.frequent, self.endings[piece.ends]])[piece.codes]


def _cells(own: np.ndarray, table: np.ndarray, size: int) -> None:
    table += np.bincount(np.roll(own, 1) * size + own, minlength=table.size)  # each text follows an end


def _told(table: np.ndarray) -> pa.RecordBatch:
    cells = np.flatnonzero(table)
    return pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(table[cells])], ["cell", "n"])


def _coded_pairs(classes: Classes, size: int) -> Callable[[Batches], Batches]:
    def run(batches):
        table = np.zeros(size * size, np.int64)
        for piece in _pieces(batches, classes.frequent.size):
            _cells(classes.of(piece).astype(np.int64), table, size)
        yield _told(table)
    return run


def _resolved_pairs(size: int) -> Callable[[Batches], Batches]:
    def run(batches):
        table = np.zeros(size * size, np.int64)
        for batch in batches:
            own = _unpacked(batch.column("own"), np.uint8)[1].astype(np.int64)
            if own.size:
                _cells(own, table, size)
        yield _told(table)
    return run


def _table(rows: DataFrame, count: Callable[[Batches], Batches], size: int) -> np.ndarray:
    """How often a class follows a class, over all tokens of the rows."""
    found = rows.mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(size * size)
    table[found["cell"].to_numpy()] = found["n"].to_numpy()
    return table.reshape(size, size)


def _contexts(classes: Classes, size: int, share: int) -> Callable[[Batches], Batches]:
    """Each frequent word of a share with the counts of the classes before it and (from ``size`` on) after it; one row a task."""
    width = 2 * size

    def run(batches):
        keys, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []

        def join():
            nonlocal keys, times
            new, n = np.unique(np.concatenate(held), return_counts=True)
            every, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
            keys, times = every, np.bincount(at, np.concatenate([times, n]), every.size).astype(np.int64)
            held.clear()

        for piece in _pieces(batches, classes.frequent.size):
            own = classes.of(piece).astype(np.int64)
            at = np.flatnonzero((piece.codes < classes.frequent.size) & (piece.codes % SHARES == share))
            before, after = np.roll(own, 1), np.roll(own, -1)
            held += [piece.codes[at] * width + before[at], piece.codes[at] * width + size + after[at]]
            if sum(x.size for x in held) > HELD:
                join()
        if held:
            join()
        word, first = np.unique(keys // width, return_index=True)
        for a in range(0, word.size, 10_000):
            ends = np.append(first, keys.size)[a:a + 10_001]
            yield pa.RecordBatch.from_arrays([
                pa.array(word[a:a + 10_000].astype(np.int32)), list_array((keys[ends[0]:ends[-1]] % width).astype(np.int16), ends - ends[0], pa.int16()),
                list_array(times[ends[0]:ends[-1]], ends - ends[0], pa.int64())], ["id", "slots", "times"])
    return run


def choose(counts: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Best class of each word, by the counts of the classes before and after it, with the table of all as it stands.

    A word's own counts are taken out of its own class, so that it isn't held there by itself.
    """
    classes = len(table)
    left, right = counts[:, :classes], counts[:, classes:]
    n = left.sum(1)
    size = table.sum(1)
    plain = (size + 0.5) / (size.sum() + 0.5 * classes)
    likely = np.log((table + BACKOFF * plain) / (size[:, None] + BACKOFF))
    fits = left @ likely + right @ likely.T - n[:, None] * np.log(size + 0.5)
    rest = np.maximum(size[own] - n, 0)
    after = np.log((np.maximum(table[own] - right, 0) + BACKOFF * plain) / (rest[:, None] + BACKOFF))
    before = np.log((np.maximum(table[:, own].T - left, 0) + BACKOFF * plain[own][:, None]) / (size[None] + BACKOFF))
    fits[np.arange(own.size), own] = (left * before).sum(1) + (right * after).sum(1) - n * np.log(rest + 0.5)
    return fits.argmax(1)


def _moves(table: np.ndarray, classes: Classes) -> Callable[[Batches], Batches]:
    """New class of each word, from rows in order of the word, which are summed as they come."""
    width = 2 * len(table)

    def told(ids, counts):
        best = choose(counts, classes.frequent[ids].astype(np.int64), table)
        return pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(best.astype(np.int16))], ["id", "class"])

    def run(batches):
        last, held = -1, np.zeros(width)
        for batch in batches:
            ids, at = np.unique(batch.column("id").to_numpy(), return_inverse=True)
            if not ids.size:
                continue
            sizes = pc.list_value_length(batch.column("slots")).to_numpy()
            counts = np.bincount(np.repeat(at, sizes) * width + pc.list_flatten(batch.column("slots")).to_numpy().astype(np.int64),
                                 pc.list_flatten(batch.column("times")).to_numpy(), ids.size * width).reshape(-1, width)
            if ids[0] == last:
                counts[0] += held
            elif last >= 0:
                yield told(np.array([last]), held[None])
            if ids.size > 1:
                yield told(ids[:-1], counts[:-1])
            last, held = int(ids[-1]), counts[-1]
        if last >= 0:
            yield told(np.array([last]), held[None])
    return run


RARE = "h long, at long, place int, e short, before short, after short, train boolean"


def _rare_tokens(classes: Classes) -> Callable[[Batches], Batches]:
    """Every token that is not a frequent word, with its row, its place among the row's rare words and the classes beside it."""
    def run(batches):
        for piece in _pieces(batches, classes.frequent.size):
            own = classes.of(piece)
            at = np.flatnonzero(piece.codes >= classes.frequent.size)
            owner = np.repeat(np.arange(piece.rows.num_rows), np.diff(piece.offsets))[at]
            place = piece.codes[at] - classes.frequent.size
            columns = [piece.rare[place], piece.rows.column("at").to_numpy()[owner], (place - piece.firsts[owner]).astype(np.int32), piece.ends[place].astype(np.int16),
                       np.roll(own, 1)[at].astype(np.int16), np.roll(own, -1)[at].astype(np.int16)]
            train = piece.rows.column("train").to_numpy(zero_copy_only=False)[owner]
            rows = pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(train)], [x.split()[0] for x in RARE.split(", ")])
            for a in range(0, rows.num_rows, 100_000):
                yield rows.slice(a, 100_000)
    return run


SETTLED = "at long, place int, class short, n int"


def _settle(table: np.ndarray, classes: Classes) -> Callable[[Batches], Batches]:
    """Class and training count of each rare word, for each row that holds it, from tokens in order of word and row. A rare word has a
    bounded share of all tokens. Rows with ``at`` -1 tell how many training words a class (``place``) got."""
    width = 2 * len(table)

    def run(batches):
        for rows, cuts in whole(batches, ["h"]):
            word = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
            before, after, train, e, at, place = (rows[c].to_numpy() for c in ("before", "after", "train", "e", "at", "place"))
            own = classes.endings[e[cuts[:-1]]].astype(np.int64)
            n = np.bincount(word[train], minlength=own.size)
            best = own.copy()
            for a in range(0, own.size, 20_000):
                some = train & (word >= a) & (word < a + 20_000)
                k = min(20_000, own.size - a)
                spots = np.concatenate([(word[some] - a) * width + before[some], (word[some] - a) * width + len(table) + after[some]])
                best[a:a + k] = choose(np.bincount(spots, minlength=k * width).reshape(k, width).astype(float), own[a:a + k], table)
            best = np.where(n > 0, best, own)
            new = np.ones(at.size, bool)
            new[1:] = (word[1:] != word[:-1]) | (at[1:] != at[:-1])
            kinds = np.bincount(best[n > 0], minlength=len(table))
            held = np.flatnonzero(kinds)
            made = [np.concatenate([at[new], np.full(held.size, -1)]), np.concatenate([place[new], held]).astype(np.int32),
                    np.concatenate([best[word[new]], held]).astype(np.int16), np.concatenate([n[word[new]], kinds[held]]).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, made)], [x.split()[0] for x in SETTLED.split(", ")])
    return run


def spread(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def gain(table: np.ndarray) -> float:
    """Sum of x log x over the table less that of the row and column sums: higher is likelier."""
    return float(spread(table).sum() - spread(table.sum(0)).sum() - spread(table.sum(1)).sum())


def exchange(pairs: np.ndarray, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each unit. Unit by unit moves to the class that makes the bigrams likeliest, until none moves.

    Units begin in turn over the classes, most frequent first; ties go to the lowest class.
    """
    pairs = pairs.astype(np.float64)
    units = len(pairs)
    order = np.argsort(-(pairs.sum(0) + pairs.sum(1)), kind="stable")
    own = np.zeros(units, np.int64)
    own[order] = np.arange(units) % classes
    table = np.zeros((classes, classes))
    np.add.at(table, (own[:, None], own[None, :]), pairs)
    for _ in range(rounds):
        moved = 0
        for u in order:
            if not pairs[u].any() and not pairs[:, u].any():
                continue
            right, left, self_ = pairs[u].copy(), pairs[:, u].copy(), pairs[u, u]
            right[u] = left[u] = 0
            out, into = np.bincount(own, right, classes), np.bincount(own, left, classes)
            table[own[u]] -= out
            table[:, own[u]] -= into
            table[own[u], own[u]] -= self_
            best = int(_tried(table, out, into, self_).argmax())
            moved += best != own[u]
            own[u] = best
            table[best] += out
            table[:, best] += into
            table[best, best] += self_
        if not moved:
            break
    return own


def _tried(table: np.ndarray, out: np.ndarray, into: np.ndarray, self_: float) -> np.ndarray:
    """Gain of the table with a unit put into each class: only that class's row and column change, and the sums of all."""
    diagonal, both = np.diag(table), out + into + self_
    change = (spread(table + out) - spread(table)).sum(1) + (spread(table + into[:, None]) - spread(table)).sum(0)
    change -= spread(diagonal + out) + spread(diagonal + into) - spread(diagonal) - spread(diagonal + both)
    rows, columns = table.sum(1) + into, table.sum(0) + out
    change -= spread(rows + out.sum() + self_) - spread(rows) + spread(columns + into.sum() + self_) - spread(columns)
    return change


class Model(NamedTuple):
    """Log10 transitions and emission sizes of the classes, and the training tokens and distinct ones."""

    transitions: np.ndarray
    emission: np.ndarray
    tokens: int
    distinct: int


RESOLVED = "train boolean, n_tokens long, n_known long, logs double, own binary"


def _resolve(classes: Classes, counts: np.ndarray, names: list[str], settled: bool) -> Callable[[Batches], Batches]:
    """Tokens of each row as classes (a byte each), with the sum of the logs of their counts. ``rare_words`` has what is known of the
    row's rare words: place, class (used if ``settled``) and count."""
    def run(batches):
        for piece in _pieces(batches, classes.frequent.size):
            own, times = classes.endings[piece.ends].copy(), np.zeros(piece.ends.size, np.int64)
            if "rare_words" in piece.rows.schema.names:
                told = piece.rows.column("rare_words")
                sizes = pc.fill_null(pc.list_value_length(told), 0).to_numpy()
                flat = pc.list_flatten(told)
                at = flat.field("place").to_numpy() + np.repeat(piece.firsts[:-1], sizes)
                times[at] = flat.field("n").to_numpy()
                if settled:
                    own[at] = flat.field("class").to_numpy()
            every = np.concatenate([classes.frequent, own]).astype(np.uint8)
            count = np.concatenate([counts, times])
            n = piece.rows.num_rows
            owner = np.repeat(np.arange(n), np.diff(piece.offsets))
            made = {"n_tokens": pa.array(np.diff(piece.offsets)), "own": _packed(every[piece.codes], piece.offsets),
                    "n_known": pa.array(np.bincount(owner, (count > 0)[piece.codes], n).astype(np.int64)),
                    "logs": pa.array(np.bincount(owner, np.log10(count + 0.5)[piece.codes], n))}
            yield pa.RecordBatch.from_arrays([made[x] if x in made else piece.rows.column(x) for x in names], names)
    return run


def fit(texts: DataFrame, stage: Stage, frequent: int | None = None) -> tuple[Model, DataFrame]:
    """Learn from the whole ``text`` of the rows of ``texts`` (doc_id, text, train) that are to train. Null and empty texts are an end
    token alone. Returns the model, and all rows (doc_id and the columns of ``RESOLVED``) with the class of each token.

    The driver gets the words above a share of 1 / ``frequent`` of the tokens, and tables of classes or units. All other words are
    settled where their tokens meet, and come back to the texts that hold them by the row's number.
    """
    frequent = frequent or FREQUENT
    kind = dict(texts.dtypes)["doc_id"]
    counts = stage(texts.where("train").select("text").mapInArrow(_count, "h long, e short, n long")
                   .groupBy("h").agg(F.min("e").alias("e"), F.sum("n").alias("n")), "word_counts")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    is_frequent = (F.col("n") * frequent > tokens) | (F.col("h") == END)
    often = counts.where(is_frequent).toArrow()
    keys, ends, n = (often[c].to_numpy() for c in ("h", "e", "n"))
    if not (keys == END).any():  # no text to learn from
        keys, ends, n = np.append(keys, END), np.append(ends, 0), np.append(n, 0)
    order = np.argsort(keys)
    keys, ends, n = keys[order], ends[order].astype(np.int64), n[order].astype(np.int64)

    names = ["doc_id", *(x.split()[0] for x in CODED.split(", "))]
    coded = stage(texts.withColumn("at", F.monotonically_increasing_id()).mapInArrow(_code(keys, names), f"doc_id {kind}, {CODED}"), "coded")
    train = coded.where("train")
    size = class_count(distinct)
    top = np.lexsort((keys, -n))
    top = np.concatenate([top[keys[top] == END], top[keys[top] != END]])[:WORDS]
    units = WORDS + ends
    units[top] = np.arange(top.size)
    start = Classes(units.astype(np.int16), (WORDS + np.arange(ENDINGS)).astype(np.int16))
    pairs = _table(train, _coded_pairs(start, UNITS), UNITS)
    first = exchange(pairs, size)
    classes = Classes(first[start.frequent].astype(np.int16), first[start.endings].astype(np.int16))
    table = np.zeros((size, size))
    np.add.at(table, (first[:, None], first[None, :]), pairs)

    rejected = 0
    for turn in range(SWEEPS * SHARES):
        moved = (train.mapInArrow(_contexts(classes, size, turn % SHARES), "id int, slots array<short>, times array<long>")
                 .repartition("id").sortWithinPartitions("id").mapInArrow(_moves(table, classes), "id int, class short")).toArrow()
        tried = classes.frequent.copy()
        tried[moved["id"].to_numpy()] = moved["class"].to_numpy()
        tried_table = _table(train, _coded_pairs(classes._replace(frequent=tried), size), size)
        rejected = 0 if gain(tried_table) > gain(table) else rejected + 1
        if not rejected:
            classes, table = classes._replace(frequent=tried), tried_table
        elif rejected == SHARES:
            break

    columns = ["doc_id", *(x.split()[0] for x in RESOLVED.split(", "))]
    kinds = np.bincount(classes.frequent[n > 0], minlength=size)
    if distinct == (n > 0).sum():  # no other words
        rows = stage(coded.mapInArrow(_resolve(classes, n, columns, False), f"doc_id {kind}, {RESOLVED}"), "resolved")
        return _model(table, kinds, tokens, distinct), rows
    settled = stage(coded.mapInArrow(_rare_tokens(classes), RARE).repartition("h").sortWithinPartitions("h", "at")
                    .mapInArrow(_settle(table, classes), SETTLED), "rare_words")
    told = settled.where("at >= 0").groupBy("at").agg(F.collect_list(F.struct("place", "class", "n")).alias("rare_words"))
    both = coded.join(told, "at", "left")
    rows = stage(both.mapInArrow(_resolve(classes, n, columns, True), f"doc_id {kind}, {RESOLVED}"), "resolved")
    tried_table = _table(rows.where("train"), _resolved_pairs(size), size)
    if gain(tried_table) > gain(table):
        table = tried_table
        other = settled.where("at < 0").groupBy(F.col("place").alias("c")).agg(F.sum("n").alias("k")).collect()
    else:
        rows = stage(both.mapInArrow(_resolve(classes, n, columns, False), f"doc_id {kind}, {RESOLVED}"), "resolved")
        by_end = counts.where(~is_frequent).groupBy("e").agg(F.count(F.lit(1)).alias("k")).collect()
        other = [(int(classes.endings[e]), k) for e, k in by_end]
    for c, k in other:
        kinds[c] += k
    return _model(table, kinds, tokens, distinct), rows


def _model(table: np.ndarray, kinds: np.ndarray, tokens: int, distinct: int) -> Model:
    size = table.sum(0)
    plain = (size + 0.5) / (size.sum() + 0.5 * len(table))
    transitions = (table + BACKOFF * plain) / (table.sum(1, keepdims=True) + BACKOFF)
    return Model(np.log10(transitions), np.log10(size + 0.5 * (kinds + 1)), int(tokens), int(distinct))


SCORED = "n_tokens long, n_known long, base double, model double"


def _score(model: Model, names: list[str]) -> Callable[[Batches], Batches]:
    whole_ = np.log10(model.tokens + 0.5 * (model.distinct + 1))

    def run(batches):
        for batch in batches:
            offsets, own = _unpacked(batch.column("own"), np.uint8)
            n = batch.num_rows
            logs = batch.column("logs").to_numpy()
            before = np.roll(own, 1)
            if n:
                before[offsets[:-1]] = own[offsets[1:] - 1]  # a text's own end, which has the class of every end
            owner = np.repeat(np.arange(n), np.diff(offsets))
            score = logs + np.bincount(owner, model.transitions[before, own] - model.emission[own], n)
            made = {"base": pa.array(logs - whole_ * np.diff(offsets)), "model": pa.array(score)}
            yield pa.RecordBatch.from_arrays([made[x] if x in made else batch.column(x) for x in names], names)
    return run


def score(docs: DataFrame, train: Column, stage: Stage | None = None, frequent: int | None = None) -> DataFrame:
    """Fit on the rows of ``docs`` (doc_id, text) where ``train`` holds, then score all: one row per row of ``docs``.

    Columns: doc_id, train, n_tokens (words and the end), n_known (tokens seen in training), train_tokens, base_score
    (smoothed unigrams) and score (class model), both log10 of the probability of the text. Words are lower-cased
    (A-Z) and cut at ASCII blanks; null and empty texts are an end alone. A null ``train`` counts as false.
    Perplexity is ``10 ** (-score / n_tokens)``. Words not seen in training have the class of their ending. Extra columns are left out.
    """
    stage = stage or WrittenTables(docs.sparkSession)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    model, rows = fit(texts, stage, frequent)
    names = ["doc_id", "train", *(x.split()[0] for x in SCORED.split(", "))]
    kind = dict(docs.dtypes)["doc_id"]
    scored = rows.mapInArrow(_score(model, names), f"doc_id {kind}, train boolean, {SCORED}")
    return scored.select("doc_id", "train", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                         F.col("base").alias("base_score"), F.col("model").alias("score"))
