"""Token-id files: flat unsigned integers with 64-bit offsets, one set of files for each range of doc_id.

Part ``n`` of a folder is ``n.tokens`` (little-endian unsigned ids, 16 bits if the vocabulary allows it, else 32),
``n.offsets`` (64-bit start of each document in the part, and the end) and ``n.docs`` (64-bit doc_ids). Parts follow each
other in doc_id order, rows without a doc_id before all others: the table of parts tells how many begin each part. The place of a part in the whole is the prefix sum of the sizes of those before it, so the
tasks that write need not know of each other.
"""

from __future__ import annotations

import codecs
import json
from array import array
from collections.abc import Callable, Iterator
from contextlib import closing
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfline.llm.arrays import BLANKS, KEEP_CASE, Words, chunks, ragged, split_words, text_bytes
from shelfline.plans.staging import Stage, WrittenTables

MANIFEST = "part long, n_docs long, n_missing long, n_tokens long, bytes_per_id int"
READ = "doc_id long, start long, n_tokens long, ids binary"
#: words whose ids a worker keeps; others are encoded again in each batch
KEPT_WORDS = 300_000
READ_DOCS = 512
#: how ``cuts_by_kind`` knows a tokenizer that cuts at contractions, runs of letters, each digit, and runs of all else
BY_KIND = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BLANK, LETTER, DIGIT, MARK, OTHER = range(5)
KINDS = np.full(256, OTHER, np.uint8)
KINDS[:128] = MARK
KINDS[BLANKS] = BLANK
KINDS[48:58] = DIGIT
KINDS[[*range(65, 91), *range(97, 123)]] = LETTER
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
APOSTROPHE = 39
#: lower-case letters which neither the normalizer nor the cutter changes, and the longest piece of them that goes straight to the model
PLAIN = "a-zß-öø-ÿ"
PLAIN_BYTES = 256


class WordEncoder:
    """Ids of texts from the ids of their distinct words.

    Right for tokenizers that never join characters across ASCII blanks, which ``word_local`` tells from the
    tokenizer's own description; others encode whole texts. If ``cuts_by_kind`` holds too, words are cut further where letters,
    digits and marks meet, and pieces of plain lower-case letters need the tokenizer's model only.
    """

    def __init__(self, description: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.by_word = word_local(description)
        self.by_kind = self.by_word and cuts_by_kind(description)
        self.added = [x["content"].encode() for x in json.loads(description)["added_tokens"]]
        self.kept: dict[bytes, bytes] = {}
        if self.by_kind:  # what the tokenizer's byte level makes of each byte of a plain letter
            shown = ["\ufffe"] * 256
            for letter in map(chr, [*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)]):
                (seen, _), = self.tokenizer.pre_tokenizer.pre_tokenize_str(letter)
                for byte, char in zip(letter.encode(), seen, strict=True):
                    shown[byte] = char
            self.shown = "".join(shown)

    def _batch(self, texts: list[str]) -> list[list[int]]:
        fast = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [x.ids for x in fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, each closed by ``end_id``, and the offsets of each text in them."""
        if not self.by_word:
            ids = [x + [end_id] for x in self._batch(["" if t is None else t for t in texts.to_pylist()])]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.concatenate([np.zeros(0, np.uint32), *(np.array(x, np.uint32) for x in ids)]), np.append(0, np.cumsum(sizes))
        words = split_pieces(texts, self.added) if self.by_kind else None
        by_kind = words is not None
        words = words or split_words(texts, KEEP_CASE)
        vocab = words.vocab.to_pylist()
        found = list(map(self.kept.get, vocab))
        new = [k for k, x in enumerate(found) if x is None]
        rest = new
        if by_kind:
            pieces = words.vocab.take(pa.array(new, pa.int64()))
            plain = pc.and_(pc.match_substring_regex(pieces.view(pa.string()), f"^[{PLAIN}]+$"), pc.less(pc.binary_length(pieces), PLAIN_BYTES))
            plain = plain.to_numpy(zero_copy_only=False)
            tokenize, show, shown = self.tokenizer.model.tokenize, codecs.charmap_decode, self.shown
            for k in np.array(new, np.int64)[plain].tolist():
                found[k] = array("I", [t.id for t in tokenize(show(vocab[k], "strict", shown)[0])]).tobytes()
            rest = np.array(new, np.int64)[~plain].tolist()
        for first in range(0, len(rest), 20_000):
            some = rest[first:first + 20_000]
            for k, ids in zip(some, self._batch([vocab[k].decode("utf-8", "replace") for k in some]), strict=True):
                found[k] = array("I", ids).tobytes()
        for k in new[:max(0, KEPT_WORDS - len(self.kept))]:
            self.kept[vocab[k]] = found[k]
        found.append(array("I", [end_id]).tobytes())
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        starts = np.cumsum(counts) - counts
        codes = np.insert(words.codes.astype(np.int64), words.starts[1:], len(vocab))
        sizes = counts[codes]
        text_ends = words.starts[1:] + np.arange(1, len(texts) + 1)
        offsets = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], text_ends])]
        return flat[ragged(starts[codes], sizes)], offsets


def word_local(description: str) -> bool:
    """True if the tokenizer drops white space and cuts there, so a text's ids are those of its words in turn."""
    told = json.loads(description)
    parts = told["normalizer"] or {}
    allowed = [x["type"] for x in parts.get("normalizers", [parts] if parts else [])]
    cutter = told["pre_tokenizer"] or {}
    cuts = cutter.get("pretokenizers", [cutter])
    first = cuts[0] if cuts else {}
    pattern = (first.get("pattern") or {}).get("Regex", "")
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and (
        r"[^\s\p{L}\p{N}]+" in pattern and r"\s+" not in pattern)
    plain = all(not (x["lstrip"] or x["rstrip"] or any(c.isspace() for c in x["content"])) for x in told["added_tokens"])
    prefix = any(x.get("add_prefix_space") for x in cuts)
    return bool(drops and plain and not prefix and set(allowed) <= {"NFC", "Replace", "Lowercase"})


def cuts_by_kind(description: str) -> bool:
    """True if the tokenizer, by its own description, composes, lower-cases and cuts as ``split_pieces`` takes for granted."""
    told = json.loads(description)
    normal = (told["normalizer"] or {}).get("normalizers", [])
    cuts = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
    return bool(
        [x["type"] for x in normal] == ["NFC", "Replace", "Lowercase"]
        and (normal[1]["pattern"], normal[1]["content"]) == ({"Regex": r"\s+"}, " ")
        and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
        and (cuts[0]["pattern"], cuts[0]["behavior"], cuts[0]["invert"]) == ({"Regex": BY_KIND}, "Removed", True)
        and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
        and told["model"]["type"] == "BPE" and not told["model"]["dropout"]
        and all(not x["normalized"] and x["content"].isascii() and x["content"] == x["content"].lower() for x in told["added_tokens"]))


def split_pieces(texts: pa.Array, added: list[bytes]) -> Words | None:
    """Words cut where kinds of characters meet, lower-cased: each piece gives the ids it gives inside its text. None if a text
    may hold one of the ``added`` tokens, which are found before anything is cut.

    Kinds are told for ASCII and the letters of Latin-1. None of those joins the character before it when texts are composed,
    so a cut in front of one is safe; one in front of anything else may tear a mark from its letter and is not made, nor is
    such a letter lower-cased. A cut behind an apostrophe could tear a contraction.
    """
    offsets, data = text_bytes(texts)
    edge = np.zeros(data.size + 1, bool)
    edge[offsets] = True
    kind = KINDS[data]
    lead = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[1:] & 0xDF != 0x97) & ~edge[1:-1])
    kind[lead] = kind[lead + 1] = LETTER
    low = LOWERED[data]
    high = lead[data[lead + 1] < 0x9F] + 1
    low[high] += 32
    unsure = np.flatnonzero(kind[1:] == OTHER)
    low[unsure] = data[unsure]
    raw = low.tobytes()
    if any(x in raw for x in added):
        return None
    before, after = kind[:-1], kind[1:]
    known = (before != OTHER) & (after != OTHER) & (data[:-1] != APOSTROPHE)
    edge[1:-1] |= (before != after) & (known | (before == BLANK) | (after == BLANK))
    inside = kind != BLANK
    first, last = np.flatnonzero(inside & edge[:-1]), np.flatnonzero(inside & edge[1:]) + 1
    ends = np.concatenate([[0], np.cumsum(last - first)]).astype(np.int32)
    flat = low[inside]
    coded = pa.Array.from_buffers(pa.binary(), first.size, [None, pa.py_buffer(ends), pa.py_buffer(flat)]).dictionary_encode()
    return Words(np.searchsorted(first, offsets), coded.indices.to_numpy(), coded.dictionary, flat, ends)


@lru_cache(maxsize=2)
def _encoder(description: str) -> WordEncoder:
    return WordEncoder(description)


def _folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _write(folder: str, description: str, end_id: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        fs, base = _folder(folder)
        fs.create_dir(base, recursive=True)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        kinds = ("tokens", "offsets", "docs")
        names = {kind: f"{base}/.{part:06d}.{attempt}.{kind}" for kind in kinds}
        n_docs = n_missing = n_tokens = 0
        encoder = _encoder(description)
        with closing(fs.open_output_stream(names["tokens"])) as tokens, closing(
                fs.open_output_stream(names["offsets"])) as offsets, closing(fs.open_output_stream(names["docs"])) as docs:
            offsets.write(np.zeros(1, "<i8").tobytes())
            for batch in chunks(batches):
                ids, at = encoder.encode(batch.column("text"), end_id)
                tokens.write(ids.astype(f"<u{width}").tobytes())
                offsets.write((at[1:] + n_tokens).astype("<i8").tobytes())
                docs.write(pc.fill_null(batch.column("doc_id"), 0).to_numpy().astype("<i8").tobytes())
                n_docs += batch.num_rows
                n_missing += batch.column("doc_id").null_count
                n_tokens += ids.size
        for kind in kinds:  # whole files only appear under their names; a second attempt writes the same again
            fs.move(names[kind], f"{base}/{part:06d}.{kind}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in ((part, pa.int64()), (n_docs, pa.int64()), (n_missing, pa.int64()),
                                               (n_tokens, pa.int64()), (width, pa.int32()))],
            ["part", "n_docs", "n_missing", "n_tokens", "bytes_per_id"])
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1,
                      stage: Stage | None = None) -> DataFrame:
    """Encode the whole ``text`` of ``docs`` and write the files under ``folder``; returns the table of parts.

    Rows are dealt by ranges of doc_id and sorted inside, so the parts in turn are the documents in ascending
    doc_id order; rows that repeat a doc_id follow each other by text. Null and empty texts are the end id alone.
    Rows without a doc_id come first, by a hash of the text, over as many parts as they fill; they are read back
    with a null doc_id, and their ids count in the start of all that follow. ``folder`` is shared by all executors: a local
    path or a URI that pyarrow opens. The write runs when this is called.
    """
    stage = stage or WrittenTables(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as file:
        description = file.read()
    from tokenizers import Tokenizer

    largest = max(Tokenizer.from_str(description).get_vocab_size(with_added_tokens=True) - 1, end_id)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", spread).sortWithinPartitions("doc_id", spread, "text")
    run = _write(folder, description, end_id, 2 if largest < 2 ** 16 else 4)
    return stage(ordered.mapInArrow(run, MANIFEST), "token_parts")


def _read(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def mapped(fs: pafs.FileSystem, path: str, kind: str) -> np.ndarray:
        if isinstance(fs, pafs.LocalFileSystem):
            return np.memmap(path, kind, "r") if fs.get_file_info(path).size else np.zeros(0, kind)
        with fs.open_input_file(path) as file:
            return np.frombuffer(file.read_buffer(), kind)

    def run(batches):
        fs, base = _folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{base}/{row['part']:06d}"
                tokens = mapped(fs, f"{name}.tokens", f"<u{row['bytes_per_id']}")
                offsets, docs = mapped(fs, f"{name}.offsets", "<i8"), mapped(fs, f"{name}.docs", "<i8")
                for k in range(0, row["n_docs"], READ_DOCS):
                    own = np.array(docs[k:k + READ_DOCS])
                    at = np.array(offsets[k:k + READ_DOCS + 1])
                    ids = tokens[at[0]:at[-1]].astype("<u4")
                    edges = ((at - at[0]) * 4).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(own, mask=np.arange(k, k + own.size) < row["n_missing"]), pa.array(at[:-1] + row["base"]), pa.array(np.diff(at)),
                        pa.Array.from_buffers(pa.binary(), at.size - 1, [None, pa.py_buffer(edges), pa.py_buffer(ids)]),
                    ], ["doc_id", "start", "n_tokens", "ids"])
    return run


def read_token_files(spark: SparkSession, folder: str, parts: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids (each as
    four little-endian bytes). Files are memory-mapped where the folder is a local path. A part is read by one task.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    based = parts.where("n_docs > 0").withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    spread = based.repartition(max(1, parts.count()))
    return spread.mapInArrow(_read(folder), READ)
