"""Near-duplicate documents by b-bit MinHash.

Every document gets ``BANDS * ROWS`` minima over its distinct word shingles. Bands of minima give buckets; of the
minima themselves only the low ``BITS`` bits are kept, packed into longs, and compared by counting bits. Candidates
come from the buckets, are narrowed by the collision-corrected estimate, and are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from shelfline.llm.arrays import LOWER, chunks, hash_words, list_array, mix, shingle_hashes, split_words
from shelfline.llm.components import components
from shelfline.plans.staging import Stage, WrittenTables

BANDS, ROWS, BITS = 32, 5, 4
SIZE = BANDS * ROWS
LANES = 64 // BITS
LONGS = SIZE // LANES
#: one bit in every lane of a long
LOW_BITS = sum(1 << (BITS * lane) for lane in range(LANES))
CHANCE = 2.0 ** -BITS
#: A pair in a bucket joins a group from GROUP on, and is done with the bucket's leader from SURE on. Pairs under
#: MAYBE are not looked at on their sets: with 160 minima a true 0.8 lies 5 standard errors above it.
GROUP, SURE, MAYBE = 0.3, 0.75, 0.62
BLOCK_ITEMS, ANCHORS = 2_000_000, 8
SIGNED = "doc_id long, text_key long, n_shingles long, cls binary, bands array<long>, sig array<long>"


def _hash_family() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240607)
    odd = draw.integers(0, 2 ** 63, SIZE, np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, draw.integers(0, 2 ** 63, SIZE, np.uint64)


def shingle_sets(batch: pa.RecordBatch, size: int, column: str = "text") -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text. A text with fewer words is one shingle, an empty one has none."""
    words = split_words(batch.column(column), LOWER)
    hashes = hash_words(words.vocab)[words.codes]
    for first, last in zip(words.starts[:-1], words.starts[1:], strict=True):
        own = hashes[first:last]
        yield np.unique(shingle_hashes(own, min(size, own.size))) if own.size else np.zeros(0, np.uint64)


def class_key(items: np.ndarray) -> bytes:
    """Documents with equal sets share it."""
    return xxhash.xxh3_128_digest(items.tobytes())


def minima(items: np.ndarray, odd: np.ndarray, add: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over the items; long sets in pieces, so memory stays small."""
    out = np.full(SIZE, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, items.size, 2048):
        out = np.minimum(out, (odd[:, None] * items[None, k:k + 2048] + add[:, None]).min(axis=1))
    return out


def pack(values: np.ndarray) -> np.ndarray:
    """Low bits of the minima, LANES to a long."""
    low = (mix(values) & np.uint64(2 ** BITS - 1)).reshape(LONGS, LANES)
    return np.bitwise_or.reduce(low << (np.arange(LANES, dtype=np.uint64) * np.uint64(BITS)), axis=1)


def band_keys(values: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        keys = mix(keys) + values.reshape(BANDS, ROWS)[:, k]
    return mix(keys)


def _sign(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        odd, add = _hash_family()
        for batch in chunks(batches):
            counts, keys, bands, sigs = [], [], [], []
            for items in shingle_sets(batch, size):
                counts.append(items.size)
                keys.append(class_key(items) if items.size else None)
                if items.size:
                    values = minima(items, odd, add)
                    bands.append(band_keys(values))
                    sigs.append(pack(values))
            full = np.concatenate([[0], np.cumsum(np.array(counts) > 0)])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                list_array(np.array(bands, np.uint64).reshape(-1).view(np.int64), full * BANDS, pa.int64()),
                list_array(np.array(sigs, np.uint64).reshape(-1).view(np.int64), full * LONGS, pa.int64()),
            ], ["doc_id", "text_key", "n_shingles", "cls", "bands", "sig"])
    return run


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: share of equal lanes, less what equals by chance."""
    equal = F.lit(SIZE)
    for k in range(LONGS):
        differ = a[k].bitwiseXOR(b[k])
        for step in range(1, BITS):
            differ = differ.bitwiseOR(F.shiftrightunsigned(a[k].bitwiseXOR(b[k]), step))
        equal = equal - F.bit_count(differ.bitwiseAND(F.lit(LOW_BITS)))
    return (equal / F.lit(SIZE) - CHANCE) / (1 - CHANCE)


def estimates(sig: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The same over arrays: one signature against many."""
    differ = sig[None, :] ^ others
    any_bit = differ.copy()
    for step in range(1, BITS):
        any_bit |= differ >> np.uint64(step)
    unequal = np.bitwise_count(any_bit & np.uint64(LOW_BITS)).sum(axis=1)
    return ((SIZE - unequal) / SIZE - CHANCE) / (1 - CHANCE)


def link(sigs: np.ndarray, flat: np.ndarray, offsets: np.ndarray, asked: np.ndarray, percent: int) -> np.ndarray:
    """Component of each set in a block, as the place of a member. Sets that are ``asked`` are held against all.

    Pairs already in one component are skipped, so a group of near copies costs its members, not their pairs,
    but for those that hang on by few links.
    """
    count = asked.size
    comp, sizes = np.arange(count), np.diff(offsets)
    whole = bool(asked.all())
    for i in np.flatnonzero(asked):
        low = i + 1 if whole else 0
        near = low + np.flatnonzero(comp[low:] != comp[i])
        near = near[(100 * np.minimum(sizes[near], sizes[i]) >= percent * np.maximum(sizes[near], sizes[i]))]
        near = near[estimates(sigs[i], sigs[near]) >= MAYBE]
        own = flat[offsets[i]:offsets[i + 1]]
        for k in range(0, near.size, 512):
            some = near[k:k + 512]
            places = np.concatenate([np.arange(offsets[j], offsets[j + 1]) for j in some])
            items = flat[places]
            found = np.searchsorted(own, items)
            hit = own[np.minimum(found, own.size - 1)] == items
            shared = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(sizes[some])[:-1]]))
            for j in some[100 * shared >= percent * (sizes[i] + sizes[some] - shared)]:
                if comp[j] != comp[i]:
                    comp[comp == comp[j]] = comp[i]
    return comp


def _link_blocks(percent: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("grp")
        groups = table["grp"].to_pylist()
        keys = np.array(table["cls"].to_pylist(), object)
        sigs = table["sig"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, LONGS)
        asked = table["asked"].to_numpy()
        items = table["items"].combine_chunks()
        flat = np.frombuffer(b"".join(items.to_pylist()), np.uint64)
        offsets = np.concatenate([[0], np.cumsum(pc.binary_length(items).to_numpy() // 8)])
        out, first = list(keys), 0
        while first < len(groups):
            last = first
            while last < len(groups) and groups[last] == groups[first]:
                last += 1
            own = slice(first, last)
            comp = link(sigs[own], flat[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first],
                        asked[own], percent)
            for place in range(last - first):
                out[first + place] = keys[first + comp[place]]
            first = last
        return pa.table({"a": pa.array(list(keys), pa.binary()), "b": pa.array(out, pa.binary())})
    return run


def _sets(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Full sets of the class representatives; of rows that share an id, only the text of the class."""
    def run(batches):
        for batch in chunks(batches):
            items = list(shingle_sets(batch, size))
            same = [class_key(x) == key for x, key in zip(items, batch.column("cls").to_pylist(), strict=True)]
            names = ["grp", "cls", "sig", "blocks", "anchor"]
            kept = pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [
                pa.array([x.tobytes() for x in items], pa.binary())], [*names, "items"])
            yield kept.filter(pa.array(same, pa.bool_()))
    return run


def _coarse(classes: DataFrame, stage: Stage) -> DataFrame:
    """Edges between classes that may be linked: each bucket's members to its leader, and to a next one where in doubt.

    If x and y are linked and x is done with a leader (estimate SURE or more), the triangle inequality of the
    Jaccard distance brings y within GROUP of that leader too, so both end in one group.
    """
    sigs = classes.select(F.col("cls").alias("_c"), F.col("sig").alias("_s"))
    rows = classes.select(F.explode("bands").alias("key"), "cls")
    edges = None
    for turn in range(3):
        heads = rows.groupBy("key").agg(F.min("cls").alias("leader"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
        rows = stage(rows.join(heads.drop("_n"), "key").where("cls <> leader"), f"bucket_rows_{turn}")
        pairs = (rows.select("cls", "leader").distinct()
                 .join(sigs, F.col("cls") == F.col("_c")).withColumnRenamed("_s", "_own").drop("_c")
                 .join(sigs, F.col("leader") == F.col("_c"))
                 .select("cls", "leader", estimate(F.col("_own"), F.col("_s")).alias("est")))
        pairs = stage(pairs, f"estimates_{turn}")
        found = pairs.where(F.col("est") >= GROUP if turn < 2 else F.lit(True)).select(
            F.col("cls").alias("a"), F.col("leader").alias("b"))
        edges = found if edges is None else edges.union(found)
        rows = rows.join(pairs.where(F.col("est") < SURE), ["cls", "leader"]).select("key", "cls")
    return edges


def _cross(large: DataFrame, strays: DataFrame, bands: DataFrame) -> DataFrame:
    """Rows of a cut group's blocks and of the strays to hold against them, dealt by grp, block and slice.

    Strays are cut into slices of bounded size as the group is into blocks, so a task holds one block and one slice at most,
    however many classes of a group are strays. A stray only goes to blocks in which a class shares a bucket with it.
    """
    slices = strays.groupBy("grp").agg(F.ceil(F.sum(F.length("items")) / (8 * BLOCK_ITEMS)).cast("int").alias("slices"))
    strays = strays.join(slices, "grp").withColumn("slice", F.pmod(F.xxhash64("cls", F.lit("stray")), "slices").cast("int")).drop("slices")
    buckets = large.select("grp", "cls", "block").join(bands, "cls").select("grp", "key", "block").distinct()
    aimed = (strays.select("grp", "cls", "slice").join(bands, "cls").join(buckets, ["grp", "key"])
             .select("grp", "cls", "slice", "block").distinct())
    held = large.join(aimed.select("grp", "block", "slice").distinct(), ["grp", "block"]).withColumn("asked", F.lit(False))
    return held.unionByName(strays.join(aimed, ["grp", "cls", "slice"]).withColumn("asked", F.lit(True)))


def _grouped(docs: DataFrame, words: int, percent: int, stage: Stage) -> DataFrame:
    """doc_id, text_key (hash of the text), n_shingles, label of the component and its smallest doc_id, for each row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stage(docs.withColumn("text_key", F.xxhash64("text")).mapInArrow(_sign(words), SIGNED), "signatures")
    classes = stage(signed.where("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("first_id"), F.min("text_key").alias("text_key"), F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"), F.first("sig").alias("sig")), "classes")
    groups = stage(components(_coarse(classes, stage), stage)
                   .select(F.col("vertex").alias("cls"), F.col("label").alias("grp")), "groups")

    # sets of all classes in a group; a group of many sets is cut into blocks of bounded size
    sized = groups.join(classes.select("cls", "first_id", "text_key", "n_shingles", "sig"), "cls")
    blocks = sized.groupBy("grp").agg(F.ceil(F.sum("n_shingles") / BLOCK_ITEMS).cast("int").alias("blocks"),
                                      F.count(F.lit(1)).alias("members"))
    bins = int(blocks.agg(F.sum("blocks")).first()[0] or 1)
    total = sized.agg(F.sum("n_shingles")).first()[0] or 0
    bins = max(1, min(bins, total // BLOCK_ITEMS + 1)) * 4
    # a few members of a cut group stand in each of its blocks, so that what hangs together does so across blocks
    anchor = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("cls", F.lit("anchor")), F.floor(F.col("members") / ANCHORS) + 1) == 0)
    placed = sized.join(blocks, "grp").withColumn("anchor", anchor).drop("n_shingles", "members")
    names = ["grp", "cls", "sig", "blocks", "anchor", "text"]
    texts = docs.join(placed, docs.doc_id == placed.first_id).select(*names)
    if not classes.where("first_id is null").isEmpty():  # classes of rows without a doc_id are found by their text
        lone = docs.where("doc_id is null").withColumn("_key", F.xxhash64("text")).dropDuplicates(["_key"])
        texts = texts.union(lone.join(placed.where("first_id is null"), F.col("_key") == F.col("text_key")).select(*names))
    sets = stage(texts.mapInArrow(_sets(words), "grp binary, cls binary, sig array<long>, blocks int, anchor boolean, items binary"), "sets")

    block = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("cls"), "blocks")).otherwise(F.lit(0)).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    place = F.when(F.col("blocks") > 1, F.xxhash64("grp")).otherwise(F.pmod(F.xxhash64("grp"), F.lit(bins)))
    dealt = sets.withColumn("block", F.explode(F.when(F.col("anchor"), every).otherwise(F.array(block))))
    linked = stage(dealt.withColumn("asked", F.lit(True)).groupBy(place.alias("place"), "block")
                   .applyInArrow(_link_blocks(percent), "a binary, b binary"), "links")
    edges = linked.where("a <> b")
    large = sets.where("blocks > 1")
    if not large.isEmpty():
        # what a block left outside its largest component is held against the blocks of the group that share a bucket with it
        parts = stage(components(edges, stage), "parts")
        labelled = large.join(parts, large.cls == parts.vertex, "left").withColumn("part", F.coalesce("label", "cls"))
        counts = labelled.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"))
        main = counts.groupBy("grp").agg(F.max_by("part", "n").alias("main"))
        strays = labelled.join(main, "grp").where("part <> main").select(*large.columns)
        bands = classes.select("cls", F.explode("bands").alias("key"))
        more = stage(_cross(large.withColumn("block", block), strays, bands).groupBy("grp", "block", "slice")
                     .applyInArrow(_link_blocks(percent), "a binary, b binary"), "cross")
        edges = edges.union(more.where("a <> b"))
    final = components(edges, stage).withColumnRenamed("vertex", "cls")
    named = classes.select("cls", "first_id").join(final, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    ids = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    by_class = named.join(ids, "label").select("cls", "label", "component_id")
    return signed.select("doc_id", "text_key", "n_shingles", "cls").join(by_class, "cls", "left").drop("cls")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, stage: Stage | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text; other columns are ignored).

    Documents are linked if their sets of distinct ``words``-word shingles (ASCII letters in lower case, words cut
    at ASCII blanks) have ``100 * intersection >= percent * union``. A text with fewer words is one shingle. Null
    and empty texts have no shingle and no links. Equal sets are one class from the start, so exact copies never
    meet pair by pair. ``component_id`` is the smallest doc_id reachable; rows that repeat a doc_id keep it together.
    Rows without a doc_id are linked as all others are; if a whole component has no doc_id, its component_id is null
    and all its rows are kept (``first_of_each`` leaves one row). Tables are written under the folder that ``stage``
    keeps (the shared checkpoint folder by default).
    """
    out = _grouped(docs, words, percent, stage or WrittenTables(docs.sparkSession))
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def first_of_each(docs: DataFrame, words: int = 5, percent: int = 80, stage: Stage | None = None) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the smallest doc_id, nulls last.

    Rows are told apart by doc_id and a 64-bit hash of the text. Of rows that share a doc_id in one group that of the
    smallest hash stays, of rows alike in both any one. Rows without words are in no group and all stay.
    """
    stage = stage or WrittenTables(docs.sparkSession)
    found = stage(_grouped(docs, words, percent, stage), "grouped")
    rows = found.where("label is not null").groupBy("label", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    first = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "n")).alias("first"))
    wordless = found.where("label is null").select("doc_id", "text_key").distinct().withColumn("n", F.lit(1).cast("long"))
    chosen = stage(first.select("first.doc_id", "first.text_key", "first.n").union(wordless), "first_of_each")

    def of(some: DataFrame) -> DataFrame:
        key = F.xxhash64(docs["text"].cast("string"))
        return docs.join(some, docs["doc_id"].cast("long").eqNullSafe(some["doc_id"]) & (key == some["text_key"]), "left_semi")

    alike = chosen.where("n > 1")
    kept = of(chosen.where("n = 1"))
    return kept if alike.isEmpty() else kept.union(of(alike).dropDuplicates(["doc_id", "text"]))
