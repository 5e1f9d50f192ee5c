"""Merkle manifest of a document table: roots, and a proof for every row, by time-forward processing.

Rows are leaves in order of group and id. A node's label is the last leaf beneath it and its level, so a parent comes right
after its last child. The forward sweep goes through the labels in order; each node sends its digest to its parent through a
priority queue ordered by label, which holds a few messages a level at any time. The backward sweep goes through the labels in
reverse and sends to each child its siblings and the proof of its parent. A block of ``BLOCK`` consecutive nodes is swept
by one task; messages that leave it are rows, which Spark deals by their label to the sweep that waits for them. So
a group of any size is spread over its blocks, and the blocks' tops over the next ones.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from shelfline.llm.groups import whole
from shelfline.plans.ordering import with_row_number
from shelfline.plans.sizing import join_dim
from shelfline.plans.staging import Stage, WrittenTables

ARITY, LEVELS = 3, 7
BLOCK = ARITY ** LEVELS
BLOCK_KEY = ["tree", "block"]
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = StructType().add("lefts", ArrayType(StringType())).add("rights", ArrayType(StringType())).add("subroot", StringType())


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of the values in turn, each as its length in UTF-8 bytes, a colon and itself, or ``-`` for null."""
    told = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")))
            for c in columns]
    return F.sha2(F.concat(*told), 256)


def fold(leaf: Column, lefts: Column, rights: Column) -> Column:
    """The root that a leaf and the digests beside its path lead to."""
    return F.aggregate(F.arrays_zip(lefts.alias("l"), rights.alias("r")), leaf,
                       lambda digest, beside: F.sha2(F.concat(beside["l"], digest, beside["r"]), 256))


def proof_digest(lefts: Column, rights: Column) -> Column:
    beside = F.transform(F.arrays_zip(lefts.alias("l"), rights.alias("r")), lambda level: F.concat(level["l"], level["r"]))
    return F.sha2(F.array_join(beside, ""), 256)


def height(nodes: int) -> int:
    """Levels above a row of nodes until one is left."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // ARITY), levels + 1
    return levels


def _last(level: int, node: int, nodes: int) -> int:
    """The last leaf beneath a node."""
    return min(nodes, (node + 1) * ARITY ** level) - 1


def forward(digests: Sequence[str], first: int, nodes: int) -> tuple[str, list[tuple[int, int, list[str]]]]:
    """Top of a block, and its inner nodes (level, node, child digests) in order of their labels.

    ``digests`` are nodes ``first``, ``first`` + 1, ... of a row of ``nodes``, and the block is whole.
    """
    levels = min(LEVELS, height(nodes))
    queue: list[tuple[int, int, int, str]] = []
    inner = []
    top = ""

    def send(level: int, node: int, digest: str) -> None:
        nonlocal top
        if level == levels:
            top = digest
        else:
            heapq.heappush(queue, (_last(level + 1, node // ARITY, nodes), level + 1, node, digest))

    for leaf, digest in enumerate(digests, first):
        send(0, leaf, digest)
        while queue and queue[0][0] == leaf:
            level, children = queue[0][1], []
            while queue and queue[0][:2] == (leaf, level):
                _, _, child, own = heapq.heappop(queue)
                children.append(own)
            inner.append((level, child // ARITY, children))
            send(level, child // ARITY, sha256("".join(children).encode()).hexdigest())
    return top, inner


def backward(inner: list[tuple[int, int, list[str]]], first: int, count: int, nodes: int, lefts: list[str],
             rights: list[str]) -> list[tuple[list[str], list[str]]]:
    """Proofs of the ``count`` leaves of a block, in their order, from that of its top."""
    levels = min(LEVELS, height(nodes))
    queue = [(-(first + count - 1), -levels, first // ARITY ** levels, lefts, rights)]
    turns = reversed(inner)
    out: list[tuple[list[str], list[str]]] = []
    while queue:
        _, level, node, lefts, rights = heapq.heappop(queue)
        if not level:
            out.append((lefts, rights))
            continue
        own_level, own, children = next(turns)
        assert (own_level, own) == (-level, node)
        for k in range(len(children)):
            child = node * ARITY + k
            heapq.heappush(queue, (-_last(-level - 1, child, nodes), level + 1, child,
                                   ["".join(children[:k]), *lefts], ["".join(children[k + 1:]), *rights]))
    return out[::-1]


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, starts in whole(batches, BLOCK_KEY):
        digests, at, n = (rows[c].to_pylist() for c in ("digest", "at", "n"))
        made = [forward(digests[a:b], at[a], n[a])[0] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        first = rows.take(starts[:-1])
        yield pa.RecordBatch.from_arrays([
            first["tree"].combine_chunks(), first["block"].combine_chunks(),
            pa.array([math.ceil(k / BLOCK) for k in first["n"].to_pylist()], pa.int64()), pa.array(made)], ["tree", "at", "n", "digest"])


def _proofs(names: list[str]):
    """Rows of nodes with their proofs, from rows in which each block begins with the message to its top (``at`` -1)."""
    def run(batches):
        for rows, starts in whole(batches, BLOCK_KEY):
            digests, at, n = (rows[c].to_pylist() for c in ("digest", "at", "n"))
            lefts, rights, roots = [], [], []
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                told = rows.slice(a, 1)
                _, inner = forward(digests[a + 1:b], at[a + 1], n[a + 1])
                for left, right in backward(inner, at[a + 1], b - a - 1, n[a + 1], told["lefts"][0].as_py(), told["rights"][0].as_py()):
                    lefts.append(left)
                    rights.append(right)
                roots.extend([told["subroot"][0].as_py()] * (b - a - 1))
            kept = rows.filter(pc.greater_equal(rows["at"], 0))
            made = {"lefts": pa.array(lefts, pa.list_(pa.string())), "rights": pa.array(rights, pa.list_(pa.string())),
                    "subroot": pa.array(roots, pa.string())}
            columns = [made[x] if x in made else kept[x] for x in names]
            yield from pa.table(columns, names=names).to_batches(max_chunksize=4096)
    return run


def _blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY, "at")


def _block(at: str = "at") -> Column:
    return F.floor(F.col(at) / BLOCK).cast("long").alias("block")


def climb(nodes: DataFrame, largest: int, stage: Stage) -> list[DataFrame]:
    """Tables of nodes (tree, at, n, digest), from the leaves to the roots, one of ``BLOCK`` times fewer after each sweep."""
    tables = [nodes]
    while largest > 1:
        rows = tables[-1].select("tree", _block(), "at", "n", "digest")
        tables.append(stage(_blocks(rows).mapInArrow(_tops, "tree long, at long, n long, digest string"), f"nodes_{len(tables)}"))
        largest = -(-largest // BLOCK)
    return tables


def descend(tables: list[DataFrame], messages: DataFrame, stage: Stage) -> DataFrame:
    """The leaves with their proofs, from the messages to the roots (tree, at, lefts, rights, subroot)."""
    for turn, nodes in enumerate(reversed(tables)):
        if turn == 0 and len(tables) > 1:
            continue  # roots: nothing above them but the messages
        told = messages if len(tables) > 1 else messages.withColumn("at", F.lit(0).cast("long"))
        rows = nodes.withColumn("block", _block()).unionByName(
            told.select("tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), *PROOF.fieldNames()), allowMissingColumns=True)
        kinds = nodes.schema
        out = StructType([*kinds.fields, *PROOF.fields])
        found = _blocks(rows).mapInArrow(_proofs(out.fieldNames()), out)
        messages = found if nodes is tables[0] else stage(found.select("tree", "at", *PROOF.fieldNames()), f"proofs_{turn}")
    return messages


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "source", order: str = "doc_id",
             also: dict[str, Column] | None = None, stage: Stage | None = None) -> DataFrame:
    """One row per row of ``docs``: ``order``, ``group``, leaf, subroot, root, lefts, rights and the columns of ``also``.

    A leaf is the digest of ``columns``. Each group has a tree over its leaves in order of ``order`` (nulls first, then by the
    digest, so repeated rows stand side by side), in which every ``ARITY`` consecutive nodes become their digest until one
    is left, the subroot; subroots in order of the group (null first, bytewise) have such a tree too, whose top is the root.
    ``lefts`` and ``rights`` are the digests before and after the path, joined level by level from the leaf to the root; both are
    empty for a table of one row. A null group is a group of its own. Empty tables have no rows. Extra columns are left out.
    """
    stage = stage or WrittenTables(docs.sparkSession)
    also = also or {}
    hashed = stage(docs.select(F.col(order).alias("_order"), F.col(group).cast("string").alias("_group"), leaf_digest([F.col(c) for c in columns]).alias("digest"),
                               *[c.alias(f"_also_{name}") for name, c in also.items()]), "hashed")  # so texts are read once
    leaves = with_row_number(hashed, ["_group", "_order", "digest"], "_row", stage=stage)
    groups = leaves.groupBy("_group").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("n"))
    groups = stage(with_row_number(groups, ["_group"], "_place", stage=stage).select(
        F.col("_group").alias("_name"), (F.col("_place") - 1).alias("tree"), "_first", "n"), "groups")
    largest, count = groups.agg(F.coalesce(F.max("n"), F.lit(0)), F.count(F.lit(1))).first()
    nodes = join_dim(leaves, groups, F.col("_group").eqNullSafe(F.col("_name")), bound=groups).select(
        "tree", (F.col("_row") - F.col("_first")).alias("at"), "n", "digest", "_order", "_group", *[f"_also_{c}" for c in also])
    nodes = stage(nodes, "leaves")

    trees = climb(nodes, largest, stage)
    subroots = stage(trees[-1].where(F.col("at") == 0).select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(count).cast("long").alias("n"), "digest"), "subroots")
    over = climb(subroots, count, stage)
    top = over[-1].select("digest").first()
    begin = over[-1].select("tree", "at", *[F.array().cast("array<string>").alias(c) for c in PROOF.fieldNames()[:2]], F.lit(None).cast("string").alias("subroot"))
    told = descend(over, begin, stage).select(F.col("at").alias("tree"), F.lit(0).cast("long").alias("at"), "lefts", "rights", F.col("digest").alias("subroot"))
    return descend(trees, told, stage).select(
        F.col("_order").alias(order), F.col("_group").alias(group), F.col("digest").alias("leaf"), "subroot",
        F.lit(top.digest if top else None).cast("string").alias("root"), "lefts", "rights", *[F.col(f"_also_{c}").alias(c) for c in also])
