"""The manifest against trees built in plain Python."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from shelfline.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """Root, and for each node the digests before and after the path at each level."""
    proofs, now, owners = [[] for _ in nodes], list(nodes), [[k] for k in range(len(nodes))]
    while len(now) > 1:
        above, owned = [], []
        for k in range(0, len(now), 3):
            run = now[k:k + 3]
            for at in range(len(run)):
                for leaf in owners[k + at]:
                    proofs[leaf].append(("".join(run[:at]), "".join(run[at + 1:])))
            above.append(digest(*run))
            owned.append(sum(owners[k:k + 3], []))
        now, owners = above, owned
    return now[0], proofs


def plain(rows):
    """[(doc_id, leaf, subroot, root, lefts, rights)] of (doc_id, source, lang, n_chars, text)."""
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0] or 0, digest(*map(told, row)), row[0]))
    trees = []
    for name in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        leaves = sorted(groups[name], key=lambda g: g[:3])
        trees.append((leaves, *tree([g[2] for g in leaves])))
    root, above = tree([t[1] for t in trees])
    return [(leaf[3], leaf[2], sub, root, [a for a, _ in own + up], [b for _, b in own + up])
            for (leaves, sub, proofs), up in zip(trees, above, strict=True) for leaf, own in zip(leaves, proofs, strict=True)]


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 2, "b": 3}, {None: 4, "": 1, "é": 28, "z": 10, "Z": 9}, {f"s{k}": 1 + k % 3 for k in range(60)},
                                   {"big": 2187 * 3 + 5, "b2": 2187, "b3": 2188, "small": 4}])
def test_like_plain_trees(spark, sizes):
    rows, k = [], 0
    for name, count in sizes.items():
        for _ in range(count):
            rows.append((k * 7919 % 100_003, name, None if k % 5 == 0 else "en", None if k % 7 == 0 else k, None if k % 11 == 0 else f"text é {k}\nmore"))
            k += 1
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = merkle.manifest(docs).withColumn("folded", merkle.fold(F.col("leaf"), F.col("lefts"), F.col("rights"))).collect()
    assert all(r.folded == r.root for r in found)
    got = [(r.doc_id, r.leaf, r.subroot, r.root, r.lefts, r.rights) for r in found]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_messy_rows(messy, nothing):
    docs = messy.withColumns({"source": F.col("kept"), "lang": F.lit(None).cast("string"), "n_chars": F.length("text")})
    docs = docs.withColumnRenamed("label", "subroot").withColumnRenamed("at", "tree")  # clash with the operator's own
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = [(r.doc_id, r.leaf, r.subroot, r.root, r.lefts, r.rights) for r in merkle.manifest(docs, also={"digest": F.length("text")}).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)
    assert merkle.manifest(docs.limit(0)).collect() == []


def test_any_change_is_told(spark):
    rows = [(k, f"s{k % 3}", "en", k, f"text {k}\n") for k in range(50)]
    docs = spark.createDataFrame(rows, SCHEMA)
    changed = merkle.leaf_digest([F.lit("x") if c == "lang" else F.col(c) for c in merkle.COLUMNS])
    found = merkle.manifest(docs, also={"changed": changed}).withColumn("folded", merkle.fold(F.col("changed"), F.col("lefts"), F.col("rights")))
    assert found.where("folded = root").count() == 0


@pytest.mark.parametrize("nodes", [1, 2, 3, 4, 9, 10, 27, 28, 100])
def test_the_queue_stays_short(nodes, monkeypatch):
    most = 0
    push = merkle.heapq.heappush

    def watched(queue, item):
        nonlocal most
        push(queue, item)
        most = max(most, len(queue))

    monkeypatch.setattr(merkle.heapq, "heappush", watched)
    top, inner = merkle.forward([digest(str(k)) for k in range(nodes)], 0, nodes)
    proofs = merkle.backward(inner, 0, nodes, nodes, [], [])
    root, want = tree([digest(str(k)) for k in range(nodes)])
    assert top == root and [list(zip(a, b, strict=True)) for a, b in proofs] == want
    assert most <= 3 * max(1, merkle.height(nodes))
