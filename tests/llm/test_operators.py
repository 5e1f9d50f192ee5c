"""Each operator on messy rows, empty tables and small made-up cases, against plain Python or the public libraries."""

import base64
import collections
import json
import math

import numpy as np
import public_tokenizers as tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm import byte_bpe, classes, licenses, minhash, pii, positions, rules, substrings, token_files, toxicity
from shelfline.llm.arrays import KEEP_CASE, split_words
from tests.llm import plain
from tests.llm.conftest import TEXTS

KNOWN = [(i, t) for i, t in TEXTS if i is not None]


def by_id(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_words_are_cut_like_the_pattern():
    @given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0c\r\x1caBé日-", max_size=40)), max_size=6))
    @settings(max_examples=60, deadline=None)
    def check(texts):
        words = split_words(pa.array(texts, pa.string()), KEEP_CASE)
        vocab = [w.decode() for w in words.vocab.to_pylist()]
        got = [[vocab[c] for c in words.codes[a:b]] for a, b in zip(words.starts[:-1], words.starts[1:], strict=True)]
        assert got == [plain.WORD.findall(t or "") for t in texts]
    check()


def test_near_duplicates(messy, nothing):
    got = minhash.near_duplicates(messy, words=2).collect()
    assert len(got) == len(TEXTS)
    want = plain.components(KNOWN[:-3] + KNOWN[-2:], 2)
    for row in got:
        if row.doc_id is not None:
            assert row.component_id == want[row.doc_id] and row.kept == (row.doc_id == row.component_id)
    assert {r.n_shingles for r in got if r.doc_id in (4, 5, 6)} == {0}
    assert minhash.near_duplicates(nothing).count() == 0
    assert minhash.first_of_each(nothing).count() == 0 and minhash.first_of_each(messy).columns == messy.columns


def test_rows_without_an_id_are_linked_one_by_one(spark):
    a, b, c, d = ([f"{name}{k}" for k in range(60)] for name in "abcd")
    near = lambda words, k: " ".join([*words[:-1], f"other{k}"])
    texts = [(5, " ".join(a)), (None, near(a, 1)), (None, near(a, 2)), (None, " ".join(b)), (None, " ".join(b)), (None, near(b, 1)),
             (7, " ".join(c)), (7, " ".join(c)), (7, " ".join(d)), (None, None), (None, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, label string, n int").repartition(4)
    got = minhash.near_duplicates(docs, words=5).collect()
    assert {r.component_id for r in got if r.n_shingles} == {5, 7, None} and len(got) == len(texts)
    assert sum(r.component_id == 5 for r in got) == 3 and sum(r.kept for r in got) == len(texts) - 2
    left = sorted(((r.doc_id, r.text) for r in minhash.first_of_each(docs, words=5).collect()), key=str)
    lone = [t for i, t in left if i is None and t]
    assert len(lone) == 1 and lone[0].startswith("b0 ")
    assert [x for x in left if x[0] is not None or x[1] is None] == sorted(
        [(5, " ".join(a)), (7, " ".join(c)), (7, " ".join(d)), (9, ""), (None, None), (None, None)], key=str)


def test_links_across_blocks_are_found(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for i in range(60):
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 12)):
            words[at] = f"x{i}y{at}"
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = plain.components(texts, 2)
    monkeypatch.setattr(minhash, "BLOCK_ITEMS", 1500)  # so the one group takes several blocks
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, words=2).collect()}
    assert got == want and len(set(want.values())) > 1


def test_estimate_follows_similarity():
    rng = np.random.default_rng(2)
    odd, add = minhash._hash_family()
    shared, a, b = (rng.integers(0, 2 ** 63, n, np.uint64) for n in (800, 100, 100))
    sig = [minhash.pack(minhash.minima(np.concatenate([shared, x]), odd, add)) for x in (a, b)]
    assert minhash.estimates(sig[0], sig[1][None])[0] == pytest.approx(0.8, abs=0.12)
    assert minhash.estimates(sig[0], sig[0][None])[0] == 1.0


def test_toxicity(spark, messy, nothing):
    bad = ["scumword", "idiotword", "trashword"]
    rng = np.random.default_rng(3)
    rows = [(k, " ".join([f"w{x}" for x in rng.integers(0, 50, 30)] + ([bad[k % 3]] if k % 4 == 0 else []))) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)] + [(None, 1), (7, None)], "doc_id long, label int")
    model = toxicity.train(docs, labels)
    seen = set().union(*[set(at.tolist()) for _, at in toxicity.features(pa.array([t for k, t in rows if k < 400]))])
    assert 1 < len(model) < 0.6 * len(seen)  # the L1 term leaves many features without a weight
    scored = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [(scored[k] >= 0.3) == (k % 4 == 0) for k in range(400, 600)]
    assert sum(held) / len(held) > 0.97
    out = toxicity.score(messy, model)
    assert out.columns == [c for c in messy.columns if c != "score"] + ["score"]
    assert all(0 <= r.score <= 1 for r in out.collect()) and out.count() == len(TEXTS)
    assert toxicity.train(nothing, labels) == {toxicity.BIAS: 0.0}
    assert toxicity.score(nothing, model).count() == 0


def test_token_files(spark, tmp_path, messy, nothing):
    path = tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = messy.where("doc_id is not null")
    parts = token_files.write_token_files(rows, str(tmp_path / "a"), path)
    got = sorted(token_files.read_token_files(spark, str(tmp_path / "a"), parts).collect(), key=lambda r: (r.doc_id, r.start))
    start = 0
    for row, (doc, text) in zip(got, KNOWN, strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids + [1]
        assert (row.doc_id, row.start, np.frombuffer(row.ids, "<u4").tolist()) == (doc, start, want)
        start += len(want)
    parts = token_files.write_token_files(messy, str(tmp_path / "b"), path)
    got = sorted(token_files.read_token_files(spark, str(tmp_path / "b"), parts).collect(), key=lambda r: r.start)
    encoded = [(i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in TEXTS]
    first = [x for x in encoded if x[0] is None]
    assert 0 < len(first) and all(r.doc_id is None for r in got[:len(first)])
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in got[:len(first)]) == sorted(ids for _, ids in first)
    assert [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got[len(first):]] == [x for x in encoded if x[0] is not None]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    empty = token_files.write_token_files(nothing, str(tmp_path / "c"), path)
    assert token_files.read_token_files(spark, str(tmp_path / "c"), empty).count() == 0


def test_words_or_whole_texts_give_the_same_ids():
    with open(tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        description = file.read()
    encoder = token_files.WordEncoder(description)
    whole = token_files.WordEncoder(description)
    whole.by_word = False
    assert encoder.by_word

    @given(st.lists(st.text(alphabet="aB' \n\té́Σ日😀<|>endoftx1٣-.", max_size=30), max_size=5))
    @settings(max_examples=60, deadline=None)
    def check(texts):
        one, two = encoder.encode(pa.array(texts, pa.string()), 1), whole.encode(pa.array(texts, pa.string()), 1)
        assert one[0].tolist() == two[0].tolist() and one[1].tolist() == two[1].tolist()
    check()


def test_words_cut_by_kind_give_the_same_ids_and_few_go_through_the_whole_tokenizer(monkeypatch):
    with open(tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        description = file.read()
    library, encoder = Tokenizer.from_str(description), token_files.WordEncoder(description)
    other = json.loads(description)
    other["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] += "|x"
    assert token_files.cuts_by_kind(description) and not token_files.cuts_by_kind(json.dumps(other))

    @given(st.lists(st.text(alphabet="aHhJsSrtevELlLmdD'#.$ \n\x7f\x1c19éÉßÿ×÷Þ\u0331\u0308\u0338\u030c\u0307\u0345ΣİﬁＡ€日٣\u00a0\u0085\u1100\u1161", max_size=12), max_size=8))
    @settings(max_examples=400, deadline=None)
    def check(texts):
        ids, at = encoder.encode(pa.array([*texts, *told], pa.string()), 1)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [library.encode(t, add_special_tokens=False).ids + [1] for t in [*texts, *told]]
    told = []
    check()
    told = ["x<|endoftext|>y'S", "X<|ENDOFTEXT|>H\u0331"]
    check()
    broken = pa.array([b"ab\xc3", b"\x80#a", b"\xe3\xc3\x80#", b"\xff'S1"]).view(pa.string())  # not UTF-8
    ids, at = encoder.encode(broken, 1)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [
        library.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids + [1] for t in broken.view(pa.binary()).to_pylist()]

    encoder, seen = token_files.WordEncoder(description), []
    whole = encoder._batch
    monkeypatch.setattr(encoder, "_batch", lambda texts: seen.extend(texts) or whole(texts))
    words = [f"{w}{mark}" for w in ("unless", "Unless", "UNLESS", "Ünless", "ünless") for mark in ("", ",", "###", "###1")]
    ids, _ = encoder.encode(pa.array([" ".join(words)]), 1)
    assert ids.tolist() == library.encode(" ".join(words), add_special_tokens=False).ids + [1]
    assert sorted(seen) == ["###", ",", "1"]  # all twenty words, before


def test_licenses(spark, nothing):
    docs = spark.createDataFrame([(1, "some text\nLICENSED UNDER the Apache Licence, version 2.0"), (2, "Copyright 2020 X\nReleased under the MIT License"),
                                  (3, None), (4, "Released under no licence"), (None, "Released under the MIT License."), (1, "x")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.whole_license, r.licenses) for r in licenses.scan(docs, licenses.known_notices(spark)).collect()), key=str)
    assert got == [(1, None, ["Apache-2.0"]), (1, None, ["Apache-2.0"]), (2, "MIT", ["MIT"]), (3, None, []), (4, None, []), (None, None, [])]
    assert licenses.scan(nothing, licenses.known_notices(spark)).count() == 0


def test_substrings(messy, nothing):
    rows = messy.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in substrings.remove_repeats(rows, window=5).collect()}
    for doc, words, flags in plain.removed(sorted(dict(KNOWN).items()), 5):
        assert (got[doc].n_words, got[doc].n_removed) == (len(words), sum(flags))
        assert got[doc].kept_text == " ".join(w for w, f in zip(words, flags, strict=True) if not f)
    every = substrings.remove_repeats(messy, window=5)
    assert every.count() == len(TEXTS)
    assert {r.n_removed for r in every.where("doc_id = 14").collect()} == {10}  # its own repeats; the same row twice is no repeat
    assert substrings.remove_repeats(nothing).count() == 0


def test_hash_ties_are_told_apart_by_words():
    codes = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3])
    at = np.array([0, 3, 6])
    assert substrings.repeats(np.zeros(3, np.uint64), codes, at, 3).tolist() == [False, False, True]


def test_quality_statistics_and_rules(spark, messy, nothing):
    got = rules.text_statistics(messy.select("doc_id", "text")).collect()
    for row in got:
        words = plain.WORD.findall(row.text or "")
        lines = [x for x in (row.text or "").split("\n") if plain.WORD.search(x)]
        assert (row.n_words, row.word_chars, row.n_dup_lines, row.n_repeat_words) == (
            len(words), sum(map(len, words)), len(lines) - len(set(lines)), plain.repeat_words(words))
        assert row.n_symbols == sum(c in "#*$%&|<>" for c in row.text or "")
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(f"word{x}" + ("###" if k % 5 == 0 else "") for x in rng.integers(0, 500, 40)), int(k % 5 != 0)) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    learned = rules.train(docs.drop("quality"), docs.drop("text"))
    assert len(learned) == 1 and learned[0][0].feature in ("symbol_share", "mean_word")
    kept = {r.doc_id for r in rules.keep(docs, learned).collect()}
    assert kept == {k for k in range(400) if k % 5}
    assert rules.judge(messy, learned).count() == len(TEXTS)
    assert rules.train(nothing, docs.drop("text")) == [] and rules.judge(nothing, []).count() == 0


def test_phrases_and_proximity(spark, messy, nothing):
    items = [(1, "cat sat on the mat"), (2, "Sat, on; the"), (3, ""), (4, None), (None, "the cat"), (5, "w5x5 w6x6 w7x7 w8x8 w9x9"), (5, "日本語")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    index = positions.build_index(messy)
    for block in (positions.BLOCK_BYTES, 20):  # one block, and several
        got = positions.phrase_matches(index, bench, window=4, block_bytes=block).collect()
        assert len(got) == len(TEXTS)
        texts = dict(TEXTS)
        for row in got:
            if row.doc_id is not None:
                flags, found = plain.hits(texts[row.doc_id], [i for i in items if i[0] is not None], 4)
                covered = {k for a, b in zip(row.spans[::2], row.spans[1::2], strict=True) for k in range(a, b)}
                assert (row.n_words, covered, row["items"]) == (len(flags), {k for k, f in enumerate(flags) if f}, found)
    near = positions.proximity_matches(index, ["mat", "cat", "looked"], 7).where("doc_id < 4").collect()
    assert sorted(map(tuple, near)) == [(k, *span) for k in (1, 2, 3) for span in ((1, 7), (5, 11))]
    assert positions.proximity_matches(index, ["mat", "absent"], 9).count() == 0
    assert positions.contamination(nothing, bench).count() == 0
    assert positions.contamination(messy, bench.limit(0)).where("contaminated").count() == 0


def test_personal_data(spark, messy, nothing):
    tricky = ["a@b.c@d.e", "x@y.zz_w@q.com", "1.2.3.4.5.6.7.8", "001.2.3.4 256.1.1.1", "+1 +12 (345) 678-90123)", "4111-1111-1111-1111 4111111111111112",
              "9" * 6000, "a" * 6000 + "@", "@" * 3000, "1-" * 3000, "+" + "1." * 3000]
    texts = dict(TEXTS) | {100 + k: t for k, t in enumerate(tricky)}
    docs = messy.unionByName(spark.createDataFrame([(100 + k, t) for k, t in enumerate(tricky)], "doc_id long, text string"), allowMissingColumns=True)
    found = pii.find(docs).collect()
    assert len(found) == len(TEXTS) + len(tricky)
    for row in found:
        if row.doc_id is not None:
            assert [tuple(x) for x in row.base] == plain.base_spans(texts[row.doc_id]), texts[row.doc_id][:40]
    masked = pii.mask(messy)
    assert masked.columns == messy.columns
    rows = masked.collect()
    text = {r.doc_id: r.text for r in rows}
    assert len(rows) == len(TEXTS) and text[13].endswith("mail <EMAIL> or <PHONE> at <IP> with <CARD>.") and text[4] is None
    assert pii.find(nothing).count() == 0


def test_contexts_find_unseen_identifiers(spark):
    rows = [(k, f"please write to a{k}b@firm{k}.example.com today") for k in range(12)]
    rows += [(100, "please write to a99b@firm99 today"), (101, "the plan is b2b22x today"), (102, "in room desk77-firm77 nobody sits")]
    got = {r.doc_id: [tuple(x) for x in r.spans] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [x[0] for x in got[0]] == ["email"] and got[101] == got[102] == []
    # an address without a top-level domain is in no base format; its context and make-up are those of the seeds but for the dot
    assert got[100] in ([], [("email", 16, 27)])


def test_confident_patterns_spread(spark):
    seeds = [("to 9", f"seed{k}", "card", 1) for k in range(8)] + [("to 9", "new", None, 3), ("rare 9", "new", None, 1), ("rare 9", "other", None, 9)]
    edges = spark.createDataFrame(seeds, "pattern string, instance string, kind string, n int")
    best = pii._bootstrap(edges, lambda df, name: df).collect()
    assert best == []  # eight of twelve is not enough
    strong = spark.createDataFrame([("to 9", f"seed{k}", "card", 1) for k in range(20)] + [("to 9", "new", None, 1)], edges.schema)
    (row,) = pii._bootstrap(strong, lambda df, name: df).collect()
    assert (row.pattern, row.kind) == ("to 9", "card") and row.confidence > 0.9


def test_byte_bpe_is_tiktoken(messy, nothing):
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = byte_bpe.decode(byte_bpe.encode(messy, path, tokenizers.PATTERN), path)
    for row in out.collect():
        assert row.ids == library.encode_ordinary(row.text or "") and bytes(row.decoded) == (row.text or "").encode()
    assert byte_bpe.encode(nothing, path, tokenizers.PATTERN).count() == 0
    vocabulary, pattern = byte_bpe.Vocabulary(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items())), regex.compile(tokenizers.PATTERN)
    letters = np.random.default_rng(5).choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOP"), 1_000_000)
    for text in ("".join(letters), "a" * 1_000_000, "x " + "é" * 5_000 + " the end", "".join(letters[:byte_bpe.WIDE + 1])):
        assert byte_bpe.encode_texts(pa.array([text]), vocabulary, pattern)[0].tolist() == library.encode_ordinary(text)

    @given(st.text(alphabet="aab bcT'sx\n\t\r 　\x1c0 é日😀--__", max_size=60))
    @settings(max_examples=150, deadline=None)
    def check(text):
        assert byte_bpe.encode_texts(pa.array([text]), vocabulary, pattern)[0].tolist() == library.encode_ordinary(text)
    check()


def test_class_scores(spark, messy, nothing):
    train = F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False))
    got = classes.score(messy, train).collect()
    assert len(got) == len(TEXTS)
    tokens = [w for i, t in TEXTS if i is not None and i % 2 == 0 for w in [*plain.lower_words(t), "\n"]]
    counts = collections.Counter(tokens)
    texts = dict(TEXTS)
    for row in got:
        if row.doc_id is not None:
            own = [*plain.lower_words(texts[row.doc_id]), "\n"]
            base = sum(math.log10((counts.get(w, 0) + 0.5) / (len(tokens) + 0.5 * (len(counts) + 1))) for w in own)
            assert (row.n_tokens, row.n_known, row.train_tokens) == (len(own), sum(w in counts for w in own), len(tokens))
            assert row.base_score == pytest.approx(base) and row.score < 0
    assert classes.score(nothing, F.lit(True)).count() == 0
    assert all(r.score < 0 for r in classes.score(messy, F.lit(False)).collect())


def test_exchange_finds_alternating_classes():
    pairs = np.zeros((6, 6))
    pairs[:3, 3:] = pairs[3:, :3] = 10
    own = classes.exchange(pairs, classes=2)
    assert len(set(own[:3])) == len(set(own[3:])) == 1 and own[0] != own[3]


def test_rare_words_get_classes_by_their_neighbours(spark):
    """Words beyond the most frequent ones, all with one ending: two kinds that always stand in turn."""
    rng = np.random.default_rng(5)
    often = [[f"{kind}{k}" for k in range(200)] for kind in "ab"]
    rare = [[f"{kind}{k}zz" for k in range(150)] for kind in "pq"]
    texts = [" ".join(w for a, b in zip(rng.integers(0, 200, 40), rng.integers(0, 200, 40), strict=True) for w in (often[0][a], often[1][b]))
             for _ in range(100)]
    texts += [f"{often[0][k]} {rare[1][k]} {often[0][k + 1]} {often[1][k]} {rare[0][k]} {often[1][k + 1]}" for k in range(150) for _ in range(3)]
    turns = " ".join(f"{a} {b}" for a, b in zip(*rare, strict=True))
    docs = spark.createDataFrame([*enumerate(texts), (-1, turns), (-2, " ".join(rare[0] + rare[1]))], "doc_id long, text string")
    got = {r.doc_id: r for r in classes.score(docs, F.col("doc_id") >= 0).where("doc_id < 0").collect()}
    assert got[-1].base_score == pytest.approx(got[-2].base_score) and got[-1].n_known == got[-2].n_known == 301
    assert got[-1].score > got[-2].score + 20  # as likely as each other if a hash of the ending gives the class


def test_strays_of_a_cut_group_are_dealt_in_bounded_tasks(spark, monkeypatch):
    """Texts that share a passage but are mostly not linked: almost the whole group is stray, and no task may hold it all."""
    passage, texts = " ".join(f"p{k}" for k in range(60)), []
    for i in range(200):
        own = " ".join(f"x{i // 2 if i < 40 else i}y{k}" for k in range(25))
        texts.append((i, f"{passage} {own}" + (f" z{i}" if i < 40 else "")))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    make, most = minhash._link_blocks, 4 * 1500

    def bounded(percent):
        run = make(percent)

        def held(table):
            size = sum(len(x) // 8 for x in table["items"].to_pylist())
            assert size <= most, f"a task holds {size} shingles"
            return run(table)
        return held

    monkeypatch.setattr(minhash, "BLOCK_ITEMS", 1500)
    monkeypatch.setattr(minhash, "_link_blocks", bounded)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, words=2).collect()}
    assert got == plain.components(texts, 2) and len(set(got.values())) == 180


def test_contexts_find_phones_cards_and_addresses_of_other_forms(spark):
    contexts = {"phone": ("call them on {} after noon", [f"+1 (2{k:02}) 555-01{k:02}" for k in range(12)], ["(555) 123-4567", "020 7946 0958"]),
                "card": ("paid by card {} last week", [f"4111 1111 11{k:02} 1{k % 10}0{k % 7}" for k in range(99)], ["4111 1111 1111 11"]),
                "email": ("please write to {} today", [f"a.{c}@firm.example.com" for c in "abcdefghijkl"], ["john@intranet"])}
    rows, want = [], {}
    for kind, (frame, seeds, planted) in contexts.items():
        for text in seeds:
            if plain.base_spans(frame.format(text)):  # of the cards, those that pass the check
                rows.append((len(rows), frame.format(text)))
        for text in planted:
            rows.append((len(rows), frame.format(text)))
            start = frame.index("{}")
            want[rows[-1][0]] = [(kind, start, start + len(text))]
    rows.append((len(rows), "the sum of 123 456 789 is not said by anyone"))
    got = {r.doc_id: [tuple(x) for x in r.spans] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: got[k] for k in want} == want and got[len(rows) - 1] == []


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING
FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def test_whole_licence_texts_are_known(spark):
    """With another holder and other line breaks, one of them before the word copyright inside a sentence."""
    words = MIT.replace("sublicense", "sublicence").replace("\n", " ")
    docs = spark.createDataFrame([(1, f"The MIT License (MIT)\n\nCopyright (c) 1999 Someone Else\n\n{MIT}\n"),
                                  (2, "© 2021 X\n" + words.replace("The above copyright notice", "The above\ncopyright notice")),
                                  (3, MIT.replace("free of charge", "for a fee")), (4, None)], "doc_id long, text string")
    frame = licenses.scan(docs, licenses.known_notices(spark), licenses.known_texts(spark))
    got = {r.doc_id: (r.whole_license, r.licenses) for r in frame.collect()}
    assert got == {1: ("MIT", ["MIT"]), 2: ("MIT", ["MIT"]), 3: (None, []), 4: (None, [])}
