"""The class model against plain Python over the classes it chose."""

import collections
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import classes
from shelfline.plans.staging import WrittenTables
from tests.llm import plain


def corpus(spark, seed=7, rows=120):
    rng = np.random.default_rng(seed)
    kinds = [[f"{kind}{k}" for k in range(60)] for kind in ("a", "b", "cé")]
    texts = [" ".join(kinds[j % 3][int(60 * rng.random() ** 3)] for j in range(int(rng.integers(0, 40)))) for _ in range(rows)]
    texts += [None, "", "Only new words here", "a1 A1 a1"]
    return texts, spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("frequent", [None, 200, 3])
def test_scores_are_those_of_the_classes(spark, frequent):
    texts, docs = corpus(spark)
    train = {k for k in range(len(texts)) if k % 3}
    stage = WrittenTables(spark)
    model, rows = classes.fit(docs.withColumn("train", F.col("doc_id") % 3 != 0), stage, frequent)
    own = {r.doc_id: np.frombuffer(bytes(r.own), np.uint8) for r in rows.collect()}
    words = {k: [*plain.lower_words(t), "\n"] for k, t in enumerate(texts)}
    of = {}
    for k in words:  # a word has one class, wherever it stands
        for word, c in zip(words[k], own[k], strict=True):
            assert of.setdefault(word, c) == c
    counts = collections.Counter(w for k in train for w in words[k])
    pairs = collections.Counter((int(a), int(b)) for k in train for a, b in itertools.pairwise([of["\n"], *own[k]]))
    size = len(model.transitions)
    table = np.array([[pairs[a, b] for b in range(size)] for a in range(size)], float)
    into, out = table.sum(0), table.sum(1)
    plain_share = (into + 0.5) / (into.sum() + 0.5 * size)
    kinds = np.bincount([of[w] for w in counts], minlength=size)
    tokens, distinct = sum(counts.values()), len(counts)
    scored = {r.doc_id: r for r in classes.score(docs, F.col("doc_id") % 3 != 0, stage, frequent).collect()}
    for k, own_words in words.items():
        want = base = 0.0
        before = of["\n"]
        for word in own_words:
            c = of[word]
            want += math.log10((table[before, c] + classes.BACKOFF * plain_share[c]) / (out[before] + classes.BACKOFF))
            want += math.log10((counts[word] + 0.5) / (into[c] + 0.5 * (kinds[c] + 1)))
            base += math.log10((counts[word] + 0.5) / (tokens + 0.5 * (distinct + 1)))
            before = c
        assert scored[k].score == pytest.approx(want) and scored[k].base_score == pytest.approx(base)
        assert (scored[k].n_tokens, scored[k].n_known) == (len(own_words), sum(w in counts for w in own_words))
    assert sum(scored[k].score - scored[k].base_score for k in range(120) if k % 3 == 0) > 0  # held out


def test_probabilities_of_a_next_word_add_up(spark):
    texts, docs = corpus(spark)
    model, _ = classes.fit(docs.withColumn("train", F.lit(True)), WrittenTables(spark), 50)
    assert (10 ** model.transitions).sum(1) == pytest.approx(1)


def test_a_try_is_the_gain_of_the_whole_table():
    rng = np.random.default_rng(3)
    table = rng.integers(0, 9, (5, 5)).astype(float)
    out, into, both = rng.integers(0, 4, 5).astype(float), rng.integers(0, 4, 5).astype(float), 2.0
    seen = []
    for b in range(5):
        new = table.copy()
        new[b] += out
        new[:, b] += into
        new[b, b] += both
        seen.append(classes.gain(new))
    got = classes._tried(table, out, into, both)
    assert got - got[0] == pytest.approx(np.array(seen) - seen[0])


def test_exchange_never_makes_the_corpus_less_likely():
    rng = np.random.default_rng(4)
    for _ in range(5):
        pairs = rng.poisson(rng.random((30, 30)) ** 4 * 20)

        def likely(own, pairs=pairs):
            table = np.zeros((4, 4))
            np.add.at(table, (own[:, None], own[None, :]), pairs)
            return classes.gain(table)

        steps = [likely(classes.exchange(pairs, 4, rounds)) for rounds in range(7)]
        assert all(b >= a - 1e-9 for a, b in itertools.pairwise(steps)) and steps[-1] > steps[0]


def test_classes_grow_with_the_vocabulary():
    assert [classes.class_count(n) for n in (0, 10, 400_000, 10 ** 7, 10 ** 12)] == [16, 16, 48, 126, 255]
