"""The stages against plain Python on a small corpus, and the registered SQL twins."""

import duckdb
import pytest

import corpus_pipeline
from shelfline.llm import rules
from shelfline.llm.queries import ORACLES, QUERIES
from shelfline.plans.staging import WrittenTables
from testbed.check import compare
from tests.llm import plain

SF = "/root/testdata/sf0.001"


def test_stages(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    train, learned = rules.train, []

    def once(*tables):
        learned.append(train(*tables))
        return learned[0]

    monkeypatch.setattr(rules, "train", once)
    out = {}
    with WrittenTables(spark) as stage_:
        for name, stage in corpus_pipeline.STAGES:
            docs = stage_(stage(spark, docs, SF), name.replace(" ", "_"))
            out[name] = docs.collect()
    kept = {r.doc_id for r in out["quality rules"]}
    assert len(learned) == 1
    assert kept == {r.doc_id for r in rules.judge(spark.read.parquet(f"{SF}/documents.parquet"), learned[0]).select("doc_id", "kept").collect() if r.kept}
    roots = plain.components([(i, texts[i]) for i in sorted(kept)], 5)
    assert {r.doc_id for r in out["near duplicates"]} == {i for i in kept if roots[i] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in out["near duplicates"]}
    assert {r.doc_id for r in out["decontamination"]} == {i for i in left if not any(plain.hits(texts[i], items, 10)[0])}
    for row in out["personal data"]:
        assert not plain.base_spans(row.text) and row.n_chars == len(row.text)
    assert len(out["token ids"]) == len(out["personal data"]) and all(r.round_trip and r.n_tokens == len(r.ids) for r in out["token ids"])


def test_contaminated_rows_go_one_by_one(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").first().text
    texts = [(1, f"before {item} after"), (1, "clean and short"), (None, item), (None, "clean too"), (None, None), (2, "")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in texts], "doc_id long, text string, row int")
    left = corpus_pipeline.decontaminate(spark, docs, SF)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(1, "clean and short"), (None, "clean too"), (None, None), (2, "")], key=str)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_sql_twins(spark, key):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    assert compare(QUERIES[key](spark, SF).toPandas(), con.execute(ORACLES[key]).df()) == ""


def test_every_operator_is_registered():
    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14))
