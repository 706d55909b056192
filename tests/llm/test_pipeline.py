"""The corpus pipeline against the operators' own decisions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kelpline.llm import decontaminate, mixing, near_dedup, quality_pu, queries
from kelpline.llm.common import Scratch

SF = "/root/testdata/sf0.001"


def test_each_stage_works_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    scores = {r["doc_id"]: r["score"] for r in quality_pu.score(docs, quality_pu.train(docs, labels)).collect()}
    a = corpus_pipeline.quality(spark, docs, SF)
    assert ids(a) == {d for d, s in scores.items() if s >= 0.5}
    b = corpus_pipeline.near_copies(spark, a, SF)
    assert ids(b) == {r["doc_id"] for r in near_dedup.near_dedup(a).collect() if r["kept"]}
    c = corpus_pipeline.decontaminated(spark, b, SF)
    assert ids(c) == {r["doc_id"] for r in decontaminate.mark(b, items, "m").collect() if not r["m"]["contaminated"]}
    d = corpus_pipeline.mixed(spark, c, SF)
    assert d.columns == c.columns == b.columns == a.columns == docs.columns
    assert d.count() == sum(r["n"] for r in mixing.mix(c, info="i").selectExpr("doc_id", "i.n_copies AS n", "i.copy AS c").where("c = 1").collect())
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() == d.count()
    whole = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in queries.op1_token_records(spark, SF).collect()}
    assert all(whole[r["doc_id"]] == (r["n_tokens"], r["ids_crc32"]) for r in out.collect())


def test_records_keep_the_order_of_the_mix(spark):
    """Copies of one document don't lie side by side in the shards beyond chance."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.when(F.col("doc_id") % 8 == 0, "a").otherwise("b").alias("source"))
    copies = mixing.mix(docs, {"a": 0.9, "b": 0.1})
    ids = [r["doc_id"] for r in corpus_pipeline.tokens(spark, Scratch(spark, "test").save(copies), SF).orderBy("start").collect()]
    assert len(ids) == copies.count()
    beside = sum(a == b for a, b in zip(ids, ids[1:]))
    in_order = sorted(ids)
    assert beside < 0.1 * len(ids) < 0.5 * sum(a == b for a, b in zip(in_order, in_order[1:]))


def _odd(spark, at, rows):
    for name, own, kind in (
        ("documents", rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        ("benchmark", [(1, "one two three four"), (None, None)], "item_id bigint, text string"),
        ("labels", [(1, 1), (None, 1), (2, None)], "doc_id bigint, quality int"),
    ):
        spark.createDataFrame(own, kind).write.parquet(f"{at}/{name}.parquet")


@pytest.mark.parametrize("empty", [True, False])
def test_odd_and_empty_tables(spark, tmp_path, empty):
    text = "A clean sentence of some words that stands here. " * 3
    rows = [(1, text, "en", "s", 5), (1, text, "en", None, None), (2, text + "x", None, "s", 1), (None, text, "en", "s", 2), (3, None, "en", "s", 0), (4, "", "en", "t", 0), (5, "word " * 20_000, "en", "t", 1), (6, text, "en", "s", 1)]
    _odd(spark, tmp_path, [] if empty else rows)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert not (empty and out)
    assert all(r["n_tokens"] >= 1 for r in out)


def test_stages_stand_in_the_order_asked_for():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "decontaminated", "mixed", "tokens"]
