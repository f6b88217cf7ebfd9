import re

import corpus_pipeline
from ledgerlake.llm.ngram_join import jaccard_classes
from ledgerlake.llm.toxicity import LIMIT, learned, train, with_toxicity

from .helpers import empty, stable, words

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_python(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, tables = docs, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns
        kept = stable(out, tmp_dir, f"stage{i}")
        tables[name] = kept.collect()
    model = train(docs, learned(spark.read.parquet(f"{SF}/labels.parquet")))
    scores = {r["id"]: r["_toxicity"] for r in with_toxicity(docs, model).selectExpr("_doc.doc_id AS id", "_toxicity").collect()}
    assert {r["doc_id"] for r in tables["toxicity"]} == {i for i, s in scores.items() if s < LIMIT}
    least = {}
    for r in tables["toxicity"]:
        t = re.sub(r"[\x20\x09-\x0D]+", " ", r["text"])
        least[t] = min(least.get(t, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in tables["exact dedup"]) == sorted(least.values())
    left = stable(spark.createDataFrame(tables["exact dedup"], docs.schema), tmp_dir, "left")
    classes = {r["doc_id"]: r["component_id"] for r in jaccard_classes(left).collect()}
    assert {r["doc_id"] for r in tables["near dedup"]} == {i for i, c in classes.items() if i == c}
    sizes, copies = {r["doc_id"]: len(words(r["text"])) for r in tables["near dedup"]}, {}
    for r in tables["mixing"]:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert max(copies.values()) <= 3 and set(copies) <= set(sizes)
    total = sum(sizes.values())
    assert abs(sum(sizes[i] * c for i, c in copies.items()) - total) < 0.35 * total  # few, long documents here
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    tokens = {r["doc_id"]: r["doc_tokens"] for r in pieces}
    assert sum(r["length"] for r in pieces) == sum(tokens[i] * c for i, c in copies.items())


def test_empty_tables(spark, tmp_dir):
    empty(spark).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0
