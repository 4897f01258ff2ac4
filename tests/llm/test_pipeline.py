import corpus_pipeline

from .helpers import docs_table, prose
from .test_decontaminate import item
from .test_toxicity import BAD, corpus


def test_stages_take_effect(spark, tmp_path):
    rows, labels = corpus(600)
    licence = "this licence line stands in many of the documents"
    rows = [(i, t + "\n" + licence) for i, t in rows]
    rows += [(1000, prose(2000, 200)), (1001, prose(2000, 200) + " end"), (1002, prose(2001, 150) + " " + item(1)), (1003, None), (None, prose(2002, 80))]
    docs = docs_table(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(k, item(k)) for k in range(5)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    steps, seen = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "byte_bpe":
            assert after.columns == docs.columns
        steps[name] = {r["doc_id"]: r for r in after.collect()}
        seen = after
    assert 1002 in steps["near_dedup"] and 1002 not in steps["decontaminate"]
    assert not any(b in (r["text"] or "") for r in steps["toxicity"].values() for b in BAD)
    assert sum(licence in (r["text"] or "") for r in steps["line_dedup"].values()) == 1
    assert {1000, 1001} <= set(steps["line_dedup"]) and {1000, 1001} & set(steps["near_dedup"]) == {1000}
    assert {i for i, _ in rows if i is not None and i < 600 and i % 6} == set(steps["byte_bpe"]) - {1000, 1003, None}
    final = sorted(map(repr, (tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())))
    assert final == sorted(map(repr, (tuple(r) for r in steps["byte_bpe"].values())))
