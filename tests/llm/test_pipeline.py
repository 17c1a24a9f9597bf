import corpus_pipeline
from sluice.llm import near_dup, toxicity
from sluice.llm.common import store

from .helpers import AWKWARD, documents, text_of
from .test_toxicity import corpus


def tables(spark, workdir, rows, labels, bench):
    documents(spark, rows, extra=True).write.parquet(f"{workdir}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{workdir}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{workdir}/benchmark.parquet")
    return str(workdir)


def test_every_stage_takes_effect(spark, workdir):
    rows, labels = corpus(300)
    leak, copy = text_of("leak", 12), text_of("copy", 80)
    rows = AWKWARD + rows + [(1000, f"see {leak} end"), (1001, copy), (1002, copy.upper()), (1003, 'password = "Sesame-1234"'), (1004, "vilew nastyw grossw")]
    where = tables(spark, workdir, rows, labels, [(1, leak)])
    docs = spark.read.parquet(f"{where}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, where), "t")
        seen.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        if name != "packing":
            assert docs.columns == columns, name
        if name == "secrets":
            r = docs.filter("doc_id = 1003").first()
            assert "Sesame" not in r["text"] and r["n_chars"] == len(r["text"])
    assert 1004 not in seen[0] and 1000 in seen[1] and 1002 not in seen[1] and 1001 in seen[1]
    assert 1000 not in seen[2] and seen[2] == seen[3] == seen[4] and {1, 5, 8, None} <= seen[4]
    assert [tuple(r) for r in corpus_pipeline.run(spark, where).select("doc_id", "start", "ids_crc32").sort("doc_id", "start").collect()] == [
        tuple(r) for r in docs.select("doc_id", "start", "ids_crc32").sort("doc_id", "start").collect()]


def test_empty_documents(spark, workdir):
    where = tables(spark, workdir, [], [], [])
    assert corpus_pipeline.run(spark, where).count() == 0


def test_stages_are_the_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    assert near_dup.SHINGLE == 5 and near_dup.THRESHOLD == 0.8 and toxicity.is_held_out(0) in (True, False)
