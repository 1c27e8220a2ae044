import corpus_pipeline
from ingot.llm import mixing, tokens, toxicity
from tests.llm.test_operators import SF, contaminated, near, same


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(2)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    outs = []
    for _, stage in corpus_pipeline.STAGES:
        outs.append((docs, stage(spark, docs, SF).cache()))
        docs = outs[-1][1]
    for before, after in outs[:-1]:
        assert after.columns == before.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    before, after = outs[0]
    scores = toxicity.toxicity(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(after) == ids(scores.where("predicted = 0"))
    before, after = outs[1]
    assert ids(after) == sorted(d for d, *_, k in near([(r.doc_id, r.text) for r in before.collect()]) if k)
    before, after = outs[2]
    assert ids(after) == sorted(d for d, *_, c in contaminated([(r.doc_id, r.text) for r in before.collect()], [tuple(r) for r in bench.collect()]) if not c)
    before, after = outs[3]
    assert ids(after) == sorted(r.doc_id for r in mixing.mixture(before).collect() for _ in range(r.copies))
    before, after = outs[4]
    assert ids(after) == ids(before)
    same(after.collect(), tokens.token_table(before).collect())


def test_run_and_empty(spark, tmp_path):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 50
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").where("false").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
