"""The pipeline's stages on a small table."""

from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.01"


def test_pipeline_runs_and_every_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    copy = docs.where("doc_id = 0").withColumn("doc_id", F.lit(10_000).cast("long"))
    null = docs.limit(1).select(*[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes])
    docs = docs.unionByName(copy).unionByName(null).withColumn("score", F.lit("extra"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "minhash near-dedup", "substring dedup", "mixing", "bpe"]
    names = docs.columns
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    calm = stages["toxicity"](spark, docs, SF)
    assert calm.columns == names and ids(calm) < ids(docs) and calm.where("score <> 'extra'").count() == 0
    single = stages["minhash near-dedup"](spark, docs, SF)
    assert single.columns == names and 10_000 not in ids(single) and {0, None} <= ids(single)
    cut = stages["substring dedup"](spark, docs, SF).cache()
    assert cut.columns == names and cut.count() == docs.count()
    assert cut.where("doc_id = 10000").first()["text"] == "" or docs.where("doc_id = 0").first()["text"].count(" ") < 12
    drawn = stages["mixing"](spark, docs, SF)
    assert drawn.columns == names and 0 < drawn.count() < docs.count()
    coded = stages["bpe"](spark, docs, SF)
    assert coded.columns == [*names, "ids"] and coded.where("ids is null").count() == 0


def test_pipeline_as_a_whole(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns[-1] == "ids" and 0 < found.count() < 1000
