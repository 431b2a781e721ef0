from pyspark.sql import functions as F

import corpus_pipeline
from glyphmill.llm import toxicity


def test_the_stage_learns_from_every_pair(spark, make_docs, tmp_path, monkeypatch):
    """The model of the stage has the pairs of a single text too."""
    models, train = [], toxicity.train_toxicity
    monkeypatch.setattr(toxicity, "train_toxicity", lambda *a, **k: models.append(train(*a, **k)) or models[0])
    rows = [f"first{chr(97 + i % 26)}{chr(97 + i // 26)} second" for i in range(200)]
    labels = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = make_docs(rows)
    assert set(corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).columns) == set(docs.columns)
    learned = docs.filter(~toxicity._fold(F.col("doc_id")).isin(0, 4)).count()
    assert learned > 100 and len(models[0].pairs.low) == learned
