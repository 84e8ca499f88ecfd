"""Operator 5: the training sample is bounded for each language."""

from pyspark.sql import functions as F

from cropflow.llm import langid


def test_rare_languages_are_learned(spark):
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("common words "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    few = spark.createDataFrame([(30_001, "zzyx qqow", "xx"), (30_002, "qqow zzyx", "xx")], "doc_id long, text string, lang string")
    profiles = langid.learn_profiles(many.unionByName(few), max_training_docs=40)
    assert set(profiles) == {"en", "xx"}


def test_sample_without_ids_is_bounded(spark, monkeypatch):
    docs = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("ab"), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    rows = spark.sparkContext.accumulator(0)
    count = langid._count_grams

    def counted(batches):
        def seen():
            for b in batches:
                rows.add(b.num_rows)
                yield b
        yield from count(seen())

    monkeypatch.setattr(langid, "_count_grams", counted)
    assert langid.learn_profiles(docs, max_training_docs=200)
    assert 100 < rows.value < 300
