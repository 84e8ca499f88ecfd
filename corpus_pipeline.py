"""Corpus pipeline: STAGES applied in order to ``documents``, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and works on every row of ``docs``. Null
texts and ids, repeated rows and empty tables pass through as the operators
define them; columns beyond those of ``documents`` are dropped by the first stage. Texts of any
length are handled whole, a batch of a few rows being as large as its longest text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cropflow.llm import decontaminate, jaccard, langid, mixing, suffixes
from cropflow.llm.store import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: A prediction that contradicts a document's label counts from this score on (the best language is half as near again as the second).
CLEAR = 0.6
#: Words of a passage that repeats are about six bytes: passages of over 50 words have at least this many bytes.
PASSAGE_BYTES = 256
#: Texts handed to Python at once; a long text makes a batch large enough.
BATCH_ROWS = 1_000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents without an identifiable language (null text, no letters) go, and those
    whose text is clearly in another language than ``lang`` says; a missing ``lang`` is filled in.

    Profiles are learned from the stage's labelled rows. Without any, nothing is judged and all stay."""
    _small_batches(spark)
    profiles = langid.learn_profiles(docs.where(~langid.held_out()))
    if not profiles:
        return docs.select(*COLUMNS)
    found = langid.identify(docs.select(*COLUMNS), profiles, keep=tuple(COLUMNS))
    mislabelled = F.coalesce((F.col("lang") != F.col("lang_pred")) & (F.col("score") >= CLEAR), F.lit(False))
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & ~mislabelled)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each component of linked texts the row with the smallest id stays; a row without
    an id only if no row of its component has one. Rows are compared under a hash of id, text and
    source, so a repeated id joins no unlinked texts; texts without words are linked with nothing and stay."""
    _small_batches(spark)
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    null = [F.col(c).isNull() for c in ("doc_id", "source")]  # a hash alone passes over nulls
    keyed = docs.select(*COLUMNS, F.xxhash64("doc_id", "text", "source", *null).alias("key")).where(worded)
    linked = jaccard.linked_components(keyed.select(F.col("key").alias("doc_id"), "text"))
    linked = linked.select(F.col("doc_id").alias("linked_key"), "component_id").distinct()
    place = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", F.xxhash64("text").alias("h"), "source", "key")
    places = keyed.select("key", place.alias("place")).groupBy("key").agg(F.min("place").alias("place"))
    joined = places.join(linked.hint("shuffle_hash"), F.col("key") == F.col("linked_key"))
    first = joined.groupBy("component_id").agg(F.min("place").alias("place")).select(F.col("place.key").alias("kept_key"))
    # equal rows are cut to one within each task before they are shuffled
    one = F.row_number().over(Window.partitionBy("key").orderBy("lang", "n_chars"))
    rows = keyed.withColumn("nth", one).where("nth = 1")
    stays = rows.join(first.hint("shuffle_hash"), F.col("key") == F.col("kept_key"), "left_semi")
    return stays.select(*COLUMNS).unionByName(docs.where(~worded).select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of repeated strings of PASSAGE_BYTES the first stays (by id, none last), the bytes of the
    others are cut out; documents emptied by that go."""
    _small_batches(spark)
    cut = suffixes.deduplicate(docs, carry=["lang", "source", "n_chars"], window=PASSAGE_BYTES, keep_first=True)
    changed = F.col("n_removed") > 0
    return cut.where(~changed | (F.col("n_removed") < F.col("n_bytes"))).select(
        "doc_id", F.col("kept_text").alias("text"), "carried.lang", "carried.source",
        F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("carried.n_chars")).alias("n_chars"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that leak a benchmark item go."""
    _small_batches(spark)
    return decontaminate.without_leaks(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: the documents that the mix takes, one row per pass over a document, in training order.

    Returns doc_id, text, lang, n_chars, size (words), taken (words the mix counts of this pass)
    and position (training time from 0 to 1). The mix is planned without texts; its passes are
    joined to them by two hashes of id and text, and equal rows share their passes.
    """
    keyed = docs.select("doc_id", "text", "lang", "source", "n_chars", F.xxhash64("doc_id", "text").alias("k1"), F.hash("text").alias("k2"))
    plan = mixing.mix(mixing.sized(keyed, "k1", "k2"))
    two = F.array(F.struct(F.col("taken_first").alias("taken"), F.col("position").alias("position")),
                  F.struct(F.col("taken_again").alias("taken"), F.col("position_again").alias("position")))
    passes = plan.where("taken > 0").groupBy("k1", "k2").agg(
        F.first("size").alias("size"), F.flatten(F.collect_list(F.filter(two, lambda x: x["taken"] > 0))).alias("passes"))
    nth = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("doc_id"))
    found = keyed.join(passes.hint("shuffle_hash"), ["k1", "k2"]).withColumn("nth", nth).where("nth = 1")
    rows = found.withColumn("pass", F.explode("passes"))
    return rows.select("doc_id", "text", "lang", "n_chars", "size", "pass.taken", "pass.position").orderBy("position", "doc_id")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("mixed", mixed),
]

#: Suffix arrays, language profiles and fingerprints are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
