"""The corpus pipeline: raw documents to packed training sequences.

Each stage is written as Parquet and read again as the next one's documents;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.llm import language_id, packing, parity_join, pii, winnowing
from meterwise.llm.common import release_workers, ship, small_batches, table, written
from meterwise.llm.queries import held_out, vocabulary

#: No stage but the third can be said in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def ready(spark: SparkSession) -> None:
    """Stages share executors: each starts with bounded batches and without what the one before remembered in Python workers."""
    ship(spark)
    small_batches(spark)
    release_workers(spark)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language can be told; null and letterless texts are rejected."""
    ready(spark)
    known = language_id.reference(docs.where(~held_out(3, 1)))
    if not known.languages:  # nothing labelled to learn from: only what can have no language goes
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return docs.where(language_id.language(F.col("text"), known)["lang_pred"] != language_id.UNDETERMINED)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each class of near duplicates; documents without words are no duplicates.

    Documents are told apart by id and text, so that rows repeating a doc_id are
    judged each by its text, and only one of equal rows stays.
    """
    ready(spark)
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    classes = written(parity_join.jaccard_classes(keyed.select("_key", "text"), row_id="_key")
                      .where("n_shingles > 0").groupBy("_key", "component_id").count(), "classes")
    ids = keyed.select("_key", "doc_id").distinct().join(classes, "_key")
    stays = ids.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_key"))["_key"].alias("stay"))
    judged = classes.join(stays, "component_id")
    goes = written(judged.where("_key <> stay").select("_key"), "goes")
    again = written(judged.where("_key = stay and count > 1").select("_key"), "again")
    # Rows that are neither dropped nor repeated pass without a shuffle; the few that may be are settled exactly.
    named, others = parity_join.split_by(keyed, goes.unionByName(again), "_key")
    once = named.join(goes, "_key", "left_anti").join(again, "_key", "left_anti")
    first = named.join(again, "_key", "left_semi").dropDuplicates(["_key"])
    return others.unionByName(once).unionByName(first).select(*docs.columns)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that share no window of ten words with a benchmark item."""
    ready(spark)
    found = winnowing.contamination(docs.withColumn("_all", F.struct(*docs.columns)), table(spark, sf_dir, "benchmark"))
    return found.where("n_hit = 0").select("_all.*")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; n_chars follows the text."""
    ready(spark)
    out = pii.redact(docs.withColumn("_before", F.col("text")), pii.fit(docs))
    if "n_chars" in docs.columns:
        changed = ~F.col("text").eqNullSafe(F.col("_before"))
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences of at most 4096 tokens."""
    ready(spark)
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), capacity=4096)


STAGES = [("language_id", known_language), ("near_duplicates", one_of_each), ("decontamination", no_benchmark),
          ("personal_data", without_personal_data), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
