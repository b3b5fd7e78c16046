"""From documents to packed sequences: language, near-duplicates, personal data, source mix, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventframe.llm import chosen_path, language_id, mixing, packing, pii
from eventframe.llm.common import cut, remove, shared_dir, table

#: No stage can be given as SQL as a whole: the first fits a classifier, and the later ones work on what it keeps.
ORACLE_SQL = None


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is determined: rejected are those without a letter, those whose language is less
    probable than not, and those whose n-grams are less likely in it than labelled texts of their length are in a model of the others. The classifier learns from all labelled documents; without any, all are rejected. Null and empty texts are
    rejected; nulls in other columns, repeated rows and extra columns stay as they are."""
    counts = language_id.count(docs)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    seen = language_id.predict(rows, counts.model(), id_col="row", text_col="row.text", floors=language_id.fit_floors(docs, counts))
    return seen.where((F.col("lang_pred") != "und") & (F.col("score") >= 0.5) & F.col("typical")).select("row.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: that with the smallest doc_id. Of equal rows one stays. Texts
    without a word are no copies of each other and all stay; a null doc_id stays only for a group without another."""
    found = cut(chosen_path.jaccard_classes(docs))
    alone = found.where("n_links = 0").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.lit(False).alias("_linked")).distinct()
    first = found.where("n_links > 0").groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("f"))
    first = first.select(F.col("f.doc_id").alias("_id"), F.col("f.text_key").alias("_key"), F.lit(True).alias("_linked"))
    kept = cut(alone.unionByName(first))
    out = docs.join(kept, docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_key")))
    again = found.where("n_links > 0").groupBy("doc_id", "text_key").count().where("count > 1")
    if again.limit(1).count():  # repeated rows: one stays
        out = out.where("not _linked").unionByName(out.where("_linked").dropDuplicates(["_id", "_key"]))
    return out.select(*[docs[c] for c in docs.columns])


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by surrogates; n_chars follows the text. Null texts stay null; rows are neither added nor lost."""
    out = pii.pseudonymise(docs, pii.session_key(spark)).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes; one taken twice is two rows. A null source is a source of its own; texts without a
    word are never taken."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences of 4096 tokens; a null text is an empty one."""
    return packing.pack(docs)


STAGES = [
    ("language_id", keep_known_language),
    ("near_duplicates", keep_one_of_near_copies),
    ("pii", replace_personal_data),
    ("mixing", mix_to_weights),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents, each written as Parquet to the shared folder and read again by the next, after
    which it is deleted; the last one's folder stays, as the result is read from it."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        if k:
            remove(spark, f"{folder}/{STAGES[k - 1][0]}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
