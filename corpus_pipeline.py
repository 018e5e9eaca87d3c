"""A training-data pipeline over ``documents``: each stage calls one operator of ``tradeloom.llm``.

Language identification drops what has no recognised language, near-duplicates keep one document of each
group, personal data is replaced by its kind, sources are mixed to target weights, and the mixture is
encoded as pieces. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.llm.base import prepare_llm, saved
from tradeloom.llm.language_id import learn_and_identify
from tradeloom.llm.mixing import mixture
from tradeloom.llm.pii import redact
from tradeloom.llm.sentencepiece_codec import encode
from tradeloom.llm.simhash import simhash_groups
from tradeloom.session import prepare


def carried(docs: DataFrame, *read: str) -> DataFrame:
    """The columns an operator reads, and all others in ``_row``: names of one's own never meet the operator's."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in read]
    return docs.select(*[c for c in read if c in docs.columns], F.struct(F.lit(0).alias("_"), *others).alias("_row"))


def restored(rows: DataFrame, names: list[str], *read: str) -> DataFrame:
    """The columns of a table that `carried` took apart."""
    return rows.select(*[F.col(c) if c in read else F.col(f"_row.`{c}`") for c in names])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from the languages the documents claim."""
    prepare_llm(prepare(spark))
    found = learn_and_identify(carried(docs, "text", "lang"), F.lit(True))
    return restored(found.filter("NOT _language.rejected"), docs.columns, "text", "lang")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the smallest doc_id.

    Of several texts of that doc_id in the group the one with the smallest hash stays, of repeated rows the
    first by their other columns. A NULL doc_id comes after all others. Groups are told apart by their
    fingerprints, so a doc_id that stands for texts of several groups is kept in each of them.
    """
    prepare_llm(prepare(spark))
    key = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))

    def flat(key: Column) -> list[Column]:
        # plain columns: equal structs may differ in what Spark knows of their NULLs, and be shuffled apart
        return [key["nameless"].alias("_nameless"), F.coalesce(key["id"].cast("string"), F.lit("")).alias("_id"),
                key["text"].alias("_hash")]

    names = ["_nameless", "_id", "_hash"]
    groups = simhash_groups(docs.select(key.alias("doc_id"), "text"))
    first = groups.select(*flat(F.col("component_id"))).distinct()
    rows = carried(docs, "doc_id", "text").select("*", *flat(key)).join(first, names, "left_semi")
    others = F.to_json("_row")
    kept = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*names).orderBy(others))).filter("_n = 1")
    return restored(kept, docs.columns, "doc_id", "text")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    prepare_llm(prepare(spark))
    return restored(redact(carried(docs, "text", "n_chars")), docs.columns, "text", "n_chars")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row for each epoch of a document."""
    prepare_llm(prepare(spark))
    read = ("doc_id", "text", "source", "n_chars")
    return restored(mixture(carried(docs, *read)), docs.columns, *read)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture as pieces: doc_id, lang, source, n_pieces, piece_score, ids."""
    prepare_llm(prepare(spark))
    return encode(docs.select("doc_id", "lang", "source", "text")).select(
        "doc_id", "lang", "source", "n_pieces", "piece_score", "ids")


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixing", mixing), ("encoding", encoding)]

# Fingerprints and learned models are beyond SQL; tests/llm checks the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a stored table that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, f"pipeline-{name}")
    return docs
