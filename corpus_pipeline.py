"""Corpus pipeline: the stages that clean the documents table, in order.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
:func:`run` writes as Parquet to the shared checkpoint folder and rereads as the
next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nnPU classifier does not call toxic."""
    from ebbflow.llm import toxicity as op

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return op.reject_toxic(docs, op.train(docs, labels, train_on=~op.held_out(F.col("doc_id"), 5, 0)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id.

    Rows are told apart by their id; rows without one and rows that share one get keys beyond the largest id
    (ids below 2**62), written once, so that copies among them go and different texts stay.
    """
    from ebbflow.llm.core import stage
    from ebbflow.llm.jaccard_join import near_duplicates as op

    ids = docs.groupBy("doc_id").count()
    shared, _ = stage(ids.where("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("shared_id")), "pipeline-shared-ids")
    if shared.isEmpty():
        stay = op(docs).where("doc_id = component_id").select("doc_id")
        return docs.join(stay, "doc_id", "left_semi").select(*docs.columns)
    same = docs["doc_id"].eqNullSafe(shared["shared_id"])
    beyond = ids.agg(F.coalesce(F.max("doc_id"), F.lit(0)) + 1).first()[0]
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    odd, _ = stage(docs.join(shared, same, "left_semi").select((F.monotonically_increasing_id() + beyond).alias("key"), row), "pipeline-odd-rows")
    keyed = docs.join(shared, same, "left_anti").select(F.col("doc_id").cast("long").alias("key"), row).unionByName(odd)
    stay = op(keyed.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text"))).where("doc_id = component_id")
    return keyed.join(stay.select(F.col("doc_id").alias("key")), "key", "left_semi").select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 13-word windows that a document with a smaller id has."""
    from ebbflow.llm.window_dedup import cut_repeated_windows

    return cut_repeated_windows(docs, width=13)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item (items under nine words: only as a whole, see the operator)."""
    from ebbflow.llm.decontaminate import remove_contaminated

    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), least=1)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digests of each document's token ids and of the text decoded from them."""
    import public_tokenizers

    from ebbflow.llm.bpe_trie import encode

    return encode(docs, public_tokenizers.path("byte_bpe_50k.json"), digests=True)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

#: The stages train models and tokenise; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ebbflow.llm.core import stage

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs, _ = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
