"""A training corpus in five stages: quality rules, near duplicates, repeated passages, source mix, token ids.

Every stage takes what the one before kept, written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm.bpe import digests, round_trip, vocabulary_path
from marketframe.llm.mixing import mix
from marketframe.llm.neardup import near_duplicates
from marketframe.llm.quality import keep_good
from marketframe.llm.substring import remove_repeats
from marketframe.session import scratch_path


def _with_text(docs: DataFrame, text: Column, row: str) -> list[Column]:
    """The columns of ``docs`` in their order: its row kept as a struct, with another text and its length."""
    changed = {"text": text, "n_chars": F.char_length(text)}
    return [
        changed[f.name].cast(f.dataType).alias(f.name) if f.name in changed else F.col(f"{row}.`{f.name}`").alias(f.name)
        for f in docs.schema
    ]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the proven cutoffs."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(docs, labels)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates (similarity 0.8 or more); rows without id stay."""
    found = near_duplicates(docs.select("doc_id", "text"), percent=80, share=50)
    others = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__other")).distinct()
    return docs.join(others, F.col("doc_id").cast("bigint") == F.col("__other"), "left_anti")


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages an earlier one has; those of which no word is left go."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__row"), "doc_id", "text")
    cut = remove_repeats(row, ["__row"], as_text=True).where("n_words > n_removed")
    return cut.select(*_with_text(docs, F.col("kept_text"), "__row"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words the mix takes of each document, repeats included."""
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__mixed"), "doc_id", "text", "source"
    )
    return mix(row, ["__mixed", "text"]).select(*_with_text(docs, F.col("text"), "__mixed"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with the digests of the ids and of the text decoded from them."""
    coded = round_trip(docs, vocabulary_path(), ["doc_id"])
    return digests(coded, "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", one_of_each_group),
    ("substring_dedup", without_repeated_passages),
    ("source_mix", source_mix),
    ("bpe", token_ids),
]

#: Exact substring ownership, components and BPE are no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
