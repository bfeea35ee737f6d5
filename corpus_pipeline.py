"""The corpus pipeline: documents in, the mix for training out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet into the shared folder and
read again as the next stage's documents. All but the last return the columns of the documents.

Defined cases are those of the stages' operators. Documents without a text or a letter go in the first stage; a null id
stays through all stages (it is no copy of and no reference for another); rows that share an id stay or go together as near
copies; an empty table, or one that a stage empties, passes through; texts of any length are taken whole; other
columns travel along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.decontam import decontaminate
from pitwall.llm.langid import UNKNOWN, identify
from pitwall.llm.mixing import mix
from pitwall.llm.partenum import BROADCAST_IDS, jaccard_components
from pitwall.llm.shared import checkpointed, fresh_path
from pitwall.llm.substring import remove_repeats


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go (no text, or no letter in it); the others get the predicted one."""
    found = identify(docs).where(F.col("lang_pred") != UNKNOWN)
    return found.select(*[F.col("lang_pred").alias(c) if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id stays; rows that share an id stay or go together."""
    found = jaccard_components(docs)
    gone = checkpointed(found.where("doc_id <> component_id").select("doc_id").distinct())
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in 13-word windows that an earlier document holds are taken out; untouched texts stay as they are."""
    found = remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    changed = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("row.n_chars"))}
    return found.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(~F.col("contaminated")).select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, sources at weights 5, 2, 1."""
    return mix(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The learned language model of the first stage has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents in order."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
