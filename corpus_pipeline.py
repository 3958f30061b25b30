"""From raw documents to packed token sequences.

Each stage takes the documents its predecessor kept and returns documents
again, the last one packed pieces; between stages they are written as Parquet
in the shared folder and read back, so a lost executor never costs more than
the stage it was in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfgate.llm import lines, packing, pii, quality, simhash
from shelfgate.llm.queries import tokenizer_path
from shelfgate.session import materialize


def _rewritten(docs: DataFrame, new: DataFrame) -> DataFrame:
    """The columns of ``docs``; ``n_chars`` follows the new text."""
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new = new.withColumn("n_chars", F.length("text").cast(kind))
    return new.select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from ``labels``.
    Null and empty texts fail the base rules."""
    rules = quality.fit_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, rules)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat an earlier one."""
    return _rewritten(docs, lines.dedup_lines(docs, counts=False))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id, of repeated rows one."""
    return simhash.keep_one(docs)


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return _rewritten(docs, pii.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens, placed in sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup),
          ("pii_redaction", pii_redaction), ("packing", pack)]

#: No stage but exact dedup could be told in SQL; the pipeline is tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Empty tables give an empty result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
