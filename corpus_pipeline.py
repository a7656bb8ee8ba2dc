"""A corpus pipeline: language ID, line dedup, near-duplicate removal, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet below
the shared folder and read again as the next stage's documents. All stages but the last return
the columns of the documents they were given.

Defined cases are those of the operators: documents that language ID rejects (null text, no letters, or far from
every learned language) go; lines found before go out of the text, and `n_chars`, where it exists, is counted
again; rows without words are never near-duplicates; documents that overlap with a benchmark item go; an
empty table stays empty throughout. There is no SQL twin: the language models can't be written in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm import decontaminate, language_id, line_dedup, near_dup, packing
from starfold.llm.common import fresh, prepare, table
from starfold.llm.queries import tokenizer_path
from starfold.session import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    prepare(spark)
    model = language_id.fit(docs, ~language_id.held_out())
    found = fresh(docs, "sf_language")
    tagged = docs.withColumn(found, language_id.predict_column(docs, model))
    return tagged.where(F.col(found)["accepted"]).drop(found)


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has."""
    prepare(spark)
    out, dropped = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(F.col(dropped) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", counted)
    return out.select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    prepare(spark)
    return near_dup.keep_one(docs)


def off_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't overlap with the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), short=True)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents packed into training sequences, one row per piece."""
    prepare(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language", known_language),
    ("lines", first_lines),
    ("near duplicates", one_of_each),
    ("benchmark", off_benchmark),
    ("packing", sequences),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
