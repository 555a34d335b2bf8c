"""A training corpus from documents, in stages; each stage's result is written and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm import decontam, jaccard, linedup, packing, simhash, toxicity
from tapeworks.llm.common import cut, table
from tapeworks.llm.queries import tokenizer_file


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on this input and its labels, doesn't reject."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of later repeated runs; n_chars follows the text."""
    left = linedup.dedup_lines(docs)
    return recounted(left.select(*docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: by SimHash, or by a similarity of 0.8 or more over five words."""
    return simhash.keep_one(docs, jaccard.NEAR)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are deleted; documents that are little else go."""
    return recounted(decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each piece's sequence and place in it."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


def recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("toxicity", toxic),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_free),
    ("best_fit_packing", packed),
]

#: A fitted classifier can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
