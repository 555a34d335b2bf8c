"""Token counts of documents, kept by digest of their content and of the tokenizer's version.

Texts of one normal form have one count. Counts once made are stored in Parquet under (version, digest); documents are
joined with them by digest, one text of each digest that is missing is encoded, and its count is appended. Digests
and ids decide which; texts move once, to meet the list of the missing (a short list goes to them instead), and not at
all where nothing is missing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import cut, join_groups
from tapeworks.llm.tokens import encoder

LIMIT = 2048

_STORED = "version string, digest binary, n_tokens bigint"
_BLANK_RUN = r"[\x20\x09-\x0D]+"


@cache
def version(tokenizer: str) -> str:
    """A digest of the tokenizer's file, of its library's version and of the normal form that its texts have here."""
    import tokenizers

    with open(tokenizer, "rb") as f:
        content = hashlib.file_digest(f, "sha256").hexdigest()
    return hashlib.sha256(f"{content} tokenizers {tokenizers.__version__} {form(tokenizer)}".encode()).hexdigest()


@cache
def form(tokenizer: str) -> str:
    """``blanks``: runs of blanks count as one, where the tokenizer drops blanks; ``whole``: the text as it is."""
    return "blanks" if encoder(tokenizer).kind == "dropped" else "whole"


def normal(text: Column, kind: str) -> Column:
    """The normal form: equal forms have equal counts. Null is empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.trim(F.regexp_replace(text, _BLANK_RUN, " ")) if kind == "blanks" else text


def stored(docs: DataFrame, cache_dir: str) -> DataFrame:
    """The counts kept in ``cache_dir``, none where nothing was stored yet. Entries that were appended twice are equal."""
    spark = docs.sparkSession
    try:
        return spark.read.schema(_STORED).parquet(cache_dir)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _STORED)


def _lengths(tokenizer: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Count the ids of texts; of texts with one digest in a task only the first is encoded."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            first = [i for i, d in enumerate(batch.column(0).to_pylist()) if d not in seen and not seen.add(d)]
            chosen = batch.take(pa.array(first, pa.int64()))
            n = [np.diff(at) - 1 for _, at in encoder(tokenizer).encode(chosen.column(1))]
            yield pa.RecordBatch.from_arrays([chosen.column(0), pa.array(np.concatenate([np.zeros(0, np.int64), *n]), pa.int64())], ["digest", "n_tokens"])

    return count


def token_counts(docs: DataFrame, tokenizer: str, cache_dir: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    ``docs``: doc_id, text; other columns are ignored. Null texts are empty: no bytes, no tokens. Special tokens in a text
    are counted as the library does, none are added. Rows that repeat keep rows of their own. ``cache_dir`` is a folder that all
    executors share; a run that was broken off leaves counts of whole files or none. Of a digest that is missing the row with
    the smallest doc_id is encoded; where rows repeat wholly, one of them in each task that has any.
    """
    kind, key = form(tokenizer), version(tokenizer)
    text = F.col("text").cast("string")
    digest = F.unhex(F.sha2(normal(text, kind), 256))
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), digest.alias("digest")))
    known = lambda: stored(docs, cache_dir).filter(F.col("version") == key).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    wanted = cut(rows.groupBy("digest").agg(F.count("*").alias("rows"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id"))["doc_id"].alias("doc_id")))
    missing = cut(wanted.join(known(), "digest", "left_anti").select("digest", "doc_id"))
    if missing.limit(1).count():
        texts = docs.select(digest.alias("digest"), text.alias("text"), F.col("doc_id").cast("long").alias("doc_id")).alias("t")
        chosen = texts.join(missing.alias("m"), (F.col("t.digest") == F.col("m.digest")) & F.col("t.doc_id").eqNullSafe(F.col("m.doc_id")), "left_semi")
        made = chosen.select("digest", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_lengths(tokenizer), "digest binary, n_tokens bigint")
        made.select(F.lit(key).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache_dir)
    counts = wanted.select("digest", "rows").join(known(), "digest")
    found = join_groups(rows, cut(counts), ["digest"], "rows", rows.count())
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
