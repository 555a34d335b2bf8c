"""Importance resampling of documents towards a target: hashed word and word-pair features, and noise that makes the best scores a draw.

A feature's bucket is its CRC-32; checksums of all words and pairs of a stretch of text come from one position table
(:mod:`tapeworks.llm.crcspans`). Counts of the buckets are summed up in Spark; they alone meet on the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm import crcspans
from tapeworks.llm.common import cut, places

BUCKETS = 10_000
SHARE = 25
LEAST_WORDS = 20
SEED = 7
#: Bytes whose words are hashed together; arrays of some 60 times as many bytes exist meanwhile.
STRETCH = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes of words: digits, lower-cased letters and all beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: Buckets of a stretch's words and pairs, and for each which document it is of: (places of documents, buckets).
Features = tuple[np.ndarray, np.ndarray]


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts that lie one after another: lower-cased bytes with a blank after each word, where words begin, and their texts."""
    inside = _WORD[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    text = np.searchsorted(bounds, starts, "right") - 1
    number = np.cumsum(inside & ~before)[inside] - 1  # of the word that a byte is in
    out = np.full(int(inside.sum()) + len(starts), ord(" "), np.uint8)
    out[np.arange(len(number)) + number] = _LOWER[data[inside]]
    first = np.flatnonzero(np.diff(number, prepend=-1))
    return out, first + np.arange(len(starts)), text


def _hashed(line: np.ndarray, starts: np.ndarray, text: np.ndarray, carried: bool) -> Features:
    """Buckets of all words and of all pairs within a text; a ``carried`` first word was counted before and only pairs up."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(line)) - 1
    single = crcspans.sums(line, starts, ends, ends)
    paired = np.flatnonzero(text[1:] == text[:-1])
    of_single = (single ^ crcspans.constants(ends - starts))[int(carried) :]
    of_text = text[int(carried) :]
    if not len(paired):
        return of_text, (of_single % BUCKETS).astype(np.int64)
    # A pair's sum is that of its first word and the blank, seen from the pair's end, with that of its second word.
    double = crcspans.sums(line, starts[paired], starts[paired + 1], ends[paired + 1]) ^ single[paired + 1]
    of_double = double ^ crcspans.constants(ends[paired + 1] - starts[paired])
    return np.concatenate([of_text, text[paired]]), (np.concatenate([of_single, of_double]) % BUCKETS).astype(np.int64)


def features(texts: pa.Array) -> Iterator[Features]:
    """The features of whole texts (null: none), a stretch at a time; a long text takes several, cut between words."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + STRETCH, "right")) - 1)
        if offsets[j] - offsets[i] <= STRETCH:
            line, starts, text = _words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            of, buckets = _hashed(line, starts, text, carried=False)
            yield of + i, buckets
        else:
            for of, buckets in _long(data[offsets[i] : offsets[j]]):
                yield of + i, buckets
        i = j


def _long(data: np.ndarray) -> Iterator[Features]:
    """The features of one long text. Each stretch starts with the last word of the one before."""
    at, last = 0, np.zeros(0, np.uint8)
    while at < len(data):
        end = min(at + STRETCH, len(data))
        while end < len(data) and _WORD[data[end]]:  # words stay whole
            more = _WORD[data[end : end + STRETCH]]
            end += len(more) if more.all() else int(np.argmin(more))
        piece = np.concatenate([last, np.full(min(1, len(last)), 32, np.uint8), data[at:end]])
        line, starts, text = _words(piece, np.array([0, len(piece)]))
        yield _hashed(line, starts, text, carried=len(last) > 0)
        if len(starts):
            last = line[starts[-1] : -1]
        at = end


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """How many features all texts have in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, buckets in features(batch.column(0)):
                total += np.bincount(buckets, minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(total)], ["bucket", "n"])

    each = rows.select(F.col("text").cast("string")).mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in each.groupBy("bucket").agg(F.sum("n").cast("long")).collect():  # as many rows as buckets
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much likelier a bucket is in the target, with one added to each count."""
    all_s, all_t = int(corpus.sum()), int(target.sum())
    ratio = lambda s, t: math.floor(1000 * math.log((t + 1) * (all_s + BUCKETS) / ((s + 1) * (all_t + BUCKETS))))
    return np.array([ratio(s, t) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: object) -> int:
    """Gumbel noise in thousandths, from a hash of the id; null counts as an empty id."""
    h = int(hashlib.sha256(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_features, weight (floored mean gain, 0 without features) and score (weight and noise)."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for of, buckets in features(batch.column(1)):
                n += np.bincount(of, minlength=len(n))
                np.add.at(total, of, gain[buckets])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            score = weight + np.array([noise(i) for i in batch.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(weight), pa.array(score)], ["doc_id", "n_features", "weight", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(weigh, "doc_id bigint, n_features bigint, weight bigint, score bigint")


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score and rank (from 1; null where it isn't drawn).

    ``docs`` (doc_id, text) and ``target`` (text) are read whole, other columns ignored. Of the documents of
    ``LEAST_WORDS`` words or more ``share`` per cent are drawn, rounded down: the highest scores, then the smallest doc_id
    (null before all), then fewer features; rows that are alike in all of these take either rank. Null texts have no words.
    No documents give no rows; an empty target makes rare features gain.
    """
    found = cut(weights(docs, gains(bucket_counts(docs), bucket_counts(target))))
    able = F.col("n_features") >= 2 * LEAST_WORDS - 1
    columns = ["doc_id", "n_features", "weight", "score"]
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_features")]
    ranked = places(found.filter(able), [], order, "place", "able")
    drawn = F.col("place") < F.floor(F.col("able") * share / 100)
    ranked = ranked.select(*columns, F.when(drawn, F.col("place") + 1).alias("rank"))
    return ranked.unionByName(found.filter(~able).select(*columns, F.lit(None).cast("long").alias("rank")))


def sample(docs: DataFrame, target: DataFrame, share: int = SHARE) -> DataFrame:
    """The drawn documents with all their columns. Rows of one doc_id are drawn together if any of them is."""
    drawn = resample(docs, target, share).filter("rank IS NOT NULL").select(F.col("doc_id").alias("drawn_")).distinct()
    return docs.join(drawn, F.col("doc_id").cast("long").eqNullSafe(F.col("drawn_")), "left_semi")
