"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts and unlabelled ones, both bounded samples, train a linear numpy classifier under a
class-prior-corrected risk: the risk of the negatives is that of the unlabelled less
the prior's share of the positives', and never counts below zero. The prior is the share
of toxic documents among all whose labels may be learned from. Its features are chosen by counts over all confirmed and all
unlabelled documents. Labels are learned only from rows whose
crc32(doc_id) mod 4 isn't 2.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import cut
from tapeworks.llm.decontam import words_of

#: Bounds of the samples that the classifier is fitted on, in documents.
MAX_POSITIVE, MAX_UNLABELLED = 6_000, 12_000
#: Features: words and their first 4, 5 and 6 bytes that tell confirmed from unlabelled documents the most, of the
#: CANDIDATES that the most confirmed documents have, LEAST_DOCUMENTS at least.
FEATURES, CANDIDATES, LEAST_DOCUMENTS = 512, 20_000, 4
THRESHOLD = 0.3

_PREFIXES = (4, 5, 6)
#: Features that a task counts before it sends them on.
HELD = 500_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def features_of(text: str | None) -> set[bytes]:
    """Words, and prefixes marked by their length."""
    words = set(words_of(text))
    out = set(words)
    for n in _PREFIXES:
        out.update(b"%d:" % n + w[:n] for w in words if len(w) > n)
    return out


@dataclass(frozen=True)
class Model:
    """``score`` is the logistic of ``bias`` plus the weights of the features that a text has."""

    prior: float
    bias: float
    weights: dict[bytes, float]

    def __post_init__(self):
        object.__setattr__(self, "parts", by_length(self.weights))

    def score(self, text: str | None) -> float:
        total = self.bias + sum(self.weights[f] for f in sorted(known_features(text, self.parts)))
        return float(1 / (1 + np.exp(-np.clip(total, -60, 60))))


def by_length(features: Iterable[bytes]) -> dict[int, dict[bytes, bytes]]:
    """Words (0) and prefixes by their length, without the mark, to the feature."""
    parts: dict[int, dict[bytes, bytes]] = {0: {}, **{n: {} for n in _PREFIXES}}
    for f in features:
        n = int(f[:1]) if f[1:2] == b":" else 0
        parts[n][f[2:] if n else f] = f
    return parts


def known_features(text: str | None, parts: dict[int, dict[bytes, bytes]]) -> list[bytes]:
    """Those of ``parts`` that a text has."""
    words = set(words_of(text))
    return [known[f] for n, known in parts.items() for f in ({w[:n] for w in words if len(w) > n} if n else words).intersection(known)]


def gradient(x_p: np.ndarray, x_u: np.ndarray, w: np.ndarray, b: float, prior: float) -> tuple[np.ndarray, float, float, float]:
    """By weights and bias: of the risk, or, where the negatives' risk is below zero, back from it; and the risks of positives and negatives."""
    narrow = w.astype(x_p.dtype)
    f_p, f_u = (x_p @ narrow).astype(np.float64) + b, (x_u @ narrow).astype(np.float64) + b
    s_p, s_u = 1 / (1 + np.exp(-f_p)), 1 / (1 + np.exp(-f_u))
    positive, negative = prior * np.mean(np.logaddexp(0, -f_p)), np.mean(np.logaddexp(0, f_u)) - prior * np.mean(np.logaddexp(0, f_p))
    d_p, d_u = -prior * s_p / len(f_p), s_u / len(f_u)  # of the negatives' risk
    if negative < 0:  # step back from where it is overfitted
        d_p, d_u = -d_p, -d_u
    else:
        d_p += prior * (s_p - 1) / len(f_p)
    return (d_p.astype(x_p.dtype) @ x_p + d_u.astype(x_u.dtype) @ x_u).astype(np.float64), float(d_p.sum() + d_u.sum()), float(positive), float(negative)


def train(x_p: np.ndarray, x_u: np.ndarray, prior: float, epochs: int = 400, rate: float = 0.05, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the logistic loss, by Adam over whole samples: of all steps, those of the least risk."""
    w, b = np.zeros(x_p.shape[1]), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    least, best = np.inf, (w, b)
    for t in range(1, epochs + 1):
        by_w, by_b, positive, negative = gradient(x_p, x_u, w, b, prior)
        risk = positive + max(0.0, negative) + decay / 2 * float(w @ w)
        if risk < least:
            least, best = risk, (w, b)
        grad = np.append(by_w + decay * w, by_b)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return best


def _sample(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` distinct ids, chosen by a hash."""
    return ids.filter("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(most)


def _counted(texts: DataFrame, chosen: list[bytes] | None = None) -> DataFrame:
    """feature, n: documents that have it; all features, or those ``chosen``. ``texts``: one column."""
    schema = pa.schema([("feature", pa.binary()), ("n", pa.int64())])
    parts = None if chosen is None else by_length(chosen)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(features_of(text) if parts is None else known_features(text, parts))
            if len(found) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], schema=schema)
                found = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], schema=schema)

    return texts.mapInArrow(count, "feature binary, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0 or 1; null counts as unlabelled).

    A doc_id with several labels counts once, as toxic if any of them says so; a doc_id with several texts gives all of them
    to the counts and the least to the sample. Null ids teach nothing. Without toxic rows, or with nothing else, the model scores every text by the prior.
    """
    mine = labels.filter(~held_out(F.col("doc_id"))).filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    seen = mine.agg(F.count("*").alias("n"), F.sum("toxic").alias("k")).first()
    prior = float(np.clip((seen["k"] or 0) / seen["n"], 1e-3, 0.9)) if seen["n"] else 0.0
    if not seen["k"]:
        return Model(0.0, -60.0, {})
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    toxic = cut(mine.filter("toxic = 1").select("doc_id"))
    confirmed = cut(texts.join(toxic, "doc_id", "left_semi"))
    unlabelled = texts.filter(~held_out(F.col("doc_id")))
    n_p, n_u = confirmed.count(), unlabelled.count()
    if not n_p or not n_u:
        return Model(prior, float(np.log(prior / (1 - prior))), {})
    common = cut(_counted(confirmed.select("text")).filter(F.col("n") >= LEAST_DOCUMENTS).orderBy(F.desc("n"), "feature").limit(CANDIDATES))
    among_all = _counted(unlabelled.select("text"), [bytes(r["feature"]) for r in common.select("feature").collect()])
    both = common.withColumnRenamed("n", "p").join(among_all.withColumnRenamed("n", "u"), "feature", "left").fillna(0, ["u"])
    share_p, share_u = (F.col("p") + 0.5) / (n_p + 1), (F.col("u") + 0.5) / (n_u + 1)
    apart = F.abs(share_p - share_u) / F.sqrt((share_p * (1 - share_p)) / n_p + (share_u * (1 - share_u)) / n_u)
    chosen = [bytes(r["feature"]) for r in both.orderBy(apart.desc(), "feature").limit(FEATURES).select("feature").collect()]
    place, parts = {f: i for i, f in enumerate(chosen)}, by_length(chosen)

    samples = [_sample(ids, most).withColumn("positive", F.lit(is_p)) for ids, most, is_p in ((confirmed, MAX_POSITIVE, True), (unlabelled, MAX_UNLABELLED, False))]
    wanted = cut(samples[0].union(samples[1]))  # at most 18,000 rows
    sample = texts.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "positive").agg(F.min("text").alias("text"))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(place[f] for f in known_features(t, parts)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "positive", "at"])

    rows = sample.select("doc_id", "text", "positive").mapInArrow(locate, "doc_id bigint, positive boolean, at array<int>").orderBy("doc_id", "positive").collect()
    x = np.zeros((len(rows), len(chosen)), np.float32)
    for i, r in enumerate(rows):
        x[i, r["at"]] = 1
    is_p = np.array([r["positive"] for r in rows])
    w, b = train(x[is_p], x[~is_p], prior)
    return Model(prior, b, dict(zip(chosen, w.tolist(), strict=True)))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row; null and empty texts score by the bias alone. Nothing but the text enters a score."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(t) for t in batch.column(2).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string")).mapInArrow(each, "doc_id bigint, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text scores ``threshold`` or more."""
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([model.score(t) < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
