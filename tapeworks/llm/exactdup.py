"""Exact deduplication: a batch against an immutable snapshot.

Texts are equal when their bytes are, once blanks are deleted. Each snapshot bucket has
a static binary-fuse filter of its digests; only digests that pass it meet the bucket's
groups, and a match counts after the texts' bytes were compared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import BLANKS, cut, join_groups, shuffle_width

#: Digests of one bucket and so of one filter, on average at most.
BUCKET_KEYS = 1 << 17

_FILTER = "bucket bigint, seed bigint, segment bigint, segments bigint, cells binary"


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def _places(mixed: np.ndarray, segment: int, segments: int) -> list[np.ndarray]:
    """Three cells, one in each of three consecutive segments."""
    first = (((mixed >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)).astype(np.int64)
    inner = np.int64(segment - 1)
    return [(first + j) * segment + ((mixed >> np.uint64(s)).astype(np.int64) & inner) for j, s in enumerate((0, 13, 26))]


def _prints(mixed: np.ndarray) -> np.ndarray:
    return ((mixed ^ (mixed >> np.uint64(29))) & np.uint64(0xFFFF)).astype(np.uint16)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Binary-fuse filter of distinct 64-bit keys: seed, segment length, segments that start a triple, cells of 16 bits.

    Cells that one key alone uses are peeled, many at a time; the reverse order sets each
    key's own cell so that its three cells xor to its fingerprint. A stuck peel takes the next seed.
    """
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    segment = 1 << max(2, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    segments = max(1, int(np.ceil(n * factor / segment)) - 2)
    for seed in range(1, 200):
        mixed = _mix(keys, seed)
        places = _places(mixed, segment, segments)
        uses = np.bincount(np.concatenate(places), minlength=(segments + 2) * segment)
        owner = np.zeros(len(uses), np.int64)
        index = np.arange(n)
        for p in places:
            np.bitwise_xor.at(owner, p, index)
        peeled: list[tuple[np.ndarray, np.ndarray]] = []
        single, done = np.flatnonzero(uses == 1), 0
        while len(single):
            who, where = np.unique(owner[single], return_index=True)
            peeled.append((who, single[where]))
            done += len(who)
            for p in places:
                np.subtract.at(uses, p[who], 1)
                np.bitwise_xor.at(owner, p[who], who)
            near = np.unique(np.concatenate([p[who] for p in places]))
            single = near[uses[near] == 1]
        if done == n:
            cells = np.zeros(len(uses), np.uint16)
            prints = _prints(mixed)
            for who, cell in reversed(peeled):
                cells[cell] = prints[who] ^ cells[places[0][who]] ^ cells[places[1][who]] ^ cells[places[2][who]] ^ cells[cell]
            return seed, segment, segments, cells.tobytes()
        if seed % 20 == 0:
            segments += max(1, segments // 8)
    raise ValueError("no filter found")


def probe_filter(keys: np.ndarray, seed: int, segment: int, segments: int, cells: bytes) -> np.ndarray:
    """True where a key may be in the filter; never false for one that is."""
    mixed = _mix(keys.astype(np.uint64), seed)
    table = np.frombuffer(cells, np.uint16)
    a, b, c = _places(mixed, segment, segments)
    return (table[a] ^ table[b] ^ table[c]) == _prints(mixed)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars_ (code points of the whole text), sha_ (of the text without blanks), bytes_; null counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bare = F.translate(text, BLANKS, "")
    return docs.select(F.col("doc_id").cast("long"), F.length(text).cast("long").alias("n_chars_"), F.unhex(F.sha2(bare, 256)).alias("sha_"), F.octet_length(bare).cast("long").alias("bytes_"))


def _better() -> list:
    """Of a group: how many rows, and which stays (most code points, then smallest doc_id, null last, then the first row)."""
    best = F.min(F.struct((-F.col("n_chars_")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"), F.col("row_").alias("d")))
    return [F.count("*").alias("rows_"), best.alias("best_")]


def groups(rows: DataFrame, buckets: int) -> DataFrame:
    """One row per digest of one batch, its copies counted before any shuffle."""
    bucket = F.pmod(F.conv(F.substring(F.hex("sha_"), 17, 8), 16, 10).cast("long"), F.lit(buckets))
    return rows.groupBy("sha_", "bytes_").agg(*_better()).withColumn("bucket", bucket)


def _key64(sha: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(x[:8] for x in sha), ">u8").astype(np.uint64) if len(sha) else np.zeros(0, np.uint64)


def build_filters(snapshot: DataFrame) -> DataFrame:
    """A filter for each bucket of a snapshot's groups."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(int(pdf.bucket.iloc[0]), *build_filter(_key64(pdf.sha_)))], columns=["bucket", "seed", "segment", "segments", "cells"])

    return snapshot.select("bucket", "sha_").groupBy("bucket").applyInPandas(build, _FILTER)


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """Incoming digests that their bucket's filter lets pass: sha_, bytes_."""

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return left[["sha_", "bytes_"]].iloc[:0]
        f = right.iloc[0]
        hit = probe_filter(_key64(left.sha_), int(f.seed), int(f.segment), int(f.segments), f.cells)
        return left.loc[hit, ["sha_", "bytes_"]]

    sides = incoming.select("bucket", "sha_", "bytes_").groupBy("bucket").cogroup(filters.groupBy("bucket"))
    return sides.applyInPandas(probe, "sha_ binary, bytes_ bigint")


def same_bytes(docs: DataFrame, matches: DataFrame) -> DataFrame:
    """Of ``matches`` (sha_, bytes_, old_, new_: doc_ids), those whose texts are equal without blanks."""
    ids = matches.select(F.col("old_").alias("doc_id")).union(matches.select("new_")).distinct().hint("merge")  # the same plan at every size
    bare = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), BLANKS, "")
    named = docs.select(F.col("doc_id").cast("long"), "text").alias("d").join(ids.alias("i"), F.col("d.doc_id").eqNullSafe(F.col("i.doc_id")), "left_semi")
    texts = named.select("doc_id", bare.alias("bare_")).withColumn("sha_", F.unhex(F.sha2("bare_", 256))).dropDuplicates(["doc_id", "sha_"])
    old = texts.select(F.col("doc_id").alias("old_"), "sha_", F.col("bare_").alias("a_"))
    new = texts.select(F.col("doc_id").alias("new_"), "sha_", F.col("bare_").alias("b_"))
    m = matches.select("sha_", "bytes_", "old_", "new_").alias("m")
    both = m.join(old.alias("o"), (F.col("m.sha_") == F.col("o.sha_")) & F.col("m.old_").eqNullSafe(F.col("o.old_")))
    both = both.join(new.alias("n"), (F.col("m.sha_") == F.col("n.sha_")) & F.col("m.new_").eqNullSafe(F.col("n.new_")))
    return both.filter(F.col("a_") == F.col("b_")).select("m.sha_", "m.bytes_").distinct()


def dedup(snapshot_docs: DataFrame, new_docs: DataFrame) -> DataFrame:
    """Exact copies within and across a snapshot and a new batch (both: doc_id, text).

    One row per document of either: doc_id, keep_id (the row that stays: most code points
    in the original text, then smallest doc_id), group_size, kept, text_sha256.
    Null texts are empty and equal; rows that repeat wholly keep their own result rows. Of each group exactly one
    row is kept, also where several rows share the keeping doc_id and length. No rows at all give none.
    """
    spark = new_docs.sparkSession
    both = digests(snapshot_docs).withColumn("new_batch_", F.lit(False)).unionByName(digests(new_docs).withColumn("new_batch_", F.lit(True)))
    rows = cut(both.withColumn("row_", F.monotonically_increasing_id()))  # fixed by being written
    total = rows.count()
    buckets = max(shuffle_width(spark), total // BUCKET_KEYS)
    old = cut(groups(rows.filter(~F.col("new_batch_")), buckets))
    new = cut(groups(rows.filter("new_batch_"), buckets))
    passed = screen(new, cut(build_filters(old)))
    on = ["sha_", "bytes_"]
    pairs = old.select(*on, F.col("best_").alias("was_"), F.col("rows_").alias("old_rows_")).join(new.join(passed, on, "left_semi").drop("bucket"), on)
    pairs = cut(pairs.select(*on, F.col("was_.c").alias("old_"), F.col("best_.c").alias("new_"), F.least("was_", "best_").alias("both_"), (F.col("old_rows_") + F.col("rows_")).alias("all_rows_")))
    docs = snapshot_docs.select("doc_id", "text").unionByName(new_docs.select("doc_id", "text"))
    merged = pairs.join(same_bytes(docs, pairs), on, "left_semi").select(*on, "both_", "all_rows_")
    each = old.select(*on, "best_", "rows_", F.lit(False).alias("new_batch_")).unionByName(new.select(*on, "best_", "rows_", F.lit(True).alias("new_batch_")))
    final = each.join(merged, on, "left").select(*on, "new_batch_", F.col("rows_"), F.coalesce("both_", "best_").alias("best_"), F.coalesce("all_rows_", "rows_").alias("group_size"))
    joined = join_groups(rows, cut(final), [*on, "new_batch_"], "rows_", total)
    return joined.select("doc_id", F.col("best_.c").alias("keep_id"), F.col("group_size").cast("long"), (F.col("row_") == F.col("best_.d")).alias("kept"), F.lower(F.hex("sha_")).alias("text_sha256"))
