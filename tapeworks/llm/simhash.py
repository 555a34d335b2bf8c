"""SimHash near-duplicates found by covering locality-sensitive hashing.

Documents get a 64-bit fingerprint. Equal fingerprints form one class; classes
are linked when their fingerprints differ in at most RADIUS bits, and linked
classes form components. Candidates come from structured bit masks: each bit has a
nonzero vector over GF(2) of RADIUS + 1 dimensions, each nonzero vector v gives the
mask of the bits whose vector has odd product with v. Any RADIUS bits leave some v
orthogonal to all their vectors, so two fingerprints in the radius agree under that mask.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm import jaccard
from tapeworks.llm.common import HOT_SHARE, cut, fresh, join_groups
from tapeworks.llm.graph import components

RADIUS, BITS, SHINGLE, SEED = 3, 64, 3, 42
#: A larger bucket is dealt again by finer masks, under which no bucket can be larger than this.
BUCKET = 4096
#: Pairs in a run of at most this many rows are compared by shifts over a whole batch.
SHORT_RUN = 32


def covering_masks() -> list[int]:
    """15 masks; each holds about half of the 64 bits."""
    vectors = [1 + i % 15 for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1) for v in range(1, 1 << (RADIUS + 1))]


def finer_masks(mask: int) -> list[int]:
    """Masks within a bucket of ``mask``: its free bits in 8 groups, all but RADIUS of them held too.

    Up to RADIUS differing bits lie in up to RADIUS groups, so some mask covers each pair;
    at most 12 bits stay free, so a bucket has at most 4096 fingerprints.
    """
    free = [i for i in range(BITS) if not mask >> i & 1]
    parts = [free[k::8] for k in range(8)]
    return [mask | sum(1 << i for k, part in enumerate(parts) if k not in out for i in part) for out in combinations(range(8), RADIUS)]


def fingerprint(text: str | None) -> int:
    """64 bits; a bit is 1 if it is set in over half of the shingles' hashes. No words: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = len(words) - SHINGLE + 1
    shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False)) if n > 0 else [b" ".join(words)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, max(n, 1))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), and row (from the long column ``row``; null without one)."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("row", pa.int64())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), batch.column(2)], schema=schema)

    number = F.col(row) if row else F.lit(None)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), number.cast("long").alias("row")).mapInArrow(each, "doc_id bigint, fp bigint, row bigint")


def _near(xored: np.ndarray) -> np.ndarray:
    return np.bitwise_count(xored.view(np.uint64)) <= RADIUS


def forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what is within the radius among distinct fingerprints: one for each that is reached, not all pairs."""
    links: list[tuple[int, int]] = []
    left = np.ones(len(fps), bool)
    for start in range(len(fps)):
        if not left[start]:
            continue
        left[start] = False
        front = [start]
        while front:
            x = front.pop()
            near = np.flatnonzero(left & _near(fps ^ fps[x]))
            left[near] = False
            links += [(int(fps[x]), y) for y in fps[near].tolist()]
            front += near.tolist()
    return links


def _runs(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1), [True]]))


def linked(sorted_rows: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[list[tuple[int, int]]]:
    """Links within buckets, from (table and key, fingerprint) rows in order of the first. A bucket may come in several pieces."""
    keys, fps = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
    for more_keys, more_fps in sorted_rows:
        keys, fps = np.concatenate([keys, more_keys]), np.concatenate([fps, more_fps])
        if len(keys):
            last = int(_runs(keys)[-2])  # the run that may go on
            yield _compare(keys[:last], fps[:last])
            keys, fps = keys[last:], fps[last:]
    yield _compare(keys, fps)


def _compare(keys: np.ndarray, fps: np.ndarray) -> list[tuple[int, int]]:
    links: list[tuple[int, int]] = []
    if len(fps) == 0:
        return links
    at = _runs(keys)
    size = np.diff(at)
    for i in np.flatnonzero(size > SHORT_RUN).tolist():
        links += forest(fps[at[i] : at[i + 1]])
    small = np.repeat((size > 1) & (size <= SHORT_RUN), size)
    keys, fps = keys[small], fps[small]
    for k in range(1, min(SHORT_RUN, len(fps))):
        same = (keys[k:] == keys[:-k]).all(axis=1)
        if not same.any():
            break
        near = same & _near(fps[k:] ^ fps[:-k])
        links += list(zip(fps[:-k][near].tolist(), fps[k:][near].tolist(), strict=True))
    return links


def _masked(fps: DataFrame, masks: list[int], table: int = 0) -> DataFrame:
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    tables = F.array(*(F.struct(F.lit(table + i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)))
    return fps.select("fp", F.explode(tables).alias("x")).select(F.col("x.t").cast("long").alias("t"), "x.key", "fp")


def _in_buckets(rows: DataFrame) -> DataFrame:
    """a, b: links within the buckets of rows t, key, fp."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numpied = ((np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], axis=1), b.column(2).to_numpy()) for b in batches)
        for found in linked(numpied):
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=schema)

    return rows.repartition("t", "key").sortWithinPartitions("t", "key", "fp").mapInArrow(compare, "a bigint, b bigint")


def links(fps: DataFrame) -> DataFrame:
    """Links a, b between distinct fingerprints (column fp) that join all within the radius; each pair in the radius is in one component.

    Buckets of more than BUCKET fingerprints never meet in a task: theirs are dealt again by finer masks.
    """
    masks, on = covering_masks(), ["t", "key"]
    rows = _masked(fps, masks)
    total = rows.count()
    large = cut(rows.groupBy(*on).agg(F.count("*").alias("n")).filter(F.col("n") > BUCKET))
    again = [r["t"] for r in large.select("t").distinct().collect()]  # 15 at most
    if not again:
        return cut(_in_buckets(rows))
    hot = F.broadcast(large.filter(F.col("n") > total // HOT_SHARE + 1).select(*on))
    out = cut(_in_buckets(rows.join(hot, on, "left_anti").join(large.select(*on), on, "left_anti").select(*on, "fp")))
    apart = cut(join_groups(rows, large, on, "n", total).select("t", "fp"))
    for t in again:
        out = out.union(cut(_in_buckets(_masked(apart.filter(F.col("t") == t).select("fp"), finer_masks(masks[t])))))
    return out


def shingle_links(docs: DataFrame, rows: DataFrame, row: str, near: float) -> DataFrame:
    """Links a, b between the fingerprints of documents whose sets of five-word shingles have a Jaccard similarity of ``near`` or more.

    ``row`` is a long column of ``docs`` that tells its rows apart; ``rows`` has each one's fingerprint.
    """
    found = cut(jaccard.links(docs, F.col(row), near).distinct())
    ends = [rows.select(F.col("row").alias(end), F.col("fp").alias(f"fp_{end}")).hint("merge") for end in ("a", "b")]
    return found.join(ends[0], "a").join(ends[1], "b").select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b")).filter("a <> b").distinct()


def _rooted(rows: DataFrame, more_links: DataFrame | None = None) -> DataFrame:
    """fp, size, first (its smallest doc_id, null last, and that one's row) and root of each distinct fingerprint of ``rows``."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    classes = cut(rows.groupBy("fp").agg(first.alias("first"), F.count("*").alias("size")))
    found = links(classes.select("fp"))
    nodes = cut(components(found if more_links is None else found.union(more_links)))
    return classes.join(nodes, classes["fp"] == nodes["node"], "left").select("fp", "first", "size", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links, itself included).

    Null and empty texts have fingerprint zero and are linked with each other. Repeated rows
    give repeated result rows. A null doc_id is reachable but never names a component unless it is alone.
    """
    rows = cut(fingerprints(docs))
    classes = cut(_rooted(rows))
    named = classes.groupBy("root").agg(F.min("first")["doc_id"].alias("component_id"))
    whole = cut(classes.join(named, "root").select("fp", "size", "component_id"))
    joined = join_groups(rows, whole, ["fp"], "size", rows.count())
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, near: float | None = None) -> DataFrame:
    """``docs`` with exactly one row of each group of near duplicates: that of the smallest doc_id (null last; of equal ids the first row).

    With ``near``, texts of that Jaccard similarity over five words are near duplicates too, however far their fingerprints are.
    Null and empty texts are one group. No rows give none.
    """
    row = fresh("row_", docs.columns)
    marked = cut(docs.withColumn(row, F.monotonically_increasing_id()))  # fixed by being written
    rows = cut(fingerprints(marked, row))
    classes = _rooted(rows, None if near is None else shingle_links(marked, rows, row, near))
    kept = cut(classes.groupBy("root").agg(F.min("first")["row"].alias(row)).select(row))
    return marked.join(kept.hint("merge"), row, "left_semi").select(*docs.columns)
