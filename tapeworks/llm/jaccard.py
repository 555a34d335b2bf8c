"""Near copies by the Jaccard similarity of their word shingles.

A document is the set of the hashes of its SHINGLE-word shingles. MinHash bands only name
candidates: those that share a band stand in one bucket. First each bucket's members are compared with one of them, its leader;
what that links is one component, and only members of different components of a bucket are compared with each other after
that. The sets themselves are compared, so what is linked has a similarity of NEAR or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import cut, join_groups
from tapeworks.llm.graph import components

SHINGLE, NEAR, SEED = 5, 0.8, 42
#: Minima in a band and bands: two sets at NEAR share no band with a chance of (1 - 0.8 ** 5) ** 30, 7 in a million.
ROWS, BANDS = 5, 30
#: Shingles in a block: the members of a bucket that its leader doesn't link are dealt in blocks, each compared with all others.
BLOCK = 1 << 20
#: Groups that a leader's members are dealt to at most.
SPREAD = 1024

_MIX = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(SEED)
_FLIP = _RNG.integers(0, 1 << 32, (ROWS * BANDS, 1), np.uint32)
_ODD = _RNG.integers(0, 1 << 32, (ROWS * BANDS, 1), np.uint32) | np.uint32(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    x ^= x >> np.uint64(32)
    return x


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct hashes in order. Fewer than SHINGLE words are one shingle; no words, none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(SHINGLE, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = _mix(out ^ hashes[i : i + n])
    return np.unique(_mix(out))


def band_keys(found: np.ndarray) -> np.ndarray:
    """A key for each band of the minima of a set that isn't empty."""
    short = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(ROWS * BANDS, (1 << 32) - 1, np.uint32)
    for at in range(0, len(short), 1024):
        np.minimum(least, ((short[at : at + 1024] ^ _FLIP) * _ODD).min(axis=1), out=least)
    rows = least.reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        keys = _mix(keys ^ rows[:, i])
    return _mix(keys).view(np.int64)


def similar(mine: np.ndarray, others: list[np.ndarray], near: float = NEAR) -> np.ndarray:
    """Which of ``others`` have a similarity of ``near`` or more with a set; no set is empty."""
    out = np.zeros(len(others), bool)
    sizes = np.array([len(s) for s in others], np.int64)
    at = np.flatnonzero((sizes >= near * len(mine) - 1) & (near * sizes <= len(mine) + 1))
    if len(at):
        flat = np.concatenate([others[i] for i in at])
        place = np.searchsorted(mine, flat)
        place[place == len(mine)] = 0
        both = np.add.reduceat((mine[place] == flat).astype(np.int64), np.cumsum([0, *sizes[at][:-1]]))
        out[at] = both / (len(mine) + sizes[at] - both) >= near
    return out


def sketches(docs: DataFrame, key: Column) -> DataFrame:
    """key, cls (a hash of the shingle set), n (its size), bands; documents without words have none."""
    schema = pa.schema([("key", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, cls, n, bands = [], [], [], []
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = shingle_set(text)
                if len(found):
                    keys.append(key)
                    cls.append(xxhash.xxh64_intdigest(found.tobytes(), SEED))
                    n.append(len(found))
                    bands.append(band_keys(found))
            if keys:
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), pa.array(np.concatenate(bands)))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(np.array(cls, np.uint64).view(np.int64)), pa.array(n, pa.int64()), lists], schema=schema)

    return docs.select(key.alias("key"), F.col("text").cast("string")).mapInArrow(each, "key bigint, cls bigint, n bigint, bands array<bigint>")


def _compared(texts: DataFrame, placed: DataFrame, near: float) -> DataFrame:
    """a, b: in each group g, names of role 1 and those of role 0 that are alike, unless they have the same root. ``placed``: g, role, name, root; ``texts``: name, text.

    A group's sets of role 0 are held, those of role 1 stream past them.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, names, roots, sets = None, [], np.zeros(0, np.int64), []
        for batch in batches:
            found: list[tuple[int, int]] = []
            for g, role, name, root, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if g != group:
                    group, names, roots, sets = g, [], np.zeros(0, np.int64), []
                if role == 0:
                    names.append(name)
                    roots = np.append(roots, root)
                    sets.append(shingle_set(text))
                    continue
                some = np.flatnonzero(roots != root)
                if len(some):
                    hit = similar(shingle_set(text), [sets[i] for i in some], near)
                    found += [(name, names[i]) for i in some[hit].tolist()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=schema)

    rows = texts.join(placed.hint("merge"), "name").select("g", "role", "name", "root", "text")
    return rows.repartition("g").sortWithinPartitions("g", "role", "name").mapInArrow(each, "a bigint, b bigint")


def _stars(members: DataFrame) -> DataFrame:
    """g, role, name, root: each leader, and what shares a bucket with it, in up to SPREAD groups. ``members``: name, leader."""
    pairs = cut(members.filter("name <> leader").select("name", "leader").distinct())
    g = F.xxhash64("leader", F.pmod(F.xxhash64("name"), F.lit(SPREAD))).alias("g")
    leaders = pairs.select(g, F.lit(0).alias("role"), F.col("leader").alias("name"), F.col("leader").alias("root")).distinct()
    return leaders.unionByName(pairs.select(g, F.lit(1).alias("role"), "name", F.col("name").alias("root")))


def _strangers(members: DataFrame) -> DataFrame:
    """g, role, name, root: members of a bucket that aren't in its leader's component against all of it, block by block. ``members``: band, name, n, root."""
    total = members.count()
    mixed = members.groupBy("band").agg(F.min(F.struct("name", "root"))["root"].alias("main"), F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("k"))
    mixed = cut(mixed.filter("low <> high").select("band", "main", "k"))
    rest = cut(join_groups(members, mixed, ["band"], "k", total).withColumn("apart", F.col("root") != F.col("main")).drop("main", "k"))
    blocks = lambda n: F.ceil(F.coalesce(n, F.lit(0)) / BLOCK).cast("int")
    sizes = cut(rest.groupBy("band").agg(F.count("*").alias("k"), blocks(F.sum("n")).alias("all_blocks"), blocks(F.sum(F.when(F.col("apart"), F.col("n")))).alias("own_blocks")))
    dealt = join_groups(rest, sizes, ["band"], "k", total)
    mine = lambda salt, n: F.pmod(F.xxhash64("name", F.lit(salt)), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = dealt.filter("apart").select("band", "name", "root", F.lit(0).alias("role"), mine(1, "own_blocks").cast("int").alias("u"), every("all_blocks").alias("r"))
    passing = dealt.select("band", "name", "root", F.lit(1).alias("role"), every("own_blocks").alias("u"), mine(2, "all_blocks").cast("int").alias("r"))
    return held.unionByName(passing).select(F.xxhash64("band", "u", "r").alias("g"), "role", "name", "root").distinct()


def links(docs: DataFrame, key: Column, near: float = NEAR) -> DataFrame:
    """a, b: keys (a long each, distinct) of documents; they join all documents with equal sets and all pairs of ``near`` or more that share a band."""
    rows = cut(sketches(docs, key))
    classes = cut(rows.groupBy("cls").agg(F.min("key").alias("name"), F.count("*").alias("times"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    same = join_groups(rows.select("key", "cls"), classes.select("cls", "name", "times"), ["cls"], "times", rows.count())
    equal = same.filter("key <> name").select(F.col("key").alias("a"), F.col("name").alias("b"))
    spread = classes.select("name", "n", F.explode("bands").alias("band"))
    buckets = cut(spread.groupBy("band").agg(F.min("name").alias("leader"), F.count("*").alias("k")).filter("k > 1"))
    members = cut(join_groups(spread, buckets, ["band"], "k", BANDS * classes.count()).drop("k"))
    texts = docs.select(key.alias("name"), F.col("text").cast("string").alias("text"))
    found = cut(_compared(texts, _stars(members), near))
    roots = components(found).select(F.col("node").alias("name"), "root")
    rooted = cut(members.join(roots.hint("merge"), "name", "left").select("band", "name", "n", F.coalesce("root", "name").alias("root")))
    return equal.union(found).union(cut(_compared(texts, _strangers(rooted), near)))
