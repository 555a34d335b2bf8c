"""A Merkle manifest of a dataset: a tree of three-way hashes for each source, a tree of the sources' roots above.

A tree is made of aligned blocks of ``ARITY ** HEIGHT`` leaves. A block's nodes lie in one array in van Emde
Boas order: a subtree is cut at half its height, the part above comes first and the parts below follow one by one,
each laid out alike, so that a path from leaf to root touches few stretches of the array whatever their size. Addresses
are arithmetic; no pointers are kept. Block roots are the leaves of the next tier of blocks, until one block holds all.
Spark groups leaves by block, builds blocks in tasks, and carries the siblings of block roots down again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import cut, places

ARITY = 3
#: Levels of a block below its root: 729 leaves, 1093 nodes, 35 kB.
HEIGHT = 6
DIGEST = 32

_MEMBER = "array<struct<place: bigint, label: string, leaf: binary, altered: binary>>"
_BLOCK = "key string, size bigint, block bigint, labels array<string>, altered array<binary>, tree binary, root binary"
_PATH = "key string, place bigint, label string, digest string, before array<string>, after array<string>, subroot string, root string"
_PROOF = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def nodes(levels: int) -> int:
    """How many nodes a whole tree of so many levels has."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes ``index`` of a ``depth`` (0: the root) of a tree of ``levels`` lie."""
    if levels == 1:
        return np.zeros_like(index)
    above = levels // 2
    if depth < above:
        return address(above, depth, index)
    below, under = levels - above, ARITY ** (depth - above)
    return nodes(above) + index // under * nodes(below) + address(below, depth - above, index % under)


@cache
def addresses(levels: int) -> list[list[int]]:
    """Byte offsets of all nodes of a block, by depth."""
    return [(DIGEST * address(levels, d, np.arange(ARITY**d))).tolist() for d in range(levels)]


def levels_for(size: int, height: int) -> int:
    """Levels of a block of a tree that has ``size`` nodes in this tier: all of them, or fewer where one block holds all."""
    levels = 1
    while levels <= height and ARITY ** (levels - 1) < size:
        levels += 1
    return levels


def combine(digests: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def grow(leaves: list[bytes], levels: int) -> bytes:
    """A block over up to ``ARITY ** (levels - 1)`` leaves. Where these end early, a run of one still gets its own hash."""
    at = addresses(levels)
    tree = bytearray(DIGEST * nodes(levels))
    for where, leaf in zip(at[-1], leaves, strict=False):
        tree[where : where + DIGEST] = leaf
    count = len(leaves)
    for depth in range(levels - 2, -1, -1):
        below = [bytes(tree[a : a + DIGEST]) for a in at[depth + 1][:count]]
        count = -(-count // ARITY)
        for i, where in enumerate(at[depth][:count]):
            tree[where : where + DIGEST] = combine(below[ARITY * i : ARITY * i + ARITY])
    return bytes(tree)


def siblings(tree: bytes, levels: int, count: int, leaf: int) -> list[tuple[str, str]]:
    """For each level from a leaf up to the block's root: its run's other nodes, before and after it, as hex text."""
    found, at = [], addresses(levels)
    for depth in range(levels - 1, 0, -1):
        first = leaf - leaf % ARITY
        run = [tree[a : a + DIGEST] for a in at[depth][first : min(first + ARITY, count)]]
        found.append((b"".join(run[: leaf - first]).hex(), b"".join(run[leaf - first + 1 :]).hex()))
        leaf, count = leaf // ARITY, -(-count // ARITY)
    return found


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    for before, after in path:
        digest = hashlib.sha256(f"{before}{digest}{after}".encode()).hexdigest()
    return digest


def field(value: Column) -> Column:
    """``-`` for null, else the count of its UTF-8 bytes, ``:`` and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """key (of the source: ordered as sources are, null first), doc_id, leaf and altered (null where tampering changes nothing)."""
    text = F.col("text").cast("string")
    digest = lambda t: F.unhex(F.sha2(F.concat(*map(field, (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), t))), 256))
    meant = (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0) & F.contains(text, F.lit("\n"))
    return docs.select(
        F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit("")).alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
        digest(text).alias("leaf"), F.when(meant, digest(F.translate(text, "\n", ""))).alias("altered"),
    )


def _blocks(members: DataFrame, height: int) -> DataFrame:
    """Members (key, size, place, label, leaf, altered) grouped by block, each block grown in a task. A block's rows are bounded."""
    width = ARITY**height

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                key, size, block, rows = (c[i].as_py() for c in batch.columns)
                tree = grow([r["leaf"] for r in rows], levels_for(size, height))
                out = [[key], [size], [block], [[r["label"] for r in rows]], [[r["altered"] for r in rows]], [tree], [tree[:DIGEST]]]
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.binary()), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], [x.split()[0] for x in _BLOCK.split(", ")])

    block = F.floor(F.col("place") / width).alias("block")
    rows = F.array_sort(F.collect_list(F.struct("place", "label", "leaf", "altered"))).cast(_MEMBER)
    return cut(members.groupBy("key", "size", block).agg(rows.alias("rows")).mapInArrow(build, _BLOCK))


def tiers(members: DataFrame, height: int) -> list[DataFrame]:
    """Tables of blocks (key, size, block, labels, altered, tree, root), the leaves' first. The last tier of a tree has one block, number 0."""
    width = ARITY**height
    made = [_blocks(members, height)]
    while made[-1].filter(F.col("size") > width).limit(1).count():
        above = made[-1].filter(F.col("size") > width)
        made.append(_blocks(above.select(
            "key", F.ceil(F.col("size") / width).alias("size"), F.col("block").alias("place"), F.col("block").cast("string").alias("label"),
            F.col("root").alias("leaf"), F.lit(None).cast("binary").alias("altered"),
        ), height))
    return made


def roots(made: list[DataFrame], height: int) -> DataFrame:
    """key and root of each tree."""
    tops = [t.filter(F.col("size") <= ARITY**height).select("key", "root") for t in made]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def _with_paths(made: list[DataFrame], above: DataFrame, height: int) -> DataFrame:
    """The first tier's blocks with the path from their roots to the root of all. ``above``: key, before, after, subroot, root for each tree."""
    columns = ["key", "size", "block", "labels", "altered", "tree", "before", "after", "subroot", "root"]
    found = None
    for t in reversed(made):
        t = t.drop("root")
        blocks = t.filter(F.col("size") <= ARITY**height).join(above, "key").select(*columns)
        if found is not None:
            known = _members(found, height).select("key", F.col("place").alias("block"), "before", "after", "subroot", "root")
            blocks = blocks.unionByName(t.filter(F.col("size") > ARITY**height).join(known, ["key", "block"]).select(*columns))
        found = blocks
    return found


def _members(blocks: DataFrame, height: int) -> DataFrame:
    """Each member of some blocks with a path: its place in its tier, label, digest, and own path to the root of all."""
    names = [x.split()[0] for x in _PATH.split(", ")]
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), pa.string())

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                key, size, block, labels, _, tree, before, after, subroot, root = (c[i].as_py() for c in batch.columns)
                levels, n = levels_for(size, height), len(labels)
                own = [siblings(tree, levels, n, k) for k in range(n)]
                digests = [tree[a : a + DIGEST].hex() for a in addresses(levels)[-1][:n]]
                first = block * ARITY**height
                out = ([key] * n, list(range(first, first + n)), labels, digests, [[b for b, _ in p] + before for p in own], [[a for _, a in p] + after for p in own], [subroot] * n, [root] * n)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    return blocks.mapInArrow(down, _PATH)


def _prove(blocks: DataFrame, height: int) -> DataFrame:
    """One row a document of some blocks with a path: its digests, its proof, and the root folded again."""
    names = [x.split()[0] for x in _PROOF.split(", ")]
    kinds = (pa.int64(), *[pa.string()] * 5, pa.bool_())

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, size, _, labels, altered, tree, before, after, subroot, root = (c[i].as_py() for c in batch.columns)
                levels = levels_for(size, height)
                at, path = addresses(levels)[-1], list(zip(before, after, strict=True))
                above = "".join(b + a for b, a in path)
                rows = []
                for k, (label, other) in enumerate(zip(labels, altered, strict=True)):
                    own = siblings(tree, levels, len(labels), k)
                    leaf = tree[at[k] : at[k] + DIGEST].hex()
                    folded = fold(other.hex() if other else leaf, own + path)
                    proof = hashlib.sha256(("".join(b + a for b, a in own) + above).encode()).hexdigest()
                    rows.append((None if label is None else int(label), leaf, subroot, root, proof, folded, folded == root))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return blocks.mapInArrow(prove, _PROOF)


def manifest(docs: DataFrame, height: int = HEIGHT) -> tuple[list[DataFrame], list[DataFrame]]:
    """The stored tiers of the trees by source, and those of the tree over their roots.

    ``docs``: doc_id, source, lang, n_chars, text; other columns are ignored. Leaves ascend by doc_id, null first;
    rows of one doc_id by their leaves' digests, so rows that repeat wholly are leaves of their own and any order of
    them is the same tree. No rows make tables without rows.
    """
    stored = cut(leaves(docs))  # no texts from here on
    members = places(stored, ["key"], [F.col("doc_id").asc_nulls_first(), F.col("leaf")], "place", "size")
    low = tiers(members.select("key", "size", "place", F.col("doc_id").cast("string").alias("label"), "leaf", "altered"), height)
    tops = places(cut(roots(low, height)), [], [F.col("key")], "place", "size")
    high = tiers(tops.select(F.lit("").alias("key"), "size", "place", F.col("key").alias("label"), F.col("root").alias("leaf"), F.lit(None).cast("binary").alias("altered")), height)
    return low, high


def proofs(low: list[DataFrame], high: list[DataFrame], height: int = HEIGHT) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` is made from the altered leaf, where there is one, and the stored siblings.
    """
    none = F.array().cast("array<string>")
    top = roots(high, height).select("key", none.alias("before"), none.alias("after"), F.lit("").alias("subroot"), F.lower(F.hex("root")).alias("root"))
    sources = _members(_with_paths(high, top, height), height).select(F.col("label").alias("key"), "before", "after", F.col("digest").alias("subroot"), "root")
    return _prove(_with_paths(low, sources, height), height)


def verify(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    return proofs(*manifest(docs, height), height)
