"""A content-addressed store of token ids.

A document's ids are cut into chunks where a rolling hash of the last ids says so, so
equal passages give equal chunks wherever they stand. Layout of a store folder:

* ``kind=chunk``: each distinct chunk once: hash, n, width (bytes an id), payload;
* ``recipes``: one row per document in ascending doc_id order (shards by range, sorted
  within): shard, place in the shard, doc_id, n_tokens, start, chunk hashes, Merkle root;
* ``manifest``: one row per shard: documents, ids, Merkle root over its documents' roots.

Reading back checks every payload against its hash and every recipe against its roots.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import HOT_SHARE, cut, shared_folder, shuffle_width
from tapeworks.llm.tokens import encoder

#: Ids that the rolling hash sees (a power of two), and bounds and mean of a chunk's length.
REACH, SHORTEST, MEAN, LONGEST = 32, 256, 1024, 4096
#: Chunk hashes that a task remembers so as to send a chunk's payload once.
SEEN = 200_000
BATCH_BYTES = 4 << 20

_POLY = 0xEDB88320


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    path: str

    @property
    def chunks(self) -> DataFrame:
        return self.spark.read.schema("hash binary, n int, width int, payload binary, kind string").parquet(f"{self.path}/parts").filter("kind = 'chunk'").drop("kind")

    @property
    def recipes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/recipes")

    @property
    def manifest(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/manifest")


def _gear(ids: np.ndarray) -> np.ndarray:
    """At each place, a hash of the REACH ids that end there (fewer at the start)."""
    with np.errstate(over="ignore"):
        h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        k = 1
        while k < REACH:
            more = h * np.uint64(pow(0xBF58476D1CE4E5B9, k, 1 << 64))
            h[k:] += more[:-k]
            k *= 2
        return (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)


def marks(ids: np.ndarray) -> np.ndarray:
    """Places after which a chunk may end. The first SHORTEST ids of a document never count, so documents may follow each other in ``ids``."""
    return np.flatnonzero(_gear(ids) >> np.uint64(32) < np.uint64((1 << 32) // (MEAN - SHORTEST))) + 1


def chunk_ends(n: int, marks: list[int]) -> list[int]:
    """Where chunks of ``n`` ids end. A place depends on the ids before it since the last cut only, so equal runs fall into step."""
    ends, at, i = [], 0, 0
    while n - at > SHORTEST:
        while i < len(marks) and marks[i] < at + SHORTEST:
            i += 1
        at = min(marks[i] if i < len(marks) else n, at + LONGEST, n)
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def merkle(hashes: list[bytes]) -> bytes:
    """Root of a binary hash tree; an odd last node moves up as it is. No hashes: 16 zero bytes."""
    level = list(hashes) or [bytes(16)]
    while len(level) > 1:
        paired = [hashlib.blake2b(a + b, digest_size=16).digest() for a, b in zip(level[::2], level[1::2], strict=False)]
        level = paired + level[len(paired) * 2 :]
    return level[0]


_PART = pa.schema([("kind", pa.string()), ("route", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("hashes", pa.binary()), ("lengths", pa.binary()), ("root", pa.binary()), ("hash", pa.binary()), ("width", pa.int32()), ("payload", pa.binary())])
_PART_DDL = "kind string, route bigint, doc_id bigint, n int, hashes binary, lengths binary, root binary, hash binary, width int, payload binary"


def _parts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One recipe per document, and each chunk of a task once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            doc_ids = iter(batch.column(0).to_pylist())
            for ids, at in encoder(tokenizer).encode(batch.column(1)):
                yield from _batches(_rows(ids, at, doc_ids, seen))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encode, _PART_DDL)


def _rows(ids: np.ndarray, at: np.ndarray, doc_ids: Iterator[int | None], seen: set[bytes]) -> Iterator[tuple]:
    """Of documents that follow each other in ``ids`` and begin at ``at``: each one's recipe, and the chunks that weren't seen."""
    wide = np.maximum.reduceat(ids, at[:-1]) >= 1 << 16
    narrow = memoryview(ids.astype("<u2")).cast("B")
    full = memoryview(np.ascontiguousarray(ids)).cast("B")
    places = marks(ids)
    cuts = np.searchsorted(places, at, side="right").tolist()
    bounds, places = at.tolist(), places.tolist()
    for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        raw, width, person = (full, 4, b"u4") if wide[k] else (narrow, 2, b"u2")
        hashes, lengths, begin = [], [], a
        for end in chunk_ends(b - a, [x - a for x in places[cuts[k] : cuts[k + 1]]]):
            payload = raw[begin * width : (a + end) * width]
            h = hashlib.blake2b(payload, digest_size=16, person=person).digest()
            if h not in seen:
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(h)
                yield "chunk", int.from_bytes(h[:8], "little", signed=True), None, a + end - begin, None, None, None, h, width, bytes(payload)
            hashes.append(h)
            lengths.append(a + end - begin)
            begin = a + end
        root = merkle(hashes)
        route = int.from_bytes(root[:8], "little") + (k + 1) * 0x9E3779B97F4A7C15 & (1 << 63) - 1  # copies go apart
        yield "recipe", route, next(doc_ids), b - a, b"".join(hashes), np.array(lengths, "<u4").tobytes(), root, None, None, None


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Some BATCH_BYTES of payload at a time."""
    some: list[tuple] = []
    size = 0
    for row in rows:
        some.append(row)
        size += len(row[-1] or row[4])
        if size > BATCH_BYTES:
            yield _batch(some)
            some, size = [], 0
    if some:
        yield _batch(some)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PART, strict=True)], schema=_PART)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of their hash, drop chunks that equal the one before; recipes, which have none, pass."""
    last = None
    for batch in batches:
        keep = []
        for h in batch.column(7).to_pylist():
            keep.append(h is None or h != last)
            last = h
        yield batch.filter(pa.array(keep, pa.bool_()))


def write_store(docs: DataFrame, tokenizer: str, path: str | None = None) -> Store:
    """Encode whole texts (null: empty), append id 0 to each, and write them as a store.

    Ids come in ascending doc_id order, a null doc_id first; rows that repeat are stored each
    for itself (their chunks once). An empty table gives an empty store. Other columns are ignored.
    """
    spark = docs.sparkSession
    path = path or shared_folder(spark)
    width = shuffle_width(spark)
    dealt = _parts(docs, tokenizer).repartition(width, "kind", "route").sortWithinPartitions("hash").mapInArrow(_once, _PART_DDL)
    dealt.write.partitionBy("kind").option("compression", "snappy").parquet(f"{path}/parts")
    recipe = "doc_id bigint, n int, hashes binary, lengths binary, root binary, kind string"
    recipes = spark.read.schema(recipe).parquet(f"{path}/parts").filter("kind = 'recipe'").drop("kind")
    ranged = recipes.repartitionByRange(width, F.col("doc_id").asc_nulls_first(), "root").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "root")
    numbered = ranged.select(F.spark_partition_id().alias("shard"), F.monotonically_increasing_id().alias("place"), F.col("n").cast("long").alias("n_tokens"), "doc_id", "hashes", "lengths", "root")
    numbered.write.option("compression", "zstd").parquet(f"{path}/shards")
    shards = spark.read.schema(numbered.schema).parquet(f"{path}/shards")
    totals = sorted((r["shard"], r["ids"]) for r in shards.groupBy("shard").agg(F.sum("n_tokens").alias("ids")).collect())  # a row per shard
    before, so_far = [], 0
    for shard, ids in totals:
        before.append((shard, so_far))
        so_far += ids
    starts = spark.createDataFrame(before, "shard int, before bigint")
    within = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("place")) - F.col("n_tokens")
    final = shards.join(F.broadcast(starts), "shard").withColumn("start", F.col("before") + within).drop("before")
    final.write.option("compression", "zstd").parquet(f"{path}/recipes")

    store = Store(spark, path)
    _sealed(store.recipes).write.parquet(f"{path}/manifest")
    return store


def _sealed(recipes: DataFrame) -> DataFrame:
    """shard, documents, ids, root of each shard, from its recipes."""

    def seal(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        return pd.DataFrame([(int(pdf.shard.iloc[0]), len(pdf), int(pdf.n_tokens.sum()), merkle(list(pdf.root)))], columns=["shard", "documents", "ids", "root"])

    return recipes.select("shard", "place", "n_tokens", "root").groupBy("shard").applyInPandas(seal, "shard int, documents bigint, ids bigint, root binary")


def check_manifest(store: Store) -> None:
    """Raise where a shard's documents, ids or Merkle root aren't those of its manifest row, or one of the two is lost."""
    there = _sealed(store.recipes).select("shard", F.struct("documents", "ids", "root").alias("there"))
    stated = store.manifest.select("shard", F.struct("documents", "ids", "root").alias("stated"))
    wrong = there.join(stated, "shard", "full").filter(~F.col("there").eqNullSafe(F.col("stated"))).select("shard").first()
    if wrong:
        raise ValueError(f"shard {wrong['shard']} doesn't fit the manifest")


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials modulo the CRC-32 one, bits reversed, element by element."""
    a, b = np.asarray(a, np.uint32), np.array(b, np.uint32)
    out = np.zeros(np.broadcast(a, b).shape, np.uint32)
    for i in range(31, -1, -1):
        out ^= np.where(a >> np.uint32(i) & np.uint32(1), b, np.uint32(0))
        b = np.where(b & np.uint32(1), (b >> np.uint32(1)) ^ np.uint32(_POLY), b >> np.uint32(1))
    return out


def _shifts(longest: int) -> np.ndarray:
    """For 0 to ``longest`` ids: what appending so many 4-byte ids multiplies a checksum by."""
    table = np.full(1, 1 << 31, np.uint32)
    step = np.uint32(1 << 31)
    for _ in range(32):  # x to the power of 32
        step = (step >> np.uint32(1)) ^ np.uint32(_POLY) if step & 1 else step >> np.uint32(1)
    power = np.array([step], np.uint32)
    while len(table) <= longest:
        table = np.concatenate([table, _times(power, table)])
        power = _times(power, power)
    return table[: longest + 1]


def joined_crc(crcs: list[np.ndarray], lengths: list[np.ndarray]) -> np.ndarray:
    """CRC-32 of each document from those of its chunks, in order, and their numbers of ids."""
    out = np.zeros(len(crcs), np.uint32)
    if not len(crcs):
        return out
    shifts = _shifts(LONGEST)
    count = np.array([len(c) for c in crcs])
    order = np.argsort(-count, kind="stable")
    for k in range(count.max(initial=0)):
        some = order[: np.searchsorted(-count[order], -k, side="left")]
        c = np.array([crcs[i][k] for i in some], np.uint32)
        n = np.array([lengths[i][k] for i in some], np.int64)
        out[some] = _times(shifts[n], out[some]) ^ c
    return out


def chunk_hash(payload: bytes, width: int) -> bytes:
    return hashlib.blake2b(payload, digest_size=16, person=b"u4" if width == 4 else b"u2").digest()


def checked_chunks(store: Store) -> DataFrame:
    """hash, n, crc of each stored chunk, from its payload; raises where a payload isn't what its hash says."""
    schema = pa.schema([("hash", pa.binary()), ("n", pa.int64()), ("crc", pa.int64())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, crcs, sizes = batch.column(0), [], []
            for h, width, payload in zip(names.to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if chunk_hash(payload, width) != h:
                    raise ValueError(f"chunk {h.hex()} is damaged")
                ids = np.frombuffer(payload, f"<u{width}")
                crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                sizes.append(len(ids))
            yield pa.RecordBatch.from_arrays([names, pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())], schema=schema)

    return store.chunks.select("hash", "width", "payload").mapInArrow(check, "hash binary, n bigint, crc bigint")


def _steps(store: Store) -> DataFrame:
    """A row for each chunk of each recipe: shard, place, seq, hash."""
    seq = F.explode(F.sequence(F.lit(0), F.expr("octet_length(hashes) div 16 - 1")))
    return store.recipes.select("shard", "place", "hashes", seq.alias("seq")).select("shard", "place", "seq", F.expr("substring(hashes, seq * 16 + 1, 16)").alias("hash"))


def _with_chunks(store: Store, chunks: DataFrame, *columns: str) -> DataFrame:
    """Each recipe with ``steps``: its chunks that were found, in order, as seq and ``columns`` of ``chunks`` (hash and these). Null if none was.

    Chunks that very many steps name (fewer than HOT_SHARE) are joined by broadcast, the others by their hash.
    """
    steps = _steps(store)
    total = store.recipes.agg(F.sum(F.expr("octet_length(hashes) div 16"))).first()[0] or 0
    hot = F.broadcast(cut(steps.groupBy("hash").count().filter(F.col("count") > total // HOT_SHARE + 1).select("hash")))
    by_hot = steps.join(F.broadcast(chunks.join(hot, "hash")), "hash")
    by_hash = steps.join(hot, "hash", "left_anti").join(chunks, "hash")
    found = by_hot.unionByName(by_hash).groupBy("shard", "place").agg(F.array_sort(F.collect_list(F.struct("seq", *columns))).alias("steps"))
    return store.recipes.join(found, ["shard", "place"], "left")


def document_digests(store: Store) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read back from the store and verified.

    Payloads are read where they lie; only their lengths and checksums meet the recipes, and a document's
    checksum follows from its chunks'. Raises where a chunk is missing or a length, a root or the manifest doesn't fit.
    """
    check_manifest(store)
    whole = _with_chunks(store, cut(checked_chunks(store)), "n", "crc").select("doc_id", "start", "n_tokens", "hashes", "root", F.col("steps.n").alias("n"), F.col("steps.crc").alias("crc"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, start, n_tokens, hashes, root, n, crc = batch.columns
            for raw, top in zip(hashes.to_pylist(), root.to_pylist(), strict=True):
                if merkle([raw[i : i + 16] for i in range(0, len(raw), 16)]) != top:
                    raise ValueError("a recipe doesn't fit its root")
            lengths = [np.array(x or [], np.int64) for x in n.to_pylist()]
            if any(len(x) * 16 != len(raw) or x.sum() != t for x, raw, t in zip(lengths, hashes.to_pylist(), n_tokens.to_pylist(), strict=True)):
                raise ValueError("a chunk is missing or a recipe's length is wrong")
            crcs = joined_crc(crc.to_pylist(), lengths)
            yield pa.RecordBatch.from_arrays([doc_id, start, n_tokens, pa.array(crcs.astype(np.int64))], schema=schema)

    return whole.mapInArrow(digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_documents(store: Store) -> DataFrame:
    """doc_id, start, ids (array) of each document, rebuilt from the chunks' payloads and verified as in ``document_digests``."""
    check_manifest(store)
    whole = _with_chunks(store, store.chunks.select("hash", "width", "payload"), "width", "payload").select("doc_id", "start", "steps", "n_tokens", "hashes", "root")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for steps, n, raw, top in zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True):
                names = [raw[i : i + 16] for i in range(0, len(raw), 16)]
                if merkle(names) != top:
                    raise ValueError("a recipe doesn't fit its root")
                if len(names) != len(steps or ()):
                    raise ValueError("a chunk is missing")
                for name, s in zip(names, steps, strict=True):
                    if chunk_hash(s["payload"], s["width"]) != name:
                        raise ValueError(f"chunk {name.hex()} is damaged")
                ids.append(np.concatenate([np.frombuffer(s["payload"], f"<u{s['width']}").astype(np.int64) for s in steps]))
                if len(ids[-1]) != n:
                    raise ValueError("a recipe's length is wrong")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int64()))], schema=schema)

    return whole.mapInArrow(rebuild, "doc_id bigint, start bigint, ids array<bigint>")
