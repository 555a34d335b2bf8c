"""Best-fit packing of documents into token sequences of one capacity.

Lengths alone decide a packing and there are at most ``capacity`` of them, so the
plan is made from a histogram (bounded, whatever the corpus size) and Spark deals
the rows into it: a row's rank among the rows of its length says which place it gets.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.common import cut, fresh, shuffle_width
from tapeworks.llm.tokens import encoded

CAPACITY = 2048

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PIECES_DDL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Encode whole texts, append id 0, cut what is longer than ``capacity``.

    A null or empty text is the single id 0. Other columns of ``docs`` are ignored.
    One row per piece: doc_id, piece, start, length, ids_crc32, and ids (binary, unsigned 32-bit) if asked for.
    """
    schema = _PIECES.append(pa.field("ids", pa.binary())) if with_ids else _PIECES

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded(tokenizer, batch.column(1)), strict=True):
                for piece, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    rows.append((doc_id, piece, at, len(part), zlib.crc32(part), part.tobytes() if with_ids else b"")[: len(schema)])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(pieces, _PIECES_DDL + (", ids binary" if with_ids else ""))


@dataclass
class Bins:
    """``count`` alike sequences: each holds the (length, how many) items in order and has ``gap`` ids left."""

    count: int
    gap: int
    items: list[tuple[int, int]] = field(default_factory=list)

    def take(self, n: int, length: int, each: int) -> Bins:
        """Split ``n`` of these off and put ``each`` items into them."""
        self.count -= n
        return Bins(n, self.gap - length * each, [*self.items, (length, each)])


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Bins]:
    """Plan sequences for ``histogram`` (length -> number of items).

    Items over a third of the capacity fit at most twice into a sequence: from the
    longest down, each is matched with the longest other one that still fits. Shorter
    items, longest first, go into the smallest gap that takes them, else a new sequence.
    Equal items are dealt together, so the work depends on the number of lengths only.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    bins: list[Bins] = []
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        longest = large[-1]
        mate_at = bisect.bisect_right(large, capacity - longest) - 1
        if mate_at < 0:
            bins.append(Bins(left[longest], capacity - longest, [(longest, 1)]))
            large.pop()
            continue
        mate = large[mate_at]
        if mate == longest:
            pairs, rest = divmod(left[longest], 2)
            large.pop()
            if pairs:
                bins.append(Bins(pairs, capacity - 2 * longest, [(longest, 2)]))
            if rest:
                mates = bisect.bisect_right(large, capacity - longest) - 1
                if mates < 0:
                    bins.append(Bins(1, capacity - longest, [(longest, 1)]))
                else:
                    bins.append(Bins(1, capacity - longest - large[mates], [(longest, 1), (large[mates], 1)]))
                    left[large[mates]] -= 1
                    if not left[large[mates]]:
                        large.pop(mates)
            continue
        pairs = min(left[longest], left[mate])
        bins.append(Bins(pairs, capacity - longest - mate, [(longest, 1), (mate, 1)]))
        for n, at in ((longest, -1), (mate, mate_at)):
            left[n] -= pairs
            if not left[n]:
                large.remove(n)

    by_gap: dict[int, list[Bins]] = {}
    gaps: list[int] = []

    def offer(b: Bins) -> None:
        if b.count and b.gap:
            if b.gap not in by_gap:
                bisect.insort(gaps, b.gap)
            by_gap.setdefault(b.gap, []).append(b)

    for b in bins:
        offer(b)
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        items = left[length]
        while items:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                each = capacity // length
                for n, k in ((items // each, each), (1, items % each)):
                    if n and k:
                        bins.append(Bins(n, capacity - length * k, [(length, k)]))
                        offer(bins[-1])
                break
            gap = gaps[at]
            found = by_gap[gap][-1]
            each = gap // length
            n = min(found.count, items // each)
            if n == 0:
                n, each = 1, items
            bins.append(found.take(n, length, each))
            items -= n * each
            if not found.count:
                by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap], gaps[at]
            offer(bins[-1])
    return [b for b in bins if b.count]


def pack(pieces: DataFrame, capacity: int = CAPACITY, key: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows that have a ``length`` of 1 to ``capacity``.

    ``pieces`` should be a written table: it is read for the histogram and again for the ranks.
    Ties (equal keys) get distinct places; an empty table gives an empty result. Columns of the new names are replaced, others kept.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    starts, base, each, offsets = [], [], [], []
    rank = dict.fromkeys(histogram, 0)
    sequence = 0
    for b in best_fit(histogram, capacity):
        offset = 0
        for length, n in b.items:
            starts.append((length << 44) + rank[length])
            base.append(sequence)
            each.append(n)
            offsets.append(offset)
            rank[length] += n * b.count
            offset += length * n
        sequence += b.count
    order = np.argsort(np.array(starts, np.int64))
    starts_, base_, each_, offsets_ = (np.array(x, np.int64)[order] for x in (starts, base, each, offsets))

    # A length may be that of a third of all rows: ranks are counted within salted shares of it.
    pieces = pieces.drop("sequence_id", "offset")
    salt, number, before, nth, rank_ = (fresh(c, pieces.columns) for c in ("salt_", "n_", "before_", "nth_", "rank_"))
    salted = pieces.withColumn(salt, F.pmod(F.xxhash64(*key), F.lit(shuffle_width(spark))))
    shares = salted.groupBy("length", salt).agg(F.count("*").alias(number))
    so_far = F.sum(number).over(Window.partitionBy("length").orderBy(salt)) - F.col(number)
    order_by = [F.col(c).asc_nulls_first() for c in (*key, *(c for c in pieces.columns if c not in key and c != "ids"))]
    ranked = (
        salted.withColumn(nth, F.row_number().over(Window.partitionBy("length", salt).orderBy(*order_by)))
        .join(shares.select("length", salt, so_far.alias(before)), ["length", salt])
        .withColumn(rank_, F.col(before) + F.col(nth) - 1)
        .select(*pieces.columns, rank_)
    )
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            nth = batch.columns[-1].to_numpy()
            at = np.searchsorted(starts_, (length << 44) + nth, side="right") - 1
            within = (length << 44) + nth - starts_[at]
            columns, names = batch.columns[:-1], batch.schema.names[:-1]
            columns += [pa.array(base_[at] + within // each_[at]), pa.array(offsets_[at] + within % each_[at] * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Cut, then pack whole documents; one row per piece with its sequence and place."""
    return pack(cut(token_pieces(docs, tokenizer, capacity, with_ids)), capacity)


def assemble(packed: DataFrame) -> DataFrame:
    """Sequences from packed pieces that carry ``ids``: sequence_id, n_ids, ids (binary). A sequence is at most one capacity long."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    hexed = F.array_join(F.transform(parts, lambda p: F.hex(p["ids"])), "")
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), F.unhex(hexed).alias("ids"))
