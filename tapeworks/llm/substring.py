"""Substring deduplication by recompression.

Documents are sequences of words. Recompression renames runs of one symbol and pairs of symbols: a symbol's class (left
or right, a bit of its name) decides alone whether it pairs with its neighbour, and a new symbol's name is a hash of its parts' names,
the same everywhere. So equal passages get the same symbols inside and differ only near their ends; the bounds on a
symbol's words bound the words near an end that the surroundings can reach.

In Spark rounds the names of symbols of rising levels meet. A symbol whose name stands nowhere else rules out
each window that holds it in its sure inner part; what is left after a round is named on the next level,
and in the last round the windows themselves are named by 128 bits of all their words. A window that no round rules out stands twice.

Only names and places meet in shuffles, packed many to a row; a task names what it repeats
once, so a passage that all documents share stays as small as one of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import cut, fresh, shuffle_width

WINDOW = 35
#: Rounds in order: what is renamed, and the words that a new symbol has at most (of runs: the symbols; longer ones are one symbol that joins no other).
ROUNDS = (("runs", 2), ("pairs", 3), ("pairs", 5), ("pairs", 8))
#: Rounds done before the names meet in Spark, level after level.
LEVELS = (3, 4)
#: Words that a task packs together, and shares of the names for each partition: a task holds one share at a time.
GROUP_WORDS, SHARES = 1_000_000, 8

_ODD, _ODD2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def unsure(rounds: tuple[tuple[str, int], ...]) -> int:
    """Words at a passage's end in which its symbols may depend on what is outside.

    A round of runs costs what a run that it renames may have, as longer ones stay apart however long they are; a round of
    pairs costs one symbol more, the longest there was before.
    """
    total, longest = 0, 1
    for kind, most in rounds:
        total += most if kind == "runs" else longest
        longest = max(longest, most)
    return total


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def wide_hashes(words: list[bytes]) -> np.ndarray:
    """128 bits a word, as two columns."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(-1, 2)


def stretch_hashes(h: np.ndarray, k: int, odd: int = _ODD) -> np.ndarray:
    """A hash of the ``k`` words from each place on, from those of lengths that are powers of two."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out, at, power, size = None, 0, h, 1
        while True:
            if k & size:
                part = power[at : at + len(h) - k + 1]
                out = part if out is None else out * np.uint64(pow(odd, size, 1 << 64)) + part
                at += size
            if size * 2 > k:
                return _mix(out)
            power = power[:-size] * np.uint64(pow(odd, size, 1 << 64)) + power[size:]
            size *= 2


def symbols(h: np.ndarray, first: np.ndarray, rounds: tuple[tuple[str, int], ...] = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Name, first word and number of words of each symbol after ``rounds``, for words ``h`` of documents that begin at ``first``.

    No symbol reaches over a document's end.
    """
    name, place = _mix(h), np.arange(len(h))
    opens = np.zeros(len(h), bool)
    opens[first[first < len(h)]] = True
    apart = np.zeros(len(h), bool)
    odd = np.uint64(_ODD)
    with np.errstate(over="ignore"):
        for nth, (kind, most) in enumerate(rounds):
            if len(place) < 2:
                break
            if kind == "runs":
                keep = np.concatenate([[True], opens[1:] | (name[1:] != name[:-1])])
                times = np.diff(np.append(np.flatnonzero(keep), len(place)))
                name, apart = name[keep], apart[keep] | (times > most)
                run = times > 1
                name[run] = _mix(name[run] * odd + np.minimum(times[run], most + 1).astype(np.uint64) + np.uint64(nth))
            else:
                size = np.diff(place, append=len(h))
                side = (name >> np.uint64(nth + 7)) & np.uint64(1)
                joins = ~opens[1:] & ~apart[1:] & ~apart[:-1] & (size[:-1] + size[1:] <= most) & (side[:-1] == 0) & (side[1:] == 1)
                left = np.flatnonzero(joins)
                name[left] = _mix(name[left] * odd + name[left + 1] + np.uint64(nth + 1))
                keep = np.ones(len(place), bool)
                keep[left + 1] = False
                name, apart = name[keep], apart[keep]
            place, opens = place[keep], opens[keep]
    return name, place, np.diff(place, append=len(h))


_MEET = pa.schema([("kind", pa.string()), ("share", pa.int64()), ("batch", pa.int64()), ("names", pa.binary()), ("a", pa.binary()), ("b", pa.binary())])
_MEET_DDL = "kind string, share bigint, batch bigint, names binary, a binary, b binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _MEET, strict=True)], schema=_MEET)


def _runs(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the names (rows of one or two numbers) in which equal ones follow each other, and which of them begin anew."""
    order = np.argsort(names[:, 0], kind="stable")
    inside = names[order]
    anew = np.ones(len(names), bool)
    anew[1:] = inside[1:, 0] != inside[:-1, 0]
    if names.shape[1] > 1:
        other = inside[1:, 1] != inside[:-1, 1]
        if (other & ~anew[1:]).any():
            order = np.lexsort(names.T[::-1])
            inside = names[order]
            anew[1:] = (inside[1:] != inside[:-1]).any(axis=1)
    return order, anew


def _alone(names: np.ndarray) -> np.ndarray:
    """Which names stand once."""
    order, anew = _runs(names)
    out = np.zeros(len(names), bool)
    out[order] = anew & np.append(anew[1:], True)[: len(anew)]
    return out


def _pack(names: np.ndarray, places: np.ndarray, sizes: np.ndarray, batch: int, shares: int) -> list[tuple]:
    """Rows for the shuffle, one for each share of the names: first those that stand once in this batch, with place and size, then each other one once."""
    order, anew = _runs(names)
    single = anew & np.append(anew[1:], True)[: len(anew)]
    parts = []
    for chosen in (order[single], order[anew & ~single]):
        share = ((names[chosen, 0] >> np.uint64(32)) * np.uint64(shares)) >> np.uint64(32)  # rises with the name
        parts.append((chosen, np.searchsorted(share, np.arange(shares + 1, dtype=np.uint64)).tolist()))
    (once, at), (others, to) = parts
    near, far = places.astype("<u4")[once], sizes.astype("<u4")[once]
    one, two = names[once], names[others]
    rows = []
    for s in range(shares):
        if at[s] < at[s + 1] or to[s] < to[s + 1]:
            mine = slice(at[s], at[s + 1])
            rows.append(("names", s, batch, one[mine].tobytes() + two[to[s] : to[s + 1]].tobytes(), near[mine].tobytes(), far[mine].tobytes()))
    return rows


def _meet(wide: int):
    """Names from all tasks meet, a share at a time: for each batch, the places and sizes of those that stand nowhere else. Other rows pass."""

    def settle(rows: list[dict]) -> Iterator[tuple]:
        names = [np.frombuffer(r["names"], np.uint64).reshape(-1, wide) for r in rows]
        alone = _alone(np.concatenate(names))
        at = 0
        for r, found in zip(rows, names, strict=True):
            sizes = np.frombuffer(r["b"], "<u4")
            mine = alone[at : at + len(sizes)]
            at += len(found)
            if mine.any():
                yield "alone", None, r["batch"], None, np.frombuffer(r["a"], "<u4")[mine].tobytes(), sizes[mine].tobytes()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of their share."""
        held: list[dict] = []
        out: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] != "names":
                    out.append(tuple(row.values()))
                    continue
                if held and held[0]["share"] != row["share"]:
                    out += settle(held)
                    held = []
                held.append(row)
                if len(out) >= 64:
                    yield _rows(out)
                    out = []
        if held:
            out += settle(held)
        if out:
            yield _rows(out)

    return meet


def _batch_id(nth: int) -> int:
    from pyspark import TaskContext

    return (TaskContext.get().partitionId() << 32) + nth


def _groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[tuple]]:
    """Documents of a window or more, some ``most`` words at a time, the text (second column) as words."""
    group: list[tuple] = []
    size = 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns, strict=True):
            words = words_of(row[1])
            if len(words) < WINDOW:
                continue
            group.append((row[0], words, *row[2:]))
            size += len(words)
            if size >= most:
                yield group
                group, size = [], 0
    if group:
        yield group


def _left(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a flag begins to hold, and how long it holds."""
    step = np.diff(np.concatenate([[0], edges.astype(np.int8), [0]]))
    begins = np.flatnonzero(step == 1)
    return begins, np.flatnonzero(step == -1) - begins


def unpacked(ranges: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(ranges, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _flags(begins: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, begins, 1)
    np.add.at(edge, begins + lengths, -1)
    return np.cumsum(edge[:n]) > 0


def possible(docs: DataFrame, level: int | None, width: int) -> DataFrame:
    """row, ranges: first words (as begins and lengths, pairs of longs) of the windows that this round doesn't rule out. A cut table.

    ``docs``: row (long, distinct), text, ranges (of the windows to look at; null: all). ``level``: rounds of recompression; None
    names the windows themselves.
    """
    ends, shares, most = (unsure(ROUNDS[:level]) if level else 0), SHARES * width, GROUP_WORDS

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nth, group in enumerate(_groups(batches, most)):
            first = np.concatenate([[0], np.cumsum([len(g[1]) for g in group])]).astype(np.int64)
            n = int(first[-1])
            words = [w for g in group for w in g[1]]
            ranges = [unpacked(g[2]) if g[2] is not None else (np.zeros(1, np.int64), np.array([len(g[1]) - WINDOW + 1])) for g in group]
            begins = np.concatenate([r[0] + f for r, f in zip(ranges, first.tolist(), strict=False)])
            lengths = np.concatenate([r[1] for r in ranges])
            before = np.concatenate([[0], np.cumsum(_flags(begins, lengths, n))])
            if level:
                names, places, sizes = symbols(hash_words(words), first, ROUNDS[:level])
                names = names[:, None]
            else:
                places, sizes = np.arange(n - WINDOW + 1), np.full(n - WINDOW + 1, WINDOW)
            # What lies in the sure part of some window that is still possible.
            low, high = np.maximum(places + sizes - WINDOW + ends, 0), places - ends
            sent = (low <= high) & (before[np.minimum(np.maximum(high, -1) + 1, n)] > before[np.minimum(low, n)])
            if not level:
                wide = wide_hashes(words)
                names = np.stack([stretch_hashes(np.ascontiguousarray(wide[:, k]), WINDOW, odd)[sent] for k, odd in ((0, _ODD), (1, _ODD2))], axis=1)
            else:
                names = names[sent]
            batch = _batch_id(nth)
            yield _rows([("docs", batch % shares, batch, np.array([g[0] for g in group], np.int64).tobytes(), first.tobytes(), np.stack([begins, lengths], axis=1).tobytes())])
            packed = _pack(names, places[sent], sizes[sent], batch, shares)
            for i in range(0, len(packed), 512):
                yield _rows(packed[i : i + 512])

    def to_documents(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        first = np.frombuffer(left.a.iloc[0], np.int64)
        open_ = _flags(*unpacked(left.b.iloc[0]), int(first[-1]))
        places, sizes = (np.frombuffer(b"".join(c), "<u4").astype(np.int64) for c in (right.a, right.b))
        low, high = np.maximum(places + sizes - WINDOW + ends, 0), places - ends
        open_ &= ~_flags(low, np.maximum(high - low + 1, 0), len(open_))
        rows = np.frombuffer(left.names.iloc[0], np.int64)
        begins, lengths = _left(open_)
        doc = np.searchsorted(first, begins, side="right") - 1
        out = []
        for at in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1) if len(doc) else []:
            d = doc[at[0]]
            out.append((int(rows[d]), np.stack([begins[at] - first[d], lengths[at]], axis=1).tobytes()))
        return pd.DataFrame(out, columns=["row", "ranges"])

    sent = docs.select("row", F.col("text").cast("string"), "ranges").mapInArrow(send, _MEET_DDL)
    dealt = sent.repartitionById(width, F.pmod("share", F.lit(width)).cast("int")).sortWithinPartitions("share")
    met = cut(dealt.mapInArrow(_meet(1 if level else 2), _MEET_DDL).select("kind", "batch", "names", "a", "b"), "kind")
    groups = [met.filter(F.col("kind") == kind).groupBy("batch") for kind in ("docs", "alone")]
    return cut(groups[0].cogroup(groups[1]).applyInPandas(to_documents, "row bigint, ranges binary"))


def uncovered(n: int, ranges: bytes) -> np.ndarray:
    """Of ``n`` words, those that no window of ``ranges`` covers."""
    begins, lengths = unpacked(ranges)
    return ~_flags(begins, lengths + WINDOW - 1, n)


def joined_sha256(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _whole(marked: DataFrame) -> DataFrame:
    """doc_id, row, n_words, kept_sha256 of each row as if nothing were removed."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_words", pa.int64()), ("kept_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(len, words), pa.int64()), pa.array(map(joined_sha256, words), pa.string())], schema=schema)

    return marked.select("doc_id", "row", "text").mapInArrow(digest, "doc_id bigint, row bigint, n_words bigint, kept_sha256 string")


def repeats(docs: DataFrame) -> DataFrame:
    """row, text, ranges (begins and lengths of the repeated windows' first words) of the documents that have any. ``docs``: row (long, distinct), text."""
    width = shuffle_width(docs.sparkSession)
    docs = docs.select("row", F.col("text").cast("string").alias("text"))
    left = docs.withColumn("ranges", F.lit(None).cast("binary"))
    for level in (*LEVELS, None):
        found = possible(left, level, width)
        left = (docs if level == LEVELS[0] else left.drop("ranges")).join(found.hint("merge"), "row")  # the same plan at every size
        left = cut(left) if level else left
    return left


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for each row of ``docs``.

    A word goes if a window of WINDOW words covers it that starts anywhere else too. Null and empty texts have no
    words; a document of fewer words than a window loses none. Rows that repeat repeat each other's
    windows, so all their windowed words go. Other columns are ignored.
    """
    schema = pa.schema([("row", pa.int64()), ("n_removed", pa.int64()), ("left_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, shas = [], []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = words_of(text)
                keep = uncovered(len(words), ranges)
                removed.append(len(words) - int(keep.sum()))
                shas.append(joined_sha256([words[i] for i in np.flatnonzero(keep)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(shas, pa.string())], schema=schema)

    marked = cut(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string")))  # fixed by being written
    changed = cut(repeats(marked).select("row", "text", "ranges").mapInArrow(digest, "row bigint, n_removed bigint, left_sha256 string"))
    joined = _whole(marked).join(changed.hint("merge"), "row", "left")
    return joined.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("left_sha256", "kept_sha256").alias("kept_sha256"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the words of repeated windows removed from ``text``, what is left joined by one blank; texts without repeats stay as they are."""
    row, ranges = fresh("row_", docs.columns), fresh("ranges_", docs.columns)
    marked = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    found = repeats(marked.select(F.col(row).alias("row"), "text")).select(F.col("row").alias(row), F.col("ranges").alias(ranges))
    joined = marked.join(cut(found).hint("merge"), row, "left").select(*docs.columns, ranges)
    at = docs.columns.index("text")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, p in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                if p is not None:
                    words = words_of(text)
                    text = b" ".join(words[i] for i in np.flatnonzero(uncovered(len(words), p))).decode("utf-8", "surrogatepass")
                texts.append(text)
            columns = [pa.array(texts, c.type) if i == at else c for i, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return joined.mapInArrow(drop, docs.schema)
