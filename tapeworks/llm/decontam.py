"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items are dealt to blocks of some BLOCK_WORDS words, long items in overlapping pieces. Blocks are taken one
after another: only the words of one block are on the driver and in its job, each worker builds that block's automaton
once, and documents stream through it; each word gets the length of the longest item passage that ends there. What a
block finds is written and meets the documents in the last block's pass, so memory doesn't grow with the benchmark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import cut, fresh

WINDOW = 10
#: Words of the items in one automaton, on average at most (some 100 MB in a worker), and in one piece of an item.
BLOCK_WORDS, PIECE_WORDS = 200_000, 10_000
#: The share of hit words above which a document goes as a whole.
MAX_COVERAGE = 0.8

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of digits, letters and all beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def word_spans(text: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words with their byte starts and ends in the UTF-8 text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_TABLE), np.uint8)
    inside = np.concatenate([[False], raw != 32, [False]]).astype(np.int8)
    step = np.diff(inside)
    return raw.tobytes().split(), np.flatnonzero(step == 1), np.flatnonzero(step == -1)


class Automaton:
    """Suffix automaton of several word sequences; finds windows of ``window`` words, and shorter sequences as wholes."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        owners: list[set[str | None]] = [set()]
        short: dict[tuple[int, ...], set[str | None]] = {}
        self.shortest = window
        for item_id, words in items:
            if not words:
                continue
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            if len(ids) < window:
                short.setdefault(tuple(ids), set()).add(item_id)
                self.shortest = min(self.shortest, len(ids))
            last = 0
            for c in ids:
                last = self._extend(last, c, owners)
        # An item occurs wherever one of its prefixes ends, and so at all suffix ancestors.
        for item_id, words in items:
            state = 0
            for w in words:
                state = self.next[state][self.vocab[w]]
                up = state
                while up > 0 and item_id not in owners[up]:
                    owners[up].add(item_id)
                    up = self.link[up]
        self.owners = [frozenset(x) for x in owners]
        self.short_at: dict[int, list[tuple[int, frozenset[str | None]]]] = {}
        for ids, who in short.items():
            state = 0
            for c in ids:
                state = self.next[state][c]
            self.short_at.setdefault(state, []).append((len(ids), frozenset(who)))
        #: The state that holds a state's suffix of window words (itself where it is shorter), and the nearest suffix, itself included,
        #: at which a short item ends (0: none). Links lead to shorter states, so those come first.
        self.window_at = list(range(len(self.length)))
        self.short_up = [0] * len(self.length)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            up = self.link[state]
            if self.length[up] >= window:
                self.window_at[state] = self.window_at[up]
            self.short_up[state] = state if state in self.short_at else self.short_up[up]

    def _extend(self, last: int, c: int, owners: list[set[str | None]]) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q, owners)
        new = len(length)
        length.append(length[last] + 1)
        nxt.append({})
        link.append(0)
        owners.append(set())
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q, owners)
        return new

    def _clone(self, p: int, c: int, q: int, owners: list[set[str | None]]) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(length)
        length.append(length[p] + 1)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        owners.append(set())
        link[q] = copy
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        return copy

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str | None]]:
        """Which words are hit, and the items with a window among them."""
        n = len(words)
        hit = np.zeros(n, bool)
        found: set[str | None] = set()
        if n < self.shortest or not self.vocab:
            return hit, found
        ids = np.fromiter(map(self.vocab.get, words, repeat(-1)), np.int64, n)
        known = np.diff(np.concatenate([[0], (ids >= 0).astype(np.int8), [0]]))
        begins, ends = np.flatnonzero(known == 1), np.flatnonzero(known == -1)
        long = ends - begins >= self.shortest
        for begin, end in zip(begins[long].tolist(), ends[long].tolist(), strict=True):
            self._stream(ids[begin:end].tolist(), begin, hit, found)
        return hit, found

    def _stream(self, ids: list[int], at: int, hit: np.ndarray, found: set[str | None]) -> None:
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for i, c in enumerate(ids):
            while state and c not in nxt[state]:
                state = link[state]
                matched = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                matched += 1
            else:
                matched = 0
            if matched >= window:
                hit[at + i - window + 1 : at + i + 1] = True
                found |= self.owners[self.window_at[state]]
            up = self.short_up[state]
            while up:
                for n, who in self.short_at[up]:
                    if n <= matched:
                        hit[at + i - n + 1 : at + i + 1] = True
                        found |= who
                up = self.short_up[link[up]]


_built: dict[bytes, Automaton] = {}


@dataclass(frozen=True)
class Block:
    """Pieces of items (id as text, words joined by blanks); a worker builds the automaton once and keeps that of one block."""

    pieces: tuple[tuple[str | None, bytes], ...]
    window: int

    def automaton(self) -> Automaton:
        name = hashlib.blake2b(repr((self.pieces, self.window)).encode(), digest_size=16).digest()
        if name not in _built:
            _built.clear()
            _built[name] = Automaton([(i, words.split()) for i, words in self.pieces], self.window)
        return _built[name]


def pieces_of(words: list[bytes], window: int = WINDOW, most: int = PIECE_WORDS) -> list[list[bytes]]:
    """A long item in pieces that overlap by ``window`` - 1 words, so each window is in one of them."""
    step = max(1, most - window + 1)
    return [words[at : at + most] for at in range(0, max(len(words) - window + 1, 1), step)] if words else []


def blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The items' words (null: none) in blocks; one block without any if there are no words. Blocks are read one at a time."""
    schema = pa.schema([("item_id", pa.string()), ("words", pa.binary()), ("n", pa.int64())])

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, b" ".join(p), len(p)) for i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) for p in pieces_of(words_of(t), window, min(PIECE_WORDS, block_words))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    pieces = cut(benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).mapInArrow(cut_up, "item_id string, words binary, n bigint").distinct())  # repeated items would all fall into one block
    total = pieces.agg(F.sum("n")).first()[0] or 0
    number = max(1, -(-total // block_words))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(number)))
    for b in range(number):
        yield Block(tuple((r["item_id"], bytes(r["words"])) for r in dealt.filter(F.col("block") == b).select("item_id", "words").collect()), window)


def _found_by(docs: DataFrame, block: Block) -> DataFrame:
    """key, hits (a bit a word), items of each text with hits; equal texts once. ``docs``: key, text."""
    schema = pa.schema([("key", pa.binary()), ("hits", pa.binary()), ("items", pa.list_(pa.string()))])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = block.automaton()
        for batch in batches:
            rows = []
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hit, items = automaton.scan(words_of(text))
                if items:
                    rows.append((key, np.packbits(hit).tobytes(), list(items)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return docs.mapInArrow(judge, "key binary, hits binary, items array<string>").dropDuplicates(["key"])


def _with_earlier(docs: DataFrame, benchmark: DataFrame, window: int, block_words: int) -> tuple[DataFrame, Block]:
    """``docs`` with two columns more, the hits and items of all blocks but the last (null if none), and the last block."""
    every = blocks(benchmark, window, block_words)
    last, found = next(every), None
    key = F.unhex(F.md5(F.col("text").cast("string")))
    for block in every:
        some = cut(_found_by(docs.select(key.alias("key"), F.col("text").cast("string")), last))
        found, last = some if found is None else found.unionByName(some), block
    names = [fresh(n, docs.columns) for n in ("earlier_hits_", "earlier_items_", "earlier_key_")]
    if found is None:
        return docs.withColumns({names[0]: F.lit(None).cast("array<binary>"), names[1]: F.lit(None).cast("array<string>")}), last
    merged = found.groupBy(F.col("key").alias(names[2])).agg(F.collect_list("hits").alias(names[0]), F.array_distinct(F.flatten(F.collect_list("items"))).alias(names[1]))
    return docs.withColumn(names[2], key).join(merged.hint("merge"), names[2], "left").select(*docs.columns, *names[:2]), last


def _all_hits(automaton: Automaton, words: list[bytes], hits: list[bytes] | None, items: list[str | None] | None) -> tuple[np.ndarray, set[str | None]]:
    hit, found = automaton.scan(words)
    for more in hits or ():
        hit |= np.unpackbits(np.frombuffer(more, np.uint8), count=len(words)).astype(bool)
    return hit, found.union(items or ())


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of ``docs``.

    Items shorter than ``window`` words are one window; items and documents without words match nothing. Rows of one
    item_id are one item; items without an id count as one more, which the digest leaves out.
    Repeated rows are judged each for itself. An empty benchmark or table gives zeros or no rows.
    """
    read, last = _with_earlier(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), benchmark, window, block_words)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = last.automaton()
        for batch in batches:
            rows = []
            for doc_id, text, hits, known in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                hit, items = _all_hits(automaton, words, hits, known)
                named = ",".join(sorted(i for i in items if i is not None))
                rows.append((doc_id, len(words), n := int(hit.sum()), len(items), hashlib.sha256(named.encode()).hexdigest(), n > 0))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return read.mapInArrow(judge, "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean")


def remove_hits(text: str | None, hit: np.ndarray, max_coverage: float = MAX_COVERAGE) -> str | None:
    """The text without its hit spans (a run of hit words, first to last); None if more than ``max_coverage`` of its words are hit."""
    if not text or not hit.any():
        return text
    if hit.mean() > max_coverage:
        return None
    raw = text.encode("utf-8", "surrogatepass")
    _, starts, ends = word_spans(text)
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    kept, at = [], 0
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist(), strict=True):
        kept.append(raw[at : starts[a]])
        at = int(ends[b])
    return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with hit spans deleted from ``text``; documents over ``max_coverage`` go. Other columns stay; untouched texts stay as they are."""
    read, last = _with_earlier(docs, benchmark, window, block_words)
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = last.automaton()
        for batch in batches:
            *own, earlier, known = batch.columns
            old = own[at].to_pylist()
            new = [remove_hits(t, _all_hits(automaton, words_of(t), hits, items)[0], max_coverage) for t, hits, items in zip(old, earlier.to_pylist(), known.to_pylist(), strict=True)]
            own[at] = pa.array(new, batch.schema.field(at).type)
            keep = pa.array([a is None or b is not None for a, b in zip(old, new, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays(own, names=batch.schema.names[:-2]).filter(keep)

    return read.mapInArrow(clean, docs.schema)
