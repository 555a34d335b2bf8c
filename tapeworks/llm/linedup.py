"""Line deduplication by winnowing over line hashes.

Of every WINDOW consecutive lines of a document the one with the smallest hash is a
fingerprint, so two documents that share a run of WINDOW lines share a fingerprint in it; a line of LEAST_WORDS words or LEAST_BYTES
bytes or more is one by itself. Fingerprints that occur once are dropped. At the other positions the windows of which the fingerprint is the minimum, on both sides,
are named by 128 bits of their lines, and those that also stand earlier in the corpus are deleted. As each window of a
repeated run has its fingerprint, a match goes on in both directions until the lines differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.common import cut, fresh, join_groups

#: The shortest run that counts as repeated: so many lines, or one line of so many words or of so many bytes in UTF-8. Bytes
#: are for scripts that don't part words by blanks: 16 Chinese characters say about as much as eight words.
WINDOW, LEAST_WORDS, LEAST_BYTES = 2, 8, 48

_BLANK = " \t\x0b\x0c\r"


def bare_lines(text: str | None) -> tuple[list[int], list[bytes]]:
    """Numbers (from 0) and UTF-8 bytes of the lines that aren't blank; blanks at a line's ends don't count."""
    bare = [line.strip(_BLANK) for line in (text or "").split("\n")]
    at = [i for i, line in enumerate(bare) if line]
    return at, [bare[i].encode("utf-8", "surrogatepass") for i in at]


def minima(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each window of consecutive lines, the place of its smallest hash, the last of equals; none for fewer lines."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64)
    seen = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.arange(n - window + 1) + window - 1 - seen[:, ::-1].argmin(axis=1)


def _key(docs: DataFrame) -> Column:
    """Rows with the same doc_id and text are the same document."""
    return F.xxhash64("doc_id", F.col("text").cast("string"))


def windows_at(lines: list[bytes], window: int = WINDOW, least_words: int = LEAST_WORDS, least_bytes: int = LEAST_BYTES) -> Iterator[tuple[int, list[tuple[int, int, bytes]]]]:
    """For each fingerprint of a document's lines: its hash, and the windows that it is the minimum of: first line, number of lines, name."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, lines), np.uint64, len(lines))
    signed = hashes.view(np.int64).tolist()
    held: dict[int, list[tuple[int, int, bytes]]] = {}
    for i, at in enumerate(minima(hashes, window).tolist()):
        held.setdefault(at, []).append((i, window, xxhash.xxh3_128_digest(b"\n".join(lines[i : i + window]))))
    if window > 1:
        for at, line in enumerate(lines):
            if len(line) >= least_bytes or len(line.split()) >= least_words:
                held.setdefault(at, []).append((at, 1, xxhash.xxh3_128_digest(line)))
    for at, windows in held.items():
        yield signed[at], windows


def fingerprints(docs: DataFrame, window: int = WINDOW, least_words: int = LEAST_WORDS, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """doc_id, key, fingerprint, windows (those that it is the minimum of: first, its place among the lines that aren't blank; lines, how many; run, its name)."""
    each = pa.struct([("first", pa.int32()), ("lines", pa.int32()), ("run", pa.binary())])
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("fingerprint", pa.int64()), ("windows", pa.list_(each))])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows += [(doc_id, key, f, w) for f, w in windows_at(bare_lines(text)[1], window, least_words, least_bytes)]
            if not rows:
                continue
            *plain, windows = zip(*rows, strict=True)
            ends = np.cumsum([0, *map(len, windows)]).astype(np.int32)
            flat = [pa.array(c, t.type) for c, t in zip(zip(*(w for some in windows for w in some), strict=True), each, strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(flat, fields=list(each)))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in plain), lists], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), _key(docs).alias("key"), F.col("text").cast("string")).mapInArrow(
        find, "doc_id bigint, key bigint, fingerprint bigint, windows array<struct<first: int, lines: int, run: binary>>"
    )


def later_runs(docs: DataFrame, window: int = WINDOW, least_words: int = LEAST_WORDS, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """doc_id, key, first, lines: places of windows that also stand earlier (by doc_id, then text, then place)."""
    prints = cut(fingerprints(docs, window, least_words, least_bytes))
    shared = cut(prints.groupBy("fingerprint").agg(F.count("*").alias("times")).filter("times > 1"))
    both = join_groups(prints, shared, ["fingerprint"], "times", prints.count())
    runs = cut(both.select("doc_id", "key", F.explode("windows").alias("w")).select("doc_id", "key", "w.first", "w.lines", "w.run"))
    # Rows that are the same document have the same places, so none of them is later.
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "first")
    earliest = runs.groupBy("lines", "run").agg(F.min(place).alias("earliest"), F.count("*").alias("times")).filter("times > 1")
    again = join_groups(runs, cut(earliest), ["lines", "run"], "times", runs.count())
    return again.filter(place > F.col("earliest")).select("doc_id", "key", "first", "lines")


def remove_lines(text: str, gone: set[int]) -> str:
    """The text without its lines number ``gone`` among those that aren't blank."""
    at, _ = bare_lines(text)
    raw = {at[g] for g in gone}
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in raw)


def dedup_lines(docs: DataFrame, window: int = WINDOW, least_words: int = LEAST_WORDS, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``docs`` without the lines of later repeated runs, and n_lines_, n_removed_ (lines that aren't blank) at the end.

    Order of the corpus: doc_id (null last), then a hash of the text, then line. Blank lines neither count nor break a
    run, and stay. Runs of fewer than ``window`` lines stay, unless they are a line of ``least_words`` words or ``least_bytes`` bytes
    or more, and so does the first place of every run and line. Null and empty texts have no lines and stay. Rows that share doc_id and text are one document: no row of it makes another go.
    """
    taken = list(docs.columns)
    n_lines, n_removed = fresh("n_lines_", taken), fresh("n_removed_", taken)
    key, places, gone_id, gone_key = (fresh(c, taken) for c in ("key_", "places_", "gone_id_", "gone_key_"))
    gone = later_runs(docs.select("doc_id", "text"), window, least_words, least_bytes).groupBy("doc_id", "key").agg(F.collect_set(F.struct("first", "lines")).alias(places))
    gone = cut(gone.select(F.col("doc_id").alias(gone_id), F.col("key").alias(gone_key), places)).hint("merge")  # the same plan at every size
    marked = docs.withColumn(key, _key(docs))
    joined = marked.join(gone, (F.col(key) == F.col(gone_key)) & marked["doc_id"].eqNullSafe(gone[gone_id]), "left").select(*docs.columns, places)
    at = docs.columns.index("text")
    out = T.StructType([*docs.schema.fields, T.StructField(n_lines, T.LongType()), T.StructField(n_removed, T.LongType())])

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before, removed = [], [], []
            for text, runs in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                lines = {r["first"] + i for r in runs or () for i in range(r["lines"])}
                before.append(len(bare_lines(text)[0]))
                removed.append(len(lines))
                texts.append(remove_lines(text, lines) if lines else text)
            columns = [pa.array(texts, c.type) if i == at else c for i, c in enumerate(batch.columns[:-1])]
            names = [*batch.schema.names[:-1], n_lines, n_removed]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(before, pa.int64()), pa.array(removed, pa.int64())], names=names)

    return joined.mapInArrow(drop, out)
