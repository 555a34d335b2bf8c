"""Statistics of sliding windows of a fixed number of rows, over series that Spark has dealt and sorted.

Order statistics are kept from row to row: a window's values stay in one sorted list, and a row takes the oldest value out
and puts its own in by bisection; highest and lowest rows are the heads of monotone queues. Sums and
moments are taken anew for each window, centred, for thousands of rows at once.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: What one window length yields, each named with the length behind it.
STATISTICS = ("top", "bottom", "share", "first", "last", "high_at", "low_at", "highest", "lowest")
#: The quantiles that ``top`` and ``bottom`` are.
TOP, BOTTOM = 0.8, 0.2


def quantile(ordered: list[float], share: float) -> float:
    """Linear between the two nearest ranks."""
    at = share * (len(ordered) - 1)
    low = int(at)
    return ordered[low] if at == low else ordered[low] * (low + 1 - at) + ordered[low + 1] * (at - low)


class Sliding:
    """The last ``n`` rows of one series."""

    def __init__(self, n: int):
        self.n = n
        self.reset()

    def reset(self) -> None:
        self.ring: deque = deque()
        self.order: list[float] = []
        self.highs: deque = deque()
        self.lows: deque = deque()

    def add(self, i: int, close: float | None, high: float | None, low: float | None) -> tuple:
        """Take row ``i`` (they are consecutive) and give the window's STATISTICS."""
        ring, order, highs, lows, n = self.ring, self.order, self.highs, self.lows, self.n
        if len(ring) == n:
            old = ring.popleft()
            if old is not None:
                del order[bisect_left(order, old)]
        ring.append(close)
        if close is not None:
            insort(order, close)
        for queue, value in ((highs, high), (lows, None if low is None else -low)):
            if queue and queue[0][1] <= i - n:
                queue.popleft()
            if value is not None:
                while queue and queue[-1][0] <= value:
                    queue.pop()
                queue.append((value, i))
        high, high_at = highs[0] if highs else (None, None)
        low, low_at = lows[0] if lows else (None, None)
        if not order:
            return None, None, None, None, None, high_at, low_at, high, None if low is None else -low
        share = None if close is None else bisect_right(order, close) / len(order)
        return quantile(order, TOP), quantile(order, BOTTOM), share, order[0], order[-1], high_at, low_at, high, None if low is None else -low


#: Rows whose windows are laid out together; 2 MB a column for windows of 60.
ROWS = 4096


class Moments:
    """Sums and moments of the last ``n`` rows; rows come in batches, and the end of each is kept for the next."""

    def __init__(self, n: int, means: list[str], sums: list[str], deviations: list[str], pairs: list[tuple[str, str]]):
        self.n, self.means, self.sums, self.deviations, self.pairs = n, means, sums, deviations, pairs
        self.names = [f"{kind}_{c}_{n}" for kind, of in (("mean", means), ("sum", sums), ("std", deviations)) for c in of]
        self.names += [f"{kind}_{x}_{y}_{n}" for x, y in pairs for kind in ("covar", "spread", "var")]
        self.tail: dict[str, np.ndarray] = {}

    def of(self, columns: dict[str, np.ndarray], before: np.ndarray) -> list[np.ndarray]:
        """One array a name. ``before``: how many rows of its own series stand before each row, as far as ``n`` - 1. NaN is missing."""
        n, used = self.n, {*self.means, *self.sums, *self.deviations, *(c for p in self.pairs for c in p)}
        whole = {c: np.concatenate([self.tail.get(c, np.full(n - 1, np.nan)), columns[c]]) for c in used}
        self.tail = {c: x[len(x) - (n - 1) :] for c, x in whole.items()}
        parts: list[list[np.ndarray]] = [[] for _ in self.names]
        for a in range(0, len(before), ROWS):
            near = np.arange(n - 1, -1, -1) <= before[a : a + ROWS, None]
            for out, x in zip(parts, self._block({c: x[a : a + ROWS + n - 1] for c, x in whole.items()}, near), strict=True):
                out.append(x)
        return [np.concatenate(x) if x else np.zeros(0) for x in parts]

    def _block(self, columns: dict[str, np.ndarray], near: np.ndarray) -> Iterator[np.ndarray]:
        rows, there, count, total = {}, {}, {}, {}
        for c, x in columns.items():
            rows[c] = np.lib.stride_tricks.sliding_window_view(x, self.n)
            there[c] = near & ~np.isnan(rows[c])
            count[c], total[c] = there[c].sum(1), np.zeros(len(near))
            for k, seen in zip(rows[c].T, there[c].T, strict=True):  # from the oldest row on, as SQL engines add up a frame
                total[c] += np.where(seen, k, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = {c: total[c] / count[c] for c in columns}
            off = {}
            for c in {*self.deviations, *(x for p in self.pairs for x in p)}:
                varies = np.where(there[c], rows[c], -np.inf).max(1) > np.where(there[c], rows[c], np.inf).min(1)
                off[c] = np.where(there[c] & varies[:, None], rows[c] - mean[c][:, None], 0.0)
            yield from (mean[c] for c in self.means)
            yield from (np.where(count[c] > 0, total[c], np.nan) for c in self.sums)
            yield from (np.sqrt((off[c] * off[c]).sum(1) / (count[c] - 1)) for c in self.deviations)
            for x, y in self.pairs:  # rows of a pair are missing together
                yield self._covariance(rows[x], rows[y], there[x])
                yield self._covariance(rows[x], rows[x], there[x])
                yield np.sqrt((off[x] * off[x]).sum(1) / count[x]) * np.sqrt((off[y] * off[y]).sum(1) / count[y])

    @staticmethod
    def _covariance(x: np.ndarray, y: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Of the population, by updating means from the oldest row on, as SQL engines do."""
        n, mean_x, mean_y, moment = (np.zeros(len(there)) for _ in range(4))
        for a, b, seen in zip(x.T, y.T, there.T, strict=True):
            n += seen
            at = np.maximum(n, 1)
            dx, dy = np.where(seen, a - mean_x, 0.0), np.where(seen, b - mean_y, 0.0)
            mean_x += dx / at
            mean_y += dy / at
            moment += np.where(seen, dx * (b - mean_y), 0.0)
        return moment / n


def with_statistics(
    rows: DataFrame, windows: tuple[int, ...], key: list[str], means: list[str], sums: list[str], deviations: list[str], pairs: list[tuple[str, str]],
    order: str = "date", number: str = "i_",
) -> DataFrame:
    """``rows`` with statistics of the last n rows up to each, for each n of ``windows``; all are doubles named with n behind.

    ``rows`` (close, high, low, consecutive ``number``) are sorted by key and ``order`` within partitions that hold whole keys, for example by
    windows over the same key, whose exchange and sort then serve here too. Of the bars, STATISTICS: ``top`` and ``bottom`` are the
    closes' quantiles, ``share`` that of closes up to the row's own, ``first`` and ``last`` the closes' extremes,
    ``high_at`` and ``low_at`` the numbers of the highest and lowest rows (the latest of equal ones), NaN counts as infinite.
    Of the columns named: means, sums, sample deviations, and for pairs, whose two sides are missing together, of the population: the covariance, the
    first side's variance (``spread``) and the product of the deviations (``var``; 0 where a side doesn't vary). Missing and NaN values don't count in these.
    """
    moments = [Moments(n, means, sums, deviations, pairs) for n in windows]
    names = [f"{s}_{n}" for n in windows for s in STATISTICS] + [x for m in moments for x in m.names]
    columns, used = rows.columns, sorted({*means, *sums, *deviations, *(c for p in pairs for c in p)})
    at = {c: columns.index(c) for c in (*key, number, "close", "high", "low", *used)}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slides, series, run = [Sliding(n) for n in windows], None, 0
        for batch in batches:
            of = zip(*(batch.column(at[k]).to_pylist() for k in key), strict=True)
            prices = ([float("inf") if x is not None and x != x else x for x in batch.column(at[c]).cast(pa.float64()).to_pylist()] for c in ("close", "high", "low"))
            found: list[list[tuple]] = [[] for _ in windows]
            before = np.empty(batch.num_rows, np.int64)
            for k, (this, i, close, high, low) in enumerate(zip(of, batch.column(at[number]).cast(pa.int64()).to_pylist(), *prices, strict=True)):
                if this != series:
                    series, run = this, 0
                    for s in slides:
                        s.reset()
                before[k] = run
                run += 1
                for s, out in zip(slides, found, strict=True):
                    out.append(s.add(i, close, high, low))
            more = [pa.array(c, pa.float64()) for out in found for c in (zip(*out, strict=True) if out else [[]] * len(STATISTICS))]
            values = {c: batch.column(at[c]).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in used}
            more += [pa.array(x, pa.float64(), from_pandas=True) for m in moments for x in m.of(values, before)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*columns, *names])

    kept = rows.sortWithinPartitions(*key, order)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields] + [f"`{x}` double" for x in names]
    return kept.mapInArrow(add, ", ".join(fields))
