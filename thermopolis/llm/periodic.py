"""Periodic runs of words: occurrences of dyadic blocks in their neighbourhood give candidate periods."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopolis.llm.common import lean, pieces, split_words
from thermopolis.llm.wordsuffixes import BLOCK, suffix_array

#: A run of so many words holds an aligned block of BLOCK words and its next occurrence.
MIN_LENGTH = 24
MIN_EXPONENT = 3
#: Texts are searched together up to so many bytes, a longer one alone.
PIECE = 4 << 20
#: So many occurrences of all blocks are asked for side by side; what is left goes by progressions.
ROUNDS = 16


class WaveletMatrix:
    """Range successor over a sequence of whole numbers, many queries at a time.

    Each level keeps its bits packed, with a running count for every 64 of them.
    """

    def __init__(self, values: np.ndarray):
        self.bits = max(int(values.max(initial=0)).bit_length(), 1)
        self.levels = []
        for bit in reversed(range(self.bits)):
            one = (values >> bit & 1).astype(bool)
            packed = np.packbits(np.append(one, np.zeros(64 - len(one) % 64, bool)), bitorder="little").view("<u8")
            counts = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))[:-1]
            self.levels.append((packed, counts, len(one) - int(one.sum())))
            values = np.concatenate((values[~one], values[one]))

    @staticmethod
    def _ones(level, at: np.ndarray) -> np.ndarray:
        packed, counts, _ = level
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return counts[at >> 6] + np.bitwise_count(packed[at >> 6] & mask)

    def _step(self, level, left, right):
        l1, r1 = self._ones(level, left), self._ones(level, right)
        return left - l1, right - r1, level[2] + l1, level[2] + r1

    def below(self, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of each range [left, right) are less than ``x``."""
        over, n, width = x >= 1 << self.bits, np.zeros(len(x), np.int64), right - left
        for level, bit in zip(self.levels, reversed(range(self.bits)), strict=True):
            l0, r0, l1, r1 = self._step(level, left, right)
            up = (x >> bit & 1).astype(bool)
            n += np.where(up, r0 - l0, 0)
            left, right = np.where(up, l1, l0), np.where(up, r1, r0)
        return np.where(over, width, n)

    def kth(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value of each range that ``k`` others stand before in ascending order."""
        value = np.zeros(len(k), np.int64)
        for level, bit in zip(self.levels, reversed(range(self.bits)), strict=True):
            l0, r0, l1, r1 = self._step(level, left, right)
            up = k >= r0 - l0
            k = np.where(up, k - (r0 - l0), k)
            left, right = np.where(up, l1, l0), np.where(up, r1, r0)
            value |= up.astype(np.int64) << bit
        return value

    def successor(self, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The least value of each range that is ``x`` or more, -1 where there is none."""
        before = self.below(left, right, x)
        found = before < right - left
        out = np.full(len(x), -1, np.int64)
        out[found] = self.kth(left[found], right[found], before[found])
        return out


def stretch(words: np.ndarray, low: int, high: int, at: int, period: int) -> tuple[int, int]:
    """The longest [start, end) around ``at`` and ``at + period`` within [low, high) in which words
    ``period`` apart are equal; it is ``period`` long if those two are not."""
    start, end, step = at, at, 64
    while end < high - period:
        width = min(step, high - period - end)
        differ = words[end : end + width] != words[end + period : end + period + width]
        end += int(differ.argmax()) if differ.any() else width
        if differ.any():
            break
        step *= 4
    step = 64
    while end > at and start > low:
        width = min(step, start - low)
        differ = (words[start - width : start] != words[start - width + period : start + period])[::-1]
        start -= int(differ.argmax()) if differ.any() else width
        if differ.any():
            break
        step *= 4
    return start, end + period


def find_runs(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """All runs (start, length, period) of several texts, by start, then period.

    Text i has the words from ``bounds[i]`` to ``bounds[i + 1]``. A run of period q and length at least
    max(24, 3 q) holds an aligned block of the largest dyadic length up to q (8 at least) together with
    its occurrence q words on. So for each aligned block the occurrences in the window of twice its
    length behind it are asked for, the next one by a range successor over the block's interval of the
    suffix array. Their distances are the candidate periods; each is confirmed by comparing words.

    Occurrences at equal distances of up to half a block are a progression inside a run of that small
    period. A larger period then moves that run's start or end onto those of a run that holds later
    occurrences, which gives two candidates for a whole progression. Blocks deep inside a run of small
    period are not asked at all.
    """
    n = len(words)
    ends = np.repeat(bounds[1:], np.diff(bounds)).astype(np.int64)
    lows = np.repeat(bounds[:-1], np.diff(bounds)).astype(np.int64)
    array, levels = suffix_array(words, ends, ends)
    found: dict[tuple[int, int], int] = {}
    if not levels:
        return np.zeros((0, 3), np.int64)
    matrix = WaveletMatrix(array)
    for length, starts, left, right in levels:
        if small := [(a, b) for (a, b), q in found.items() if 2 * q <= length]:
            reach = np.zeros(n, np.int64)
            small = np.array(small)
            np.maximum.at(reach, small[:, 0], small[:, 1])
            inside = np.maximum.accumulate(reach)[starts] >= starts + 3 * length
            starts, left, right = starts[~inside], left[~inside], right[~inside]
        least = 1 if length == BLOCK else length
        candidates, at, now = [], np.arange(len(starts)), starts + least
        for _ in range(ROUNDS):
            now = matrix.successor(left[at], right[at], now)
            near = (now >= 0) & (now < starts[at] + 2 * length)
            at, now = at[near], now[near]
            if not len(at):
                break
            candidates.append((now - starts[at]) * n + starts[at])
            now = now + 1
        for i, x in zip(at.tolist(), now.tolist(), strict=True):
            more = _progressions(words, lows, ends, matrix, int(starts[i]), int(left[i]), int(right[i]), x, length)
            candidates.append(np.array([q * n + s for q, s in more], np.int64))
        pairs = np.unique(np.concatenate(candidates)) if candidates else np.zeros(0, np.int64)
        i = 0
        while i < len(pairs):
            q, s = divmod(int(pairs[i]), n)
            start, end = stretch(words, int(lows[s]), int(ends[s]), s, q)
            if end - start >= max(MIN_LENGTH, MIN_EXPONENT * q):
                found.setdefault((start, end), q)
            # Further candidates of this period inside the stretch lead to it again.
            i = max(i + 1, int(np.searchsorted(pairs, q * n + end - q)))
    runs = np.array([(a, b - a, q) for (a, b), q in found.items()], np.int64).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _progressions(words, lows, ends, matrix, start, left, right, now, length) -> set[tuple[int, int]]:
    """The candidates of one block from ``now`` on, each progression of occurrences at once."""

    def following(x: int) -> int:
        p = int(matrix.successor(np.array([left]), np.array([right]), np.array([x]))[0])
        return p if 0 <= p < start + 2 * length else -1

    low, high, pairs = int(lows[start]), int(ends[start]), set()
    while (p := following(now)) >= 0:
        pairs.add((p - start, start))
        step = following(p + 1) - p
        if not 0 < step <= length // 2:
            now = p + 1
            continue
        mine, theirs = stretch(words, low, high, start, step), stretch(words, low, high, p, step)
        pairs |= {(q, start) for q in (theirs[0] - mine[0], theirs[1] - mine[1]) if length <= q < 2 * length}
        now = p + (theirs[1] - length - p) // step * step + 1
    return pairs


def strongest(runs: np.ndarray) -> int | None:
    """The index of the run with the greatest length / period, the first of equal ones."""
    best = None
    for i, (_, length, period) in enumerate(runs.tolist()):
        if best is None or length * runs[best, 2] > int(runs[best, 1]) * period:
            best = i
    return best


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, ``n_words``, ``runs`` (start, length, period), ``strongest`` and ``collapsed`` of each row.

    Words are runs without ASCII white space, numbered from 0. A run is a stretch of consecutive words
    with smallest period q, at least max(24, 3 q) long, that no neighbouring word extends. ``runs`` are
    in order of start, then period; ``strongest`` has the greatest length / period, the first of equal
    ones, NULL without runs. ``collapsed`` has the words that no run holds behind its first q words,
    joined by one space. All texts of a batch are searched together; runs never leave their text.

    Defined results: NULL, empty and blank texts have no words, no runs and an empty ``collapsed``;
    repeated rows come out once each; a NULL id passes; other columns are ignored whatever their names.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1, PIECE):
            number: defaultdict[bytes, int] = defaultdict()
            number.default_factory = number.__len__
            parts, counts = [], []
            for text in batch.column(1).cast(pa.large_binary()):
                lists = split_words(text.as_py() or b"")
                mine = [np.fromiter(map(number.__getitem__, x), np.int32, len(x)) for x in lists]
                parts += mine
                counts.append(sum(map(len, mine)))
            words = np.concatenate([*parts, np.zeros(0, np.int32)])
            bounds = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
            spelling = list(number)
            runs = find_runs(words, bounds)
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
            np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
            kept = np.cumsum(cover)[:-1] == 0
            cuts = np.searchsorted(runs[:, 0], bounds)
            rows = []
            for i, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                mine = runs[cuts[i] : cuts[i + 1]] - [low, 0, 0]
                keep = words[low:high][kept[low:high]].tolist()
                best = strongest(mine)
                listed = [dict(zip(("start", "length", "period"), r, strict=True)) for r in mine.tolist()]
                rows.append((listed, None if best is None else listed[best], b" ".join(map(spelling.__getitem__, keep))))
            columns = [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array([r[0] for r in rows], pa.list_(run)),
                pa.array([r[1] for r in rows], run),
                pa.array([r[2] for r in rows], pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "strongest", "collapsed"])

    struct = "struct<start: long, length: long, period: long>"
    searched = docs.mapInArrow(lean(search), f"id {kind}, n_words long, runs array<{struct}>, strongest {struct}, collapsed string")
    return searched.withColumnRenamed("id", id_col)
