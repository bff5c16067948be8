"""Periodic runs of words, found by internal pattern matching over a suffix array and a wavelet tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from danji.llm.common import ship
from danji.llm.words import parts, steps

#: A run has at least so many words, and at least so many times its period.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: What stands between words.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: The distance to a next occurrence that doesn't exist.
FAR = np.int64(1) << 60

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def next_distances(codes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """How far on each word stands again in its own text; FAR if it doesn't."""
    order = np.argsort(codes, kind="stable")
    here, there = order[:-1], order[1:]
    again = (codes[here] == codes[there]) & (text[here] == text[there])
    out = np.full(len(codes), FAR)
    out[here[again]] = (there - here)[again]
    return out


def stretches(distances: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of stretches that may hold a run whose period is in (block / 2, block].

    All words of such a run but the last period stand again within the period, so they are a stretch
    of words that stand again within a block, of at least the shortest run less its period.
    """
    period = block // 2 + 1
    least = max(LEAST_WORDS - block, (LEAST_PERIODS - 1) * period)
    out = np.flatnonzero(distances > block)
    starts, ends = np.concatenate([[0], out + 1]), np.concatenate([out, [len(distances)]])
    long = ends - starts >= least
    return starts[long], ends[long]


class WaveletTree:
    """A wavelet tree over numbers below `limit`, level by level, with bits packed in words of 64."""

    def __init__(self, values: np.ndarray, limit: int):
        self.bits = max(int(limit).bit_length(), 1)
        self.levels = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, np.uint8)]).view(np.uint64)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            self.levels.append((bit, packed, before, len(values) - int(ones.sum())))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return before[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def below(self, left: np.ndarray, right: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many numbers of each range [left, right) are below its value (itself below 2 ** bits)."""
        out = np.zeros(len(left), np.int64)
        for bit, packed, before, zeros in self.levels:
            l1, r1 = self._ones(packed, before, left), self._ones(packed, before, right)
            up = (value >> bit & 1).astype(bool)
            out += np.where(up, (right - r1) - (left - l1), 0)
            left, right = np.where(up, zeros + l1, left - l1), np.where(up, zeros + r1, right - r1)
        return out

    def ranked(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The number of that rank, from 0, of each range; the rank must be in the range."""
        out = np.zeros(len(left), np.int64)
        for bit, packed, before, zeros in self.levels:
            l1, r1 = self._ones(packed, before, left), self._ones(packed, before, right)
            lower = (right - r1) - (left - l1)
            up = rank >= lower
            rank = np.where(up, rank - lower, rank)
            out |= np.where(up, np.int64(1) << bit, 0)
            left, right = np.where(up, zeros + l1, left - l1), np.where(up, zeros + r1, right - r1)
        return out

    def successors(self, left: np.ndarray, right: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The smallest number above the value in each range; -1 where there is none."""
        rank = self.below(left, right, value + 1)
        found = rank < right - left
        out = np.full(len(left), -1, np.int64)
        out[found] = self.ranked(left[found], right[found], rank[found])
        return out


def suffix_array(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, rank, level): suffixes by their first 2 ** depth words, by prefix doubling.

    level[j] is the least k for which the j-th suffix in order differs from the one before it in its
    first 2 ** k words, depth + 1 if it doesn't. A suffix that ends is smaller than those that go on.
    """
    n = len(codes)
    level = np.full(n, depth + 1, np.int8)
    key = codes.astype(np.int64)
    for k in range(depth + 1):
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
        level[new & (level > k)] = k
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        if k < depth:
            after = np.zeros(n, np.int64)
            after[: max(n - (1 << k), 0)] = rank[1 << k :] + 1
            key = rank * (n + 1) + after
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place, level


def candidates(codes: np.ndarray, ends: np.ndarray, distances: np.ndarray) -> list[tuple[int, int]]:
    """(period, place) pairs; each run holds a place that is given with the run's period.

    A run of period q holds a block of B words, B the power of two in [q, 2 q), that begins at a
    multiple of B / 2 and stands again q words later: B + B / 2 - 1 + q words always hold one, and a run
    has 4 q. In the window of B words after it the block's occurrences are an arithmetic progression
    whose difference is its period; so if the run has no smaller period, the next occurrence is q on.
    """
    levels = {}
    longest = int(np.diff(ends).max(initial=0))
    k = 0
    while LEAST_PERIODS * ((1 << k) // 2 + 1) <= longest:
        starts, stops = stretches(distances, 1 << k)
        if len(starts):
            levels[k] = starts, stops
        k += 1
    if not levels:
        return []
    # The regions that the windows reach, cut at the text's end, each closed by a word of its own.
    spans = np.concatenate([np.stack([a, b + (2 << k)]) for k, (a, b) in levels.items()], axis=1)
    spans[1] = np.minimum(spans[1], ends[np.searchsorted(ends, spans[0], "right")])
    spans = spans[:, np.argsort(spans[0], kind="stable")]
    reach = np.maximum.accumulate(spans[1])
    first = np.flatnonzero(np.concatenate([[True], spans[0, 1:] > reach[:-1]]))
    begin, end = spans[0, first], reach[np.concatenate([first[1:] - 1, [len(reach) - 1]])]
    sizes = end - begin + 1
    offset = np.concatenate([[0], np.cumsum(sizes)])
    shift = begin - offset[:-1]
    place = np.arange(offset[-1]) + np.repeat(shift, sizes)
    inside = np.ones(offset[-1], bool)
    inside[offset[1:] - 1] = False
    region = np.empty(offset[-1], np.int64)
    region[inside] = codes[place[inside]]
    region[~inside] = codes.max() + 1 + np.arange(len(begin))

    order, rank, level = suffix_array(region, max(levels))
    tree = WaveletTree(order, len(order) + 1)
    found = []
    for k, (starts, stops) in levels.items():
        block, step = 1 << k, max(1 << k >> 1, 1)
        low, high = -(-starts // step), (stops - block) // step + 1
        sizes = np.maximum(high - low, 0)
        at = (np.arange(sizes.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)) * step
        at -= shift[np.searchsorted(begin, at, "right") - 1]
        groups = np.concatenate([np.flatnonzero(level <= k), [len(level)]])
        group = np.searchsorted(groups, rank[at], "right") - 1
        after = tree.successors(groups[group], groups[group + 1], at)
        period = after - at
        near = (after >= 0) & (period <= block) & (period > block // 2)
        found.append(np.stack([period[near], place[at[near]]]))
    every = np.concatenate(found, axis=1)
    return list(map(tuple, every[:, np.lexsort((every[1], every[0]))].T.tolist()))


def same_until(codes: np.ndarray, at: int, period: int, end: int) -> int:
    """The first place from `at` on, `end` at most, whose word isn't the one a period before."""
    size = 64
    while at < end:
        stop = min(at + size, end)
        other = codes[at:stop] != codes[at - period : stop - period]
        if other.any():
            return at + int(other.argmax())
        at, size = stop, size * 2
    return end


def same_since(codes: np.ndarray, at: int, period: int, begin: int) -> int:
    """The first place, `begin` at least, from which on to `at` each word is the one a period later."""
    size = 64
    while at > begin:
        stop = max(at - size, begin)
        other = codes[stop:at] != codes[stop + period : at + period]
        if other.any():
            return at - int(other[::-1].argmax())
        at, size = stop, size * 2
    return begin


def word_runs(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, periods) of the runs of texts laid end to end, by start, then period.

    ends: 0 and where each text ends.
    """
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    runs = []
    last, covered = 0, 0
    for period, at in candidates(codes, ends, next_distances(codes, text)) if len(codes) else ():
        if period == last and at < covered:
            continue
        begin, end = int(ends[text[at]]), int(ends[text[at] + 1])
        stop = same_until(codes, at + period, period, end)
        start = same_since(codes, at, period, begin)
        # Candidates up to here lie in the stretch that was just looked at.
        last, covered = period, stop - period
        if stop - start >= max(LEAST_WORDS, LEAST_PERIODS * period):
            runs.append((start, stop - start, period))
    out = np.asarray(sorted(runs), np.int64).reshape(-1, 3)
    return out[:, 0], out[:, 1], out[:, 2]


def runs_of_texts(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(runs, collapsed) of each text."""
    ends, codes, words = parts(texts, pc.ascii_split_whitespace)
    # Splitting leaves empty words at the ends of a text.
    real = ~pc.equal(words, "").to_numpy(zero_copy_only=False)[codes]
    ends, codes = np.concatenate([[0], np.cumsum(real)])[ends], codes[real]
    starts, lengths, periods = word_runs(codes, ends)
    # Words of several runs: +1 where a run's tail begins, -1 where it ends.
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, starts + periods, 1)
    np.add.at(change, starts + lengths, -1)
    keep = np.cumsum(change)[:-1] == 0
    kept_ends = np.concatenate([[0], np.cumsum(keep)])[ends]
    kept = words.take(pa.array(codes[keep]))
    collapsed = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(kept_ends), kept), pa.scalar(" ", kept.type))
    at = np.searchsorted(starts, ends)
    text = np.searchsorted(ends, starts, "right") - 1
    rows = pa.StructArray.from_arrays([pa.array(starts - ends[text]), pa.array(lengths), pa.array(periods)], ["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), rows).cast(RUNS), collapsed


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for step in steps(batch, 1):
            runs, collapsed = runs_of_texts(step.column(1))
            yield pa.RecordBatch.from_arrays([step.column(0), runs, collapsed.cast(pa.string())], ["doc_id", "runs", "collapsed"])


def repeated_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, with a repeated end where h = crc32(decimal id) is divisible by 10: planted runs.

    There, of n words and with g = h div 10, each word i >= a becomes word a + (i - a) % p, where
    a = g % n and p = 1 + (n - a) div (3 + g % 8). Other texts, and those of null ids, stay as they are.
    """
    hashed = F.crc32(docs[id_col].cast("string").cast("binary"))
    listed = F.filter(F.split(docs[text_col], WORD_GAP), lambda w: w != "")
    edited = F.expr("array_join(concat(slice(listed, 1, a), transform(sequence(0, n - a - 1), k -> listed[a + k % p])), ' ')")
    return (
        docs.select(
            docs[id_col].alias("doc_id"), docs[text_col].alias("text"),
            F.floor(hashed / 10).alias("g"), F.when(hashed % 10 == 0, listed).alias("listed"),
        )
        .withColumn("n", F.expr("nullif(size(listed), 0)"))  # null: not chosen, or without words
        .withColumn("a", F.expr("int(g % n)"))
        .withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
        .select("doc_id", F.coalesce(edited, F.col("text")).alias("text"))
    )


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, runs, collapsed.

    runs: array of (start, length, period) by start, then period, in words [^\\x20\\x09-\\x0D]+ numbered from
    0. A run is a stretch whose words a period apart are identical, of at least 6 words and 4 periods,
    that has no smaller period and that no neighbouring word extends. collapsed: the words that no
    run has after its first period, joined by one space.

    Only words that stand again soon enough, in stretches long enough, are indexed; most texts have
    none. What is left of a few megabytes of texts is one suffix array with a wavelet tree. Rows are
    independent, nothing is shuffled. A text of any length is searched as a whole, a long one by
    itself; it takes about twenty times its size in memory. A null text counts as empty and has no
    runs and an empty collapsed text; ids pass through, null or repeated; other columns are not read;
    an empty table gives no rows.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return rows.mapInArrow(
        _searched, f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    )
