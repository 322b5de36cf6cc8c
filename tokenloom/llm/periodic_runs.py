"""Stretches of a text that repeat with a period, found on an enhanced suffix array.

The suffixes of all words of a run of texts are sorted at once, by prefix doubling over the suffixes not yet told
apart; the text's number is part of every first word, so that suffixes of different texts share nothing. A cut
between two neighbouring suffixes of LCP d splits its LCP interval in two: the suffixes down to the last cut of LCP
d or less, and those up to the next cut of LCP below d (an interval with m children has m - 1 cuts). For each suffix i
of the smaller side, ``ISA[i + d]`` or ``ISA[i - d]`` on the other side of the cut means that d words stand twice in a
row and that the word after them ends the period: a branching tandem repeat, the last square of exactly one run.
Rotating it to the left, a word at a time as long as words d apart agree, gives the run. Squares of the same end
whose length is a multiple of a shorter one in the same run are that run again and merge into it. There are no tree
nodes, only arrays; enumerating smaller sides costs O(n log n) look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import col, fresh, kept_names, text_of, text_slices, word_hashes, word_spans

_SIDES = 1 << 21  # look-ups made at a time


@dataclass(frozen=True)
class Repeats:
    """What counts as a run: at least ``least`` words, and at least ``exponent`` (2 or more) times its period."""

    least: int = 24
    exponent: int = 3


class SuffixArray:
    """Sorted suffixes (``order``), their places (``place``) and ``lcp``, all within rows given by their ``firsts``.

    ``lcp[k]`` is what the suffixes at places k - 1 and k share; it is 0 between rows. Memory is 4 bytes a word for
    each doubling of the longest repeat, beside some arrays of 8.
    """

    def __init__(self, words: np.ndarray, firsts: np.ndarray):
        n = len(words)
        row = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        self.stop = firsts[1:][row].astype(np.int64)  # end of the row of each word
        order = np.lexsort((words, row))
        new = np.ones(n, bool)
        new[1:] = (words[order[1:]] != words[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
        rank = np.empty(n, np.int32)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        step = np.zeros(n, np.int8)  # the doubling that told a place from the one before
        levels = [rank.copy()]
        single = new.copy()
        single[:-1] &= new[1:]
        open_ = np.flatnonzero(~single)
        while len(open_):
            at = order[open_]
            after = at + (1 << (len(levels) - 1))
            inside = after < self.stop[at]
            key = rank[at].astype(np.int64) * (n + 1)
            key[inside] += rank[after[inside]] + 1
            by = np.argsort(key, kind="stable")
            at, key = at[by], key[by]
            order[open_] = at
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            fresh_cut = new & (open_ != rank[at])  # groups keep their first place
            step[open_[fresh_cut]] = len(levels)
            rank[at] = open_[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
            levels.append(rank.copy())
            single = new.copy()
            single[:-1] &= new[1:]
            open_ = open_[~single]
        self.order, self.place = order, rank
        self.lcp = self._shared(step, levels)

    def _shared(self, step: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        cut = np.flatnonzero(step > 0)
        took = step[cut].astype(np.int64)
        length = np.left_shift(1, took - 1)
        for level in range(len(levels) - 3, -1, -1):
            due = np.flatnonzero(took - 2 >= level)
            a, b = self.order[cut[due] - 1] + length[due], self.order[cut[due]] + length[due]
            stop, ranks = self.stop[self.order[cut[due]]], levels[level]
            fits = (a < stop) & (b < stop)
            same = np.zeros(len(due), bool)
            same[fits] = ranks[a[fits]] == ranks[b[fits]]
            length[due[same]] += 1 << level
        lcp = np.zeros(len(step), np.int64)
        lcp[cut] = length
        return lcp


def last_before(values: np.ndarray, queries: np.ndarray, equal: bool) -> np.ndarray:
    """For each of the places ``queries`` the last earlier place whose value is smaller (or equal); -1 if there is none.

    A pyramid of minima is climbed until a node to the left holds such a value, then followed down to it.
    """
    pyramid = [values]
    while len(pyramid[-1]) > 1:
        v = pyramid[-1]
        pairs = v[: len(v) // 2 * 2].reshape(-1, 2).min(1)
        pyramid.append(np.concatenate([pairs, v[-1:]]) if len(v) % 2 else pairs)
    limit = values[queries] + int(equal)
    out = np.full(len(queries), -1, np.int64)
    height = np.zeros(len(queries), np.int64)
    left, node = np.arange(len(queries)), queries.astype(np.int64)
    for level, minima in enumerate(pyramid):
        odd = (node & 1) == 1
        hit = np.zeros(len(node), bool)
        hit[odd] = minima[node[odd] - 1] < limit[left[odd]]
        out[left[hit]], height[left[hit]] = node[hit] - 1, level
        left, node = left[~hit], node[~hit] >> 1
    for level in range(len(pyramid) - 1, 0, -1):
        here = np.flatnonzero((out >= 0) & (height >= level))
        lower = pyramid[level - 1]
        right = np.minimum(2 * out[here] + 1, len(lower) - 1)
        out[here] = np.where(lower[right] < limit[here], right, 2 * out[here])
    return out


def _tandems(suffixes: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """First word and half length of every branching tandem repeat."""
    order, place, lcp = suffixes.order, suffixes.place, suffixes.lcp
    cut = np.flatnonzero(lcp > 0)
    if not len(cut):
        return cut, cut
    n, depth = len(lcp), lcp[cut]
    low = last_before(lcp, cut, equal=True)
    high = n - 1 - last_before(lcp[::-1], n - 1 - cut, equal=False)  # n if there is none
    left_small = cut - low <= high - cut
    first = np.where(left_small, low, cut)
    size = np.where(left_small, cut - low, high - cut)
    other_low, other_high = np.where(left_small, cut, low), np.where(left_small, high, cut)
    starts, halves = [], []
    ends = np.cumsum(size)
    a = 0
    while a < len(cut):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + _SIDES, "right")))
        mine = np.repeat(np.arange(a, b), size[a:b])
        inner = np.arange(len(mine)) - np.repeat(ends[a:b] - size[a:b] - (ends[a - 1] if a else 0), size[a:b])
        i, d = order[first[mine] + inner], depth[mine]
        for j, begin in ((i + d, i), (i - d, i - d)):
            ok = np.flatnonzero((j >= 0) & (j < n))
            at = place[j[ok]]
            ok = ok[(at >= other_low[mine[ok]]) & (at < other_high[mine[ok]])]
            starts.append(begin[ok])
            halves.append(d[ok])
        a = b
    return np.concatenate(starts), np.concatenate(halves)


def _rotated(words: np.ndarray, begin: int, half: int, floor: int) -> int:
    """The first word of the run that the square at ``begin`` ends, not below ``floor``."""
    reach = 64
    while begin > floor:
        width = min(reach, begin - floor)
        differ = np.flatnonzero(words[begin - width : begin] != words[begin - width + half : begin + half])
        if len(differ):
            return begin - width + int(differ[-1]) + 1
        begin, reach = begin - width, reach * 2
    return begin


def runs_of(words: np.ndarray, firsts: np.ndarray, rule: Repeats = Repeats()) -> np.ndarray:
    """``first word, end, period`` of all runs of rows of words, by first word and period (word numbers of all rows)."""
    if not len(words):
        return np.zeros((0, 3), np.int64)
    suffixes = SuffixArray(words, firsts)
    begin, half = _tandems(suffixes)
    floor = firsts[np.searchsorted(firsts, begin, "right") - 1]
    need = np.maximum(np.maximum(rule.least, rule.exponent * half) - 2 * half, 0)
    keep = begin - need >= floor
    begin, half, floor, need = begin[keep], half[keep], floor[keep], need[keep]
    for share in (0.0, 0.5, 1.0):  # a cheap look at some of the words that have to agree
        part = np.minimum(need, 1 + (need * share).astype(np.int64))
        keep = words[begin - part] == words[begin - part + half]
        begin, half, floor, need = begin[keep], half[keep], floor[keep], need[keep]
    found: list[tuple[int, int, int]] = []
    at_end: dict[int, list[tuple[int, int]]] = {}
    by = np.lexsort((half, begin + 2 * half))
    for b, d, f in zip(begin[by].tolist(), half[by].tolist(), floor[by].tolist(), strict=True):
        end = b + 2 * d
        known = at_end.setdefault(end, [])
        if any(d % q == 0 and s <= b for s, q in known):
            continue
        start = _rotated(words, b, d, f)
        known.append((start, d))
        if end - start >= max(rule.least, rule.exponent * d):
            found.append((start, end, d))
    out = np.array(sorted((s, q, e) for s, e, q in found), np.int64).reshape(-1, 3)
    return out[:, [0, 2, 1]]


def _found(text: str, keep: list[str], out: str, rule: Repeats):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_slices(batches, text):
            starts, ends, firsts = word_spans(data, offsets)
            runs = runs_of(word_hashes(data, starts, ends), firsts, rule)
            gone = np.zeros(len(starts) + 1, np.int64)
            np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
            np.add.at(gone, runs[:, 1], -1)
            stays = np.cumsum(gone)[:-1] == 0
            of_row = np.searchsorted(runs[:, 0], firsts)
            lists, texts = [], []
            for i in range(rows.num_rows):
                lo, hi = int(firsts[i]), int(firsts[i + 1])
                own = runs[of_row[i] : of_row[i + 1]]
                lists.append([{"start": int(s) - lo, "length": int(e - s), "period": int(q)} for s, e, q in own])
                if len(own) or hi == lo:
                    texts.append(b" ".join([data[a:b].tobytes() for a, b in zip(starts[lo:hi][stays[lo:hi]], ends[lo:hi][stays[lo:hi]], strict=True)]))
                else:
                    texts.append(b" ".join(data[offsets[i] : offsets[i + 1]].tobytes().split()))
            struct = pa.StructArray.from_arrays(
                [
                    pa.array(np.diff(firsts), pa.int64()),
                    pa.array(lists, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                    pa.array([t.decode() for t in texts], pa.string()),
                ],
                names=["n_words", "runs", "collapsed"],
            )
            yield pa.RecordBatch.from_arrays([*[rows.column(n) for n in keep], struct], names=[*keep, out])

    return run


def find_runs(docs: DataFrame, rule: Repeats = Repeats(), text_col: str = "text", keep: list[str] | None = None, out: str = "periodic") -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) and a struct ``out``: ``n_words, runs, collapsed``.

    Words are runs of characters other than the six white-space ones, compared by 64-bit hashes. A run is a stretch of
    words with smallest period q (words q apart are identical), long enough by ``rule``, that no neighbouring word
    extends; ``runs`` holds ``start, length, period`` in words by start, then period. ``collapsed`` is the text without the
    words that any run contains after its first q words, the others joined by one space.

    Each row is judged on its own in one task, whole, whatever its length: nothing is shuffled, and equal rows give equal
    results. Null and empty texts have no words and no runs; an empty table gives an empty one. If ``docs`` has a column
    named ``out`` already, underscores are put before the name; use :func:`~tokenloom.llm.common.fresh` to foretell it.
    """
    keep = docs.columns if keep is None else keep
    out, text = fresh(docs, out, "text_of_row")
    given = docs.select(*[col(docs, c) for c in keep], text_of(docs, text_col).alias(text))
    schema = ", ".join(f"`{c.replace('`', '``')}` {t}" for c, t in given.dtypes if c != text)
    kinds = "struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, collapsed: string>"
    return given.mapInArrow(_found(text, keep, out, rule), f"{schema}{', ' if schema else ''}`{out}` {kinds}")


def with_strongest(rows: DataFrame, runs: str) -> DataFrame:
    """Add ``strongest``: of the runs in column ``runs`` the one with the greatest length/period (then smallest start,
    then period), null if there is none. Ratios are compared as products, exactly."""

    def earlier(a, b):
        more, less = a.length * b.period, b.length * a.period
        return F.when(more > less, -1).when(more < less, 1).when(a.start < b.start, -1).when(a.start > b.start, 1).otherwise(F.signum(a.period - b.period).cast("int"))

    return rows.select(*kept_names(rows), F.get(F.array_sort(F.col(runs), earlier), F.lit(0)).alias(fresh(rows, "strongest")[0]))
