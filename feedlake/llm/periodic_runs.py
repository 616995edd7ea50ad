"""Operator 13, periodic run detection: maximal-pair enumeration.

A run is a stretch of words with smallest period q that is at least
``max(min_words, exponent * q)`` long and that no neighbouring word extends. Two
suffixes of a document at distance p whose common prefix has l words and whose
left words differ (a maximal pair) span a stretch of p + l words with period p
that cannot be extended; it is a run if l >= (exponent - 1) * p. So the maximal
pairs under that bound are the runs, each with its smallest period and with
multiples of it, of which the smallest stays.

The words of a batch of documents are numbered, suffixes sorted by doubling of
ranks (only those still tied), and common prefixes of neighbours read off the
levels. The LCP-interval tree is then walked bottom-up. A node holds its
suffixes by place, and where their left-word class changes along them; a child
is merged into the larger one, each of its suffixes looks up partners of another
class within l / (exponent - 1) words, and steps over places of its own class
at once. Work is O(n log n) for n words and the pairs reported, which are as many
as the exponents of the runs add up to, so O(n).

Only suffixes that can have a partner enter the tree: the same words must start
close enough, measured by the longest prefix that the suffix shares at all.

Spark deals the documents to tasks; nothing crosses documents and nothing is
shuffled. A task holds a few documents' words at once, and a very long document
alone.

Defined cases: a null text has no words; a text without words has no runs, four
nulls and the digests of nothing; a null id is judged as the text ``''`` where
the id decides; repeated rows are rows of their own; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import arrow_schema, text_or_empty

EXPONENT = 4      # a run holds its period at least this often
MIN_WORDS = 6
BATCH_WORDS = 200_000
BATCH_ROWS = 1000


class _Node:
    """Suffixes of one LCP interval: their places, sorted, and those at which the left class changes."""

    __slots__ = ("places", "starts")

    def __init__(self, place: int):
        self.places = [place]
        self.starts = [place]

    def add(self, x: int, left: list[int]) -> None:
        places, starts, c = self.places, self.starts, left[x]
        k = bisect_left(places, x)
        before = left[places[k - 1]] if k else None
        if k < len(places):
            after, was = left[places[k]], left[places[k]] != before or not k
            if was and after == c:
                starts.pop(bisect_left(starts, places[k]))
            elif not was and after != c:
                insort(starts, places[k])
        if before != c or not k:
            insort(starts, x)
        places.insert(k, x)

    def partners(self, x: int, reach: int, left: list[int]) -> Iterator[int]:
        """Places within ``reach`` of ``x`` whose left class is another."""
        places, starts, c = self.places, self.starts, left[x]
        k = bisect_right(places, x)
        while k < len(places) and places[k] <= x + reach:
            if left[places[k]] != c:
                yield places[k]
                k += 1
            else:
                t = bisect_right(starts, places[k])
                if t == len(starts):
                    break
                k = bisect_left(places, starts[t], k)
        k = bisect_left(places, x) - 1
        while k >= 0 and places[k] >= x - reach:
            if left[places[k]] != c:
                yield places[k]
                k -= 1
            else:
                k = bisect_left(places, starts[bisect_right(starts, places[k]) - 1]) - 1


def suffix_levels(codes: np.ndarray) -> list[np.ndarray]:
    """Ranks of the suffixes by their first 1, 2, 4, ... words until all differ. A rank is the
    number of suffixes before the first that shares it."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    new = np.r_[True, codes[order][1:] != codes[order][:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    levels, h = [rank.astype(np.int32)], 1
    tied = _tied(rank, np.arange(n))
    while len(tied):
        follower = np.where(tied + h < n, rank[np.minimum(tied + h, n - 1)] + 1, 0)
        key = rank[tied] * (n + 1) + follower
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        old = rank[tied]
        at = np.arange(len(tied))
        group = np.r_[True, old[1:] != old[:-1]]
        part = np.r_[True, key[1:] != key[:-1]]
        first = np.maximum.accumulate(np.where(group, at, 0))
        rank[tied] = old + np.maximum.accumulate(np.where(part, at, 0)) - first
        levels.append(rank.astype(np.int32))
        h *= 2
        tied = _tied(rank, tied)
    return levels


def _tied(rank: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Those of ``places`` whose rank another shares."""
    counts = np.bincount(rank[places], minlength=len(rank))
    return places[counts[rank[places]] > 1]


def common_prefixes(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` share, pair by pair."""
    n = len(levels[0])
    a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = np.maximum(a, b) < n
        same = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        step = same.astype(np.int64) << k
        a, b, out = a + step, b + step, out + step
    return out


def _candidates(levels: list[np.ndarray], least: int, ratio: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that can be in a pair, in lexical order, and the common prefix of each with the one before."""
    depth = min(len(levels) - 1, least.bit_length() - 1)
    shared = levels[depth]                              # by the first 2 ** depth <= least words
    counts = np.bincount(shared, minlength=len(shared))
    places = np.flatnonzero(counts[shared] > 1)
    if not len(places):
        return places, places
    # The nearest place with the same first words, on either side.
    by = places[np.lexsort((places, shared[places]))]
    far = np.int64(1) << 40
    gap = np.where(shared[by[1:]] == shared[by[:-1]], by[1:] - by[:-1], far)
    nearest = np.full(len(shared), far)
    nearest[by] = np.minimum(np.r_[far, gap], np.r_[gap, far])
    order = places[np.argsort(levels[-1][places], kind="stable")]
    lcp = np.r_[0, common_prefixes(levels, order[:-1], order[1:])]
    longest = np.maximum(lcp, np.r_[lcp[1:], 0])
    keep = np.flatnonzero((longest >= least) & (nearest[order] * ratio <= longest))
    if not len(keep):
        return keep, keep
    # Between two that stay, the least common prefix of all from one to the other.
    lows = np.minimum.reduceat(lcp, np.r_[0, keep[:-1] + 1])
    # reduceat's last slice runs to the end of the array.
    lows[-1] = lcp[(keep[-2] + 1 if len(keep) > 1 else 0):keep[-1] + 1].min()
    return order[keep], lows


def maximal_pairs(codes: np.ndarray, left: list[int], exponent: int = EXPONENT,
                  min_words: int = MIN_WORDS) -> dict[tuple[int, int], int]:
    """``(start, length) -> smallest period`` of the runs in ``codes``; ``left``: the class of the
    word before each place. Documents are parted by numbers that occur once."""
    ratio = exponent - 1
    least = max(ratio, min_words - 1)                   # words that any pair shares
    runs: dict[tuple[int, int], int] = {}
    if len(codes) < 2:
        return runs
    order, lcp = _candidates(suffix_levels(codes), least, ratio)

    def join(a: _Node, b: _Node, depth: int) -> _Node:
        if len(a.places) < len(b.places):
            a, b = b, a
        reach = depth // ratio
        for x in b.places:
            for y in a.partners(x, reach, left):
                period, start = abs(x - y), min(x, y)
                if depth + period >= min_words:
                    key = (start, depth + period)
                    if period < runs.get(key, period + 1):
                        runs[key] = period
        for x in b.places:
            a.add(x, left)
        return a

    stack: list[tuple[int, _Node]] = []                 # (common prefix with what lies below, node)

    def close(depth: int) -> None:
        """Join all that share more than ``depth`` words."""
        while len(stack) > 1 and stack[-1][0] > depth:
            inner, node = stack.pop()
            outer, below = stack.pop()
            stack.append((outer, join(below, node, inner)))

    for place, shared in zip(order.tolist(), lcp.tolist(), strict=True):
        if shared < least:
            close(least - 1)
            stack.clear()
            shared = 0
        close(shared)
        stack.append((shared, _Node(place)))
    close(least - 1)
    return runs


def planted(words: list[bytes], name: bytes) -> list[bytes]:
    """The words to be searched: in one document of ten the tail repeats, as its id's checksum says."""
    h, n = zlib.crc32(name), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def batch_runs(documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """``start, length, period`` of every document's runs, in order."""
    lengths = [len(d) for d in documents]
    known: dict[bytes, int] = {}
    words = np.fromiter((known.setdefault(w, len(known)) for d in documents for w in d), np.int64, sum(lengths))
    owner = np.repeat(np.arange(len(documents)), lengths)
    # Words match inside a document only; a number of its own ends each.
    total = len(words) + len(documents)
    at = np.arange(len(words)) + owner
    codes = np.empty(total, np.int64)
    codes[at] = owner * len(known) + words
    ends = np.cumsum(np.asarray(lengths, np.int64) + 1) - 1
    codes[ends] = len(documents) * len(known) + np.arange(len(documents))
    left = np.r_[-1, codes[:-1]].tolist()
    found: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    starts = ends - np.asarray(lengths, np.int64)
    for (start, length), period in maximal_pairs(codes, left).items():
        k = int(np.searchsorted(ends, start))
        found[k].append((start - int(starts[k]), length, period))
    for f in found:
        f.sort(key=lambda r: (r[0], r[2]))
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats: all after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


_COLUMNS = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
            "runs_sha256 string, collapsed_sha256 string, collapsed_text string")


def _row(doc_id: int | None, words: list[bytes], runs: list[tuple[int, int, int]], with_text: bool) -> tuple:
    best = None
    for r in runs:
        if best is None:
            best = r
            continue
        more = r[1] * best[2] - best[1] * r[2]          # exact comparison of length / period
        if more > 0:
            best = r                                    # runs come by start, then period
    start, length, period = best or (None, None, None)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    text = b" ".join(collapsed(words, runs))
    return (doc_id, len(runs), start, length, period, 1000 * length // period if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest(),
            text.decode() if with_text else None)


def _find(plant: bool, with_text: bool):
    schema = arrow_schema(_COLUMNS)

    def result(ids: list, documents: list[list[bytes]]) -> pa.RecordBatch:
        rows = [_row(i, d, r, with_text) for i, d, r in zip(ids, documents, batch_runs(documents), strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, documents, size = [], [], 0
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                doc_id, words = doc_id.as_py(), text.as_py().split()
                if plant:
                    words = planted(words, b"" if doc_id is None else str(doc_id).encode())
                ids.append(doc_id)
                documents.append(words)
                size += len(words)
                if size >= BATCH_WORDS or len(ids) == BATCH_ROWS:
                    yield result(ids, documents)
                    ids, documents, size = [], [], 0
            if ids:
                yield result(ids, documents)
    return run


def periodic_runs(docs: DataFrame, plant: bool = False, with_text: bool = False) -> DataFrame:
    """Runs of every row of ``docs`` (``doc_id``, ``text``): their number, the one with the
    greatest exponent, a digest of all and one of the words without repeats. ``plant`` first
    repeats the tail of one document in ten (see ``planted``); ``with_text`` adds the words left,
    joined by one space."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    out = rows.mapInArrow(_find(plant, with_text), _COLUMNS)
    return out if with_text else out.drop("collapsed_text")
