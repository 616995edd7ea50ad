"""Operator 7, substring dedup: relative Lempel-Ziv parsing.

A word goes if a window of 13 words that covers it also starts in a document
with a smaller id. ``repeats`` brings the stretches whose windows can be equal
to one block. A block's reference is all its stretches, indexed by their
suffixes' order (prefix doubling on word numbers). The longest match of a place
with a smaller document's stretch is that with one of two neighbours in this
order: the nearest above and the nearest below that belong to a smaller document.
Every stretch is parsed greedily from left to right: a factor is the longest
match at its place, and factors of at least a window's length are the spans that
go. Behind a factor the parse goes on at the first window across its boundary
that the index has, so no window that starts inside one factor and ends in the
next is missed.

Defined cases: a null text has no words; texts below 13 words keep all; of
equal texts, those of the smallest id are judged against the other texts and
the rest go whole; rows that share an id do not count against each other; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import arrow_schema, materialise
from feedlake.llm.repeats import BYTE_CODES, Kind, Pile, Verdict, covered, keyed, repeated_spans, span_hashes

LENGTH = 13
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and each text's number of words."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    word = ~_SPACE[data]
    edges = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
    bounds = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    return span_hashes(BYTE_CODES[data], starts, ends), np.diff(np.searchsorted(starts, bounds), prepend=0)


def word_kind(length: int = LENGTH) -> Kind:
    return Kind(length, max(1, length * 2 // 5), word_codes, bytes.split, lambda words, a, b: b" ".join(words[a:b]))


def _ranks(pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    both = pairs[0] * (int(pairs[1].max(initial=0)) + 1) + pairs[1]
    return np.unique(both, return_inverse=True)[1]


def _nearest_smaller(order: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Of each element the next strictly smaller one before and behind it, -1 if there is none."""
    before, behind, open_ = [-1] * len(order), [-1] * len(order), []
    for i, x in enumerate(order):
        while open_ and order[open_[-1]] > x:
            behind[open_.pop()] = i
        if open_:
            last = open_[-1]
            before[i] = last if order[last] < x else before[last]
        open_.append(i)
    return np.array(before, np.int64), np.array(behind, np.int64)


class ReferenceIndex:
    """Suffixes of a block's stretches in order. ``levels[k]`` ranks the places by their next 2**k words."""

    def __init__(self, stretches: list[bytes], length: int):
        numbers: dict = {}
        words = [[numbers.setdefault(w, len(numbers) + 1) for w in x.split(b" ")] + [0] for x in stretches]
        self.sizes = np.fromiter((len(x) - 1 for x in words), np.int64, len(words))
        self.begin = np.cumsum(self.sizes + 1) - self.sizes - 1
        rank = np.fromiter((w for x in words for w in x), np.int64, int((self.sizes + 1).sum()))
        self.levels, depth, longest = [rank], 1, max(length, int(self.sizes.max(initial=0)))
        while depth < longest and (depth < length or rank.max() + 1 < len(rank)):
            rank = _ranks((rank, np.concatenate([rank[depth:], np.zeros(min(depth, len(rank)), np.int64)])))
            self.levels.append(rank)
            depth *= 2

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal words from each pair of places on, a stretch's end being one."""
        out, last = np.zeros(len(a), np.int64), len(self.levels[0]) - 1
        for k in range(len(self.levels) - 1, -1, -1):
            i, j = a + out, b + out
            same = self.levels[k][np.minimum(i, last)] == self.levels[k][np.minimum(j, last)]
            out += (same & (i <= last) & (j <= last)).astype(np.int64) << k
        return out

    def longest_matches(self, place: np.ndarray, order: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Words that each place has in common with the best place of a smaller order number; at
        most ``left``, those up to its stretch's end."""
        ranked = np.argsort(self.levels[-1][place], kind="stable")
        best = np.zeros(len(place), np.int64)
        for beside in _nearest_smaller(order[ranked].tolist()):
            at = np.flatnonzero(beside >= 0)
            here = ranked[at]
            best[here] = np.maximum(best[here], self.common(place[here], place[ranked[beside[at]]]))
        return np.minimum(best, left)


def factors(matches: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretch, first word and words of the greedy parse's factors of at least ``length`` words.
    ``matches``: longest match at each window; ``n``: windows of each stretch."""
    ends = np.cumsum(n)
    hits = np.flatnonzero(matches >= length)
    stretch, at = np.arange(len(n)), np.searchsorted(hits, ends - n)
    out = []
    while len(stretch):
        on = at < len(hits)
        on[on] = hits[at[on]] < ends[stretch[on]]
        stretch, at = stretch[on], at[on]
        window = hits[at]
        out.append((stretch, window - (ends - n)[stretch], matches[window]))
        # The first window that ends behind the factor and is in the index.
        at = np.searchsorted(hits, window + matches[window] - length + 1)
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate([empty, *x]) for x in zip(*out, strict=True)) if out else (empty, empty, empty)


def relative_parse(pile: Pile, length: int = LENGTH) -> Verdict:
    """Windows that a smaller document has, each window's number (equal windows have equal ones),
    and the factors of each distinct stretch as its first document holds it."""
    index = ReferenceIndex(pile.data, length)
    total = int(pile.n.sum())
    stretch = np.repeat(np.arange(len(pile.n)), pile.n)
    place = index.begin[stretch] + np.arange(total) - (np.cumsum(pile.n) - pile.n)[stretch]
    matches = index.longest_matches(place, pile.least[stretch], (index.begin + index.sizes)[stretch] - place)
    k = length.bit_length() - 1
    numbers = _ranks((index.levels[k][place], index.levels[k][place + length - (1 << k)]))
    return matches >= length, numbers, factors(matches, pile.n, length)


_KEPT = "r1 long, r2 long, n_words long, n_removed long, whole_sha256 string, kept_sha256 string, kept string"


def _kept(length: int, with_text: bool):
    schema = arrow_schema(_KEPT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = text.as_py().encode().split()
                whole = hashlib.sha256(b" ".join(words)).hexdigest()
                if not spans.is_valid:
                    rows.append((len(words), 0, whole, whole, None))
                    continue
                start, size = (c.to_numpy() for c in spans.values.flatten())
                gone = covered(len(words), start, size)
                kept = b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])
                rows.append((len(words), int(gone.sum()), whole, hashlib.sha256(kept).hexdigest(),
                             kept.decode() if with_text else None))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("r1"), batch.column("r2"),
                     *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types[2:], strict=True))],
                    schema=schema)
    return run


def substring_dedup(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row of ``docs`` (``doc_id``,
    ``text``), and the kept words as ``kept`` if ``with_text`` (null where none was removed)."""
    texts = keyed(docs)
    rows = materialise(texts.select("doc_id", "r1", "r2"), "substring-rows")
    classes = rows.groupBy("r1", "r2").agg(F.min("doc_id").alias("rep"))
    distinct, spans = repeated_spans(
        texts.select("r1", "r2", "text"), word_kind(length),
        classes.select("r1", "r2", F.coalesce("rep", F.lit(-(1 << 63))).alias("rep")), True,
        lambda pile: relative_parse(pile, length))
    judged = (distinct.join(spans.hint("shuffle_hash"), ["r1", "r2"], "left").select("r1", "r2", "text", "spans")
                      .mapInArrow(_kept(length, with_text), _KEPT))
    copy = (F.col("doc_id") > F.col("rep")) & (F.col("n_words") >= length)
    out = (rows.join(classes, ["r1", "r2"]).join(judged, ["r1", "r2"])
               .select("doc_id", "n_words",
                       F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
                       F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("kept_sha256"))
                       .alias("kept_sha256"),
                       F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept")))
    return out if with_text else out.drop("kept")
