"""Operator 8, best-fit packing with Martello-Toth dominance reduction.

Only the number of pieces of each length matters, so the packing is made on
that histogram (at most ``capacity`` numbers) and never sees the pieces. In the
reduction, small sets of pieces that provably dominate every other content of
a sequence with a given piece are fixed for good, as often as the counts allow,
and the instance shrinks. What is left is packed best-fit, longest first. The
result is a list of runs: "the pieces of length l with ranks a to a+m go to the
sequences b to b+m, at this offset". Its size depends on the capacity only. A
piece finds its place by its rank among the pieces of its length, which blocks
of a hash count out without sorting a length in one task.

Defined cases: a null text counts as empty and gives the end token alone; texts
above the capacity are cut, the short piece first; repeated rows are packed one
by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import arrow_schema, materialise, shuffle_partitions, text_or_empty
from feedlake.llm.tokens import encoder

CAPACITY = 1024
END = 2


class Run(NamedTuple):
    length: int
    rank: int      # of the first piece among those of its length
    count: int
    sequence: int  # of the first piece; one after another
    offset: int


class _Plan:
    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.lengths = sorted(self.left)
        self.rank = dict.fromkeys(self.left, 0)
        self.sequences = 0
        self.runs: list[Run] = []

    def put(self, length: int, count: int, sequence: int, offset: int) -> None:
        if count:
            self.runs.append(Run(length, self.rank[length], count, sequence, offset))
            self.rank[length] += count
            self.left[length] -= count
            if not self.left[length]:
                del self.left[length]
                self.lengths.pop(bisect_left(self.lengths, length))

    def fix(self, members: list[int], times: int) -> None:
        """``times`` sequences of the given lengths, closed."""
        offset = 0
        for length in members:
            self.put(length, times, self.sequences, offset)
            offset += length
        self.sequences += times

    def longest(self, room: int, used: tuple[int, ...] = ()) -> int | None:
        """The longest length that fits ``room`` with a piece not in ``used``."""
        k = bisect_right(self.lengths, room) - 1
        while k >= 0 and self.left[self.lengths[k]] <= used.count(self.lengths[k]):
            k -= 1
        return self.lengths[k] if k >= 0 else None

    def smallest(self, count: int, used: int) -> list[int]:
        """The ``count`` smallest pieces left beside one of length ``used``."""
        out: list[int] = []
        for length in self.lengths:
            out += [length] * min(count, self.left[length] - (length == used))
            if len(out) >= count:
                break
        return out[:count]

    def dominant(self, length: int) -> list[int] | None:
        """A set with a piece of this length that dominates all others, if one is proven.

        A set dominates another if the other's pieces can be parted into groups,
        one for each of its pieces, none longer than that piece.
        """
        room = self.capacity - length
        best = self.longest(room, (length,))
        if best is None:
            return [length]                      # nothing fits beside it
        if best == room:
            return [length, best]                # an exact pair
        small = self.smallest(3, length)
        if len(small) < 2 or small[0] + small[1] > room:
            return [length, best]                # one more fits at most: the longest
        if len(small) > 2 and sum(small) <= room:
            return None
        # Two more fit at most.
        second = self.longest(room - best, (length, best))
        half = self.longest(room // 2, (length,))
        if second is not None and half is not None and second >= half:
            return [length, best, second]        # no pair's shorter piece is longer
        if second is None:
            pairs = [a + b for a in self.lengths if a <= room
                     and (b := self.longest(room - a, (length, a))) is not None]
            if not pairs or max(pairs) <= best:
                return [length, best]            # the single piece covers any pair
        return None

    def reduce(self) -> None:
        for length in reversed(list(self.lengths)):
            while length in self.left and (members := self.dominant(length)) is not None:
                times = min(self.left[m] // members.count(m) for m in members)
                # With fewer pieces left the proof may change; it holds while one of each is left over.
                self.fix(members, times if len(members) < 3 else max(1, times - 2))

    def best_fit(self) -> None:
        open_at: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, count)
        for length in reversed(list(self.lengths)):
            for room in sorted(r for r in open_at if r >= length):
                if length not in self.left:
                    break
                groups, open_at[room] = open_at[room], []
                for first, count in groups:
                    count -= self._fill(length, first, count, room, open_at)
                    if count > 0:
                        open_at[room].append((first + self._filled, count))
            if length in self.left:
                each = self.capacity // length
                new = -(-self.left[length] // each)
                first = self.sequences
                self.sequences += new
                self._fill(length, first, new, self.capacity, open_at)

    def _fill(self, length: int, first: int, count: int, room: int, open_at: dict) -> int:
        """Best fit takes a sequence until nothing more of the length fits, then the next."""
        each, left = room // length, self.left.get(length, 0)
        full = min(count, left // each)
        for k in range(each):
            self.put(length, full, first, self.capacity - room + k * length)
        if full:
            open_at.setdefault(room - each * length, []).append((first, full))
        rest = min(left - full * each, each) if full < count else 0
        for k in range(rest):
            self.put(length, 1, first + full, self.capacity - room + k * length)
        if rest:
            open_at.setdefault(room - rest * length, []).append((first + full, 1))
        self._filled = full + (rest > 0)
        return self._filled


def packing_plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """Where the pieces of each length go, and the number of sequences."""
    plan = _Plan(counts, capacity)
    plan.reduce()
    plan.best_fit()
    return plan.runs, plan.sequences


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def _tokenize(path: str, capacity: int, end: int, with_ids: bool):
    schema = arrow_schema(_PIECES)
    tail = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).ids
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text"), strict=True):
                    ids = encode(text.as_py()) + tail
                    n = len(ids) // 4
                    first = (n - 1) % capacity + 1  # the short piece comes first
                    starts = [0, *range(first, n, capacity)]
                    for k, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                        piece = ids[4 * a:4 * b]
                        rows.append((doc_id, k, a, b - a, zlib.crc32(piece), piece if with_ids else None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
    return run


_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long"


def _place(runs: dict[int, np.ndarray]):
    schema = arrow_schema(_PLACED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length).tolist():
                at = np.flatnonzero(length == n)
                table = runs[n]
                k = np.searchsorted(table[:, 0], rank[at], side="right") - 1
                sequence[at] = table[k, 1] + rank[at] - table[k, 0]
                offset[at] = table[k, 2]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in schema.names[:6]), pa.array(sequence), pa.array(offset)], schema=schema)
    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END,
         with_ids: bool = False) -> DataFrame:
    """One row per piece of each document (``doc_id``, ``text``): ``doc_id, piece, start,
    length, ids_crc32, ids, sequence_id, offset``; ``ids`` only if ``with_ids``."""
    pieces = materialise(docs.select("doc_id", text_or_empty().alias("text"))
                             .mapInArrow(_tokenize(tokenizer, capacity, end, with_ids), _PIECES), "pack-pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_length: dict[int, list[tuple[int, int, int]]] = {}
    for r in packing_plan(counts, capacity)[0]:
        by_length.setdefault(r.length, []).append((r.rank, r.sequence, r.offset))
    runs = {n: np.array(sorted(v), np.int64) for n, v in by_length.items()}
    blocks = shuffle_partitions(docs.sparkSession)
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)).cast("int"))
    before = (dealt.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
                   .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n"))
                   .drop("n"))
    inner = F.row_number().over(Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = (dealt.withColumn("inner", inner).join(before, ["length", "block"])
                   .withColumn("rank", F.col("before") + F.col("inner") - 1))
    return ranked.mapInArrow(_place(runs), _PLACED)
