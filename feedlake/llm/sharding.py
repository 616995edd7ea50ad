"""Operator 1, sharding: minimax contiguous partition.

Equal texts form one atomic group. The groups are ordered by a 63-bit hash of
the text and the order is cut into at most ``n_shards`` runs, so that the
largest run is as small as any contiguous partition allows: binary search for
the smallest feasible capacity, checked greedily, then cut there.

The order is never sorted or collected. The hash range is summed into cells by
one partial aggregation. A cell that may be cut anywhere gives a lower bound
on the capacity, a cell that may not be cut an upper bound. Only cells in
which a cut can still fall are summed again, more finely, until they hold one
hash value each. Every round collects at most ``MAX_CELLS`` sums, whatever the
input's size, and the result is exact.

Defined cases: a null text counts as empty (size 8) and shares the group of
empty texts; repeated rows are rows of their own in one group; an empty table
gives an empty result; other columns are ignored. A group larger than a fair
share stays whole and sets the capacity.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import materialise, shuffle_partitions, text_or_empty

HASH_BITS = 63
MAX_CELLS_BITS = 16  # sums collected per round: 65,536 at most
Cell = tuple[int, int, int]  # first hash value, width in bits, bytes


def greedy_cuts(ends: list[int], n_shards: int, capacity: int, exact: bool, at: int = 0) -> list[int] | None:
    """Greedy run ends in the running sum from ``at`` on, or None if ``n_shards`` runs do not do.

    ``exact`` cuts only at cell ends, else anywhere.
    """
    total, cuts = ends[-1], []
    while at < total:
        if len(cuts) == n_shards:
            return None
        end = min(total, at + capacity)
        if exact:
            k = bisect_right(ends, end) - 1
            end = ends[k] if k >= 0 else 0
            if end <= at:
                return None
        cuts.append(end)
        at = end
    return cuts


def smallest_capacity(ends: list[int], n_shards: int, exact: bool) -> int:
    low, high = -(-ends[-1] // n_shards), ends[-1]
    while low < high:
        mid = (low + high) // 2
        if greedy_cuts(ends, n_shards, mid, exact) is None:
            low = mid + 1
        else:
            high = mid
    return low


def even_cuts(ends: list[int], n_shards: int, capacity: int) -> list[int]:
    """Run ends at cell ends, each run within ``capacity`` and as near an equal
    part of what is left as the runs after it allow."""
    at, cuts = 0, []
    for left in range(n_shards, 0, -1):
        most = bisect_right(ends, at + capacity) - 1
        low = min(most, max(bisect_right(ends, at), bisect_left(ends, at + (ends[-1] - at) / left)))
        high = most
        while low < high:  # the first end from which the rest can be done
            mid = (low + high) // 2
            if greedy_cuts(ends, left - 1, capacity, True, ends[mid]) is None:
                low = mid + 1
            else:
                high = mid
        at = ends[low]
        cuts.append(at)
        if at == ends[-1]:
            break
    return cuts


def _finer(rows: DataFrame, bits: int, cells: list[Cell]) -> list[Cell]:
    """The given cells, all ``bits`` wide, as sums of narrower cells."""
    room = MAX_CELLS_BITS - (len(cells) - 1).bit_length()
    down = max(0, bits - max(1, room))
    inside = F.lit(True) if bits >= HASH_BITS else \
        F.shiftright("h", bits).isin([c[0] >> bits for c in cells])
    sums = (rows.where(inside).groupBy(F.shiftright("h", down).alias("cell"))
                .agg(F.sum("size").alias("size"), F.min("h").alias("low"), F.max("h").alias("high"))
                .collect())
    # A cell with a single hash value is one group: it can't be cut.
    return [(r["low"], 0, r["size"]) if r["low"] == r["high"] else (r["cell"] << down, down, r["size"])
            for r in sums]


def minimax_boundaries(rows: DataFrame, n_shards: int) -> list[int]:
    """First hash of each shard after the first. ``rows``: ``h`` (0 to 2^63-1), ``size`` > 0."""
    cells = sorted(_finer(rows, HASH_BITS, [(0, HASH_BITS, 0)]))
    while cells:
        ends = list(accumulate(c[2] for c in cells))
        low = smallest_capacity(ends, n_shards, exact=False)
        high = smallest_capacity(ends, n_shards, exact=True)
        # For every capacity between the bounds, the k-th greedy cut falls
        # between these two positions.
        early = late = 0
        open_cells: set[int] = set()
        for _ in range(n_shards):
            k = bisect_right(ends, early + low) - 1
            early = max(early, ends[k] if k >= 0 else 0)
            late = min(ends[-1], late + high)
            span = range(bisect_right(ends, early), min(bisect_left(ends, late) + 1, len(cells)))
            open_cells.update(k for k in span if cells[k][1])
        if not open_cells:
            cuts = even_cuts(ends, n_shards, high)
            return [cells[bisect_right(ends, c)][0] for c in cuts[:-1]]
        bits = max(cells[k][1] for k in open_cells)
        wide = {k for k in open_cells if cells[k][1] == bits}
        wide = set(sorted(wide)[:1 << (MAX_CELLS_BITS - 1)])
        cells = sorted([c for k, c in enumerate(cells) if k not in wide]
                       + _finer(rows, bits, [cells[k] for k in sorted(wide)]))
    return []


def text_hash(col: str = "text") -> Column:
    return F.shiftrightunsigned(F.xxhash64(text_or_empty(col)), 1)


def shard_of(h: Column, boundaries: list[int]) -> Column:
    shard: Column = F.lit(0)
    for b in boundaries:
        shard = shard + (h >= F.lit(b)).cast("int")
    return shard


def shard_documents(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row of ``docs`` (``doc_id``, ``text``)."""
    text = text_or_empty()
    rows = materialise(docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), text_hash().alias("h")), "shard-rows")
    boundaries = minimax_boundaries(rows, n_shards)
    # Slots: rows are dealt to blocks by a hash, so one group does not fill a
    # block; a row's slot is its place in its block plus the blocks before.
    blocks = shuffle_partitions(docs.sparkSession)
    placed = (rows.withColumn("shard", shard_of(F.col("h"), boundaries))
                  .withColumn("block", F.pmod(F.xxhash64("doc_id", "h"), F.lit(blocks)).cast("int")))
    before = (placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
                    .withColumn("before", F.sum("n").over(
                        Window.partitionBy("shard").orderBy("block")) - F.col("n"))
                    .drop("n"))
    inner = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "h"))
    return (placed.withColumn("inner", inner).join(before, ["shard", "block"])
                  .select("doc_id", "size", "text_crc32", "shard",
                          (F.col("before") + F.col("inner") - 1).alias("slot")))


def write_shards(docs: DataFrame, path: str, n_shards: int = 24, writers_per_shard: int = 8) -> None:
    """All columns of ``docs`` as Parquet under ``path``/shard=N."""
    h = text_hash()
    rows = docs.select((F.octet_length(text_or_empty()) + 8).cast("long").alias("size"), h.alias("h"))
    boundaries = minimax_boundaries(materialise(rows, "shard-sizes"), n_shards)
    (docs.withColumn("shard", shard_of(h, boundaries))
         .repartition(n_shards * writers_per_shard, "shard",
                      F.pmod(F.xxhash64("doc_id"), F.lit(writers_per_shard)))
         .write.mode("overwrite").partitionBy("shard").parquet(path))
