"""Operator 4, suffix-array dedup: two-stage suffix sorting.

A byte goes if a 200-byte string that covers it also starts anywhere else, in
the same document or another. ``repeats`` brings together the stretches of
text whose windows can be equal. Within a pile of such stretches the windows
are sorted as suffixes in two stages: suffixes smaller than their successor
are sorted directly, the others are induced from them by scanning the buckets
of first bytes in order. Adjacent suffixes with a common prefix of 200 bytes
or more repeat.

Defined cases: a null text is empty; a text below 200 bytes keeps all; equal
texts of 200 bytes or more go whole, every one of them; repeated rows count as
occurrences; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import arrow_schema, materialise
from feedlake.llm.repeats import BYTE_CODES, Kind, Pile, Verdict, covered, keyed, repeated_spans

LENGTH = 200


def _codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return (BYTE_CODES[np.frombuffer(b"".join(texts), np.uint8)],
            np.fromiter(map(len, texts), np.int64, len(texts)))


def byte_kind(length: int = LENGTH) -> Kind:
    return Kind(length, max(1, length * 8 // 25), _codes, lambda text: text, lambda text, a, b: text[a:b])


def two_stage_sort(data: bytes, ends: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions ordered by the ``depth`` bytes that follow them.

    ``data`` is a row of strings, ``ends`` the end of the string of each byte;
    ``wanted`` flags positions. A string's last byte has the end of the string,
    smaller than any byte, as its successor.
    """
    text = np.frombuffer(data, np.uint8)
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    at = np.arange(n)
    step = np.zeros(n, np.int8)  # -1: smaller than the successor, by the first bytes that differ
    step[:-1] = np.sign(text[:-1].astype(np.int16) - text[1:].astype(np.int16))
    step[at + 1 == ends] = 1
    decides = np.where(step != 0, at, n)
    decides = np.minimum.accumulate(decides[::-1])[::-1]
    rising = step[decides] < 0
    # Inducing a falling suffix needs its successors up to the next rising one.
    nearest = np.minimum.accumulate(np.where(rising, at, n)[::-1])[::-1]
    need = np.zeros(n + 1, np.int64)
    falling = np.flatnonzero(wanted & ~rising)
    stop = np.minimum(nearest[falling], ends[falling])  # at most the string's end
    np.add.at(need, falling, 1)
    np.add.at(need, stop, -1)
    chain = np.cumsum(need[:-1]) > 0
    seeds = np.unique(np.concatenate([np.flatnonzero(wanted & rising), stop]))
    # A seed at a string's end is the empty suffix; its place is before all others.
    seed_end = np.zeros(n + 1, bool)
    seed_end[stop[stop == ends[falling]]] = True

    # Stage 1: the rising suffixes, directly.
    direct = seeds[(seeds < n) & rising[np.minimum(seeds, n - 1)]]
    string_end = ends[direct]
    keys = [data[p:min(p + depth, e)] for p, e in zip(direct.tolist(), string_end.tolist(), strict=True)]
    direct = direct[np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)]
    del keys
    by_byte = np.searchsorted(text[direct], np.arange(257))

    # Stage 2: buckets of first bytes in order; each sorted suffix places its
    # falling predecessor in the bucket of that one's first byte.
    ahead: list[list[np.ndarray]] = [[] for _ in range(256)]

    def place(sorted_part: np.ndarray) -> np.ndarray:
        """The predecessors to induce, in order."""
        before = sorted_part - 1
        before = before[before >= 0]
        return before[chain[before] & ~rising[before]]

    def deal(found: np.ndarray) -> None:
        if not len(found):
            return
        first = text[found]
        order = np.argsort(first, kind="stable")
        found, first = found[order], first[order]
        cuts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        for a, b in zip(cuts, [*cuts[1:], len(found)], strict=True):
            ahead[first[a]].append(found[a:b])

    ends_found = np.flatnonzero(seed_end) - 1
    ends_found = ends_found[chain[ends_found] & ~rising[ends_found]]
    deal(ends_found)
    out = []
    for c in range(256):
        queue = np.concatenate(ahead[c]) if ahead[c] else np.zeros(0, np.int64)
        while len(queue):
            out.append(queue)
            found = place(queue)
            # The last byte of a string is no predecessor of the next string's first.
            found = found[ends[found] != found + 1]
            again = text[found] == c
            deal(found[~again])
            queue = found[again]
        risen = direct[by_byte[c]:by_byte[c + 1]]
        if len(risen):
            out.append(risen)
            found = place(risen)
            deal(found[(ends[found] != found + 1) & (text[found] > c)])
    result = np.concatenate(out) if out else np.zeros(0, np.int64)
    return result[wanted[result]]


def equal_windows(pile: Pile, length: int = LENGTH) -> Verdict:
    data = b"".join(pile.data)
    sizes = np.fromiter(map(len, pile.data), np.int64, len(pile.data))
    begin = np.cumsum(sizes) - sizes
    ends = np.repeat(begin + sizes, sizes)
    wanted = np.zeros(len(data), bool)
    number = np.cumsum(pile.n) - pile.n
    total = int(pile.n.sum())
    place = np.repeat(begin, pile.n) + np.arange(total) - np.repeat(number, pile.n)
    wanted[place] = True
    order = two_stage_sort(data, ends, wanted, length)
    window = np.zeros(len(data) + 1, np.int64)
    window[place] = np.arange(total)
    rows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), length)
    same = np.zeros(len(order), bool)  # common prefix with the suffix before reaches the length
    for low in range(1, len(order), 1 << 15):
        high = min(len(order), low + (1 << 15))
        same[low:high] = (rows[order[low:high]] == rows[order[low - 1:high - 1]]).all(axis=1)
    number = np.cumsum(~same) - 1
    repeats, group = np.zeros(total, bool), np.zeros(total, np.int64)
    again = same.copy()
    again[:-1] |= same[1:]
    repeats[window[order]] = again
    group[window[order]] = number
    return repeats, group


_KEPT = "r1 long, r2 long, n_removed long, n_spans long, kept_sha256 string, kept binary, kept_text string"


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> str:
    """The text without every character of which a byte goes."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(starts):
        return ""
    broken = np.logical_or.reduceat(gone, starts)
    return data[~np.repeat(broken, np.diff(np.append(starts, len(data))))].tobytes().decode()


def _kept(with_text: bool):
    schema = arrow_schema(_KEPT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                data = np.frombuffer(text.as_py().encode(), np.uint8)
                start, length = (c.to_numpy() for c in spans.values.flatten())
                gone = covered(len(data), start, length)
                kept = data[~gone].tobytes()
                edges = np.diff(np.concatenate([[False], gone]).astype(np.int8))
                rows.append((int(gone.sum()), int((edges > 0).sum()), hashlib.sha256(kept).hexdigest(),
                             kept if with_text else None, _whole_characters(data, gone) if with_text else None))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("r1"), batch.column("r2"),
                     *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types[2:], strict=True))],
                    schema=schema)
    return run


def suffix_dedup(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row of ``docs``
    (``doc_id``, ``text``). ``with_text`` adds ``r1, r2``, the hashes of the text, and, where
    something was removed, the remaining bytes as ``kept`` and the remaining whole characters
    as ``kept_text``."""
    texts = keyed(docs)
    rows = materialise(texts.select(
        "doc_id", "r1", "r2", F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2(F.col("text").cast("binary"), 256).alias("whole")), "suffix-rows")
    classes = rows.groupBy("r1", "r2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    distinct, spans = repeated_spans(texts.select("r1", "r2", "text"), byte_kind(length),
                                     classes.select("r1", "r2", F.lit(0).cast("long").alias("rep")), False,
                                     lambda pile: equal_windows(pile, length))
    changed = (distinct.join(spans.hint("shuffle_hash"), ["r1", "r2"]).select("r1", "r2", "text", "spans")
                       .mapInArrow(_kept(with_text), _KEPT))
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    pick = lambda c, whole, none: F.when(gone, whole).otherwise(F.coalesce(F.col(c), none))
    out = (rows.join(classes, ["r1", "r2"]).join(changed, ["r1", "r2"], "left")
               .select("doc_id", "r1", "r2", "n_bytes",
                       pick("n_removed", F.col("n_bytes"), F.lit(0)).cast("long").alias("n_removed"),
                       pick("n_spans", F.lit(1), F.lit(0)).cast("long").alias("n_spans"),
                       pick("kept_sha256", F.sha2(F.lit("").cast("binary"), 256), F.col("whole")).alias("kept_sha256"),
                       F.when(gone, F.lit("").cast("binary")).otherwise(F.col("kept")).alias("kept"),
                       F.when(gone, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text")))
    return out if with_text else out.drop("kept", "kept_text", "r1", "r2")
