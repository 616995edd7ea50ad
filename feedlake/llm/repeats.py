"""Finding places where a stretch of ``length`` symbols may occur again.

Operators 4 and 7 compare all positions of all documents. To bring together
only what can be equal, every document is sampled: of the ``k``-symbol grams
inside each window of ``length`` symbols, the one with the smallest hash (the
first of equals) is the window's anchor. Equal windows have equal anchors at
equal places, so windows need comparing only if their anchors' hashes agree.
That loses nothing; the operator's own method then decides on the symbols.
In a run of one symbol or of a short period anchors of one hash follow each
other; the first keeps its own windows, so that two places show the repeat, and
the windows of the others go together in stretches of about ``STRETCH``.

Steps, each a Spark shuffle of what the one before kept:

1. ``candidate_anchors``: anchors go to buckets by hash, packed into arrays,
   one row per bucket and input batch. Anchors that a batch holds twice are
   known to repeat and are dealt by document, so that a frequent passage sends
   one posting per batch to its bucket, not one per occurrence.
2. ``contexts``: each candidate anchor's windows (the stretch of text that they
   cover) go to the anchor's hash, in batches of bounded size. An anchor with
   more than ``HOT`` stretches, or as much in longer ones, is split into chunks
   by text and place.
3. ``decide``: the operator compares the windows of a pile of whole chunks in
   one task. For split anchors a chunk also sends one digest per distinct
   window, packed by digest bucket.
4. ``settle``: equal digests of different chunks meet.

Texts are keyed by two 64-bit hashes; equal texts are one text throughout.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import arrow_schema, materialise, shuffle_partitions, text_or_empty

HOT = 4096              # contexts of one anchor that one chunk takes
BROADCAST_ANCHORS = 200_000  # split anchors that are broadcast, 16 bytes each
STRETCH = 2048          # windows of anchors of one hash that go together
CUT_BYTES = 1 << 23     # context bytes of an output batch
PIECE = 1 << 18         # symbols sampled at once
SLICE = 500             # documents of a batch that are held as text at once
PILE_BYTES = 1 << 20    # context bytes compared at once
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEED = np.random.default_rng(20240229)
BYTE_CODES = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(n: int, cache: dict = {"n": 0}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    if cache["n"] < n:
        size = max(n, PIECE + 4096)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        cache.update(n=size, up=np.multiply.accumulate(up), down=np.multiply.accumulate(down))
    return cache["up"][:n], cache["down"][:n]


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) ^ (h >> np.uint64(31))


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``codes[start:end]`` for each pair; equal spans have equal hashes."""
    up, down = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[:len(codes)], out=sums[1:])
    return scramble((sums[ends] - sums[starts]) * down[starts])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    n = len(x)
    rows = -(-n // w)
    padded = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    padded = padded.reshape(rows, w)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def anchors(codes: np.ndarray, ends: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, first and last window start of each run of windows with one anchor, or
    with anchors of one hash.

    ``codes`` holds several documents one after another, ``ends`` the end of
    each symbol's document; no window crosses it.
    """
    n = len(codes)
    if n < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(n - k + 1)
    grams = span_hashes(codes, at, at + k)
    ranked = (grams & np.uint64(0xFFFFFFFFFF000000)) | at.astype(np.uint64)
    place = (_sliding_min(ranked, length - k + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
    starts = np.flatnonzero(np.arange(n - length + 1) + length <= ends[:n - length + 1])
    if not len(starts):
        return np.zeros(0, np.uint64), starts, starts
    place = place[starts]
    new = np.flatnonzero((place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
    first = np.concatenate([[0], new])
    last = np.concatenate([new, [len(starts)]]) - 1
    fp, lo, hi = grams[place[first]], starts[first], starts[last]
    # Of neighbours with one hash all but the first go together.
    head = np.concatenate([[True], (fp[1:] != fp[:-1]) | (lo[1:] != hi[:-1] + 1)])
    at = np.maximum.accumulate(np.where(head, np.arange(len(fp)), 0))
    block = np.where(head, -1, (lo - lo[at]) // STRETCH)
    new = np.flatnonzero(head | np.concatenate([[True], block[1:] != block[:-1]]))
    return fp[new], lo[new], hi[np.concatenate([new[1:], [len(fp)]]) - 1]


@dataclass(frozen=True)
class Kind:
    """What a symbol is. ``codes``: symbols' hashes of some documents, concatenated, and
    each document's number of symbols. ``cut``: the stretch of symbols [start, end) of a document."""

    length: int
    k: int
    codes: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    split: Callable[[bytes], object]
    cut: Callable[[object, int, int], bytes]


def _sampled(kind: Kind, texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Document number, anchor hash, first and last window of each anchor."""
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (size == 0 or size + len(texts[upto]) <= PIECE):
            size += len(texts[upto])
            upto += 1
        codes, sizes = kind.codes(texts[at:upto])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.repeat(bounds[1:], sizes)
        for low in range(0, max(1, len(codes)), PIECE):  # one long document: pieces that overlap
            part = slice(low, low + PIECE + kind.length - 1)
            fp, lo, hi = anchors(codes[part], np.minimum(ends[part] - low, PIECE + kind.length - 1),
                                 kind.length, kind.k)
            lo, hi = lo + low, hi + low
            doc = np.searchsorted(bounds, lo, side="right") - 1
            yield doc + at, fp, lo - bounds[doc], hi - bounds[doc]
        at = upto


_POSTINGS = "bucket int, fp binary, ref binary, lo binary, hi binary, known binary"
_CANDIDATES = "r1 long, fp long, lo int, hi int"


def _postings(kind: Kind, n_buckets: int):
    schema = arrow_schema(_POSTINGS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs, first = np.unique(batch.column("r1").to_numpy(zero_copy_only=False), return_index=True)
            if not len(refs):
                continue
            column, parts = batch.column("text"), []
            for low in range(0, len(first), SLICE):
                texts = [t.encode() for t in column.take(pa.array(first[low:low + SLICE])).to_pylist()]
                parts += [(doc + low, fp, a.astype(np.int32), b.astype(np.int32))
                          for doc, fp, a, b in _sampled(kind, texts)]
            doc, fp, lo, hi = (np.concatenate(p) for p in zip(*parts, strict=True))
            del parts
            order = np.argsort(fp, kind="stable")
            ref, fp, lo, hi = refs[doc[order]], fp[order], lo[order], hi[order]
            starts = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]])) if len(fp) else np.zeros(0, int)
            counts = np.diff(np.concatenate([starts, [len(fp)]]))
            known = np.repeat(counts > 1, counts)
            # One posting per anchor hash; all places of those found twice here go by document.
            one = (fp % np.uint64(n_buckets)).astype(np.int64)[starts]
            spread = n_buckets + (ref[known] % n_buckets)
            bucket = np.concatenate([one, spread])
            pick = np.concatenate([starts, np.flatnonzero(known)])
            if not len(bucket):  # only short texts
                continue
            order = np.argsort(bucket, kind="stable")
            bucket, pick = bucket[order], pick[order]
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            rows = [(int(bucket[a]), *(x[pick[a:b]].tobytes() for x in (fp, ref, lo, hi, known)))
                    for a, b in zip(cuts, [*cuts[1:], len(bucket)], strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
    return run


def _found_twice(n_buckets: int):
    schema = arrow_schema(_CANDIDATES)
    kinds = {"fp": np.uint64, "ref": np.int64, "lo": np.int32, "hi": np.int32, "known": np.bool_}

    def unpacked(batches: list[pa.RecordBatch], which: Callable[[int], bool]) -> list[np.ndarray]:
        keep = [(b, i) for b in batches for i, x in enumerate(b.column("bucket").to_pylist()) if which(x)]
        return [np.concatenate([np.zeros(0, t), *(np.frombuffer(b.column(c)[i].as_py(), t) for b, i in keep)])
                for c, t in kinds.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single = []
        for batch in batches:
            fp, ref, lo, hi, _ = unpacked([batch], lambda x: x >= n_buckets)
            if len(fp):
                yield pa.RecordBatch.from_arrays([ref, fp.view(np.int64), lo, hi], schema=schema)
            single.append(batch)
        fp, ref, lo, hi, known = unpacked(single, lambda x: x < n_buckets)
        del single
        order = np.lexsort((lo, ref, fp))
        fp, ref, lo, hi, known = (x[order] for x in (fp, ref, lo, hi, known))
        if not len(fp):
            return
        new = np.concatenate([[True], fp[1:] != fp[:-1]])
        other = np.concatenate([[True], (ref[1:] != ref[:-1]) | (lo[1:] != lo[:-1])]) | new
        starts = np.flatnonzero(new)
        places = np.add.reduceat(other.astype(np.int64), starts) + np.maximum.reduceat(known.astype(np.int64), starts)
        keep = (places > 1)[np.cumsum(new) - 1] & other & ~known
        yield pa.RecordBatch.from_arrays(
            [ref[keep], fp[keep].view(np.int64), lo[keep], hi[keep]], schema=schema)
    return run


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, r1, r2, text`` with null texts as empty ones."""
    text = text_or_empty()
    return docs.select("doc_id", F.xxhash64(text).alias("r1"), F.xxhash64(F.lit(7), text).alias("r2"),
                       text.alias("text"))


def candidate_anchors(texts: DataFrame, kind: Kind) -> DataFrame:
    """``r1, fp, lo, hi``: anchors whose hash occurs at two places or more."""
    n = shuffle_partitions(texts.sparkSession)
    return (texts.select("r1", "text").mapInArrow(_postings(kind, 2 * n), _POSTINGS)
                 .repartition(n, "bucket").mapInArrow(_found_twice(2 * n), _CANDIDATES))


_CONTEXTS = "fp long, chunk int, chunks int, r1 long, r2 long, rep long, lo int, n int, data binary"


def _cut_contexts(kind: Kind):
    schema = arrow_schema(_CONTEXTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                places = part.column("places")
                offsets = places.offsets.to_numpy()
                offsets = offsets - offsets[0]
                fp, lo, hi, chunks = (c.to_numpy(zero_copy_only=False) for c in places.flatten().flatten())
                row = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                r1, r2, rep = (part.column(c).to_numpy(zero_copy_only=False) for c in ("r1", "r2", "rep"))
                # Chunks by text and place: one long text may hold most of an anchor's stretches.
                mixed = scramble(r1[row].view(np.uint64) ^ (lo.astype(np.uint64) << np.uint64(20)))
                chunk = ((mixed >> np.uint64(8)) % chunks.astype(np.uint64)).astype(np.int32)
                data, size, at = [], 0, 0

                def batch_of(at: int, data: list[bytes]) -> pa.RecordBatch:
                    to = slice(at, at + len(data))
                    return pa.RecordBatch.from_arrays(
                        [fp[to], chunk[to], chunks[to], r1[row[to]], r2[row[to]], rep[row[to]], lo[to],
                         (hi[to] - lo[to] + 1).astype(np.int32), pa.array(data, pa.binary())], schema=schema)

                for i, text in enumerate(part.column("text")):
                    symbols = kind.split(text.as_py().encode())
                    for j in range(offsets[i], offsets[i + 1]):
                        data.append(kind.cut(symbols, int(lo[j]), int(hi[j]) + kind.length))
                        size += len(data[-1])
                        if size >= CUT_BYTES:
                            yield batch_of(at, data)
                            data, size, at = [], 0, at + len(data)
                if data:
                    yield batch_of(at, data)
    return run


@dataclass
class Pile:
    """Distinct contexts of whole chunks. A context's windows start at its first ``n`` symbols."""

    data: list[bytes]
    n: np.ndarray       # windows
    least: np.ndarray   # smallest order number among its texts
    many: np.ndarray    # occurs more than once


#: Of each window of the pile: does it repeat, and a number that equal windows share. Where the order of
#: texts counts: does a text with a smaller number have it, and the spans (context, first symbol, symbols)
#: that repeat in each distinct context as its text with the smallest number holds it.
Verdict = tuple[np.ndarray, np.ndarray] | tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]
_MARKS = "target long, r1 long, r2 long, start int, length int, packed binary"
_LEFT = np.dtype([("a", "<u8"), ("b", "<u8"), ("rep", "<i8"), ("r1", "<i8"), ("r2", "<i8"), ("start", "<i4"),
                  ("done", "?")])


def _runs(flags: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of set flags; a run goes on where ``joined`` says so."""
    on = np.flatnonzero(flags)
    if not len(on):
        return on, on
    new = np.flatnonzero((on[1:] != on[:-1] + 1) | ~joined[on[1:]]) + 1
    return on[np.concatenate([[0], new])], on[np.concatenate([new, [len(on)]]) - 1]


def _decide(kind: Kind, by_order: bool, compare: Callable[[Pile], Verdict], n_buckets: int):
    """``by_order``: only occurrences in texts with a larger order number repeat."""
    schema = arrow_schema(_MARKS)

    def pile_marks(table: pa.Table) -> Iterator[pa.RecordBatch]:
        col = {c: table.column(c).to_numpy() for c in ("fp", "chunk", "chunks", "r1", "r2", "rep", "lo", "n")}
        data = table.column("data").to_pylist()
        ids: dict = {}
        which = np.fromiter((ids.setdefault(x, len(ids)) for x in data), np.int64, len(data))
        first = np.unique(which, return_index=True)[1]
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, which, col["rep"])
        pile = Pile(list(ids), col["n"][first], least, np.bincount(which) > 1)
        repeats, same, *spans = compare(pile)
        bounds = np.concatenate([[0], np.cumsum(pile.n)])
        # Back to all contexts: windows of context i at bounds[which[i]].
        n = col["n"].astype(np.int64)
        row = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        window = bounds[which[row]] + step
        if by_order:
            # A context that a text with a smaller number holds as well goes whole.
            again = pile.least[which] < col["rep"]
            marked = again[row] | repeats[window]
            context, first, size = spans[0]
            by = np.argsort(context, kind="stable")
            at = np.searchsorted(context[by], np.arange(len(ids) + 1))
            whole, parsed = np.flatnonzero(again), np.flatnonzero(~again)
            many = np.diff(at)[which[parsed]]
            pick = np.repeat(at[which[parsed]] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            of = np.concatenate([whole, np.repeat(parsed, many)])
            start = np.concatenate([np.zeros(len(whole), np.int64), first[by][pick]])
            size = np.concatenate([n[whole] + kind.length - 1, size[by][pick]])
        else:
            marked = repeats[window] | pile.many[which[row]]
            a, b = _runs(marked, np.concatenate([[False], row[1:] == row[:-1]]))
            of, start, size = row[a], step[a], b - a + kind.length
        if len(of):
            yield pa.RecordBatch.from_arrays(
                [col["r1"][of], col["r1"][of], col["r2"][of], pa.array((col["lo"][of] + start).astype(np.int32)),
                 pa.array(size.astype(np.int32)), pa.nulls(len(of), pa.binary())], schema=schema)
        split = col["chunks"][row] > 1
        if split.any():
            # An entry for each distinct window, of its first text by order, and
            # for each window that other chunks may still mark.
            index = np.flatnonzero(split)
            index = index[np.lexsort((col["rep"][row[index]], same[window[index]]))]
            group = same[window[index]]
            index = index[np.concatenate([[True], group[1:] != group[:-1]]) | ~marked[index]]
            left = np.zeros(len(index), _LEFT)
            for j, i in enumerate(index.tolist()):
                r, s = row[i], int(step[i])
                stretch = kind.cut(kind.split(data[r]), s, s + kind.length)
                digest = hashlib.blake2b(stretch, digest_size=16).digest()
                left[j] = (int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little"),
                           col["rep"][r], col["r1"][r], col["r2"][r], col["lo"][r] + s, marked[i])
            bucket = (left["a"] % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, left = bucket[order], left[order]
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])).tolist()
            packed = [left[x:y].tobytes() for x, y in zip(cuts, [*cuts[1:], len(left)], strict=True)]
            none = pa.nulls(len(cuts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [bucket[cuts], none, none, pa.nulls(len(cuts), pa.int32()), pa.nulls(len(cuts), pa.int32()),
                 pa.array(packed, pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            size += batch.nbytes
            if size < PILE_BYTES:
                continue
            table = pa.Table.from_batches(waiting)
            fp, chunk = table.column("fp").to_numpy(), table.column("chunk").to_numpy()
            ends = np.flatnonzero((fp[1:] != fp[:-1]) | (chunk[1:] != chunk[:-1])) + 1
            at, step = 0, max(1, int(table.num_rows * PILE_BYTES / size))
            while len(ends) and (end := int(ends[min(np.searchsorted(ends, at + step), len(ends) - 1)])) > at:
                yield from pile_marks(table.slice(at, end - at))
                at = end
            waiting = table.slice(at).combine_chunks().to_batches()
            size = sum(b.nbytes for b in waiting)
        if waiting:
            table = pa.Table.from_batches(waiting)
            if table.num_rows:
                yield from pile_marks(table)
    return run


def _settle(kind: Kind, by_order: bool):
    schema = arrow_schema("r1 long, r2 long, start int, length int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = []
        for batch in batches:
            packed = batch.column("packed")
            plain = batch.filter(packed.is_null())
            if plain.num_rows:
                yield pa.RecordBatch.from_arrays([plain.column(c) for c in schema.names], schema=schema)
            left += [np.frombuffer(x, _LEFT) for x in packed.drop_null().to_pylist()]
        if not left:
            return
        x = np.concatenate(left)
        x = x[np.lexsort((x["rep"], x["b"], x["a"]))]
        new = np.concatenate([[True], (x["a"][1:] != x["a"][:-1]) | (x["b"][1:] != x["b"][:-1])])
        group = np.cumsum(new) - 1
        if by_order:
            hit = x["rep"][new][group] < x["rep"]
        else:
            hit = np.bincount(group)[group] > 1
        x = x[hit & ~x["done"]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(x[c])) for c in ("r1", "r2", "start")]
            + [pa.array(np.full(len(x), kind.length, np.int32))], schema=schema)
    return run


def repeated_spans(texts: DataFrame, kind: Kind, classes: DataFrame, by_order: bool,
                   compare: Callable[[Pile], Verdict]) -> tuple[DataFrame, DataFrame]:
    """The distinct texts (``r1, r2, text``) and the spans of symbols that windows
    occurring again cover (``r1, r2, spans``: array of start and length, which may overlap).

    ``texts``: ``r1, r2, text``; ``classes``: ``r1, r2, rep``, a text's order number.
    Both results read one shuffle of the distinct texts if used in one plan.
    """
    n = shuffle_partitions(texts.sparkSession)
    found = materialise(candidate_anchors(texts, kind), "anchors")
    wide = F.ceil((F.col("hi") - F.col("lo") + 1) / (kind.length - kind.k + 1))
    hot = materialise(found.groupBy("fp").agg(F.sum(wide).alias("n")).where(F.col("n") > HOT)
                           .select("fp", F.ceil(F.col("n") / HOT).cast("int").alias("chunks")), "split-anchors")
    if hot.count() <= BROADCAST_ANCHORS:  # else the join shuffles, and AQE splits its hot partitions
        hot = F.broadcast(hot)
    places = (found.join(hot, "fp", "left").join(classes, "r1")
                   .groupBy("r1", "r2", "rep")
                   .agg(F.collect_set(F.struct("fp", "lo", "hi", F.coalesce("chunks", F.lit(1)).alias("chunks")))
                        .alias("places")))
    distinct = texts.dropDuplicates(["r1", "r2"])
    marks = (distinct.join(places.hint("shuffle_hash"), ["r1", "r2"])
                     .select("r1", "r2", "rep", "text", "places")
                     .mapInArrow(_cut_contexts(kind), _CONTEXTS)
                     .repartition(n, "fp", "chunk").sortWithinPartitions("fp", "chunk")
                     .mapInArrow(_decide(kind, by_order, compare, 2 * n), _MARKS))
    spans = (marks.repartition(n, "target")
                  .mapInArrow(_settle(kind, by_order), "r1 long, r2 long, start int, length int")
                  .groupBy("r1", "r2").agg(F.collect_list(F.struct("start", "length")).alias("spans")))
    return distinct, spans


def covered(n: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which of ``n`` symbols the spans cover."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lengths, -1)
    return np.cumsum(step[:-1]) > 0
