"""Operator 12, cross-tokenizer alignment: pointer jumping.

Two tokenizers cut the same bytes. Every token points to the token of the other
side that overlaps it and ends farthest right, or to itself if none ends beyond
it (of two that end at one byte, to the second tokenizer's). Replacing each
pointer by its pointer's pointer doubles the distance jumped, so after a
logarithmic number of rounds all tokens of a component point to its terminal
token, which labels the group. All documents of a batch are one array, laid end
to end; components never cross a document's end, since tokens of both sides end
there.

Links are the pairs of tokens whose bytes overlap. How many documents hold a
pair of ids linked is counted over the whole table:

1. Each batch of documents is tokenised once. Its groups are digested and its
   links kept as packed parts, one per bucket of first ids: the distinct
   codes (pair of ids), the documents that hold each, and how often.
2. Tasks add up the documents of each code over the parts they read; the sums
   meet by bucket, and then by code.
3. A bucket's counts, with the mark of the highest per first id, become one
   packed table. Its size is bounded by the two vocabularies. It goes to every
   chunk of the bucket's parts, and the parts stream past it.
4. Per document, the counts are summed.

A hot pair is one code per batch, so no group grows with the documents that
hold it, and a chunk has a fixed number of batches.

Defined cases: a null or empty text, or one whose tokens of either side do not
give back its bytes, has no tokens: zeros and an empty string; repeated rows are
documents of their own, also in the counts; null ids are kept; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import arrow_schema, materialise, shuffle_partitions, text_or_empty
from feedlake.llm.tokens import _byte_letters, encoder

BUCKETS = 16          # of first ids
BATCH_BYTES = 1 << 19
BATCH_ROWS = 1000     # a document's number in its batch fits 10 bits
CHUNK_BATCHES = 128   # batches whose parts pass one copy of a bucket's counts
SUM_TASKS = 64        # tasks whose sums of a bucket meet
SUM_CODES = 1 << 20   # distinct codes held before sums are sent
_DOC_BITS = 10


class Pair:
    """Both tokenizers, the bytes of their tokens, and the decimal texts of their ids."""

    def __init__(self, first: str, second: str):
        import sentencepiece

        self.first = encoder(first)
        letters = _byte_letters()
        with open(first, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        self.first_bytes = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.first_bytes[i] = bytes(letters[c] for c in token)
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        self.second_bytes = [self._piece(i) for i in range(self.second.vocab_size())]
        self.first_lengths = np.array([len(b) for b in self.first_bytes], np.int64)
        self.second_lengths = np.array([len(b) for b in self.second_bytes], np.int64)
        a, b = range(len(self.first_bytes)), range(len(self.second_bytes))
        self.names = np.array([f"{i}," for i in a] + [f"{i}|" for i in a] + [f"{i}," for i in b] + [f"{i};" for i in b],
                              object)

    def _piece(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        if self.second.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides of each text; None where they do not give back its bytes."""
        out = []
        for text, second in zip(texts, self.second.encode(texts, num_threads=1), strict=True):
            whole = b" " + text.encode()
            first = self.first.encode(" " + text) if text else []
            sound = (text and b"".join([self.second_bytes[i] for i in second]) == whole
                     and b"".join([self.first_bytes[i] for i in first]) == whole)
            out.append((np.array(first, np.int64), np.array(second, np.int64)) if sound else None)
        return out


@cache
def pair(first: str, second: str) -> Pair:
    """One per Python worker and pair of files."""
    return Pair(first, second)


def tokens_at(ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``size`` bytes, the token that holds it, and whether one ends before it (or at the end)."""
    cut = np.zeros(size + 1, bool)
    cut[ends] = True
    return np.cumsum(cut[:-1], dtype=np.int32 if size < 1 << 31 else np.int64), cut


def components(first_ends: np.ndarray, second_ends: np.ndarray, first_at: np.ndarray, second_at: np.ndarray,
               first_cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers, from 0 in byte order, of the tokens of both sides; a side is given by the
    byte offsets at which its tokens end (see ``tokens_at``)."""
    n = len(first_ends)
    beyond = first_at[second_ends - 1]                  # the first side's token with a second one's last byte
    terminal = first_cut[second_ends]
    own = n + np.arange(len(second_ends))
    pointer = np.concatenate([n + second_at[first_ends - 1], np.where(terminal, own, beyond)])
    while True:
        further = pointer[pointer]
        if np.array_equal(further, pointer):
            break
        pointer = further
    label = (np.cumsum(terminal) - 1)[pointer - n]      # every pointer is at a terminal, on the second side
    return label[:n], label[n:]


def overlaps(first_at: np.ndarray, second_at: np.ndarray, first_cut: np.ndarray,
             second_cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of overlapping tokens, as places on both sides, and the byte after each overlap.
    The overlaps are what both sides' cuts together leave of the bytes."""
    ends = np.flatnonzero(first_cut | second_cut)
    return first_at[ends - 1], second_at[ends - 1], ends


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(len(a) for a in arrays)], np.uint32)
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head.tobytes(), *(a.tobytes() for a in arrays)]))


def _unpack(data: bytes, *kinds: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    at, out = 4 * (1 + len(kinds)), []
    for n, kind in zip(np.frombuffer(raw, np.uint32, len(kinds), 4), kinds, strict=True):
        out.append(np.frombuffer(raw, kind, int(n), at))
        at += out[-1].nbytes
    return out


def pack_part(codes: np.ndarray, docs: np.ndarray, times: np.ndarray) -> bytes:
    """Entries sorted by code, then document; codes as differences, times mostly in a byte."""
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    distinct = codes[first]
    small = np.minimum(times, 255).astype(np.uint8)
    return _pack(np.diff(distinct, prepend=0).astype(np.uint32), np.diff(np.r_[first, len(codes)]).astype(np.uint16),
                 docs.astype(np.uint16), small, times[times >= 255].astype(np.uint32))


def unpack_part(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes, documents of each, and per entry the document and how often."""
    codes, held, docs, small, large = _unpack(data, np.uint32, np.uint16, np.uint16, np.uint8, np.uint32)
    times = small.astype(np.int64)
    times[small == 255] = large
    return np.cumsum(codes, dtype=np.int64), held.astype(np.int64), docs.astype(np.int64), times


def align(tokens: list[tuple[np.ndarray, np.ndarray] | None], both: Pair,
          buckets: int = BUCKETS) -> tuple[list[tuple], list[bytes | None]]:
    """Per document ``n_a, n_b, n_groups, n_links, groups_sha256, groups``; packed links per bucket."""
    rows: list[tuple] = [(0, 0, 0, 0, "", "")] * len(tokens)
    some = [k for k, t in enumerate(tokens) if t is not None]
    if not some:
        return rows, [None] * buckets
    a, b = (np.concatenate([tokens[k][side] for k in some]) for side in (0, 1))
    a_after, b_after = (np.cumsum([len(tokens[k][side]) for k in some]) for side in (0, 1))
    a_ends, b_ends = np.cumsum(both.first_lengths[a]), np.cumsum(both.second_lengths[b])
    (a_at, a_cut), (b_at, b_cut) = (tokens_at(ends, int(a_ends[-1])) for ends in (a_ends, b_ends))
    a_group, b_group = components(a_ends, b_ends, a_at, b_at, a_cut)
    n_groups = int(b_group[-1]) + 1
    groups_after = b_group[b_after - 1] + 1

    # All ids in the order of the groups, each with what follows it.
    in_a, in_b = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
    listed = np.empty(len(a) + len(b), np.int64)
    n_first, n_second = len(both.first_bytes), len(both.second_bytes)
    last_a, last_b = np.r_[a_group[1:] != a_group[:-1], True], np.r_[b_group[1:] != b_group[:-1], True]
    listed[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[a_group]] = a + n_first * last_a
    listed[np.arange(len(b)) + np.cumsum(in_a)[b_group]] = 2 * n_first + b + n_second * last_b
    names = both.names[listed].tolist()

    left, right, ends = overlaps(a_at, b_at, a_cut, b_cut)
    links_after = np.searchsorted(ends, a_ends[a_after - 1]) + 1
    before = (0, 0, 0, 0)
    for k, *after in zip(some, a_after.tolist(), b_after.tolist(), groups_after.tolist(), links_after.tolist(),
                         strict=True):
        text = "".join(names[before[0] + before[1]:after[0] + after[1]])[:-1]
        rows[k] = (*(y - x for x, y in zip(before, after, strict=True)), hashlib.sha256(text.encode()).hexdigest(), text)
        before = tuple(after)

    # Entries by bucket, code and document; ``some`` numbers fit _DOC_BITS.
    first, second = a[left], b[right]
    doc = np.repeat(np.array(some), np.diff(np.r_[0, links_after]))
    code = first * n_second + second
    keys, times = np.unique(((first % buckets << 32) + code << _DOC_BITS) + doc, return_counts=True)
    cuts = np.searchsorted(keys, np.arange(buckets + 1) << 32 + _DOC_BITS)
    parts: list[bytes | None] = []
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own = keys[low:high]
        parts.append(pack_part(own >> _DOC_BITS & 0xFFFFFFFF, own & (1 << _DOC_BITS) - 1, times[low:high])
                     if high > low else None)
    return rows, parts


_DOC = pa.struct([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                  ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string())])
_DOC_DDL = ("doc_id: bigint, n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, "
            "groups_sha256: string, groups: string")


def _tokenise(first: str, second: str, buckets: int, with_groups: bool):
    schema = pa.schema([("batch", pa.int64()), ("docs", pa.list_(_DOC)), ("parts", pa.list_(pa.binary()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(first, second)
        number = TaskContext.get().partitionId() << 32

        def result(ids: list, texts: list[str]) -> pa.RecordBatch:
            rows, parts = align(both.tokens(texts), both, buckets)
            docs = [{"doc_id": i, "n_a": r[0], "n_b": r[1], "n_groups": r[2], "n_links": r[3], "groups_sha256": r[4],
                     "groups": r[5] if with_groups else None} for i, r in zip(ids, rows, strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([docs], schema.types[1]), pa.array([parts], schema.types[2])],
                schema=schema)

        ids: list = []
        texts: list[str] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids.append(doc_id.as_py())
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= BATCH_BYTES or len(ids) == BATCH_ROWS:
                    yield result(ids, texts)
                    ids, texts, size, number = [], [], 0, number + 1
        if ids:
            yield result(ids, texts)
    return run


def _sums(buckets: int):
    """Documents per code over the parts that a task reads, a bounded number of codes at a time."""
    schema = arrow_schema("bucket int, chunk long, data binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() // SUM_TASKS
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(buckets)]
        size = 0

        def merged() -> int:
            total = 0
            for k, some in enumerate(held):
                if some:
                    held[k] = [add_up(some)]
                    total += len(held[k][0][0])
            return total

        def sent() -> pa.RecordBatch:
            merged()
            full = [k for k in range(buckets) if held[k]]
            data = [_pack(np.diff(held[k][0][0], prepend=0).astype(np.uint32), held[k][0][1]) for k in full]
            for k in full:
                held[k] = []
            return pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([chunk] * len(full), pa.int64()), pa.array(data, pa.binary())],
                schema=schema)

        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data"), strict=True):
                codes, documents, _, _ = unpack_part(data.as_py())
                held[bucket].append((codes, documents))
                size += len(codes)
                if size >= 4 * SUM_CODES:
                    size = merged()
                    if size >= SUM_CODES:
                        yield sent()
                        size = 0
        yield sent()
    return run


def add_up(some: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, sorted, and the sums of their counts."""
    if len(some) == 1:
        return some[0]
    codes, counts = (np.concatenate(x) for x in zip(*some, strict=True))
    by = np.argsort(codes, kind="stable")
    codes, counts = codes[by], counts[by]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]][:len(codes)])
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of one bucket and chunk follow each other; ``code, documents`` of each."""
    schema = arrow_schema("bucket int, code long, documents long")
    held: tuple[np.ndarray, np.ndarray] | None = None
    now = None

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(held[0]), now[0], np.int32)), pa.array(held[0]), pa.array(held[1])], schema=schema)

    for batch in batches:
        for bucket, chunk, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "chunk", "data")), strict=True):
            if now is not None and now != (bucket, chunk):
                yield rows()
                held = None
            now = (bucket, chunk)
            codes, counts = _unpack(data, np.uint32, np.int64)
            one = (np.cumsum(codes, dtype=np.int64), counts)
            held = one if held is None else add_up([held, one])
    if held is not None:
        yield rows()


def _table(n_second: int):
    """A bucket's counts, sorted by code, as one packed row with the marks of the highest of each first id."""
    def run(group: pa.Table) -> pa.Table:
        codes = group.column("code").to_numpy()
        by = np.argsort(codes, kind="stable")
        codes, counts = codes[by], group.column("documents").to_numpy()[by]
        first = codes // n_second
        start = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
        highest = np.maximum.reduceat(counts, start)
        best = counts == np.repeat(highest, np.diff(np.r_[start, len(codes)]))
        data = _pack(np.diff(codes, prepend=0).astype(np.uint32), counts, best.astype(np.uint8))
        return pa.table({"bucket": group.column("bucket").slice(0, 1), "data": pa.array([data], pa.binary())})
    return run


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batch, doc, n_best, count_sum``; a bucket's counts (batch -1) come before its parts."""
    schema = arrow_schema("batch long, doc int, n_best long, count_sum long")
    codes = counts = best = np.empty(0, np.int64)
    for batch in batches:
        for number, data in zip(batch.column("batch").to_pylist(), batch.column("data"), strict=True):
            if number < 0:
                steps, counts, best = _unpack(data.as_py(), np.uint32, np.int64, np.uint8)
                codes = np.cumsum(steps, dtype=np.int64)
                continue
            own, held, docs, times = unpack_part(data.as_py())
            at = np.repeat(np.searchsorted(codes, own), held)
            n = 1 << _DOC_BITS
            # Sums of whole numbers below 2 ** 53, so exact in doubles.
            n_best = np.bincount(docs, times * best[at], n).astype(np.int64)
            total = np.bincount(docs, times * counts[at], n).astype(np.int64)
            some = np.flatnonzero(np.bincount(docs, minlength=n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), number, np.int64)), pa.array(some.astype(np.int32)),
                 pa.array(n_best[some]), pa.array(total[some])], schema=schema)


def link_counts(parts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, code, documents``: how many documents hold each linked pair of ids."""
    sums = parts.select("bucket", "data").mapInArrow(_sums(buckets), "bucket int, chunk long, data binary")
    n = shuffle_partitions(parts.sparkSession)
    met = (sums.repartition(n, "bucket", "chunk").sortWithinPartitions("bucket", "chunk")
               .mapInArrow(_meet, "bucket int, code long, documents long"))
    return met.groupBy("bucket", "code").agg(F.sum("documents").alias("documents"))


def token_alignment(docs: DataFrame, first: str, second: str, buckets: int = BUCKETS,
                    with_groups: bool = False) -> DataFrame:
    """Tokens of both sides, groups, links and their counts of every row of ``docs``
    (``doc_id``, ``text``); ``first`` is a byte-level ``tokenizers`` file and ``second`` a
    ``sentencepiece`` model that adds a space. ``with_groups`` adds the groups as text."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    whole = materialise(rows.mapInArrow(
        _tokenise(first, second, buckets, with_groups),
        f"batch long, docs array<struct<{_DOC_DDL}>>, parts array<binary>"), "alignment")
    parts = (whole.select("batch", F.posexplode("parts").alias("bucket", "data")).where("data IS NOT NULL"))
    tables = materialise(link_counts(parts, buckets).groupBy("bucket").applyInArrow(
        _table(pair(first, second).second.vocab_size()), "bucket int, data binary"), "alignment-counts")
    chunks = -(-max(1, whole.count()) // CHUNK_BATCHES)
    copies = tables.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"),
                           F.lit(-1).cast("long").alias("batch"), "data")
    passing = parts.select("bucket", F.pmod(F.xxhash64("batch"), F.lit(chunks)).alias("chunk"), "batch", "data")
    scored = (passing.unionByName(copies).repartition(shuffle_partitions(spark), "bucket", "chunk")
              .sortWithinPartitions("bucket", "chunk", "batch")
              .mapInArrow(_score, "batch long, doc int, n_best long, count_sum long")
              .groupBy("batch", "doc").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    base = whole.select("batch", F.posexplode("docs").alias("doc", "x")).select("batch", "doc", "x.*")
    none = F.lit(0).cast("long")
    return (base.join(scored, ["batch", "doc"], "left")
                .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
                        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
                        *(["groups"] if with_groups else [])))
