"""Operator 5, n-gram Jaccard join: count-vector R-tree.

A document is the set of its 5-word shingles. Documents link when their
Jaccard similarity is at least ``percent``. Equal sets are one node.

1. Blocking, exact: in any fixed order of all shingles, two linked sets share
   one among the first ``n - ceil(t n) + 1`` of each. The order is by hash, with
   frequent shingles last, so shingles of common passages rarely block. Which
   are frequent is estimated on a sample of at most ``SAMPLE_MOST`` documents;
   it moves work, not results. Nodes that share a shingle there form a block;
   equal blocks are one, and large ones are dealt out as leaves.
2. Count-vector R-tree: a set's shingles are hashed into ``GROUPS`` groups, and
   its counts per group are a point. In a block the points are packed into tree
   nodes with the largest count of each group and the smallest set size. The sum
   of the coordinates' minima bounds the overlap of two points, and of any two
   points in two tree nodes; pairs of nodes, then of points, that cannot reach
   the overlap they need are left out.
3. Verification on the sets of the pairs that are left, in two rounds. In the
   first each point proposes one partner per block, which joins a large group of
   near copies without comparing all its pairs. The second takes every pair of
   a block whose ends are still in different components, so no link between
   components is lost.

Defined cases: a null or blank text has the empty set and links with nothing;
a text below five words has one shingle; repeated rows share a node and link;
an empty table gives an empty result; other columns are ignored. Shingles are
compared by 63-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import arrow_schema, connected_components, materialise, shuffle_partitions
from feedlake.llm.repeats import keyed, scramble, span_hashes
from feedlake.llm.substring_dedup import word_codes

SHINGLE = 5
PERCENT = 75
GROUPS = 512
FANOUT = 16          # points in a tree node
LEAF = 256           # points of a large block that one task takes from it at once
SAMPLE_PART = 10     # one document in so many is sampled for frequent shingles
SAMPLE_LEAST, SAMPLE_MOST = 5_000, 1_000_000
FREQUENT_MOST = 65_536
BROADCAST_TEXTS = 1_000_000  # keys of texts to verify that are broadcast, 24 bytes each
SLICE = 200          # documents, and bytes of text, that a task holds with their word hashes at once
SLICE_BYTES = 1 << 20
POSTED = 1 << 18     # postings that a task holds before they go out
HOT_BIT = np.uint64(1 << 63)


def shingles(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Document number and shingle hash (63 bits), each shingle once, ordered by both."""
    codes, sizes = word_codes([t.lower() for t in texts])  # bytes.lower() lowers A-Z only
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    ends = np.repeat(bounds[1:], sizes)
    at = np.arange(len(codes))
    whole = (at == np.repeat(bounds[:-1], sizes)) & (np.repeat(sizes, sizes) < size)
    starts = np.flatnonzero((at + size <= ends) | whole)
    hashes = span_hashes(codes, starts, np.minimum(starts + size, ends[starts])) >> np.uint64(1)
    doc = np.repeat(np.arange(len(texts)), sizes)[starts]
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[new], hashes[new]


def _nodes(n_docs: int, doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size and hash of each document's set; the hash does not depend on the order of its shingles."""
    n = np.bincount(doc, minlength=n_docs)
    starts = np.cumsum(n) - n
    total = np.concatenate([[np.uint64(0)], np.cumsum(scramble(hashes + np.uint64(1)), dtype=np.uint64)])
    return n, scramble(total[starts + n] - total[starts] + n.astype(np.uint64)).view(np.int64)


def _slices(batch: pa.RecordBatch, rows: np.ndarray | None = None) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """``batch``, or its ``rows``, in parts of bounded rows and bytes (a longer text is a part of its own)."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.arange(batch.num_rows) if rows is None else rows
    upto = np.cumsum(sizes[rows])
    low = 0
    while low < len(rows):
        before = int(upto[low - 1]) if low else 0
        high = min(max(low + 1, int(np.searchsorted(upto, before + SLICE_BYTES, side="right"))), low + SLICE)
        part = batch.take(pa.array(rows[low:high]))
        yield part, [t.encode() for t in part.column("text").to_pylist()]
        low = high


_PROFILE = "doc_id long, r1 long, r2 long, n_shingles long, node long, point binary"


def _points(n_docs: int, doc: np.ndarray, hashes: np.ndarray) -> pa.Array:
    """Each document's count vector."""
    group = (scramble(hashes + np.uint64(3)) % np.uint64(GROUPS)).astype(np.int64)
    points = np.bincount(doc * GROUPS + group, minlength=n_docs * GROUPS).reshape(n_docs, GROUPS)
    kinds = [np.uint8 if m < 1 << 8 else np.uint16 if m < 1 << 16 else np.uint32
             for m in points.max(axis=1, initial=0).tolist()]
    return pa.array([p.astype(k).tobytes() for p, k in zip(points, kinds, strict=True)], pa.binary())


def _unpacked(points: list[bytes]) -> np.ndarray:
    """Count vectors of one, two or four bytes a group."""
    return np.array([np.frombuffer(p, f"<u{len(p) // GROUPS}") for p in points], np.int32).reshape(len(points), GROUPS)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_PROFILE)
    for batch in batches:
        for part, texts in _slices(batch):
            doc, h = shingles(texts)
            n, node = _nodes(len(texts), doc, h)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("doc_id", "r1", "r2")), pa.array(n), pa.array(node),
                 _points(len(texts), doc, h)], schema=schema)


def _plain_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in _slices(batch):
            yield pa.RecordBatch.from_arrays([pa.array(shingles(texts)[1].view(np.int64))],
                                             schema=arrow_schema("h long"))


def frequent_shingles(texts: DataFrame, n_texts: int) -> np.ndarray:
    part = max(1, min(SAMPLE_PART, n_texts // SAMPLE_LEAST), n_texts // SAMPLE_MOST)
    rows = (texts.where(F.pmod(F.xxhash64("r2"), F.lit(part)) == 0).dropDuplicates(["r1", "r2"])
                 .select("text").mapInArrow(_plain_shingles, "h long")
                 .groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 2")
                 .orderBy(F.desc("n"), "h").limit(FREQUENT_MOST).select("h").collect())
    return np.sort(np.array([r["h"] for r in rows], np.int64).astype(np.uint64))


_POSTINGS = "bucket int, token binary, node binary"


def _postings(frequent: np.ndarray, percent: int, n_buckets: int):
    schema = arrow_schema(_POSTINGS)

    def dealt(tokens: list[np.ndarray], nodes: list[np.ndarray]) -> pa.RecordBatch:
        token, node = np.concatenate(tokens), np.concatenate(nodes)
        bucket = (token % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        token, node, bucket = token[order], node[order], bucket[order]
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])).tolist()
        spans = list(zip(cuts, [*cuts[1:], len(token)], strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[cuts].astype(np.int32)),
             *(pa.array([x[a:b].tobytes() for a, b in spans], pa.binary()) for x in (token, node))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, nodes, held = [], [], 0
        for batch in batches:
            # Copies in a batch once.
            _, first = np.unique(batch.column("r1").to_numpy(zero_copy_only=False), return_index=True)
            for _, texts in _slices(batch, np.sort(first)):
                doc, h = shingles(texts)
                n, node = _nodes(len(texts), doc, h)
                if len(frequent):
                    k = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
                    h = np.where(frequent[k] == h, h | HOT_BIT, h)
                    h = h[np.lexsort((h, doc))]
                start = np.cumsum(n) - n
                take = n - -(-percent * n // 100) + 1
                pick = np.arange(len(doc)) - start[doc] < take[doc]
                tokens.append(h[pick])
                nodes.append(node[doc[pick]])
                held += len(tokens[-1])
                if held >= POSTED:
                    yield dealt(tokens, nodes)
                    tokens, nodes, held = [], [], 0
        if held:
            yield dealt(tokens, nodes)
    return run


_BLOCKS = "block long, leaf int, leaves int, nodes binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes that share a token; equal lists once per task."""
    schema = arrow_schema(_BLOCKS)
    held_tokens, held_nodes = bytearray(), bytearray()
    for b in batches:
        for t, n in zip(b.column("token"), b.column("node"), strict=True):
            held_tokens += t.as_py()
            held_nodes += n.as_py()
    if not held_tokens:
        return
    token, node = np.frombuffer(held_tokens, np.uint64), np.frombuffer(held_nodes, np.int64)
    order = np.lexsort((node, token))
    token, node = token[order], node[order]
    new = np.concatenate([[True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])])
    token, node = token[new], node[new]
    starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(token)]]))
    name = np.add.reduceat(scramble(node.view(np.uint64) + np.uint64(11)), starts)
    many = np.flatnonzero(sizes > 1)
    many = many[np.unique(name[many], return_index=True)[1]]
    rows = []
    for i in many.tolist():
        a, m = int(starts[i]), int(sizes[i])
        leaves = -(-m // LEAF)
        rows += [(int(name[i].view(np.int64)), k, leaves, node[a + k * LEAF:min(a + m, a + (k + 1) * LEAF)].tobytes())
                 for k in range(leaves)]
        if len(rows) >= 10_000:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per node of a leaf."""
    for batch in batches:
        nodes = [np.frombuffer(x, np.int64) for x in batch.column("nodes").to_pylist()]
        sizes = np.fromiter(map(len, nodes), np.int64, len(nodes))
        at = np.repeat(np.arange(len(nodes)), sizes)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(pa.array(at)) for c in ("block", "leaf", "leaves")),
             pa.array(np.concatenate([np.zeros(0, np.int64), *nodes]))],
            schema=arrow_schema("block long, leaf int, leaves int, node long"))


_SETS = "node long, shingles binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_SETS)
    for batch in batches:
        for part, texts in _slices(batch):
            doc, h = shingles(texts)
            n = np.bincount(doc, minlength=len(texts))
            ends = np.cumsum(n).tolist()
            yield pa.RecordBatch.from_arrays(
                [part.column("node"),
                 pa.array([h[e - k:e].tobytes() for e, k in zip(ends, n.tolist(), strict=True)], pa.binary())],
                schema=schema)


def _reach(n_a: np.ndarray, n_b: np.ndarray, overlap: np.ndarray, percent: int) -> np.ndarray:
    """Can sets of these sizes with at most this overlap link?"""
    overlap = np.minimum(overlap, np.minimum(n_a, n_b))
    return 100 * overlap >= percent * (n_a + n_b - overlap)


def tree_pairs(points: np.ndarray, n: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, ...]:
    """Index pairs (i < j) of points that the bounds cannot rule out, and their bounds.

    The points are packed into tree nodes in order of set size and first
    differing counts; pairs of tree nodes are ruled out before their points.
    """
    order = np.lexsort((points[:, 1], points[:, 0], n))
    points, size = points[order], n[order].astype(np.int64)
    starts = np.arange(0, len(n), FANOUT)
    high = np.maximum.reduceat(points, starts, axis=0)
    least = np.minimum.reduceat(size, starts)
    most = np.maximum.reduceat(size, starts)
    found = []
    for a in range(len(starts)):
        bound = np.minimum(high[a], high[a:]).sum(axis=1, dtype=np.int64)
        # The overlap of sets of at least these sizes, and no more than the smaller set has.
        near = (np.minimum(bound, np.minimum(most[a], most[a:])) * (100 + percent)
                >= percent * (least[a] + least[a:]))
        near &= 100 * most[a] >= percent * least[a:]
        x = np.arange(starts[a], min(starts[a] + FANOUT, len(n)))
        for b in (a + np.flatnonzero(near)).tolist():
            y = np.arange(starts[b], min(starts[b] + FANOUT, len(n)))
            bound = np.minimum(points[x][:, None], points[y][None]).sum(axis=2, dtype=np.int64)
            keep = _reach(size[x][:, None], size[y][None], bound, percent)
            if a == b:
                keep &= x[:, None] < y[None]
            i, j = np.nonzero(keep)
            found.append((x[i], y[j], bound[i, j]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    i, j, bound = (np.concatenate(c) for c in zip(*found, strict=True))
    return order[i], order[j], bound


def _unit_pairs(spanning: bool, percent: int):
    """Pairs of one unit's nodes that may link. ``spanning``: one partner for each node, and
    each node that may link with any, paired with itself; else all whose components differ."""
    schema = arrow_schema("u long, v long")

    def pairs(node: np.ndarray, n: np.ndarray, points: np.ndarray, component: np.ndarray) -> tuple[np.ndarray, ...]:
        if len(node) < 2:
            return node[:0], node[:0]
        i, j, bound = tree_pairs(points, n, percent)
        if spanning:
            # The later point's best earlier partner.
            closeness = bound / (n[i] + n[j])
            order = np.lexsort((-closeness, j))
            order = order[np.concatenate([[True], j[order][1:] != j[order][:-1]])] if len(order) else order
            may = np.unique(np.concatenate([i, j]))
            i, j = np.concatenate([i[order], may]), np.concatenate([j[order], may])
        else:
            apart = component[i] != component[j]
            i, j = i[apart], j[apart]
        return np.minimum(node[i], node[j]), np.maximum(node[i], node[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            unit, node, n, component = (table.column(c).to_numpy() for c in ("unit", "node", "n", "component"))
            points = table.column("point")
            cuts = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]])).tolist()
            found = []
            for a, b in zip(cuts, [*cuts[1:], len(unit)], strict=True):
                # A node may be in both leaves of a unit.
                keep = a + np.unique(node[a:b], return_index=True)[1]
                if spanning or (component[keep] != component[keep[0]]).any():
                    found.append(pairs(node[keep], n[keep], _unpacked(points.take(pa.array(keep)).to_pylist()),
                                       component[keep]))
            if not found:
                return
            u, v = (np.concatenate(c) for c in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            unit = table.column("unit").to_numpy()
            ends = np.flatnonzero(unit[1:] != unit[:-1]) + 1
            end = int(ends[-1]) if len(ends) else 0
            if end:
                yield from done(table.slice(0, end))
            rest = table.slice(end).combine_chunks()
        if rest is not None and rest.num_rows:
            yield from done(rest)
    return run


def _linked(percent: int):
    schema = arrow_schema("u long, v long, linked boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b in zip(batch.column("a"), batch.column("b"), strict=True):
                a, b = (np.frombuffer(x.as_py(), np.uint64) for x in (a, b))
                both = len(np.intersect1d(a, b, assume_unique=True))
                out.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), batch.column("v"), pa.array(out, pa.bool_())], schema=schema)
    return run


def jaccard_components(docs: DataFrame, percent: int = PERCENT, with_key: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (``doc_id``, ``text``).
    ``with_key`` adds ``r1, r2``, the hashes of the text, and ``component``, a number of the
    component whatever the ids; null without words."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    texts = keyed(docs)
    rows = materialise(texts.mapInArrow(_profiles, _PROFILE), "jaccard-rows")
    frequent = frequent_shingles(texts, rows.count())
    blocks = materialise(
        texts.select("r1", "text").mapInArrow(_postings(frequent, percent, 2 * parts), _POSTINGS)
             .repartition(parts, "bucket").mapInArrow(_blocks, _BLOCKS)
             .dropDuplicates(["block", "leaf"]), "jaccard-blocks")
    members = blocks.mapInArrow(_members, "block long, leaf int, leaves int, node long")
    points = rows.select("node", F.col("n_shingles").cast("int").alias("n"), "point").dropDuplicates(["node"])

    def proposed(units: DataFrame, spanning: bool) -> DataFrame:
        """``units``: ``unit, node, component``."""
        return (units.join(points, "node").select("unit", "node", "component", "n", "point")
                     .repartition(parts, "unit").sortWithinPartitions("unit")
                     .mapInArrow(_unit_pairs(spanning, percent), "u long, v long").distinct())

    # First round: each leaf of a block together with the block's first leaf.
    leaf = F.col("leaf")
    first = (members.where(leaf > 0).unionByName(
                members.where((leaf == 0) & (F.col("leaves") == 1)))
             .unionByName(members.where((leaf == 0) & (F.col("leaves") > 1))
                          .withColumn("leaf", F.explode(F.sequence(F.lit(1), F.col("leaves") - 1))))
             .select(F.xxhash64("block", "leaf").alias("unit"), "node", F.col("node").alias("component")))
    proposals = materialise(proposed(first, True), "jaccard-proposals")
    # Sets are needed of nodes that may link; in large blocks that is not known of all pairs yet.
    may_link = (proposals.where("u = v").select(F.col("u").alias("node"))
                         .unionByName(members.where(F.col("leaves") > 1).select("node")).distinct())
    wanted = materialise(rows.join(may_link, "node").groupBy("node").agg(F.min(F.struct("r1", "r2")).alias("t"))
                             .select("node", "t.r1", "t.r2"), "jaccard-wanted")
    some = texts.select("r1", "r2", "text")
    if wanted.count() <= BROADCAST_TEXTS:
        some = some.join(F.broadcast(wanted), ["r1", "r2"]).dropDuplicates(["node"])
    else:
        some = some.dropDuplicates(["r1", "r2"]).join(wanted.hint("shuffle_hash"), ["r1", "r2"])
    sets = materialise(some.select("node", "text").mapInArrow(_sets, _SETS), "jaccard-sets")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
        right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
        return materialise(pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b")
                                .mapInArrow(_linked(percent), "u long, v long, linked boolean"), name)

    tried = verified(proposals.where("u < v"), "jaccard-first")
    found = tried.where("linked").select("u", "v")
    groups = materialise(connected_components(found, "jaccard-groups"), "jaccard-groups")

    # Second round: units that still hold more than one component.
    placed = (members.join(groups, "node", "left")
                     .withColumn("component", F.coalesce("component", "node")))
    placed = materialise(placed, "jaccard-placed")
    open_blocks = (placed.groupBy("block").agg(F.min("component").alias("x"), F.max("component").alias("y"))
                         .where("x <> y").select("block"))
    left_over = placed.join(open_blocks, "block", "left_semi")
    i, j = F.least("leaf", "other"), F.greatest("leaf", "other")
    tiles = (left_over.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("leaves") - 1)))
                      .select(F.xxhash64("block", i, j).alias("unit"), "node", "component"))
    open_units = (tiles.groupBy("unit").agg(F.min("component").alias("x"), F.max("component").alias("y"))
                       .where("x <> y").select("unit"))
    pairs = (proposed(tiles.join(open_units, "unit", "left_semi"), False)
             .join(tried.select("u", "v"), ["u", "v"], "left_anti"))
    more = verified(pairs, "jaccard-second").where("linked").select("u", "v")
    final = materialise(connected_components(groups.select(F.col("node").alias("u"), F.col("component").alias("v"))
                                             .unionByName(more), "jaccard-final"), "jaccard-final")

    named = rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    labelled = (named.join(final, "node", "left").withColumn("component", F.coalesce("component", "node")))
    ids = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    return (rows.join(labelled.join(ids, "component").select("node", "component", "component_id"), "node", "left")
                .select("doc_id", "n_shingles",
                        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
                        .alias("component_id"),
                        *(["r1", "r2", F.when(F.col("n_shingles") > 0, F.col("component")).alias("component")]
                          if with_key else [])))
