"""Operator 3, embedding near-dedup: sorted projection passes.

Each pass orders the vectors by a bit string, on which side of random planes
they lie, and compares every vector with the ``window`` next ones in that order.
A plane goes through the median of what it splits: the first bits split a sample
of the table as a tree, each part at its own median, and the others go through
the medians of the tree's leaves. So bits halve the table also where vectors have
a common direction or crowd in a loose cluster. Pairs with a cosine of at least
``threshold`` are verified in double precision and their links united over all
passes.

The number of passes is measured, not assumed: ``planned_passes`` counts how often
sampled vectors and partners at the threshold agree in each of the log2(n / window)
bits that bring them into one window, and makes so many passes that a pair is missed
with a probability of 1 - ``recall`` only. Then all true links of ``PROBES`` vectors,
found by comparing them with the whole table, are looked up in the components. While
too few of them are there, the passes are doubled. From the number on at which passes
cost more than comparing all pairs, all pairs are compared, in tiles.

Equal vectors are one vector with a weight. A window is bounded, so inside a
large group of near copies a vector meets only some of the others. The links
are therefore counted in a second step over each component found: its vectors
are compared in tiles of ``TILE``, which gives exact numbers of links, as sums
per vector and never as pairs, for a component of any size.

Defined cases: null vectors, zero vectors and vectors with null or non-finite
components link with nothing; so do vectors of different dimensions; repeated
ids are rows of their own with their vector's links, their other rows included;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import arrow_schema, connected_components, materialise, shuffle_partitions

THRESHOLD = 0.95
WINDOW = 32
RECALL = 0.995
BITS = 60
TILE = 1024
SAMPLE = 4096    # vectors that place the planes
LEAF = 16        # sampled vectors in a leaf of the tree
TRIALS = 24      # trees by which agreement is measured
PROBES = 1024    # vectors whose links are all found, to measure the recall
WIDE_TILE = 4096  # of vectors, if all pairs are compared


def n_passes(n: int, threshold: float, window: int, recall: float) -> int:
    p = 1 - math.acos(threshold) / math.pi
    hit = p ** max(1.0, math.log2(max(2.0, n / window)))
    return max(4, math.ceil(math.log(1 - recall) / math.log(1 - hit)))


def _planes(t: int, size: int) -> np.ndarray:
    return np.random.default_rng([t, size]).standard_normal((size // 8, BITS))


class Tree:
    """Where the planes of a pass cut: at the medians of a sample's parts."""

    def __init__(self, sample: np.ndarray, planes: np.ndarray):
        self.planes = planes
        self.depth = min(BITS, max(0, int(math.log2(max(1, len(sample)) / LEAF)))) if len(sample) >= LEAF else 0
        at, part = sample @ planes, np.zeros(len(sample), np.int64)
        self.cuts: list[np.ndarray] = []
        for level in range(self.depth):
            order = np.lexsort((at[:, level], part))
            bounds = np.searchsorted(part[order], np.arange((1 << level) + 1))
            middle = np.minimum((bounds[:-1] + bounds[1:]) // 2, len(order) - 1)
            low = np.maximum(middle - 1, 0)
            self.cuts.append((at[order[low], level] + at[order[middle], level]) / 2)
            part = 2 * part + (at[:, level] > self.cuts[level][part])
        self.leaves = np.zeros((1 << self.depth, BITS - self.depth))
        for leaf in np.unique(part).tolist():
            self.leaves[leaf] = np.median(at[part == leaf, self.depth:], axis=0)

    def cut_of(self, at: np.ndarray) -> np.ndarray:
        """The place of every plane on each vector's way; ``at``: its projections."""
        out, part = np.empty_like(at), np.zeros(len(at), np.int64)
        for level in range(self.depth):
            out[:, level] = self.cuts[level][part]
            part = 2 * part + (at[:, level] > out[:, level])
        out[:, self.depth:] = self.leaves[part]
        return out

    def bits(self, x: np.ndarray) -> np.ndarray:
        at = x @ self.planes
        return at > self.cut_of(at)


def planned_passes(samples: dict[int, np.ndarray], n: int, threshold: float, window: int, recall: float) -> int:
    """Passes that miss a pair at the threshold with a probability of 1 - ``recall``, by the
    bits in which sampled vectors and such partners agree. Vectors with links in the sample
    don't count: others lead to them."""
    bits, hits = min(BITS, max(1, math.ceil(math.log2(max(2.0, n / window))))), []
    for size, sample in samples.items():
        lonely = ((sample @ sample.T) >= threshold).sum(axis=1) <= 1
        x = sample[lonely][:PROBES]
        if not len(x) or size == 8:
            continue
        rng = np.random.default_rng(size)
        off = rng.standard_normal(x.shape)
        off -= np.einsum("ij,ij->i", off, x)[:, None] * x
        off /= np.linalg.norm(off, axis=1)[:, None]
        y = threshold * x + math.sqrt(1 - threshold * threshold) * off
        agree = np.zeros((len(x), bits))
        for t in range(TRIALS):
            tree = Tree(sample, _planes(t, size))
            at = x @ tree.planes
            cut = tree.cut_of(at)
            agree += ((at > cut) == (y @ tree.planes > cut))[:, :bits]
        hits.append(np.prod(np.maximum(agree, 0.5) / TRIALS, axis=1))
    least = n_passes(n, threshold, window, recall)
    if not hits:
        return least
    miss = 1 - np.concatenate(hits)
    most = all_pairs_from(n, window)
    while least < most and (miss ** least).mean() > 1 - recall:
        least += 1
    return least


def all_pairs_from(n: int, window: int) -> int:
    """The number of passes that cost as much as comparing all pairs."""
    return max(64, math.ceil(n / (2 * (BITS + window))))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors as packed doubles; null if the vector can't link."""
    schema = pa.schema([("vec_id", pa.int64()), ("unit", pa.binary())])
    for batch in batches:
        out = []
        for x in batch.column("embedding"):
            v = None if not x.is_valid else np.array(
                [np.nan if c is None else c for c in x.as_py()], np.float64)
            norm = 0.0
            if v is not None and len(v) and np.isfinite(v).all():
                v = v / np.abs(v).max() if np.abs(v).max() > 0 else v  # no overflow in squares
                norm = math.sqrt(float(v @ v))
            out.append((v / norm + 0.0).tobytes() if norm > 0 else None)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], schema=schema)


def _keys(passes: range, samples: dict[int, np.ndarray]):
    """One row per vector and pass: its sides of the pass's planes, first bit highest."""
    schema = arrow_schema("pass int, key long, node long, unit binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[tuple[int, int], Tree] = {}
        for batch in batches:
            node, units = batch.column("node").to_numpy(), batch.column("unit")
            sizes = np.array([len(u) for u in units.to_pylist()])
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                some = units.take(pa.array(at))
                x = np.frombuffer(b"".join(some.to_pylist()), np.float64).reshape(len(at), size // 8)
                for t in passes:
                    if (tree := trees.get((t, size))) is None:
                        tree = trees[t, size] = Tree(samples.get(size, np.zeros((0, size // 8))), _planes(t, size))
                    bits = tree.bits(x).astype(np.int64)
                    key = bits @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), t, np.int32)), pa.array(key), pa.array(node[at]), some],
                        schema=schema)
    return run


class _Union:
    """Keeps, of the links one task finds, those that join two groups."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.up.setdefault(x, x)) != x:
            self.up[x] = x = self.up[y]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


_FOUND = "u long, v long, pass int, edge int, place int, node long, unit binary"


def _window_links(threshold: float, window: int):
    """Links within a sorted partition; its first and last ``window`` rows of a pass also go
    out, to be compared across the partition's edges."""
    schema = arrow_schema(_FOUND)

    def links(nodes: np.ndarray, units: list[bytes], new_from: int, union: _Union) -> list[tuple[int, int]]:
        out = []
        sizes = np.array([len(u) for u in units])
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            x = np.frombuffer(b"".join([units[i] for i in at.tolist()]), np.float64).reshape(len(at), size // 8)
            for d in range(1, min(window, len(at) - 1) + 1):
                near = np.einsum("ij,ij->i", x[:-d], x[d:]) >= threshold
                for i in np.flatnonzero(near).tolist():
                    a, b = int(nodes[at[i]]), int(nodes[at[i + d]])
                    if at[i + d] >= new_from and union.join(a, b):
                        out.append((a, b))
        return out

    def rows(found: list[tuple[int, int]]) -> pa.RecordBatch:
        n = len(found)
        u, v = (np.array(c, np.int64) for c in (zip(*found, strict=True) if found else ((), ())))
        none = [pa.nulls(n, t) for t in schema.types[2:]]
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), *none], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId()
        union = _Union()
        at_pass, nodes, units, head, seen = None, np.zeros(0, np.int64), [], [], 0

        def edge(which: int, rows_: list[tuple[int, bytes]]) -> pa.RecordBatch:
            n = len(rows_)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.full(n, at_pass, np.int32)),
                 pa.array(np.full(n, here + which, np.int32)),
                 pa.array(np.arange(n, dtype=np.int32) + (0 if which else window)),
                 pa.array([r[0] for r in rows_], pa.int64()), pa.array([r[1] for r in rows_], pa.binary())],
                schema=schema)

        def finish() -> Iterator[pa.RecordBatch]:
            # Edge number e lies before partition e; rows after it come later in order.
            yield edge(0, head)
            yield edge(1, list(zip(nodes.tolist(), units, strict=True))[-window:])

        for batch in batches:
            passes = batch.column("pass").to_numpy()
            cuts = np.flatnonzero(np.diff(passes)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(passes)], strict=True):
                if a == b:
                    continue
                if at_pass != passes[a]:
                    if at_pass is not None:
                        yield from finish()
                    at_pass, nodes, units, head, seen = int(passes[a]), np.zeros(0, np.int64), [], [], 0
                more = batch.slice(a, b - a)
                old = len(nodes)
                nodes = np.concatenate([nodes, more.column("node").to_numpy()])
                units = units + more.column("unit").to_pylist()
                if len(head) < window:
                    head = list(zip(nodes[old:].tolist(), units[old:], strict=True))[:window] if not old else \
                        (head + list(zip(nodes[old:].tolist(), units[old:], strict=True)))[:window]
                yield rows(links(nodes, units, old, union))
                nodes, units = nodes[-window:], units[-window:]
        if at_pass is not None:
            yield from finish()

    def across(key, table):
        table = table.sort_by("place")
        nodes = table.column("node").to_numpy()
        return pa.Table.from_batches([rows(links(nodes, table.column("unit").to_pylist(), 0, _Union()))],
                                     schema=schema).select(["u", "v"])

    return run, across


def _tile_links(threshold: float):
    """Links between two tiles of the table that join groups."""

    def run(key, table):
        side, node, units = table.column("side").to_numpy(), table.column("node").to_numpy(), table.column("unit").to_pylist()
        sizes, union, out = np.array([len(u) for u in units]), _Union(), []
        for size in np.unique(sizes).tolist():
            left, right = (np.flatnonzero((sizes == size) & (side == s)) for s in (0, 1))
            x, y = (np.frombuffer(b"".join([units[i] for i in at.tolist()]), np.float64).reshape(len(at), size // 8)
                    for at in (left, right))
            for low in range(0, len(left), TILE):
                i, j = np.nonzero((x[low:low + TILE] @ y.T) >= threshold)
                out += [(a, b) for a, b in zip(node[left[i + low]].tolist(), node[right[j]].tolist(), strict=True)
                        if a != b and union.join(a, b)]
        u, v = (np.array(c, np.int64) for c in (zip(*out, strict=True) if out else ((), ())))
        return pa.table([pa.array(u), pa.array(v)], schema=arrow_schema("u long, v long"))
    return run


def _probed(probes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], threshold: float):
    """True links of the probes (``node``, component, vectors by size), and those of one component."""
    schema = arrow_schema("links long, there long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = there = 0
        for batch in batches:
            node, component = batch.column("node").to_numpy(), batch.column("component").to_numpy()
            units = batch.column("unit").to_pylist()
            sizes = np.array([len(u) for u in units])
            for size, (names, groups, x) in probes.items():
                at = np.flatnonzero(sizes == size)
                y = np.frombuffer(b"".join([units[i] for i in at.tolist()]), np.float64).reshape(len(at), size // 8)
                near = ((y @ x.T) >= threshold) & (node[at][:, None] != names[None, :])
                links += int(near.sum())
                there += int((near & (component[at][:, None] == groups[None, :])).sum())
        yield pa.RecordBatch.from_arrays([pa.array([links], pa.int64()), pa.array([there], pa.int64())], schema=schema)
    return run


def measured_recall(classes: DataFrame, groups: DataFrame, threshold: float) -> float:
    """Of all links of ``PROBES`` vectors, the part whose ends are in one component."""
    placed = (classes.select("node", "unit", "r2").join(groups, "node", "left")
                     .withColumn("component", F.coalesce("component", "node")))
    by_size: dict[int, list] = {}
    for r in placed.orderBy("r2", "node").limit(PROBES).collect():
        by_size.setdefault(len(r["unit"]), []).append(r)
    probes = {size: (np.array([r["node"] for r in rs]), np.array([r["component"] for r in rs]),
                     np.array([np.frombuffer(r["unit"], np.float64) for r in rs])) for size, rs in by_size.items()}
    links, there = (placed.select("node", "component", "unit").mapInArrow(_probed(probes, threshold), "links long, there long")
                          .agg(F.sum("links"), F.sum("there")).first())
    return there / links if links else 1.0


_COUNTS = "node long, n long"


def _tile_counts(threshold: float):
    """Links between two tiles of a component, summed per vector."""

    def run(key, table):
        side = table.column("side").to_numpy()
        node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        units = table.column("unit").to_pylist()
        sizes = np.array([len(u) for u in units])
        total = np.zeros(len(node), np.int64)
        for size in np.unique(sizes).tolist():
            left, right = (np.flatnonzero((sizes == size) & (side == s)) for s in (0, 1))
            x, y = (np.frombuffer(b"".join([units[i] for i in at.tolist()]), np.float64).reshape(len(at), size // 8)
                    for at in (left, right))
            if len(left) and len(right):
                near = (x @ y.T) >= threshold
                near &= node[left][:, None] != node[right][None, :]
                total[left] += near @ weight[right]
        keep = side == 0
        return pa.table([pa.array(node[keep]), pa.array(total[keep])], schema=arrow_schema(_COUNTS))
    return run


def embedding_dedup(vectors: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW,
                    recall: float = RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors`` (``vec_id``, ``embedding``)."""
    spark = vectors.sparkSession
    rows = materialise(
        vectors.select("vec_id", "embedding").mapInArrow(_units, "vec_id long, unit binary")
               .withColumn("r1", F.xxhash64("unit")).withColumn("r2", F.xxhash64(F.lit(7), "unit")), "units")
    # Equal vectors are one node, named by a hash of the vector.
    classes = materialise(
        rows.where("unit IS NOT NULL").groupBy("r1", "r2")
            .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"), F.first("unit").alias("unit"))
            .withColumn("node", F.col("r1")), "vectors")
    n = classes.count()
    run, across = _window_links(threshold, window)
    by_size: dict[int, list[np.ndarray]] = {}
    for r in classes.select("unit", "r2", "node").orderBy("r2", "node").limit(SAMPLE).collect():
        by_size.setdefault(len(r["unit"]), []).append(np.frombuffer(r["unit"], np.float64))
    samples = {size: np.array(x) for size, x in by_size.items()}

    def window_edges(passes: range) -> DataFrame:
        found = materialise(
            classes.select("node", "unit")
                   .mapInArrow(_keys(passes, samples), "pass int, key long, node long, unit binary")
                   .repartitionByRange(shuffle_partitions(spark), "pass", "key", "node")
                   .sortWithinPartitions("pass", "key", "node")
                   .mapInArrow(run, _FOUND), "links")
        return (found.where("u IS NOT NULL").select("u", "v")
                     .unionByName(found.where("edge IS NOT NULL").groupBy("pass", "edge")
                                       .applyInArrow(across, "u long, v long")))

    def all_edges() -> DataFrame:
        tiles = max(1, math.ceil(n / WIDE_TILE))
        tiled = classes.select("node", "unit", F.pmod(F.xxhash64("node", F.lit(5)), F.lit(tiles)).cast("int").alias("t"))
        left = tiled.select("node", "unit", F.col("t").alias("a"), F.explode(F.sequence("t", F.lit(tiles - 1))).alias("b"),
                            F.lit(0).alias("side"))
        right = tiled.select("node", "unit", F.explode(F.sequence(F.lit(0), "t")).alias("a"), F.col("t").alias("b"),
                             F.lit(1).alias("side"))
        return (left.unionByName(right).repartition(shuffle_partitions(spark), "a", "b").groupBy("a", "b")
                    .applyInArrow(_tile_links(threshold), "u long, v long"))

    done, passes = 0, planned_passes(samples, n, threshold, window, recall)
    links = spark.createDataFrame([], "u long, v long")
    while True:
        exact = passes >= all_pairs_from(n, window)
        links = links.unionByName(all_edges() if exact else window_edges(range(done, passes)))
        groups = materialise(connected_components(links, "vector-components"), "vector-groups")
        if exact or measured_recall(classes, groups, threshold) >= recall:
            break
        # The components stand for the links found.
        links = groups.select(F.col("node").alias("u"), F.col("component").alias("v"))
        done, passes = passes, 2 * passes
    members = (groups.join(classes, "node")
                     .withColumn("tile", F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 30)).cast("int")))
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    dealt = members.join(sizes, "component").withColumn("tile", F.pmod("tile", "tiles"))
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    cols = ["component", "node", "weight", "unit"]
    left = dealt.select(*cols, F.col("tile").alias("a"), every, F.lit(0).alias("side")).withColumnRenamed("other", "b")
    right = dealt.select(*cols, F.col("tile").alias("b"), every, F.lit(1).alias("side")).withColumnRenamed("other", "a")
    # Tile pairs are dealt by all three: a component's tiles go to many tasks.
    counts = (left.unionByName(right).repartition(shuffle_partitions(spark), "component", "a", "b")
                  .groupBy("component", "a", "b")
                  .applyInArrow(_tile_counts(threshold), _COUNTS)
                  .groupBy("node").agg(F.sum("n").alias("n")))
    least = (groups.join(classes.select("node", "least"), "node").groupBy("component")
                   .agg(F.min("least").alias("component_id")))
    linked = groups.join(least, "component").join(counts, "node").select("node", "component_id", "n")
    per_class = (classes.join(linked, "node", "left")
                        .select("r1", "r2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                                F.coalesce("component_id", "least").alias("component_id")))
    return (rows.join(per_class, ["r1", "r2"], "left")
                .select("vec_id", F.coalesce(F.when(F.col("unit").isNotNull(), F.col("n_links")), F.lit(0)).cast("long")
                        .alias("n_links"),
                        F.when(F.col("unit").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
                        .alias("component_id"))
                .withColumn("kept", F.col("vec_id") == F.col("component_id")))
