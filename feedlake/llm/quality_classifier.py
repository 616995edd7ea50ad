"""Operator 11, quality classifier: Naive Bayes support vectors.

A text is the set of its n-grams: of words, of characters (bytes, ASCII letters
lower-cased), and of word forms (kinds of the first and last character, and
whether the word repeats the one before). Each n-gram is an indicator in one of
``2 ** BITS`` hashed places. Indicators are scaled by the logarithm of the ratio
of their shares in the two classes (add-one counts), a text's vector is brought
to length one, and a linear model with hinge loss is fitted to the vectors by
dual coordinate descent: one dual variable a time is set to its best value, and
the weights follow. Margins become scores by a logistic curve, fitted to
documents kept out of the descent.

The model is fitted in one task, on at most about ``sample_rows`` labelled
documents of each class, whatever the size of the table: label ids are thinned
by a threshold on their hash. All documents are then scored where they are,
with no shuffle.

Labels are learned only from rows outside the held-out fold. Inputs of a score
are the characters of the text and nothing else.

Defined cases: a null text is empty and gets the score of no n-grams; a null id
is held out and never learned from; of several labels of one id the majority
counts, and none if there is no majority; labels other than 0 and 1 are ignored; of
rows that share an id the one whose text hashes lowest is learned from, and all are
scored; without labels of both classes the score is the share of label 1 among the
labels, (n1 + 1) / (n + 2); empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import arrow_schema, materialise, text_or_empty

BITS = 18
SAMPLE_ROWS = 8192     # labelled documents of a class that the model is fitted to, at most about
FOLDS = 5              # one in five documents is held out
THRESHOLD = 0.3        # scores from here on are predicted as label 1
COST = 1.0             # bound on a dual variable, shared out so that both classes weigh the same
EPOCHS = 20
SLICE_BYTES = 1 << 20  # of a text looked at together
WORD_ORDERS, BYTE_ORDERS, FORM_ORDERS = 2, 3, 3

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3  # odd, so it has an inverse modulo 2 ** 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
# Kinds of bytes: small letter (and all beyond ASCII), capital, digit, others as they are.
_KIND = np.arange(256, dtype=np.uint64)
_KIND[97:123] = _KIND[128:] = 97
_KIND[65:91] = 65
_KIND[48:58] = 48


class _Powers:
    """Powers of the hash base and of its inverse, as many as were needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            def row(base: int) -> np.ndarray:
                return np.multiply.accumulate(np.r_[np.uint64(1), np.full(2 * n, base, np.uint64)])
            self.up, self.down = row(_BASE), row(pow(_BASE, -1, 1 << 64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _grams(codes: np.ndarray, orders: int, family: int, bits: int) -> Iterator[np.ndarray]:
    """Places of the n-grams of a sequence, of 1 to ``orders`` codes."""
    h = codes
    for n in range(1, orders + 1):
        if len(codes) < n:
            return
        if n > 1:
            h = h[:-1] * np.uint64(1000003) + codes[n - 1:]
        x = (h + np.uint64(16 * family + n)) * _MULTIPLIER
        x ^= x >> np.uint64(32)
        yield ((x * _MULTIPLIER) >> np.uint64(64 - bits)).astype(np.int64)


def _mark(raw: np.ndarray, seen: np.ndarray, bits: int, follows: bool) -> int:
    """Mark the n-grams of a slice of whole words. ``follows``: its first word is known only as a
    context. Returns where its last few words begin, the context of the next slice."""
    lower = _LOWER[raw]
    for places in _grams(lower.astype(np.uint64) + np.uint64(1), BYTE_ORDERS, 1, bits):
        seen[places] = True
    edges = np.flatnonzero(np.diff(_SPACE[raw], prepend=True, append=True))
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return 0
    up, down = _POWERS.get(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    words = (total[end] - total[start]) * down[start] * _MULTIPLIER
    for places in _grams(words ^ (words >> np.uint64(29)), WORD_ORDERS, 2, bits):
        seen[places] = True
    again = np.r_[False, words[1:] == words[:-1]].astype(np.uint64)
    forms = (_KIND[raw[start]] * np.uint64(256) + _KIND[raw[end - 1]]) * np.uint64(2) + again
    for places in _grams(forms[1:] if follows else forms, FORM_ORDERS, 3, bits):
        seen[places] = True
    back = 1 + max(WORD_ORDERS, BYTE_ORDERS, FORM_ORDERS)
    return int(start[-back]) if len(start) > back else 0


def ngrams(text: str, bits: int = BITS, slice_bytes: int = SLICE_BYTES) -> np.ndarray:
    """Sorted places of all n-grams of a text. A long text is looked at in slices of whole words
    that overlap; marking an n-gram again changes nothing."""
    raw = np.frombuffer(text.encode(), np.uint8)
    seen = np.zeros(1 << bits, bool)
    at, follows = 0, False
    while at < len(raw):
        end = at + slice_bytes
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        back = _mark(raw[at:end], seen, bits, follows)
        if end >= len(raw):
            break
        # Without some progress (a word beyond the size of a slice) the slice grows.
        if back:
            at, follows = at + back, True
        else:
            slice_bytes *= 2
    return np.flatnonzero(seen)


def log_ratios(rows: list[np.ndarray], labels: np.ndarray, places: int) -> np.ndarray:
    """Logarithm of the ratio of each n-gram's shares in the texts of label 1 and of label 0."""
    shares = []
    for label in (1, 0):
        some = [r for r, y in zip(rows, labels, strict=True) if y == label]
        counts = 1.0 + (np.bincount(np.concatenate(some), minlength=places) if some else np.zeros(places))
        shares.append(counts / counts.sum())
    return np.log(shares[0] / shares[1])


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, bounds: np.ndarray, places: int,
                 epochs: int = EPOCHS, tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 + the sum of bound * hinge loss: each step sets one
    dual variable to its best value in [0, bound]. The bias is the weight of a constant 1."""
    weights, bias = np.zeros(places), 0.0
    dual = np.zeros(len(rows))
    squares = [float(v @ v) + 1.0 for v in values]
    order = np.random.RandomState(0)
    for _ in range(epochs):
        most = 0.0
        for i in order.permutation(len(rows)):
            y = signs[i]
            slope = y * (weights[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(dual[i] - slope / squares[i], 0.0), bounds[i])
            step = new - dual[i]
            if step:
                weights[rows[i]] += step * y * values[i]
                bias += step * y
                dual[i] = new
                most = max(most, abs(step) / bounds[i])
        if most < tolerance:
            break
    return weights, bias


def logistic(margins: np.ndarray, labels: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and offset of the logistic curve of the labels over margins, by Newton's method with
    smoothed targets."""
    ones, zeros = int((labels == 1).sum()), int((labels == 0).sum())
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 0.0, math.log((ones + 1) / (zeros + 1))

    def loss(a: float, b: float) -> float:
        z = a * margins + b
        return float((np.logaddexp(0, z) - target * z).sum())

    now = loss(a, b)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        d, h = p - target, np.maximum(p * (1 - p), 1e-12)
        g = np.array([(d * margins).sum(), d.sum()])
        cross = (h * margins).sum()
        step = np.linalg.solve(np.array([[(h * margins ** 2).sum() + 1e-9, cross], [cross, h.sum() + 1e-9]]), g)
        size = 1.0
        while size > 1e-8 and loss(a - size * step[0], b - size * step[1]) > now:
            size /= 2
        a, b = a - size * step[0], b - size * step[1]
        before, now = now, loss(a, b)
        if before - now < 1e-9:
            break
    return float(a), float(b)


class Model:
    """``ratios`` and ``weights`` by place; margins lie on a logistic curve."""

    def __init__(self, ratios: np.ndarray, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.ratios, self.weights, self.bias, self.slope, self.offset = ratios, weights, bias, slope, offset
        self.products = ratios * weights

    @staticmethod
    def scaled(row: np.ndarray, ratios: np.ndarray) -> np.ndarray:
        values = ratios[row]
        return values / math.sqrt(float(values @ values) + 1e-12)

    def margin(self, row: np.ndarray) -> float:
        values = self.ratios[row]
        return float(self.products[row].sum()) / math.sqrt(float(values @ values) + 1e-12) + self.bias

    def score(self, row: np.ndarray) -> float:
        z = self.slope * self.margin(row) + self.offset
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))

    def to_bytes(self) -> bytes:
        return b"".join([np.array([self.bias, self.slope, self.offset]).tobytes(), self.ratios.tobytes(),
                         self.weights.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> Model:
        x = np.frombuffer(data, np.float64)
        half = (len(x) - 3) // 2
        return cls(x[3:3 + half], x[3 + half:], *(float(v) for v in x[:3]))


def fit(rows: list[np.ndarray], labels: np.ndarray, places: int, cost: float = COST) -> Model:
    """A model of the rows' labels. Every fifth row of a class is left to the logistic curve."""
    ones, total = int((labels == 1).sum()), len(labels)
    if min(ones, total - ones) < 2:
        return Model(np.zeros(places), np.zeros(places), 0.0, 0.0, math.log((ones + 1) / (total - ones + 1)))
    number = np.empty(total, np.int64)
    for label in (0, 1):
        own = labels == label
        number[own] = np.arange(own.sum())
    aside = number % 5 == 1
    used = [r for r, x in zip(rows, aside, strict=True) if not x]
    known = labels[~aside]
    ratios = log_ratios(used, known, places)
    values = [Model.scaled(r, ratios) for r in used]
    # Both classes weigh the same in the loss.
    weight = np.where(known == 1, (known == 0).mean(), (known == 1).mean()) * 2 * cost
    weights, bias = dual_descent(used, values, np.where(known == 1, 1.0, -1.0), weight, places)
    model = Model(ratios, weights, bias, 1.0, 0.0)
    margins = np.array([model.margin(r) for r, x in zip(rows, aside, strict=True) if x])
    model.slope, model.offset = logistic(margins, labels[aside])
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the checksum of the id as text is divisible by the number of folds; a null id counts as ''."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(name.cast("binary")), F.lit(FOLDS)) == 0


def training_sample(docs: DataFrame, labels: DataFrame, label: str, sample_rows: int) -> DataFrame:
    """``y, text`` of at most about ``sample_rows`` labelled documents of each class, in a fixed order."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    votes = known.groupBy("doc_id").agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(-1)).alias("vote"))
    votes = materialise(votes.where("vote <> 0").select("doc_id", (F.col("vote") > 0).cast("int").alias("y")),
                        "quality-labels")
    totals = {r["y"]: r["n"] for r in votes.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Ids are taken by hash. A share of 0.9 of the bound is exceeded by chance in no real case.
    share = {y: min(1.0, 0.9 * sample_rows / n) if n > sample_rows else 1.0 for y, n in totals.items()}
    cut = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30))
    limit = F.when(F.col("y") == 1, F.lit(share.get(1, 0.0))).otherwise(F.lit(share.get(0, 0.0))) * float(1 << 30)
    chosen = materialise(votes.where(cut < limit), "quality-sample-ids")
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    return (rows.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x"))
                .select("y", "doc_id", "x.text"))


def _fit(bits: int, cost: float):
    schema = arrow_schema("model binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels: list[int] = []
        rows: list[np.ndarray] = []
        for batch in batches:
            labels += batch.column("y").to_pylist()
            rows += [np.frombuffer(x.as_py(), np.int32) for x in batch.column("grams")]
        model = fit(rows, np.array(labels, np.int64), 1 << bits, cost)
        yield pa.RecordBatch.from_arrays([pa.array([model.to_bytes()], pa.binary())], schema=schema)
    return run


def _features(bits: int):
    schema = arrow_schema("doc_id long, y int, grams binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [ngrams(x.as_py(), bits).astype(np.int32).tobytes() for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("y"), pa.array(grams, pa.binary())], schema=schema)
    return run


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS,
                bits: int = BITS, cost: float = COST) -> bytes:
    """The fitted model, of a size set by ``bits`` alone."""
    sample = materialise(
        training_sample(docs, labels, label, sample_rows).select(F.col("doc_id").cast("long").alias("doc_id"), "y", "text")
        .mapInArrow(_features(bits), "doc_id long, y int, grams binary"), "quality-sample")
    # The bounded sample goes to one task, in the order of its ids: a rerun gives the same model.
    models = sample.repartition(1).sortWithinPartitions("doc_id").mapInArrow(_fit(bits, cost), "model binary")
    row = materialise(models, "quality-model").first()
    return bytes(row["model"]) if row else fit([], np.empty(0, np.int64), 1 << bits).to_bytes()


def _score(model, bits: int, threshold: float):
    schema = arrow_schema("doc_id long, held_out boolean, score double, predicted int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.from_bytes(model.value)
        for batch in batches:
            scores = np.array([own.score(ngrams(x.as_py(), bits)) for x in batch.column("text")], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores),
                 pa.array((scores >= threshold).astype(np.int32))], schema=schema)
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS,
                   bits: int = BITS, threshold: float = THRESHOLD, cost: float = COST) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (``doc_id``, ``text``);
    ``labels``: ``doc_id`` and ``label``, 0 or 1."""
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, label, sample_rows, bits, cost))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       text_or_empty().alias("text"))
    return rows.mapInArrow(_score(model, bits, threshold), "doc_id long, held_out boolean, score double, predicted int")
