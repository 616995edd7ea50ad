"""Operators 11, 12 and 13 against plain versions, and their defined cases."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.llm import quality_classifier as Q
from feedlake.llm import token_alignment as A
from feedlake.llm.periodic_runs import batch_runs, periodic_runs, planted
from tests.llm.test_operators import SCHEMA, corpus, table

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
                       T.StructField("toxic", T.IntegerType()), T.StructField("text", T.StringType())])


# --- 11: quality classifier ----------------------------------------------------------------------

def labelled(n=400, seed=4):
    """Label 0: some words repeat or end in signs; the words themselves are drawn alike."""
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6))) for _ in range(r.randint(5, 60))]
        low = i % 4 == 0
        if low:
            at = r.randrange(len(words))
            words[at:at + 1] = [words[at]] * 8 if i % 8 else [words[at] + "%%%"] * 3
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 0 if low else 1, 0, "label text"))
    return rows, labels


def test_ngrams_of_slices_are_those_of_the_whole_text():
    r = random.Random(2)
    for _ in range(60):
        text = "".join(r.choice(["a", "Bé", "c c", " ", "\n", "x" * 30, "the the ", "1%", "日本 "]) for _ in range(r.randint(0, 400)))
        whole = Q.ngrams(text)
        assert np.array_equal(whole, Q.ngrams(text, slice_bytes=r.choice([1, 7, 40, 200])))
        assert np.array_equal(whole, np.unique(whole))
    assert len(Q.ngrams("")) == 0 and np.array_equal(Q.ngrams("ABC"), Q.ngrams("ABC "[:3]))


def test_log_ratios_are_add_one_shares():
    rows = [np.array([0, 2]), np.array([2]), np.array([1, 2])]
    labels = np.array([1, 0, 1])
    ratios = Q.log_ratios(rows, labels, 4)
    ones, zeros = np.array([2, 2, 3, 1]) / 8, np.array([1, 1, 2, 1]) / 5
    assert np.allclose(ratios, np.log(ones / zeros))


def test_dual_descent_reaches_the_best_value():
    """Primal and dual values meet, which only the optimum does."""
    r = np.random.RandomState(5)
    places, n = 30, 80
    rows = [np.sort(r.choice(places, r.randint(1, 8), replace=False)) for _ in range(n)]
    values = [r.randn(len(x)) for x in rows]
    signs = np.where(r.rand(n) < 0.4, 1.0, -1.0)
    bounds = np.full(n, 0.5)
    w, b = Q.dual_descent(rows, values, signs, bounds, places, epochs=3000, tolerance=1e-12)
    margins = np.array([w[x] @ v + b for x, v in zip(rows, values)])
    primal = (w @ w + b * b) / 2 + (bounds * np.maximum(0, 1 - signs * margins)).sum()
    # A plain sub-gradient search cannot do better.
    x, best = np.zeros(places + 1), math.inf
    dense = np.zeros((n, places + 1))
    for i, (p, v) in enumerate(zip(rows, values)):
        dense[i, p], dense[i, -1] = v, 1.0
    for step in range(20000):
        slack = 1 - signs * (dense @ x)
        best = min(best, (x @ x) / 2 + (bounds * np.maximum(0, slack)).sum())
        x = x - (x - ((slack > 0) * bounds * signs) @ dense) / (step + 10)
    assert primal <= best + 1e-6 and abs(primal - best) < 0.02 * best


def test_classifier_learns_and_holds_out(spark):
    rows, labels = labelled()
    docs, known = table(spark, rows), spark.createDataFrame(labels, LABELS)
    out = {x["doc_id"]: x for x in Q.quality_scores(docs, known).collect()}
    truth = {i: q for i, q, *_ in labels}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, x in out.items() if x["held_out"]} == set(held) and len(out) == len(rows)
    assert sum(out[i]["predicted"] == truth[i] for i in held) >= 0.9 * len(held)
    assert all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.3) for x in out.values())
    low, high = ([out[i]["score"] for i in held if truth[i] == k] for k in (0, 1))
    assert sum(a < b for a in low for b in high) > 0.95 * len(low) * len(high)


def test_held_out_labels_ids_and_sources_do_not_matter(spark):
    rows, labels = labelled(200)
    docs = table(spark, rows)
    plain = {x["doc_id"]: x["score"] for x in Q.quality_scores(docs, spark.createDataFrame(labels, LABELS)).collect()}
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t, x) for i, q, t, x in labels]
    other = docs.withColumn("source", F.lit("z")).withColumn("lang", F.lit(None).cast("string")).repartition(7)
    again = Q.quality_scores(other, spark.createDataFrame(turned, LABELS)).collect()
    assert {x["doc_id"]: x["score"] for x in again} == plain


def test_classifier_defined_cases(spark):
    rows, labels = labelled(120)
    odd = [(1000, None, None), (1001, "", "s"), (None, "some text", "s"), (None, None, "s"), (5, rows[5][1], "s"),
           (5, "another text under the id", "s"), (1002, "word " * 300_000, "s"), (1003, "x" * 3_000_000, "s")]
    notes = [(None, 1, 0, "x"), (7, 0, 0, "x"), (8, 1, 0, "x"), (8, 1, 0, "x"), (9, None, 1, "x"), (11, 5, 0, "x"),
             (99_999, 1, 0, "x")]
    out = Q.quality_scores(table(spark, rows + odd), spark.createDataFrame(labels + notes, LABELS)).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= x["score"] <= 1 for x in out)
    none = [x for x in out if x["doc_id"] is None]
    assert len(none) == 2 and all(x["held_out"] for x in none)
    by = defaultdict(list)
    for x in out:
        by[x["doc_id"]].append(x["score"])
    assert by[1000] == by[1001] and len(by[5]) == 3 and len(set(by[5])) == 2
    # One class only, and no label at all: the smoothed share.
    ones = spark.createDataFrame([(i, 1, 0, "x") for i in range(1, 4)], LABELS)
    used = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(1, 4))
    assert {round(x["score"], 12) for x in Q.quality_scores(table(spark, rows), ones).collect()} == {round((used + 1) / (used + 2), 12)}
    nothing = spark.createDataFrame([], LABELS)
    assert {x["score"] for x in Q.quality_scores(table(spark, rows), nothing).collect()} == {0.5}
    assert Q.quality_scores(spark.createDataFrame([], SCHEMA), nothing).collect() == []


def test_training_sample_is_bounded(spark):
    rows, labels = labelled(400)
    docs = table(spark, rows + rows * 3)
    sample = Q.training_sample(docs, spark.createDataFrame(labels, LABELS), "quality", 50).collect()
    by = Counter(x["y"] for x in sample)
    assert 20 < by[0] <= 60 and 20 < by[1] <= 60 and len({x["doc_id"] for x in sample}) == len(sample)
    assert all(zlib.crc32(str(x["doc_id"]).encode()) % 5 for x in sample)


# --- 12: cross-tokenizer alignment ---------------------------------------------------------------

def plain_alignment(text, both):
    tokens = both.tokens([text or ""])[0]
    if tokens is None:
        return None
    sides = []
    for ids, pieces in zip(tokens, (both.first_bytes, both.second_bytes)):
        at, spans = 0, []
        for i in ids.tolist():
            spans.append((i, at, at + len(pieces[i])))
            at = spans[-1][2]
        sides.append(spans)
    a, b = sides
    cuts = sorted({e for *_, e in a} & {e for *_, e in b})
    groups = [[[i for i, s, e in side if low <= s and e <= high] for side in sides] for low, high in zip([0, *cuts], cuts)]
    links, j = [], 0
    for x, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            links.append((x, b[k][0]))
            k += 1
    return len(a), len(b), groups, links, ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)


@pytest.fixture(scope="module")
def both():
    return A.pair(FIRST, SECOND)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=30), st.lists(st.integers(1, 5), min_size=1, max_size=30))
def test_pointer_jumping_finds_the_common_cuts(first, second):
    gap = sum(first) - sum(second)
    (second if gap > 0 else first).append(abs(gap)) if gap else None
    a, b = np.cumsum(first), np.cumsum(second)
    (a_at, a_cut), (b_at, b_cut) = A.tokens_at(a, a[-1]), A.tokens_at(b, b[-1])
    in_a, in_b = A.components(a, b, a_at, b_at, a_cut)
    cuts = sorted(set(a.tolist()) & set(b.tolist()))
    assert in_a.tolist() == [sum(c < e for c in cuts) for e in a.tolist()]
    assert in_b.tolist() == [sum(c < e for c in cuts) for e in b.tolist()]
    left, right, _ = A.overlaps(a_at, b_at, a_cut, b_cut)
    starts = lambda e: [0, *e[:-1].tolist()]
    pairs = [(i, j) for i, (s, e) in enumerate(zip(starts(a), a)) for j, (u, v) in enumerate(zip(starts(b), b)) if s < v and u < e]
    assert sorted(zip(left.tolist(), right.tolist())) == pairs


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2 ** 31), st.integers(0, 999), st.integers(1, 400)), max_size=60))
def test_parts_round_trip(entries):
    rows = sorted({(c, d): n for c, d, n in entries}.items())
    codes, docs, times = (np.array(x, np.int64) for x in ([k[0] for k, _ in rows], [k[1] for k, _ in rows], [n for _, n in rows]))
    if not rows:
        return
    c, held, d, n = A.unpack_part(A.pack_part(codes, docs, times))
    assert np.repeat(c, held).tolist() == codes.tolist() and d.tolist() == docs.tolist() and n.tolist() == times.tolist()


@pytest.mark.parametrize("limits", [(1 << 20, 128, 1 << 20), (500, 2, 50)])
def test_alignment_against_a_plain_version(spark, both, monkeypatch, limits):
    for name, value in zip(("BATCH_BYTES", "CHUNK_BATCHES", "SUM_CODES"), limits):
        monkeypatch.setattr(A, name, value)
    rows = corpus(7, 30) + [(900, "</s> <|endoftext|> <unk> <0x41> a\x00b", "s"), (901, "▁ under ▁", "s"), (902, " ", "s"),
                            (903, "  two  spaces\n\n\ttabs ", "s"), (None, "no id", "s"), (904, "nul\x00 \x7f ½ ﬁ 　", "s")]
    plain = [(i, plain_alignment(t, both)) for i, t, _ in rows]
    counts = Counter(pair for _, p in plain if p for pair in set(p[3]))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    want = Counter()
    for i, p in plain:
        want[(i, 0, 0, 0, 0, 0, 0, "", "") if p is None else
             (i, p[0], p[1], len(p[2]), len(p[3]), sum(counts[x] == best[x[0]] for x in p[3]), sum(counts[x] for x in p[3]),
              hashlib.sha256(p[4].encode()).hexdigest(), p[4])] += 1
    out = A.token_alignment(table(spark, rows), FIRST, SECOND, with_groups=True)
    assert Counter(tuple(x) for x in out.collect()) == want
    assert sum(p is None for _, p in plain) >= 4                       # null, empty and one that does not round trip


def test_alignment_of_an_empty_table(spark):
    out = A.token_alignment(spark.createDataFrame([], SCHEMA), FIRST, SECOND)
    assert out.collect() == [] and out.columns[:3] == ["doc_id", "n_a", "n_b"]


# --- 13: periodic runs ---------------------------------------------------------------------------

def plain_runs(words, least=6, exponent=4):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, plant):
    words = (text or "").encode().split()
    if plant:
        words = planted(words, b"" if doc_id is None else str(doc_id).encode())
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    sha = [hashlib.sha256(x).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode(), kept)]
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sha, kept.decode())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 9)), max_size=6), max_size=5))
def test_maximal_pairs_are_the_runs(blocks):
    documents = [[b"%d" % w for period, times in block for w in period * times] for block in blocks]
    assert batch_runs(documents) == [plain_runs(d) for d in documents]


def test_long_runs_cost_no_more_than_their_words():
    n = 300_000
    assert batch_runs([[b"a"] * n]) == [[(0, n, 1)]]
    assert batch_runs([[b"a", b"b", b"c"] * n]) == [[(0, 3 * n, 3)]]
    # A line that many places share, after another word each time, and no run.
    lines = [w for i in range(30_000) for w in (b"%d" % i, b"a", b"line", b"that", b"many", b"places", b"share")]
    assert batch_runs([lines]) == [[]]


@pytest.mark.parametrize("plant", [False, True])
def test_runs_of_documents(spark, plant):
    rows = corpus(9, 40) + [(800 + i, ("one two three four " * 3 + "end ") * (i % 5) + f"w{i} " * i, "s") for i in range(40)]
    rows += [(None, "a b a b a b a b a b", "s"), (None, None, "s"), (880, "a a a a a a", "s"), (881, "a a a a a", "s"),
             (882, "same word same word same same same same same\x0bsame\x1fsame", "s")]
    out = periodic_runs(table(spark, rows), plant=plant, with_text=True)
    assert Counter(tuple(x) for x in out.collect()) == Counter(plain_row(i, t, plant) for i, t, _ in rows)


def test_planted_tail_follows_from_the_id():
    words = [b"%d" % i for i in range(100)]
    some = [i for i in range(200) if planted(words, str(i).encode()) != words]
    assert some and all(zlib.crc32(str(i).encode()) % 10 == 0 for i in some)
    assert planted([], b"") == []


def test_runs_of_an_empty_table(spark):
    assert periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []
