"""Each operator against a plain version on small tables, and its defined cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T

from feedlake.llm import repeats
from feedlake.llm.embedding_dedup import embedding_dedup, n_passes
from feedlake.llm.html_extract import extract_text, main_text, parse, style_tree
from feedlake.llm.jaccard_join import jaccard_components, tree_pairs
from feedlake.llm.mixing import mix, mixture
from feedlake.llm.packing import _Plan, pack, packing_plan
from feedlake.llm.quality import quality_rules, without_frequent_lines
from feedlake.llm.sharding import even_cuts, greedy_cuts, shard_documents, smallest_capacity
from feedlake.llm.substring_dedup import factors, relative_parse, substring_dedup
from feedlake.llm.suffix_dedup import byte_kind, suffix_dedup, two_stage_sort
from feedlake.llm.token_counts import CountTree, apply_edits, count_trees, edited_token_counts, sample_edits
from feedlake.llm.tokens import Encoder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Names that the operators use inside, as a table's own columns.
CLASHES = ("size", "h", "r1", "n", "shard", "block", "node", "kept", "times", "copies", "spans", "rep")
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("n_chars", T.LongType())] + [T.StructField(c, T.StringType()) for c in CLASHES])


def table(spark, rows):
    """``rows``: (doc_id, text, source)."""
    full = [(i, t, s, "en", len(t or ""), *("x" * len(CLASHES))) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def corpus(seed=0, n=60):
    """Texts with copies, near copies, shared passages, repeats inside, odd ones and a very long one."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéüñ日") for _ in range(r.randint(1, 7))) for _ in range(400)]

    def prose(k):
        return "".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "  ", "\n", "\t"]) for _ in range(k))

    texts = [prose(r.choice([3, 20, 80, 200])) for _ in range(n)]
    texts += [texts[0], texts[0], texts[2], prose(4000)]
    passage = prose(70)
    texts += [prose(30) + passage + prose(40) for _ in range(5)]
    for k in range(6):
        words = texts[k + 5].split(" ")
        words[len(words) // 2:len(words) // 2 + 1] = ["other"]
        texts.append(" ".join(words))
    texts += ["ab " * 300, "same line here\n" * 50, "", " \n\t ", None, None, "one", "One", "é" * 250, "x" * 900, "日本 語"]
    rows = [(i, t, ["a", "b", "ä", None, "c"][i % 5]) for i, t in enumerate(texts)]
    return rows + [rows[1], rows[1], (rows[3][0], rows[3][1], "z")]


def by_id(df, *cols):
    out = defaultdict(list)
    for r in df.collect():
        out[r["doc_id"]].append(tuple(r[c] for c in cols))
    return out


# --- 1: sharding ---------------------------------------------------------------------------------

def plain_minimax(sizes, n):
    """Smallest largest run of a contiguous partition into n runs."""
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, runs, at = (low + high) // 2, 1, 0
        for s in sizes:
            if at + s > mid:
                runs, at = runs + 1, 0
            at += s
        low, high = (low, mid) if runs <= n else (mid + 1, high)
    return low


def test_greedy_search_is_minimal():
    r = random.Random(3)
    for _ in range(300):
        sizes = [r.choice([1, 2, 3, 5, 40]) for _ in range(r.randint(1, 30))]
        n = r.randint(1, 8)
        ends = list(accumulate(sizes))
        capacity = smallest_capacity(ends, n, exact=True)
        assert capacity == plain_minimax(sizes, n)
        cuts = even_cuts(ends, n, capacity)
        assert cuts[-1] == ends[-1] and len(cuts) <= n and set(cuts) <= set(ends)
        assert max(b - a for a, b in zip([0, *cuts], cuts)) <= capacity
        assert greedy_cuts(ends, n, capacity - 1, True) is None or capacity == -(-ends[-1] // n)


@pytest.mark.parametrize("n_shards", [1, 5, 24])
def test_shards_are_minimax_and_slots_gapless(spark, n_shards):
    from pyspark.sql import functions as F

    from feedlake.llm.sharding import text_hash
    rows = corpus()
    docs = table(spark, rows)
    out = shard_documents(docs, n_shards).collect()
    assert len(out) == len(rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    slots, sizes = defaultdict(list), Counter()
    for r in out:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots) < n_shards
    groups = docs.groupBy(text_hash().alias("h")).agg(
        F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 8).alias("s")).orderBy("h").collect()
    assert max(sizes.values()) == plain_minimax([g["s"] for g in groups], n_shards)
    where = defaultdict(set)
    for i, t, _ in rows:
        where[t or ""] |= {r["shard"] for r in out if r["doc_id"] == i}
    assert all(len(v) == 1 for v in where.values())


# --- 2: mixing -----------------------------------------------------------------------------------

def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left = dict.fromkeys(names, 0.0), share * sum(sizes.values())
    open_ = set(names)
    while open_ and left > 1e-9:
        total, given = sum(weight[s] for s in open_), 0.0
        for s in list(open_):
            part = min(most * sizes[s] - target[s], left * weight[s] / total)
            target[s] += part
            given += part
            if target[s] >= most * sizes[s] - 1e-9:
                open_.discard(s)
        left -= given
    return target


def test_mix_meets_targets(spark):
    r = random.Random(5)
    sources = ["a", "b", "ä", "Z", None, "\U0001F600", "￮"]
    rows = [(i, "w " * r.choice([0, 1, 5, 9]), r.choice([*sources, "a", "a", "a", "a"])) for i in range(1500)]
    rows += [(5000, None, "b"), (5001, "", "empty")]
    out = mix(table(spark, rows)).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    target = plain_targets(sizes)
    taken = Counter()
    for x in out:
        assert x["source_size"] == sizes[x["source"]]
        assert x["target"] == pytest.approx(target[x["source"]])
        assert x["times"] in (0, 1, 2) and x["taken"] == x["times"] * x["size"]
        taken[x["source"]] += x["taken"]
    assert len(out) == len(rows)
    assert all(abs(taken[s] - target[s]) <= 9 for s in target)
    again = mix(table(spark, rows[::-1])).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))
    full = mixture(table(spark, rows))
    assert full.columns == table(spark, rows[:1]).columns
    assert Counter(x["doc_id"] for x in full.collect()) == Counter({x["doc_id"]: x["times"] for x in out if x["times"]})


def test_mix_takes_more_for_a_larger_budget(spark):
    rows = [(i, "w " * (i % 7), "a") for i in range(400)]
    small, large = ({r["doc_id"]: r["times"] for r in mix(table(spark, rows), share=s).collect()} for s in (0.3, 1.7))
    assert all(large[i] >= small[i] for i in small)


def test_documents_without_or_with_shared_ids_are_taken_one_by_one(spark):
    r = random.Random(8)
    rows = [(None if k % 2 else 7, " ".join(str(r.random()) for _ in range(r.randint(5, 40))), "a") for k in range(600)]
    rows += [(k, "word " * r.randint(5, 40), "b") for k in range(1000, 1400)]
    taken, target = Counter(), {}
    for x in mix(table(spark, rows), share=0.8).collect():
        taken[x["source"]] += x["taken"]
        target[x["source"]] = x["target"]
    assert all(abs(taken[s] - target[s]) <= 40 for s in "ab")


# --- 3: embeddings -------------------------------------------------------------------------------

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType()), T.StructField("node", T.StringType()),
                        T.StructField("unit", T.StringType())])


def test_embedding_links(spark):
    g = np.random.default_rng(1)
    vectors = [g.standard_normal(16) for _ in range(150)]
    vectors += [vectors[0] + 0.05 * g.standard_normal(16) for _ in range(60)]
    vectors += [vectors[1]] * 30
    vectors += [2 * vectors[1], -vectors[1], np.zeros(16), None, [1.0, None] + [0.0] * 14, [np.nan] * 16, [np.inf] * 16,
                g.standard_normal(8), []]
    rows = [(100 + i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], i % 3, "n", "u")
            for i, v in enumerate(vectors)]
    rows.append(rows[2])
    out = embedding_dedup(spark.createDataFrame(rows, VECTORS).repartition(4)).collect()

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v):
            return None
        v = np.array(v, float)
        return v / np.linalg.norm(v) if v.any() else None
    units = [unit(r[1]) for r in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    links = Counter()
    for i, a in enumerate(units):
        for j, b in enumerate(units):
            if i != j and a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95:
                links[i] += 1
                up[max(find(i), find(j))] = min(find(i), find(j))
    expected = Counter((rows[i][0], links[i], rows[find(i)][0], rows[i][0] == rows[find(i)][0]) for i in range(len(rows)))
    assert Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in out) == expected
    assert n_passes(10**9, 0.95, 32, 0.995) > n_passes(10**4, 0.95, 32, 0.995) >= 4


def test_embedding_links_in_a_loose_cluster(spark):
    # A common direction, and a third of the rows in a cluster whose cosines are below the threshold.
    g = np.random.default_rng(5)

    def units(x):
        return x / np.linalg.norm(x, axis=1)[:, None]
    n, d = 12000, 64
    common, centre = units(g.standard_normal((2, d)))
    x = units(0.7 ** 0.5 * common + 0.3 ** 0.5 * units(g.standard_normal((n, d))))
    x[::3] = units(0.85 ** 0.5 * centre + 0.15 ** 0.5 * units(g.standard_normal((len(x[::3]), d))))
    some = np.arange(0, 3000, 3).tolist() + np.arange(1, 3000, 3).tolist()
    off = g.standard_normal((len(some), d))
    off = units(off - np.einsum("ij,ij->i", off, x[some])[:, None] * x[some])
    x = np.concatenate([x, 0.955 * x[some] + (1 - 0.955 ** 2) ** 0.5 * off]).astype(np.float32).astype(float)
    rows = [(i, v.tolist(), 0, "n", "u") for i, v in enumerate(x)]
    out = {r["vec_id"]: r for r in embedding_dedup(spark.createDataFrame(rows, VECTORS).repartition(4)).collect()}
    near = np.argwhere(np.triu(units(x) @ units(x).T >= 0.95, 1)).tolist()
    met = sum(out[i]["component_id"] == out[j]["component_id"] for i, j in near)
    print(f"recall {met / len(near):.4f} of {len(near)} links")
    assert len(near) >= 2000 and met >= 0.99 * len(near)


# --- 4 and 7: repeats ----------------------------------------------------------------------------

def plain_suffix(rows, length=200):
    count = Counter()
    for _, t, _ in rows:
        b = (t or "").encode()
        count.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = Counter()
    for i, t, _ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if count[b[k:k + length]] > 1:
                gone[k:k + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) > 0).sum())
        out[(i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def plain_substring(rows, length=13):
    words = [(i, (t or "").encode().split()) for i, t, _ in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - length + 1):
            key = tuple(w[k:k + length])
            first[key] = min(first.get(key, i), i)
    out = Counter()
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if first[tuple(w[k:k + length])] < i:
                gone[k:k + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[(i, len(w), sum(gone), hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("hot", [repeats.HOT, 2])
def test_repeats_equal_brute_force(spark, monkeypatch, hot):
    """Also with anchors split into chunks from three windows on."""
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = corpus(1)
    out = suffix_dedup(table(spark, rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(map(tuple, out)) == plain_suffix(rows)
    out = substring_dedup(table(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, out)) == plain_substring(rows)


def test_repeats_across_the_pieces_of_a_very_long_text(spark, monkeypatch):
    r = random.Random(8)
    long = " ".join(f"w{r.randint(0, 10**6)}" for _ in range(repeats.PIECE // 4))
    middle = long[repeats.PIECE - 300:repeats.PIECE + 300]  # lies across the edge of a piece
    rows = [(1, "start|" + middle + "|end", "a"), (2, long, "a"), (3, "nothing", "b")]
    out = {x["doc_id"]: x for x in suffix_dedup(table(spark, rows)).collect()}
    assert (out[2]["n_removed"], out[2]["n_spans"], out[3]["n_removed"]) == (len(middle), 1, 0)
    words = {x["doc_id"]: x for x in substring_dedup(table(spark, rows)).collect()}
    assert words[1]["n_removed"] == 0 and words[2]["n_removed"] >= len(middle.split()) - 2


def test_repeats_of_long_runs(spark, monkeypatch):
    r = random.Random(9)

    def prose(k):
        return " ".join(f"v{r.randint(0, 10**6)}" for _ in range(k))
    runs = ["x" * 900, "=-" * 600, "row, " * 400, "ab " * 300 + prose(60) + " ab" * 500, "x" * 250 + prose(50) + "x" * 700]
    rows = [(i, t, "s") for i, t in enumerate([*runs, *(prose(30) + t for t in runs), prose(80)])]
    for hot in (repeats.HOT, 3):
        monkeypatch.setattr(repeats, "HOT", hot)
        assert Counter(tuple(x) for x in suffix_dedup(table(spark, rows)).collect()) == Counter(plain_suffix(rows))
        assert Counter(map(tuple, substring_dedup(table(spark, rows)).collect())) == Counter(plain_substring(rows))
    # Of a run of some MB not every byte is a place.
    data = b"x" * 3_000_000
    found = [lo for _, _, lo, _ in repeats._sampled(byte_kind(), [data])]
    assert sum(map(len, found)) < 3000
    monkeypatch.undo()
    out = suffix_dedup(table(spark, [(1, "x" * 3_000_000, "s"), (2, prose(9) + "x" * 300, "s")])).collect()
    assert {x["doc_id"]: x["n_removed"] for x in out} == {1: 3_000_000, 2: 300}


def test_relative_parse_against_a_plain_one():
    r = random.Random(12)
    for _ in range(60):
        length, n_texts = r.choice([3, 5, 13]), r.randint(1, 12)
        texts = list({" ".join(r.choice("ab" if r.random() < .3 else "abcdef") for _ in range(r.randint(length, 60)))
                      for _ in range(n_texts)})
        if r.random() < .7:  # a copy of a part, in another text
            words = texts[0].split()
            texts.append(" ".join(["z", *words[:max(length, len(words) // 2)], "z", *words[-length:]]))
        split = [t.split() for t in texts]
        order = np.array([r.randint(0, 6) for _ in texts])
        pile = repeats.Pile([t.encode() for t in texts], np.array([len(w) - length + 1 for w in split]), order,
                            np.zeros(len(texts), bool))
        seen, numbers, (context, first, size) = relative_parse(pile, length)

        def match(i, a, split=split, order=order):  # longest match of a place with a smaller text
            best = 0
            for j, other in enumerate(split):
                for b in range(len(other) if order[j] < order[i] else 0):
                    k = 0
                    while a + k < len(split[i]) and b + k < len(other) and split[i][a + k] == other[b + k]:
                        k += 1
                    best = max(best, k)
            return best
        plain, windows, hits = set(), [], []
        for i, w in enumerate(split):
            found = [match(i, a) for a in range(len(w) - length + 1)]
            hits += [x >= length for x in found]
            windows += [tuple(w[a:a + length]) for a in range(len(found))]
            a = 0
            while a < len(found):
                if found[a] >= length:
                    plain.add((i, a, found[a]))
                    a += found[a] - length  # windows across the factor's end come next
                a += 1
        assert set(zip(context.tolist(), first.tolist(), size.tolist(), strict=True)) == plain
        assert seen.tolist() == hits
        assert len(set(zip(windows, numbers.tolist(), strict=True))) == len(set(windows)) == len(set(numbers.tolist()))
    assert [x.tolist() for x in factors(np.zeros(0, np.int64), np.zeros(0, np.int64), 13)] == [[], [], []]


def test_a_shared_passage_goes_whole(spark):
    r = random.Random(13)
    shared = [f"s{k}" for k in range(40)]
    rows = [(k, " ".join([f"a{r.random()}" for _ in range(9)] + shared + [f"b{r.random()}" for _ in range(9)]), "x")
            for k in range(4)]
    out = by_id(substring_dedup(table(spark, rows)), "n_removed")
    assert [out[k][0][0] for k in range(4)] == [0, 40, 40, 40]


def test_removed_text_keeps_whole_characters(spark):
    rows = [(1, "é" * 150 + "ab", "a"), (2, "è" + "é" * 150 + "cd", "a")]
    out = by_id(suffix_dedup(table(spark, rows), with_text=True), "kept_text", "kept")
    assert out[1][0][0] == "ab" and out[2][0][0] == "ècd"


def test_two_stage_sort_orders_suffixes():
    r = random.Random(2)
    for _ in range(300):
        strings = [bytes(r.choice(b"aab\xffc") for _ in range(r.randint(1, 40))) for _ in range(r.randint(1, 6))]
        data = b"".join(strings)
        ends = np.repeat(np.cumsum([len(s) for s in strings]), [len(s) for s in strings])
        depth = r.choice([1, 3, 8])
        wanted = np.array([r.random() < 0.7 and e - i >= depth for i, e in enumerate(ends)])
        order = two_stage_sort(data, ends, wanted, depth)
        assert sorted(order) == list(np.flatnonzero(wanted))
        keys = [data[p:p + depth] for p in order.tolist()]
        assert keys == sorted(keys)


# --- 5: Jaccard join -----------------------------------------------------------------------------

def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def plain_components(rows, percent=75):
    sets = [shingle_set(t) for _, t, _ in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for k, (i, _, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return Counter((rows[k][0], len(sets[k]), least[find(k)] if sets[k] else rows[k][0]) for k in range(len(rows)))


def test_jaccard_components_equal_brute_force(spark):
    r = random.Random(4)
    rows = corpus(2, 40)
    words = [f"v{k}" for k in range(3000)]
    base = [r.choice(words) for _ in range(60)]
    near = []
    for k in range(300):  # one large group: more than a leaf of a block
        w = list(base)
        for _ in range(r.choice([0, 1, 2, 3])):
            w[r.randrange(60)] = r.choice(words)
        near.append((1000 + k, " ".join(w), "a"))
    chain = [r.choice(words) for _ in range(50)]
    for k in range(30):  # each close to the next only
        chain = [*chain[2:], r.choice(words), r.choice(words)]
        near.append((2000 + k, "\t".join(chain).upper() if k % 2 else " ".join(chain), "b"))
    rows += near
    out = jaccard_components(table(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, out)) == plain_components(rows)


def test_tree_pairs_lose_nothing():
    g = np.random.default_rng(6)
    base = [set(g.integers(0, 500, g.integers(5, 60)).tolist()) for _ in range(60)]
    sets = base + [set(list(s)[1:]) | {900 + i} for i, s in enumerate(base)]
    points = np.zeros((len(sets), 16), np.int32)
    for i, s in enumerate(sets):
        for x in s:
            points[i, x % 16] += 1
    i, j, bound = tree_pairs(points, np.array([len(s) for s in sets]))
    found = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                assert (b, a) in found
    assert len(found) < len(sets) * (len(sets) - 1) / 4


# --- 6: quality rules ----------------------------------------------------------------------------

def plain_quality(rows, max_documents, min_kept):
    def norm(line):
        return " ".join(WORD.findall(line)).lower()
    seen = defaultdict(set)
    for _, t, s in rows:
        for line in (t or "").split("\n"):
            if norm(line):
                seen[(s, norm(line))].add(t)
    out = Counter()
    for i, t, s in rows:
        t = t or ""
        words, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
        count = Counter(windows)
        repeated = {k + d for k, w in enumerate(windows) if count[w] > 1 for d in range(3)}
        removed = sum(len(WORD.findall(x)) for x in lines if len(seen[(s, norm(x))]) > max_documents)
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        out[(i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
             len(repeated), failed, not failed and len(words) - removed >= min_kept * len(words))] += 1
    return out


def test_quality_rules_equal_brute_force(spark):
    r = random.Random(7)
    lines = [" ".join(f"w{r.randint(0, 3000)}" for _ in range(12)) for _ in range(4)]
    rows = corpus(3)
    for k in range(40):
        own = [" ".join(f"u{r.randint(0, 10**6)}" for _ in range(r.choice([2, 30]))) for _ in range(3)]
        rows.append((500 + k, "\n".join([*r.sample(lines, 4), *own]).replace("w1", "W1" if k % 2 else "w1"), "host"))
    rows += [(600 + k, "# a | b\n" + " ".join(f"c{j}" for j in range(80)), "copies") for k in range(30)]
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    out = quality_rules(table(spark, rows), max_documents=10, min_kept=0.5).select(*cols).collect()
    expected = plain_quality(rows, 10, 0.5)
    assert Counter(map(tuple, out)) == expected
    assert any(not x[-1] and not x[-2] for x in expected)          # some are depleted
    assert all(x[-1] for x in expected if 600 <= x[0] < 630)       # copies of a good text stay
    cleaned = by_id(without_frequent_lines(table(spark, rows), max_documents=10), "text")
    assert all(not set(lines) & set(cleaned[500 + k][0][0].split("\n")) for k in range(40))
    assert cleaned[600][0][0].startswith("# a | b")


def test_quality_rules_keep_near_copies(spark):
    r = random.Random(8)

    def line(k=12):
        return " ".join(f"n{r.randint(0, 10**6)}" for _ in range(k))
    page, shared = [line() for _ in range(20)], [line() for _ in range(4)]
    rows = [(0, "\n".join(page), "hot")]
    for k in range(1, 300):
        copy = list(page)
        for _ in range(r.choice([1, 1, 2])):
            copy[r.randrange(20)] = line()
        rows.append((k, "\n".join(copy), "hot"))
    rows += [(1000 + k, "\n".join([*shared, line(60), line(60)]), "hot") for k in range(60)]  # boilerplate of other pages
    rows += [(2000 + k, "\n".join([*shared, line(8)]), "hot") for k in range(20)]             # little but that
    out = {x["doc_id"]: x for x in quality_rules(table(spark, rows)).collect()}
    assert all(out[k]["kept"] and out[k]["removed_words"] == 0 for k in range(300))
    assert all(out[1000 + k]["kept"] and out[1000 + k]["removed_words"] == 48 for k in range(60))
    assert not any(out[2000 + k]["kept"] for k in range(20))
    # A line in 81 of 380 documents is no boilerplate of a host that allows a quarter of them.
    out = quality_rules(table(spark, rows), max_share=0.25).collect()
    assert all(x["kept"] and x["removed_words"] == 0 for x in out if x["doc_id"] >= 1000)


def test_quality_rules_reject_pages_of_one_template(spark):
    r = random.Random(9)

    def line(k):
        return " ".join(f"t{r.randint(0, 10**6)}" for _ in range(k))
    template, page = [line(9) for _ in range(10)], [line(12) for _ in range(20)]
    pages = [(k, "\n".join([*template[:5], line(8), *template[5:]]), "shop") for k in range(1000)]
    copies = []
    for k in range(400):  # lines changed, a word changed, lines left out; some add a line
        copy, at = list(page), r.randrange(20)
        copy[at:at + 1] = r.choice([[line(12)], [copy[at].replace("t", "u", 1)], [], [copy[at], line(5)]])
        copies.append((2000 + k, "\n".join(copy), "shop"))
    clean = [(5000 + k, "\n".join(line(12) for _ in range(8)), "shop") for k in range(150)]
    out = {x["doc_id"]: x["kept"] for x in quality_rules(table(spark, pages + copies + clean)).collect()}
    assert not any(out[k] for k in range(1000))
    assert all(out[k] for k in range(2000, 2400)) and all(out[5000 + k] for k in range(150))
    # A table twice as large, of other rows of the same kinds: the same verdicts.
    more = [(10000 + k, "\n".join([*template[:5], line(8), *template[5:]]), "shop") for k in range(1000)]
    more += [(20000 + k, "\n".join(line(12) for _ in range(8)), "shop") for k in range(550)]
    twice = {x["doc_id"]: x["kept"] for x in quality_rules(table(spark, pages + copies + clean + more)).collect()}
    assert {k: v for k, v in twice.items() if k < 10000} == out
    assert not any(twice[10000 + k] for k in range(1000)) and all(twice[20000 + k] for k in range(550))


def test_without_frequent_lines_keeps_a_callers_columns(spark):
    rows = [(k, f"the same line\nown line {k}", "a") for k in range(12)] + [(20, "the same line", None)]
    docs = table(spark, rows).withColumnsRenamed({"size": "f", "h": "frequent", "n": "frequent lines"})
    out = without_frequent_lines(docs, max_documents=10)
    assert out.columns == docs.columns
    assert {x["doc_id"]: x["text"] for x in out.collect()} == {k: f"own line {k}" for k in range(12)} | {20: "the same line"}


# --- 8: packing ----------------------------------------------------------------------------------

def optimum(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in sorted(set(bins)):
            if b + items[i] <= capacity:
                k = bins.index(b)
                bins[k] += items[i]
                put(i + 1, bins)
                bins[k] -= items[i]
        put(i + 1, [*bins, items[i]])
    put(0, [])
    return best[0]


def test_reduction_keeps_an_optimum_and_plan_is_whole():
    r = random.Random(9)
    excess = 0
    for _ in range(400):
        capacity = r.choice([10, 15, 20])
        items = [r.randint(1, capacity) for _ in range(r.randint(1, 8))]
        counts = Counter(items)
        best = optimum(items, capacity)
        plan = _Plan(counts, capacity)
        plan.reduce()
        rest = [n for n, c in plan.left.items() for _ in range(c)]
        assert plan.sequences + (optimum(rest, capacity) if rest else 0) == best
        runs, n = packing_plan(counts, capacity)
        excess += n - best
        used, filled = set(), defaultdict(list)
        for run in runs:
            for k in range(run.count):
                used.add((run.length, run.rank + k))
                filled[run.sequence + k].append((run.offset, run.length))
        assert used == {(n_, k) for n_, c in counts.items() for k in range(c)} and set(filled) == set(range(n))
        for pieces in filled.values():
            pieces.sort()
            assert [o for o, _ in pieces] == [0, *accumulate(n_ for _, n_ in pieces)][:-1]
            assert sum(n_ for _, n_ in pieces) <= capacity
    assert excess <= 4


def test_pack_pieces(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)  # gives the string of its special token that token's id
    rows = corpus(4, 30) + [(900, "don't  <|endoftext|> x<|endoftext|><|endoftext|>", "a"), (902, "<|endoftext|>", "a"), (901, " 日本   語 \U0001F600", "b")]
    out = pack(table(spark, rows), TOKENIZER, with_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for p in out:
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"] <= 4096
        pieces[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    texts = defaultdict(list)
    for i, text, _ in rows:
        texts[i].append(np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes())
    for i, expected in texts.items():
        n = len(expected[0]) // 4
        first = (n - 1) % 1024 + 1
        layout = sorted(((p["piece"], p["start"], p["length"]) for p in pieces[i]))[::len(expected)]
        assert layout == [(k, 0 if k == 0 else first + 1024 * (k - 1), first if k == 0 else 1024)
                          for k in range(len(layout))]
        whole = b"".join(p["ids"] for p in sorted(pieces[i], key=lambda p: p["piece"])[::len(expected)])
        assert whole == expected[0]
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == [0, *accumulate(n for _, n in s)][:-1] and sum(n for _, n in s) <= 1024


# --- 9: HTML -------------------------------------------------------------------------------------

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("html", T.StringType()), T.StructField("host", T.StringType()),
                      T.StructField("paths", T.StringType())])


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain", "plain"), ("<p>a<b>b</b>\n c<br>d</p>e", "ab c d e"),
    ("<article><h1>T</h1><p>a &amp; b&nbsp;c &#233; &lt;i&gt;<p>d</article><footer>f</footer>", "T a & b c é <i> d"),
    ("<body><nav>n</nav><header>h</header><main>m<aside>s</aside><form>f</form></main><p>out", "m"),
    ("<article>a<script>if (a < b) '</p>'</script><style>p{}</style><!-- c > -->b</article>", "ab"),
    ("<article>x<div class='cookie-notice'>c</div><ul><li>1<li>2</ul><div id=comments>r</div></article>", "x 1 2"),
    ("<article><a title=\"x>y\" href='z'>t</a> 1 < 2 & 3", "t 1 < 2 & 3"),
    ("<article>a<div hidden>b</div><div style='display: none'>c</div><p role=navigation>d</p>e", "a e"),
    ("<article>one</article><p>between</p><article>two", "one two"), ("<div><div><article>deep</div>out", "deep"),
    ("<script>never closed <p>x", ""), ("<article><!-- open", ""), ("<article>é<p>\U0001F600</p>", "é \U0001F600"),
])
def test_main_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(("page", "text"), [
    ("<article><h2 id='related-work'>R</h2><section id='social-effects'>s</section><section id=sharing>t</section>",
     "R s t"),
    ("<article><p class='notice-period'>p</p><div class=share-price>q</div><p class='notice'>r</p>", "p q"),
    ("<article><a title='the hidden side'>l</a> <b title=\"x class='ad' y\" data-x='role=navigation'>m</b>", "l m"),
    ("<article>a<div class='x ad'>b</div><div class=share-buttons>c</div><div id=ad_box>d</div><i HIDDEN>e</i>f", "af"),
    ("<article>a<div class = 'newsletter' title='x'>b</div><p title=''hidden>c</p>", "a"),
])
def test_names_of_furniture_are_whole(page, text):
    assert main_text(page).replace("a f", "af") == text


LONG = "running text of the page " * 20


@pytest.mark.parametrize(("page", "text"), [
    ("<main>a<section id='comments'>b</section></main>", "a"), ("<article>a<div class='comment'>b</div>c</article>", "a c"),
    ("<article>a<ol class='comment-list'><li>b</ol></article>", "a"),
    ("<article>a<div class=notice>b</div><div class=related>c</div><p class='promo box'>d</p>e</article>", "a e"),
    (f"<article>teaser</article><div class=content>{LONG}</div>", f"teaser {LONG.strip()}"),
    (f"<div><a href=x>{LONG}</a></div><article>short</article>", "short"),
    ("<article>a<video src=x><p>c</p></article>", "a c"),
    ("<article>a<svg><path><p>b</article>", "a b"), ("<article>a<object><p>b</article>", "a b"),
    ("<article>a<audio><p>b<select><p>c</article>", "a b c"), ("<article>so <math>x+1</math> holds</article>", "so x+1 holds"),
    ("<form action=x><p>a</p><div>b<nav>n</nav></div></form>", "a b"), ("<p>a</p><form><p>b</p></form>", "a"),
    ('<article><script src="a.js"/>alert(1)</script>b', "b"), ("<article><a title=\"x>b</a> c", "b c"),
    ("<div class=site-header>a</div><div id=main-nav>b</div><p>c</p><div class=site-footer>d</div>"
     "<div class='x page-sidebar'>e</div><div class=post-comments>f</div><div class=main-content>g</div>", "c g"),
    ("<div class=post-title>a</div><div class=main>b</div><div class=page-header>c</div>", "a b c"),
])
def test_furniture_of_pages(page, text):
    assert main_text(page) == text


def test_style_tree_against_a_plain_one(spark):
    """Importance by the definition, from all pages of a host at once."""
    import math
    r = random.Random(3)
    made = []
    for k in range(60):
        host = f"h{k % 4}.example"
        own = " ".join(f"w{r.randint(0, 999)}" for _ in range(30))
        made.append((k, f"http://{host}/{k}", f"<div class=top>Site {r.randint(0, k % 4)}</div><div class=body><p>{own}</p>"
                     + "<p>x</p>" * r.randint(0, 2) + "</div>" + "<i>end</i>" * r.randint(0, 1), "x", "y"))
    pages = spark.createDataFrame(made + made[:20], PAGES)
    seen = {}
    for _, url, html, *_ in made:
        host = url.split("/")[2]
        nodes, runs = parse(html)
        longest = max((" ".join(t.split()) for n, t in runs if t), key=lambda x: (len(x), x))
        for n, t in runs:
            if t and t.strip():
                seen.setdefault((host, n.path), ([], set(), {}))[2].setdefault(" ".join(t.split()), set()).add(longest)
        for path in {n.path for n, t in runs if t and t.strip()}:
            seen[(host, path)][0].append("|".join(",".join(n.children) for n in nodes if n.path == path))
    want = {}
    for key, (ways, _, contents) in seen.items():
        m = len(ways)
        if m < 2:
            want[key] = 1.0
            continue
        shown = -sum(c / m * math.log(c / m, m) for c in Counter(ways).values())
        held = 1 - sum(math.log(len(p), m) for p in contents.values()) / len(contents)
        want[key] = 1 - (1 - (0.9 * held + 0.1 * shown)) * (1 - 1 / m)
    got = {(x["host"], x["path"]): x["importance"] for x in style_tree(pages).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    cut = extract_text(pages).collect()
    assert all(not x["text"].startswith("Site") for x in cut if x["url"].startswith("http://h0"))


def test_near_copies_of_an_article_are_no_evidence_against_it(spark):
    article = "<article><h1>Title</h1><p>" + "one two three " * 30 + "</p><p>second part</p></article>"
    rows = [(k, "http://c.example/p", f"<body><script>t({k})</script>{article}<p>{k}</p></body>", "x", "y") for k in range(40)]
    out = extract_text(spark.createDataFrame(rows, PAGES)).collect()
    assert {x["text"] for x in out} == {"Title " + ("one two three " * 30).strip() + " second part"}


def test_very_deep_pages():
    deep = 1000
    assert main_text("<body><div><article>a" + "<div>" * deep + "b" + "</div>" * deep + "<p>c</p></article></div>out") == "a b c"
    assert main_text("<div>" * deep + "out<article>a<nav>n</nav><p>b</p></article>" + "</div>" * deep + "out") == "a b"
    assert main_text("<article>" + "<b>" * deep + "a<aside>n</aside>b") == "a b"
    assert main_text("<p>" + "<object>x</object><span><div>" * 30000 + "a" + "</i>" * 30000 + "b").endswith("ab")
    assert len(max((n.path for n in parse("<div>" * 30000)[0]), key=len)) < 10000


def test_style_tree_cuts_what_a_site_repeats(spark):
    r = random.Random(1)

    def page(k, repeated="Visit our partners today"):
        own = " ".join(f"w{r.randint(0, 10**6)}" for _ in range(20))
        return (f"<html><body><div class='box a{k}'>{repeated}</div><div class=body><p>{own}</p><p>And {k}</p></div>"
                f"</body></html>")
    rows = [(k, f"http://Big.example/{k}", page(k), "x", "y") for k in range(30)]
    rows += [rows[0]] * 40                                                # copies of a page count once
    rows += [(100 + k, f"http://few.example/{k}", page(k), "x", "y") for k in range(3)]
    rows += [(200, None, None, "x", "y"), (201, "no url", "<p>t</p>", "x", "y")]
    rows += [(300 + k, "https://copies.example/p", "<body><p>only this</p></body>", "x", "y") for k in range(50)]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    out = {x["page_id"]: x for x in extract_text(pages).collect()}
    assert len(out) == 30 + 3 + 2 + 50
    assert all("partners" not in out[k]["text"] and out[k]["text"].endswith(f"And {k}") for k in range(30))
    assert all(out[100 + k]["text"].startswith("Visit our partners") for k in range(3))
    assert out[200]["text"] == "" and out[200]["n_chars"] == 0 and out[201]["text"] == "t"
    assert out[300]["text"] == "only this" and all(x["n_chars"] == len(x["text"]) for x in out.values())
    tree = {(x["host"], x["path"].rsplit("/", 1)[1]): x for x in style_tree(pages).collect()}
    assert tree[("big.example", "div.box a")]["pages"] == 30
    assert tree[("big.example", "div.box a")]["importance"] < 0.1 < 0.8 < tree[("big.example", "p")]["importance"]


# --- 10: token counts ----------------------------------------------------------------------------

def test_edits_count_like_the_whole_text():
    enc, r = Encoder(TOKENIZER), random.Random(1)
    letters = ["a", "bc", "the", " ", "  ", "\n", " x", "don't", "é", "日本", "1", "...", " ", " "]

    def count(s):
        return len(enc.tokenizer.encode(s, add_special_tokens=False).ids)
    for _ in range(150):
        s = "".join(r.choice(letters) for _ in range(r.choice([0, 1, 20, 600])))
        tree = CountTree(s, enc)
        assert tree.total() == count(s)
        for _ in range(r.randint(1, 10)):
            at, deleted = r.randint(0, len(s) + 2), r.choice([0, 1, 10, len(s)])
            new = "".join(r.choice(letters) for _ in range(r.choice([0, 1, 10, 300])))
            tree.edit(at, deleted, new)
            at = min(at, len(s))
            s = s[:at] + new + s[at + deleted:]
            assert (tree.text(), tree.total(), tree.length()) == (s, count(s), len(s))
        assert CountTree("", enc, tree.leaves()).total() == count(s)


@pytest.mark.parametrize("unit", ["some words here ", "a word\nto\na line\n", "two  spaces  each  ", "天地玄黄宇宙洪荒日月盈昃辰宿列张",
                                  "春眠不覚暁、処処聞啼鳥。", "ひらがなとカタカナ", "x=1;y(2)+z[3]", "https://a.example/b?c=d&e/"])
def test_edit_encodes_a_small_region(unit):
    enc = Encoder(TOKENIZER)
    text = unit * (100_000 // len(unit))
    tree = CountTree(text, enc)
    assert tree.total() == len(enc.tokenizer.encode(text, add_special_tokens=False).ids)
    tree.encoded = 0
    tree.edit(40_000, 5, "changed")
    assert 0 < tree.encoded < 2000
    assert tree.total() == len(enc.tokenizer.encode(tree.text(), add_special_tokens=False).ids)


def test_edited_counts_of_documents(spark):
    enc = Encoder(TOKENIZER)
    rows = corpus(5, 20)
    docs = table(spark, rows).withColumn("edits", sample_edits())
    out = edited_token_counts(docs, TOKENIZER, with_text=True).collect()
    assert len(out) == len(rows)
    texts = {i: t or "" for i, t, _ in rows}
    for x in out:
        assert x["n_tokens"] == len(enc.encode(texts[x["doc_id"]])) and x["n_edits"] == 4
        assert x["n_tokens_after"] == len(enc.encode(x["text_after"])) and x["n_chars_after"] == len(x["text_after"])
    trees = count_trees(docs, TOKENIZER)
    again = apply_edits(trees.dropDuplicates(["doc_id"]).join(docs.select("doc_id", "edits").dropDuplicates(["doc_id"]),
                                                             "doc_id"), TOKENIZER)
    after = {x["doc_id"]: x["n_tokens_after"] for x in out}
    assert {x["doc_id"]: x["n_tokens"] for x in again.collect()} == after


# --- all: empty tables ---------------------------------------------------------------------------

@pytest.mark.parametrize("run", [
    shard_documents, mix, mixture, suffix_dedup, substring_dedup, jaccard_components, quality_rules,
    lambda d: pack(d, TOKENIZER), lambda d: edited_token_counts(d.withColumn("edits", sample_edits()), TOKENIZER),
], ids=["1", "2", "2m", "4", "7", "5", "6", "8", "10"])
def test_empty_documents(spark, run):
    assert run(spark.createDataFrame([], SCHEMA)).collect() == []


def test_other_empty_tables(spark):
    assert embedding_dedup(spark.createDataFrame([], VECTORS)).collect() == []
    assert extract_text(spark.createDataFrame([], PAGES)).collect() == []
