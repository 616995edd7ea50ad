"""Operator 10, token counts: edit-aware counting.

A document's text is cut into parts at pre-token boundaries that the characters
beside them alone make sure of (see ``tokens``; long pre-tokens are cut where no
merge can reach across). The parts are the leaves' contents of a segment tree
whose nodes hold characters and tokens of their subtree. An edit (delete some
characters at a place, insert a text) descends the tree to the leaves it touches,
takes one more leaf on each side as boundary context, cuts and encodes that
region again and updates the sums on the paths to the root. The rest of the
document is not encoded again.

Trees are kept in a table (``count_trees``); edits are applied to kept trees
(``apply_edits``) without the texts. ``edited_token_counts`` does both.

Defined cases: a null text is empty; a null list of edits has none; a place or
length beyond the text is moved to its end; a null inserted text is empty; edits
of a document apply in order; repeated rows are rows of their own; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.llm.common import materialise, text_or_empty
from feedlake.llm.tokens import Encoder, encoder

LEAF_PARTS = 16    # most parts of a leaf
LEAF_CHARS = 256   # a leaf with as many characters takes no more parts


class CountTree:
    """Segment tree over a text's parts.

    Leaf texts join to the whole text; between two of them is a cut. ``chars`` and
    ``tokens`` are heaps: node k has the children 2k and 2k + 1, the leaves start
    at ``width``.
    """

    def __init__(self, text: str, enc: Encoder, leaves: list[tuple[str, int]] | None = None):
        self.enc = enc
        self.encoded = 0  # characters encoded so far
        self._build(leaves if leaves is not None else self._leaves(text))

    def _leaves(self, text: str) -> list[tuple[str, int]]:
        """Leaf texts and tokens of a text, or of a part of one between two cuts."""
        self.encoded += len(text)
        out, low, chars = [], 0, 0
        parts, counts = self.enc.part_counts(text)
        for k, part in enumerate(parts, 1):
            chars += len(part)
            if k - low == LEAF_PARTS or chars >= LEAF_CHARS or k == len(parts):
                out.append(("".join(parts[low:k]), sum(counts[low:k])))
                low, chars = k, 0
        return out

    def _build(self, leaves: list[tuple[str, int]]) -> None:
        self.texts = [t for t, _ in leaves] or [""]
        self.width = 1 << max(0, len(self.texts) - 1).bit_length()
        self.chars, self.tokens = ([0] * (2 * self.width) for _ in range(2))
        for k, (t, n) in enumerate(leaves):
            self.chars[self.width + k], self.tokens[self.width + k] = len(t), n
        for k in range(self.width - 1, 0, -1):
            self._sum(k)

    def _sum(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def total(self) -> int:
        return self.tokens[1]

    def length(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(self.texts)

    def leaves(self) -> list[tuple[str, int]]:
        """What a new tree can be made of without encoding."""
        return [(t, self.tokens[self.width + k]) for k, t in enumerate(self.texts) if t or len(self.texts) == 1]

    def _find(self, at: int) -> tuple[int, int]:
        """Leaf of the character at ``at`` (the last leaf with text for the end), and its place there."""
        k = 1
        while k < self.width:
            if at < self.chars[2 * k] or not self.chars[2 * k + 1]:
                k = 2 * k
            else:
                at -= self.chars[2 * k]
                k = 2 * k + 1
        return k - self.width, at

    def _beside(self, leaf: int, step: int) -> int:
        """The next leaf with text in a direction, or the same if there is none."""
        k = leaf + step
        while 0 <= k < len(self.texts):
            if self.texts[k]:
                return k
            k += step
        return leaf

    def edit(self, at: int, deleted: int, inserted: str) -> None:
        at = max(0, min(at, self.length()))
        end = min(at + max(0, deleted), self.length())
        first, place = self._find(at)
        last, _ = self._find(end)
        low, high = self._beside(first, -1), self._beside(last, 1)
        before = sum(len(self.texts[k]) for k in range(low, first)) + place
        region = "".join(self.texts[low:high + 1])
        region = region[:before] + inserted + region[before + end - at:]
        # The context leaves are whole, so the region's ends are still cuts.
        fresh = self._leaves(region) if region else []
        room = high - low + 1
        if len(fresh) > 2 * room + 2:
            self._build([*self._part(0, low), *fresh, *self._part(high + 1, len(self.texts))])
            return
        # The same leaves take the new parts; what is too much goes to the last.
        if len(fresh) > room:
            tail = fresh[room - 1:]
            fresh = [*fresh[:room - 1], ("".join(t for t, _ in tail), sum(n for _, n in tail))]
        for k in range(room):
            t, n = fresh[k] if k < len(fresh) else ("", 0)
            self.texts[low + k] = t
            self.chars[self.width + low + k], self.tokens[self.width + low + k] = len(t), n
        touched = {(self.width + low + k) // 2 for k in range(room)}
        while touched and max(touched) >= 1:
            for k in touched:
                if k:
                    self._sum(k)
            touched = {k // 2 for k in touched if k > 1}

    def _part(self, low: int, high: int) -> list[tuple[str, int]]:
        return [(self.texts[k], self.tokens[self.width + k]) for k in range(low, high) if self.texts[k]]


_LEAVES = pa.list_(pa.struct([("text", pa.string()), ("tokens", pa.int64())]))
_SLICE = 500  # documents whose trees are held at once


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (batch.slice(low, _SLICE) for batch in batches for low in range(0, batch.num_rows, _SLICE))


def _tree(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for part in _slices(batches):
            trees = pa.array([[{"text": t, "tokens": n} for t, n in CountTree(x.as_py(), enc).leaves()]
                              for x in part.column("text")], _LEAVES)
            at = part.schema.get_field_index("text")
            yield part.set_column(at, "leaves", trees)
    return run


def count_trees(docs: DataFrame, tokenizer: str, *keep: str) -> DataFrame:
    """``doc_id, leaves``: each document's tree, to be kept in a table between edits; with the
    columns ``keep`` of ``docs`` between the two."""
    rows = docs.select("doc_id", *keep, text_or_empty().alias("text"))
    leaf = T.StructType().add("text", "string").add("tokens", "long")
    return rows.mapInArrow(_tree(tokenizer), T.StructType([*rows.schema.fields[:-1]]).add("leaves", T.ArrayType(leaf)))


_APPLIED = ("doc_id long, leaves array<struct<text: string, tokens: bigint>>, n_tokens_before long, n_edits int, "
            "n_tokens long, n_chars long, n_chars_encoded long")


def _apply(path: str, with_leaves: bool):
    kinds = [("doc_id", pa.int64()), ("leaves", _LEAVES), ("n_tokens_before", pa.int64()), ("n_edits", pa.int32()),
             ("n_tokens", pa.int64()), ("n_chars", pa.int64()), ("n_chars_encoded", pa.int64())]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for part in _slices(batches):
            rows = []
            for doc_id, old, edits in zip(part.column("doc_id").to_pylist(), part.column("leaves"),
                                          part.column("edits"), strict=True):
                tree = CountTree("", enc, [(x["text"], x["tokens"]) for x in old.as_py() or ()])
                before, edits = tree.total(), edits.as_py() or ()
                for e in edits:
                    tree.edit(e["at"] or 0, e["deleted"] or 0, e["inserted"] or "")
                leaves = [{"text": t, "tokens": n} for t, n in tree.leaves()] if with_leaves else None
                rows.append((doc_id, leaves, before, len(edits), tree.total(), tree.length(), tree.encoded))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
    return run


def apply_edits(trees: DataFrame, tokenizer: str, with_leaves: bool = True) -> DataFrame:
    """``doc_id, leaves, n_tokens_before, n_edits, n_tokens, n_chars, n_chars_encoded`` of kept trees
    (``doc_id, leaves``) after each row's ``edits`` (array of ``at, deleted, inserted``)."""
    return trees.select("doc_id", "leaves", "edits").mapInArrow(_apply(tokenizer, with_leaves), _APPLIED)


def edited_token_counts(docs: DataFrame, tokenizer: str, with_text: bool = False) -> DataFrame:
    """Tokens of every row of ``docs`` (``doc_id``, ``text``, ``edits``) before and after its edits,
    and the characters that the edits made it encode again. The trees are stored in between."""
    trees = materialise(count_trees(docs, tokenizer, "edits"), "count-trees")
    text = F.array_join(F.transform("leaves", lambda x: x["text"]), "")
    return apply_edits(trees, tokenizer, with_text).select(
        "doc_id", F.col("n_tokens_before").alias("n_tokens"), "n_edits", F.col("n_tokens").alias("n_tokens_after"),
        F.col("n_chars").alias("n_chars_after"), "n_chars_encoded", *([text.alias("text_after")] if with_text else []))


def sample_edits(n_edits: int = 4, most: int = 40) -> Column:
    """Edits that follow from a document's id and text alone: each deletes up to ``most``
    characters at a place and inserts as many of another place's."""
    text = text_or_empty()
    n = F.char_length(text) + 1

    def number(k: int, which: int, below: Column) -> Column:
        return F.pmod(F.xxhash64("doc_id", F.lit(k), F.lit(which)), below.cast("long")).cast("int")

    return F.array(*[
        F.struct(number(k, 0, n).alias("at"), number(k, 1, F.lit(most)).alias("deleted"),
                 F.substring(text, number(k, 2, n) + 1, number(k, 3, F.lit(most))).alias("inserted"))
        for k in range(n_edits)])
