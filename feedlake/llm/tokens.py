"""Byte-level BPE ids of a public tokenizer, with a bounded cache of words.

The ids are those of the ``tokenizers`` file. Its vocabulary and merges are run
by ``tiktoken``, which is several times faster; text with characters beyond
Latin letters, whose classes may differ between the two libraries' Unicode
tables, goes to ``tokenizers`` itself.

A text may be cut where the two characters beside the cut alone make sure that
no id spans it, and its parts encoded one by one; parts repeat, and the cache
keeps their numbers of ids. Such cuts are the tokenizer's own pre-token
boundaries: before white space that follows a character of another kind, and in
longer parts between letters, digits and signs (but not after an apostrophe,
which may begin a contraction). A long run of letters is one pre-token; it is
cut between two letters whose bytes at the cut stand side by side in no entry of
the vocabulary, so that no merge reaches across.
"""

from __future__ import annotations

import json
import re
import sys
from array import array

import numpy as np

CACHE_PARTS = 300_000
LONG_PART = 64    # characters from which on a part is cut further
SHORT_PART = 16   # characters that such a cut leaves at least
# Characters whose kind is the same in all versions of Unicode: letters, digits, signs. White space
# that some tables count otherwise is nowhere beside a cut.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
_SIGNS = "!-&(-/:-@\\[-`{-~\u3001\u3002\u300c-\u300f\uff01\uff0c\uff1a\uff1b\uff1f"  # without the apostrophe
_SPACE_CUT = re.compile("(?<=[^\\s\u180e\u200b\ufeff])(?=[ \t-\r\u3000])")
_KIND_CUT = re.compile(f"(?<=[{_LETTERS}])(?=[0-9'{_SIGNS}])|(?<=[0-9])(?=[{_LETTERS}'{_SIGNS}])|"
                       f"(?<=[{_SIGNS}])(?=[0-9{_LETTERS}])")
_LETTER_PAIR = re.compile(f"(?<=[{_LETTERS}])(?=[{_LETTERS}])")


assert sys.byteorder == "little" and array("I").itemsize == 4
_LAST_LATIN = "\u024f"


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable
    ones stand for themselves, the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Encoder:
    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        letters = _byte_letters()
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        vocabulary = content["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.added_in = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()
                 if all(c in letters for c in token) and token != "<|endoftext|>"}
        self.fast = tiktoken.Encoding("byte level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.parts: dict[str, int] = {}
        self.beside = np.zeros((256, 256), bool)  # bytes that stand side by side in an entry
        for token in ranks:
            data = np.frombuffer(token, np.uint8)
            self.beside[data[:-1], data[1:]] = True

    def encode(self, text: str) -> list[int]:
        if text.isascii() or max(text) <= _LAST_LATIN:
            return self.fast.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids, as the file gives them without special tokens added:
        the string of an added token that stands in the text has that token's id."""
        if self.added_in is None or not any(t in text for t in self.added):
            return array("I", self.encode(text)).tobytes()
        out = array("I")
        for part in self.added_in.split(text):
            out.extend([self.added[part]] if part in self.added else self.encode(part))
        return out.tobytes()

    def _known(self, words: list[str]) -> list[int]:
        """Number of ids of each word as it stands after a space; 0: it can't be cut off there, or is long."""
        out = list(map(self.parts.get, words))
        if None not in out:
            return out
        if len(self.parts) > CACHE_PARTS:
            self.parts.clear()
        for i, w in enumerate(words):
            if out[i] is None:
                sound = w and not w[0].isspace() and not w[-1].isspace() and len(w) <= LONG_PART
                out[i] = len(self.encode(" " + w)) if sound else 0
                if len(w) <= LONG_PART:
                    self.parts[w] = out[i]
        return out

    def _cuts(self, part: str) -> list[int]:
        """Places in a part where it may be cut."""
        cuts = [m.start() for m in _KIND_CUT.finditer(part)]
        at = np.fromiter((m.start() for m in _LETTER_PAIR.finditer(part)), np.int64)
        if len(at):
            ends = np.cumsum(np.fromiter((len(c.encode()) for c in part), np.int64, len(part)))[at - 1]
            data = np.frombuffer(part.encode(), np.uint8)
            cuts = sorted([*cuts, *at[~self.beside[data[ends - 1], data[ends]]].tolist()])
        return cuts

    def _divided(self, text: str) -> list[str]:
        out = []
        for part in _SPACE_CUT.split(text):
            low = 0
            if len(part) > LONG_PART:
                for at in self._cuts(part):
                    if at - low >= SHORT_PART:
                        out.append(part[low:at])
                        low = at
            out.append(part[low:])
        return out

    def part_counts(self, text: str) -> tuple[list[str], list[int]]:
        """Parts that join to the text, each encoded on its own, and their numbers of ids. A text
        that begins at a cut of a longer one is cut as it would be there."""
        spaced = text[:1] == " "
        first, *words = ["", *text[1:].split(" ")] if spaced else text.split(" ")
        counts = self._known(words)
        if 0 not in counts and (spaced or 0 < len(first) <= LONG_PART and not first[-1].isspace()):
            if spaced:
                return [" " + w for w in words], counts
            return [first, *(" " + w for w in words)], [len(self.encode(first)), *counts]
        parts, counts = self._divided(text), []
        if len(self.parts) > CACHE_PARTS:
            self.parts.clear()
        for p in parts:
            # The cache's keys stand after a space; a key with a space in front is a part as it is.
            key = p[1:] if len(p) > 1 and p[0] == " " and not p[1].isspace() and not p[-1].isspace() else " " + p
            n = self.parts.get(key)
            if not n:
                n = len(self.encode(p))
                if len(p) <= LONG_PART:
                    self.parts[key] = n
            counts.append(n)
        return parts, counts


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
