"""Ids of the word vocabulary: whole tokens by lookup, everything else merged once per pre-token."""

from __future__ import annotations

import json
import re
import struct
import sys
import types
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

WORD_BPE = "word_bpe_49k.json"

#: Words, and merged pre-tokens, that a worker remembers.
REMEMBERED = 600_000

#: Characters below this are their own composed form and keep their class in every Unicode version.
_STABLE = 0x180


def _of(major: str) -> str:
    return "".join(re.escape(c) for c in map(chr, range(0x21, _STABLE)) if unicodedata.category(c)[0] == major)


#: What is neither a tab, a line end nor a printable character below that; and the letters
#: whose lower case is two characters.
_OTHER = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-\u012f\u0131-\u0148\u014a-\u017f]").search
_LETTER, _NUMBER = _of("L"), _of("N")
#: The tokenizer's own pattern for pre-tokens, with letters and numbers spelled out.
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+").findall


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def whole_tokens(path: str) -> dict[str, int]:
    """The vocabulary strings that, encoded alone, are proven to be that one token."""
    end, stands = "</w>", _byte_characters()
    words = {}
    with open(path, encoding="utf-8") as file:
        for entry, number in json.load(file)["model"]["vocab"].items():
            if entry.endswith(end) and all(c in stands for c in entry[: -len(end)]):
                try:
                    words[bytes(stands[c] for c in entry[: -len(end)]).decode()] = number
                except UnicodeDecodeError:
                    pass
    tokenizer = Tokenizer.from_file(path)
    proofs = tokenizer.encode_batch(list(words), add_special_tokens=False)
    return {w: n for (w, n), proof in zip(words.items(), proofs) if proof.ids == [n] and _PIECES(w) == [w]}


class Words:
    """The ids of texts, as packed little-endian unsigned 32-bit numbers, or their counts.

    Pre-tokens never reach across white space, and each is merged without regard to its
    neighbours, so a word between spaces always has the same ids. Texts with characters
    whose normal form or class depends on the Unicode version, and texts that may hold
    special strings, go to the library whole.
    """

    def __init__(self, path: str, whole: dict[str, int]):
        self.tokenizer = Tokenizer.from_file(path)
        self.merger = Tokenizer.from_file(path)  # its merges alone, for pre-tokens already cut
        self.merger.normalizer = self.merger.pre_tokenizer = None
        self.stands = {b: c for c, b in _byte_characters().items()}
        self.whole = {w: struct.pack("<I", n) for w, n in whole.items()}
        self.merged: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [
            struct.pack(f"<{len(e.ids)}I", *e.ids)
            for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]

    def _merge(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of pre-tokens, by the library's merges."""
        stands = self.stands
        plain = [p if p.isascii() else p.encode().decode("latin-1").translate(stands) for p in pieces]
        merged = self.merger.encode(plain, is_pretokenized=True, add_special_tokens=False)
        numbers = np.array(merged.ids, "<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(np.array(merged.word_ids, np.int64), minlength=len(pieces)))
        return {p: numbers[a:b] for p, a, b in zip(pieces, [0, *ends.tolist()], ends.tolist())}

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """The ids of new words: whole tokens by lookup, the other pre-tokens merged."""
        whole, merged = self.whole, self.merged
        pieces = [[w] if w in whole else _PIECES(w) for w in new]
        rest = list({p for row in pieces for p in row if p not in whole and p not in merged})
        found = self._merge(rest) if rest else {}
        if len(merged) < REMEMBERED:
            merged.update(found)
        learned = {}
        for word, row in zip(new, pieces):
            learned[word] = b"".join([whole.get(p) or found.get(p) or merged[p] for p in row])
        return learned

    def _each(self, texts: list[str]) -> Iterator[list[bytes]]:
        """The ids of every text, word by word, or by the library in one."""
        split = [None if "<|" in t or _OTHER(t) else t.lower().split() for t in texts]
        known = self.words
        parts = [[known.get(w) for w in words] if words is not None else None for words in split]
        gaps = [k for k, row in enumerate(parts) if row is not None and None in row]
        new = self._learn(list({w for k in gaps for w, part in zip(split[k], parts[k]) if part is None}))
        for k in gaps:
            parts[k] = [new[w] if part is None else part for w, part in zip(split[k], parts[k])]
        if len(known) < REMEMBERED:
            known.update(new)
        others = iter(self._library([t for t, words in zip(texts, split) if words is None]))
        for row in parts:
            yield [next(others)] if row is None else row

    def ids(self, texts: list[str]) -> list[bytes]:
        return [b"".join(parts) for parts in self._each(texts)]

    def counts(self, texts: list[str]) -> list[int]:
        return [sum(map(len, parts)) // 4 for parts in self._each(texts)]


def words_of_worker(path: str, whole: dict[str, int]) -> Words:
    """The ``Words`` of this Python worker: later tasks of the process know what earlier ones learned.

    Kept in a module of its own, as functions of this package reach workers by value; bounded
    by ``REMEMBERED`` like that of a single task.
    """
    state = sys.modules.setdefault("_hearthline_worker", types.ModuleType("_hearthline_worker")).__dict__
    if path not in state:
        state[path] = Words(path, whole)
    return state[path]


def path_of(name: str = WORD_BPE) -> str:
    return public_tokenizers.path(name)
