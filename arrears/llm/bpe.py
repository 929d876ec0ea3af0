"""Byte-level BPE ids of whole texts, with the ids of every word kept at hand.

Text is cut at single spaces, where the tokenizer cuts too. The ids of a word
with its space before it are looked up, and the words not met yet are encoded
in one call. Texts with several white-space characters in a row, or some at
either end, take the encoder itself. A special string has an id of its own and
parts the text around it, as the tokenizer has it.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Mapping, Sequence
from functools import cached_property

import numpy as np
import regex
import tiktoken

# The strings that the tokenizer's file gives an id of their own.
SPECIALS = {"<|endoftext|>": 50256}

# The splitting pattern looks ahead after white space, which fails on very long runs of it.
_LONG_GAP = regex.compile(r"\p{White_Space}{10000,}")


class Encoder:
    """``ranks`` is the path of a rank file; ``pattern`` splits text before its merges.

    ``specials`` are strings with an id of their own. At most ``words`` words
    are held; beyond that the store starts anew.
    """

    def __init__(
        self, ranks: str, pattern: str, words: int = 400_000, specials: Mapping[str, int] = SPECIALS
    ) -> None:
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.table = table
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.specials = specials
        self.parts = re.compile("|".join(f"({re.escape(s)})" for s in specials) or r"(?!)")
        self.sizes = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            self.sizes[rank] = len(token)
        self.words = words
        self.known: dict[str, bytes] = {}

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        split = [t.split(" ") if _single_gaps(t) and not self.parts.search(t) else None for t in texts]
        wanted: set[str] = set()
        for words in split:
            if words:
                wanted.update(words[1:])
        self._learn(wanted)
        known = self.known.__getitem__
        return [
            self._whole(text) if words is None else self._whole(words[0]) + b"".join(map(known, words[1:]))
            for text, words in zip(texts, split)
        ]

    @cached_property
    def one_piece(self) -> tiktoken.Encoding:
        """The same merges over a text that is not split."""
        return tiktoken.Encoding("piece", pat_str=r"(?s).+", mergeable_ranks=self.table, special_tokens={})

    def _whole(self, text: str) -> bytes:
        out, at = [], 0
        for found in self.parts.finditer(text):
            out += [self._between(text[at : found.start()]), self.specials[found[0]].to_bytes(4, "little")]
            at = found.end()
        return b"".join([*out, self._between(text[at:])])

    def _between(self, text: str) -> bytes:
        """Ids of a text without specials. Of white space before a word all but the last
        character is one piece, which is cut out where it is long."""
        out, at = [], 0
        for gap in _LONG_GAP.finditer(text):
            end = gap.end() if gap.end() == len(text) else gap.end() - 1
            out += self.encoding.encode_ordinary(text[at : gap.start()])
            out += self.one_piece.encode_ordinary(text[gap.start() : end])
            at = end
        return np.array(out + self.encoding.encode_ordinary(text[at:]), "<u4").tobytes()

    def _learn(self, wanted: set[str]) -> None:
        new = list(wanted.difference(self.known))
        if len(self.known) + len(new) > self.words:
            self.known, new = {}, list(wanted)
        if not new:
            return
        ids = np.array(self.encoding.encode_ordinary(" " + " ".join(new)), "<u4")
        ends = np.cumsum(np.array([len(word.encode()) + 1 for word in new]))
        cuts = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1
        raw, at = ids.tobytes(), 0
        for word, cut in zip(new, (cuts * 4).tolist()):
            self.known[word] = raw[at:cut]
            at = cut


def _single_gaps(text: str) -> bool:
    """Whether white space is single spaces and line ends between words."""
    return len(text.split()) == text.count(" ") + text.count("\n") + 1
