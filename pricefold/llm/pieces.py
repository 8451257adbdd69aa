"""Byte-level BPE over the pieces that the tokenizer's split pattern makes, which no token crosses.

What a piece gives is remembered from task to task, since most words come again.
"""

from __future__ import annotations

import json
import re
import sys
import types
from collections.abc import Callable

import ahocorasick

# Fixed value: the split pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# A text of other signs than these takes the general way. An apostrophe does too, as it may start a contraction.
_OTHER = re.compile(r"[^ -&(-~\nÀ-ÖØ-öø-ÿ]")
# The split pattern for such texts without two white spaces in a row.
_SIMPLE = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[!-/:-@[-`{-~]+|\s")
_CUT = re.compile(r"(?<=[!-~]) (?=[!-~])")
_MOST_REMEMBERED = 500_000


def plain_pieces(text: str) -> list[str] | None:
    """The pieces of a text, in order, or None if it takes the full split pattern to find them."""
    if _OTHER.search(text) or "  " in text or "\n " in text or " \n" in text or "\n\n" in text:
        return None
    return _SIMPLE.findall(text)


def cut(text: str) -> list[str]:
    """A text cut before single spaces between printable ASCII signs, where all its prefixes are cut too."""
    first, *others = _CUT.split(text)
    return [first, *[f" {part}" for part in others]]


class Remembered(dict):
    """What ``make`` gives for a key. When there are too many, those not asked for since the last time go."""

    def __init__(self, make: Callable[[str], bytes], most: int = _MOST_REMEMBERED):
        super().__init__()
        self.make = make
        self.most = most
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        made = self.older.get(key)
        made = self[key] = self.make(key) if made is None else made
        return made

    def joined(self, keys: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, keys))


def kept_by_worker(kind: str, path: str, make: Callable[[str], object]) -> object:
    """What ``make(path)`` gives, made once for all tasks of a Python worker process, with what it remembers."""
    kept = sys.modules.setdefault("_pricefold_kept", types.ModuleType("_pricefold_kept")).__dict__
    if (kind, path) not in kept:
        kept[kind, path] = make(path)
    return kept[kind, path]


def forget_kept() -> None:
    """Give the memory back, for tasks of other operators that come to the same worker."""
    sys.modules.pop("_pricefold_kept", None)


class Merges:
    """The merges of a byte-level BPE vocabulary, as rules on token numbers in merge order."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        shown = shown_bytes()
        model = described["model"]
        self.special = [token["content"] for token in described["added_tokens"] if token["special"]]
        # Bytes first, then one token for each merge, so that a smaller number means an earlier merge.
        self.bytes = [bytes([value]) for value in range(256)]
        self.number = {token: place for place, token in enumerate(self.bytes)}
        self.halves = [(value, value) for value in range(256)]
        self.merged: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            halves = merge.split(" ") if isinstance(merge, str) else merge
            left, right = (bytes(shown[sign] for sign in half) for half in halves)
            pair = self.number[left], self.number[right]
            place = len(self.bytes)
            self.merged[pair] = place
            self.halves.append(pair)
            self.bytes.append(left + right)
            self.number.setdefault(left + right, place)
        # Finds the tokens that end at each byte of a piece.
        self.found = ahocorasick.Automaton()
        for token, place in self.number.items():
            self.found.add_word(token.decode("latin-1"), (place, len(token)))
        self.found.make_automaton()
        self._fits: dict[int, bool] = {}

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are when their bytes stand next to each other."""
        if len(self._fits) > 1_000_000:
            self._fits.clear()
        known = self._fits[left << 32 | right] = self._stays(left, right)
        return known

    def _stays(self, left: int, right: int) -> bool:
        """Undo the merges on both sides of the border, latest first.

        At no moment may the border pair have a merge that comes before the one just undone: it would have been
        done first. Of two equal merges the left one is done first.
        """
        before = len(self.bytes)
        while True:
            joint = self.merged.get((left, right))
            if joint is not None and joint < before:
                return False
            if left < 256 and right < 256:
                return True
            if left > right:
                before, left = left, self.halves[left][1]
            else:
                before, right = right + 1, self.halves[right][0]

    def prefix_counts(self, piece: bytes) -> list[int]:
        """Tokens of each prefix of a piece that the split pattern does not cut, from the empty one on.

        The last token of a prefix is the one that fits the last token of the prefix before it; there is just one.
        So each count is the count of a shorter prefix plus one.
        """
        remembered = self._fits.get
        last, counts = [-1], [0]
        solved = 0
        for place, (token, length) in self.found.iter(piece.decode("latin-1")):
            if place < solved:
                continue
            start = place + 1 - length
            if start:
                fitting = remembered(last[start] << 32 | token)
                if fitting is None:
                    fitting = self.fits(last[start], token)
                if not fitting:
                    continue
            last.append(token)
            counts.append(counts[start] + 1)
            solved = place + 1
        return counts


def shown_bytes() -> dict[str, int]:
    """The sign that stands for each byte in the vocabulary file: itself if it is printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [value for value in range(256) if value not in plain]
    return {chr(value): value for value in plain} | {chr(256 + rank): value for rank, value in enumerate(other)}
