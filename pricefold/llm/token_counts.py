"""Operator 1: token counts of every prefix, so that truncation and budgets need no second encoding."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from operator import sub

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.llm.pieces import PATTERN, Merges, Remembered, cut, kept_by_worker, plain_pieces

_PIECE = regex.compile(PATTERN)
_SPACE = regex.compile(r"\s+")
_RUN = regex.compile(r"\s\s")
_CONTRACTIONS = frozenset(["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"])


class PrefixCounter:
    """Token counts of all prefixes of a text, by code points."""

    def __init__(self, tokenizer: str):
        self.merges = Merges(tokenizer)
        self.special = regex.compile("|".join(map(regex.escape, self.merges.special)) or r"(?!)")
        self.steps = Remembered(self._steps)
        self.pieces = Remembered(self._piece_steps)

    def steps_of(self, text: str) -> np.ndarray:
        """By how many tokens each code point lengthens the encoding; it can also shorten it."""
        if self.merges.special and "<|" in text and self.special.search(text):
            return self._steps_with_special(text)
        pieces = plain_pieces(text)
        found = self.steps.joined(cut(text)) if pieces is None else self.pieces.joined(pieces)
        return np.frombuffer(found, np.int16)

    def _steps_with_special(self, text: str) -> np.ndarray:
        """The string of a special token is one token; its own prefixes are ordinary text."""
        parts, start, tokens = [], 0, 0
        for found in self.special.finditer(text):
            ordinary = np.frombuffer(self._steps(text[start : found.end()]), np.int16).copy()
            before = int(ordinary[: found.start() - start].sum(dtype=np.int64))
            # The whole string adds one token to what stands before it, whatever its last prefix counts.
            ordinary[-1] = before + 1 - int(ordinary[:-1].sum(dtype=np.int64))
            parts.append(ordinary)
            start = found.end()
        parts.append(np.frombuffer(self._steps(text[start:]), np.int16))
        return np.concatenate(parts)

    def _steps(self, text: str) -> bytes:
        pieces = _PIECE.findall(text)
        if _RUN.search(text) is None and _CONTRACTIONS.isdisjoint(pieces):
            return self.pieces.joined(pieces)
        return self._steps_around_space(text)

    def _steps_around_space(self, text: str) -> bytes:
        counts = np.zeros(len(text) + 1, np.int64)
        base = 0
        pieces = [(found.start(), found.end()) for found in _PIECE.finditer(text)]
        for place, (start, end) in enumerate(pieces):
            piece = text[start:end]
            lent = start > 0 and _is_space(text[start - 1]) and _is_space(text[start])
            if _is_space(piece):
                # A prefix that ends in white space has all of the run as one piece, though the whole text gives the
                # last of the run to what follows.
                run = end + (place + 1 < len(pieces) and _is_space(text[end]))
                if not lent:
                    counts[start + 1 : run + 1] = base + np.array(self._counts(text[start:run])[1:])
                base += int(self._counts(piece)[-1])
                continue
            own = np.array(self._counts(piece))
            if piece in _CONTRACTIONS:
                own[1:-1] = np.arange(1, len(piece))
            # Where a run of white space lends its last sign, that prefix is counted already.
            counts[start + 1 + lent : end + 1] = base + own[1 + lent :]
            base += int(own[-1])
        steps = np.diff(counts)
        if len(steps) and (steps.max() > 32767 or steps.min() < -32768):
            raise OverflowError("one code point changes the token count by more than 32767")
        return steps.astype(np.int16).tobytes()

    def _piece_steps(self, piece: str) -> bytes:
        counts = self._counts(piece)
        return array("h", map(sub, counts[1:], counts)).tobytes()

    def _counts(self, piece: str) -> list[int]:
        """Tokens of the prefixes of a piece, by code points."""
        data = piece.encode()
        counts = self.merges.prefix_counts(data)
        if len(data) == len(piece):
            return counts
        return [count for count, byte in zip(counts, data + b" ") if byte & 0xC0 != 0x80]


def _is_space(text: str) -> bool:
    return text[0] <= " " and _SPACE.fullmatch(text) is not None if text.isascii() else _SPACE.fullmatch(text) is not None


def packed(steps: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(steps.tobytes())


def unpacked(prefixes: bytes) -> np.ndarray:
    """Token counts of the prefixes of 0, 1, 2 … code points, from what ``prefix_counts`` stores."""
    steps = np.frombuffer(zstandard.ZstdDecompressor().decompress(prefixes), np.int16)
    return np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])


def longest_within(steps: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix that has at most ``budget`` tokens."""
    if not len(steps):
        return 0
    fitting = np.flatnonzero(np.cumsum(steps, dtype=np.int64) <= budget)
    return int(fitting[-1]) + 1 if len(fitting) else 0


def prefix_counts(docs: DataFrame, tokenizer: str, budget: int = 512, id_column: str = "doc_id") -> DataFrame:
    """One row for each row of ``docs``: id, n_bytes, n_tokens, within_budget, prefixes.

    ``tokenizer`` is the path of a byte-level BPE ``tokenizer.json``, the same on all executors. ``prefixes`` packs the
    exact token count of every prefix of the text (see ``unpacked``), from which any truncation or budget question is
    answered; ``within_budget`` answers one: the code points of the longest prefix of at most ``budget`` tokens. The
    strings of special tokens count as one token each; nothing is added at the ends.

    A null text counts as empty: 0 bytes, 0 tokens, 0 code points. Ids may be null or repeat. One pass, no shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept_by_worker("prefix counter", tokenizer, PrefixCounter)
        for batch in batches:
            sizes, totals, within, prefixes = [], [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                steps = counter.steps_of(text)
                sizes.append(len(text.encode()))
                totals.append(int(steps.sum(dtype=np.int64)))
                within.append(longest_within(steps, budget) if totals[-1] > budget else len(text))
                prefixes.append(packed(steps))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(values, pa.int64()) for values in (sizes, totals, within)],
                 pa.array(prefixes, pa.binary())],
                names=["id", "n_bytes", "n_tokens", "within_budget", "prefixes"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col("text"))
    return rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long, within_budget long, prefixes binary")
