"""Counts over one text, each made when first asked for."""

from __future__ import annotations

from functools import cached_property

import numpy as np

from .common import Rolling, word_hashes, words

_ROLLING = Rolling()
_SYMBOLS = list(b"#*$%&|<>")
_BLANKS = [9, 10, 11, 12, 13, 32]
_STOPS = list(b".!?;:,")


class Page:
    """A text with lazily made counts; a null text is an empty one."""

    def __init__(self, text: str | None) -> None:
        self.text = text or ""
        self.data = self.text.encode()

    @cached_property
    def histogram(self) -> np.ndarray:
        return np.bincount(np.frombuffer(self.data, np.uint8), minlength=256)

    @cached_property
    def words(self) -> list[bytes]:
        return words(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points that are not one of the six blanks."""
        return len(self.text) - int(self.histogram[_BLANKS].sum())

    @cached_property
    def n_symbols(self) -> int:
        return int(self.histogram[_SYMBOLS].sum())

    @cached_property
    def n_upper(self) -> int:
        return int(self.histogram[65:91].sum())

    @cached_property
    def n_lower(self) -> int:
        return int(self.histogram[97:123].sum())

    @cached_property
    def n_digits(self) -> int:
        return int(self.histogram[48:58].sum())

    @cached_property
    def n_marks(self) -> int:
        """Exclamation and question marks."""
        return int(self.histogram[33] + self.histogram[63])

    @cached_property
    def n_stops(self) -> int:
        return int(self.histogram[_STOPS].sum())

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines that hold a word."""
        return [line for line in self.data.split(b"\n") if line.strip(b" \t\r\x0b\x0c")]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, _ROLLING)

    @cached_property
    def n_distinct_words(self) -> int:
        return len(set(self.words))

    @cached_property
    def n_adjacent(self) -> int:
        """Words equal to the word before."""
        return int((self.hashes[1:] == self.hashes[:-1]).sum())

    def repeated(self, width: int) -> int:
        """Words in windows of ``width`` words whose sequence occurs twice or more in the text."""
        h = self.hashes
        if len(h) <= width:
            return 0
        windows = _ROLLING.windows(_ROLLING.prefix(h), width)
        order = np.argsort(windows, kind="stable")
        same = windows[order[1:]] == windows[order[:-1]]
        if not same.any():
            return 0
        again = np.zeros(len(windows), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        step = np.zeros(len(h) + 1, np.int32)
        at = np.flatnonzero(again)
        step[at] += 1
        step[at + width] -= 1
        return int((np.cumsum(step[:-1]) > 0).sum())

    @cached_property
    def n_repeat_words(self) -> int:
        return self.repeated(8)
