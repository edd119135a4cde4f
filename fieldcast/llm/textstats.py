"""Figures of one text: words, lines, symbols and repeated three-word windows."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from fieldcast.session import send_with_tasks

send_with_tasks(__name__)

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"


class TextFigures(NamedTuple):
    words: list[bytes]
    codes: np.ndarray  # each word's place among the distinct words
    distinct: list[bytes]
    word_chars: int
    n_symbols: int
    n_lines: int  # lines that hold a word
    n_dup_lines: int
    n_repeat_words: int


def figures(text: str | None) -> TextFigures:
    """All figures of a text; a null text has none, like an empty one."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    place: dict[bytes, int] = {}
    codes = np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, len(words))
    spaces = len(data) - len(data.translate(None, SPACES))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip()]
    return TextFigures(
        words, codes, list(place), len(text) - spaces, symbols, len(lines), len(lines) - len(set(lines)),
        repeat_words(codes, len(place)),
    )


def repeat_words(codes: np.ndarray, distinct: int) -> int:
    """Words in three-word windows that are found twice or more, the first one included."""
    if len(codes) < 4:
        return 0
    pairs = codes[:-1] * distinct + codes[1:]
    if distinct >= 1 << 21:  # three codes don't fit in 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, count = np.unique(pairs[:-1] * distinct + codes[2:], return_inverse=True, return_counts=True)
    again = count[which] > 1
    covered = np.zeros(len(codes), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())
