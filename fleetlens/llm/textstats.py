"""Word statistics of one text, in NumPy.

A word is a run of characters other than space, tab, line feed, vertical tab,
form feed and carriage return.  ``bytes.split()`` splits at just these six.
"""

from __future__ import annotations

import re

import numpy as np

#: Fixed value: the word pattern of the contracts.
WORD = r"[^\x20\x09-\x0D]+"
#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"

_WORDS = re.compile(WORD)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def str_words(text: str) -> list[str]:
    return _WORDS.findall(text)


def word_ids(words: list) -> tuple[np.ndarray, int]:
    """The words as numbers from 0 in order of first appearance, and how many differ."""
    seen = dict.fromkeys(words)
    number = dict(zip(seen, range(len(seen)), strict=True))
    return np.array(list(map(number.__getitem__, words)), dtype=np.int64), len(seen)


def repeated_words(ids: np.ndarray, n_distinct: int, width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more, first included."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    key, base = ids[:n], max(n_distinct, 1)
    for j in range(1, width):
        if base * n_distinct > 2**62:  # renumber before numbers get too large
            key = np.unique(key, return_inverse=True)[1]
            base = int(key.max()) + 1
        key, base = key * n_distinct + ids[j : j + n], base * n_distinct
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), dtype=bool)
    for j in range(width):
        covered[j : j + n] |= twice
    return int(covered.sum())


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and lines with a word."""
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if _WORDS.search(line):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    return dup, lines


def symbol_count(text: str) -> int:
    return sum(map(text.count, SYMBOLS))


def word_char_count(text: str) -> int:
    return len(text) - sum(map(text.count, " \t\n\v\f\r"))
