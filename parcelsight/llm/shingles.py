"""Word shingles as 64-bit numbers, for many texts at once, in numpy.

Words are what stands between blanks (space and the ASCII control blanks). A shingle is
WORDS words in a row; a text of fewer words has one shingle of all its words, and a
text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
#: Texts of about this many bytes are worked on together.
BLOCK = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_ODD = [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (a one-to-one map)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers_to(n: int) -> np.ndarray:
    """Powers of the base and of its inverse modulo 2**64."""
    both = np.empty((2, n), np.uint64)
    both[:, 0] = 1
    both[0, 1:], both[1, 1:] = _BASE, pow(_BASE, -1, 1 << 64)
    return np.multiply.accumulate(both, axis=1, out=both)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of the text it stands in."""
    joined = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    blank = _BLANK[joined]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _powers_to(len(joined))
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * power, out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    first = np.cumsum([1] + [len(t) + 1 for t in texts])
    owners = np.searchsorted(first, starts, side="right") - 1
    return mix(hashes), owners


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every shingle in place order, repeated ones too, and the number of its text."""
    words, owners = word_hashes(texts)
    n = len(words)
    total = np.zeros(n, np.uint64)
    for j, odd in enumerate(_ODD[: min(n, WORDS)]):
        same = owners[j:] == owners[: n - j]
        total[: n - j] += np.where(same, words[j:] * np.uint64(odd), np.uint64(0))
    # A start counts if all its words are there, or if it starts a short text.
    full = np.zeros(n, bool)
    if n >= WORDS:
        full[: n - WORDS + 1] = owners[WORDS - 1 :] == owners[: n - WORDS + 1]
    opens = np.ones(n, bool)
    opens[1:] = owners[1:] != owners[:-1]
    taken = full | opens
    return mix(total[taken]), owners[taken]


def counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in order of their number: shingle, text, count."""
    numbers, owners = shingles(texts)
    order = np.lexsort((numbers, owners))
    numbers, owners = numbers[order], owners[order]
    new = np.ones(len(numbers), bool)
    new[1:] = (numbers[1:] != numbers[:-1]) | (owners[1:] != owners[:-1])
    at = np.flatnonzero(new)
    return numbers[at], owners[at], np.diff(np.append(at, len(numbers)))


def blocks(texts: list[bytes], size: int = BLOCK) -> Iterator[list[bytes]]:
    """Runs of texts of about the given bytes; a longer text stands alone."""
    block, used = [], 0
    for text in texts:
        if block and used + len(text) > size:
            yield block
            block, used = [], 0
        block.append(text)
        used += len(text)
    if block:
        yield block
