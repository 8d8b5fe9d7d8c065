"""Plain versions that several tests share."""

import re
from collections import Counter


def plain_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def plain_shingles(text, n=5):
    words = plain_words((text or "").lower())
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))
