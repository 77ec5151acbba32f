"""Word shingles of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np

SHINGLE_WORDS = 5
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, b in enumerate((_BASE, _BACK)):
            p = np.full(n, np.uint64(b), np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of the word's text); texts have single spaces between words."""
    raw = np.frombuffer("\n".join([*texts, ""]).encode("utf-8", "surrogatepass"), np.uint8)
    gap = np.flatnonzero((raw == 32) | (raw == 10))
    start = np.concatenate([[0], gap[:-1] + 1])
    up, down = _powers(len(raw) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1])])
    h = mix((sums[gap] - sums[start]) * down[start] + np.uint64(1))
    doc = np.cumsum(raw[gap] == 10) - (raw[gap] == 10)
    full = gap > start
    return h[full], doc[full]


def shingles(texts: list[str], words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, count) of the distinct shingles, sorted by both; a text with fewer words than a
    shingle has one, of all its words, and a text without words none."""
    h, doc = word_hashes(texts)
    n = len(h) - words + 1
    if n > 0:
        s = np.zeros(n, np.uint64)
        for k in range(words):
            s = mix(s * np.uint64(_BASE) + h[k:k + n])
        whole = doc[:n] == doc[words - 1:]
        s, d = s[whole], doc[:n][whole]
    else:
        s, d = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n_words = np.bincount(doc, minlength=len(texts))
    short = np.flatnonzero((n_words > 0) & (n_words < words))
    if len(short):
        own = [int.from_bytes(blake2b(texts[i].strip().encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for i in short]
        s, d = np.concatenate([s, np.array(own, np.uint64)]), np.concatenate([d, short])
    order = np.lexsort((s, d))
    s, d = s[order], d[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    return d[at], s[at], np.diff(np.concatenate([at, [len(s)]]))


def similarities(left: list[str], right: list[str], words: int = SHINGLE_WORDS) -> np.ndarray:
    """Weighted Jaccard similarity of the shingles of left[i] and right[i]; 0 where both have none."""
    (da, sa, ca), (db, sb, cb) = shingles(left, words), shingles(right, words)
    d, s, c = np.concatenate([da, db]), np.concatenate([sa, sb]), np.concatenate([ca, cb])
    order = np.lexsort((s, d))
    d, s, c = d[order], s[order], c[order]
    both = np.flatnonzero((s[1:] == s[:-1]) & (d[1:] == d[:-1])) if len(s) else np.zeros(0, int)
    shared = np.bincount(d[both], np.minimum(c[both], c[both + 1]), minlength=len(left))
    total = np.bincount(d, c, minlength=len(left))
    return np.divide(shared, total - shared, out=np.zeros(len(left)), where=total > 0)


SLICE_ROWS = 1000


def row_slices(parts: Iterable) -> Iterator:
    """Record batches in slices of rows, views of them: only a slice's values become Python objects at a time."""
    for part in parts:
        for at in range(0, part.num_rows, SLICE_ROWS):
            yield part.slice(at, SLICE_ROWS)


def batches(texts: list[str], size: int = 1 << 20):
    """Ranges of texts of about ``size`` characters together, one text at least."""
    at = 0
    while at < len(texts):
        to, n = at, 0
        while to < len(texts) and (to == at or n + len(texts[to]) <= size):
            n += len(texts[to])
            to += 1
        yield at, to
        at = to
