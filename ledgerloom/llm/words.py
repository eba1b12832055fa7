"""Words of whole texts as arrays: where they lie, and 64-bit hashes of words and word runs.

Everything works on the UTF-8 bytes of one text at a time with array operations. Hashes are
polynomials modulo 2**64 over the bytes, mixed afterwards; they steer candidate search, and a
comparison of words decides wherever a result depends on equality.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_RUN = np.uint64(0xD6E8FEB86659FD93)
_BLOCK = 1 << 20


def _separators(codes) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[list(codes)] = True
    return found


#: space, tab, line feed, vertical tab, form feed, carriage return
WHITE = _separators([0x20, *range(0x09, 0x0E)])
#: every ASCII character that is neither a letter nor a digit
NON_WORD = _separators(c for c in range(128) if not chr(c).isalnum())

_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, _BLOCK)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def as_bytes(text: str | None) -> np.ndarray:
    # lone surrogates cannot come from Parquet, but must not stop a job either
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def spans(data: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where words start and end (exclusive)."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~separators[data]
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per word; a long text is worked off in blocks of whole words."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, base + _BLOCK, side="right")))
        size = int(ends[last - 1]) - base
        up, down = _power_table(size + 1)
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum((data[base : base + size].astype(np.uint64) + np.uint64(1)) * up[:size], out=total[1:])
        a, b = starts[first:last] - base, ends[first:last] - base
        out[first:last] = (total[b] - total[a]) * down[a] + (b - a).astype(np.uint64)
        first = last
    return mix(out)


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for every ``k`` consecutive words; none when there are fewer."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = words[:n].copy()
    for j in range(1, k):
        total *= _RUN
        total += words[j : j + n]
    return mix(total)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """As ``run_hashes``; a text of fewer than ``k`` words, but one at least, is one shingle."""
    return run_hashes(words, min(k, max(1, len(words))))


def plain_words(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts, ends and hashes of the lower-cased words between ASCII non-alphanumerics."""
    data = as_bytes((text or "").lower())
    starts, ends = spans(data, NON_WORD)
    return data, starts, ends, word_hashes(data, starts, ends)
