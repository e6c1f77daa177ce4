"""Hashes of words and word runs, for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
CHUNK = 2_000_000  # characters hashed at a time inside a task


def blended(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(a hash per word, words per text); words are parted by space, tab, LF, VT, FF and CR."""
    data = np.frombuffer("\n".join(texts).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    gap = np.concatenate([[True], space, [True]])
    first = np.flatnonzero(gap[:-2] & ~gap[1:-1])
    last = np.flatnonzero(~gap[1:-1] & gap[2:]) + 1
    powers = np.cumprod(np.full(len(data) + 1, BASE))
    back = np.cumprod(np.full(len(data) + 1, INVERSE))
    total = np.concatenate([[np.uint64(0)], np.cumsum((data + np.uint64(1)) * powers[:-1])])
    hashed = blended((total[last] - total[first]) * back[first])
    sizes = np.array([len(text.encode("utf-8", "surrogatepass")) + 1 for text in texts])
    ends = np.cumsum(sizes)
    upto = np.searchsorted(first, ends, side="left")
    return hashed, np.diff(np.concatenate([[0], upto]))


def run_hashes(words: np.ndarray, per_text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(a hash per run of ``size`` words, runs per text); a shorter text is one run of all its words."""
    n = len(words)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        shifted = np.zeros(n, dtype=np.uint64)
        shifted[: n - i] = words[i:] if i else words
        total = total * BASE + shifted
    total = blended(total)
    starts = np.cumsum(per_text) - per_text
    place = np.arange(n) - np.repeat(starts, per_text)
    whole = place + size <= np.repeat(per_text, per_text)
    runs = np.where(per_text >= size, per_text - size + 1, np.minimum(per_text, 1))
    found = total[whole | (place == 0)]
    at = np.cumsum(runs) - runs
    for i in np.flatnonzero((per_text > 0) & (per_text < size)):
        value = np.zeros(1, dtype=np.uint64)
        for word in words[starts[i] : starts[i] + per_text[i]]:
            value = value * BASE + word
        found[at[i]] = blended(value + np.uint64(per_text[i]))[0]
    return found, runs


def chunks(texts: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts with some million characters each."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= CHUNK or i + 1 == len(texts):
            yield start, i + 1
            start, held = i + 1, 0


def distinct_runs(texts: Sequence[str], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per chunk of texts: (each text's sorted distinct run hashes, one after the other; sizes)."""
    for start, end in chunks(texts):
        words, per_text = word_hashes(texts[start:end])
        found, runs = run_hashes(words, per_text, size)
        owner = np.repeat(np.arange(end - start), runs)
        order = np.lexsort((found, owner))
        found, owner = found[order], owner[order]
        fresh = np.ones(len(found), dtype=bool)
        fresh[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
        yield found[fresh], np.bincount(owner[fresh], minlength=end - start)
