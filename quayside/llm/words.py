"""64-bit hashes of the words of many texts at once, by numpy over their joined bytes."""

from __future__ import annotations

import numpy as np

#: Words end at white space; A-Z become lower case.
BY_SPACE = bytes(32 if c == 32 or 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Words are runs of ASCII letters and digits and of other characters; A-Z become lower case.
BY_SIGN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _BACK)):
            grown = np.full(n, base, np.uint64)
            grown[0] = 1
            _POWERS[k] = np.cumprod(grown, dtype=np.uint64)
    return _POWERS


def forget() -> None:
    """Give back the tables of powers; a task whose worker has hashed texts before may need the room."""
    _POWERS[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes], classes: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words start (one more entry than texts).

    A word's hash is the polynomial of its bytes modulo 2**64 times a power that takes its place away, then mixed.
    """
    data = np.frombuffer((b" ".join(texts) + b" ").translate(classes), np.uint8)
    word = np.concatenate([[False], data != 32])
    edge = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edge[0::2], edge[1::2]
    forth, back = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * forth[: len(data)], dtype=np.uint64, out=sums[1:])
    raw = (sums[ends] - sums[starts]) * back[starts]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    begins = np.concatenate([[0], np.cumsum(lengths)])
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), np.searchsorted(starts, begins)


def shingle_runs(texts: list[bytes], width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text, hashes of its runs of ``width`` words and of its words; fewer words are one run, none no run."""
    words, at = word_hashes(texts, BY_SPACE)
    runs = chain(words, width)
    out = []
    for a, b in zip(at.tolist(), at[1:].tolist(), strict=False):
        out.append((runs[a : b - width + 1] if b - a >= width else chain(words[a:b], b - a), words[a:b]))
    return out


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs."""
    return [np.unique(runs) for runs, _ in shingle_runs(texts, width)]


def chain(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words."""
    if width < 1 or len(words) < width:
        return np.zeros(0, np.uint64)
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = mix((out * np.uint64(0x9E3779B97F4A7C15)) ^ words[k : k + n])
    return out
