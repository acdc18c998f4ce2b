"""Sets of five-word shingles, as sorted 64-bit hashes, for whole blocks of texts at once."""

from __future__ import annotations

import numpy as np

WIDTH = 5
#: Signs that are hashed together.
BLOCK = 1_000_000
SALT = tuple(np.uint64((2 * k + 1) * 0x94D049BB133111EB % 2**64) for k in range(32))
A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * B
    x = (x ^ (x >> np.uint64(27))) * C
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the number of words of each text. Words are runs of anything but ASCII white space, with A-Z lower-cased."""
    counts = np.zeros(len(texts), np.int64)
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    gap = (points == 32) | ((points >= 9) & (points <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), counts
    lower = points + ((points >= 65) & (points <= 90)).astype(np.uint32) * np.uint32(32)
    place = np.arange(len(points), dtype=np.uint64)
    place[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, len(points)))).astype(np.uint64)
    mixed = scramble(lower.astype(np.uint64) + (place + np.uint64(1)) * A)
    mixed[gap] = 0
    words = scramble(np.add.reduceat(mixed, starts) + (ends - starts).astype(np.uint64))
    limits = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], limits])))
    return words, counts


def shingle_sets(texts: list[str], width: int = WIDTH) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted; fewer words than `width` make one shingle, none make an empty set."""
    out: list[np.ndarray] = []
    block: list[str] = []
    size = 0
    for t in texts:
        block.append(t)
        size += len(t)
        if size >= BLOCK:
            out += block_sets(block, width)
            block, size = [], 0
    return out + (block_sets(block, width) if block else [])


def block_sets(texts: list[str], width: int) -> list[np.ndarray]:
    words, counts = word_hashes(texts)
    n = len(words)
    rolled = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width):
        rolled = rolled * A + words[k : k + len(rolled)] * SALT[k]
    rolled = scramble(rolled)
    out, at = [], 0
    for c in counts.tolist():
        if c >= width:
            out.append(np.unique(rolled[at : at + c - width + 1]))
        elif c:
            h = np.uint64(c)
            with np.errstate(over="ignore"):
                for w in words[at : at + c]:
                    h = scramble(np.array([h * A + w]))[0]
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
        at += c
    return out


def prefix_length(n: int) -> int:
    """So many of a set's shingles, in any order that all sets share, meet those of every set with Jaccard similarity 0.8 or more."""
    return n // 5 + 1 if n else 0
