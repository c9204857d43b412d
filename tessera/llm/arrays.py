"""Texts as flat code-point arrays, so tasks hash and count words with numpy
over many documents at once instead of looping over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
BLOCK_CHARS = 1_000_000
_powers: dict[int, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads 64-bit values over all bits."""
    x = x.astype(U64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> U64(shift)
        x *= U64(factor)
    return x ^ (x >> U64(33))


def power_table(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    if base not in _powers or len(_powers[base]) < n:
        p = np.full(max(n, 1 << 16), base, dtype=U64)
        p[0] = 1
        np.multiply.accumulate(p, out=p)
        _powers[base] = p
    return _powers[base][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of ``values[start:end]`` for every span: polynomial sums from
    one running total, shifted back to the span's start."""
    total = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(mix64(values.astype(U64) + U64(1)) * power_table(BASE, len(values)), out=total[1:])
    back = power_table(pow(BASE, -1, 1 << 64), len(values) + 1)
    return mix64((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(U64))


def blocks(texts, limit: int = BLOCK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts (null as empty) in blocks of about ``limit`` characters,
    with the index of the first."""
    at, block, size = 0, [], 0
    for i, t in enumerate(texts):
        t = t if isinstance(t, str) else ""
        if block and size + len(t) > limit:
            yield at, block
            at, block, size = i, [], 0
        block.append(t)
        size += len(t) + 1
    if block:
        yield at, block


_classes: dict[str, np.ndarray] = {}


def _class_table(kind: str) -> np.ndarray:
    if kind not in _classes:
        test = {"alnum": str.isalnum, "alpha": str.isalpha, "upper": str.isupper, "digit": str.isdigit}[kind]
        _classes[kind] = np.array([test(chr(c)) for c in range(0x10000)])
    return _classes[kind]


def is_class(cp: np.ndarray, kind: str) -> np.ndarray:
    """Character class of each code point; beyond the basic plane all count as letters."""
    low = np.minimum(cp, 0xFFFF)
    return np.where(cp > 0xFFFF, kind in ("alnum", "alpha"), _class_table(kind)[low])


def is_space(cp: np.ndarray) -> np.ndarray:
    return (cp == 0x20) | ((cp >= 0x09) & (cp <= 0x0D))


class Block:
    """Code points of several texts, a line feed after each."""

    def __init__(self, texts: list[str], lower: bool = False):
        self.n = len(texts)
        if lower:
            texts = [t.lower() for t in texts]
        joined = "\n".join(texts) + "\n"
        self.cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        self.lengths = lengths

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, positions, side="right")

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs where ``inside`` holds."""
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

    def per_doc(self, mask: np.ndarray) -> np.ndarray:
        """How many positions of each text are set."""
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[self.ends] - total[self.starts]


def unique_per_doc(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, value) pairs with counts; values are compared by 40 bits
    within a document, which statistics can afford."""
    key = (doc.astype(U64) << U64(40)) | (value >> U64(24))
    key, counts = np.unique(key, return_counts=True)
    return (key >> U64(40)).astype(np.int64), key, counts
