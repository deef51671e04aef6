"""Hashes of words, of word shingles, and of texts, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np


def hash64(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")


def plain(raw: str) -> str:
    """Letters and digits of a word, in lower case."""
    low = raw.lower()
    return low if low.isalnum() else "".join(filter(str.isalnum, low))


class _Known(dict):
    """Hash of a word as it stands in the text; 0 where nothing of it is left."""

    #: Words kept by one task; beyond them all are let go.
    ENTRIES = 300_000

    def __missing__(self, raw: str) -> int:
        if len(self) >= self.ENTRIES:
            self.clear()
        word = plain(raw)
        self[raw] = value = (hash64(word.encode("utf-8", "surrogatepass")) or 1) if word else 0
        return value


_known = _Known()


def forget() -> None:
    """Let go of the words kept: a worker lives on after its task, through the stages that follow."""
    _known.clear()


def word_hashes(text: str) -> np.ndarray:
    """Of each word between white space, without case and punctuation; words of punctuation alone are left out."""
    found = np.array(list(map(_known.__getitem__, text.split())), "u8")
    return found[found != 0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words; a shorter text is one run."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    out = np.full(len(hashes) - size + 1, size, "u8")
    for i in range(size):
        out = mixed(out + hashes[i : len(hashes) - size + 1 + i])
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from 64-bit hashes."""
    return ((x >> np.uint64(11)).astype("f8") + 1) * 2.0**-53
