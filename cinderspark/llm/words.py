"""Words, their hashes, and the hashes of runs of words.

A word is what ``[^\\x20\\x09-\\x0D]+`` matches after A-Z are lower-cased, which is what
``bytes.lower`` and ``bytes.split`` do.
"""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_ONE = np.uint64(1)
_S32 = np.uint64(32)
_S29 = np.uint64(29)


def tokens(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def hashes(own: list[bytes]) -> np.ndarray:
    """A 64-bit hash for each word; each distinct word is hashed once."""
    known: dict[bytes, int] = {}
    digest = xxhash.xxh3_64_intdigest
    for word in set(own):
        known[word] = digest(word)
    return np.fromiter(map(known.__getitem__, own), np.uint64, len(own))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _S32)) * _MIX
        x = (x ^ (x >> _S29)) * _ODD
        return x ^ (x >> _S32)


def run_hashes(hashed: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` words, in order; the whole as one run if there are fewer."""
    width = min(width, len(hashed))
    if not width:
        return np.zeros(0, np.uint64)
    n = len(hashed) - width + 1
    with np.errstate(over="ignore"):
        out = hashed[:n].copy()
        for k in range(1, width):
            out = mix(out + _ODD * np.uint64(k)) + hashed[k : k + n]
    return mix(out)


def hash_run(run) -> int:
    return int(run_hashes(hashes(list(run)), len(run))[0])
