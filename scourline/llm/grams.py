"""Hashed character n-grams of texts."""

from __future__ import annotations

import numpy as np

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32  # A-Z
_FOLD[9:14] = 32
_SPREAD = np.uint32(0x9E3779B1)


def grams(
    texts: list[bytes | None], sizes: tuple[int, ...], bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (below ``2**bits``) of all n-grams of the texts, and the text of each.

    Grams are of bytes, with A-Z lower-cased, and lie within a word and the blanks that
    border it.
    """
    lengths = np.array([len(t or b"") + 1 for t in texts], np.int64)
    data = np.frombuffer(b" " + b"".join((t or b"") + b" " for t in texts), np.uint8)
    data = _FOLD[data]
    gaps = np.cumsum(data == 32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    step = data.astype(np.uint32) + np.uint32(1)
    rolled, found, of = step, [], []
    for n in range(2, max(sizes) + 1):
        count = len(data) - n + 1
        if count <= 0:
            break
        rolled = rolled[:count] * _SPREAD + step[n - 1 :]
        if n in sizes:
            # No blank inside; the blank before a text counts to the one before it, and
            # the byte after that is the text's own.
            at = np.flatnonzero(gaps[n - 2 : n - 2 + count] == gaps[:count])
            mixed = (rolled[at] ^ (rolled[at] >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
            found.append((mixed >> np.uint32(32 - bits)).astype(np.int32))
            of.append(owner[at])
    if not found:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    return np.concatenate(found), np.concatenate(of)
