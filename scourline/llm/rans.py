"""Blocks of token IDs coded by a static range asymmetric numeral system (rANS).

One frequency table, shared by all blocks, gives each ID a share of ``2**BITS`` slots.  A
block is coded on its own by ``LANES`` interleaved coders: ID ``i`` goes to coder
``i % LANES``, and a step moves all coders at once.  A block is, little-endian::

    magic 4s | lanes u32 | documents u32 | ids u64 | words u64 | checkpoints u32 |
    crc32 of what follows u32 | length of each document u32 |
    for each checkpoint: first word u64, crc32 of its stretch of ids u32, states u64 |
    words u32

A checkpoint stands before every ``STRIDE``-th step, the first included.  The stretch of ids
up to the next one can be decoded and checked on its own.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"SRA2"
BITS = 20
LANES = 1024
STRIDE = 128
_LOW = 1 << 31
_HEAD = struct.Struct("<4sIIQQII")
_MARK = struct.Struct("<QI")
_U32, _MASK = np.uint64(32), np.uint64((1 << BITS) - 1)


class Frequencies:
    """Slots of each ID; ``counts`` are its occurrences, zero for an ID that never comes."""

    def __init__(self, counts: np.ndarray):
        counts = np.asarray(counts, dtype=np.float64)
        used = np.flatnonzero(counts > 0)
        if len(used) > 1 << BITS:
            raise ValueError(f"more than {1 << BITS} different ids")
        slots = np.zeros(len(counts), np.int64)
        if len(used):
            exact = counts[used] / counts[used].sum() * ((1 << BITS) - len(used))
            share = 1 + np.floor(exact).astype(np.int64)
            rest = (1 << BITS) - int(share.sum())
            order = np.argsort(np.floor(exact) - exact, kind="stable")
            share[order[:rest]] += 1
            slots[used] = share
        self.slots = slots.astype(np.uint64)
        self.first = (np.cumsum(slots) - slots).astype(np.uint64)
        self.id_at = np.repeat(np.arange(len(counts), dtype=np.uint32), slots)


def encode_block(ids: np.ndarray, lengths: np.ndarray, table: Frequencies) -> bytes:
    n = len(ids)
    steps = -(-n // LANES)
    slots, first = table.slots[ids], table.first[ids]
    if n and not slots.min():
        raise ValueError("an id has no slots in the frequency table")
    state = np.full(LANES, _LOW, np.uint64)
    room = np.uint64((_LOW >> BITS) << 32)
    emitted: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    for step in range(steps - 1, -1, -1):
        f = slots[step * LANES : (step + 1) * LANES]
        c = first[step * LANES : (step + 1) * LANES]
        x = state[: len(f)]
        full = x >= f * room
        emitted.append(x[full].astype(np.uint32))  # the low halves
        x = np.where(full, x >> _U32, x)
        whole = x // f
        state[: len(f)] = (whole << np.uint64(BITS)) + (x - whole * f) + c
        if step % STRIDE == 0:
            marks.append((step, state.copy()))
    words = np.concatenate(emitted[::-1] or [np.empty(0, np.uint32)])
    before = np.cumsum([0, *(len(e) for e in emitted[::-1])])
    body = [np.asarray(lengths, "<u4").tobytes()]
    for step, held in marks[::-1]:
        crc = zlib.crc32(ids[step * LANES : (step + STRIDE) * LANES].astype("<u4").tobytes())
        body += [_MARK.pack(before[step], crc), held.astype("<u8").tobytes()]
    body.append(words.astype("<u4").tobytes())
    body = b"".join(body)
    return _HEAD.pack(MAGIC, LANES, len(lengths), n, len(words), len(marks), zlib.crc32(body)) + body


class Block:
    """A coded block; refuses a damaged one."""

    def __init__(self, data: bytes):
        head = _HEAD.unpack_from(data)
        magic, self.lanes, docs, self.ids, words, marks, crc = head
        body = memoryview(data)[_HEAD.size :]
        if magic != MAGIC or zlib.crc32(body) != crc:
            raise ValueError("not a block, or a damaged one")
        self.lengths = np.frombuffer(body, "<u4", docs)
        at = 4 * docs
        self.marks = []
        for _ in range(marks):
            word, crc = _MARK.unpack_from(body, at)
            self.marks.append((word, crc, np.frombuffer(body, "<u8", self.lanes, at + _MARK.size)))
            at += _MARK.size + 8 * self.lanes
        self.words = np.frombuffer(body, "<u4", words, at)

    def decode(self, table: Frequencies, mark: int) -> np.ndarray:
        """The IDs from one checkpoint to the next, held against their checksum."""
        at, crc, state = self.marks[mark]
        state = state.copy()
        size = STRIDE * self.lanes
        out = np.empty(min(self.ids - mark * size, size), np.uint32)
        most = self.marks[mark + 1][0] if mark + 1 < len(self.marks) else len(self.words)
        words = self.words[at:most].astype(np.uint64)
        at = 0
        for low in range(0, len(out), self.lanes):
            x = state[: len(out) - low]
            slot = x & _MASK
            ids = table.id_at[slot]
            out[low : low + len(x)] = ids
            x = table.slots[ids] * (x >> np.uint64(BITS)) + slot - table.first[ids]
            need = np.flatnonzero(x < _LOW)
            x[need] = (x[need] << _U32) | words[at : at + len(need)]
            at += len(need)
            state[: len(x)] = x
        if zlib.crc32(out.astype("<u4").tobytes()) != crc:
            raise ValueError("a stretch does not decode to its checksum")
        return out

    def decode_all(self, table: Frequencies) -> np.ndarray:
        stretches = [self.decode(table, mark) for mark in range(len(self.marks))]
        return np.concatenate(stretches or [np.empty(0, np.uint32)])
