"""Static range asymmetric numeral system (rANS) for arrays of token ids.

A *segment* has one frequency table, counted over all its ids and shared by its
blocks. A *block* is coded on its own: its ids are dealt to ``lanes`` interleaved
coder states, so that one numpy step codes one id of every lane. Each
``span`` steps the block keeps a checkpoint — where in the word stream decoding
can start, the lanes' states there, and the CRC-32 of the span's ids — so spans
are decoded independently and verified one by one.
"""

from __future__ import annotations

import zlib

import numpy as np

SCALE_BITS = 18
LOW = np.uint64(1 << 31)
_M = np.uint64((1 << SCALE_BITS) - 1)
_BITS = np.uint64(SCALE_BITS)
_WORD = np.uint64(32)
_LIMIT = np.uint64(31 - SCALE_BITS + 32)


class Corrupt(ValueError):
    """A span's ids do not have the CRC-32 that was written for them."""


def frequency_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(symbols, frequencies)``: the ids that occur and their shares of
    ``2**SCALE_BITS``, at least 1 each; empty for no ids."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    counts = counts[symbols]
    if not len(symbols):
        return symbols.astype(np.uint32), np.zeros(0, dtype=np.uint32)
    if len(symbols) > 1 << SCALE_BITS:
        raise ValueError(f"more than {1 << SCALE_BITS} distinct ids in one segment")
    share = np.maximum(1, counts * (1 << SCALE_BITS) // counts.sum())
    order = np.argsort(-share, kind="stable")
    over = int(share.sum()) - (1 << SCALE_BITS)
    if over < 0:
        share[order[0]] -= over
    while over > 0:
        can = order[share[order] > 1][:over]
        share[can] -= 1
        over -= len(can)
    return symbols.astype(np.uint32), share.astype(np.uint32)


class Table:
    """Look-ups of one segment's frequency table."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray):
        self.symbols = symbols
        self.freq = freqs.astype(np.uint64)
        self.cum = np.cumsum(self.freq) - self.freq
        self._slots: np.ndarray | None = None
        self._place: np.ndarray | None = None

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Each id's place in the table."""
        if self._place is None:
            self._place = np.zeros(int(self.symbols[-1]) + 1 if len(self.symbols) else 0, dtype=np.int32)
            self._place[self.symbols] = np.arange(len(self.symbols))
        return self._place[ids]

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq)), self.freq.astype(np.int64))
        return self._slots


def lanes_for(n: int, most: int) -> int:
    """Fewer lanes for short blocks, whose states would outweigh their words."""
    return int(max(1, min(most, n // 256)))


def encode_block(ids: np.ndarray, table: Table, lanes: int, span: int) -> dict:
    """``words`` and the checkpoints (``at``: word offsets, ``states``, ``crc``)
    of one block of ids, every one of which is in ``table``."""
    n = len(ids)
    steps = -(-n // lanes)
    where = table.places(ids)
    freq, cum = table.freq[where], table.cum[where]
    limit = freq << _LIMIT
    x = np.full(lanes, LOW, dtype=np.uint64)
    out: list[np.ndarray] = []
    emitted, at, states = 0, [], []
    for s in range(steps - 1, -1, -1):
        f = freq[s * lanes : (s + 1) * lanes]
        y = x[: len(f)]
        over = np.flatnonzero(y >= limit[s * lanes : (s + 1) * lanes])
        if len(over):
            out.append(y[over].astype(np.uint32))
            emitted += len(over)
            y[over] >>= _WORD
        q, r = np.divmod(y, f)
        x[: len(f)] = (q << _BITS) + r + cum[s * lanes : (s + 1) * lanes]
        if s % span == 0:
            at.append(emitted)
            states.append(x.astype("<u8").tobytes())
    words = np.concatenate(out[::-1]) if out else np.zeros(0, dtype=np.uint32)
    raw = np.ascontiguousarray(ids, dtype="<u4")
    size = span * lanes
    return {
        "n": n, "lanes": lanes, "span": span, "words": words.astype("<u4").tobytes(),
        "at": [emitted - k for k in reversed(at)], "states": states[::-1],
        "crc": [zlib.crc32(raw[k : k + size].tobytes()) & 0xFFFFFFFF for k in range(0, n, size)],
    }


def decode_span(block, k: int, table: Table, words: np.ndarray | None = None) -> np.ndarray:
    """Ids of the block's span ``k``, from its checkpoint alone; raises
    ``Corrupt`` if they are not the ids that were written."""
    lanes, span, n = int(block["lanes"]), int(block["span"]), int(block["n"])
    if words is None:
        words = np.frombuffer(block["words"], dtype="<u4")
    x = np.frombuffer(block["states"][k], dtype="<u8").astype(np.uint64)
    pos = int(block["at"][k])
    lo, hi = k * span * lanes, min(n, (k + 1) * span * lanes)
    out = np.empty(hi - lo, dtype=np.int64)
    slots, freq, cum = table.slots, table.freq, table.cum
    for a in range(0, hi - lo, lanes):
        b = min(a + lanes, hi - lo)
        y = x[: b - a]
        slot = y & _M
        sym = slots[slot.astype(np.int64)]
        out[a:b] = sym
        y = freq[sym] * (y >> _BITS) + slot - cum[sym]
        low = np.flatnonzero(y < LOW)
        if len(low):
            y[low] = (y[low] << _WORD) | words[pos : pos + len(low)].astype(np.uint64)
            pos += len(low)
        x[: b - a] = y
    ids = table.symbols[out]
    if zlib.crc32(ids.astype("<u4").tobytes()) & 0xFFFFFFFF != int(block["crc"][k]):
        raise Corrupt(f"span {k}: CRC-32 differs")
    return ids


def decode_block(block, table: Table) -> np.ndarray:
    """All ids of a block, span by span."""
    words = np.frombuffer(block["words"], dtype="<u4")
    spans = [decode_span(block, k, table, words) for k in range(len(block["at"]))]
    return np.concatenate(spans) if spans else np.zeros(0, dtype=np.uint32)
