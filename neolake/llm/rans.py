"""Range asymmetric numeral system with static tables, over interleaved lanes.

A block holds the ids of some documents. Its ids go to ``lanes`` states in turn,
all coded with one shared frequency table and independent of other blocks. Every
``CHECKPOINT`` steps the encoder notes its states and its place in the words
written, so that a block can be decoded from any checkpoint on its own.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Frequencies of a table add up to 2**BITS.
BITS = 20
#: States stay in [2**31, 2**63); 32 bits move at once.
LOW = np.uint64(1 << 31)
LANES = 1024
CHECKPOINT = 128


class Table:
    """Shared frequencies: symbols that occur, each at least 1, in all 2**BITS."""

    def __init__(self, symbols: np.ndarray, freq: np.ndarray) -> None:
        self.symbols, self.freq = symbols.astype(np.uint32), freq.astype(np.uint64)
        size = int(symbols.max()) + 1 if len(symbols) else 1
        self.f = np.zeros(size, np.uint64)
        self.c = np.zeros(size, np.uint64)
        self.f[symbols] = freq
        self.c[symbols] = np.cumsum(freq) - freq
        self.slot = np.repeat(self.symbols, freq.astype(np.int64))

    @classmethod
    def of_counts(cls, symbols: np.ndarray, counts: np.ndarray) -> Table:
        """Scale counts to 2**BITS; the remainder goes to the most frequent symbols."""
        order = np.argsort(symbols)
        symbols, counts = symbols[order], counts[order].astype(np.float64)
        total = 1 << BITS
        if len(symbols) > total:
            raise ValueError("more symbols than slots")
        if not len(symbols):
            return cls(symbols.astype(np.int64), counts.astype(np.int64))
        freq = np.maximum(1, np.floor(counts / counts.sum() * (total - len(symbols)))).astype(np.int64)
        rest = total - int(freq.sum())
        by = np.argsort(-counts, kind="stable")
        freq[by] += rest // len(by)
        freq[by[: rest % len(by)]] += 1
        return cls(symbols.astype(np.int64), freq)


def encode(ids: np.ndarray, table: Table, lanes: int = LANES) -> dict:
    """A block: payload (words), states, checkpoints (states and place in the words), n, lanes, crc."""
    n = len(ids)
    lanes = max(1, min(lanes, n))
    steps = -(-n // lanes)
    x = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    written, marks = 0, []
    for step in range(steps - 1, -1, -1):  # the decoder reads the other way round
        s = ids[step * lanes : (step + 1) * lanes]
        k = len(s)
        f, c, own = table.f[s], table.c[s], x[:k]
        out = own >= (f << np.uint64(63 - BITS))
        if out.any():
            words.append((own[out] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            written += len(words[-1])
            own = np.where(out, own >> np.uint64(32), own)
        q = own // f
        x[:k] = (q << np.uint64(BITS)) + (own - q * f) + c
        if step % CHECKPOINT == 0 and step:
            marks.append(np.r_[np.uint64(step), np.uint64(written), x])
    payload = np.concatenate(words) if words else np.zeros(0, np.uint32)
    return {
        "n": n, "lanes": lanes, "states": x.astype("<u8").tobytes(), "payload": payload.astype("<u4").tobytes(),
        "marks": (np.concatenate(marks) if marks else np.zeros(0, np.uint64)).astype("<u8").tobytes(), "crc": zlib.crc32(ids.astype("<u4").tobytes()),
    }


def decode(block: dict, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of steps first..last-1 (all by default); ``first`` must be 0 or a checkpoint's step."""
    n, lanes = block["n"], block["lanes"]
    steps = -(-n // lanes) if n else 0
    last = steps if last is None else min(last, steps)
    words = np.frombuffer(block["payload"], "<u4")
    x, at = np.frombuffer(block["states"], "<u8").astype(np.uint64), len(words)
    if first:
        marks = np.frombuffer(block["marks"], "<u8").reshape(-1, lanes + 2)
        mark = marks[marks[:, 0] == first][0]
        x, at = mark[2:].astype(np.uint64), int(mark[1])
    out = np.empty(max(0, min(n, last * lanes) - first * lanes), np.uint32)
    mask = np.uint64((1 << BITS) - 1)
    for step in range(first, last):
        k = min(lanes, n - step * lanes)
        own = x[:k]
        slot = own & mask
        s = table.slot[slot]
        out[(step - first) * lanes : (step - first) * lanes + k] = s
        own = table.f[s] * (own >> np.uint64(BITS)) + slot - table.c[s]
        low = own < LOW
        m = int(np.count_nonzero(low))
        if m:
            own[low] = (own[low] << np.uint64(32)) | words[at - m : at].astype(np.uint64)
            at -= m
        x[:k] = own
    if first == 0 and last == steps:
        if at != 0 or (x != LOW).any() or zlib.crc32(out.astype("<u4").tobytes()) != block["crc"]:
            raise ValueError("a block's checksum doesn't fit its ids")
    return out
