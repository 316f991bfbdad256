"""Range asymmetric numeral system with a static table, over arrays of interleaved lanes.

A block holds ``LANES`` interleaved states. Every ``EVERY`` steps the states are kept as a
checkpoint, so that the steps from there on, a segment, are decoded without what precedes them.
All segments that are decoded together advance in one array.
"""

from __future__ import annotations

import numpy as np

BITS = 20
LANES = 32
EVERY = 512
STEPS = 2048
BLOCK = LANES * STEPS

_LOW = np.uint64(1 << 31)
_U = np.uint64


def quantized(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**BITS; every symbol that occurs has one at least."""
    counts = np.asarray(counts, dtype=np.int64)
    seen = counts > 0
    if not seen.any():
        counts, seen = np.ones_like(counts), np.ones(len(counts), bool)
    room = (1 << BITS) - int(seen.sum())
    if room < 0:
        raise ValueError("more symbols than the table has slots")
    share = counts * (room / counts.sum())
    freq = np.floor(share).astype(np.int64) + seen
    order = np.lexsort((np.arange(len(counts)), -(share - np.floor(share)) * seen))
    freq[order[: (1 << BITS) - int(freq.sum())]] += 1
    return freq


class Table:
    """Frequencies, their running sums, and the symbol of every slot."""

    def __init__(self, freq: np.ndarray):
        freq = np.asarray(freq, dtype=np.int64)
        if freq.sum() != 1 << BITS:
            raise ValueError("frequencies do not fill the table")
        self.freq = freq.astype(_U)
        self.start = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(_U)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


def encode_block(table: Table, tokens: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Segments (tokens, lane states, words) of each of the equally long blocks, flat in order.

    ``tokens`` has a row per block. A last step that is not full repeats the last token.
    """
    blocks, n = tokens.shape
    steps = -(-n // LANES)
    if steps * LANES > n:
        tokens = np.concatenate([tokens, np.repeat(tokens[:, -1:], steps * LANES - n, axis=1)], axis=1)
    grid = np.ascontiguousarray(tokens.reshape(blocks, steps, LANES).transpose(1, 0, 2))
    x = np.full((blocks, LANES), _LOW, dtype=_U)
    words = np.empty(grid.shape, dtype=np.uint32)
    sent = np.empty(grid.shape, dtype=bool)
    states = {}
    for t in range(steps - 1, -1, -1):
        freq, start = table.freq[grid[t]], table.start[grid[t]]
        full = x >= (freq << _U(63 - BITS))
        words[t], sent[t] = x & _U(0xFFFFFFFF), full
        x = np.where(full, x >> _U(32), x)
        whole = x // freq
        x = (whole << _U(BITS)) + (x - whole * freq) + start
        if t % EVERY == 0:
            states[t] = x
    segments = []
    for block in range(blocks):
        for t in range(0, steps, EVERY):
            kept = sent[t : t + EVERY, block]
            segments.append((min(n - t * LANES, EVERY * LANES), states[t][block], words[t : t + EVERY, block][kept]))
    return segments


def decode_segments(table: Table, sizes: list[int], states: np.ndarray, words: list[np.ndarray]) -> list[np.ndarray]:
    """Tokens of each segment. Longer segments first would not matter: all advance together."""
    x = states.astype(_U).copy()
    flat = np.concatenate([*words, np.zeros(1, np.uint32)]).astype(_U)
    at = np.concatenate(([0], np.cumsum([len(w) for w in words])[:-1])).astype(np.int64)
    steps = [-(-n // LANES) for n in sizes]
    out = np.empty((max(steps), len(sizes), LANES), dtype=np.uint32)
    order = np.array(steps)
    for t in range(max(steps)):
        live = order > t
        if live.all():
            live = slice(None)
        now = x[live]
        slot = now & _U((1 << BITS) - 1)
        token = table.symbol[slot]
        out[t, live] = token
        now = table.freq[token] * (now >> _U(BITS)) + slot - table.start[token]
        low = now < _LOW
        taken = np.cumsum(low, axis=1)
        index = at[live][:, None] + taken - 1
        now[low] = (now[low] << _U(32)) | flat[index[low]]
        x[live] = now
        at[live] += taken[:, -1]
    return [out[: steps[i], i].reshape(-1)[: sizes[i]] for i in range(len(sizes))]
