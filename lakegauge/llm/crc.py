"""CRC-32 of many short spans at once, by NumPy."""

import zlib

import numpy as np


def _table() -> np.ndarray:
    """What a byte does to the register, for the reflected polynomial of zlib."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> np.uint32(1)) ^ np.uint32(0xEDB88320), x >> np.uint32(1))
    return x


TABLE = _table()
#: Longer spans are given to the library one by one.
LONG = 64


def crc32(data: np.ndarray, start: np.ndarray, end: np.ndarray, begin: np.ndarray | int = 0) -> np.ndarray:
    """Unsigned CRC-32 of data[start:end] for each pair, carried on from begin, the CRC-32 of the bytes before."""
    size = end - start
    begin = np.broadcast_to(np.asarray(begin, np.uint32), size.shape)
    out = ~begin
    left, at = np.flatnonzero((size > 0) & (size <= LONG)), 0
    state, place, left_over = out[left], start[left], size[left]
    while len(left):
        state = TABLE[(state ^ data[place + at]) & np.uint32(0xFF)] ^ (state >> np.uint32(8))
        at += 1
        done = left_over == at
        if done.any():
            out[left[done]] = state[done]
            left, state, place, left_over = left[~done], state[~done], place[~done], left_over[~done]
    out = ~out
    for i in np.flatnonzero(size > LONG):
        out[i] = zlib.crc32(data[start[i] : end[i]].tobytes(), int(begin[i]))
    return out.astype(np.int64)
