"""Words of whole Arrow string columns, found and hashed by NumPy on the UTF-8 bytes.

Nothing here loops over words. A slice holds whole documents, about SLICE_BYTES of text or
one longer document, so memory stays bounded by the largest document.
"""

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 1 << 19
U = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _separators(inside) -> np.ndarray:
    return np.array([inside(b) for b in range(256)])


#: True where a byte separates words: white space only, or all ASCII but digits and lower-case letters.
SPACE = _separators(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
NOT_ALNUM = _separators(lambda b: b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix64)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def keys(seed: int, n: int) -> np.ndarray:
    """n pseudo-random odd 64-bit values that depend on the seed alone."""
    return mix((np.arange(1, n + 1, dtype=U) + U(seed << 32)) * U(0x9E3779B97F4A7C15)) | U(1)


BYTE_KEY = keys(1, 256)
LANES = keys(2, 4)


#: Spans of more bytes than this are hashed one by one by a library; shorter ones eight bytes at a time, all together.
LONG = 64
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], U)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lanes: int = 1) -> list[np.ndarray]:
    """64-bit hashes of data[start:end] for each pair, as many independent ones as lanes.

    Every eight bytes are mixed into what went before, so no structure of a text, such as one sequence
    and its complement, makes two spans meet more often than chance.
    """
    size = (end - start).astype(np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    out = [mix(size.astype(U) * BYTE_KEY[0] + LANES[k]) for k in range(lanes)]
    left, at = np.flatnonzero((size > 0) & (size <= LONG)), 0
    while len(left):
        chunk = eight[start[left] + at] & _KEEP[np.minimum(size[left] - at, 8)]
        for h in out:
            h[left] = mix(h[left] ^ chunk) + BYTE_KEY[1]
        at += 8
        left = left[size[left] > at]
    for i in np.flatnonzero(size > LONG):
        span = data[start[i] : end[i]].tobytes()
        for k, h in enumerate(out):
            h[i] = xxhash.xxh3_64_intdigest(span, seed=int(LANES[k]))
    return out


#: Polynomials of runs are taken modulo this prime, for products modulo a power of two have runs that always meet.
PRIME = U(2**61 - 1)


def _modulo(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> U(61))
    return np.where(x >= PRIME, x - PRIME, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, from halves of 31 bits."""
    low = U(2**31 - 1)
    a1, a0, b1, b0 = a >> U(31), a & low, b >> U(31), b & low
    middle = a0 * b1 + a1 * b0
    return _modulo(a1 * b1 * U(2) + (middle >> U(30)) + ((middle & U(2**30 - 1)) << U(31)) + a0 * b0)


@cache
def _powers(n: int, lane: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a lane's base and of its inverse, 0 to n - 1; n is a power of two."""
    out, p = [], int(PRIME)
    base = int(LANES[lane]) % p
    for step in (base, pow(base, p - 2, p)):
        x = np.ones(1, U)
        while len(x) < n:
            x = np.concatenate([x, _times(x, U(pow(step, len(x), p)))])
        out.append(x)
    return out[0], out[1]


def run_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, lanes: int = 1) -> list[np.ndarray]:
    """64-bit hashes of the runs values[start:end] of 64-bit values, by polynomials over prefix sums modulo a prime."""
    out, n = [], 1 << max(16, len(values).bit_length())
    size = mix((end - start).astype(U) + BYTE_KEY[2])
    for lane in range(lanes):
        up, down = _powers(n, lane)
        term = _times(_modulo(mix(values ^ LANES[lane])), up[: len(values)])
        low, high = (np.concatenate([np.zeros(1, U), np.cumsum(x, dtype=U)]) for x in (term & U(2**31 - 1), term >> U(31)))
        whole = _modulo(_modulo(low[end] - low[start]) + _times(_modulo(high[end] - high[start]), U(2**31)))
        out.append(mix(_times(whole, down[start]) ^ size))
    return out


def column(array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array without nulls taken as text (null: empty), and the n + 1 offsets into them."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if not pa.types.is_large_string(array.type):
        array = array.cast(pa.large_string())
    if array.null_count:
        array = pc.fill_null(array, "")
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    if offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    data = np.frombuffer(array.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batches, text: str, limit: int = SLICE_BYTES):
    """Record batches cut into runs of rows with about limit bytes of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(size) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(size)]
        for lo, hi in zip(cuts, cuts[1:]):
            yield batch.slice(lo, hi - lo)


def joined(batches, text: str, limit: int):
    """Record batches of whole rows with about limit bytes of text each: small ones are put together, large ones cut."""
    held, size = [], 0
    for part in slices(batches, text, limit):
        own = pc.sum(pc.binary_length(part.column(part.schema.get_field_index(text)))).as_py() or 0
        if held and size + own > limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        held.append(part)
        size += own
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class Words:
    """start, end: byte positions; hash: 64 bits each; doc: row; first, count: by row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separator: np.ndarray, lower: bool = True, hashed: bool = True):
        self.rows = len(offsets) - 1
        n = len(data)
        self.data = LOWER[data] if lower else data
        inside = ~separator[self.data]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[offsets[:-1][offsets[:-1] < n]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.start, self.end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets[:-1])
        self.count = np.diff(self.first, append=len(self.start))
        self.doc = np.repeat(np.arange(self.rows), self.count)
        self.hash = span_hashes(self.data, self.start, self.end)[0] if n and hashed else np.zeros(0, U)


def fold(hashes: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hashes of all runs of width consecutive values; the last width - 1 places have none."""
    n, key = max(0, len(hashes) - width + 1), keys(seed, width)
    out = np.zeros(n, U)
    for j in range(width):
        out += hashes[j : j + n] * key[j]
    return mix(out)
