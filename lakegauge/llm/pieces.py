"""Ids of whole texts through the tokenizers library, each distinct piece of text once.

A byte-level tokenizer cuts text by one pattern and encodes every piece by itself, so equal pieces
have equal ids. Pieces are found and hashed by NumPy on the UTF-8 bytes; those not seen before go
to the library in one batch.
"""

import json
import os
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers

from . import arrowtext

U = np.uint64

#: The pattern that the public files share.
PATTERN = public_tokenizers.PATTERN

#: Pieces that a worker remembers, some 60 bytes each; others are encoded in every slice where they occur.
REMEMBERED = 1_000_000


@cache
def load_tokenizer(text: str):
    """A tokenizer from its JSON, once in each worker, on one thread: Spark's tasks are the parallel part."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(text)


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of the byte-level pattern start, for text with characters below U+0250 only.

    Runs of letters, digits or other characters are pieces, with a space before them if there is
    one; the last character of white space before a run stands alone if it is no space; an
    apostrophe that starts a run takes the letters of a contraction.
    """
    n = len(data)
    code = data.astype(np.int64)
    lead = np.flatnonzero(data >= 0xC0)
    code[lead] = ((code[lead] & 0x1F) << 6) | (code[np.minimum(lead + 1, n - 1)] & 0x3F)
    head = (data & 0xC0) != 0x80
    at = np.flatnonzero(head)
    kind = _kinds()[code[at]]
    first = np.zeros(len(at) + 1, bool)
    first[np.searchsorted(at, offsets)] = True  # of a document, or after the last
    last = first[1:]
    first = first[:-1]
    run = first | np.concatenate([[True], kind[1:] != kind[:-1]])
    space = data[at] == 0x20
    after_space = np.concatenate([[False], space[:-1]]) & ~first
    white = kind == 0
    start = np.where(white, run, run & ~after_space)
    before_run = white & ~last & np.concatenate([~white[1:], [False]])
    start |= before_run | first
    # contractions
    m = len(at)
    quote = np.flatnonzero((data[at] == 0x27) & start & ~last)
    if quote.size:
        byte = data[at]
        one = byte[np.minimum(quote + 1, m - 1)]
        two = np.where(last[np.minimum(quote + 1, m - 1)], 0, byte[np.minimum(quote + 2, m - 1)])
        single = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        double = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for hit, length in ((single, 2), (double, 3)):
            q = quote[hit]
            start[q + 1] = False
            stop = q + length
            stop = stop[stop < m]
            start[stop] = True
    return at[start]


@cache
def _kinds() -> np.ndarray:
    """0 white space, 1 letter, 2 number, 3 other, for characters below U+0250."""
    import unicodedata

    white = {0x20, 0x85, 0xA0, *range(9, 14)}
    return np.array([0 if c in white else {"L": 1, "N": 2}.get(unicodedata.category(chr(c))[0], 3) for c in range(0x250)], np.int8)


class PieceEncoder:
    """Ids of whole texts by a byte-level tokenizers file; each distinct piece between the pattern's cuts goes to the library once.

    Pieces are found by one 64-bit hash in an open table and known by a second one that must agree too;
    pieces that agree in the first alone are encoded by themselves. A worker remembers so many of them.
    """

    def __init__(self, model: str, remembered: int = REMEMBERED):
        self.tokenizer = load_tokenizer(model)
        own = json.loads(model)
        self.special = [t["content"].encode() for t in own["added_tokens"]]
        level = own["pre_tokenizer"] or {}
        steps = level.get("pretokenizers", [])
        cut = len(steps) == 2 and steps[0].get("type") == "Split" and steps[0]["pattern"] == {"Regex": PATTERN} and steps[0]["behavior"] == "Isolated" and steps[1]["type"] == "ByteLevel" and not steps[1]["use_regex"]
        #: Texts of other files, or with characters that two Unicode versions might class differently, go to the library whole.
        self.plain = (cut or level.get("type") == "ByteLevel" and level.get("use_regex")) and not level.get("add_prefix_space") and not own["normalizer"]
        self.remembered, self.bits = remembered, int(2 * remembered - 1).bit_length()
        self.table, self.value, self.check = np.zeros(1 << self.bits, U), np.zeros(1 << self.bits, np.int32), np.zeros(0, U)
        self.start, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.room, self.known, self.filled = (0, 0), 0, 0

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum())), size

    def _lookup(self, hashes: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The number of each known piece, -1 for others."""
        out = np.full(len(hashes), -1, np.int64)
        place = (hashes >> U(64 - self.bits)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            key = self.table[place]
            hit = key == hashes[left]
            found = self.value[place[hit]]
            out[left[hit]] = np.where(self.check[found] == check[left[hit]], found, -1)
            more = ~hit & (key != 0)
            left, place = left[more], (place[more] + 1) & (len(self.table) - 1)
        return out

    def _held(self, hashes: np.ndarray) -> np.ndarray:
        """Whether the table has an entry of each hash."""
        out, left = np.zeros(len(hashes), bool), np.arange(len(hashes))
        place = (hashes >> U(64 - self.bits)).astype(np.int64)
        while len(left):
            key = self.table[place]
            out[left[key == hashes[left]]] = True
            more = (key != hashes[left]) & (key != 0)
            left, place = left[more], (place[more] + 1) & (len(self.table) - 1)
        return out

    def _remember(self, hashes: np.ndarray, check: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
        take = min(len(hashes), self.remembered - self.known)
        if take <= 0:
            return
        hashes, size = hashes[:take], size[:take]
        flat = flat[: int(size.sum())]
        if self.known + take > len(self.start):
            more = max(take, len(self.start), 1 << 16)
            self.start, self.size = (np.concatenate([x, np.zeros(more, np.int64)]) for x in (self.start, self.size))
            self.check = np.concatenate([self.check, np.zeros(more, U)])
        if self.filled + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(flat), len(self.flat), 1 << 18), np.uint32)])
        own = slice(self.known, self.known + take)
        self.start[own], self.size[own], self.check[own] = self.filled + np.cumsum(size) - size, size, check[:take]
        self.flat[self.filled : self.filled + len(flat)] = flat
        place, left = (hashes >> U(64 - self.bits)).astype(np.int64), np.arange(take)
        while len(left):
            free = self.table[place] == 0
            self.table[place[free]] = hashes[left[free]]
            mine = self.table[place] == hashes[left]
            self.value[place[mine]] = self.known + left[mine]
            left, place = left[~mine], (place[~mine] + 1) & (len(self.table) - 1)
        self.known, self.filled = self.known + take, self.filled + len(flat)

    def encode(self, column, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column's texts in a row, end (if given) after each text's, and each text's number of ids."""
        data, offsets = arrowtext.column(column)
        rows = len(offsets) - 1
        by_piece = simple_rows(data, offsets) if self.plain else np.zeros(rows, bool)
        raw = data.tobytes()
        for special in self.special:
            at = raw.find(special)
            while at >= 0:
                by_piece[np.searchsorted(offsets, at, side="right") - 1] = False
                at = raw.find(special, at + 1)
        if not by_piece.all():  # such rows go to the library whole, the rest by pieces
            whole = np.flatnonzero(~by_piece)
            other, other_size = self._library([raw[offsets[r] : offsets[r + 1]].decode("utf-8", "replace") for r in whole])
            kept = np.repeat(by_piece, np.diff(offsets))
            data = data[kept]
            raw = data.tobytes()
            offsets = np.concatenate([[0], np.cumsum(np.where(by_piece, np.diff(offsets), 0))])
        start = piece_starts(data, offsets) if len(data) else np.zeros(0, np.int64)
        stop = np.append(start[1:], len(data))
        hashes, check = arrowtext.span_hashes(data, start, stop[: len(start)], 2)
        hashes |= U(1)
        place = self._lookup(hashes, check)
        flat, begin, size = self.flat, self.start, self.size
        missing = np.flatnonzero(place < 0)
        if missing.size:
            fresh, index, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            # the first piece of each hash stands for those that agree in both, unless another piece of the hash is known
            first, taken = missing[index], self._held(fresh)
            same = check[missing] == check[first][back]
            alone = missing[~same]
            made, made_size = self._library([raw[start[i] : stop[i]].decode() for i in (*first, *alone)])
            whole_size = int(made_size[: len(first)].sum())
            flat = np.concatenate([self.flat[: self.filled], made])
            begin = np.concatenate([self.start[: self.known], self.filled + np.cumsum(made_size) - made_size])
            size = np.concatenate([self.size[: self.known], made_size])
            place[missing] = self.known + back
            place[alone] = self.known + len(first) + np.arange(len(alone))
            free = ~taken
            kept = np.repeat(free, made_size[: len(first)])
            self._remember(fresh[free], check[first][free], made[:whole_size][kept], made_size[: len(first)][free])
        count = size[place]
        of = np.searchsorted(offsets, start, side="right") - 1
        number = np.bincount(of, count, minlength=rows).astype(np.int64)
        if not by_piece.all():
            number[whole] = other_size
        tail = int(end is not None)
        close = np.cumsum(number + tail)
        out = np.empty(int(close[-1]) if rows else 0, np.uint32)
        if tail:
            out[close - 1] = end
        open_ = close - number - tail
        lane = np.cumsum(count) - count
        total = int(count.sum())
        source = np.arange(total) + np.repeat(begin[place] - lane, count)
        pieces_before = np.concatenate([[0], np.cumsum(np.where(by_piece, number, 0))])[:-1]
        shift = np.repeat(np.where(by_piece, open_ - pieces_before, 0), np.where(by_piece, number, 0))
        out[np.arange(total) + shift] = flat[source]
        if not by_piece.all():
            before = np.cumsum(other_size) - other_size
            for r, a, k in zip(whole, before, other_size):
                out[open_[r] : open_[r] + k] = other[a : a + k]
        return out, number + tail


def simple_rows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows whose characters all lie below U+0250 and are no ASCII separators, from their UTF-8 bytes."""
    odd = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data >= 0xC9) | ((data >= 0x1C) & (data <= 0x1F)), out=odd[1:])
    return odd[offsets[1:]] == odd[offsets[:-1]]


@cache
def encoder(model: str, remembered: int = REMEMBERED) -> PieceEncoder:
    return PieceEncoder(model, remembered)
