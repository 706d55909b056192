"""Word and shingle hashes of whole batches of texts, with numpy.

A batch is one Arrow string column. All its bytes are looked at in one buffer;
word boundaries come from a table of the 256 byte values, so that a boundary
class has to be a set of ASCII characters (UTF-8 never uses bytes below 0x80
inside a longer character).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
STEP = U64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64 bits, so that low and high bits are alike."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


_BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * BASE) | U64(1)
_INVERSE = U64(pow(int(BASE), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column with one 0x20 after each, and the offsets. Null is empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    column = column.fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=n + 1 + column.offset)[column.offset :]
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    flat = flat[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    out = np.full(len(flat) + n, 0x20, dtype=np.uint8)
    own = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    out[np.arange(len(flat), dtype=np.int64) + own] = flat
    return out, offsets + np.arange(n + 1, dtype=np.int64)


class Words:
    """The words of a batch: start, end (bytes in `data`), doc (row in the batch) and hash."""

    def __init__(self, column: pa.Array, inside: np.ndarray):
        """inside: for each of the 256 byte values, whether it belongs to a word. A-Z are lower-cased."""
        raw, self.offsets = text_buffer(column)
        self.n_docs = len(column)
        self.data = _LOWER[raw]
        word = inside[self.data]
        edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0))
        # every text ends in 0x20, which is in no word: edges come in pairs and words stay in their text
        self.start, self.end = edge[0::2], edge[1::2]
        self.doc = np.searchsorted(self.offsets, self.start, side="right") - 1
        code = _BYTE_CODES[self.data]
        code[~word] = 0
        n = len(code)
        code *= powers(BASE, n)
        total = np.zeros(n + 1, dtype=U64)
        np.add.accumulate(code, out=total[1:])
        span = total[self.end] - total[self.start]
        self.hash = mix(span * powers(_INVERSE, n + 1)[self.start] + (self.end - self.start).astype(U64))
        #: first word of each text, and one past the last text's
        self.first = np.searchsorted(self.doc, np.arange(self.n_docs + 1))

    def __len__(self) -> int:
        return len(self.start)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` consecutive words, across text borders too."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = words[:n].copy()
    for j in range(1, size):
        out *= STEP
        out += words[j : j + n]
    return mix(out)


def byte_class(excluded: str) -> np.ndarray:
    """The table of bytes that are inside words, given the excluded ASCII characters."""
    table = np.ones(256, dtype=bool)
    table[[ord(c) for c in excluded]] = False
    return table


#: Words are runs of anything but ASCII white space.
SPACED = byte_class(" \t\n\v\f\r")
#: Words are runs of digits, letters and all that isn't ASCII.
ALNUM = byte_class("".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])))


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted by text and hash, and where each text's begin.

    A text of fewer words has its whole sequence as one shingle, and one without words none.
    """
    n_words = np.diff(words.first)
    full = grams(words.hash, size)
    doc = words.doc[: len(full)]
    inside = doc == words.doc[size - 1 :][: len(full)] if len(full) else np.zeros(0, bool)
    full, doc = full[inside], doc[inside]
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        few = []
        for d in short:
            h = U64(len(words.hash[words.first[d] : words.first[d + 1]]))
            for x in words.hash[words.first[d] : words.first[d + 1]]:
                h = U64((int(h) * int(STEP) + int(x)) & 0xFFFFFFFFFFFFFFFF)
            few.append(h)
        full = np.concatenate([full, mix(np.array(few, dtype=U64) ^ STEP)])
        doc = np.concatenate([doc, short])
    order = np.lexsort((full, doc))
    full, doc = full[order], doc[order]
    if len(full):
        new = np.ones(len(full), dtype=bool)
        new[1:] = (full[1:] != full[:-1]) | (doc[1:] != doc[:-1])
        full, doc = full[new], doc[new]
    return full, np.searchsorted(doc, np.arange(words.n_docs + 1))
