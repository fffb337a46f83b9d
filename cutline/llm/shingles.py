"""Word shingles of whole texts as 64-bit hashes, computed over the bytes of many texts at once.

Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return, A-Z
lower-cased. A text of fewer words than a shingle has one shingle, its whole sequence; a text without
words has none.
"""

import numpy as np

from cutline.llm.common import text_slices

_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.uint64(0xD6E8FEB86659FD93)


def mix(x):
    """Spreads each bit of 64-bit numbers over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_powers = {}


def _power_table(size):
    """Powers of an odd number and of its inverse modulo 2**64, at least `size` of them."""
    if len(_powers.get("up", ())) < size:
        base = int(_STEP)
        size = max(size, 1 << 20) + 1
        for name, value in (("up", base), ("down", pow(base, -1, 1 << 64))):
            table = np.full(size, value, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def word_hashes(data, offsets):
    """(hash of each word, first word of each text and the total): a word never spans two texts."""
    size = len(data)
    if not size:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    blank = _BLANK[data]
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(~blank & (edge[:-1] | np.concatenate(([True], blank[:-1]))))
    ends = np.flatnonzero(~blank & (edge[1:] | np.concatenate((blank[1:], [True])))) + 1
    up, down = _power_table(size)
    total = np.zeros(size + 1, np.uint64)
    np.cumsum(_BYTE[_FOLD[data]] * up[:size], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts])
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(column, words):
    """Yields (row, sorted distinct shingle hashes) for each text of an Arrow column."""
    for first, _, data, offsets in text_slices(column):
        hashes, at = word_hashes(data, offsets)
        whole = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for j in range(words):
            whole = whole * _WORD + hashes[j:j + len(whole)]
        whole = mix(whole + np.uint64(words))
        for row in range(len(offsets) - 1):
            a, b = int(at[row]), int(at[row + 1])
            if b - a >= words:
                found = np.sort(whole[a:b - words + 1])
                found = found[np.concatenate(([True], found[1:] != found[:-1]))]
            elif b > a:
                one = 0
                for h in hashes[a:b].tolist():
                    one = (one * int(_WORD) + h) & 0xFFFFFFFFFFFFFFFF
                found = mix(np.array([(one + b - a) & 0xFFFFFFFFFFFFFFFF], np.uint64))
            else:
                found = whole[:0]
            yield first + row, found
