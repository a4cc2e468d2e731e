"""Word and shingle hashes of whole texts with numpy, for use inside Spark tasks.

Words are runs of bytes other than ASCII white space, with A-Z lowered. Equal words have equal
64-bit hashes whatever the text around them; shingle hashes mix the hashes of their words.
"""

import numpy as np

SHINGLE = 5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 20


def _powers(base, count):
    """base ** 0, 1, ... modulo 2 ** 64, by doubling."""
    found = np.ones(count, np.uint64)
    have, step = 1, base
    while have < count:
        more = min(have, count - have)
        found[have : have + more] = found[:more] * np.uint64(step)
        have, step = have + more, step * step % (1 << 64)
    return found


_UP, _DOWN = _powers(_BASE, _CHUNK + 1), _powers(_INVERSE, _CHUNK + 1)


def mixed(values):
    """Well spread 64-bit values; a bijection."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(raw):
    """The 64-bit hash of each word of a text in UTF-8, in order."""
    data = _LOWER[np.frombuffer(raw, np.uint8)]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_BLANK[data]
    change = np.diff(inside)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    if len(data) > _CHUNK:
        # Powers are kept for shorter texts only; here each word starts with the first one.
        sums = np.array([_one(data[a:b]) for a, b in zip(starts, ends)], np.uint64)
    else:
        running = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[: len(data)], out=running[1:])
        sums = (running[ends] - running[starts]) * _DOWN[starts]
    return mixed(sums + (ends - starts).astype(np.uint64))


def _one(word):
    powers = _UP[: len(word)] if len(word) < len(_UP) else _powers(_BASE, len(word))
    return ((word.astype(np.uint64) + np.uint64(1)) * powers).sum(dtype=np.uint64)


def shingle_hashes(words, size=SHINGLE):
    """The distinct hashes, sorted, of runs of `size` words; of all words where there are fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    total = np.full(count, size, np.uint64)
    for at in range(size):
        total = mixed(total + words[at : at + count])
    return np.unique(total)
