"""Word shingles as numbers, for whole batches of texts at once.

Words are what stands between the blanks of `WORD_BREAKS`, with A-Z in lower case. A
shingle is five words in a row; a text of fewer words is one shingle. Each word becomes a
64-bit number, a hash of its bytes, each shingle one of 60 bits from its words.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORDS = 5
HASH_BITS = 60
_MASK = np.uint64((1 << HASH_BITS) - 1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[9, 10, 11, 12, 13, 32]] = True
_FACTORS = np.random.default_rng(11).integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    for factor in (0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each begins; a null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def find_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts' bytes with A-Z in lower case, where each word begins and ends there, and
    how many words each text has."""
    raw, at = _bytes_of(texts)
    low = _LOWER[raw]
    n = len(low)
    if not n:
        return low, np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    inside = ~_BREAK[low]
    edge = np.zeros(n + 1, dtype=bool)
    edge[at] = True  # a text begins or ends here
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return low, starts, ends, np.diff(np.searchsorted(starts, at))


def distinct_words(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct word stands first in the list, and which distinct word each one
    is. Words are told apart by their bytes."""
    n = len(starts)
    bounds = np.empty(2 * n, np.int64)
    bounds[::2], bounds[1::2] = starts, ends
    # Words and what stands between them lie one behind the other, as Arrow wants them.
    spelled = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 2 * n - 1, [None, pa.py_buffer(bounds), pa.py_buffer(low)])
    coded = np.asarray(spelled.dictionary_encode().indices)[::2]
    first = np.full(int(coded.max()) + 1, n, np.int64)
    first[coded[::-1]] = np.arange(n - 1, -1, -1)
    used = first < n
    return first[used], (np.cumsum(used) - 1)[coded]


def number_words(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number for each word, a hash of its bytes."""
    if not len(starts):
        return np.empty(0, np.uint64)
    first, which = distinct_words(low, starts, ends)
    view = memoryview(low)
    numbers = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    return np.array(numbers, np.uint64)[which]


def word_numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, and how many words each text has."""
    low, starts, ends, counts = find_words(texts)
    return number_words(low, starts, ends), counts


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The distinct shingles of each text in rising order."""
    words, counts = word_numbers(texts)
    windows = max(0, len(words) - WORDS + 1)
    total = np.zeros(windows, np.uint64)
    for k, factor in enumerate(_FACTORS):
        total += words[k : k + windows] * factor
    total = _mix(total) & _MASK
    out, at = [], 0
    for n in counts.tolist():
        if n >= WORDS:
            out.append(np.unique(total[at : at + n - WORDS + 1]))
        elif n:
            part = (words[at : at + n] * _FACTORS[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n)
            out.append(_mix(part) & _MASK)
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def set_number(shingles: np.ndarray) -> int:
    """One signed 64-bit number for a whole set."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes(), seed=len(shingles)) - (1 << 63)
