"""The runs of characters of lines, their hashes, buckets and similarity in numpy, for lines in memory.

The plain version that the tests hold the DataFrame functions of ``line_dedup`` against; no query runs it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import text_blocks

SHINGLE = 10
SIMILARITY = 0.8
BANDS = 8
ROWS = 4
#: Lines of fewer shingles are found by prefixes; those of up to SHORT_NEAR by prefixes as well.
SHORT = 16
SHORT_NEAR = int((SHORT - 1) / SIMILARITY)
PREFIXES = SHORT_NEAR - int(np.ceil(SIMILARITY * SHORT_NEAR)) + 1
LOG_SKETCH = 11
SKETCH = 1 << LOG_SKETCH
SKETCH_WORDS = SKETCH // 64
#: Bits of a shingle's hash; the others of 64 hold the line's place in its block.
HASH_BITS = 52
#: Most lines, and about how many bytes of them, hashed at once: a hash is 8 bytes a character, and some ten arrays are alive.
BLOCK_LINES = 1 << (64 - HASH_BITS)
HASH_BYTES = 1 << 18
_LOW = np.uint64((1 << HASH_BITS) - 1)
#: Odd constants that the hashes are mixed with.
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def _run_hashes(chars: np.ndarray) -> np.ndarray:
    """The hash of the run of ``SHINGLE`` characters that begins at each place but the last ones."""
    mixed = _scramble(chars)
    n = max(len(chars) - SHINGLE + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        out *= _MIX[0]
        out += mixed[j:j + n]
    return _scramble(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of all lines, each below its line's number, and where each line's begin.

    ``data`` holds the UTF-8 bytes of the lines, ``offsets`` where each begins, and the end; no line is empty.
    """
    first = (data & 0xC0) != 0x80
    first[offsets[:-1]] = True
    starts = np.flatnonzero(first)
    at = np.searchsorted(starts, offsets)
    # A character's number: its bytes; never 0, which fills up short lines.
    chars = data[starts].astype(np.uint64)
    if len(starts) < len(data):
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        more = np.ones(len(starts), bool)
        for k in (1, 2, 3):
            byte = padded[starts + k]
            more &= (byte & 0xC0) == 0x80
            chars |= np.where(more, byte, 0).astype(np.uint64) << np.uint64(8 * k)
    chars += np.uint64(1)
    lengths = np.diff(at)
    runs = np.maximum(lengths - SHINGLE + 1, 0)
    line = np.repeat(np.arange(len(lengths), dtype=np.uint64), runs)
    place = np.arange(len(line)) + np.repeat(at[:-1] - np.cumsum(runs) + runs, runs)
    short = np.flatnonzero(runs == 0)
    filled = np.zeros((len(short), SHINGLE), np.uint64)
    for j in range(SHINGLE - 1):
        there = lengths[short] > j
        filled[there, j] = chars[at[short[there]] + j]
    hashes = np.concatenate([_run_hashes(chars)[place], _run_hashes(filled.ravel())[::SHINGLE]])
    line = np.concatenate([line, short.astype(np.uint64)])
    sets = np.sort((line << np.uint64(HASH_BITS)) | (hashes >> np.uint64(64 - HASH_BITS)))
    sets = sets[np.concatenate([[True], sets[1:] != sets[:-1]])]
    begins = np.searchsorted(sets, np.arange(len(lengths), dtype=np.uint64) << np.uint64(HASH_BITS))
    return sets, np.append(begins, len(sets))


def band_keys(sets: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The buckets of each line, one for each band.

    The points of the ring are the beginnings of ``BANDS`` equal parts of the hashes' range;
    a band goes round the end of its line's hashes.
    """
    own, sizes = begins[:-1], np.diff(begins)
    line = np.arange(len(own), dtype=np.uint64) << np.uint64(HASH_BITS)
    out = np.empty((len(own), BANDS), np.uint64)
    for t in range(BANDS):
        point = np.uint64(t * (1 << HASH_BITS) // BANDS)
        begin = np.searchsorted(sets, line | point) - own
        key = np.full(len(own), t + 1, np.uint64)
        for j in range(ROWS):
            key = _scramble(key * _MIX[0] + (sets[own + (begin + j) % sizes] & _LOW))
        out[:, t] = key
    return out.view(np.int64)


def prefix_keys(sets: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The prefix buckets of each line, and which of them there are: those of short lines and their neighbours."""
    own, sizes = begins[:-1], np.diff(begins)
    wanted = np.where(sizes <= SHORT_NEAR, sizes - np.ceil(SIMILARITY * sizes - 1e-9).astype(np.int64) + 1, 0)
    there = np.arange(PREFIXES) < wanted[:, None]
    keys = np.zeros((len(own), PREFIXES), np.uint64)
    for j in range(PREFIXES):
        keys[:, j] = _scramble((sets[np.minimum(own + j, len(sets) - 1)] & _LOW) * _MIX[0] + np.uint64(BANDS + 1))
    return keys.view(np.int64), there


def line_keys(sets: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of each line, and which of them there are."""
    bands = band_keys(sets, begins)
    prefixes, there = prefix_keys(sets, begins)
    long = np.broadcast_to((np.diff(begins) >= SHORT)[:, None], bands.shape)
    return np.concatenate([bands, prefixes], axis=1), np.concatenate([long, there], axis=1)


def sketches(sets: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """For each line, which of ``SKETCH`` equal parts of the hashes' range hold one of its hashes, as words of bits."""
    part = sets >> np.uint64(HASH_BITS - LOG_SKETCH)  # with the line's number above
    out = np.zeros((len(begins) - 1) * SKETCH_WORDS, np.uint64)
    np.bitwise_or.at(out, (part >> np.uint64(6)).astype(np.int64), np.uint64(1) << (part & np.uint64(63)))
    return out.reshape(-1, SKETCH_WORDS).view(np.int64)


def near_lines(a: pa.Array, b: pa.Array) -> np.ndarray:
    """For each pair of lines, is their similarity at least the threshold."""
    near = np.zeros(len(a), bool)
    long = np.cumsum(pc.add(pc.binary_length(a), pc.binary_length(b)).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(a):
        end = int(np.searchsorted(long, HASH_BYTES + (long[at - 1] if at else 0), side="right"))
        end = min(max(end, at + 1), at + BLOCK_LINES)
        found = []
        for x in (a, b):
            _, _, data, offsets = next(text_blocks(x.slice(at, end - at), int(long[-1])))
            found.append(shingle_sets(data, offsets))
        (sa, na), (sb, nb) = found
        merged = np.sort(np.concatenate([sa, sb]))
        same = merged[1:][merged[1:] == merged[:-1]] >> np.uint64(HASH_BITS)
        both = np.bincount(same.astype(np.int64), minlength=end - at)
        near[at:end] = both >= SIMILARITY * (np.diff(na) + np.diff(nb) - both)
        at = end
    return near
