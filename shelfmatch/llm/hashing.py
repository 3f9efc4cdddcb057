"""64-bit hashes of many pieces of one byte string at once."""

import hashlib

import numpy as np

STEP = np.uint64(0x9E3779B97F4A7C15)
LONG = 256  # bytes; longer pieces are hashed one by one

_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly; no two give the same."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def piece_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of raw[start:end] for each pair; equal pieces have equal hashes wherever they stand.

    Eight bytes at a time are mixed into the hash of those before, so no rule of arithmetic makes different pieces meet;
    up to eight bytes, pieces of one length never do. Who needs certainty compares the bytes of equal hashes.
    """
    sizes = ends - starts
    found = mixed(sizes.astype(np.uint64) * STEP)
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    open_ = np.flatnonzero((sizes > 0) & (sizes <= LONG))
    done = 0
    while len(open_):
        left = sizes[open_] - done
        found[open_] = mixed(found[open_] ^ (eight[starts[open_] + done] & _LOW_BYTES[np.minimum(left, 8)]))
        open_ = open_[left > 8]
        done += 8
    for i in np.flatnonzero(sizes > LONG).tolist():
        found[i] = int.from_bytes(hashlib.blake2b(raw[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    return found
