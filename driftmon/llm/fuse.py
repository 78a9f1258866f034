"""Binary fuse filters in numpy: three slots per key in neighbouring segments, one byte each.

Built once from a fixed key set and never changed after that. A lookup of a member always
passes; another key passes once in 256.
"""

import math

import numpy as np

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)  # 64-bit mixing constants
_HALF = np.uint64(33)


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys + np.uint64(int(seed) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> _HALF)) * _M1
        x = (x ^ (x >> _HALF)) * _M2
        return x ^ (x >> _HALF)


def _layout(n: int) -> tuple[int, int]:
    """Segment length (a power of two) and number of segments for n keys."""
    length = 1 << max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25))
    room = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 3))) + 8
    return length, max(1, math.ceil(room / length) - 2)


def _slots(h: np.ndarray, length: int, segments: int) -> np.ndarray:
    first = ((h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)) * np.uint64(length)
    low = np.uint64(length - 1)
    steps = [(h >> np.uint64(s)) & low for s in (0, 10, 20)]
    return np.stack([first + np.uint64(i * length) + steps[i] for i in range(3)]).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(29))) & np.uint64(0xFF)).astype(np.uint8)


def build(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, fingerprints) over the distinct 64-bit keys."""
    keys = np.unique(np.asarray(keys).astype(np.uint64))
    length, segments = _layout(len(keys))
    size = (segments + 2) * length
    for seed in range(1, 1000):
        h = _mix(keys, seed)
        slots = _slots(h, length, segments)
        layers = _peel(slots, size)
        if layers is not None:
            break
        if seed % 20 == 0:
            segments += max(1, segments // 10)
            size = (segments + 2) * length
    else:
        raise RuntimeError("no seed peels these keys")
    table, prints = np.zeros(size, np.uint8), _prints(h)
    # Keys of a layer share no slot with the own slot of another of that layer.
    for key, own in reversed(layers):
        others = table[slots[0, key]] ^ table[slots[1, key]] ^ table[slots[2, key]] ^ table[own]
        table[own] = others ^ prints[key]
    return seed, length, segments, table.tobytes()


def _peel(slots: np.ndarray, size: int) -> list | None:
    """Layers of (keys, own slots), each alone in its slot once the earlier ones are gone."""
    ids = np.arange(slots.shape[1])
    count, held = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for row in slots:
        np.add.at(count, row, 1)
        np.bitwise_xor.at(held, row, ids)
    layers, left = [], len(ids)
    lone = np.flatnonzero(count == 1)
    while len(lone):
        key, at = np.unique(held[lone], return_index=True)
        layers.append((key, lone[at]))
        left -= len(key)
        for row in slots[:, key]:
            np.subtract.at(count, row, 1)
            np.bitwise_xor.at(held, row, key)
        touched = np.unique(slots[:, key])
        lone = touched[count[touched] == 1]
    return layers if left == 0 else None


def contains(filter_: tuple[int, int, int, bytes], keys: np.ndarray) -> np.ndarray:
    seed, length, segments, data = filter_
    table = np.frombuffer(data, np.uint8)
    h = _mix(np.asarray(keys).astype(np.uint64), seed)
    a, b, c = _slots(h, int(length), int(segments))
    return (table[a] ^ table[b] ^ table[c]) == _prints(h)
