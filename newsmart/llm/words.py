"""Words of a text as 64-bit hashes, and hashes of windows of words (numpy)."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes hashed at once; a longer text is cut at white space.
_SLICE = 1 << 21
_BLOCK = 4096
_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_LOW = _powers(0x9E3779B97F4A7C15, _BLOCK)
_HIGH = int(_LOW[-1]) * 0x9E3779B97F4A7C15 & (2**64 - 1)


def spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, in bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def _hashes(data: bytes) -> np.ndarray:
    buf = np.frombuffer(data, np.uint8)
    starts, ends = spans(data)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    power = _LOW[place % _BLOCK]
    if (longest := int(lengths.max())) > _BLOCK:
        power = power * _powers(_HIGH, longest // _BLOCK + 1)[place // _BLOCK]
    letters = buf[~_SPACE[buf]].astype(np.uint64) + _U(1)
    return mix(np.add.reduceat(letters * power, first) + lengths.astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def hashes(data: bytes) -> np.ndarray:
    """One hash per word, in order."""
    if len(data) <= _SLICE:
        return _hashes(data)
    parts, at = [], 0
    while at < len(data):
        end = min(at + _SLICE, len(data))
        if end < len(data):
            gaps = np.flatnonzero(_SPACE[np.frombuffer(data[at:end], np.uint8)])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # one word longer than a slice
                while end < len(data) and not _SPACE[data[end]]:
                    end += 1
        parts.append(_hashes(data[at:end]))
        at = end
    return np.concatenate(parts)


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """One hash per window of k words, in order; none if there are fewer words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, factor = np.zeros(n, np.uint64), 1
    for j in range(k):
        factor = factor * 0xC2B2AE3D27D4EB4F % 2**64
        out += words[j : j + n] * _U(factor)
    return mix(out)


def masked_hashes(words: np.ndarray, places: tuple[int, ...]) -> np.ndarray:
    """One hash per window, of the words at ``places`` alone."""
    n = len(words) - places[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, factor = np.zeros(n, np.uint64), 1
    for j in places:
        factor = factor * 0xC2B2AE3D27D4EB4F % 2**64
        out += words[j : j + n] * _U(factor)
    return mix(out + _U(sum(1 << j for j in places)))


def repeated(values: np.ndarray) -> np.ndarray:
    """Which values occur twice or more, the first included."""
    order = np.sort(values)
    twice = order[1:][order[1:] == order[:-1]]
    return np.isin(values, twice) if len(twice) else np.zeros(len(values), bool)


def covered(windows: np.ndarray, k: int) -> np.ndarray:
    """Which words lie in a marked window of k words."""
    steps = np.zeros(len(windows) + k, np.int32)
    steps[: len(windows)] += windows
    steps[k:] -= windows
    return np.cumsum(steps[:-1]) > 0 if len(windows) else np.zeros(0, bool)
