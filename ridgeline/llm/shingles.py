"""Word shingles of whole texts as sets of 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH = 5
# Text is hashed in segments of about this many bytes, cut between words, so
# scratch memory does not grow with the length of a text.
SEGMENT = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240229))  # fixed: hashes must agree between tasks
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER]
_MIX = (_rng.integers(1, 1 << 63, WIDTH, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_STEP = 0x9E3779B97F4A7C15 | 5
_BACK = pow(_STEP, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_cache: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _segment_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a buffer that cuts no word: a
    polynomial in the lower-cased bytes, from one running sum."""
    word = ~_BLANK[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    if len(_cache.get("up", ())) < len(buf):
        size = max(2 * SEGMENT, len(buf))
        _cache["up"], _cache["down"] = _powers(_STEP, size), _powers(_BACK, size)
        if size > 2 * SEGMENT:  # a single word longer than that: not kept
            up, down = _cache.pop("up"), _cache.pop("down")
        else:
            up, down = _cache["up"], _cache["down"]
    else:
        up, down = _cache["up"], _cache["down"]
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * up[:len(buf)], out=total[1:])
    return starts, mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(byte position, hash) of every word of a buffer."""
    buf = np.frombuffer(data, np.uint8)
    starts, hashes, lo = [], [], 0
    while lo < len(buf):
        hi = lo + SEGMENT
        while hi < len(buf):  # the next blank ends the segment
            gap = np.flatnonzero(_BLANK[buf[hi:hi + SEGMENT]])
            if len(gap):
                hi += int(gap[0])
                break
            hi += SEGMENT
        s, h = _segment_hashes(buf[lo:hi])
        starts.append(s + lo)
        hashes.append(h)
        lo = hi
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles: of five words, or
    of the whole sequence when it has fewer; empty without words."""
    done, part, size = 0, [], 0
    for t in texts:
        part.append((t or "").encode())
        size += len(part[-1]) + 1
        if size >= SEGMENT:
            yield from _sets(part)
            done, part, size = done + len(part), [], 0
    if part:
        yield from _sets(part)


def _sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    starts, words = word_hashes(b" ".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.concatenate(([0], np.searchsorted(starts, ends)))
    wide = np.empty(0, np.uint64)
    if len(words) >= WIDTH:
        n = len(words) - WIDTH + 1
        wide = words[:n] * _MIX[0]
        for k in range(1, WIDTH):
            wide += words[k:k + n] * _MIX[k]
        wide = mix(wide)
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if hi - lo >= WIDTH:
            own = np.sort(wide[lo:hi - WIDTH + 1])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif hi > lo:
            short = np.append(words[lo:hi] * _MIX[:hi - lo], np.uint64(hi - lo))
            yield mix(short.sum(dtype=np.uint64, keepdims=True))
        else:
            yield np.empty(0, np.uint64)
