"""Numpy views of Arrow text columns: many documents at once, no per-word Python."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer document is handled alone.
SLICE = 2 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = None


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the splitmix64 step); ``x`` is uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_codes() -> np.ndarray:
    """A random odd-looking 64-bit code for each byte value."""
    global _BYTE
    if _BYTE is None:
        _BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
    return _BYTE


_POWERS = np.ones(1, np.uint64)
_INVERSE = np.ones(1, np.uint64)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    global _POWERS, _INVERSE
    if len(_POWERS) < n:
        size = max(n + (n >> 2), 1 << 18)
        step = np.full(size, _BASE, np.uint64)
        back = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        step[0] = back[0] = 1
        _POWERS, _INVERSE = np.multiply.accumulate(step), np.multiply.accumulate(back)
    return _POWERS[:n], _INVERSE[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a position-weighted polynomial; ``span_hash`` reads spans from it.

    Equal hashes of such spans are a hint only: structured bytes can collide.
    """
    out = np.zeros(len(data) + 1, np.uint64)
    if len(data):
        np.cumsum(byte_codes()[data] * powers(len(data))[0], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:stop], the same wherever the bytes stand; start < len(data)."""
    return (sums[stop] - sums[start]) * powers(len(sums))[1][start]


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets into them) of a text or binary column, about ``size`` bytes each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, raw = column.buffers()
    if n == 0:
        return
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset: column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, to, data[offsets[at]: offsets[to]], offsets[at: to + 1] - offsets[at]
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and stops of the words, and the number of words of each document."""
    solid = ~IS_SPACE[data]
    first, last = solid.copy(), solid.copy()
    if len(data):
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        edge = offsets[(offsets > 0) & (offsets < len(data))]
        first[edge] = solid[edge]
        last[edge - 1] = solid[edge - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, stops, counts


#: Places of a span that have a row in the table of random codes; further ones are mixed one by one.
_PLACES = 64
_CODES = None


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hashes of sorted, disjoint spans: sums of a random code for each (place in the span, byte).

    Unlike a polynomial, no structure in the bytes makes two spans collide.
    """
    global _CODES
    if not len(starts):
        return np.zeros(0, np.uint64)
    if _CODES is None:
        _CODES = mix(np.arange(1, _PLACES * 256 + 1, dtype=np.uint64) * _ODD)
    base, end = int(starts[0]), int(stops[-1])
    part = data[base:end]
    place = np.arange(len(part), dtype=np.int32) - np.repeat((starts - base).astype(np.int32), np.diff(np.append(starts, end)))
    code = place.astype(np.int64) << 8 | part if len(part) >> 22 else place << 8 | part
    codes = _CODES[np.minimum(code, _PLACES * 256 - 1)]
    far = np.flatnonzero(place >= _PLACES)
    if len(far):
        codes[far] = mix((code[far].astype(np.uint64) + np.uint64(1)) * _ODD)
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(codes, out=sums[1:])
    return mix(sums[stops - base] - sums[starts - base] ^ (stops - starts).astype(np.uint64) * _ODD)


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether data[a:a + size] equals data[b:b + size], for arrays of places; eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    same, at = np.ones(len(a), bool), 0
    live = np.flatnonzero(a != b)
    while len(live):
        if at >= 512:  # few and long ones
            for i in live.tolist():
                same[i] = np.array_equal(data[a[i] + at: a[i] + size[i]], data[b[i] + at: b[i] + size[i]])
            break
        left = np.minimum(size[live] - at, 8).astype(np.uint64)
        differ = (eight[a[live] + at] ^ eight[b[live] + at]) << (np.uint64(64) - left * np.uint64(8)) % np.uint64(64)
        same[live] &= (differ == 0) | (left == 0)
        at += 8
        live = live[same[live] & (size[live] > at)]
    return same


def equal_spans(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, kind: np.ndarray | None = None):
    """(an example of each class, class of each span, hash of each class): spans of a class have the same bytes (and kind).

    Hashes bring spans together; every span is compared with its class's first.  Should a hash join different
    ones, these get classes of their own.
    """
    h = span_hashes(data, starts, stops)
    if kind is not None:
        h = mix(h ^ kind.astype(np.uint64))
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    other, size = first[which], stops - starts
    same = size == size[other]
    if kind is not None:
        same &= kind == kind[other]
    close = np.flatnonzero(same)
    same[close] = same_bytes(data, starts[close], starts[other[close]], size[close])
    if not same.all():
        more: dict = {}
        extra = []
        for i in np.flatnonzero(~same).tolist():
            key = data[starts[i]: stops[i]].tobytes(), None if kind is None else kind[i].item()
            if key not in more:
                more[key] = len(first) + len(extra)
                extra.append(i)
            which[i] = more[key]
        first = np.append(first, extra)
    return first, which, h[first]


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    return span_hashes(data, starts, stops)


def sequence_hashes(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hashes of every n consecutive values (across document borders too; the caller selects)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i, c in enumerate(mix(np.arange(1, n + 1, dtype=np.uint64) * _ODD + np.uint64(salt)) | np.uint64(1)):
        out += h[i: len(h) - n + 1 + i] * c
    return mix(out)
