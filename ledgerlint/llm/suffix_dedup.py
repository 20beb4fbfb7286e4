"""Suffix-array dedup (operator 9): common-prefix intervals of an enhanced suffix array, over bytes.

Every whole text is its UTF-8 bytes.  ``repeats.py`` brings together the suffixes
whose 200-byte prefixes can be equal.  In each prefix class the suffixes are sorted
and the common prefixes of neighbours computed (the enhanced suffix array of the
group); a stack-scan over these gives the tree of common-prefix intervals, and an
interval whose suffixes differ in the byte to their left is a maximal repeat, with
all its occurrences.  Removing all occurrences removes each byte covered by a
200-byte string that also starts anywhere else.

Defined results: null text counts as empty; texts of fewer than 200 bytes have no
window and stay; matches never cross documents and may overlap; repeated rows are
copies of each other; ids may be null; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .repeats import HOT, Chunk, Repeats, Units

LENGTH, RUN = 200, 64


def common_prefix(a: bytes | list, b: bytes | list) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    if isinstance(a, bytes):
        return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))
    return next(i for i in range(n) if a[i] != b[i])


def intervals(lcp: list[int]):
    """(depth, first, last) of the inner common-prefix intervals of a suffix array, by a stack-scan.

    lcp[i] belongs to the suffixes i - 1 and i; lcp[0] is ignored.
    """
    stack: list[list[int]] = []  # [depth, first suffix]
    for i in range(1, len(lcp) + 1):
        depth, first = (lcp[i] if i < len(lcp) else -1), i - 1
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            yield top, first, i - 1
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append([depth, first])


def tail_repeats(tails: list, left: list):
    """(common prefix, members) of the maximal repeats among suffixes, given what stands left of each."""
    array = sorted(range(len(tails)), key=tails.__getitem__)
    lcp = [0] + [common_prefix(tails[a], tails[b]) for a, b in zip(array, array[1:])]
    change = [0] * len(array)  # how often the left unit changes up to here: an interval is diverse if it does inside
    for i in range(1, len(array)):
        change[i] = change[i - 1] + (left[array[i]] != left[array[i - 1]])
    for depth, first, last in intervals(lcp):
        if change[last] > change[first]:
            yield depth, array[first: last + 1]


def maximal_repeats(c: Chunk, length: int, pos: list[int], seg: list[int]):
    """(length, members) of the maximal repeats of one class of equal prefixes."""
    tails = [c.units[p + length: c.stop[s]].astype(np.uint8).tobytes() for p, s in zip(pos, seg)]
    # a segment's first window has no known left unit: it differs from all others
    left = [-1 - k if p == c.begin[s] else int(c.units[p - 1]) for k, (p, s) in enumerate(zip(pos, seg))]
    for depth, members in tail_repeats(tails, left):
        yield length + depth, members


def repeats(docs: DataFrame, length: int = LENGTH, run: int = RUN, hot: int = HOT) -> Repeats:
    """``occurrences()``: maximal repeats with all occurrences; ``groups()``: these by distinct text; ``covers()``: spans; ``removed()``: the cut texts' digests."""
    return Repeats(docs, Units(False, length, run), maximal_repeats, tail_repeats, hot)
