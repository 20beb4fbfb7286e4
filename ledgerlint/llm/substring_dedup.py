"""Substring dedup (operator 8): prefix-partitioned suffix trees over words.

``repeats.py`` partitions all word suffixes by a part of their 35-word prefix, and
by the whole of it where a group would not fit in memory: variable-length prefixes.
For each prefix class a suffix tree of what follows the prefix is built in memory,
by inserting its suffixes; every inner node (and the root, which stands for the
prefix) is a string that occurs at least twice, ``length`` words or deeper, and is a
maximal repeat if the words to the left of its leaves differ.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``, unchanged; null text has none;
texts of fewer than 35 words have no window and stay; windows are judged on the
input; repeated rows are copies of each other; ids may be null; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .repeats import HOT, Chunk, Repeats, Units

LENGTH, RUN = 35, 12


class Node:
    """A node of a suffix tree: its depth in words, children by first word, suffixes that end here."""

    __slots__ = ("depth", "edge", "children", "ends")

    def __init__(self, depth: int, edge: list[int]):
        self.depth, self.edge, self.children, self.ends = depth, edge, {}, []


def build(suffixes: list[list[int]]) -> Node:
    """The compact tree of the given suffixes; members are their indices."""
    root = Node(0, [])
    for member, words in enumerate(suffixes):
        node, at = root, 0
        while True:
            if at == len(words):
                node.ends.append(member)
                break
            child = node.children.get(words[at])
            if child is None:
                leaf = node.children[words[at]] = Node(len(words), words[at:])
                leaf.ends.append(member)
                break
            n, edge = 0, child.edge
            most = min(len(edge), len(words) - at)
            while n < most and edge[n] == words[at + n]:
                n += 1
            if n < len(edge):  # split the edge
                inner = Node(node.depth + n, edge[:n])
                child.edge = edge[n:]
                inner.children[child.edge[0]] = child
                node.children[words[at]] = inner
                child = inner
            node, at = child, at + n
    return root


def tail_repeats(tails: list[list[int]], left: list):
    """(common prefix, members) of the maximal repeats among suffixes, given what stands left of each."""
    # depth first, children before parents
    todo, below = [(build(tails), False)], []
    while todo:
        node, done = todo.pop()
        if not done:
            todo.append((node, True))
            todo += [(x, False) for x in node.children.values()]
            continue
        members = list(node.ends)
        for _ in node.children:
            members += below.pop()
        below.append(members)
        if len(members) > 1 and (len(node.children) + len(node.ends) > 1) and any(left[m] != left[members[0]] for m in members):
            yield node.depth, members


def maximal_repeats(c: Chunk, length: int, pos: list[int], seg: list[int]):
    """(length, members) of the maximal repeats of one class of equal prefixes."""
    tails = [c.units[p + length: c.stop[s]].tolist() for p, s in zip(pos, seg)]
    # a segment's first window has no known left word: it differs from all others
    left = [-1 - k if p == c.begin[s] else int(c.units[p - 1]) for k, (p, s) in enumerate(zip(pos, seg))]
    for depth, members in tail_repeats(tails, left):
        yield length + depth, members


def repeats(docs: DataFrame, length: int = LENGTH, run: int = RUN, hot: int = HOT) -> Repeats:
    """``occurrences()``: maximal repeats with all occurrences; ``groups()``: these by distinct text; ``covers()``: spans; ``removed()``: the cut texts' digests."""
    return Repeats(docs, Units(True, length, run), maximal_repeats, tail_repeats, hot)
