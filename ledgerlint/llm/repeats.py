"""Repeated windows of whole texts: routing shared by the two substring operators.

A window is L consecutive units (words or bytes).  Its anchor is the smallest hash
of the k-unit runs inside it, so equal windows have equal anchors, wherever they
stand.  Consecutive windows with one anchor travel together as one segment, and the
segments of an anchor form a group that is small enough for memory: that is a
partition of all suffixes by a part of their L-unit prefix.  Anchors that occur
once in the corpus can't belong to a repeat and their texts are never moved.

Equal segments are one body with a count, aggregated before the shuffle, so the
inside of a passage that any share of the documents holds is one row.  For an anchor
with more than ``HOT`` different bodies the routing prefix is lengthened to all L
units: each window goes by its 128-bit digest, counted before the shuffle too.
Anchors only bring windows together; words, and windows of one group, count as
equal after a comparison unit by unit.

Equal texts are one node; if it has more than one document and at least L units,
all of it is repeated.

``groups()`` joins the windows again across segments.  A stretch of windows that always
stand together is one letter: where a window has several left or right neighbours in the
corpus a letter begins or ends, so each maximal repeat is a string of whole letters.  The
suffixes of the texts' letter strings are partitioned by variable-length prefixes until a
group fits in memory, and the operator's own finder works on each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .exact_dedup import located
from .textbytes import equal_spans, mix, powers, prefix_sums, sequence_hashes, slices, span_hash, word_hashes, word_spans

#: Different segments of one anchor that a task takes at most.
HOT = 1 << 16
#: Bytes of segments that a task works on at once (whole groups, so a little more).
CHUNK = 2 << 20
#: Letters of a suffix that a round of ``groups()`` looks at, and suffixes of one prefix that a task takes at most.
LOOK, SUFFIXES = 64, 1 << 13
PLACE = ["__file", "__row"]


@dataclass(frozen=True)
class Units:
    """What a window is made of: ``length`` units each, anchored by runs of ``run`` units."""

    words: bool
    length: int
    run: int


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    out, step = x, 1
    while step * 2 <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    n = len(x) - width + 1
    return np.minimum(out[:n], out[width - step: width - step + n])


def _anchors(u: Units, data: np.ndarray, offsets: np.ndarray):
    """Units by document, and (document, anchor, first window, windows) of every segment."""
    if u.words:
        starts, stops, counts = word_spans(data, offsets)
        runs = sequence_hashes(word_hashes(data, starts, stops), u.run)
    else:
        counts = np.diff(offsets)
        at = np.arange(max(0, len(data) - u.run + 1))
        runs = mix(span_hash(prefix_sums(data), at, at + u.run)) if len(at) else np.zeros(0, np.uint64)
    base = np.cumsum(counts) - counts
    total = int(counts.sum())
    if total < u.length:
        none = np.zeros(0, np.int64)
        return counts, none, none.astype(np.uint64), none, none
    doc = np.repeat(np.arange(len(counts)), counts)
    low = sliding_min(runs, u.length - u.run + 1)
    inside = doc[: len(low)] == doc[u.length - 1:]
    new = inside.copy()
    # the next window's anchor is another one, or another occurrence of the same run
    new[1:] &= (low[1:] != low[:-1]) | (runs[: len(low) - 1] == low[:-1]) | ~inside[:-1] | (doc[1: len(low)] != doc[: len(low) - 1])
    first = np.flatnonzero(new)
    seg_doc = doc[first]
    last = np.append(first[1:], 0)
    final = np.append(seg_doc[1:] != seg_doc[:-1], True)  # the document's last segment
    ends = base + counts - u.length + 1
    last[final] = ends[seg_doc[final]]
    return counts, seg_doc, low[first], first - base[seg_doc], last - first


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(values))


def scan(docs: DataFrame, u: Units) -> DataFrame:
    """Per located document: doc_id, place, digest of the text, n_units, sha256 of the whole output, its segments' lists."""

    def run(batches):
        for batch in batches:
            n_units, hashes, firsts, sizes, per_doc, shas = [], [], [], [], [], []
            for at, to, data, offsets in slices(batch.column("text")):
                counts, doc, low, first, size = _anchors(u, data, offsets)
                n_units.append(counts)
                hashes.append(low.view(np.int64))
                firsts.append(first.astype(np.int32))
                sizes.append(size.astype(np.int32))
                per_doc.append(np.bincount(doc, minlength=to - at))
                if u.words:
                    raw = data.tobytes()
                    shas += [hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            if not n_units:
                continue
            per = np.concatenate(per_doc)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", *PLACE, "digest")), pa.array(np.concatenate(n_units).astype(np.int64)),
                 pa.array(shas) if u.words else batch.column("digest"),
                 _lists(np.concatenate(hashes), per), _lists(np.concatenate(firsts), per), _lists(np.concatenate(sizes), per)],
                names=["doc_id", *PLACE, "digest", "n_units", "whole_sha256", "anchors", "firsts", "sizes"])

    kind = dict(docs.dtypes)["doc_id"]
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", *PLACE, F.sha2(text, 256).alias("digest"), text.alias("text")).mapInArrow(
        run, f"doc_id {kind}, __file string, __row bigint, digest string, n_units bigint, whole_sha256 string, "
             "anchors array<bigint>, firsts array<int>, sizes array<int>")


def _segments(texts: DataFrame, u: Units) -> DataFrame:
    """anchor, node, first, body of every listed segment; words are joined by one space."""

    def run(batches):
        for batch in batches:
            out = {name: [] for name in ("anchor", "node", "first", "body")}
            segs = batch.column("segs").to_pylist()
            nodes = batch.column("node").to_pylist()
            text = batch.column("text")
            for i in range(batch.num_rows):
                raw = text[i].as_buffer().to_pybytes()
                units = raw.split() if u.words else raw
                for s in segs[i]:
                    a, b = s["first"], s["first"] + s["size"] + u.length - 1
                    out["anchor"].append(s["anchor"])
                    out["node"].append(nodes[i])
                    out["first"].append(a)
                    out["body"].append(b" ".join(units[a:b]) if u.words else units[a:b])
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    return texts.select("node", F.col("text").cast("binary").alias("text"), "segs").mapInArrow(
        run, "anchor bigint, node bigint, first int, body binary")


@dataclass
class Chunk:
    """Whole anchor groups: the units of all bodies in one array."""

    units: np.ndarray  # unit codes; equal units have equal codes
    begin: np.ndarray  # of each body in units
    stop: np.ndarray
    group: np.ndarray  # the anchor of each body
    count: np.ndarray  # how many segments have this body


def _chunk(u: Units, rows: list) -> Chunk:
    """From (anchor, key, n, body) rows."""
    group, _, count, body = zip(*rows)
    data = np.frombuffer(b"\n".join(body) if u.words else b"".join(body), np.uint8)
    size = np.fromiter(map(len, body), np.int64, len(body))
    units = data
    if u.words:
        ends = np.cumsum(size + 1)
        starts, stops, size = word_spans(data, np.append(0, np.append(ends[:-1], len(data))))
        units = equal_spans(data, starts, stops)[1]
    stop = np.cumsum(size)
    return Chunk(units.astype(np.int64), stop - size, stop, np.array(group, np.int64), np.array(count, np.int64))


def same_windows(units: np.ndarray, key: np.ndarray, pos: np.ndarray, length: int) -> np.ndarray:
    """Classes of the windows units[p:p + length] such that windows of one class have equal units, not only equal keys.

    Every window is compared with its class's first.  Neighbouring windows whose firsts are neighbours too are
    compared as one stretch, so each unit of it is looked at once.
    """
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    shift = pos - pos[first[which]]
    todo = np.flatnonzero(shift)
    if not len(todo):
        return which
    todo = todo[np.lexsort((pos[todo], shift[todo]))]
    p, d = pos[todo], shift[todo]
    opens = np.ones(len(p), bool)
    opens[1:] = (p[1:] != p[:-1] + 1) | (d[1:] != d[:-1])
    at = np.flatnonzero(opens)
    n = np.diff(np.append(at, len(p)))  # windows of each stretch
    wrong, run = [], 0
    while run < len(at):  # some stretches at once, to bound the memory
        to = max(run + 1, int(np.searchsorted(np.cumsum(n[run:] + length), 1 << 21)) + run)
        size = n[run:to] + length - 1
        ends = np.cumsum(size)
        place = np.repeat(p[at[run:to]] - ends + size, size) + np.arange(ends[-1])
        differ = units[place] != units[place - np.repeat(d[at[run:to]], size)]
        if differ.any():
            seen = np.append(0, np.cumsum(differ))
            begin = np.repeat(ends - size, n[run:to]) + (p[at[run]: at[run] + n[run:to].sum()] - np.repeat(p[at[run:to]], n[run:to]))
            wrong.append(todo[at[run]: at[run] + n[run:to].sum()][seen[begin + length] > seen[begin]])
        run = to
    if wrong:
        more: dict = {}
        for i in np.concatenate(wrong).tolist():
            which[i] = more.setdefault((which[i], units[pos[i]: pos[i] + length].tobytes()), len(first) + len(more))
    return which


def window_classes(u: Units, c: Chunk):
    """Class, position in c.units and body of every window, by body and position."""
    windows = c.stop - c.begin - u.length + 1
    seg = np.repeat(np.arange(len(windows)), windows)
    pos = np.arange(len(seg)) + np.repeat(c.begin - np.cumsum(windows) + windows, windows)
    codes = mix(c.units.astype(np.uint64) + np.uint64(1))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(len(codes))[0], out=sums[1:])
    key = mix(span_hash(sums, pos, pos + u.length) ^ mix(c.group.view(np.uint64)[seg]))
    return same_windows(c.units, key, pos, u.length), pos, seg


def letters(u: Units, c: Chunk):
    """(class of the first window, its position, body, windows) of the repeated stretches that always stand together.

    Cuts depend on the units around them only, so equal texts are cut alike: before a window
    that has several left neighbours in its group, after one with several right
    neighbours, and at the ends of segments.
    """
    key, pos, seg = window_classes(u, c)
    if not len(key):
        return key, pos, seg, pos
    key = np.unique(key, return_inverse=True)[1]
    many = (np.bincount(key, c.count[seg]) > 1)[key]
    opens, closes = pos == c.begin[seg], pos + u.length == c.stop[seg]

    def varied(edge: np.ndarray, unit: np.ndarray) -> np.ndarray:
        low, high, out = np.full(key.max() + 1, unit.max()), np.full(key.max() + 1, -1), np.zeros(key.max() + 1, bool)
        np.minimum.at(low, key, unit)
        np.maximum.at(high, key, unit)
        out[key[edge]] = True
        return (out | (low != high))[key]

    left = varied(opens, c.units[np.maximum(pos - 1, 0)])
    right = varied(closes, c.units[np.minimum(pos + u.length, len(c.units) - 1)])
    starts = opens | left
    starts[1:] |= right[:-1] | ~many[:-1]
    at = np.flatnonzero(starts | ~many)
    size = np.diff(np.append(at, len(key)))
    use = many[at]
    return key[at][use], pos[at][use], seg[at][use], size[use]


def repeated_windows(u: Units, c: Chunk):
    """Suffixes whose L-unit prefix occurs at least twice in its group, and from where a repeat may begin.

    Returns arrays, sorted by prefix class: class number, position in c.units, body; a
    body that several segments have stands twice.  Classes whose members all have the
    same unit to their left are left out: their repeats begin further left.  A
    segment's first window counts as a beginning.
    """
    key, pos, seg = window_classes(u, c)
    order = np.argsort(key, kind="stable")
    key, pos, seg = key[order], pos[order], seg[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(key)))
    many = np.add.reduceat(c.count[seg], at) > 1 if len(at) else np.zeros(0, bool)
    if not many.any():
        none = np.zeros(0, np.int64)
        return none, none, none
    opens = pos == c.begin[seg]
    left = np.where(opens, -1, c.units[np.maximum(pos - 1, 0)])
    varied = np.logical_or.reduceat(opens, at) | (np.minimum.reduceat(left, at) != np.maximum.reduceat(left, at))
    use = np.repeat(many & varied, count)
    klass, pos, seg = np.repeat(np.arange(len(at)), count)[use], pos[use], seg[use]
    twice = np.where(c.count[seg] > 1, 2, 1)
    return np.repeat(klass, twice), np.repeat(pos, twice), np.repeat(seg, twice)


def repeats_of(u: Units, c: Chunk, finder: Callable):
    """(length, members) of the maximal repeats of a chunk; members index the returned positions and segments."""
    klass, pos, seg = repeated_windows(u, c)
    found = []
    at = np.flatnonzero(np.append(True, klass[1:] != klass[:-1])) if len(klass) else []
    for a, b in zip(at, [*at[1:], len(klass)]):
        found += [(n, [a + i for i in m]) for n, m in finder(c, u.length, pos[a:b].tolist(), seg[a:b].tolist())]
    return found, pos, seg


def _grouped(batches, limit: int = CHUNK):
    """Lists of (anchor, key, n, body) that hold whole groups, from rows sorted by anchor."""
    rows, size, last = [], 0, None
    for batch in batches:
        columns = [batch.column(x).to_pylist() for x in ("anchor", "key", "n", "body")]
        for row in zip(*columns):
            if row[0] != last and size >= limit:
                yield rows
                rows, size = [], 0
            last = row[0]
            rows.append(row)
            size += len(row[3])
    if rows:
        yield rows


def _hot_windows(bodies: DataFrame, u: Units) -> DataFrame:
    """window (a digest of all L units), anchor, key, n, start of every window of some bodies."""

    def run(batches):
        for batch in batches:
            for rows in _grouped([batch]):
                out = []
                for anchor, key, n, body in rows:
                    units = body.split() if u.words else body
                    for start in range(len(units) - u.length + 1):
                        part = units[start: start + u.length]
                        window = hashlib.blake2b(b" ".join(part) if u.words else part, digest_size=16).digest()
                        out.append((window, anchor, key, n, start))
                window, anchor, key, n, start = zip(*out)
                kinds = (pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((window, anchor, key, n, start), kinds)],
                                                 names=["window", "anchor", "key", "n", "start"])

    return bodies.mapInArrow(run, "window binary, anchor bigint, key string, n bigint, start bigint")


def merge(spans: np.ndarray) -> np.ndarray:
    """The union of [start, stop) rows as maximal spans."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    at = np.flatnonzero(new)
    return np.stack([spans[at, 0], reach[np.append(at[1:], len(spans)) - 1]], 1)


def _by_group(batches):
    """(group, rows) from rows sorted by the first column."""
    rows: list = []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            if rows and row[0] != rows[0][0]:
                yield rows[0][0], rows
                rows = []
            rows.append(row)
    if rows:
        yield rows[0][0], rows


#: A suffix with the prefix ``group`` of ``length`` units: its place, the index of the next letter in its run, the letter to its left.
TODO = ["group", "length", "node", "run", "at", "start", "left"]
PENDING = "group bigint, length bigint, node bigint, run bigint, at int, start bigint, left bigint, more boolean"


def _pending(rows: list) -> pa.RecordBatch:
    group, length, node, run, at, start, left, more = zip(*rows)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
    columns = (group, length, node, run, at, start, left, more)
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names=[*TODO, "more"])


def _varied(neighbour: str):
    """Whether a group has several neighbours; a missing one is unlike all others, and alone it is not several."""
    return (F.count("*") > 1) & ((F.count(neighbour) < F.count("*")) | F.coalesce(F.min(neighbour) != F.max(neighbour), F.lit(False)))


class Repeats:
    """The repeats of a corpus.

    ``finder(chunk, L, positions, segments)`` yields (length, members) of a prefix class;
    ``tails(suffixes, lefts)`` yields (common prefix, members) of the maximal repeats among suffixes.
    """

    def __init__(self, docs: DataFrame, u: Units, finder: Callable, tails: Callable, hot: int = HOT):
        self.u, self.finder, self.tails, self.suffixes = u, finder, tails, min(hot, SUFFIXES)
        docs = located(docs.select("doc_id", "text"))
        self.rows = stage(scan(docs, u), "repeat-scan")
        nodes = self.rows.groupBy("digest").agg(
            F.min(F.struct(*PLACE)).alias("at"), F.count("*").alias("copies"), F.first("n_units").alias("n_units"),
            F.first("anchors").alias("anchors"), F.first("firsts").alias("firsts"), F.first("sizes").alias("sizes"))
        self.nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "repeat-nodes")
        segs = self.nodes.select("node", F.explode(F.arrays_zip("anchors", "firsts", "sizes")).alias("s")).select(
            "node", F.col("s.anchors").alias("anchor"), F.col("s.firsts").alias("first"), F.col("s.sizes").alias("size"))
        # written, so that the join below has a plain shuffle on both sides and Spark can split a hot anchor
        often = stage(segs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "repeat-often")
        listed = segs.join(often, "anchor").groupBy("node").agg(F.collect_list(F.struct("anchor", "first", "size")).alias("segs"))
        listed = listed.join(self.nodes.select("node", "at.*"), "node")
        texts = docs.select(*PLACE, F.coalesce("text", F.lit("")).alias("text")).join(listed, PLACE)
        self.texts = stage(texts.select("node", "text", "segs"), "repeat-texts")
        self.segments = stage(_segments(self.texts, u).withColumn("key", F.md5("body")), "repeat-segments")
        self.bodies = stage(self.segments.groupBy("anchor", "key").agg(
            F.count("*").alias("n"), F.first("body").alias("body")), "repeat-bodies")
        self.hot = stage(self.bodies.groupBy("anchor").agg(F.count("*").alias("bodies")).where(F.col("bodies") > hot).select("anchor"), "repeat-hot-anchors")

    def _routed(self) -> DataFrame:
        cold = self.bodies.join(self.hot, "anchor", "left_anti").select("anchor", "key", "n", "body")
        return cold.repartition("anchor").sortWithinPartitions("anchor")

    def _hot_repeats(self, numbered: bool = False) -> DataFrame:
        """anchor, key, start of the repeated windows of the hot anchors' bodies; ``numbered``: also each window's letter."""
        windows = stage(_hot_windows(self.bodies.join(self.hot, "anchor", "left_semi").select("anchor", "key", "n", "body"), self.u), "repeat-hot")
        many = windows.groupBy("window").agg(F.sum("n").alias("total")).where("total > 1").select("window")
        if numbered:
            many = stage(many.withColumn("letter", -1 - F.monotonically_increasing_id()), "repeat-hot-letters")
        return windows.join(many, "window").drop("window", "n")

    def _placed(self, spans: DataFrame, *columns: str) -> DataFrame:
        """Spans (anchor, key, start) of bodies at all the places where the bodies stand: node, start and more columns."""
        return spans.join(self.segments.select("anchor", "key", "node", "first"), ["anchor", "key"]).select(
            "node", (F.col("start") + F.col("first")).alias("start"), *columns)

    def _runs(self) -> DataFrame:
        """node, run, and by letter of the run: starts, sizes (in windows), letters.  A run is a gapless string of letters."""
        u = self.u

        def run(batches):
            from pyspark import TaskContext

            number = TaskContext.get().partitionId() << 33
            for rows in _grouped(batches):
                c = _chunk(u, rows)
                klass, pos, seg, size = letters(u, c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.group[seg]), pa.array([rows[b][1] for b in seg.tolist()], pa.string()),
                     pa.array((pos - c.begin[seg]).astype(np.int64)), pa.array(size.astype(np.int64)), pa.array(klass.astype(np.int64) + number)],
                    names=["anchor", "key", "start", "size", "letter"])
                number += int(klass.max()) + 1 if len(klass) else 0

        cold = self._routed().mapInArrow(run, "anchor bigint, key string, start bigint, size bigint, letter bigint")
        hot = self._hot_repeats(numbered=True).select("anchor", "key", "start", F.lit(1).cast("long").alias("size"), "letter")
        # the letters' numbers are the tasks' own, so they are written before anything else reads them
        bodies = stage(cold.unionByName(hot), "repeat-letters")
        here = Window.partitionBy("node").orderBy("start")
        joined = F.lag(F.col("start") + F.col("size")).over(here) == F.col("start")
        follows = F.lead("start").over(here) == F.col("start") + F.col("size")
        near = stage(self._placed(bodies, "size", "letter").select(
            "node", "start", "size", "letter", F.when(joined, F.lag("letter").over(here)).alias("left"),
            F.when(follows, F.lead("letter").over(here)).alias("right")), "repeat-neighbours")
        sides = near.groupBy("letter").agg(_varied("left").alias("from_many"), _varied("right").alias("to_many"))
        # segments cut finer than need be: letters that always stand together are one
        opens = F.col("left").isNull() | F.col("from_many") | F.lag("to_many").over(here)
        whole = near.join(sides, "letter").select("node", "start", "size", "letter", "left", opens.alias("opens")).select(
            "node", "start", "size", "letter", F.sum(F.col("opens").cast("long")).over(here).alias("place"),
            F.sum(F.col("left").isNull().cast("long")).over(here).alias("run"))
        whole = whole.groupBy("node", "run", "place").agg(
            F.min("start").alias("start"), F.sum("size").alias("size"), F.min_by("letter", "start").alias("letter"))
        runs = whole.groupBy("node", "run").agg(F.array_sort(F.collect_list(F.struct("start", "size", "letter"))).alias("x"))
        return stage(runs.select("node", "run", F.col("x.start").alias("starts"), F.col("x.size").alias("sizes"),
                                 F.col("x.letter").alias("letters")), "repeat-runs")

    def groups(self) -> DataFrame:
        """Maximal repeats among different texts, with all places in these: group_id, length, node, start.

        A repeat is a string of L units or more that stands at two places at least and can't be extended by one
        unit to either side at all its places.  A node stands for all copies of its text;
        ``occurrences`` has every document's place.  A text of one short string over and over has as many
        maximal repeats as it has periods, so rows grow with the square of those.

        Each round looks at ``LOOK`` further letters of all suffixes with one prefix; a prefix with more
        suffixes than a task takes is lengthened by one letter, in Spark.
        """
        runs, look, tails = self._runs(), LOOK, self.tails

        def run(batches):
            from pyspark import TaskContext

            number = TaskContext.get().partitionId() << 33
            out: list = []
            for _, rows in _by_group(batches):
                left = [(i,) if r[6] is None else r[6] for i, r in enumerate(rows)]  # no neighbour: unlike all others
                for depth, members in tails([r[7] for r in rows], left):
                    number += 1
                    length = rows[members[0]][1] + sum(rows[members[0]][8][:depth])
                    out += [(number, length, *rows[m][2:4], rows[m][4] + depth, *rows[m][5:7], depth == look) for m in members]
                    if len(out) >= 1 << 14:
                        yield _pending(out)
                        out = []
            if out:
                yield _pending(out)

        todo = runs.select("node", "run", "starts", "sizes", "letters", F.posexplode("letters").alias("at", "group")).select(
            "group", (F.get("sizes", "at") + self.u.length - 1).alias("length"), "node", "run", (F.col("at") + 1).alias("at"),
            F.get("starts", "at").alias("start"), F.get("letters", F.col("at") - 1).alias("left"))
        found, turn = [], 0
        while True:
            sizes = stage(todo.groupBy("group").agg(F.count("*").alias("n"), _varied("left").alias("open")).where("n > 1 and open"), "repeat-prefixes")
            if sizes.isEmpty():
                break
            rows = todo.join(sizes.select("group", (F.col("n") > self.suffixes).alias("big")), "group").join(runs, ["node", "run"])
            small = rows.where("not big").select(*TODO, F.slice("letters", F.col("at") + 1, look).alias("tail"),
                                                 F.slice("sizes", F.col("at") + 1, look).alias("tail_sizes"))
            small = stage(small.repartition("group").sortWithinPartitions("group").mapInArrow(run, PENDING), f"repeat-found-{turn}")
            done = small.where("not more").select(F.concat(F.lit(f"{turn}-"), "group").alias("group_id"), "length", "node", "start")
            found.append(done)
            todo = small.where("more").select(*TODO)
            if not sizes.where(F.col("n") > self.suffixes).isEmpty():
                big = stage(rows.where("big").select(*TODO, F.get("letters", "at").alias("next"), F.get("sizes", "at").alias("size")), f"repeat-long-{turn}")
                ends = big.groupBy("group").agg(_varied("next").alias("ends")).where("ends")
                found.append(big.join(ends.select("group"), "group", "left_semi").select(
                    F.concat(F.lit(f"{turn}+"), "group").alias("group_id"), "length", "node", "start"))
                below = big.groupBy("group", "next").agg(F.count("*").alias("n")).where("n > 1 and next is not null")
                below = stage(below.select("group", "next", (-1 - F.monotonically_increasing_id()).alias("child")), f"repeat-below-{turn}")
                todo = todo.unionByName(big.join(below, ["group", "next"]).select(
                    F.col("child").alias("group"), (F.col("length") + F.col("size")).alias("length"), "node", "run",
                    (F.col("at") + 1).alias("at"), "start", "left"))
            turn += 1
        if not found:
            return self.nodes.sparkSession.createDataFrame([], "group_id string, length bigint, node bigint, start bigint")
        out = found[0]
        for part in found[1:]:
            out = out.unionByName(part)
        return out

    def occurrences(self) -> DataFrame:
        """Repeats with all their occurrences in documents: group_id, length, doc_id, __file, __row, start.

        ``groups()`` at the places of all copies of a text; and each text of L units or more
        that several documents have, and no other text holds, is a repeat of its full length.
        """
        found = stage(self.groups(), "repeat-groups")
        held = found.where("start = 0").select("node", F.col("length").alias("n_units"))
        whole = self.nodes.where((F.col("copies") > 1) & (F.col("n_units") >= self.u.length)).join(held, ["node", "n_units"], "left_anti").select(
            F.concat(F.lit("copies-"), "node").alias("group_id"), F.col("n_units").alias("length"), "node", F.lit(0).cast("long").alias("start"))
        places = self.rows.select("doc_id", *PLACE, "digest").join(self.nodes.select("node", "digest"), "digest")
        return stage(found.unionByName(whole).join(places, "node").select("group_id", "length", "doc_id", *PLACE, "start"), "repeat-occurrences")

    def covers(self) -> DataFrame:
        """node, start, stop: spans whose union by node is all that repeats cover."""
        u, finder = self.u, self.finder

        def run(batches):
            for rows in _grouped(batches):
                c = _chunk(u, rows)
                found, pos, seg = repeats_of(u, c, finder)
                if not found:
                    continue
                longest = np.zeros(len(pos), np.int64)
                for n, members in found:
                    longest[members] = np.maximum(longest[members], n)
                use = longest > 0
                # the union of each body's spans, by shifting the bodies apart
                at = pos[use] + seg[use]
                spans = merge(np.stack([at, at + longest[use]], 1))
                body = np.searchsorted(c.begin + np.arange(len(rows)), spans[:, 0], "right") - 1
                start = spans[:, 0] - c.begin[body] - body
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.group[body]), pa.array([rows[b][1] for b in body.tolist()], pa.string()), pa.array(start),
                     pa.array(spans[:, 1] - spans[:, 0])], names=["anchor", "key", "start", "length"])

        cold = self._routed().mapInArrow(run, "anchor bigint, key string, start bigint, length bigint")
        hot = self._hot_repeats().select("anchor", "key", "start", F.lit(u.length).cast("long").alias("length"))
        return self._placed(cold.unionByName(hot), "length").select("node", "start", (F.col("start") + F.col("length")).alias("stop"))

    def removed(self) -> DataFrame:
        """One row per document: doc_id, n_units, n_removed, n_spans, kept_sha256."""
        u = self.u

        def run(batches):
            for batch in batches:
                nodes, text = batch.column("node"), batch.column("text")
                n_removed, n_spans, shas = [], [], []
                for i in range(batch.num_rows):
                    raw = text[i].as_buffer().to_pybytes()
                    flat = batch.column("spans")[i].values.flatten()
                    spans = merge(np.stack([x.to_numpy() for x in flat], 1).astype(np.int64))
                    units = raw.split() if u.words else raw
                    kept, at = [], 0
                    for a, b in spans.tolist():
                        kept += units[at:a] if u.words else [units[at:a]]
                        at = b
                    kept += units[at:] if u.words else [units[at:]]
                    n_removed.append(int((spans[:, 1] - spans[:, 0]).sum()))
                    n_spans.append(len(spans))
                    shas.append(hashlib.sha256((b" " if u.words else b"").join(kept)).hexdigest())
                yield pa.RecordBatch.from_arrays([nodes, pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(shas)],
                                                 names=["node", "n_removed", "n_spans", "kept_sha256"])

        spans = self.covers().groupBy("node").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
        cut = self.texts.select("node", F.col("text").cast("binary").alias("text")).join(spans, "node").mapInArrow(
            run, "node bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
        cut = stage(cut, "repeat-cut")
        by_digest = self.nodes.select("node", "digest", "copies").join(cut, "node", "left").drop("node")
        gone = (F.col("copies") > 1) & (F.col("n_units") >= u.length)
        return self.rows.select("doc_id", "digest", "n_units", "whole_sha256").join(by_digest, "digest").select(
            "doc_id", "n_units", F.when(gone, F.col("n_units")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"))
