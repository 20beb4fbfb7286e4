"""Ranked lexical search (operator 12): hybrid TAAT-DAAT over shards of an inverted index.

The items (queries) come in blocks of bounded size.  For a block, every document's whole
text is cut into terms once, and its postings of the block's terms are written: they are the
index.  Document frequencies and lengths are added up over all documents.  Then each task
turns its part of the index into inverted lists, chunk by chunk, and answers every item:

* term at a time: the item's short lists are summed into one accumulator list, which from
  then on is an iterator like any long list, with its largest sum as its bound;
* document at a time, by blocks of documents: the iterators with the smallest bounds, as long
  as these together stay below the score of the k-th document so far, can't make a result
  alone.  Candidates come from the other iterators only, and are looked up in the former (by
  search, skipping all between) as long as their score and the bounds that are left reach it.

The tasks' best k of each item are merged in two rounds, so that no task reads a list of all.

Defined results: null and empty texts have no terms and are never results; an item without
terms, or whose terms occur nowhere, has no rows.  A repeated item is answered each time, a
repeated document row is a result of its own.  Equal scores go by identifier (integers, nulls
last).  Very long texts are cut into terms window by window.  Empty tables give no rows; extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, stage

#: Bytes of items answered at once (an item that is longer by itself makes a block alone).
BLOCK_BYTES = 8 << 20
#: Postings that one task's shard is made of, about, and that are inverted at once.
SHARD = 1 << 20
CHUNK = 2 << 20
#: Lists with postings in less than one of so many documents are summed term at a time.
SHORT = 16
#: Documents gone through at once.
STEP = 4096
#: Bytes of text cut into terms at once.
WINDOW = 1 << 20

# ASCII letters and digits and all bytes beyond ASCII belong to terms; A-Z are lower-cased
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(raw: bytes):
    """Lists of the terms of a text in UTF-8, window by window."""
    clean, at = raw.translate(_TERM_BYTES), 0
    while at < len(clean):
        to = clean.find(b" ", at + WINDOW) if len(clean) - at > WINDOW else -1
        to = len(clean) if to < 0 else to
        yield clean[at:to].split()
        at = to


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# ---------------------------------------------------------------- one shard

class Inverted:
    """Inverted lists of a chunk: by term, the documents' places in the chunk and what the term adds to their scores."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray, weights: np.ndarray):
        order = np.argsort(term, kind="stable")  # documents stay in order within a list
        term, self.doc, tf = term[order], doc[order], tf[order]
        self.adds = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[self.doc]))
        self.start = np.searchsorted(term, np.arange(len(weights) + 1))
        self.n_docs = len(m)

    def list(self, t: int):
        a, b = self.start[t], self.start[t + 1]
        return self.doc[a:b], self.adds[a:b]


def iterators(index: Inverted, query: np.ndarray):
    """(documents, adds) of the accumulator of all short lists, and of each long list."""
    lists = [index.list(t) for t in query if index.start[t] < index.start[t + 1]]
    short = [x for x in lists if len(x[0]) * SHORT < index.n_docs]
    out = [x for x in lists if len(x[0]) * SHORT >= index.n_docs]
    if short:
        docs, place = np.unique(np.concatenate([d for d, _ in short]), return_inverse=True)
        sums = np.zeros(len(docs), np.int64)
        np.add.at(sums, place, np.concatenate([a for _, a in short]))
        out.append((docs, sums))
    return out


class Best:
    """The best k documents of an item so far, by falling score and rising (null, identifier)."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.null, self.ident = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """What a document must reach, if only by a tie."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score, null, ident) -> None:
        s, n, i = np.append(self.score, score), np.append(self.null, null), np.append(self.ident, ident)
        order = np.lexsort((i, n, -s))[: self.k]
        self.score, self.null, self.ident = s[order], n[order], i[order]


def search(index: Inverted, query: np.ndarray, null: np.ndarray, ident: np.ndarray, best: Best) -> None:
    """Document at a time over the item's iterators, with skipping; ``best`` is brought up to date."""
    runs = iterators(index, query)
    if not runs:
        return
    bounds = np.array([a.max() for _, a in runs])
    order = np.argsort(bounds, kind="stable")
    runs, reach = [runs[i] for i in order], np.cumsum(bounds[order])  # reach[i]: the most that runs 0..i give together
    # k documents whose accumulator or single list reaches a score: no later result is below it
    known = max((int(np.partition(a, -best.k)[-best.k]) for d, a in runs if len(a) >= best.k), default=0)
    for base in range(0, index.n_docs, STEP):
        least = max(best.least, known)
        first = int(np.searchsorted(reach, least))  # runs before this one can't reach it together
        if first == len(runs):
            return
        score = np.zeros(min(STEP, index.n_docs - base), np.int64)
        for docs, adds in runs[first:]:
            a, b = np.searchsorted(docs, (base, base + STEP))
            score[docs[a:b] - base] += adds[a:b]
        found = np.flatnonzero(score)
        score = score[found]
        for i in range(first - 1, -1, -1):
            keep = score + reach[i] >= least
            found, score = found[keep], score[keep]
            if not len(found):
                break
            docs, adds = runs[i]
            at = np.searchsorted(docs, found + base)
            hit = at < len(docs)
            hit[hit] = docs[at[hit]] == found[hit] + base
            score[hit] += adds[at[hit]]
        keep = score >= least
        if keep.any():
            best.add(score[keep], null[found[keep] + base], ident[found[keep] + base])


# ---------------------------------------------------------------- the Spark jobs

def _postings(docs: DataFrame, vocabulary: dict) -> DataFrame:
    """doc_id, n (terms with repeats), and the block's terms in the document with their numbers of occurrences."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most one block of items

    def run(batches):
        get = shared.value.get
        for batch in batches:
            n, ends, which, tf, size = [], [0], [], [], 0
            for x in batch.column("text"):
                total, met = 0, []
                for part in terms(x.as_buffer().to_pybytes()):
                    total += len(part)
                    met.append(np.array([i for i in map(get, part) if i is not None], np.int32))
                found, times = np.unique(np.concatenate(met), return_counts=True) if met else ((), ())
                n.append(total)
                which.append(np.array(found, np.int32))
                tf.append(np.array(times, np.int64))
                size += len(found)
                ends.append(size)
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(which) if which else [], pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(tf) if tf else [], pa.int64()))],
                names=["doc_id", "n", "terms", "tf"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, tf array<bigint>")


def _totals(index: DataFrame, n_terms: int):
    """(documents with a term, all terms, document frequency by term) over the whole index."""

    def add_up(batches):
        df, docs, length = np.zeros(n_terms, np.int64), 0, 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            docs, length = docs + int((n > 0).sum()), length + int(n.sum())
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append([-1, -2], at).astype(np.int32)), pa.array(np.append([docs, length], df[at]))],
                                         names=["term", "n"])

    rows = index.select("n", "terms").mapInArrow(add_up, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = dict(map(tuple, rows))  # two rows more than the block has terms, at most
    df = np.zeros(n_terms, np.int64)
    for t, n in found.items():
        if t >= 0:
            df[t] = n
    return found.get(-1, 0), found.get(-2, 0), df


def _search_shards(index: DataFrame, queries: list, weights: np.ndarray, n_docs: int, length: int, k: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast((queries, weights))  # one block of items

    def run(batches):
        queries, weights = shared.value
        best = [Best(k) for _ in queries]
        held, size = [], 0

        def answer():
            n = np.concatenate([b.column("n").to_numpy() for b in held])
            at = np.concatenate([np.diff(b.column("terms").offsets.to_numpy()) for b in held])
            term = np.concatenate([b.column("terms").flatten().to_numpy() for b in held])
            tf = np.concatenate([b.column("tf").flatten().to_numpy() for b in held])
            null = np.concatenate([b.column("doc_id").is_null().to_numpy(zero_copy_only=False) for b in held])
            ident = np.concatenate([b.column("doc_id").fill_null(0).to_numpy() for b in held])
            m = 50 + 50 * n * n_docs // length
            found = Inverted(np.repeat(np.arange(len(n)), at), term, tf, m, weights)
            for query, top in zip(queries, best):
                search(found, query, null, ident, top)

        for batch in batches:
            held.append(batch)
            size += len(batch.column("terms").flatten()) + batch.num_rows
            if size >= CHUNK:
                answer()
                held, size = [], 0
        if size:
            answer()
        shard = TaskContext.get().partitionId()
        for i, top in enumerate(best):
            if len(top.score):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(top.score), i, np.int32)), pa.array(np.full(len(top.score), shard, np.int32)),
                    pa.array(top.ident, mask=top.null), pa.array(top.score)], names=["query", "shard", "doc_id", "score"])

    return index.mapInArrow(run, "query int, shard int, doc_id bigint, score bigint")


def _top(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents with a score above 0 of every row of ``items``."""
    spark = settle(docs.sparkSession)
    schema = f"item_id {dict(items.dtypes)['item_id']}, rank int, doc_id bigint, score bigint"
    listed = stage(items.select("item_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("nth")),
                   "search-items")
    size = listed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, out = max(1, math.ceil(size / BLOCK_BYTES)), []
    for block in range(blocks):
        rows = listed.where(F.pmod(F.xxhash64("nth"), F.lit(blocks)) == block).collect()  # BLOCK_BYTES, about
        number, vocabulary = count(), {}
        queries = [np.array(sorted({vocabulary[t] if t in vocabulary else vocabulary.setdefault(t, next(number))
                                    for part in terms(r.text.encode()) for t in part}), np.int64) for r in rows]
        if not vocabulary:
            continue
        index = stage(_postings(docs, vocabulary), "search-index")
        n_docs, length, df = _totals(index, len(vocabulary))
        if not df.any():
            continue
        weights = np.array([weight(n_docs, d) for d in df.tolist()], np.int64)
        shards = math.ceil((int(df.sum()) + n_docs // 8) / SHARD)
        found = _search_shards(index.coalesce(shards), queries, weights, n_docs, length, k)
        if shards > 1:  # first within groups of shards, then of all
            groups = math.ceil(math.sqrt(shards))
            found = _top(found.withColumn("shard", F.col("shard") % groups), k, "query", "shard").drop("rank", "shard")
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"query int, item_id {dict(items.dtypes)['item_id']}")
        out.append(_top(found, k, "query").join(names, "query").select("item_id", "rank", "doc_id", "score"))
    if not out:
        return spark.createDataFrame([], schema)
    merged = out[0]
    for other in out[1:]:
        merged = merged.unionByName(other)
    return merged
