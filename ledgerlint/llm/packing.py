"""Packing (operator 3): lexical retrieval packing with a sharded BM25 index.

1. Every text becomes token ids (whole texts, one closing id each), written once.
2. Document frequencies of the token ids are counted over all documents (one
   bounded vector, summed within each task first).
3. Documents are range-partitioned by a lexical sketch (the smallest hash of their
   token pairs), then by doc_id, into shards of about ``SHARD_TOKENS`` tokens, so
   that like documents meet and a run of equal ones is cut by doc_id.
4. Each shard is a BM25 inverted index over its documents.  A window starts with a
   seed document; the index returns its unused neighbours by score, which fill the
   window greedily; then further documents in order.  The document that is cut at
   the window's end starts the next window.  The last window of a shard is cut into
   powers of two, so that no sequence has padding.

A seed's query is all of its terms.  Those that more than ``DENSE_SHARE`` of all
documents hold are kept as full rows of weights, if these are few (their lists would
be as long), the others as inverted lists; the scores are the same.

Defined results: null and empty texts are one closing id; ties in score go to the
document earlier in the shard; a very long text is cut into as many windows as it fills; repeated rows are packed each; ids may be null;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .textbytes import mix
from .wordbpe import encode_column, forget

WINDOW = 4096
CLOSING = 2
SHARD_TOKENS = 1 << 20
DENSE_SHARE = 0.25
#: Weights of a shard's full rows at most; with more, all terms are inverted lists.
MAX_DENSE = 8 << 20
K1, B = 1.2, 0.75
VOCABULARY = 1 << 16


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary, little-endian uint16), n_ids, sketch."""

    def run(batches):
        for batch in batches:
            ids, lengths, sketches = [], [], []
            for found, n in encode_column(batch.column("text"), path):
                size = n + 1
                ends = np.cumsum(size)
                closed = np.full(ends[-1], CLOSING, np.uint16)
                closed[np.arange(len(found)) + np.repeat(np.arange(len(n)), n)] = found
                pairs = closed.astype(np.uint64)
                pairs[:-1] = pairs[:-1] << np.uint64(16) | pairs[1:]
                sketches.append(np.minimum.reduceat(mix(pairs), ends - size) >> np.uint64(1))
                ids.append(closed)
                lengths.append(size)
            if not lengths:
                continue
            size = np.concatenate(lengths)
            offsets = np.append(0, np.cumsum(size) * 2).astype(np.int32)
            column = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.concatenate(ids).tobytes())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), column, pa.array(size), pa.array(np.concatenate(sketches).astype(np.int64))],
                names=["doc_id", "ids", "n_ids", "sketch"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids binary, n_ids bigint, sketch bigint")


def _id_lists(column) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and each row's first position (one more at the end)."""
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]: offsets[-1]]
    return raw.view(np.uint16) if raw.ctypes.data % 2 == 0 else np.frombuffer(raw.tobytes(), np.uint16), (offsets - offsets[0]) // 2


def _terms(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, term) with counts, sorted."""
    key, n = np.unique(np.repeat(np.arange(len(at) - 1), np.diff(at)) * VOCABULARY + ids, return_counts=True)
    return key // VOCABULARY, key % VOCABULARY, n


def document_frequencies(tokens: DataFrame) -> np.ndarray:
    """Documents that hold each id, over all documents; VOCABULARY numbers."""

    def run(batches):
        total = np.zeros(VOCABULARY, np.int64)
        for batch in batches:
            ids, at = _id_lists(batch.column("ids"))
            step = 2048
            for i in range(0, len(at) - 1, step):
                part = at[i: i + step + 1]
                total += np.bincount(_terms(ids[part[0]: part[-1]], part - part[0])[1], minlength=VOCABULARY)
        terms = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(total[terms])], names=["term", "n"])

    found = tokens.select("ids").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(VOCABULARY, np.int64)
    out[found.term.to_numpy(np.int64)] = found.n.to_numpy(np.int64)
    return out


class Shard:
    """A BM25 inverted index over the documents of one shard."""

    def __init__(self, ids: np.ndarray, at: np.ndarray, df: np.ndarray, n_docs: int, mean: float):
        self.n = len(at) - 1
        doc, term, count = _terms(ids, at)
        idf = np.log1p((n_docs - df + 0.5) / (df + 0.5))
        long = K1 * (1 - B + B * np.diff(at) / mean)
        weight = (idf[term] * count * (K1 + 1) / (count + long[doc])).astype(np.float32)
        common = np.flatnonzero(df > DENSE_SHARE * n_docs)
        common = common[np.isin(common, term)]
        if len(common) * self.n > MAX_DENSE:
            common = common[:0]
        self.row = np.full(VOCABULARY, -1)
        self.row[common] = np.arange(len(common))
        often = self.row[term] >= 0
        self.dense = np.zeros((len(common), self.n), np.float32)
        self.dense[self.row[term[often]], doc[often]] = weight[often]
        # every document's rows; then the lists of the other terms
        self.rows, self.rows_at = self.row[term[often]], np.searchsorted(doc[often], np.arange(self.n + 1))
        doc, term, weight = doc[~often], term[~often], weight[~often]
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        first = np.searchsorted(term[order], np.arange(VOCABULARY + 1))
        self.begin, self.size = first[:-1], np.diff(first)
        self.term = term
        self.term_at = np.searchsorted(doc, np.arange(self.n + 1))

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents by falling score; those without a common term come last, in order."""
        score = self.scores(seed)
        return unused[np.argsort(-score[unused], kind="stable")]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of the shard for the seed's distinct terms."""
        terms = self.term[self.term_at[seed]: self.term_at[seed + 1]]
        size = self.size[terms]
        ends = np.cumsum(size)
        where = np.repeat(self.begin[terms] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        rows = self.rows[self.rows_at[seed]: self.rows_at[seed + 1]]
        return np.bincount(self.doc[where], self.weight[where], self.n) + self.dense[rows].sum(0, dtype=float)


def fill(sizes: np.ndarray, shard: Shard):
    """(document, start, length, sequence, offset) of every piece of a shard, windows filled by retrieval."""
    unused = np.ones(len(sizes), bool)
    pieces, sequence, used = [], 0, 0
    queue: list = []
    at = 0
    while True:
        while queue and not unused[queue[-1]]:
            queue.pop()
        if queue:
            doc = queue.pop()
        else:
            while at < len(sizes) and not unused[at]:
                at += 1
            if at == len(sizes):
                break
            doc = at
        unused[doc] = False
        start, size = 0, int(sizes[doc])
        crossed = used == 0
        while start < size:
            n = min(size - start, WINDOW - used)
            pieces.append((doc, start, n, sequence, used))
            start, used = start + n, used + n
            if used == WINDOW:
                sequence, used, crossed = sequence + 1, 0, True
        if crossed and used:  # this document opens the current window: ask for its neighbours
            left = np.flatnonzero(unused)
            ranked = shard.neighbours(doc, left)
            need = np.searchsorted(np.cumsum(sizes[ranked]), WINDOW - used) + 1
            queue = ranked[:need][::-1].tolist()
        elif not used:
            queue = []
    if not used:
        return pieces
    # the last, partly filled window: powers of two
    whole = [p for p in pieces if p[3] < sequence]
    rest, room, offset = [p for p in pieces if p[3] == sequence], 1 << (used.bit_length() - 1), 0
    for doc, start, n, _, _ in rest:
        while n:
            take = min(n, room - offset)
            whole.append((doc, start, take, sequence, offset))
            start, n, used, offset = start + take, n - take, used - take, offset + take
            if offset == room:
                sequence, offset, room = sequence + 1, 0, 1 << max(used.bit_length() - 1, 0)
    return whole


def pack(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian uint32)."""
    spark = docs.sparkSession
    tokens = stage(tokenize(docs, path), "pack-tokens")
    n_docs, total = tokens.agg(F.count("*"), F.coalesce(F.sum("n_ids"), F.lit(0))).first()
    shared = spark.sparkContext.broadcast((document_frequencies(tokens), n_docs, total / max(n_docs, 1)))
    shards = max(1, -(-total // SHARD_TOKENS))

    def run(batches):
        from pyspark import TaskContext

        forget()  # the worker may come from the tokenizing stage
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows).combine_chunks()
        ids, at = _id_lists(table.column("ids").combine_chunks())
        sizes = np.diff(at)
        pieces = np.array(fill(sizes, Shard(ids, at, *shared.value)), np.int64)
        base = TaskContext.get().partitionId() << 32
        for i in range(0, len(pieces), 2000):
            doc, start, length, sequence, offset = pieces[i: i + 2000].T
            parts = [ids[a: a + n].astype("<u4").tobytes() for a, n in zip((at[doc] + start).tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [table.column("doc_id").combine_chunks().take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(sizes[doc]),
                 pa.array(sequence + base), pa.array(offset), pa.array(parts, pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    sharded = tokens.repartitionByRange(shards, "sketch", "doc_id").sortWithinPartitions("sketch", "doc_id")
    return sharded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")
