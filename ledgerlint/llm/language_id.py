"""Language ID (operator 10): multilingual mixture inference.

Training counts hashed byte trigrams by language over all training documents (one
bounded table of ``BUCKETS`` counts a language, summed within each task first).
A document is a mixture: its trigrams come from language l with proportion p_l.
Expectation-maximisation estimates the proportions from the trigram likelihoods;
the language set is the one with the best penalised likelihood, among the nested
sets of the languages by falling proportion; ``lang_pred`` is the set's largest.

The languages are taken in blocks of ``LANGS``, by falling number of training
documents, so that neither the driver nor a task holds more than one block's model,
however many values ``lang`` has.  A document's set is formed inside a block; the
block whose set has the best penalised likelihood decides.  Up to ``LANGS`` values
make one block.

Defined results: text that is null or has no letter is ``und`` with score 0; so is
everything if nothing can be learnt.  Rows with a null id are predicted but not
learnt from.  ASCII letters are lower-cased, other ASCII characters are one
separator, other bytes are kept, so whole texts in any script are used.  Repeated
rows are predicted alike; ties go to the language with more training documents,
then the smaller name.  Any number of ``lang`` values is learnt from.  Extra columns are ignored; a very long text is one mixture
like any other, worked on by itself; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle, stage
from .exact_dedup import keeping_names, located
from .textbytes import slices

BUCKETS = 1 << 16
#: Penalty on the log-likelihood for each language of the set, times log(trigrams).
PENALTY = 3.0
ROUNDS = 12
#: Languages of one block: at most LANGS * (BUCKETS + 1) counts in the driver, 4 * LANGS * BUCKETS bytes sent to a task.
LANGS = 200
#: Entries (trigrams of a document times languages) that a task works on at once; one text has at most BUCKETS * LANGS.
ENTRIES = 1 << 21

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = 32
_FOLD[97:123] = range(97, 123)
_FOLD[65:91] = range(97, 123)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted keys document * BUCKETS + bucket, one per trigram; documents are framed by a separator."""
    n = len(offsets) - 1
    framed = np.full(len(data) + 2 * n, 32, np.uint32)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    framed[np.arange(len(data)) + 2 * doc + 1] = _FOLD[data]
    a, b, c = framed[:-2], framed[1:-1], framed[2:]
    ends = offsets[1:] + 2 * np.arange(1, n + 1)  # in framed
    use = ~((b == 32) & ((a == 32) | (c == 32)))
    for e in (ends - 1, ends - 2):  # trigrams that reach into the next document
        use[e[e < len(use)]] = False
    bucket = ((a << 16 | b << 8 | c) * np.uint32(2654435761)) >> np.uint32(16)
    where = np.repeat(np.arange(n), np.diff(offsets) + 2)[:-2]
    return where[use] * BUCKETS + bucket[use]


@dataclass
class Model:
    langs: list
    log_p: np.ndarray  # float32 [BUCKETS, languages]
    last: bool = True  # no block follows


def models(docs: DataFrame) -> Iterator[Model]:
    """The blocks of languages, each learnt from all rows of (lang, text) with a lang and a text."""

    settle(docs.sparkSession)
    most = LANGS

    def count(batches):
        table = {}

        def flush():
            for lang, sums in table.items():
                at = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(sums[at])],
                                                 names=["lang", "bucket", "n"])
            table.clear()

        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for at, to, data, offsets in slices(batch.column("text"), 1 << 19):
                keys = _trigrams(data, offsets)
                doc, bucket = keys // BUCKETS, keys % BUCKETS
                names, which = np.unique(langs[at:to], return_inverse=True)
                order = np.argsort(which[doc], kind="stable")
                ends = np.searchsorted(which[doc][order], np.arange(len(names) + 1))
                for i, lang in enumerate(names):
                    if lang not in table and len(table) == most:
                        yield from flush()
                    sums = table.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                    sums[:-1] += np.bincount(bucket[order[ends[i]:ends[i + 1]]], minlength=BUCKETS)
                    sums[-1] += int((which == i).sum())  # the last entry counts documents
        yield from flush()

    rows = docs.where("lang is not null and text is not null").select("lang", "text").mapInArrow(
        count, "lang string, bucket int, n bigint")
    counted = stage(rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    left = counted.where(F.col("bucket") == BUCKETS).select("lang", "n")
    while True:
        block = left.orderBy(F.desc("n"), "lang").limit(most + 1).collect()
        if not block:
            return
        last, block = len(block) <= most, block[:most]
        langs = [r.lang for r in block]
        found = counted.where(F.col("bucket") < BUCKETS).join(F.broadcast(
            docs.sparkSession.createDataFrame([(x, i) for i, x in enumerate(langs)], "lang string, at int")), "lang").select(
            "at", "bucket", "n").toArrow()  # BUCKETS rows a language at most
        counts = np.full((BUCKETS, len(langs)), 0.1)
        counts[found.column("bucket").to_numpy(), found.column("at").to_numpy()] += found.column("n").to_numpy()
        del found
        counts /= counts.sum(0)
        yield Model(langs, np.log(counts, out=counts).astype(np.float32), last)
        if last:
            return
        n, lang = F.lit(block[-1].n), F.lit(block[-1].lang)
        left = left.where((F.col("n") < n) | (F.col("n") == n) & (F.col("lang") > lang))


def learn(docs: DataFrame) -> Model:
    """The first block: the ``LANGS`` languages with most training documents (no language, if there is nothing to learn from)."""
    return next(models(docs), Model([], np.zeros((BUCKETS, 0), np.float32)))


def _mixture(p: np.ndarray, count: np.ndarray, at: np.ndarray, allowed: np.ndarray, rounds: int):
    """EM over documents: p [entries, languages], at: each document's first entry, allowed [documents, languages].

    Returns proportions and log-likelihoods (of p, which may be scaled by entry); sums over long texts are in doubles.
    """
    size = np.diff(np.append(at, len(count)))
    total = np.add.reduceat(count, at)
    theta = allowed / allowed.sum(1, keepdims=True)
    for _ in range(rounds):
        mixed = np.repeat(theta, size, 0) * p
        mixed *= (count / mixed.sum(1))[:, None]
        theta = (np.add.reduceat(mixed, at, 0, float) / total[:, None]).astype(np.float32)
    fit = np.add.reduceat(count * np.log((np.repeat(theta, size, 0) * p).sum(1)), at, dtype=float)
    return theta, fit


def infer(model: Model, data: np.ndarray, offsets: np.ndarray):
    """Index of the predicted language, score, and proportions in the chosen set, by document."""
    return weigh(model, data, offsets)[:3]


#: Log-likelihood of a trigram that is drawn evenly from all buckets.
NOISE = -np.log(BUCKETS)


def weigh(model: Model, data: np.ndarray, offsets: np.ndarray):
    """As ``infer``, the penalised log-likelihood of the chosen set, and by how much that set explains the text better than noise.

    Both are 0 without trigrams; the second is not penalised.
    """
    n, langs = len(offsets) - 1, len(model.langs)
    best, score, shares, worth, gain = np.zeros(n, int), np.zeros(n), np.zeros((n, langs), np.float32), np.zeros(n), np.zeros(n)
    keys, count = np.unique(_trigrams(data, offsets), return_counts=True)
    doc = keys // BUCKETS
    has, at = np.unique(doc, return_index=True)
    if not len(has):
        return best, score, shares, worth, gain
    count = count.astype(np.float32)
    log_p = model.log_p[keys % BUCKETS]
    top = log_p.max(1, keepdims=True)
    p = np.exp(log_p - top)  # scaled by entry, which moves every fit of a document alike
    theta, fit = _mixture(p, count, at, np.ones((len(has), langs), np.float32), ROUNDS)
    price = PENALTY * np.log(np.maximum(np.add.reduceat(count, at), 2))
    order = np.argsort(-theta, 1, kind="stable")
    alone = np.add.reduceat(count[:, None] * (log_p - top), at, 0, float)
    chosen = np.zeros_like(theta)
    lead = order[:, 0]
    chosen[np.arange(len(has)), lead] = 1
    value = alone[np.arange(len(has)), lead] - price
    size = np.diff(np.append(at, len(count)))
    open_ = np.arange(len(has))
    for k in range(2, langs + 1):
        # a larger set can't beat the chosen one if even the full mixture's fit doesn't pay for k languages
        open_ = open_[fit[open_] - k * price[open_] > value[open_]]
        if not len(open_):
            break
        pick = np.repeat(np.isin(np.arange(len(has)), open_), size)
        at2 = np.append(0, np.cumsum(size[open_])[:-1])
        allowed = np.zeros((len(open_), langs), np.float32)
        np.put_along_axis(allowed, order[open_, :k], 1, 1)
        t, f = _mixture(p[pick], count[pick], at2, allowed, ROUNDS)
        better = f - k * price[open_] > value[open_]
        value[open_[better]] = (f - k * price[open_])[better]
        chosen[open_[better]] = t[better]
    best[has] = chosen.argmax(1)
    score[has] = np.clip(theta[np.arange(len(has)), best[has]], 0, 1)
    shares[has] = chosen
    worth[has] = value + np.add.reduceat(count * top[:, 0].astype(float), at)
    gain[has] = worth[has] + (chosen > 0).sum(1) * price - NOISE * np.add.reduceat(count, at)
    return best, score, shares, worth, gain


def _lettered() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model | Iterable[Model], keep: tuple = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, lang_pred, score, langs (the chosen set with proportions, as text), gain.

    ``gain`` is the log-likelihood of the text in the chosen set above that in evenly drawn trigrams (null for ``und``).

    Of several blocks, each reads what the one before has written, whole texts with the best set so far.
    """
    spark = settle(docs.sparkSession)
    kinds = dict(docs.dtypes)

    def judge(rows: DataFrame, m: Model) -> DataFrame:
        carried = [*keep] if m.last else [*keep, "text", "letters"]
        given = "".join(f"`{c}` {kinds.get(c, 'boolean')}, " for c in carried)
        shared = spark.sparkContext.broadcast((m.langs, m.log_p))  # one block

        def run(batches):
            m = Model(*shared.value)
            size = min(1 << 19, max(1, ENTRIES // len(m.langs)))
            for batch in batches:
                columns = {c: batch.column(c).to_pylist() for c in ("letters", "lang_pred", "score", "langs", "worth", "gain")}
                for at, to, data, offsets in slices(batch.column("text"), size):
                    best, score, shares, worth, gain = weigh(m, data, offsets)
                    for i in range(to - at):
                        before = columns["worth"][at + i]
                        if columns["letters"][at + i] and (before is None or worth[i] > before):
                            columns["lang_pred"][at + i] = m.langs[best[i]]
                            columns["score"][at + i] = float(score[i])
                            columns["langs"][at + i] = ",".join(
                                f"{m.langs[j]}:{shares[i, j]:.2f}" for j in np.argsort(-shares[i], kind="stable") if shares[i, j] > 0)
                            columns["worth"][at + i] = float(worth[i])
                            columns["gain"][at + i] = float(gain[i])
                yield pa.RecordBatch.from_arrays(
                    [*map(batch.column, carried), pa.array(columns["lang_pred"], pa.string()), pa.array(columns["score"], pa.float64()),
                     pa.array(columns["langs"], pa.string()), pa.array(columns["worth"], pa.float64()), pa.array(columns["gain"], pa.float64())],
                    names=[*carried, "lang_pred", "score", "langs", "worth", "gain"])

        return rows.mapInArrow(run, given + "lang_pred string, score double, langs string, worth double, gain double")

    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"), _lettered().alias("letters"),
                       F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit("").alias("langs"),
                       F.lit(None).cast("double").alias("worth"), F.lit(None).cast("double").alias("gain"))
    first = True
    for m in [model] if isinstance(model, Model) else model:
        if m.langs:
            rows = judge(rows if first else stage(rows, "language-block"), m)
            first = False
    return rows.select(*keep, "lang_pred", "score", "langs", "gain")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, langs: learnt from the rows that aren't held out."""
    known = models(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    return predict(docs, known).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "langs")


@keeping_names
def drop_unidentified(docs: DataFrame, noise: bool = True) -> DataFrame:
    """The documents in which a language was found, with their own columns.

    Each row is judged by itself, whatever its id: texts that are null or have no letter go.  Without ``noise``, so do
    texts that the best set of languages explains no better than evenly drawn trigrams: noise, or a language never learnt.
    Texts with a letter all stay if no language could be learnt.
    """
    blocks = models(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    first = next(blocks, None)
    if first is None:
        return docs.where(_lettered())
    rows, place = located(docs), ("__file", "__row")
    gone = predict(rows, chain([first], blocks), place).where(
        "lang_pred = 'und'" if noise else "lang_pred = 'und' or gain <= 0").select(*place)
    return rows.join(gone, [*place], "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
