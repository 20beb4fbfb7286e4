"""Operator 12 against a brute-force version; ties, hot terms, blocks, shards and chunks."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlint.llm import lexical_search as ls
from ledgerlint.llm import queries
from ledgerlint.sources.tables import read_table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute_force(docs, items, k=50):
    tf = [(i, Counter(cut(t))) for i, t in docs]
    n_docs = sum(1 for _, c in tf if c)
    length = sum(c.total() for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        asked, found = set(cut(text)), []
        for i, c in tf:
            if c:
                m = 50 + 50 * c.total() * n_docs // length
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                            for t in asked if t in c)
                if score > 0:
                    found.append((-score, i is None, i if i is not None else 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k])]
    return Counter(out)


def run(spark, docs, items, k=50, parts=5):
    d = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id bigint, text string, source string, n int, query int").repartition(parts)
    q = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id bigint, text string, nth int")
    return Counter(map(tuple, ls.rank_documents(d, q, k).collect()))


def test_terms():
    assert [t.decode() for p in ls.terms("Été-ABC_d2 ½x\x7fÑ y ÀB".encode()) for t in p] == cut("Été-ABC_d2 ½x\x7fÑ y ÀB")
    assert list(ls.terms(b"")) == []


def test_query_equals_brute_force(spark, sf_small):
    docs = [tuple(r) for r in read_table(spark, sf_small, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in read_table(spark, sf_small, "benchmark").select("item_id", "text").collect()]
    out = queries.op12_search(spark, sf_small)
    assert [f"{c} {t}" for c, t in out.dtypes] == ["item_id bigint", "rank int", "doc_id bigint", "score bigint"]
    assert Counter(map(tuple, out.collect())) == brute_force(docs, items)


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(150)]
    weights = [1 / (i + 1) for i in range(150)]
    docs = [(i, " ".join(["the"] * rng.randrange(3) + rng.choices(words, weights, k=rng.randrange(0, 40)))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(30)]  # a group of copies, all of one score
    docs += [(docs[5][0], docs[5][1]), (None, docs[6][1]), (None, docs[6][1]), (900, None), (901, ""), (902, "?!")]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 15))) + " the The") for i in range(25)]
    return docs, items + [(3, items[3][1]), (None, items[4][1]), (50, None), (51, ""), (52, "nowhere"), (53, docs[3][1])]


@pytest.mark.parametrize("seed, sizes", [
    (1, {}), (2, {"SHARD": 300, "CHUNK": 150, "STEP": 16}), (3, {"BLOCK_BYTES": 300, "WINDOW": 8}), (4, {"SHORT": 2, "STEP": 8, "CHUNK": 400}),
    (5, {"SHORT": 10 ** 9, "STEP": 16}),
])
def test_small_tables(spark, monkeypatch, seed, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(ls, name, value)
    docs, items = corpus(seed)
    for k in (3, 50):
        assert run(spark, docs, items, k) == brute_force(docs, items, k)


def test_skipping_skips(monkeypatch):
    """Documents of the non-essential lists alone are not looked at, and the result is the same."""
    rng = np.random.default_rng(0)
    n = 3000
    often = np.arange(n)
    rare = np.sort(rng.choice(n, 200, replace=False))
    doc, term = np.concatenate([often, rare]), np.repeat([0, 1], [n, 200])
    index = ls.Inverted(doc, term, np.ones(len(doc), np.int64), np.full(n, 100), np.array([10, 5000]))
    asked = []
    real = np.searchsorted
    monkeypatch.setattr(ls.np, "searchsorted", lambda a, v, *r: (asked.append(np.size(v)), real(a, v, *r))[1])
    best = ls.Best(50)
    ls.search(index, np.array([0, 1]), np.zeros(n, bool), np.arange(n), best)
    assert best.ident.tolist() == rare[:50].tolist()
    assert max(asked) <= 200


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == Counter()
    assert run(spark, [(1, "a")], []) == Counter()
    assert run(spark, [(1, None)], [(1, "a")]) == Counter()


def test_long_text(spark):
    docs = [(1, "ab " * 1_000_000 + "tail"), (2, "tail ab"), (3, "other")]
    assert run(spark, docs, [(1, "tail"), (2, "AB")]) == brute_force(docs, [(1, "tail"), (2, "ab")])
