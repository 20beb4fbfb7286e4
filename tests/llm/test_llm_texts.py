"""Operators on documents: brute-force comparison and the defined edge cases, on one small table."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlint.llm import (decontam, exact_dedup, language_id, near_dedup, packing, pii, queries, substring_dedup,
                            suffix_dedup)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use for columns of their own.
CLASHES = ["digest", "node", "anchor", "group_size", "keep", "bands", "class", "h", "ids", "spans", "letters", "u", "item_id"]


def _words(rng, n, stems="alpha beta gamma delta omega sigma kappa lambda theta zeta".split()):
    return " ".join(rng.choice(stems) + str(rng.randrange(400)) for _ in range(n))


def make_docs():
    rng = random.Random(5)
    passage, license_ = _words(rng, 60), _words(rng, 45)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one two three"), (4, "one  two\nthree"), (5, "12 34 !?"), (6, "Ünï cödé ✓ 漢字 🙂")]
    base = _words(rng, 150)
    for i in range(10, 16):  # copies, some with other white space
        rows.append((i, base.replace(" ", "\n" if i % 2 else " ")))
    for i in range(20, 26):  # near copies
        w = base.split()
        for _ in range(3):
            w[rng.randrange(len(w))] = f"edit{i}{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    for i in range(30, 36):
        rows.append((i, f"{_words(rng, 40)} {passage} {_words(rng, 40)}"))
    rows.append((40, (license_ + "\n") * 3))
    rows.append((41, "same " * 300))
    rows.append((42, _words(rng, 9000)))  # very long
    rows += [(50 + i, _words(rng, 20 * i)) for i in range(8)]
    rows.append((57, rows[-1][1]))  # a repeated row
    return [(i, t, "en" if i % 2 else "de", f"s{i % 3}", len(t or "")) for i, t in rows]


DOCS = make_docs()


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    df = spark.createDataFrame(DOCS, SCHEMA).withColumns({c: F.lit(c) for c in CLASHES})
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def _normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def check_groups(got):
    groups = defaultdict(list)
    for i, t, *_ in DOCS:
        groups[_normal(t)].append((-len(t or ""), i))
    want = Counter((i, min(groups[_normal(t)])[1], len(groups[_normal(t)]), hashlib.sha256(_normal(t).encode()).hexdigest()) for i, t, *_ in DOCS)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_exact_groups(docs):
    check_groups(exact_dedup.exact_groups(docs).collect())


def test_exact_weak_digest_is_checked_on_full_bytes(docs):
    weak = lambda norm: F.substring(F.sha2(norm, 256), 1, 1)
    check_groups(exact_dedup.exact_groups(docs, digest=weak).collect())


def test_exact_stream_goes_on_from_its_state(spark, docs):
    stream = exact_dedup.StreamDedup(spark)
    located = exact_dedup.located(docs.select("doc_id", "text"))
    stream.ingest(located.where("doc_id < 30"))
    again = exact_dedup.StreamDedup(spark, root=stream.root)  # as after a restart
    again.ingest(located.where("doc_id >= 30"))
    sizes = {r.digest: r.group_size for r in again.groups().collect()}
    assert sizes == dict(Counter(hashlib.sha256(_normal(t).encode()).hexdigest() for _, t, *_ in DOCS))


def test_drop_exact_keeps_columns(docs, empty):
    out = exact_dedup.drop_exact_duplicates(docs)
    assert out.columns == docs.columns
    assert out.count() == len({_normal(t) for _, t, *_ in DOCS})
    assert out.where("digest <> 'digest'").isEmpty()
    assert exact_dedup.drop_exact_duplicates(empty).isEmpty()


def _bag(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if len(w) < 5:
        return Counter([tuple(w)] if w else [])
    return Counter(tuple(w[i: i + 5]) for i in range(len(w) - 4))


def brute_classes(rows):
    bags, parent = [_bag(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if bags[a] and bags[b] and sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values()):
                parent[find(a)] = find(b)
    best = {}
    for n, (i, _) in enumerate(rows):
        best[find(n)] = min(best.get(find(n), i), i)
    return Counter((i, best[find(n)] if bags[n] else i) for n, (i, _) in enumerate(rows))


def test_near_classes(docs, empty):
    got = near_dedup.near_classes(docs).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == brute_classes([r[:2] for r in DOCS])
    assert len([r for r in got if r.kept]) == len({r.class_id for r in got})
    assert near_dedup.near_classes(empty).isEmpty()


def test_near_chain_across_leaders(spark):
    """A chain of overlapping texts: neighbours are linked, the ends are not; the middle must still join them."""
    rng = random.Random(9)
    w = _words(rng, 400).split()
    rows = [(i, " ".join(w[10 * i: 10 * i + 200])) for i in range(20)]
    got = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == brute_classes(rows)


def test_near_pairs_inside_a_template_family(spark):
    """All texts are alike at about 0.75, and each has one partner at 0.82 that no leader need ever bring to it."""
    rng = random.Random(12)
    head, tail = _words(rng, 130), _words(rng, 131)
    rows = []
    for i in range(400):
        if i % 2 == 0:
            ours = " ".join(f"pair{i}x{k}" for k in range(14))
        own = " ".join(f"own{i}x{k}" for k in range(25))
        rows.append((i, f"{head} {ours} {own} {tail}"))
    got = Counter((r.doc_id, r.class_id) for r in near_dedup.near_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == Counter((i, i - i % 2) for i in range(400)) == brute_classes(rows)


def test_near_frequencies_reach_the_driver_as_columns(spark):
    """All tokens are counted; 400,000 of them don't become as many Python objects in the driver."""
    numbers = np.random.default_rng(3).integers(0, 1 << 40, (200, 2000))
    texts = [" ".join(map(str, r)) for r in numbers] + ["same " * 300, "one two", ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4).cache()
    assert df.count() == len(texts)
    want = np.zeros(near_dedup.COUNTERS, np.int64)
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        _, token = near_dedup._tokens(data, np.array([0, len(data)]))
        np.add.at(want, (token % np.uint64(near_dedup.COUNTERS)).astype(np.int64), 1)
    tracemalloc.start()
    got = near_dedup._frequencies(df)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    df.unpersist()
    assert (got == want).all() and np.count_nonzero(got) > 300_000
    assert not near_dedup._frequencies(df.limit(0)).any()
    assert peak < 50e6


def test_drop_near_keeps_one_of_each_class(docs):
    out = near_dedup.drop_near_duplicates(docs)
    classes = brute_classes([r[:2] for r in DOCS])
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for _, c in classes}) and out.columns == docs.columns


def test_dart_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    element = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    a, b = rng.uniform(0.2, 3, 300), rng.uniform(0.2, 3, 300)
    doc, weight = np.repeat([0, 1], 300), np.concatenate([a, b])
    k = 4096
    best = near_dedup.dart_signatures(2, doc, np.concatenate([element, element]), weight, k)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((best[0] == best[1]).mean() - want) < 4 * (want * (1 - want) / k) ** 0.5


def brute_removed(length, units, join):
    seen = Counter()
    for i, x in units:
        for p in range(len(x) - length + 1):
            seen[join.join(x[p: p + length])] += 1
    out = Counter()
    for i, x in units:
        cover = bytearray(len(x))
        for p in range(len(x) - length + 1):
            if seen[join.join(x[p: p + length])] > 1:
                cover[p: p + length] = b"\1" * length
        spans = sum(1 for p, c in enumerate(cover) if c and (not p or not cover[p - 1]))
        kept = join.join(u for u, c in zip(x, cover) if not c)
        out[i, len(x), sum(cover), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("hot", [2, 8192])
@pytest.mark.parametrize("module", [substring_dedup, suffix_dedup])
def test_repeats(docs, empty, module, hot):
    texts = [(i, (t or "").encode()) for i, t, *_ in DOCS if i != 42 or module is substring_dedup]
    if module is substring_dedup:
        want = brute_removed(35, [(i, t.split()) for i, t in texts], b" ")
    else:
        want = brute_removed(200, [(i, [bytes([c]) for c in t]) for i, t in texts], b"")
    found = module.repeats(docs.where("doc_id <> 42 or doc_id is null") if module is suffix_dedup else docs, hot=hot)
    got = Counter((r.doc_id, r.n_units, r.n_removed, r.n_spans, r.kept_sha256) for r in found.removed().collect())
    assert got == want
    if hot == 2:
        assert module.repeats(empty).removed().isEmpty()
        return
    # every group is a repeat: its occurrences are equal, and no two are the same place
    text = {r.node: r.text for r in found.texts.collect()}
    groups = defaultdict(list)
    for r in found.groups().collect():
        units = text[r.node].encode().split() if module is substring_dedup else text[r.node].encode()
        assert len(units[r.start: r.start + r.length]) == r.length
        groups[r.group_id].append((tuple(units[r.start: r.start + r.length]), (r.node, r.start)))
    assert groups
    for g in groups.values():
        assert len({u for u, _ in g}) == 1 and len({p for _, p in g}) == len(g) > 1


@pytest.mark.parametrize("module", [substring_dedup, suffix_dedup])
def test_occurrences_are_complete(spark, module):
    """The places of every repeated window are the places of a group, also where only copies of a text repeat it."""
    rng = random.Random(3)
    passage, copied, other = _words(rng, 50), _words(rng, 70), _words(rng, 40)
    texts = [copied, copied, copied, f"{_words(rng, 20)} {passage} {_words(rng, 20)}", f"{_words(rng, 9)} {passage}",
             f"{other} {other}", f"{other} {other}", _words(rng, 60), "short text", "short text", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    units = [(t or "").encode() for t in texts]
    if module is substring_dedup:
        units = [t.split() for t in units]
    length, windows, want = module.LENGTH, defaultdict(set), defaultdict(set)
    for i, x in enumerate(units):
        for p in range(len(x) - length + 1):
            windows[tuple(x[p: p + length])].add((i, p))
    for r in module.repeats(docs).occurrences().collect():
        want[r.group_id, r.length].add((r.doc_id, r.start))
    shifted = set()
    for (_, n), places in want.items():
        assert len(places) > 1 and len({tuple(units[i][p: p + n]) for i, p in places}) == 1
        shifted |= {frozenset((i, p + d) for i, p in places) for d in range(n - length + 1)}
    repeated = [w for w in windows.values() if len(w) > 1]
    assert {i for w in repeated for i, _ in w} == {0, 1, 2, 3, 4, 5, 6}
    assert all(frozenset(w) in shifted for w in repeated)


def brute_maximal(length, units):
    """(length, places) of all strings that can't be extended to either side at all their places."""
    places = defaultdict(list)
    for i, x in enumerate(units):
        for p in range(len(x)):
            for q in range(p + length, len(x) + 1):
                places[tuple(x[p:q])].append((i, p))
    out = set()
    for s, at in places.items():
        left = {units[i][p - 1] if p else (i, p) for i, p in at}
        right = {units[i][p + len(s)] if p + len(s) < len(units[i]) else (i, p) for i, p in at}
        if len(at) > 1 and len(left) > 1 and len(right) > 1:
            out.add((len(s), frozenset(at)))
    return out


@pytest.mark.parametrize("hot, look", [(8192, 64), (8192, 2), (2, 1), (5, 3)])
@pytest.mark.parametrize("module", [substring_dedup, suffix_dedup])
def test_groups_are_all_maximal_repeats(spark, monkeypatch, module, hot, look):
    """Passages in passages, repeats of repeats, copies, texts inside texts: groups equal a list of all maximal repeats."""
    from ledgerlint.llm import repeats

    monkeypatch.setattr(repeats, "LOOK", look)
    rng = random.Random(hot + look)
    draw = lambda n: [rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)]
    long, inner, tail = draw(30), draw(12), draw(9)
    long[9:21] = inner
    units = [long, long, draw(5) + long + draw(4), draw(6) + long, draw(3) + inner + draw(9), inner + tail, long + tail + long,
             inner * 2 + tail, ["x"] * 15, ["x", "y"] * 9, draw(20), [], draw(4), tail, tail]
    join = " " if module is substring_dedup else ""
    docs = spark.createDataFrame([(i, join.join(x)) for i, x in enumerate(units)], "doc_id bigint, text string").repartition(3)
    got = defaultdict(set)
    for r in module.repeats(docs, 6, 3, hot).occurrences().collect():
        got[r.group_id, r.length].add((r.doc_id, r.start))
    want = brute_maximal(6, units)
    assert {(n, frozenset(at)) for (_, n), at in got.items()} == want and len(got) == len(want) > 15


@pytest.mark.parametrize("module", [substring_dedup, suffix_dedup])
def test_a_long_passage_is_one_group(spark, module):
    rng = random.Random(12)
    passage = _words(rng, 200)
    texts = [f"{_words(rng, 60)} <{i}> {passage} <{i}> {_words(rng, 60)}" for i in range(3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = module.repeats(docs).occurrences().collect()
    assert len(rows) == 3 and len({r.group_id for r in rows}) == 1 and {r.doc_id for r in rows} == {0, 1, 2}
    assert {r.length for r in rows} == {200 if module is substring_dedup else len(passage) + 4}  # with "> " and " <"


def test_interval_tree_and_suffix_tree_agree():
    from ledgerlint.llm.repeats import Chunk, Units, repeats_of

    rng = np.random.default_rng(8)
    units = rng.integers(0, 2, 400)
    stop = np.arange(40, 401, 40)
    c = Chunk(units, stop - 40, stop, np.zeros(10, np.int64), np.ones(10, np.int64))
    u = Units(False, 6, 3)
    results = []
    for finder in (suffix_dedup.maximal_repeats, substring_dedup.maximal_repeats):
        found, pos, _ = repeats_of(u, c, finder)
        results.append(sorted((n, sorted(pos[m].tolist())) for n, m in found))
    assert results[0] == results[1] and len(results[0]) > 20


def test_language(spark, sf_small, empty):
    got = {r.doc_id: r for r in queries.op10_language(spark, sf_small).collect()}
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2)
        assert 0 <= got[d.doc_id].score <= 1
    unseen = [d for d in docs if got[d.doc_id].held_out]
    assert sum(got[d.doc_id].lang_pred == d.lang for d in unseen) >= 0.97 * len(unseen)


def test_language_edges(spark, docs, empty):
    got = defaultdict(set)
    for r in language_id.identify(docs).collect():
        got[r.doc_id].add(r.lang_pred)
    assert all(got[i] == {"und"} for i in (0, 1, 2, 5, 50)) and got[6] <= {"en", "de"}
    assert language_id.identify(empty).isEmpty()
    out = language_id.drop_unidentified(docs)
    assert {r.doc_id for r in out.collect()} == {i for i, *_ in DOCS} - {0, 1, 2, 5, 50} and out.columns == docs.columns
    assert out.count() == len(DOCS) - 5
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_language_mixture(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    model = language_id.learn(docs)
    one = {r.lang: r.text for r in docs.groupBy("lang").agg(F.max_by("text", F.length("text")).alias("text")).collect()}
    mixed = one["fr"][:1500] + " " + one["de"][:1500]
    row = language_id.predict(spark.createDataFrame([(1, mixed)], "doc_id bigint, text string"), model).first()
    shares = dict(x.split(":") for x in row.langs.split(","))
    assert set(shares) == {"fr", "de"} and all(0.35 < float(s) < 0.65 for s in shares.values())


def plain_mixture(model, text):
    """Language set with proportions of one text, and its likeliest language, by plain EM over all nested sets."""
    letters = [32] + [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in text.encode()] + [32]
    grams = Counter(g for g in zip(letters, letters[1:], letters[2:]) if not (g[1] == 32 and 32 in (g[0], g[2])))
    rows = [(n, np.exp(model.log_p[((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> 16].astype(float))) for (a, b, c), n in grams.items()]
    total = sum(grams.values())

    def fit(allowed):
        theta = np.array([float(i in allowed) for i in range(len(model.langs))]) / len(allowed)
        for _ in range(language_id.ROUNDS):
            theta = sum(n * theta * p / (theta @ p) for n, p in rows) / total
        return theta, sum(n * np.log(theta @ p) for n, p in rows)

    full = fit(range(len(model.langs)))[0]
    order = np.argsort(-full, kind="stable").tolist()
    price = language_id.PENALTY * np.log(max(total, 2))
    sets = [fit(order[:k]) for k in range(1, len(order) + 1)]
    value = [f - k * price for k, (_, f) in enumerate(sets, 1)]
    return sets[int(np.argmax(value))][0], full


def test_language_sets_equal_plain_em(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    model = language_id.learn(docs)
    rng = random.Random(4)
    texts = {lang: [r.text for r in docs.where(F.col("lang") == lang).select("text").collect() if r.text] for lang in model.langs}
    samples = [rng.choice(texts[lang])[:rng.randrange(5, 900)] for lang in model.langs for _ in range(4)]
    samples += [" ".join(rng.choice(texts[x])[:rng.randrange(40, 700)] for x in rng.sample(model.langs, k)) for k in (2, 2, 2, 3, 3) for _ in range(3)]
    samples = [t for t in samples if any(c.isascii() and c.isalpha() for c in t)]
    raw = [t.encode() for t in samples]
    best, score, shares = language_id.infer(model, np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(x) for x in raw])))
    several = 0
    for i, t in enumerate(samples):
        chosen, full = plain_mixture(model, t)
        assert np.allclose(shares[i], chosen, atol=5e-3) and abs(score[i] - full[best[i]]) < 5e-3
        assert best[i] == chosen.argmax()
        several += (chosen > 0).sum() > 1
    assert several >= 5


@pytest.mark.parametrize("size", [1, 2, 3])
def test_language_blocks(spark, sf_small, monkeypatch, size):
    """Several blocks: every language is learnt, and the block of the best penalised likelihood decides, as in plain Python."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    known = docs.where(~language_id.held_out(F.col("doc_id")))
    whole = language_id.learn(known)
    monkeypatch.setattr(language_id, "LANGS", size)
    blocks = list(language_id.models(known))
    assert [x for m in blocks for x in m.langs] == whole.langs and {len(m.langs) for m in blocks[:-1]} <= {size}
    assert [m.last for m in blocks] == [False] * (len(blocks) - 1) + [True]
    assert np.array_equal(np.hstack([m.log_p for m in blocks]), whole.log_p)
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    rows = docs.where("text is not null").orderBy("doc_id").limit(40).collect()
    assert len(got) == docs.count()
    for r in rows:
        raw = r.text.encode()
        found = [language_id.weigh(m, np.frombuffer(raw, np.uint8), np.array([0, len(raw)])) for m in blocks]
        m, (best, score, *_) = max(zip(blocks, found, strict=True), key=lambda x: x[1][3][0])
        if any(c.isalpha() for c in r.text):
            assert got[r.doc_id].lang_pred == m.langs[best[0]] and abs(got[r.doc_id].score - score[0]) < 1e-4
    unseen = [d for d in docs.collect() if got[d.doc_id].held_out]
    assert sum(got[d.doc_id].lang_pred == d.lang for d in unseen) >= 0.97 * len(unseen)


def test_language_many_values(spark, monkeypatch):
    """More values of ``lang`` than a block or a task's table holds; the most frequent come first, ties by name."""
    monkeypatch.setattr(language_id, "LANGS", 7)
    rows = [(i, f"{chr(97 + i % 20) * 3} word{i % 20} " * 9, f"x{i % 20:02}") for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    blocks = list(language_id.models(docs))
    assert [x for m in blocks for x in m.langs] == [f"x{i:02}" for i in range(20)] and [len(m.langs) for m in blocks] == [7, 7, 6]
    got = {r.doc_id: r.lang_pred for r in language_id.predict(docs, blocks).collect()}
    assert got == {i: lang for i, _, lang in rows}


def test_language_noise_goes(spark, sf_small):
    """Letters that no learnt language explains better than chance are rejected by the filter, all prose stays."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(8)
    noise = [(-i, "".join(chr(rng.randrange(0x3400, 0x4db0)) for _ in range(30 * i)), None) for i in range(1, 6)]
    mixed = docs.union(spark.createDataFrame(noise, docs.schema))
    kept = Counter(r.doc_id for r in language_id.drop_unidentified(mixed, noise=False).collect())
    assert language_id.drop_unidentified(mixed).count() == sum(kept.values()) + len(noise)
    assert kept == Counter(r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text))


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    want = Counter((i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t, *_ in DOCS)
    rows = packing.pack(docs, path).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, bytes(r.ids), r.doc_tokens))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 4096 or at & (at - 1) == 0
    for i, parts in pieces.items():
        if i == 57:
            continue  # two rows of one id
        parts.sort()
        whole = b"".join(p[1] for p in parts)
        assert want[i, whole] == 1 and all(p[2] * 4 == len(whole) for p in parts)
    assert sum(len(r.ids) for r in rows) == sum(len(ids) * n for (_, ids), n in want.items())
    assert packing.pack(empty, path).isEmpty()


def test_word_encoding_equals_the_tokenizer():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from ledgerlint.llm.wordbpe import encode_column

    path = queries.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    rng = random.Random(2)
    pool = "aAbzZéÉßñÿİıſǅσΣ09²½_'.,!<|>&%$ \t\n\x0b\x1c\x85\xa0…漢👍\u0301\u200d\xad"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["x<|endoftext|>y <|ENDOFTEXT|> don't I'LL", "", " "]
    at = 0
    for ids, counts in encode_column(pa.array(texts), path):
        ends = np.cumsum(counts)
        for n, e in zip(counts, ends):
            assert ids[e - n: e].tolist() == tokenizer.encode(texts[at], add_special_tokens=False).ids, texts[at]
            at += 1
    assert at == len(texts)


BENCH = [(1, "The quick brown fox jumps over the lazy dog while seven wizards boil green tea in copper kettles quietly"),
         (2, "Short item here"), (3, None), (4, "")]


def test_decontamination(spark, empty):
    copy = BENCH[0][1]
    w = copy.split()
    swapped = [x if k % 7 else "changed" for k, x in enumerate(w)]
    rows = [(1, f"before {copy.upper()}, after"), (2, " ".join(w[:14])), (3, "unrelated words about the quick brown dog and tea"),
            (4, None), (5, ""), (6, " ".join(reversed(w))), (7, " ".join(swapped)), (1, f"before {copy.upper()}, after"), (None, copy)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(c) for c in CLASHES})
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()}
    assert got == {(1, 1), (2, 1), (7, 1), (None, 1)}
    assert sorted(r.doc_id for r in decontam.drop_leaks(docs, bench).collect()) == [3, 4, 5, 6]
    assert decontam.find_leaks(docs.limit(0), bench).isEmpty() and decontam.find_leaks(docs, bench.limit(0)).isEmpty()


def test_filters_judge_rows_not_ids(spark):
    """A rejected row takes no other row of its id, or without an id, with it."""
    leak = BENCH[0][1]
    rows = [(None, "a clean text without an id", "en"), (None, "12 34", "en"), (None, None, "en"), (None, leak, "en"),
            (7, "a clean text under the id seven", "en"), (7, "", "en"), (7, leak, "en"), (8, "another one", "en"), (9, "more words", "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    lettered = Counter(t for _, t, _ in rows if t and t != "12 34")
    assert Counter(r.text for r in language_id.drop_unidentified(docs).collect()) == lettered
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert Counter(r.text for r in language_id.drop_unidentified(unlabelled).collect()) == lettered
    assert Counter(r.text for r in decontam.drop_leaks(docs, bench).collect()) == Counter(t for _, t, _ in rows if t != leak)


def test_decontamination_equals_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    masks = [[i for i, c in enumerate(m) if c == "1"] for m in decontam.MASKS]
    items = {r.item_id: split(r.text) for r in bench.collect()}
    seeds = defaultdict(list)
    for item, w in items.items():
        for m, mask in enumerate(masks):
            for p in range(len(w) - len(decontam.MASKS[m]) + 1):
                seeds[m, tuple(w[p + i] for i in mask)].append((item, p))
    want = set()
    for d in docs.collect():
        w = split(d.text)
        for m, mask in enumerate(masks):
            for p in range(len(w) - len(decontam.MASKS[m]) + 1):
                for item, q in seeds.get((m, tuple(w[p + i] for i in mask)), ()):
                    n = min(13, len(items[item]))
                    reach = max(map(len, decontam.MASKS)) + 12
                    same = [0 <= p + k < len(w) and 0 <= q + k < len(items[item]) and w[p + k] == items[item][q + k] for k in range(-12, reach)]
                    if max(sum(same[s: s + n]) for s in range(len(same) - n + 1)) >= decontam.MIN_SHARE * n:
                        want.add((d.doc_id, item))
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()} == want and want


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))
    return total % 10 == 0


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                  "card": 12 <= len(digits) <= 19 and _luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def test_pii_base_spans(spark, empty):
    rng = random.Random(4)
    pool = "0123456789" * 3 + "....--  ++@@()abzZ_%é🙂\n"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(120))) for _ in range(300)]
    texts += ["a@b.co_x@d.ef", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.0003.4", "4111 1111-1111 1111, 4111111111111112", "+1 (212) 555-0100 x", None, "",
              "1" * 20000, "9 " * 20000, "a" * 20000, "é🙂 me@x.org", "+" * 3000 + "1" * 30, "1.1." * 5000]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(c) for c in CLASHES})
    got = pii.digest_spans(pii.find_pii(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        spans = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), texts[r.doc_id]
        assert [s for s in r.spans.split(",") if s and not s.startswith("id:")] == spans
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s.startswith(k + ":") for s in spans) for k in PLAIN)
    assert pii.digest_spans(pii.find_pii(docs.limit(0))).isEmpty()


def test_pii_pattern_does_not_vouch_for_itself(spark):
    """Half of a pattern's instances are seeds, the others order numbers that stand nowhere else: 0.5, not 0.8."""
    rows = [(i, f"we sent it to user{i}@mail.org today") for i in range(8)] + [(100 + i, f"we sent it to order-{i}7431x today") for i in range(8)]
    got = pii.digest_spans(pii.find_pii(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect()
    assert sum(r.n_email for r in got) == 8 and all(r.n_id == 0 for r in got)


def test_pii_bootstrapping_finds_unseen_identifiers(spark):
    rng = random.Random(6)
    rows = [(i, f"{_words(rng, 9)} please contact user{i}@mail.org {_words(rng, 9)}") for i in range(8)]
    rows += [(100, "Hello, please contact badge-77431x today"), (101, "nobody said badge-99999y today"), (102, "please contact us")]
    got = {r.doc_id: r for r in pii.digest_spans(pii.find_pii(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect()}
    assert got[100].spans == "id:22:34" and got[100].n_id == 1
    assert got[101].spans == "" and got[102].spans == "" and got[0].n_email == 1 and got[0].n_id == 0
