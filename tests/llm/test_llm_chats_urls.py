"""Chat formatting and URL filter: round trips, brute force and edge cases."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlint.llm import chat_format, queries, url_filter

CHATS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
    (2, 0, "user", "</s>[INST] ok [/INST]"), (2, 1, "assistant", r"[\INST] <\\s> [[INST]] <<s>"),
    (3, 0, "assistant", "first"), (4, 0, "user", None), (4, 1, "assistant", ""), (5, 0, "tool", "x[/TURN]"), (5, 1, None, "y"),
    (6, 1, "user", "tie b"), (6, 1, "user", "tie a"), (6, 1, "user", "tie a"), (7, None, "user", "no turn"), (None, 0, "user", "no id"),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.fixture(scope="module")
def chats(spark):
    rng = random.Random(1)
    pool = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "ROLE]", "/TURN]", "SYS]", "a", "é🙂", "\n"]
    rows = CHATS + [(100 + i, j, rng.choice(["user", "assistant", "system", "[INST]"]), "".join(rng.choice(pool) for _ in range(12)))
                    for i in range(60) for j in range(4)]
    return rows, spark.createDataFrame(rows, SCHEMA).withColumns({"turns": F.lit(1), "parts": F.lit("p"), "segments": F.lit("s")})


def test_round_trip(chats):
    rows, df = chats
    want = defaultdict(list)
    for c, t, r, x in rows:
        want[c].append((t is not None, t or 0, (r or "").encode(), (x or "").encode()))
    out = chat_format.format_chats(df)
    got = {r.conv_id: r for r in chat_format.parse_chats(out).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        turns = [(r.decode(), x.decode()) for *_, r, x in sorted(turns)]
        assert [(t.role, t.text) for t in got[c].turns] == turns
        assert got[c].loss_text == "".join(x for r, x in turns if r == "assistant")
    for r in out.collect():
        assert "".join(r.formatted[s.start: s.start + s.length] for s in r.segments) == r.formatted


def test_automaton(chats):
    got = {r.conv_id: (r.valid, r.bad_turn) for r in chat_format.format_chats(chats[1]).collect()}
    assert got[1] == (True, None) and got[2] == (True, None) and got[3] == (False, 0)
    assert got[5] == (False, 0) and got[6] == (False, 1) and got[7] == (False, None)


def test_empty_chats(chats):
    assert chat_format.parse_chats(chat_format.format_chats(chats[1].limit(0))).isEmpty()


def test_escaped_text_holds_no_control_string(chats):
    t = chat_format.Template()
    for r in chat_format.format_chats(chats[1]).collect():
        for s in r.segments:
            part = r.formatted[s.start: s.start + s.length]
            if part not in t.controls():
                assert not any(c in part for c in t.controls())


URLS = ["http://a.org/x", "https://Example.ORG/es/1?q", "http://sub.example.org/en/1", "http://example.org/en/2", "http://example.org/es",
        "http://b.com/fr/1", "http://b.com/de/1#f", "http://notorg/x", "http://x.example.org.net/es/", "ftp://casino-win.example.net/play",
        "nope", None, "://", "http://host", "http://h?x=/fr/", "http://org/", "http://b.com/fr", "x://y://z/w", "http://ÄÖ.org/É"]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for action, rule in url_filter.RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (action, rule)
    return host, path, best


def test_rules_and_parts(spark):
    df = spark.createDataFrame(list(enumerate(URLS)) + [(0, URLS[0])], "page_id bigint, url string").withColumns({c: F.lit("c") for c in ("host", "rule", "score", "features", "grams")})
    got = url_filter.judge(df, url_filter.seed_model(spark)).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path, best = brute(URLS[r.page_id])
        assert (r.host, r.path) == (host, path)
        assert r.rule == (best and best[1]) and 0 <= r.score <= 1
        assert r.verdict == (best[0] if best else "block" if r.score >= 0.5 else "allow")
    assert url_filter.judge(df.limit(0), url_filter.seed_model(spark)).isEmpty()


def test_classifier_separates_unseen_hosts(spark, sf_small):
    rows = [(0, "http://casino-games.example.net/x/1"), (1, "http://blog.pills-cheap.example.com/y"), (2, "https://www.spamfarm.example.net/z"),
            (3, "http://nothing.example.net/en/1"), (4, "https://m.theory.example.com/es/8"), (5, "http://reading.example.net/de/77")]
    got = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(rows, "page_id bigint, url string"), url_filter.seed_model(spark)).collect()}
    assert [got[i] for i in range(6)] == ["block"] * 3 + ["allow"] * 3


def test_classifier_on_held_out_rows(spark):
    """Precision and recall on labelled urls that the fit has not seen, four folds."""
    rows = list(enumerate(url_filter.LABELLED))
    hits = {(w, g): 0 for w in (0, 1) for g in (0, 1)}
    for fold in range(4):
        model = url_filter.fit(spark.createDataFrame([r for i, r in rows if i % 4 != fold], "label int, url string"))
        pages = spark.createDataFrame([(label, url) for i, (label, url) in rows if i % 4 == fold], "page_id int, url string")
        for r in url_filter.judge(pages, model, rules=()).collect():
            hits[r.page_id, int(r.verdict == "block")] += 1
    assert sum(hits.values()) == len(rows)
    precision, recall = hits[1, 1] / max(1, hits[1, 1] + hits[0, 1]), hits[1, 1] / (hits[1, 1] + hits[1, 0])
    print("held out:", hits, precision, recall)
    assert precision >= 0.8 and recall >= 0.8


def test_whole_table(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    assert queries.op2_url_filter(spark, sf_small).count() == pages.count()


def test_chat_query_digests(spark, sf_small):
    row = queries.op5_chat_format(spark, sf_small).where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and row.loss_chars == len(text) and row.n_turns == 2
