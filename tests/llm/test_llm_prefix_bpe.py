"""Operator 13 against the tokenizers library."""

import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlint.llm import prefix_bpe, queries
from ledgerlint.sources.tables import read_table

PATH = public_tokenizers.path("byte_bpe_50k.json")
RAW = prefix_bpe.read_vocabulary(PATH)
OWN, BACK, WANT = prefix_bpe.Encoder(RAW), prefix_bpe.Decoder(RAW), Tokenizer.from_file(PATH)


def ids(raw: bytes):
    return np.frombuffer(raw, "<u4").tolist()


def same(text):
    want = WANT.encode(text, add_special_tokens=False).ids
    got = OWN.encode(text)
    assert ids(got) == want
    assert BACK.decode(got) == WANT.decode(want, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text())
def test_any_text(text):
    same(text)


@pytest.mark.parametrize("alphabet", ["a ab'rsetl", "aaaaab", "  \n\t x\x85　​", "éñ中文ไทย😀🇩🇪", "0123456789.,!?-½Ⅷ", "the and "])
def test_narrow_alphabets(alphabet):
    rng = random.Random(alphabet)
    for _ in range(400):
        same("".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 80))))


def test_special_tokens_in_texts():
    for text in ("<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "<|endoftext|><|endoftext|>", "<|endoftext", " <|endoftext|> x"):
        same(text)


def test_characters_that_libraries_class_differently():
    for a, b in prefix_bpe.unassigned()[:200]:
        same(f"a{chr(a)}1 {chr(b)}a  {chr(a)}!")


def test_every_kind_of_white_space_and_class():
    for c in [*range(0x3000), 0xFEFF, 0x1D7CE, 0x20000]:
        if not 0xD800 <= c < 0xE000:
            same(f"a {chr(c)}b{chr(c)} 1 {chr(c)}{chr(c)} {chr(c)}")


def test_windows(monkeypatch):
    monkeypatch.setattr(prefix_bpe, "WINDOW", 40)
    rng = random.Random(4)
    for _ in range(200):
        same("".join(rng.choice(["ab", " ", "  ", "\n", "'re", "12", "é", "."]) for _ in range(200)))


def test_long_pieces():
    for text in ("a" * 20_000, " " * 20_000 + "x", "ab" * 10_000, "中" * 5_000, "'re" * 3_000, "-" * 9_999):
        same(text)


def test_bounded_memories(monkeypatch):
    for name in ("MAX_PIECES", "MAX_PAIRS", "MAX_STEPS"):
        monkeypatch.setattr(prefix_bpe, name, 16)
    small = prefix_bpe.Encoder(RAW)
    rng = random.Random(7)
    for _ in range(300):
        text = " ".join("".join(rng.choices("aeioucdt", k=6)) for _ in range(9))
        assert ids(small.encode(text)) == WANT.encode(text, add_special_tokens=False).ids
    assert len(small.spaced) <= 16 and len(small.spaced.before) <= 16


def test_pairs_equal_the_library():
    """fits(a, b) holds exactly if the library encodes the joined bytes as these two tokens."""
    rng, v = random.Random(3), OWN.vocabulary
    words = [t for t in v.reachable() if v.bytes[t].isalpha()]
    for a, b in [(rng.choice(words), rng.choice(words)) for _ in range(3000)]:
        found = WANT.encode((v.bytes[a] + v.bytes[b]).decode(), add_special_tokens=False).ids
        assert v.fits(a, b, OWN.end) == (found == [a, b])


def test_decoding_odd_ids():
    assert BACK.decode(np.array([50256, 99999999, 220], "<u4").tobytes()) == "<|endoftext|> "
    raw = np.array([OWN.vocabulary.bytes.index(b"\xe4"), OWN.vocabulary.bytes.index(b"a")], "<u4")
    assert BACK.decode(raw.tobytes()) == WANT.decode(raw.tolist(), skip_special_tokens=False) == "�a"


def test_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError):
        prefix_bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_query_equals_the_library(spark, sf_small):
    docs = {r.doc_id: r.text or "" for r in read_table(spark, sf_small, "documents").collect()}
    out = queries.op13_bpe(spark, sf_small)
    assert [f"{c} {t}" for c, t in out.dtypes] == ["doc_id bigint", "n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]
    got = {r.doc_id: tuple(r)[1:] for r in out.collect()}
    want = {}
    for i, text in docs.items():
        found = WANT.encode(text, add_special_tokens=False).ids
        want[i] = (len(found), sha256(np.array(found, "<u4").tobytes()).hexdigest(),
                   sha256(WANT.decode(found, skip_special_tokens=False).encode()).hexdigest())
    assert got == want


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "OUT_BYTES", 64)
    rows = [(1, None, 1), (2, "", 1), (None, "ab c", 1), (3, "ab c", 1), (3, "ab c", 1), (4, "ab " * 200_000, 1), (5, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    coded = prefix_bpe.encode_texts(df, RAW, keep=("doc_id",))
    got = sorted((r.doc_id or 0, r.n_tokens, bytes(r.ids)) for r in coded.collect())
    want = sorted((i or 0, len(w := WANT.encode(t or "", add_special_tokens=False).ids), np.array(w, "<u4").tobytes()) for i, t, _ in rows)
    assert got == want
    back = prefix_bpe.decode_ids(coded, RAW)
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == sorted((i or 0, t or "") for i, t, _ in rows)
    assert prefix_bpe.decode_ids(spark.createDataFrame([(1, None)], "doc_id bigint, ids binary"), RAW).first().text == ""
    assert prefix_bpe.encode_texts(df.limit(0), RAW).count() == 0
    kept = prefix_bpe.encode_texts(df.withColumnRenamed("ids", "__x"), RAW, keep=("doc_id", "__x"))
    assert kept.columns == ["doc_id", "__x", "n_tokens", "ids"] and kept.count() == 7
