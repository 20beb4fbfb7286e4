"""BPE encoding and decoding (operator 13): dynamic programming over the prefixes of a piece.

A byte-level BPE of the merges' ranks has one encoding for every byte string, and each
prefix of an encoding is the encoding of that prefix.  So every prefix of a piece has one
last token.  An automaton of the vocabulary names the tokens that are suffixes of
the prefix; the one that may follow the last token of what is before it is stored.  Two tokens
may follow each other if no merge across their border comes before the merges that made
them.  Back-pointers by token length give the ids.

Texts are cut into pieces by the vocabulary's own pattern; special tokens that stand in a
text have their own ids, as in the tokenizers library.  Pieces, and runs between spaces,
that were met before are looked up by their whole text (``MAX_PIECES`` of each are
remembered at most in a Python worker, short ones only).

Defined results: null text is empty and has no ids.  Repeated rows are encoded each; extra
columns are ignored unless named in ``keep``; empty tables give empty tables.  Very long
texts are cut window by window, and a very long piece costs time in proportion
to its length.  Decoding joins the bytes of the ids, skips ids that the vocabulary doesn't
have, and puts U+FFFD for bytes that aren't UTF-8.  A null in place of ids decodes to an
empty text.
"""

from __future__ import annotations

import json
import re
import sys
import types
import unicodedata
from array import array
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

MAX_PIECES = 500_000
MAX_PAIRS = 1_000_000
#: Pieces of more characters aren't remembered.
LONG_PIECE = 48
#: Characters cut into pieces at once.
WINDOW = 1 << 20
MAX_STEPS = 1_000_000
SHORTER = -1
#: Marks that end a run of letters as a piece of their own.
MARKS = frozenset(".,;:!?)")
#: A space before a visible character.
BORDER = re.compile(r" (?=\S)")
#: Bytes of output in one Arrow batch, but for a row that is longer by itself.
OUT_BYTES = 16 << 20
#: The split of byte-level vocabularies (fixed value of the format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def unassigned() -> list[tuple[int, int]]:
    """The ranges of code points beyond Latin that this Python's Unicode data leaves unassigned."""
    ranges, begin = [], None
    for c in range(0x250, 0x110001):
        gap = c < 0x110000 and unicodedata.category(chr(c)) == "Cn"
        if gap and begin is None:
            begin = c
        elif not gap and begin is not None:
            ranges.append((begin, c - 1))
            begin = None
    return ranges


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and not any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        split = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        added = spec.get("added_tokens") or []
        if not (plain and split) or spec.get("normalizer") or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("a byte-level BPE file without normalizer, prefix space and stripping special tokens is needed")
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in added}
        self.size = 1 + max([*model["vocab"].values(), *self.special.values()])
        self.bytes: list[bytes | None] = [None] * self.size
        for token, i in model["vocab"].items():
            self.bytes[i] = bytes(letters[c] for c in token) if token not in self.special else token.encode()
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        single = {model["vocab"][c]: b for c, b in letters.items() if c in model["vocab"]}
        if len(single) != 256:
            raise ValueError("the vocabulary lacks some byte")
        # rank of the merge that makes a token (-1: a byte), its parts, and what a pair becomes
        self.made, self.parts, self.joined = [None] * self.size, [None] * self.size, {}
        for i in single:
            self.made[i] = -1
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, whole = model["vocab"][left], model["vocab"][right], model["vocab"][left + right]
            if self.made[a] is None or self.made[b] is None or self.made[whole] is not None:
                raise ValueError(f"merge {rank} uses a token before it is made, or makes one again")
            self.made[whole], self.parts[whole], self.joined[a, b] = rank, (a, b), whole

    def fits(self, a: int, b: int, until: int) -> bool:
        """Whether no merge of a rank below ``until`` joins ``a`` and ``b``, or parts of them, across their border.

        The border's neighbours are taken apart from the youngest to the oldest.  A merge of two neighbours
        would have happened if it comes before the merge that used up either of them; of equal merges the left
        one comes first.
        """
        made, parts, joined = self.made, self.parts, self.joined
        end_a = end_b = until
        while True:
            whole = joined.get((a, b))
            if whole is not None and made[whole] < end_a and (made[whole] < end_b or made[whole] == end_b < until):
                return False
            if made[a] == made[b] == -1:
                return True
            if made[b] >= made[a]:
                end_b, b = made[b], parts[b][0]
            else:
                end_a, a = made[a], parts[a][1]

    def reachable(self) -> list[int]:
        """Tokens that are the encoding of their own bytes, oldest first."""
        good = set()
        for t in sorted((i for i in range(self.size) if self.made[i] is not None), key=lambda i: self.made[i]):
            if self.parts[t] is None or (self.parts[t][0] in good and self.parts[t][1] in good and self.fits(*self.parts[t], self.made[t])):
                good.add(t)
        return [t for t in range(self.size) if t in good]


class _Remembered(dict):
    """Little-endian 32-bit ids by string; a missing one is encoded.

    When it is full, what was not asked for since it was last full is forgotten.
    """

    def __init__(self, encode, at_most: int):
        super().__init__()
        self.encode, self.at_most, self.before = encode, at_most, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.before.get(key)
        if ids is None:
            ids = self.encode(key)
        if len(key) <= LONG_PIECE:
            if 2 * len(self) >= self.at_most:
                self.before = dict(self)
                self.clear()
            self[key] = ids
        return ids


class SuffixAutomaton:
    """For each prefix of a byte string, the tokens that are its suffixes, the longest first.

    A state stands for the longest suffix that begins some token: a pair of its branches and of the (token, length,
    tokens that may come before) found there.  ``SHORTER`` among the branches leads to the next shorter such suffix.
    Steps that leave the tree of the tokens go along these links, and are remembered (``MAX_STEPS`` at most).
    """

    def __init__(self, tokens):
        self.start, self.room = ({}, []), MAX_STEPS
        for t, word in tokens:
            state = self.start
            for b in word:
                if b not in state[0]:
                    state[0][b] = {}, []
                state = state[0][b]
            state[1].append((t, len(word), set()))
        level = [self.start]
        while level:  # the shorter suffix of a state stands on an earlier level
            deeper = []
            for state in level:
                for b, to in state[0].items():
                    if b != SHORTER:
                        link = self.along(state[0].get(SHORTER), b) if state is not self.start else self.start
                        to[0][SHORTER] = link
                        to[1].extend(link[1])
                        deeper.append(to)
            level = deeper

    def along(self, link, b: int):
        while link is not None:
            if b in link[0]:
                return link[0][b]
            link = link[0].get(SHORTER)
        return self.start

    def follow(self, branches: dict, b: int):
        """The step of a state that has no branch ``b`` of its own."""
        to = self.along(branches.get(SHORTER), b)
        if self.room:
            self.room -= 1
            branches[b] = to
        return to


class Encoder:
    """Ids of texts by the last token of every prefix."""

    def __init__(self, raw: bytes):
        import regex

        self.raw, self.own_split = raw, None
        self.vocabulary = v = Vocabulary(raw)
        self.suffixes = SuffixAutomaton((t, v.bytes[t]) for t in v.reachable())
        self.length = [len(b or b"") for b in v.bytes]
        self.end = len(v.joined) + 1  # a rank beyond all merges
        self.tested, self.may_not = 0, set()
        self.pieces = _Remembered(lambda piece: array("I", self.encode_piece(piece.encode())).tobytes(), MAX_PIECES // 8)
        # strings that begin a text, and strings after a space (remembered without it)
        self.first = _Remembered(self.encode_run, MAX_PIECES // 8)
        self.spaced = _Remembered(self.encode_spaced, MAX_PIECES)
        self.split = regex.compile(PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, sorted(v.special, key=len, reverse=True)))) if v.special else None
        self.unassigned = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in unassigned()) + "]")

    def test_pair(self, a: int, b: int, may: set) -> bool:
        """Whether ``b`` may follow ``a``: remembered in ``may``, or among the pairs that may not (``MAX_PAIRS`` of each)."""
        if (a, b) in self.may_not:
            return False
        if self.vocabulary.fits(a, b, self.end):
            if self.tested < MAX_PAIRS:
                self.tested += 1
                may.add(a)
            return True
        if len(self.may_not) >= MAX_PAIRS:
            self.may_not.clear()
        self.may_not.add((a, b))
        return False

    def encode_piece(self, piece: bytes) -> list[int]:
        follow, (branches, _) = self.suffixes.follow, self.suffixes.start
        last, at = [-1], 0
        for b in piece:
            at += 1
            branches, ends = branches.get(b) or follow(branches, b)
            for t, n, may in ends:
                if n == at or (before := last[at - n]) in may or self.test_pair(before, t, may):
                    last.append(t)
                    break
        ids, length = [], self.length
        while at:
            t = last[at]
            ids.append(t)
            at -= length[t]
        ids.reverse()
        return ids

    def encode_run(self, run: str) -> bytes:
        """Ids of a part of a text that begins and ends at borders of pieces."""
        if self.unassigned.search(run):
            # newer characters than this Python knows: libraries may class them differently, so the file's own split decides
            if self.own_split is None:
                from tokenizers import Tokenizer

                self.own_split = Tokenizer.from_buffer(self.raw).pre_tokenizer
            pieces = [run[a:b] for _, (a, b) in self.own_split.pre_tokenize_str(run)]
        else:
            pieces = self.split.findall(run)
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode_spaced(self, run: str) -> bytes:
        """Ids of a space and ``run``; letters alone are one piece, and so is a mark after them."""
        if run.isalpha():
            return array("I", self.encode_piece(b" " + run.encode())).tobytes()
        if run[-1] in MARKS and run[:-1].isalpha():
            return self.spaced[run[:-1]] + self.pieces[run[-1]]
        return self.encode_run(" " + run)

    def encode_plain(self, text: str) -> bytes:
        """Ids of a text without special tokens.

        A space before a visible character always begins a piece, whatever is around it; so the text falls into
        runs there, and a window of the text may end there.
        """
        out, at = [], 0
        while at < len(text):
            border = len(text) - at > WINDOW and BORDER.search(text, at + WINDOW)
            to = border.start() if border else len(text)
            runs = BORDER.split(text[at:to])
            if at == 0 or runs[0]:
                out.append(self.first[runs[0]])
            out += map(self.spaced.__getitem__, runs[1:])
            at = to
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        if self.special is None or not any(s in text for s in self.vocabulary.special):
            return self.encode_plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [self.encode_plain(text[at: m.start()]), self.vocabulary.special[m.group()].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, self.encode_plain(text[at:])])


class Decoder:
    """Texts of ids."""

    def __init__(self, raw: bytes):
        self.table = [b or b"" for b in Vocabulary(raw).bytes]

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4")
        out = []
        for at in range(0, len(numbers), WINDOW):
            part = numbers[at: at + WINDOW]
            out += map(self.table.__getitem__, part[part < len(self.table)].tolist())
        return b"".join(out).decode("utf-8", "replace")


def _kept(kind, raw: bytes):
    """The worker's encoder or decoder of a file, kept from task to task."""
    store = sys.modules.setdefault("_ledgerlint_prefix_bpe", types.ModuleType("_ledgerlint_prefix_bpe")).__dict__.setdefault("made", {})
    key = kind.__name__, sha256(raw).digest()
    if key not in store:
        store[key] = kind(raw)
    return store[key]


def _by_size(batch, made, keep, kind, name, count=None):
    """Output batches of the kept columns and a made one, each of about OUT_BYTES."""
    at, held, size = 0, [], 0

    def close(to):
        columns = [batch.column(c).slice(at, to - at) for c in keep]
        extra = [pa.array([count(x) for x in held], pa.int64())] if count else []
        return pa.RecordBatch.from_arrays([*columns, *extra, pa.array(held, kind)], names=[*keep, *(["n_tokens"] if count else []), name])

    for i, x in enumerate(made):
        held.append(x)
        size += len(x)
        if size >= OUT_BYTES:
            yield close(i + 1)
            at, held, size = i + 1, [], 0
    if held:
        yield close(at + len(held))


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        raw = f.read()
    Vocabulary(raw)  # a wrong file fails here, not in the tasks
    return raw


def _columns(df: DataFrame, keep) -> str:
    kinds = dict(df.dtypes)
    return "".join(f"`{c}` {kinds[c]}, " for c in keep)


def encode_texts(docs: DataFrame, vocabulary: bytes, keep: tuple = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep``, n_tokens, ids (binary: little-endian 32-bit), for each row."""
    settle(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # one file's bytes

    def run(batches):
        encoder = _kept(Encoder, shared.value)
        for batch in batches:
            texts = (encoder.encode(x.as_py()) for x in batch.column("__text"))
            yield from _by_size(batch, texts, keep, pa.binary(), "ids", lambda x: len(x) // 4)

    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    return rows.mapInArrow(run, _columns(docs, keep) + "n_tokens bigint, ids binary")


def decode_ids(rows: DataFrame, vocabulary: bytes, keep: tuple = ("doc_id",), ids: str = "ids") -> DataFrame:
    """The columns ``keep`` and the decoded text."""
    settle(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        decoder = _kept(Decoder, shared.value)
        for batch in batches:
            texts = (decoder.decode(x.as_py() or b"") for x in batch.column("__ids"))
            yield from _by_size(batch, texts, keep, pa.string(), "text")

    known = rows.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{ids}`").alias("__ids"))
    return known.mapInArrow(run, _columns(rows, keep) + "text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text decoded from them."""
    vocabulary = read_vocabulary(path)
    coded = encode_texts(docs, vocabulary).withColumn("ids_sha256", F.sha2("ids", 256))
    keep = ("doc_id", "n_tokens", "ids_sha256")
    return decode_ids(coded, vocabulary, keep).select(*keep, F.sha2("text", 256).alias("decoded_sha256"))
