"""Token ids of whole texts, piece by piece, equal to the tokenizer's own encoding.

The tokenizer drops white space and treats the pieces between apart: runs of
letters, single digits, runs of other characters.  Numpy cuts a slice of many texts
into its pieces at once; each distinct piece is encoded once and remembered while
the Python worker lives (``MAX_PIECES`` at most, found by 64-bit hashes and
compared byte by byte).
Plain pieces (ASCII and the letters U+00C0 to U+00FF) are merged by the tokenizer's
own merge ranks in tiktoken; a word with anything else in it (an apostrophe,
another script, a special token) is one piece and is given to the tokenizer itself.
"""

from __future__ import annotations

import json
import sys
import types
from array import array

import numpy as np

from .textbytes import IS_SPACE, equal_spans, same_bytes, slices, word_spans

#: Pieces that a worker remembers; beyond that it starts anew.
MAX_PIECES = 1_500_000
#: Bytes of text encoded at once.
ENCODED = 1 << 20

# 0 white space, 1 letter, 2 digit, 3 other
_CLASS = np.full(256, 3, np.uint8)
_CLASS[128:] = 1
_CLASS[[*range(65, 91), *range(97, 123)]] = 1
_CLASS[48:58] = 2
_CLASS[IS_SPACE] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# bytes that make a word odd: controls, apostrophe, and all beyond ASCII but C3 and what may follow it
_ODD = np.zeros(256, bool)
_ODD[:32] = ~IS_SPACE[:32]
_ODD[[0x27, 0x7F]] = True
_ODD[0xC0:] = True
_ODD[0xC3] = False


def _byte_letters() -> dict:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pieces(data: np.ndarray, offsets: np.ndarray):
    """(folded bytes, starts, stops, odd) of the pieces of some texts; odd ones are whole words, not folded."""
    starts, stops, _ = word_spans(data, offsets)
    kind = _CLASS[data]
    before = np.zeros(len(data), np.uint8)
    before[1:] = data[:-1]
    accent = (before == 0xC3) & (data >= 0x80)
    odd_byte = _ODD[data] | ((data >= 0x80) & (data < 0xC0) & (before != 0xC3)) | (accent & ((data == 0x97) | (data == 0xB7)))
    odd_byte |= (data == 0x7C) & (before == 0x3C)  # <| may begin a special token
    folded = _LOWER[data]
    folded[accent & (data < 0x9F) & (data != 0x97)] += 0x20
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum(odd_byte, out=seen[1:])
    odd_word = seen[stops] > seen[starts]
    for a, b in zip(starts[odd_word].tolist(), stops[odd_word].tolist()):
        folded[a:b] = data[a:b]
    new = kind != 0
    new[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    new[starts] = True
    begin = np.flatnonzero(new)
    word = np.cumsum(np.bincount(np.searchsorted(begin, starts), minlength=len(begin))) - 1
    odd = odd_word[word]
    keep = ~odd | (begin == starts[word])
    begin, word, odd = begin[keep], word[keep], odd[keep]
    stop = np.minimum(np.append(begin[1:], len(data)), stops[word])
    return folded, begin, stop, odd


class PieceEncoder:
    """Ids of pieces by hash, in one sorted table that grows with what is met."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        # the end of a word is one more byte value; no UTF-8 text holds 0xFF
        ranks = {}
        for piece, rank in spec["model"]["vocab"].items():
            end = piece.endswith("</w>")
            body = piece[:-4] if end else piece
            if all(c in letters for c in body) and piece not in {t["content"] for t in spec["added_tokens"]}:
                ranks[bytes(letters[c] for c in body) + b"\xff" * end] = rank
        ranks.setdefault(b"\xff", len(spec["model"]["vocab"]))
        if spec["model"].get("end_of_word_suffix") != "</w>" or not all(bytes([b]) in ranks for b in range(255)):
            raise ValueError(f"{path}: a byte-level vocabulary with word ends is needed")
        self.plain = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.forget()

    def forget(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint16)
        # the bytes of each known piece
        self.text, self.text_at, self.text_size = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, raw: bytes, odd: bool) -> list[int]:
        return self.whole.encode(raw.decode(), add_special_tokens=False).ids if odd else self.plain(raw + b"\xff")

    def lookup(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, odd: np.ndarray, keys: np.ndarray) -> tuple:
        """(start in the pool, number of ids) of different pieces, spans of ``data`` with their hashes."""
        order = np.argsort(keys, kind="stable")
        if len(self.keys) + len(keys) > MAX_PIECES:
            self.forget()
        where = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        known = self.keys[where] == keys if len(self.keys) else np.zeros(len(keys), bool)
        hit = np.flatnonzero(known)
        # one array, so that known and new bytes can be compared in place
        both = np.concatenate([data, self.text])
        known[hit] = (self.text_size[where[hit]] == (stops - starts)[hit])
        hit = np.flatnonzero(known)
        known[hit] = same_bytes(both, starts[hit], len(data) + self.text_at[where[hit]], (stops - starts)[hit])
        at, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at[known], size[known] = self.at[where[known]], self.size[where[known]]
        missing = order[~known[order]]
        if len(missing):
            ids, count = array("H"), []
            for a, b, o in zip(starts[missing].tolist(), stops[missing].tolist(), odd[missing].tolist()):
                found = self.encode(data[a:b].tobytes(), o)
                ids.extend(found)
                count.append(len(found))
            count = np.array(count, np.int64)
            at[missing], size[missing] = len(self.pool) + np.cumsum(count) - count, count
            self.pool = np.concatenate([self.pool, np.frombuffer(ids, np.uint16)])
            # a hash is remembered for the first piece that has it
            fresh = missing[np.append(True, np.diff(keys[missing]) != 0)]
            place = np.searchsorted(self.keys, keys[fresh])
            taken = np.zeros(len(fresh), bool)
            inside = place < len(self.keys)
            taken[inside] = self.keys[place[inside]] == keys[fresh[inside]]
            fresh, place = fresh[~taken], place[~taken]
            n = (stops - starts)[fresh]
            text_at = len(self.text) + np.cumsum(n) - n
            flat = np.repeat(starts[fresh] - np.cumsum(n) + n, n) + np.arange(n.sum())
            self.text = np.concatenate([self.text, data[flat]])
            columns = (self.keys, self.at, self.size, self.text_at, self.text_size)
            values = (keys[fresh], at[fresh], size[fresh], text_at, n)
            self.keys, self.at, self.size, self.text_at, self.text_size = (np.insert(c, place, v) for c, v in zip(columns, values))
        return at, size


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a tokenizer file, kept from task to task."""
    store = sys.modules.setdefault("_ledgerlint_encoders", types.ModuleType("_ledgerlint_encoders"))
    kept = store.__dict__.setdefault("by_path", {})
    if path not in kept:
        kept[path] = PieceEncoder(path)
    return kept[path]


def forget() -> None:
    """Free what this worker's encoders remember, for tasks that encode no more."""
    for kept in getattr(sys.modules.get("_ledgerlint_encoders"), "by_path", {}).values():
        kept.forget()


def encode_column(column, path: str):
    """(ids, lengths) by slice of a text column: all ids as uint16 and the number of ids of each document."""
    known = encoder(path)
    for _, _, data, offsets in slices(column, ENCODED):
        folded, begin, stop, odd = pieces(data, offsets)
        if not len(begin):
            yield np.zeros(0, np.uint16), np.zeros(len(offsets) - 1, np.int64)
            continue
        first, which, keys = equal_spans(folded, begin, stop, odd)
        at, size = known.lookup(folded, begin[first], stop[first], odd[first], keys)
        length = size[which]
        ends = np.cumsum(length)
        ids = known.pool[np.repeat(at[which] - ends + length, length) + np.arange(ends[-1])]
        last = np.append(0, ends)[np.searchsorted(begin, offsets)]
        yield ids, np.diff(last)
