"""Encode whole texts with the tokenizers library, each distinct word only once per worker.

Both vocabularies treat a text's white-space-delimited chunks one by one: no token of theirs spans the
boundary between a character that is not white space and a following blank. So a batch is cut into chunks
with Arrow. A chunk of Latin letters with punctuation behind them is two pieces of its own, which the library's
model encodes by themselves; other chunks are encoded in full. Distinct pieces are encoded once, many in one
call, and remembered; the ids of the texts are gathered from them. Texts with uncommon white space or control
characters are encoded as they are. Texts of any length are encoded whole: a batch holds one very long text at least.

A worker remembers two generations of pieces: when the young one is full it becomes the old one, and pieces that
are met again move back to the young one.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"

#: Pieces of a generation that a worker remembers.
MEMO = 500_000
#: Pieces that are encoded in one call.
_CALL = 20_000
#: Marks a text's first chunk; texts that hold control characters are encoded directly.
_FIRST = "\x02"
#: In a piece: the blank before a word. Between pieces: the end of one.
_BLANK, _END = "\x00", "\x01"
#: Letters below U+0300 have no other normal form; the apostrophe has patterns of its own.
_PLAIN = r"(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<points>[!-&(-/:-@\[-`{-~]*)$"
_ODD = r"[\x00-\x08\x0e-\x1f]"
_ODD_SPACE = (
    r"[ \n][ \n]|^[ \n]|[ \n]\z|[\x00-\x09\x0b-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


#: The fixed byte-level alphabet: printable bytes stand for themselves, the others for U+0100 onwards, in order.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}
_LETTERS = np.array([_BYTE_CHARS.get(b, b) for b in range(256)], "<u2")
_LETTERS[0], _LETTERS[32] = _BYTE_CHARS[32], 32  # a piece's blank is a letter, a blank parts the pieces


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Pieces:
    """Ids of remembered pieces by their number; number 0 is the empty piece."""

    def __init__(self):
        self.number: dict[str, int] = {"": 0}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int32)
        self.used = 0

    def add(self, keys: list[str], ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        n = len(self.number)
        while n + len(keys) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        new = np.arange(n, n + len(keys))
        self.ids[self.used : self.used + len(ids)] = ids
        self.lengths[new] = lengths
        self.starts[new] = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)
        self.number.update(zip(keys, new.tolist(), strict=True))
        return new

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces in a row, and each one's length."""
        lengths = self.lengths[numbers].astype(np.int64)
        ends = np.cumsum(lengths)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[numbers] - (ends - lengths), lengths)
        return self.ids[at], lengths


class Encoder:
    """encode(texts) gives (ids, offsets): all ids of the texts in a row and where each text's ids begin."""

    def __init__(self, path: str, memo: int = MEMO):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        (self.end,) = self.model.encode(chr(_LETTERS[ord(_END)]), add_special_tokens=False).ids
        self.words = "word_bpe" in os.path.basename(path)
        self.size = memo
        self.young, self.old = _Pieces(), _Pieces()

    def _direct(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_model(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, lengths = [], []
        for i in range(0, len(pieces), _CALL):
            raw = "".join([f"{p} {_END} " for p in pieces[i : i + _CALL]]).encode()
            text = _LETTERS[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-16-le")
            found = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(found == self.end)
            lengths.append(np.diff(ends, prepend=-1) - 1)
            ids.append(np.delete(found, ends))
        return np.concatenate(ids), np.concatenate(lengths)

    def _in_full(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        texts = chunks if self.words else [c[1:] if c[0] == _FIRST else c if c[0] == "\n" else " " + c for c in chunks]
        ids = self._direct(texts)
        return np.concatenate(ids), np.array([len(x) for x in ids])

    def _numbers(self, pieces: pa.Array, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The young generation's numbers of the pieces; new ones are learnt."""
        coded = pieces.dictionary_encode()
        keys, known = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.young.number
        numbers = np.fromiter(map(known.get, keys, repeat(-1)), np.int64, len(keys))
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            lost = [keys[i] for i in missing.tolist()]
            before = np.fromiter(map(self.old.number.get, lost, repeat(-1)), np.int64, len(lost))
            for some, found in ((before >= 0, None), (before < 0, learn)):
                if some.any():
                    names = [k for k, s in zip(lost, some.tolist(), strict=True) if s]
                    numbers[missing[some]] = self.young.add(names, *(found(names) if found else self.old.gather(before[some])))
        return numbers[coded.indices.to_numpy()]

    def _chunk_pieces(self, chunks: pa.Array) -> list[np.ndarray]:
        """The numbers of every chunk's pieces, in order."""
        none, text = "", lambda x: pa.scalar(x, pa.large_string())
        parts = pc.extract_regex(chunks, "^" + ("" if self.words else f"(?P<lead>[{_FIRST}\\n]?)") + _PLAIN)
        whole = pc.is_null(parts)
        letters, points = (pc.fill_null(pc.struct_field(parts, name), none).cast(pa.large_string()) for name in ("letters", "points"))
        out = []
        if self.words:
            stems = pc.utf8_lower(letters)
        else:
            lead = pc.fill_null(pc.struct_field(parts, "lead"), none)
            line = pc.equal(lead, "\n")
            if pc.any(line).as_py():
                out.append(self._numbers(pc.if_else(line, text("\n"), text(none)), self._by_model))
            bare, empty = pc.and_(pc.equal(lead, none), pc.invert(whole)), pc.equal(letters, none)
            blank = lambda where, x: pc.binary_join_element_wise(pc.if_else(where, text(_BLANK), text(none)), x, text(none))
            stems, points = blank(pc.and_not(bare, empty), letters), blank(pc.and_(bare, empty), points)
        out += [self._numbers(stems, self._by_model), self._numbers(points, self._by_model)]
        if pc.any(whole).as_py():
            where = whole.to_numpy(zero_copy_only=False)
            out[-1][where] = self._numbers(chunks.filter(whole), self._in_full)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        odd = pc.match_substring_regex(texts, _ODD if self.words else _ODD_SPACE)
        any_odd = pc.any(odd).as_py()
        usual = pc.if_else(odd, pa.scalar("", pa.large_string()), texts) if any_odd else texts
        if self.words:
            lists = pc.ascii_split_whitespace(usual)
        else:
            marked = pc.binary_join_element_wise(pa.scalar(_FIRST, pa.large_string()), pc.replace_substring(usual, "\n", " \n"), pa.scalar("", pa.large_string()))
            lists = pc.split_pattern(marked, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        if len(self.young.number) > self.size:
            self.young, self.old = _Pieces(), self.young
        pieces = self._chunk_pieces(coded.dictionary)
        own, lengths = self.young.gather(np.column_stack(pieces).ravel())
        ends = np.cumsum(lengths.reshape(-1, len(pieces)).sum(axis=1))
        taken = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(own)).take(coded.indices)
        ids, starts = taken.flatten().to_numpy(), taken.offsets.to_numpy()[offsets - offsets[0]].astype(np.int64)
        if not any_odd:
            return ids, starts
        where = odd.to_numpy(zero_copy_only=False)
        whole = dict(zip(np.flatnonzero(where).tolist(), self._direct(texts.filter(odd).to_pylist()), strict=True))
        parts = [whole.get(i, ids[starts[i] : starts[i + 1]]) for i in range(n)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file; a bare name is one of the public vocabularies."""
    if path not in _encoders:
        _encoders[path] = Encoder(path if re.search(r"[/\\]", path) else vocabulary_path(path))
    return _encoders[path]


def with_end(ids: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Put the end id behind every text's ids."""
    return np.insert(ids, starts[1:], end), starts + np.arange(len(starts))
