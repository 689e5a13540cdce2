"""Fast, exact token ids of a word-level BPE tokenizer file.

The library's tokenizer spends most of its time on normalisation and
pre-tokenization, and texts repeat their words.  So a worker remembers the
ids of each chunk between ASCII white space (ids never depend on text beyond
it) and computes a new chunk from its remembered pieces.  Chunks with
characters beyond Latin-1 letters go through the library as they are.
"""
from __future__ import annotations

import json
import sys
import types
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: A worker starts anew when it remembers twice as many chunks and pieces (some 150 MB).
REMEMBERED = 400_000
_PLAIN = regex.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def per_process(key, make):
    """``make()``'s value, kept for later tasks of the same Python worker.  (A
    module that is pickled by value is made anew for every task.)"""
    held = sys.modules.setdefault("_runoff_llm_held", types.ModuleType("_runoff_llm_held")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def _byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others for the characters from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {**{b: chr(b) for b in kept}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class _Remembered(dict):
    """Ids by chunk or piece; what is missing is made."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        made = self[key] = self.make(key)
        return made


class WordEncoder:
    """Encodes texts (UTF-8) as little-endian uint32 ids, as the tokenizer of
    the JSON ``spec`` does with add_special_tokens=False and its special
    tokens' strings taken as ordinary text."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(spec)
        self.whole.encode_special_tokens = True
        self.split = self._pattern(json.loads(spec))
        self.model = self.whole.model
        self.chars = _byte_chars()
        self.chunks = _Remembered(self._chunk)
        self.pieces = _Remembered(self._piece)

    @staticmethod
    def _pattern(parsed):
        """The split pattern if the file has the form that the fast way
        covers: NFC, white space to a space, lower case; split, byte level."""
        norm = [n["type"] for n in (parsed["normalizer"] or {}).get("normalizers", [])]
        pre = (parsed["pre_tokenizer"] or {}).get("pretokenizers", [])
        if norm == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in pre] == ["Split", "ByteLevel"]:
            if not pre[1]["add_prefix_space"] and not pre[1]["use_regex"]:
                return regex.compile(pre[0]["pattern"]["Regex"])
        return None

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _piece(self, piece: str) -> bytes:
        mapped = piece.encode().decode("latin-1").translate(self.chars)
        return self._packed([t.id for t in self.model.tokenize(mapped)])

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if not _PLAIN.fullmatch(text):
            return self._packed(self.whole.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.pieces.__getitem__, self.split.findall(text.lower())))

    def encode(self, text: bytes) -> bytes:
        if self.split is None:
            return self._packed(self.whole.encode(text.decode(), add_special_tokens=False).ids)
        if len(self.chunks) + len(self.pieces) > 2 * REMEMBERED:
            self.chunks.clear()
            self.pieces.clear()
        return b"".join(map(self.chunks.__getitem__, text.split()))


def word_encoder(spec: str) -> WordEncoder:
    return per_process(("word", zlib.crc32(spec.encode())), lambda: WordEncoder(spec))


#: Bytes of text encoded at a time, and what a worker remembers at most: pieces, and bytes of pieces and ids.
SEGMENT = 4 << 20
PIECES, PIECE_BYTES = 300_000, 16 << 20
_SPACE, _LETTER, _DIGIT, _MARK, _ODD = range(5)
_QUOTE = 39


def _byte_classes() -> np.ndarray:
    out = np.full(256, _ODD, np.uint8)
    out[33:127] = _MARK
    out[[32, *range(9, 14)]] = _SPACE
    out[48:58] = _DIGIT
    out[65:91] = out[97:123] = _LETTER
    return out


_CLASS = _byte_classes()
_ACCENT = np.zeros(256, bool)  # second bytes of the letters from À to ÿ
_ACCENT[128:192] = True
_ACCENT[[0x97, 0xB7]] = False


class ColumnEncoder(WordEncoder):
    """As WordEncoder, a text column at a time: a segment of rows is cut into
    pieces by byte class, its *distinct* pieces are looked up or tokenised
    once, and all ids are taken by index.

    Chunks between white space that hold an apostrophe or a character beyond
    Latin-1 letters are one piece each and take the slow way.  What is
    remembered is bounded in pieces and in bytes; beyond that only the pieces
    of the present segment, the frequent ones among them, are kept.
    """

    def __init__(self, spec: str):
        super().__init__(spec)
        self._keep(pa.array([], pa.binary()), np.zeros(1, np.int64), np.zeros(0, np.uint32))

    def _keep(self, pieces: pa.BinaryArray, start: np.ndarray, ids: np.ndarray) -> None:
        self.known, self.start, self.ids = pieces, start, ids

    def rows(self, column: pa.Array):
        """Yields (row, ids as uint32 array) for every row; null: no ids."""
        if self.split is None:
            for r, text in enumerate(column.to_pylist()):
                ids = self.whole.encode(text, add_special_tokens=False).ids if text else []
                yield r, np.array(ids, np.uint32)
            return
        column = column.cast(pa.large_string()).fill_null("")
        _, offsets, data = column.buffers()
        off = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset)
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        i = 0
        while i < len(column):
            j = max(i + 1, int(np.searchsorted(off, off[i] + SEGMENT, "right")) - 1)
            if off[j] - off[i] <= SEGMENT:
                ids, cut = self._segment(raw[off[i]:off[j]], off[i:j + 1] - off[i])
                for r in range(j - i):
                    yield i + r, ids[cut[r]:cut[r + 1]]
            else:
                yield i, np.concatenate([self._segment(part, np.array([0, len(part)]))[0]
                                         for part in self._parts(raw[off[i]:off[j]])])
            i = j

    @staticmethod
    def _parts(text: np.ndarray):
        """A long text in parts of some ``SEGMENT`` bytes, cut at white space."""
        at = 0
        while at < len(text):
            to = min(at + SEGMENT, len(text))
            while to < len(text):
                found = np.flatnonzero(_CLASS[text[to:to + SEGMENT]] == _SPACE)
                if len(found):
                    to += int(found[0])
                    break
                to = min(to + SEGMENT, len(text))
            yield text[at:to]
            at = to

    def _segment(self, b: np.ndarray, cuts: np.ndarray):
        """(ids, offsets of ids at ``cuts``) of the rows in bytes ``b``."""
        if not len(b):
            return np.zeros(0, np.uint32), np.zeros(len(cuts), np.int64)
        kind = _CLASS[b]
        lead = np.flatnonzero(b[:-1] == 0xC3)
        lead = lead[_ACCENT[b[lead + 1]]]
        kind[lead] = kind[lead + 1] = _LETTER
        word = kind != _SPACE
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        inner = cuts[(cuts > 0) & (cuts < len(b))]
        begins[inner] = word[inner]
        other = np.ones(len(b), bool)
        other[1:] = kind[1:] != kind[:-1]
        other |= kind == _DIGIT
        text = b.copy()
        upper = (b >= 65) & (b <= 90)
        accents = lead[b[lead + 1] < 0x9F] + 1
        odd = np.flatnonzero((kind == _ODD) | (b == _QUOTE))
        if len(odd):
            chunk = np.cumsum(begins, dtype=np.int32)
            strange = np.zeros(int(chunk[-1]) + 1, bool)
            strange[chunk[odd]] = True
            plain = ~strange[chunk]
            other &= plain
            upper &= plain
            accents = accents[plain[accents]]
        text[upper] += 32
        text[accents] += 32
        begins |= other & word
        at = np.flatnonzero(begins)
        packed = text[word]
        ends = np.empty(len(at) + 1, np.int32)
        ends[:-1] = np.flatnonzero(begins[word])
        ends[-1] = len(packed)
        pieces = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(packed)])
        coded = pieces.dictionary_encode()
        code = self._codes(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        n = self.start[code + 1] - self.start[code]
        total = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=total[1:])
        take = np.repeat(self.start[code] - total[:-1], n)
        take += np.arange(len(take))
        return self.ids[take], total[np.searchsorted(at, cuts)]

    def _codes(self, distinct: pa.BinaryArray) -> np.ndarray:
        """Numbers of ``distinct`` pieces among the known; makes the missing."""
        if len(self.known) > PIECES or self.known.nbytes + self.ids.nbytes > PIECE_BYTES:
            kept = pc.index_in(self.known, value_set=distinct).is_valid().to_numpy(zero_copy_only=False)
            kept = np.flatnonzero(kept)
            n = self.start[kept + 1] - self.start[kept]
            start = np.r_[0, np.cumsum(n)]
            take = np.repeat(self.start[kept] - start[:-1], n) + np.arange(start[-1])
            self._keep(self.known.take(pa.array(kept)), start, self.ids[take])
        code = pc.index_in(distinct, value_set=self.known)
        missing = code.is_null()
        out = code.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        new = distinct.filter(missing)
        if len(new):
            out[missing.to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(new))
            made = [self._made(p) for p in new.to_pylist()]
            start = np.r_[self.start, self.start[-1] + np.cumsum([len(m) for m in made])]
            flat = np.fromiter(chain.from_iterable(made), np.uint32, int(start[-1] - self.start[-1]))
            self._keep(pa.concat_arrays([self.known, new]), start, np.concatenate([self.ids, flat]))
        return out

    def _made(self, piece: bytes) -> list[int]:
        text = piece.decode()
        if _QUOTE in piece or not _PLAIN.fullmatch(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        return [t.id for t in self.model.tokenize(piece.decode("latin-1").translate(self.chars))]


def column_encoder(spec: str) -> ColumnEncoder:
    return per_process(("column", zlib.crc32(spec.encode())), lambda: ColumnEncoder(spec))
