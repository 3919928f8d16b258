"""Byte-level BPE token ids of whole texts, for use inside tasks.

A byte-level BPE never merges across the pieces its pattern cuts a text into,
and every space that follows a non-space character starts a new piece. Texts are
therefore cut at such spaces, each distinct piece is encoded once by the
`tokenizers` library, and a text's ids are its pieces' ids in order — the same
ids as encoding the whole text, at a fraction of the work on repeated words.
The memo is bounded by ``memo_pieces`` and ``IDS_PER_PIECE`` times as many ids and is emptied
when it is full, so a task's memory does not grow with its rows.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: texts that a task encodes at once
TEXTS_AT_ONCE = 640
#: bounds of a worker's memo: distinct pieces (about 250 bytes each), and ids for each
MEMO_PIECES = 1_200_000
IDS_PER_PIECE = 10

_SPACE_AFTER_SPACE = re.compile(r"\s ")
# byte-level vocabularies write a byte that is not printable as the next free
# character from 256 on; all others stand for themselves
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_SPACE_CHAR = _BYTE_CHARS[32]
# (an apostrophe can open a contraction, which is a piece of its own)
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_LOADED: dict[tuple[str, int], PieceEncoder] = {}


class PieceEncoder:
    """Ids of many texts at once; ``path``: a `tokenizers` JSON file of a
    byte-level BPE whose pattern attaches one leading space to a word."""

    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.line = self._model(_BYTE_CHARS[10])
        self.tails: dict[str, list[int]] = {}
        self.memo_pieces = memo_pieces
        self.clear()

    def clear(self) -> None:
        # key: a word without its leading space; a text's first word, which has
        # none, is kept under " " + word (no later word can start with a space)
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0
        self.start = np.zeros(0, dtype=np.int32)  # the memo's bounds keep places below 2**31
        self.size = np.zeros(0, dtype=np.int32)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _model(self, chars: str) -> list[int]:
        return [t.id for t in self.model.tokenize(chars)]

    def _piece(self, piece: str) -> list[int]:
        """Ids of one of the pieces the pattern cuts texts into: straight to the BPE
        model."""
        if piece.isascii() and piece[0] != " ":
            return self._model(piece)
        return self._model(piece.encode().decode("latin-1").translate(_BYTE_CHARS))

    def _parts(self, word: str) -> list[int] | None:
        """Ids of " " + ``word`` if it is letters, and after them a run of ASCII
        punctuation if any, once or more often with single line feeds between:
        there the pattern's pieces are plain. None for other words."""
        out: list[int] = []
        for k, part in enumerate(word.split("\n")):
            letters = part.rstrip(_PUNCTUATION)
            if not letters.isalpha():
                return None
            if k:
                out += self.line
                out += self._piece(letters)
            else:
                known = self.index.get(letters) if len(letters) < len(word) else None
                if known is None:
                    out += self._model(_SPACE_CHAR + letters) if letters.isascii() else self._piece(" " + letters)
                else:
                    at = self.start[known]
                    out += self.flat[at : at + self.size[known]].tolist()
            if len(letters) < len(part):
                tail = part[len(letters) :]
                if tail not in self.tails:
                    if len(self.tails) > 4096:
                        self.tails.clear()
                    self.tails[tail] = self._piece(tail)
                out += self.tails[tail]
        return out

    def _ids(self, new: list[str]) -> list[list[int]]:
        coded = [self._parts(w) for w in new]
        rest = [k for k, ids in enumerate(coded) if ids is None]
        for k, ids in zip(rest, self._whole([new[k][1:] if new[k][:1] == " " else " " + new[k] for k in rest]), strict=True):
            coded[k] = ids
        return coded

    def _learn(self, new: list[str]) -> None:
        coded = self._ids(new)
        size = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        flat = np.fromiter(chain.from_iterable(coded), dtype=np.uint32, count=int(size.sum()))
        if self.used + len(flat) > len(self.flat):
            grown = np.zeros(max(2 * len(self.flat), self.used + len(flat)), dtype=np.uint32)
            grown[: self.used] = self.flat[: self.used]
            self.flat = grown
        self.flat[self.used : self.used + len(flat)] = flat
        base = len(self.size)
        self.index.update(zip(new, range(base, base + len(new)), strict=True))
        self.start = np.concatenate([self.start, (self.used + np.cumsum(size) - size).astype(np.int32)])
        self.size = np.concatenate([self.size, size.astype(np.int32)])
        self.used += len(flat)

    def _places(self, pieces: list[str]) -> np.ndarray:
        """Where each piece's ids are; what is new is learnt first."""
        at = np.fromiter(map(self.index.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            self._learn(list(dict.fromkeys(pieces[k] for k in new)))
            at[new] = [self.index[pieces[k]] for k in new]
        return at

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """One ``uint32`` array of ids per text. All words of the call are coded
        to distinct ones first, so that each is looked up once."""
        if len(self.size) > self.memo_pieces or self.used > IDS_PER_PIECE * self.memo_pieces:
            self.clear()
        out: list[np.ndarray] = [None] * len(texts)
        plain = []
        for k, t in enumerate(texts):
            if _SPACE_AFTER_SPACE.search(t):  # runs of white space: encoded whole
                out[k] = np.array(self._whole([t])[0], dtype=np.uint32)
            else:
                plain.append(k)
        if not plain:
            return out
        cut = pc.split_pattern(pa.array([texts[k] for k in plain], pa.large_string()), " ")
        offsets = cut.offsets.to_numpy()
        words = cut.flatten().dictionary_encode()
        which = words.indices.to_numpy()
        first = offsets[:-1]
        later = np.ones(len(which), dtype=bool)
        later[first] = False
        used = np.flatnonzero(np.bincount(which[later], minlength=len(words.dictionary)))
        pieces = words.dictionary.take(pa.array(used)).to_pylist()
        starts = [" " + w for w in words.dictionary.take(words.indices.take(pa.array(first))).to_pylist()]
        found = self._places(pieces + starts)
        place = np.zeros(len(words.dictionary), dtype=np.int32)
        place[used] = found[: len(used)]
        at = place[which]
        at[first] = found[len(used) :]
        del cut, words, which, later
        size = self.size[at]
        ends = np.cumsum(size, dtype=np.int64)
        take = np.repeat((self.start[at] - (ends - size)), size)
        take += np.arange(len(take))
        ids = self.flat[take]
        last = ends[offsets[1:] - 1]
        for k, lo, hi in zip(plain, np.concatenate([[0], last[:-1]]).tolist(), last.tolist(), strict=True):
            out[k] = ids[lo:hi]
        return out


def encoder(path: str, memo_pieces: int = MEMO_PIECES) -> PieceEncoder:
    """One encoder per worker process, tokenizer file and bound of its memo."""
    key = (path, memo_pieces)
    if key not in _LOADED:
        _LOADED[key] = PieceEncoder(path, memo_pieces)
    return _LOADED[key]


def release() -> None:
    """Drops this worker's encoders: workers are used again by other operators,
    which should not share their memory with a memo."""
    if _LOADED:
        _LOADED.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def crc32_u32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes()) & 0xFFFFFFFF
