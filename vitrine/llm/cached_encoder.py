"""Whole-text encoding with a public tokenizer, each distinct chunk of a worker encoded once."""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters on which white space, letters and lower-casing need no context, so that a text cut
#: at white space gives the same ids chunk by chunk. Any other text goes to the tokenizer whole.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-¬®-įı-ɏ‐-‧€]*\Z")
#: A byte-level vocabulary keeps white space: a word takes the one blank before it.
_BYTE_CHUNK = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: White space beside white space, and white space other than blanks and line feeds, of plain texts.
_RUNS = ("  ", " \n", "\n ", "\n\n", "\t", "\r")
_LATIN = [chr(c) for c in range(0x250)]
_L = "".join(c for c in _LATIN if unicodedata.category(c)[0] == "L")
_N = "".join(c for c in _LATIN if unicodedata.category(c)[0] == "N")
#: The two vocabularies' own cuts, with letters and numbers spelled out for plain texts.
_WORD_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+")
_BYTE_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
#: Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_BLANK = chr(_BYTE_LETTERS[0x20])
#: The letters of plain texts as such vocabularies write their bytes.
_LETTERS = {c: c.encode().decode("latin-1").translate(_BYTE_LETTERS) for c in _L}
#: Signs that often end a word, each a piece by itself there.
_STOPS = tuple(",.;:!?")
#: Distinct chunks that one worker remembers by default; later ones are encoded anew each time.
CACHE_ENTRIES = 1_000_000


def _shown(word: str) -> str:
    """A word of letters and the blank before it."""
    return _BLANK + (word if word.isascii() else "".join(map(_LETTERS.__getitem__, word)))


class CachedEncoder:
    """Ids of whole texts as little-endian unsigned 16-bit bytes (vocabularies below 65,536).

    ``drops_space`` says that the vocabulary drops white space and lower-cases (word-end BPE);
    otherwise it keeps white space (byte-level BPE). A text that may hold an added token of the
    vocabulary (in any case, where it lower-cases) goes to the tokenizer whole.
    """

    def __init__(self, path: str, drops_space: bool, remember: int = CACHE_ENTRIES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = [t.lower() for t in added] if drops_space else added
        self.drops_space, self.remember = drops_space, remember
        self.pieces = (_WORD_PIECE if drops_space else _BYTE_PIECE).findall
        self.cache: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def _learn(self, chunk: str) -> bytes:
        ids: list[int] = []
        for piece in self.pieces(chunk):
            if piece.isascii() and piece.isprintable():
                mapped = piece.replace(" ", _BLANK)
            else:
                mapped = piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
            ids += [t.id for t in self.tokenizer.model.tokenize(mapped)]
        return array("H", ids).tobytes()

    def _one(self, piece: str) -> bytes:
        """Ids of one piece of the vocabulary's own cut, blanks as the vocabulary writes them."""
        return array("H", [t.id for t in self.tokenizer.model.tokenize(piece)]).tobytes()

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of words as ``_by_words`` marks them."""
        found = list(map(self.words.get, words))
        fresh: dict[str, bytes] = {}
        for i, ids in enumerate(found):
            if ids is not None:
                continue
            word = words[i]
            if word.isalpha():
                ids = self._one(_shown(word))
            elif word[-1:] in _STOPS and word[:-1].isalpha():  # letters are one piece, and so is what follows them
                before = word[:-1]
                start = self.words.get(before) or fresh.get(before)
                if start is None:
                    start = fresh[before] = self._one(_shown(before))
                ids = start + self._one(word[-1])
            else:
                ids = self._learn(word[1:] if word[:1] == "\0" else word if word[:1] == "\n" else " " + word)
            found[i] = fresh[word] = ids
        room = self.remember - len(self.cache) - len(self.words)
        self.words.update(fresh if len(fresh) <= room else islice(fresh.items(), max(room, 0)))
        return found

    def _by_words(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts without two white spaces in a row, by a vocabulary that keeps white space.

        A word takes the blank or line feed before it (the first of a text takes none), and Arrow numbers the words, so that each
        distinct one of ``texts`` is looked up once."""
        marked = pa.array(["\0" + t.replace("\n", " \n") for t in texts], pa.large_string())
        words = pc.split_pattern(marked, " ")
        coded = words.values.dictionary_encode()
        ids = pa.array(self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[words.offsets.to_numpy()]
        body = memoryview(ids.buffers()[2] or b"")
        return [bytes(body[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        if self.drops_space:
            return self._by_chunks(texts)
        easy = [bool(_PLAIN.match(t)) and not any(r in t for r in (*_RUNS, *self.added)) for t in texts]
        one = iter(self._by_words([t for t, e in zip(texts, easy, strict=True) if e]) if any(easy) else ())
        rest = iter(self._by_chunks([t for t, e in zip(texts, easy, strict=True) if not e]))
        return [next(one if e else rest) for e in easy]

    def _by_chunks(self, texts: list[str]) -> list[bytes]:
        cut = str.split if self.drops_space else _BYTE_CHUNK.findall
        pieces: list[list[str] | None] = []
        missing: set[str] = set()
        for text in texts:
            cased = text.lower() if self.drops_space else text
            if _PLAIN.match(text) and not any(t in cased for t in self.added):
                chunks = cut(cased)
                missing.update(set(chunks).difference(self.cache))
                pieces.append(chunks)
            else:
                pieces.append(None)
        known: dict[str, bytes] = self.cache
        if missing:
            fresh: dict[str, bytes] = {}
            for chunk in missing:
                fresh[chunk] = self._learn(chunk)
            if len(self.cache) + len(fresh) <= self.remember:
                self.cache.update(fresh)
            else:
                known = _Both(self.cache, fresh)
        get = known.__getitem__
        return [
            self._whole(text) if chunks is None else b"".join(map(get, chunks))
            for text, chunks in zip(texts, pieces, strict=True)
        ]


class _Both(dict):
    """The fresh chunks of one batch in front of the cache, when the cache is full."""

    def __init__(self, cache: dict[str, bytes], fresh: dict[str, bytes]) -> None:
        super().__init__(fresh)
        self.rest = cache

    def __missing__(self, key: str) -> bytes:
        return self.rest[key]


_ENCODERS: dict[tuple[str, bool, int], CachedEncoder] = {}


def encoder(path: str, drops_space: bool, remember: int = CACHE_ENTRIES) -> CachedEncoder:
    """The encoder of this Python worker for ``path``; it lives as long as the worker does."""
    key = (path, drops_space, remember)
    if key not in _ENCODERS:
        _ENCODERS[key] = CachedEncoder(*key)
    return _ENCODERS[key]


def forget_encoders() -> None:
    """Give up this worker's encoders, whose memory other stages need."""
    _ENCODERS.clear()
