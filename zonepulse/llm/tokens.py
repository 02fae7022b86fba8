"""Whole texts to token ids with a public tokenizer, inside a Spark task."""

from __future__ import annotations

import gc
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer, models

#: White space before a space or line feed: the text is then cut by the careful rule below.
_ODD = re.compile(r"\s[ \n]")
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
#: The first step of the two kinds of public tokenizers; fixed values.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PIECES = {
    False: regex.compile(PATTERN),
    True: regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"),
}
#: Up to here Unicode's letter classes are the same in all libraries; chunks beyond go through the whole tokenizer.
_LATIN = "ɏ"
#: Marks that, behind a word, are a piece of their own in both kinds of tokenizers.
_MARKS = ".,;:!?"
#: White space beyond ASCII, as the last three bytes before a place; those of two bytes without the first.
_WIDE = np.array([int.from_bytes(c.encode(), "big") for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))])
_BEFORE, _BREAK, _MARK = np.zeros(256, np.uint8), 1, 2  # what a byte is at a place where a chunk may begin
_BEFORE[[10, 32]], _BEFORE[list(_MARKS.encode())] = _BREAK, _MARK
_SPACES, _LETTERS = np.zeros(256, bool), np.zeros(256, bool)
_SPACES[[*range(9, 14), *range(28, 33)]] = True
_LETTERS[[*range(65, 91), *range(97, 123)]] = True
#: Bytes of text that are cut at once, about.
_AT_ONCE = 8 << 20
#: Byte-level vocabularies write a byte as a visible character: itself, or the next one from 256 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


def byte_values() -> dict[str, int]:
    """The byte that each visible character of a byte-level vocabulary stands for."""
    return {**{chr(b): b for b in _VISIBLE}, **{c: b for b, c in _BYTES.items()}}


def vocabulary(name: str) -> str:
    """Default path of a public vocabulary file; every operator takes the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Memory(dict):
    """A table that keeps what was met lately: when it is full, it becomes the older one and a new one begins.

    ``get`` looks in the new one; what ``older`` finds in the other should be kept again. At most twice
    ``limit`` entries are held, and keys over 64 characters are not held at all.
    """

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.before = limit, {}

    def older(self, key: str):
        return self.before.get(key)

    def keep(self, key: str, value):
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        if len(key) <= 64:
            self[key] = value
        return value


def chunk_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where chunks begin in the bytes of texts that begin at ``starts``, and the end of the bytes.

    That is before a space or line feed that follows a character other than white space, as ``_CUT`` says, and before
    a mark that follows a letter of ASCII or Latin-1: all letters are one piece there and the mark is in the next.
    """
    kind = _BEFORE[data]
    at = np.flatnonzero(kind)
    kind, last = kind[at], data[at - 1]
    cut = np.where(kind == _BREAK, ~_SPACES[last], _LETTERS[last])
    wide = np.flatnonzero((last >= 128) & (at > 2))
    three = sum(data[at[wide] - k].astype(np.int64) << 8 * (k - 1) for k in (1, 2, 3))
    two = three & 0xFFFF
    blank = np.isin(three, _WIDE) | np.isin(two, _WIDE)
    letter = (two >> 8 == 0xC3) & (two != 0xC397) & (two != 0xC3B7)  # but for the signs of times and divided by
    cut[wide] = np.where(kind[wide] == _BREAK, ~blank, letter)
    flags = np.zeros(len(data) + 1, bool)
    flags[at] = cut
    flags[starts] = True
    flags[-1] = True
    return np.flatnonzero(flags)


class ChunkEncoder:
    """Encodes texts chunk by chunk and remembers the ids of chunks and pieces it has met.

    A text is cut before every space or line feed that follows a character other than white space. No
    token of the public vocabularies used here reaches over such a place: their first step ends a piece
    before white space, or drops it. So the ids of the chunks, one after the other, are those of the
    whole text. Subclasses say which pieces a chunk has and which ids a piece has.
    """

    def __init__(self, limit: int = 400_000):
        self.chunks, self.pieces = Memory(limit), Memory(limit)
        gc.set_threshold(100_000, 20, 100)  # the tables hold many small objects and no cycles

    def split(self, chunk: str) -> list[str]:
        raise NotImplementedError

    def ids(self, piece: str) -> Iterable[int]:
        raise NotImplementedError

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.before.get(piece)
        return self.pieces.keep(piece, array("I", self.ids(piece)).tobytes() if ids is None else ids)

    def _chunk(self, chunk: str) -> bytes:
        ids = self.chunks.before.get(chunk)
        if ids is None:
            get, pieces = self.pieces.get, self.split(chunk)
            ids = (get(pieces[0]) or self._piece(pieces[0])) if len(pieces) == 1 else b"".join([get(p) or self._piece(p) for p in pieces])
        return self.chunks.keep(chunk, ids)

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers; a null or empty text has none."""
        if not text:
            return b""
        if "\0" in text or _ODD.search(text):
            chunks = _CUT.split(text)
        else:
            chunks = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
        get, learn = self.chunks.get, self._chunk
        return b"".join([ids if (ids := get(c)) is not None else learn(c) for c in chunks])

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """What ``encode`` gives for every text, in order.

        The texts of some megabytes are cut at once, and each of their different chunks is looked up once.
        """
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        whole = self._apart(texts)
        _, ends, data = texts.buffers()
        ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data, at = np.frombuffer(data or b"", np.uint8), 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + _AT_ONCE, "right")) - 1)
            of = range(at, to)
            found = self._together(data[ends[at] : ends[to]], ends[at : to + 1] - ends[at])
            yield from (self.encode(texts[i].as_py()) if i in whole else ids for i, ids in zip(of, found, strict=True)) if whole else found
            at = to

    def _together(self, data: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The ids of the texts between ``ends``."""
        if not len(data):
            return [b""] * (len(ends) - 1)
        cuts = chunk_starts(data, ends)
        chunks = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        table = self._table(chunks.dictionary)
        made = table.take(chunks.indices)
        places = np.frombuffer(made.buffers()[1], np.int64)[np.searchsorted(cuts, ends)].tolist()
        ids = memoryview(made.buffers()[2] or b"")
        return [bytes(ids[i:j]) for i, j in zip(places, places[1:])]

    def _apart(self, texts: pa.Array) -> set[int]:
        """The places of texts that ``encode`` does not take chunk by chunk."""
        return set()

    def _table(self, chunks: pa.Array) -> pa.Array:
        """The ids of each chunk."""
        return pa.array(self._looked_up(chunks), pa.large_binary())

    def _looked_up(self, chunks: pa.Array) -> list[bytes]:
        """The ids of different chunks."""
        get, learn = self.chunks.get, self._chunk
        return [ids if (ids := get(c)) is not None else learn(c) for c in chunks.to_numpy(zero_copy_only=False).tolist()]  # faster than to_pylist


class LibraryEncoder(ChunkEncoder):
    """By a file of the tokenizers library; the merges are the library's own.

    Strings of special tokens become their ids, as the library does by default, or with ``plain`` are ordinary
    text. Texts with such a string go through the whole library, and so do chunks with letters beyond the Latin ones, so
    that its own tables of letters decide.
    """

    def __init__(self, path: str, plain: bool = False):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # what all of them begin with, up to the first letter, is looked for first: that is fast
        self.sign = re.match(r"[\W\d_]*", commonprefix(added)).group() if added else None
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE).search
        self.normalize = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else None
        if not isinstance(self.tokenizer.model, models.BPE):
            raise ValueError(f"{path} is not a byte-pair vocabulary")
        self.find = _PIECES[self.normalize is not None].findall
        self.merge = self.tokenizer.model.tokenize

    def encode(self, text: str | None) -> bytes:
        if text and self.sign is not None and self.sign in text and self.added(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return super().encode(text)

    def _apart(self, texts: pa.Array) -> set[int]:
        if self.sign is None:
            return set()
        return {i for i in np.flatnonzero(pc.match_substring(texts, self.sign).to_numpy(zero_copy_only=False)).tolist() if self.added(texts[i].as_py())}

    def _table(self, chunks: pa.Array) -> pa.Array:
        if self.normalize is not None:  # white space is dropped and ASCII letters become small, so many chunks are alike
            plain = pc.if_else(pc.string_is_ascii(chunks), pc.ascii_lower(pc.ascii_ltrim(chunks, characters=" \n")), chunks).dictionary_encode()
            return super()._table(plain.dictionary).take(plain.indices)
        return super()._table(chunks)

    def _looked_up(self, chunks: pa.Array) -> list[bytes]:
        """The ids of different chunks; words of ASCII letters that are new go straight to the merges."""
        get, keep, learn, merge = self.chunks.get, self.chunks.keep, self._chunk, self.merge
        out = []
        for chunk in chunks.to_numpy(zero_copy_only=False).tolist():  # faster than to_pylist
            if (ids := get(chunk)) is None:
                word = chunk[1:] if chunk[:1] == " " else chunk
                if word.isascii() and word.isalpha() and (ids := self.chunks.before.get(chunk)) is None and (self.normalize is None or word.islower()):
                    ids = array("I", [t.id for t in merge(word if word is chunk or self.normalize is not None else _BYTES[32] + word)]).tobytes()
                ids = learn(chunk) if ids is None else keep(chunk, ids)
            out.append(ids)
        return out

    def split(self, chunk: str) -> list[str]:
        if self.normalize is not None:
            chunk = chunk.lower() if chunk.isascii() else self.normalize(chunk)
        return self.find(chunk)

    def ids(self, piece: str) -> Iterable[int]:
        plain = piece.isascii() and piece.isprintable()
        text = piece.replace(" ", _BYTES[32]) if plain else piece.encode().decode("latin-1").translate(_BYTES)
        return [t.id for t in self.merge(text)]

    def _alone(self, piece: str) -> bytes:
        """A piece that is a chunk by itself shares its table."""
        ids = self.chunks.get(piece) or self.chunks.before.get(piece)
        return ids or self.chunks.keep(piece, array("I", self.ids(piece)).tobytes())

    def _chunk(self, chunk: str) -> bytes:
        if (ids := self.chunks.before.get(chunk)) is not None:
            return self.chunks.keep(chunk, ids)
        head = chunk.rstrip(_MARKS)
        word = head[1:] if head[:1] == " " else head
        if word.isascii() or max(word) <= _LATIN:
            if self.normalize is not None:  # these letters are composed already, so only their case changes
                head = word = word.lower()
            if word.isalpha():  # most chunks are a word and marks behind it, which needs no pattern
                ids, marks = self._alone(head), chunk[len(chunk.rstrip(_MARKS)) :]
                if marks:
                    return self.chunks.keep(chunk, ids + self._alone(marks))
                return ids if chunk == head else self.chunks.keep(chunk, ids)
            if chunk.isascii() or max(chunk) <= _LATIN:
                return super()._chunk(chunk)
        return self.chunks.keep(chunk, array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes())


@lru_cache(2)
def library_encoder(path: str, plain: bool = False) -> LibraryEncoder:
    """One per worker process: the next task goes on with the tables that the last one has filled."""
    return LibraryEncoder(path, plain)
