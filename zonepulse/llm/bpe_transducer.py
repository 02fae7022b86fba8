"""Byte-level BPE as a finite-state transducer that is made deterministic step by step.

The merges say which two tokens may stand next to each other: exactly those whose joint bytes the merges
turn back into the two. A text's encoding is the one token sequence whose neighbours all may. So the
last token of every prefix follows from the last tokens of shorter prefixes, and a machine can read
byte after byte. What is open is the set of tokens that could be going on, as nodes of the tokens' trie; it
depends on the bytes alone. These sets are the states that are made deterministic: a state, and its move by a byte, is made
when it is first met and then looked up. A move names the tokens that end there; the tokens before
each open position, which go along, decide between them. A boundary is final once every prefix that a longer token
could still continue goes through it; the tokens before it are then emitted. What a token could still continue
is at most one token long, which bounds the lookahead. Where the machine stands behind the first bytes of a piece is remembered.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache, reduce
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from zonepulse.llm.common import per_batch
from zonepulse.llm.tokens import _LATIN, PATTERN, ChunkEncoder, vocabulary

MAX_STATES = 400_000
#: Bytes at the beginning of a piece that are looked up at once.
HEAD = 6
#: Bytes behind which final tokens are emitted.
_EMIT = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Token ids of one piece of text (bytes), by the ranks of a byte-level BPE."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.child: dict[int, int] = {}  # the trie: the node behind a node and a byte
        self.token_at, self.goes_on = [None], [False]  # of each node: its token, and whether a longer token goes through it
        for text, token in ranks.items():
            node = 0
            for byte in text:
                self.goes_on[node] = True
                if (to := self.child.get(node << 8 | byte)) is None:
                    to = self.child[node << 8 | byte] = len(self.token_at)
                    self.token_at.append(None)
                    self.goes_on.append(False)
                node = to
            self.token_at[node] = token
        # the states: nodes of the tokens that could be going on, longest first, and the root. The longest has the
        # others as its ends, so there are no more states than nodes
        self.states: list[tuple[int, ...]] = [(0,)]
        self.numbers = {(0,): 0}
        self.right = lru_cache(None)(lambda token: self._edge(token, 1))  # at most one entry per token
        self.left = lru_cache(None)(lambda token: self._edge(token, 0))
        self.fits = lru_cache(MAX_STATES)(self._fits)
        self._forget()

    def _forget(self) -> None:
        self.moves: dict[int, tuple] = {}
        self.heads: dict[bytes, tuple[int, list]] = {}

    def _parts(self, text: bytes, below: int) -> list[bytes]:
        """What the merges of rank under ``below`` leave of ``text``."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank >= below:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _edge(self, token: int, side: int) -> tuple[tuple[bytes, int, int], ...]:
        """The tokens that stand at one edge of ``token`` while it is merged, and the ranks that begin and end each."""
        out, ends, t = [], 1 << 60, token
        while True:
            text = self.bytes_of[t]
            out.append((text, t if len(text) > 1 else -1, ends))
            parts = self._parts(text, t)
            if len(parts) != 2:
                return tuple(out)
            ends, t = t, self.ranks[parts[side and -1]]

    def _fits(self, left: int | None, right: int) -> bool:
        """No merge joins an edge of ``left`` with an edge of ``right`` before both are whole."""
        if left is None:
            return True
        ranks = self.ranks
        for a, a_from, a_ends in self.right(left):
            for b, b_from, b_ends in self.left(right):
                joint = ranks.get(a + b)
                if joint is not None and (at := max(joint, a_from, b_from)) < a_ends and at <= b_ends:
                    return False
        return True

    def _move(self, state: int, byte: int) -> tuple[int, tuple, int, int, tuple[int, ...]]:
        """The state behind a byte; the tokens that end there, longest first, each with the place in the old state where
        it begins, the shortest apart; the places that stay open."""
        ends, stay, nodes = [], [], []
        for place, node in enumerate(self.states[state]):
            if (to := self.child.get(node << 8 | byte)) is not None:
                if self.token_at[to] is not None:
                    ends.append((place, self.token_at[to]))
                if self.goes_on[to]:
                    stay.append(place)
                    nodes.append(to)
        key = (*nodes, 0)
        if (number := self.numbers.get(key)) is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
        move = self.moves[state << 8 | byte] = (number, tuple(ends[:-1]), *ends[-1], tuple(stay))
        return move

    def _run(self, state: int, live: list[tuple], piece: bytes) -> tuple[int, list[tuple]]:
        """Where the machine stands behind ``piece``: the state, and for each of its places the last token before it with the
        one before that, and so on; the last place is the end of what was read."""
        moves, fits = self.moves, self.fits
        for byte in piece:
            state, ends, at, shortest, stay = moves.get(state << 8 | byte) or self._move(state, byte)
            for place, token in ends:
                if fits((before := live[place])[0], token):
                    made = (token, before)
                    break
            else:  # every prefix has an encoding, so this one fits
                made = (shortest, live[at])
            live = [*[live[place] for place in stay], made] if stay else [made]
        return state, live

    def _emit(self, live: list[tuple], out: list[int]) -> list[tuple]:
        """Moves the tokens that all open places share to ``out``; only the last of them stays, as the beginning."""
        paths = [_path(tokens) for tokens in live]
        final = commonprefix(paths)
        if not final:
            return live
        out += final
        begin, rest = (final[-1], None), [path[len(final) :] for path in paths]
        return [reduce(lambda before, token: (token, before), path, begin) for path in rest]

    def encode(self, piece: bytes) -> Sequence[int]:
        """A piece that is a token itself is that token; any other goes through the machine."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(self.heads) + len(self.moves) > MAX_STATES:
            self._forget()
        head = piece[:HEAD]
        if (found := self.heads.get(head)) is None:
            found = self.heads[head] = self._run(0, [(None, None)], head)
        state, live = found
        out: list[int] = []
        for i in range(HEAD, len(piece), _EMIT):
            if i > HEAD:
                live = self._emit(live, out)
            state, live = self._run(state, live, piece[i : i + _EMIT])
        return out + _path(live[-1])


def _path(tokens: tuple) -> list[int]:
    """The ids behind the beginning up to a place."""
    path, (token, before) = [], tokens
    while before is not None:
        path.append(token)
        token, before = before
    path.reverse()
    return path


class Encoder(ChunkEncoder):
    """Texts to ids: pieces by the pattern of the rank files, each through the transducer."""

    def __init__(self, path: str):
        super().__init__()
        self.machine = Transducer(read_ranks(path))
        self.split = regex.compile(PATTERN).findall

    def ids(self, piece: str) -> tuple[int, ...]:
        return self.machine.encode(piece.encode())

    def _chunk(self, chunk: str) -> bytes:
        word = chunk[1:] if chunk[:1] == " " else chunk
        if not (word.isalpha() and (word.isascii() or max(word) <= _LATIN)):
            return super()._chunk(chunk)
        ids = self.chunks.before.get(chunk)  # most chunks are a word, which is one piece and needs no pattern
        return self.chunks.keep(chunk, array("I", self.ids(chunk)).tobytes() if ids is None else ids)


@lru_cache(2)
def encoder_of(path: str) -> Encoder:
    """One per worker process: the next task goes on with the machine that the last one has built."""
    return Encoder(path)


class Utf8Machine:
    """Incremental UTF-8: takes bytes in any cuts and gives out whole characters.

    The state is the bytes of a character that is not complete. Bytes that cannot be text become U+FFFD.
    """

    def __init__(self) -> None:
        self.open = b""

    def feed(self, more: bytes) -> str:
        data = self.open + more
        cut = len(data)
        for back in range(1, min(4, len(data) + 1)):
            byte = data[-back]
            if byte & 0xC0 != 0x80:  # a first byte: complete only if its length is reached
                need = 2 if byte >> 5 == 6 else 3 if byte >> 4 == 14 else 4 if byte >> 3 == 30 else 1
                cut -= back if need > back else 0
                break
        self.open = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.open = self.open, b""
        return rest.decode("utf-8", "replace")


def joined(table: pa.Array, ids: np.ndarray) -> bytes:
    """The entries of a table of bytes that the ids name, one after the other."""
    found = table.take(pa.array(ids))
    _, ends, data = found.buffers()
    return data.slice(0, np.frombuffer(ends, np.int32)[len(found)]).to_pybytes() if len(found) and data else b""


class Decoder:
    """Ids back to text, some at a time."""

    def __init__(self, path: str, block: int = 4096):
        table = [b""] * (1 + max((ranks := read_ranks(path)).values()))
        for token, rank in ranks.items():
            table[rank] = token
        self.table, self.block = pa.array(table, pa.binary()), block

    def pieces(self, ids: Sequence[int] | np.ndarray) -> Iterator[str]:
        """The text of the ids, block after block; never cut within a character."""
        machine, ids = Utf8Machine(), np.asarray(ids, np.uint32)
        for i in range(0, len(ids), self.block):
            yield machine.feed(joined(self.table, ids[i : i + self.block]))
        yield machine.end()

    def decode(self, ids: Sequence[int] | None) -> str:
        return "".join(self.pieces(ids or []))


class Decimal:
    """Ids as decimal numbers with commas between them, some at a time."""

    def __init__(self, size: int, block: int = 1 << 16):
        self.table, self.block = pa.array([b"%d," % i for i in range(size)], pa.binary()), block

    def pieces(self, ids: Sequence[int] | np.ndarray) -> Iterator[bytes]:
        ids = np.asarray(ids, np.uint32)
        for i in range(0, len(ids), self.block):
            text = joined(self.table, ids[i : i + self.block])
            yield text if i + self.block < len(ids) else text[:-1]


@lru_cache(2)
def decoder_of(path: str) -> tuple[Decoder, Decimal]:
    decoder = Decoder(path)
    return decoder, Decimal(len(decoder.table))


def digest(pieces: Iterable[bytes]) -> str:
    sha = hashlib.sha256()
    for piece in pieces:
        sha.update(piece)
    return sha.hexdigest()


def _lists(values: list[array]) -> pa.Array:
    return pa.array(values, pa.list_(pa.int32()))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the ids of its whole text; a null text counts as empty and has none. One row per input row."""
    path = path or vocabulary("byte_bpe_multi_50k.tiktoken")

    def make():
        encoder = encoder_of(path)
        return lambda b: pa.record_batch({"doc_id": b["doc_id"], "ids": _lists([array("I", x) for x in encoder.encode_all(b["text"])])})

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(per_batch(make), "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the text of its ids; null ids give an empty text."""
    path = path or vocabulary("byte_bpe_multi_50k.tiktoken")

    def make():
        decoder, _ = decoder_of(path)
        return lambda b: pa.record_batch({"doc_id": b["doc_id"], "text": pa.array([decoder.decode(x) for x in b["ids"].to_pylist()], pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(per_batch(make), "doc_id bigint, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Digest of every document's ids and of what they decode to, in one pass and without a shuffle.

    Null and empty texts have no tokens and the digests of nothing; repeated rows give repeated rows; an
    empty table gives none. Only doc_id and text are read, so other columns cannot clash.
    """
    path = path or vocabulary("byte_bpe_multi_50k.tiktoken")

    def make():
        encoder, (decoder, decimal) = encoder_of(path), decoder_of(path)

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            counts, shas, texts = [], [], []
            for data in encoder.encode_all(b["text"]):
                ids = np.frombuffer(data, np.uint32)
                counts.append(len(ids))
                shas.append(digest(decimal.pieces(ids)))
                texts.append(digest(piece.encode() for piece in decoder.pieces(ids)))
            return pa.record_batch({
                "doc_id": b["doc_id"], "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(shas, pa.string()), "decoded_sha256": pa.array(texts, pa.string()),
            })

        return step

    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return rows.mapInArrow(per_batch(make), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
