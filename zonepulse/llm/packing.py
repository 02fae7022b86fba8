"""Packing of token sequences by minimum bin slack.

Only the number of remainders of each length matters for which lengths go together, so a window (the next
sequence) is filled on a histogram of at most ``capacity`` lengths: the largest remaining length opens it, a
bitset of reachable sums says how close the others can come to the capacity, and backtracking through the
bitsets gives how many of each length that takes. The same choice is made again while the counts last.
Whatever slack no choice can fill is closed by cutting one remainder, so windows are full.

Tasks pack the rows they read, block by block, without a shuffle: a block holds a bounded number of tokens,
what does not fill a window is carried to the next block, and the last tokens of a task go into sequences
whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from zonepulse.llm.tokens import library_encoder, vocabulary

SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
_TASK_BITS = 36  # sequence numbers of a task; its own number stands above them


def closest(counts: dict[int, int], target: int) -> dict[int, int]:
    """How many of each length give the largest sum that is at most ``target``.

    ``counts``: how many there are of each length. Subset sums are bits of a whole number; a length that is there
    many times enters as 1, 2, 4, ... copies. The bitsets before each step allow going back from the sum.
    """
    reach, mask, steps = 1, (1 << target + 1) - 1, []
    for length in sorted((n for n in counts if n <= target and counts[n] > 0), reverse=True):
        left, copies = min(counts[length], target // length), 1
        while left:
            copies = min(copies, left)
            steps.append((reach, length, copies))
            reach |= reach << length * copies & mask
            left, copies = left - copies, copies * 2
        if reach >> target & 1:
            break
    total, used = reach.bit_length() - 1, defaultdict(int)
    for before, length, copies in reversed(steps):
        if not before >> total & 1:
            used[length] += copies
            total -= length * copies
    return dict(used)


class Packer:
    """Takes remainders of documents and gives full sequences of their pieces."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.of: dict[int, list[tuple]] = defaultdict(list)  # by length: (document row, start, ids)
        self.total = 0

    def add(self, row: tuple, start: int, ids: memoryview) -> None:
        n = len(ids) // 4
        self.of[n].append((row, start, ids))
        self.total += n

    def _take(self, length: int, part: int | None = None) -> tuple:
        """A piece of this length; with ``part``, its first ids, and the rest stays."""
        row, start, ids = self.of[length].pop()
        if not self.of[length]:
            del self.of[length]
        self.total -= length
        if part is not None and part < length:
            self.add(row, start + part, ids[4 * part :])
            ids = ids[: 4 * part]
        return row, start, ids

    def windows(self) -> Iterator[list[tuple]]:
        """Full sequences as long as there are tokens for one."""
        while self.total >= self.capacity:
            counts = {n: len(p) for n, p in self.of.items()}
            first = max(counts)
            counts[first] -= 1
            used = closest(counts, self.capacity - first)
            slack = self.capacity - first - sum(n * k for n, k in used.items())
            used[first] = used.get(first, 0) + 1
            counts[first] += 1
            times = 1 if slack else min(counts[n] // k for n, k in used.items())
            for _ in range(times):
                pieces = [self._take(n) for n in sorted(used, reverse=True) for _ in range(used[n])]
                if slack:  # nothing left is that short, so one piece is cut
                    pieces.append(self._take(min(self.of), slack))
                yield pieces

    def rest(self) -> Iterator[list[tuple]]:
        """What is left, in sequences whose lengths are powers of two."""
        while self.total:
            space, pieces = 1 << self.total.bit_length() - 1, []
            while space:
                fits = [n for n in self.of if n <= space]
                piece = self._take(max(fits)) if fits else self._take(min(self.of), space)
                space -= len(piece[2]) // 4
                pieces.append(piece)
            yield pieces


def pack(docs: DataFrame, path: str | None = None, capacity: int = 2048, end_id: int = 1, block: int = 2_000_000) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most ``capacity`` tokens.

    A document is its ids and then ``end_id``; a null text counts as empty, so it is the end id alone. Long
    documents give full sequences of their own first; their remainders are packed. ``ids`` are the piece's
    ids as little-endian unsigned 32-bit integers, ``start`` the ids of its document before it. Repeated rows
    are packed as often as they occur, a null doc_id stays null, an empty table gives no rows. A task that is
    run again packs the same rows the same way. ``block`` bounds the tokens that a task holds.
    """
    path = path or vocabulary("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = library_encoder(path), Packer(capacity)
        end = end_id.to_bytes(4, "little")
        number = TaskContext.get().partitionId() << _TASK_BITS
        out: list[tuple] = []

        def place(pieces: list[tuple]) -> None:
            nonlocal number
            offset = 0
            for (doc_id, tokens), start, ids in pieces:
                out.append((doc_id, start, len(ids) // 4, bytes(ids), tokens, number, offset))
                offset += len(ids) // 4
            number += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 7
            out.clear()
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

        for batch in batches:
            for doc_id, found in zip(batch["doc_id"].to_pylist(), encoder.encode_all(batch["text"]), strict=True):
                ids = memoryview(found + end)
                row, whole = (doc_id, len(ids) // 4), len(ids) // 4 // capacity * capacity
                for start in range(0, whole, capacity):
                    place([(row, start, ids[4 * start : 4 * (start + capacity)])])
                if whole < row[1]:
                    packer.add(row, whole, memoryview(bytes(ids[4 * whole :])))
                if packer.total >= block:
                    for pieces in packer.windows():
                        place(pieces)
                if len(out) >= 2000:
                    yield flush()
        for pieces in packer.windows():
            place(pieces)
        for pieces in packer.rest():
            place(pieces)
        yield flush()

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(run, SCHEMA)
