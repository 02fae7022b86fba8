"""Alignment of two tokenizers over the same texts, by pointer jumping.

Both tokenizers cut the bytes of a text. Every token points to the farthest-right token that overlaps it (of two that
end together, the one of B is the farther); following pointers leads to the last token of its group, where a token of A
and one of B end together. All pointers of many texts are followed at once: the successor array is applied to itself,
so the length of the jumps doubles, until nothing changes.

Texts are worked on in blocks of bounded size. A block keeps a dictionary of the id pairs that it links, so the
corpus-wide counts move one row for a pair and block, not one for a link, and come back to the block the same way.

Defined results: texts that are null or empty, or that a tokenizer does not give back byte by byte, have no tokens. Rows
that repeat an id are aligned each on their own; strings of special tokens are plain text; texts are aligned whole,
whatever their length; an empty table gives no rows; only doc_id and text are read, so names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zonepulse.llm.tokens import byte_values, library_encoder, vocabulary
from zonepulse.sources.scratch import materialize

#: Bytes of text in a block; a longer text is a block of its own.
_BLOCK = 2_000_000
_ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups string, block string, links binary, codes array<bigint>, uses array<bigint>"


class Side:
    """The bytes of every token of a vocabulary, and its ids as text followed by each kind of separator."""

    def __init__(self, pieces: list[bytes], last: bytes):
        self.pieces = pieces
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        # an id's text is at 2 * id within a run of the side and at 2 * id + 1 at its end
        self.texts = [b"%d%s" % (i, end) for i in range(len(pieces)) for end in (b",", last)]


@lru_cache(2)
def _sides(a_path: str, b_path: str) -> tuple[Side, Side, sentencepiece.SentencePieceProcessor]:
    """The tables of both vocabularies, once per worker process."""
    values = byte_values()
    entries = Tokenizer.from_file(a_path).get_vocab()
    a = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        a[i] = bytes(values[c] for c in entry) if all(c in values for c in entry) else entry.encode()
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    made = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return Side(a, b"|"), Side(made, b";"), b


def components(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group numbers, from 0, of the tokens of A and of B, whose byte ranges end at the given places.

    Both sides cover the same bytes without gaps. The farthest-right token that overlaps another is the one that
    covers its last byte.
    """
    n = len(ends_a)
    over_a = n + np.searchsorted(ends_b, ends_a)  # the token of B over the last byte of each token of A
    cover = np.searchsorted(ends_a, ends_b)
    over_b = np.where(ends_a[cover] > ends_b, cover, n + np.arange(len(ends_b)))
    to = np.concatenate([over_a, over_b])
    while not np.array_equal(further := to[to], to):
        to = further
    last = np.zeros(len(ends_b), np.int64)
    last[to - n] = 1  # terminal tokens are of B
    group = (np.cumsum(last) - 1)[to - n]
    return group[:n], group[n:]


def _flat(lists: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(lists).astype(kind, copy=False) if lists else np.zeros(0, kind)


class Aligner:
    def __init__(self, a_path: str, b_path: str, digest: bool):
        self.first, self.digest = library_encoder(a_path, plain=True), digest
        self.a, self.b, self.second = _sides(a_path, b_path)

    def _tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        none, out = (np.zeros(0, np.int64),) * 2, []
        encoded = self.second.encode([t or "" for t in texts], num_threads=1)
        for text, ids_b in zip(texts, encoded, strict=True):
            out.append(none)
            if not text:
                continue
            raw, ids_a = (" " + text).encode(), np.frombuffer(self.first.encode(" " + text), np.uint32).astype(np.int64)
            a, b = self.a.pieces, self.b.pieces
            if b"".join([a[i] for i in ids_a.tolist()]) == raw and b"".join([b[i] for i in ids_b]) == raw:
                out[-1] = ids_a, np.array(ids_b, np.int64)
        return out

    def block(self, doc_ids: list[int | None], texts: list[str | None], name: str) -> pa.RecordBatch:
        """One row per text; the first row carries the block's dictionary of linked pairs and their number of links."""
        tokens = self._tokens(texts)
        size_a, size_b = (np.array([len(t[k]) for t in tokens]) for k in (0, 1))
        a, b = (_flat([t[k] for t in tokens], np.int64) for k in (0, 1))
        of_a, of_b = components(np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])) if len(a) else (a, b)

        # both sides in the order of the groups; a token's separator tells whether it is the last of its side there
        n = int(of_b[-1]) + 1 if len(of_b) else 0
        in_a, in_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        last_a, last_b = np.diff(of_a, append=n) != 0, np.diff(of_b, append=n) != 0
        merged = np.empty(len(a) + len(b), np.int64)
        place_a, place_b = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[of_a], np.arange(len(b)) + np.cumsum(in_a)[of_b]
        merged[place_a], merged[place_b] = 2 * a + last_a, -1 - (2 * b + last_b)
        ta, tb = self.a.texts, self.b.texts
        shown = [ta[i] if i >= 0 else tb[-1 - i] for i in merged.tolist()]

        codes, links = np.unique(a[last_a] << 32 | b[last_b], return_inverse=True)
        uses = np.bincount(links, minlength=len(codes))
        until = np.cumsum(size_a)
        groups = np.concatenate([[0], np.cumsum(last_a)])[np.concatenate([[0], until])] if len(a) else np.zeros(len(texts) + 1, np.int64)
        at, cuts, slots = np.concatenate([[0], np.cumsum(size_a + size_b)]), [], links.astype(np.uint32)
        for k in range(len(texts)):
            text = b"".join(shown[at[k] : at[k + 1]])[:-1]
            cuts.append((hashlib.sha256(text).hexdigest() if self.digest else text.decode()) if text else "")
        whole = lambda x: pa.array(x, pa.int64())
        head = lambda x: pa.array([x if k == 0 else None for k in range(len(texts))], pa.list_(pa.int64()))
        return pa.record_batch({
            "doc_id": whole(doc_ids), "n_a": whole(size_a), "n_b": whole(size_b), "n_groups": whole(np.diff(groups)), "groups": pa.array(cuts),
            "block": pa.array([name] * len(texts)),
            "links": pa.array([slots[groups[k] : groups[k + 1]].tobytes() for k in range(len(texts))], pa.binary()), "codes": head(codes), "uses": head(uses),
        })


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups and ``groups``, the ids as ``a1,a2|b1;a3|b2,b3``.

    With ``digest`` groups is the lower-case hex sha256 of that text ('' where there are no tokens). The other columns
    serve ``corpus_links``.
    """
    a_path, b_path = a_path or vocabulary("byte_bpe_50k.json"), b_path or vocabulary("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, made, part = Aligner(a_path, b_path, digest), 0, TaskContext.get().partitionId()
        for batch in batches:
            ids, texts, first, held = batch["doc_id"].to_pylist(), batch["text"].to_pylist(), 0, 0
            for k, text in enumerate(texts):
                held += len(text or "")
                if held >= _BLOCK or k + 1 == len(texts):
                    yield aligner.block(ids[first : k + 1], texts[first : k + 1], f"{part}-{made}")
                    first, held, made = k + 1, 0, made + 1

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, _ALIGNED)


def corpus_links(aligned: DataFrame) -> DataFrame:
    """The rows of ``align`` with n_links, n_best and count_sum.

    A pair's count is the number of its links in all rows; n_best counts the links whose pair has the highest count of
    all pairs with the same id of B. At most |A| pairs share an id of B.
    """
    aligned = materialize(aligned, "aligned")
    entries = aligned.filter("codes IS NOT NULL").select("block", F.posexplode(F.arrays_zip("codes", "uses")).alias("slot", "e"))
    entries = entries.select("block", "slot", F.col("e.codes").alias("code"), F.col("e.uses").alias("uses"))
    counts = entries.groupBy("code").agg(F.sum("uses").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.expr("code & 4294967295")))
    counts = counts.select("code", "count", (F.col("count") == most).alias("best"))
    told = entries.select(F.col("block").alias("of"), "slot", "code").join(counts, "code").select("of", "slot", "count", "best")
    plain = aligned.select("block", "doc_id", "n_a", "n_b", "n_groups", "groups", "links")

    def measure(docs: pa.Table, dictionary: pa.Table) -> pa.Table:
        """The documents of one block and the counts of its pairs, in any order."""
        n = dictionary.num_rows
        count, best = np.zeros(n, np.int64), np.zeros(n, bool)
        slot = dictionary["slot"].to_numpy()
        count[slot], best[slot] = dictionary["count"].to_numpy(), dictionary["best"].to_numpy()
        links = [np.frombuffer(x, np.uint32) for x in docs["links"].to_pylist()]
        whole = lambda x: pa.array(x, pa.int64())
        return pa.table({
            **{c: docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups")}, "n_links": whole([len(x) for x in links]),
            "n_best": whole([int(best[x].sum()) for x in links]), "count_sum": whole([int(count[x].sum()) for x in links]), "groups": docs["groups"],
        })

    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"
    return plain.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(measure, schema)
