"""Jaccard join on word n-grams: rare-first prefixes with length, positional and suffix filters.

The n-grams of a text are ordered by the number of texts that have them, the rarest first. Two texts that are alike
share one of the first n - ceil(share * n) + 1, so they are joined on those only; n-grams of a single text take places
of the prefix but join nothing. Pairs that are met are tested on their sizes, on their places in both orders (the first
common n-gram bounds the rest), and on the numbers of n-grams that fall into each part of the hash space (a suffix
filter for all parts at once); the pairs that are left are verified once, on full sets.

Counting moves packed arrays: a block of documents sends each part of the hash space one row of sorted 32-bit
values, and gets back those that another text has too. An n-gram that is frequent within a block is sent once, with
its number, so an n-gram of a third of all texts costs a value for a block. Texts with the same set are one node; a
group that shares an n-gram is compared with one of its nodes first, and only nodes that are still apart are compared
with each other, in cells of bounded size. So no group is spelled out as pairs and no link between different
components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.common import per_batch, salted_join, slices
from zonepulse.llm.components import components
from zonepulse.llm.near_duplicates import Shingles, labelled, texts_of, verified
from zonepulse.sources.scratch import materialize

WIDTH = 5
#: Links need 100 * intersection >= SHARE * union.
SHARE = 80
_BUCKET = 2_000_000  # n-grams in one part of the hash space
_BLOCK = 1_000_000  # n-grams in a block of documents, and at most _DOCS of them
_DOCS = 60_000
_RANGE = 500_000  # entries of a bucket that are sorted at once, about
_MANY = 8  # an n-gram that more texts of a block have is sent once
_HEAVY = 0xFFFF  # in place of a document: the entry stands for all of the block's
_CELL = 1024  # nodes of a group that are compared at once
_PARTS = 256  # parts of the hash space of the suffix filter

_SENT = 1 << 20  # bytes of a block's rows that leave Python at once, about

_HEAD = "block string, doc_id array<bigint>, text_hash array<bigint>, node array<bigint>, n array<bigint>, heavy binary, heavy_owners binary"
_PACK = "bucket int, values binary, owners binary, counts binary"


def _pack(sets: list[np.ndarray], bits: int) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """The block's n-grams by bucket; those of many texts once, with a count, and again with their owners."""
    # a key with its owner is one number (bits is at most 16), sorted in place
    keys = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    keys >>= np.uint64(32 - bits)
    keys <<= np.uint64(16)
    keys |= np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
    keys.sort()
    owners = keys.astype(np.uint16)
    keys >>= np.uint64(16)
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1)) != 0) if len(keys) else np.zeros(0, np.int64)
    size = np.diff(first, append=len(keys))
    many = np.repeat(size > _MANY, size)
    heavy, heavy_owners = keys[many], owners[many]
    sent = ~many
    sent[first] = True
    owners[first[size > _MANY]] = _HEAVY
    counts = np.zeros(len(keys), np.uint32)
    counts[first] = size
    keys, owners, counts = keys[sent], owners[sent], counts[sent]
    at = np.searchsorted(keys >> np.uint64(32), np.arange((1 << bits) + 1, dtype=np.uint64))
    packs = [{"bucket": k, "values": keys[i:j].astype(np.uint32).tobytes(), "owners": owners[i:j].tobytes(), "counts": counts[i:j][owners[i:j] == _HEAVY].tobytes()}
             for k, (i, j) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())) if i < j]
    return packs, heavy, heavy_owners


def blocks(docs: DataFrame, bits: int) -> DataFrame:
    """Rows of blocks: a head with the block's documents, their nodes (null without words) and set sizes, and a row for
    each bucket with the n-grams of its nodes there. Heads have no bucket; a row is small, however large the block.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, made, part = Shingles(WIDTH), 0, TaskContext.get().partitionId()
        rows, local, sets, held = [], {}, [], 0

        def block() -> Iterator[pa.RecordBatch]:
            packs, heavy, owners = _pack(sets, bits)
            name = f"{part}-{made}"
            head = dict(zip(("doc_id", "text_hash", "node", "n"), zip(*rows)))
            yield pa.RecordBatch.from_pylist([{"block": name, **head, "heavy": heavy.tobytes(), "heavy_owners": owners.tobytes()}], schema=_arrow())
            some, size = [], 0
            for p in packs:
                some.append({"block": name, **p})
                size += len(p["values"])
                if size >= _SENT or p is packs[-1]:
                    yield pa.RecordBatch.from_pylist(some, schema=_arrow())
                    some, size = [], 0

        for batch in slices(batches):
            for doc_id, text_hash, text in zip(*[batch[c].to_pylist() for c in ("doc_id", "text_hash", "text")], strict=True):
                s = shingles.of(text)
                node = int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None
                rows.append((doc_id, text_hash, node, len(s)))
                if node is not None and node not in local:
                    local[node] = len(sets)
                    sets.append(s)
                    held += len(s)
                if held >= _BLOCK or len(rows) >= _DOCS:
                    yield from block()
                    made, rows, local, sets, held = made + 1, [], {}, [], 0
        if rows:
            yield from block()

    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return keyed.mapInArrow(run, f"{_HEAD}, {_PACK}")


def _arrow() -> pa.Schema:
    lists = [(c, pa.list_(pa.int64())) for c in ("doc_id", "text_hash", "node", "n")]
    blobs = [(c, pa.binary()) for c in ("heavy", "heavy_owners", "values", "owners", "counts")]
    return pa.schema([("block", pa.string()), *lists, *blobs[:2], ("bucket", pa.int32()), *blobs[2:]])


def _joined(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """All arrays of a binary column in one, and where each ends."""
    parts = [np.frombuffer(x, kind) for x in column.to_pylist()]
    return (np.concatenate(parts) if parts else np.zeros(0, kind)), np.cumsum([len(p) for p in parts], dtype=np.int64)


def _shared(packs: pa.Table) -> pa.Table:
    """One bucket: the entries of each block whose value another text has too, with the number of texts.

    The entries of a block ascend by value, so the bucket is counted range by range of values, and only the entries of
    one range are sorted at once.
    """
    column = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in packs[name]]
    values, owners, counts = column("values", np.uint32), column("owners", np.uint16), column("counts", np.uint32)
    ranges = max(1, -(-sum(map(len, values)) // _RANGE))
    edges = np.linspace(0, 1 << 32, ranges + 1).astype(np.uint64)[1:-1].astype(np.uint32)
    cuts = [[0, *np.searchsorted(v, edges).tolist(), len(v)] for v in values]
    told = [0] * len(values)  # counts of each block that earlier ranges have used
    kept = [([], [], []) for _ in values]
    for k in range(ranges):
        parts = [(v[c[k] : c[k + 1]], o[c[k] : c[k + 1]]) for v, o, c in zip(values, owners, cuts)]
        ends = np.cumsum([len(v) for v, _ in parts])
        own = np.concatenate([o for _, o in parts])
        weight, many = np.ones(len(own)), [np.count_nonzero(o == _HEAVY) for _, o in parts]
        weight[own == _HEAVY] = np.concatenate([c[i : i + n] for c, i, n in zip(counts, told, many)])
        told = [i + n for i, n in zip(told, many)]
        _, at = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
        found = np.bincount(at, weight)[at].astype(np.uint32) if len(at) else np.zeros(0, np.uint32)
        for (v, o), i, out in zip(parts, ends - [len(v) for v, _ in parts], kept):
            here = found[i : i + len(v)]
            keep = here > 1
            for to, array in zip(out, (v, o, here)):
                to.append(array[keep].tobytes())
    out = {"block": packs["block"], "bucket": packs["bucket"]}
    for i, name in enumerate(("values", "owners", "found")):
        out[name] = pa.array([b"".join(x[i]) for x in kept], pa.binary())
    return pa.table(out)


def _prefixes(head: pa.Table, answers: pa.Table) -> pa.Table:
    """One block: the shared n-grams in the prefix of each of its nodes, with their place in its order and their frequency."""
    nodes, sizes = [], []
    seen = set()
    for node, n in zip(head["node"].to_pylist()[0] if head.num_rows else [], head["n"].to_pylist()[0] if head.num_rows else []):
        if node is not None and node not in seen:
            seen.add(node)
            nodes.append(node)
            sizes.append(n)
    values, ends = _joined(answers["values"], np.uint32)
    owners, _ = _joined(answers["owners"], np.uint16)
    found, _ = _joined(answers["found"], np.uint32)
    bucket = np.repeat(answers["bucket"].to_numpy().astype(np.uint64), np.diff(ends, prepend=0))
    keys = bucket << np.uint64(32) | values
    many = owners == _HEAVY
    if many.any():
        heavy = np.frombuffer(head["heavy"][0].as_py(), np.uint64)
        order = np.argsort(keys[many])
        at = np.searchsorted(keys[many][order], heavy)
        keys = np.concatenate([keys[~many], heavy])
        found = np.concatenate([found[~many], found[many][order][at]])
        owners = np.concatenate([owners[~many], np.frombuffer(head["heavy_owners"][0].as_py(), np.uint16)])
    order = np.lexsort((keys, found, owners))
    keys, found, owners = keys[order], found[order], owners[order].astype(np.int64)
    n, node = np.array(sizes, np.int64), np.array(nodes, np.int64)
    shared = np.bincount(owners, minlength=len(n))
    place = np.arange(len(keys)) - (np.cumsum(shared) - shared)[owners] + (n - shared)[owners]
    keep = place <= (n + (-SHARE * n // 100))[owners]  # the first n - ceil(SHARE * n / 100) + 1
    owners = owners[keep]
    whole = lambda x: pa.array(x.astype(np.int64), pa.int64())
    return pa.table({"key": whole(keys[keep]), "node": whole(node[owners]), "n": whole(n[owners]), "pos": whole(place[keep]), "found": whole(found[keep])})


def prefixes(made: DataFrame) -> DataFrame:
    """(key, node, n, pos, found): the n-grams of rare-first prefixes that more than one text has, from ``blocks``."""
    packs = made.filter("bucket IS NOT NULL").select("block", "bucket", "values", "owners", "counts")
    shared = packs.groupBy("bucket").applyInArrow(_shared, "block string, bucket int, values binary, owners binary, found binary")
    told = shared.filter(F.length("values") > 0).withColumnRenamed("block", "of")
    heads = made.filter("bucket IS NULL").select("block", "node", "n", "heavy", "heavy_owners")
    rows = heads.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(_prefixes, "key bigint, node bigint, n bigint, pos bigint, found bigint")
    return rows.dropDuplicates(["key", "node"])  # a set that several blocks hold has the same prefix in each


def _groups(rows: DataFrame) -> DataFrame:
    """The rows of ``prefixes`` whose n-gram several nodes have; of n-grams with the very same nodes only the first in the order."""
    marks = [F.expr(f"bit_xor(xxhash64(node, {k}))").alias(f"mark{k}") for k in (1, 2)]
    met = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("size"), F.min("found").alias("found"), *marks)
    same = met.filter("low != high").groupBy("low", "high", "size", "mark1", "mark2").agg(F.min(F.struct("found", "key")).alias("first"))
    picked = same.select(F.col("first.key").alias("of"), "size")
    return salted_join(rows, picked, lambda a, b: a["key"] == b["of"], F.col("node"), "inner").select("key", "node", "n", "pos", "size")


def _may_link(n: str, pos: str, n2: str, pos2: str) -> str:
    """Length filter, and positional filter for the first common n-gram: both texts have at most what follows in common, and it."""
    alike = f"100 * least({n}, {n2}) >= {SHARE} * greatest({n}, {n2})"
    return f"{alike} AND {100 + SHARE} * least({n} - {pos}, {n2} - {pos2}) >= {SHARE} * ({n} + {n2})"


def _near_hubs(members: DataFrame) -> DataFrame:
    """Candidate pairs (u, v) of each node with the hub of its group: the node that meets most others over all its groups."""
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = members.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node", "n", "pos")).alias("hub"))
    hubs = hubs.select(F.col("key").alias("of"), F.col("hub.node").alias("u"), F.col("hub.n").alias("hub_n"), F.col("hub.pos").alias("hub_pos"))
    pairs = salted_join(members, hubs, lambda a, b: a["key"] == b["of"], F.col("node"), "inner").filter("node != u")
    return pairs.filter(_may_link("n", "pos", "hub_n", "hub_pos")).select("u", F.col("node").alias("v")).distinct()


def _parts(texts: DataFrame) -> DataFrame:
    """(node, parts): how many n-grams fall into each part of the hash space, up to 255."""
    def make():
        shingles = Shingles(WIDTH)

        def parts(text: str | None) -> bytes:
            at = (shingles.of(text) >> np.uint64(24)) % np.uint64(_PARTS)
            return np.minimum(np.bincount(at.astype(np.int64), minlength=_PARTS), 255).astype(np.uint8).tobytes()

        return lambda b: pa.record_batch({"node": b["node"], "parts": pa.array([parts(t) for t in b["text"].to_pylist()], pa.binary())})

    return texts.select("node", "text").mapInArrow(per_batch(make), "node bigint, parts binary")


def _compare(cell: list[np.ndarray], left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes of two blocks (or one) in different components that pass all three filters."""
    node, root, n, pos, parts, own = cell
    us, vs = [], []
    full = (parts == 255).any(1)
    sides = np.flatnonzero(left), (np.flatnonzero(~left) if not left.all() else np.flatnonzero(left))
    b = sides[1]
    for i in sides[0].tolist():
        both = SHARE * (n[i] + n[b])
        ok = (root[b] != root[i]) & (100 * np.minimum(n[b], n[i]) >= SHARE * np.maximum(n[b], n[i]))
        ok &= (100 + SHARE) * np.minimum(n[i] - pos[i], n[b] - pos[b]) >= both
        if left.all():
            ok &= b > i
        at = b[ok]
        if len(at):
            common = np.minimum(parts[at], parts[i]).sum(1, dtype=np.int64)
            at = at[((100 + SHARE) * common >= both[ok]) | full[at] | full[i]]
            us.append(np.minimum(node[i], node[at]))
            vs.append(np.maximum(node[i], node[at]))
    none = np.zeros(0, np.int64)
    return (np.concatenate(us), np.concatenate(vs)) if us else (none, none)


def _still_apart(members: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Candidate pairs of nodes of one group that are in different components.

    A group of at most _CELL nodes is one cell; a larger one is cut into blocks, and each pair of blocks is a cell of
    its own, dealt by (group, block, block).
    """
    known = members.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = known.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size")).filter("low != high")
    groups = groups.select(F.col("key").alias("open"), F.ceil(F.col("size") / _CELL).cast("int").alias("blocks"))
    rows = salted_join(known.drop("size"), groups, lambda a, b: a["key"] == b["open"], F.col("node"), "inner").drop("open")
    rows = materialize(rows.withColumn("own", F.expr("CAST(pmod(xxhash64(node), blocks) AS INT)")), "apart")
    parts = _parts(texts.join(rows.select("node").distinct(), "node", "left_semi"))
    filled = rows.join(parts, "node").withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    filled = filled.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "root", "n", "pos", "parts")
    # of a pair of a block with itself nothing is repeated; rows of (i, j) come from both blocks
    dealt = filled.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, mark = [], None

        def done() -> pa.RecordBatch:
            cell = [np.concatenate([h[c] for h in held]) for c in range(6)]
            own = cell[5]
            u, v = _compare(cell, own == own.min())
            return pa.record_batch({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

        for batch in batches:
            keys = np.stack([batch[c].to_numpy().astype(np.int64) for c in ("key", "i", "j")], 1)
            columns = [batch[c].to_numpy() for c in ("node", "root", "n", "pos")]
            columns += [np.frombuffer(b"".join(batch["parts"].to_pylist()), np.uint8).reshape(-1, _PARTS), batch["own"].to_numpy()]
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if mark is not None and tuple(keys[a]) != mark:
                    yield done()
                    held = []
                mark = tuple(keys[a])
                held.append([c[a:b] for c in columns])
        if held:
            yield done()

    return dealt.mapInArrow(run, "u bigint, v bigint").distinct()


def join(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, text_hash, n_shingles and component_id, the smallest doc_id that links reach.

    Without words (or text) a document is its own component and linked with nothing; one with fewer words than an n-gram
    has all of them as its only n-gram. A null doc_id is never an end of a component: it is null if all of the component
    are. Rows that repeat an id are judged each by its own text. An empty table gives no rows. Only doc_id and text are
    read, so names cannot clash; texts are read whole, whatever their length.
    """
    docs = docs.select("doc_id", "text")
    length = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(16, ceil(log2(max(1, length / 7 / _BUCKET))))
    made = materialize(blocks(docs, bits), "blocks")
    known = made.filter("bucket IS NULL").select(F.inline(F.arrays_zip("doc_id", "text_hash", "node", "n")))
    members = materialize(_groups(materialize(prefixes(made), "prefixes")), "members")
    texts = texts_of(docs, known.filter(F.col("node").isNotNull()), members.select("node").distinct())
    links = materialize(verified(_near_hubs(members), texts, SHARE), "links")
    apart = materialize(_still_apart(members, components(links), texts), "pairs")
    more = materialize(verified(apart, texts, SHARE), "links")
    return labelled(known, components(links.union(more)))


def oracle_sql() -> str:
    """The contract as SQL: sets, pairs that share an n-gram, components by reachability."""
    return rf"""WITH RECURSIVE
words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WIDTH} THEN [list_aggregate(w, 'string_agg', ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - {WIDTH - 2}), lambda i: list_aggregate(w[i:i + {WIDTH - 1}], 'string_agg', ' '))) END AS s FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common, any_value(a.n) AS n, any_value(b.n) AS m
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM pairs WHERE 100 * common >= {SHARE} * (n + m - common)),
both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT u, v FROM both_ways UNION SELECT reach.u, both_ways.v FROM reach JOIN both_ways ON reach.v = both_ways.u)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce((SELECT min(v) FROM reach WHERE u = doc_id), doc_id)) AS component_id FROM sets"""
