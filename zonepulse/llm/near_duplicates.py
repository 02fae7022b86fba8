"""Near-duplicate documents: many universal hash minima, bands, checks on full sets, connected components.

Texts with the same set of shingles are one node, so copies cost one comparison however many there are. Nodes
that share a band are first compared with one of them only, its hub; what links is joined, and only nodes of
a band that are still apart are compared with each other, in blocks, on signatures and short hashes. Every candidate
is confirmed on the full shingle sets. So no group is spelled out as pairs, and no link between different
components is lost (but for pairs that share no band: with 40 bands of 5 minima about 2 in 100,000 at a
similarity of 0.75, fewer above).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.common import per_batch, salted_join
from zonepulse.llm.components import components
from zonepulse.llm.tokens import Memory
from zonepulse.sources.scratch import materialize

WIDTH, ROWS, BANDS = 5, 5, 40
#: Links need 100 * intersection >= SHARE * union.
SHARE = 75
_CHUNKS = 64  # tasks that the members of one hub may be dealt over
_BLOCK = 32  # nodes of a band that are compared at once
_SLACK = 0.15  # five standard deviations of a similarity estimated from 200 minima at 0.75
_P = np.uint64(0x9E3779B97F4A7C15)


class Shingles:
    """Texts to sorted distinct 64-bit shingle hashes; hashes of lately met words are remembered."""

    def __init__(self, width: int = WIDTH):
        self.width, self.known = width, Memory(200_000)

    def _learn(self, word: bytes) -> bytes:
        if (h := self.known.older(word)) is None:
            h = xxhash.xxh3_64_digest(word)
        return self.known.keep(word, h)

    def of(self, text: str | None) -> np.ndarray:
        """A-Z are lower-cased; with fewer words than the width, all of them are one shingle; without words there is none."""
        get, learn = self.known.get, self._learn
        words = (text or "").encode("utf-8", "replace").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        h = np.frombuffer(b"".join([get(w) or learn(w) for w in words]), np.uint64)
        n = min(self.width, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(n):
                out = (out ^ h[i : len(h) - n + 1 + i]) * _P
                out ^= out >> np.uint64(29)
        return np.unique(out)


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    draw = lambda: rng.integers(0, 1 << 63, ROWS * BANDS, dtype=np.uint64)
    return draw() << np.uint64(1) | np.uint64(1), draw()


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of every multiply-shift hash function over the shingles."""
    least = np.full(len(a), np.uint64(0xFFFFFFFFFFFFFFFF))
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 256):
            least = np.minimum(least, (shingles[at : at + 256, None] * a + b).min(0))
    return (least >> np.uint64(32)).astype(np.uint32)


_FEATURES = "doc_id bigint, text_hash bigint, node bigint, n bigint, signature binary, bands array<bigint>"


def features(docs: DataFrame) -> DataFrame:
    """One row per document: its node (null without words), set size, signature (a byte of each minimum) and band keys."""
    def make():
        shingles, (a, b) = Shingles(), _functions()
        salts = np.arange(BANDS, dtype=np.uint64)

        def one(text: str | None):
            s = shingles.of(text)
            if not len(s):
                return None, 0, None, None
            sig = signature(s, a, b)
            parts, keys = sig.reshape(BANDS, ROWS).astype(np.uint64), salts + np.uint64(1)
            with np.errstate(over="ignore"):
                for i in range(ROWS):
                    keys = (keys ^ parts[:, i]) * _P
                    keys ^= keys >> np.uint64(31)
            node = int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
            return node, len(s), sig.astype(np.uint8).tobytes(), keys.view(np.int64)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [one(t) for t in batch["text"].to_pylist()]
            column = lambda i, kind: pa.array([f[i] for f in found], kind)
            return pa.record_batch({
                "doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "node": column(0, pa.int64()), "n": column(1, pa.int64()),
                "signature": column(2, pa.binary()), "bands": column(3, pa.list_(pa.int64())),
            })

        return step

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(per_batch(make), _FEATURES)


def _alike(a: str, b: str) -> str:
    """Sizes that a link allows."""
    return f"100 * least({a}, {b}) >= {SHARE} * greatest({a}, {b})"


def verified(candidates: DataFrame, texts: DataFrame, share: int = SHARE) -> DataFrame:
    """The (u, v) with 100 * intersection >= share * union of their full shingle sets. Rows of a hub u stream past its set; none are collected."""
    pairs = candidates.select("u", "v", F.pmod(F.xxhash64("v"), F.lit(_CHUNKS)).cast("int").alias("chunk"))
    hub, member = texts.select(F.col("node").alias("u"), "text"), texts.select(F.col("node").alias("v"), "text")
    heads = pairs.select("u", "chunk").distinct().join(hub, "u").select("u", "chunk", F.lit(None).cast("bigint").alias("v"), "text")
    rows = heads.unionByName(pairs.join(member, "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, current, own = Shingles(), None, np.zeros(0, np.uint64)
        for batch in batches:
            us, vs = [], []
            for u, v, text in zip(batch["u"].to_pylist(), batch["v"].to_pylist(), batch["text"], strict=True):
                other = shingles.of(text.as_py())
                if v is None:
                    current, own = u, other
                    continue
                if u != current:
                    raise RuntimeError(f"node {u} is not before its pairs")
                both = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * both >= share * (len(own) + len(other) - both):
                    us.append(u)
                    vs.append(v)
            yield pa.record_batch({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    dealt = rows.repartition("u", "chunk").sortWithinPartitions("u", "chunk", F.asc_nulls_first("v"))
    return dealt.select("u", "v", "text").mapInArrow(run, "u bigint, v bigint")


def _short_sets(texts: DataFrame) -> DataFrame:
    """(node, set): shingle sets with hashes of 32 bits, enough to tell which pairs are worth a full check."""
    def make():
        shingles = Shingles()

        def short(text: str | None) -> bytes:
            return (shingles.of(text) >> np.uint64(32)).astype(np.uint32).tobytes()

        return lambda b: pa.record_batch({"node": b["node"], "set": pa.array([short(t) for t in b["text"].to_pylist()], pa.binary())})

    return texts.select("node", "text").mapInArrow(per_batch(make), "node bigint, set binary")


def _still_apart(members: DataFrame, labels: DataFrame, texts: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs of nodes of one band in different components whose signatures and sets, by short hashes, are alike.

    Nodes of a band are compared block by block within tasks, first on signatures, then on short sets, and only
    pairs that are alike leave a task. Both limits are lower than the one of the full check that follows.
    """
    known = members.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_keys = known.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size")).filter("low != high")
    open_keys = open_keys.select(F.col("key").alias("open"), F.ceil(F.col("size") / _BLOCK).cast("int").alias("blocks"))
    rows = salted_join(known, open_keys, lambda a, b: a["key"] == b["open"], F.col("node"), "inner")
    rows = materialize(rows.select("key", "node", "root", F.expr("CAST(pmod(xxhash64(node), blocks) AS INT)").alias("block")), "apart")
    sets = _short_sets(texts.join(rows.select("node").distinct(), "node", "left_semi"))
    one = signed.join(rows.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    filled = rows.join(sets.join(one, "node"), "node")
    cells = filled.groupBy("key", "block").agg(F.collect_list(F.struct("node", "root", "signature", "set")).alias("cell"))
    other = cells.select(F.col("key").alias("key_"), F.col("block").alias("block_"), F.col("cell").alias("cell_"))
    met = cells.join(other, (F.col("key") == F.col("key_")) & (F.col("block") <= F.col("block_"))).select("cell", "cell_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for a, b in zip(batch["cell"], batch["cell_"], strict=True):
                (ida, ra, ga, sa), (idb, rb, gb, sb) = _columns(a.as_py()), _columns(b.as_py())
                near = (ga[:, None, :] == gb[None, :, :]).mean(2) >= SHARE / 100 - _SLACK
                sizes = np.array([len(x) for x in sb])
                flat, owner = np.concatenate(sb), np.repeat(np.arange(len(sb)), sizes)
                for i, own in enumerate(sa):
                    far = near[i] & (rb != ra[i]) & (100 * np.minimum(sizes, len(own)) >= (SHARE - 1) * np.maximum(sizes, len(own)))
                    if not far.any():
                        continue
                    both = np.bincount(owner[np.isin(flat, own)], minlength=len(sb))
                    for j in np.flatnonzero(far & (100 * both >= (SHARE - 1) * (sizes + len(own) - both))):
                        us.append(min(ida[i], idb[j]))
                        vs.append(max(ida[i], idb[j]))
            yield pa.record_batch({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    return met.mapInArrow(run, "u bigint, v bigint").distinct()


def _columns(cell: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    ids, roots = (np.array([c[k] for c in cell], np.int64) for k in ("node", "root"))
    return ids, roots, np.array([np.frombuffer(c["signature"], np.uint8) for c in cell]), [np.frombuffer(c["set"], np.uint32) for c in cell]


def link(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, text_hash, n_shingles, component_id and kept.

    ``component_id`` is the smallest doc_id that can be reached over links; without words (or text) a document is its
    own component. Rows with a null doc_id are never an end of a component: theirs is null if they are linked
    with nothing, and they are kept. Rows that repeat an id are judged each by its own text. An empty table gives
    no rows. Only doc_id and text are read.
    """
    docs = docs.select("doc_id", "text")
    known = materialize(features(docs), "minhash")
    nodes = known.filter(F.col("node").isNotNull())
    rows = nodes.select(F.explode("bands").alias("key"), "node", "n")
    met = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("top"), F.count("*").alias("size")).filter("low != top")
    met = met.select(F.col("key").alias("of"), "size")
    members = salted_join(rows, met, lambda a, b: a["key"] == b["of"], F.col("node"), "inner")
    members = materialize(_with_hubs(members.select("key", "node", "n", "size").distinct()), "bands")
    texts = texts_of(docs, nodes, members.select("node").distinct())
    near = members.filter("node != hub").filter(_alike("n", "hub_n")).select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct()
    links = materialize(verified(near, texts), "links")
    apart = materialize(_still_apart(members.select("key", "node"), components(links), texts, nodes.select("node", "signature")), "pairs")
    more = materialize(verified(apart, texts), "links")
    out = labelled(known, components(links.union(more)))
    return out.withColumn("kept", F.col("doc_id").isNull() | F.col("doc_id").eqNullSafe(F.col("component_id")))


def labelled(known: DataFrame, roots: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles and component_id of every row of ``known`` (doc_id, text_hash, node, n).

    ``roots`` (node, root) holds the nodes that are linked with another one.
    """
    nodes = known.filter(F.col("node").isNotNull())
    first = nodes.groupBy("node").agg(F.min("doc_id").alias("first"))
    rooted = first.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ends = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    table = salted_join(rooted.select("node", "root"), ends.withColumnRenamed("root", "end"), lambda a, b: a["root"] == b["end"], F.col("node"), "inner")
    table = table.select(F.col("node").alias("of"), "component_id")
    out = salted_join(known.select("doc_id", "text_hash", "node", "n"), table, lambda a, b: a["node"] == b["of"], F.struct("doc_id", "text_hash"), "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _with_hubs(members: DataFrame) -> DataFrame:
    """``members`` with the hub of their band: the node that meets most others over all its bands.

    The text that others were made from has more in common with them than they have with each other, so
    it meets them in more bands, and one comparison with it joins most of a group.
    """
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = members.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node", "n")).alias("hub"))
    hubs = hubs.select(F.col("key").alias("of"), F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"))
    return salted_join(members, hubs, lambda a, b: a["key"] == b["of"], F.col("node"), "inner").select("key", "node", "n", "hub", "hub_n")


def texts_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the wanted nodes, one row each, written once for both rounds of checks."""
    first = nodes.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("at")).join(wanted, "node", "left_semi")
    first = first.select("node", F.col("at.doc_id").alias("id"), F.col("at.text_hash").alias("hash"))
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    found = keyed.join(first, keyed["doc_id"].eqNullSafe(first["id"]) & (keyed["text_hash"] == first["hash"]))
    return materialize(found.select("node", "text").dropDuplicates(["node"]), "texts")


def filter_documents(docs: DataFrame) -> DataFrame:
    """One document of each component, with its own columns: the one with the smallest id. Repeated rows stay once."""
    kept = link(docs).filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).distinct()
    match = docs["doc_id"].cast("bigint").eqNullSafe(kept["kept_id"]) & (F.xxhash64(docs["text"]) == kept["kept_hash"])
    stays = docs.join(kept, match, "left_semi")
    plain = all(not k.startswith("map") and "variant" not in k for _, k in docs.dtypes)
    return stays.dropDuplicates() if plain else stays
