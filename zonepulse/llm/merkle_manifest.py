"""Merkle manifest of a dataset, with proofs by pointer jumping.

Every row is a leaf; the leaves of a language form a tree whose runs of eight neighbours are hashed together, and the
roots of the languages form the top tree. Each node first holds the siblings that lead to its parent. Joining the
node table with itself doubles the distance: a node takes over its ancestor's ancestor and appends its segment, so
after a logarithm of the depth every leaf holds the siblings up to the root.

Positions come from a range partitioning, not from a window over a language, so a language of any size is spread over
all tasks. Only digests are shuffled, never texts. Where very many nodes have one ancestor, its row is dealt over salts whose
number follows from the distance.

Defined results: null columns count as ``-``; a null language is a tree of its own, the first one; rows that repeat an id
are leaves in the order of their digests; texts are hashed whole, whatever their length; an empty table gives no rows;
columns beyond the five are not read, so names cannot clash.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonepulse.sources.scratch import broadcast_if_small, materialize

#: Nodes that are hashed together.
RUN = 8
_TOP = "*"  # the tree over the languages; a language's own tree is named "+" and the language, "" for null
_FANOUT = 100_000  # nodes that may meet one row of an ancestor in a task
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_PATH = "CAST(array() AS array<struct<left:binary,right:binary>>)"


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], _field(text)), 256))


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, digest, ...) with ``pos``, the place in the tree by ``order``, and ``size``, the tree's rows.

    Rows are dealt by ranges of (tree, order); a row's place is its place within its partition plus the rows of
    the partitions before. The dealt rows are written, so later jobs see the same partitions.
    """
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    dealt = materialize(dealt.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "placed")
    parts = dealt.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    own = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(own).alias("size"))
    # one row per partition and tree in it
    return dealt.join(broadcast_if_small(parts), ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _levels(leaves: DataFrame, extra: list[str]) -> list[DataFrame]:
    """The runs of each level as (tree, size, run, kids, digest), written; ``leaves``: tree, pos, size, digest, extra columns."""
    most, level, out = leaves.agg(F.max("size")).first()[0] or 0, 0, []
    nodes = leaves
    while most > 1:
        kid = F.struct("pos", "digest", *(extra if level == 0 else []))
        runs = nodes.filter("size > 1").groupBy("tree", "size", F.expr(f"pos div {RUN}").alias("run")).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
        joined = F.array_join(F.transform("kids", lambda k: _hex(k["digest"])), "")
        out.append(materialize(runs.withColumn("digest", F.unhex(F.sha2(joined, 256))), "runs"))
        nodes = out[-1].select("tree", F.col("run").alias("pos"), F.expr(f"(size + {RUN - 1}) div {RUN}").alias("size"), "digest")
        level, most = level + 1, -(-most // RUN)
    return out


def _steps(runs: DataFrame, level: int, extra: list[str]) -> DataFrame:
    """One row per child: its own place, that of its parent and the path of one step: the siblings to its left and right."""
    kids = runs.select("tree", "size", "run", "kids", F.posexplode("kids").alias("i", "kid"))

    def side(start: Column, length: Column) -> Column:
        return F.aggregate(F.slice("kids", start, length), F.lit(b""), lambda a, k: F.concat(a, k["digest"]))

    step = F.struct(side(F.lit(1), F.col("i")).alias("left"), side(F.col("i") + 2, F.size("kids")).alias("right"))
    return kids.select(
        "tree", F.lit(level).alias("level"), F.col("kid.pos").alias("pos"), F.col("size"), F.col("run").alias("up_pos"),
        F.array(step).alias("path"), F.col("kid.digest").alias("digest"), *[F.col(f"kid.{c}").alias(c) for c in extra],
    )


def _nodes(leaves: DataFrame, low: list[DataFrame], high: list[DataFrame], tops: DataFrame, about: list[str]) -> DataFrame:
    """Every node but the root with its first step; the last node of a language's tree leads on to its place in the top tree."""
    place = broadcast_if_small(tops.select(F.col("name").alias("of"), F.col("pos").alias("place"), F.col("digest").alias("subroot")))
    lone = leaves.filter("size = 1").select("tree", F.lit(0).alias("level"), "pos", "size", F.lit(0).cast("bigint").alias("up_pos"), F.expr(_NO_PATH).alias("path"), "digest", *about)
    nodes = lone
    for k, runs in enumerate(low):
        nodes = nodes.unionByName(_steps(runs, k, about if k == 0 else []), allowMissingColumns=True)
    ends = F.col("size") <= RUN
    nodes = nodes.join(place, F.col("tree") == F.col("of")).withColumns({
        "up_tree": F.when(ends, F.lit(_TOP)).otherwise(F.col("tree")), "up_level": F.when(ends, 0).otherwise(F.col("level") + 1),
        "up_pos": F.when(ends, F.col("place")).otherwise(F.col("up_pos"))}).drop("of", "place")
    for k, runs in enumerate(high):
        step = _steps(runs, k, []).withColumns({"up_tree": F.col("tree"), "up_level": F.lit(k + 1)})
        nodes = nodes.unionByName(step, allowMissingColumns=True)
    return nodes.drop("size").withColumn("done", (F.col("up_tree") == _TOP) & (F.col("up_level") == len(high)))


def _jump(nodes: DataFrame, distance: int, rows: int, height: int) -> DataFrame:
    """Every node goes on from its ancestor to that one's ancestor and appends its path; those at the root stay."""
    salts = max(1, ceil(min(RUN**distance, rows) / _FANOUT))
    ends = nodes.filter((F.col("tree") == _TOP) | (F.col("level") >= distance)).select(
        F.col("tree").alias("t"), F.col("level").alias("l"), F.col("pos").alias("p"), F.col("up_tree").alias("t2"), F.col("up_level").alias("l2"),
        F.col("up_pos").alias("p2"), F.col("path").alias("more"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    going = nodes.filter("NOT done").withColumn("of", F.pmod(F.xxhash64("tree", "level", "pos"), F.lit(salts)).cast("int"))
    met = going.join(ends, (F.col("up_tree") == F.col("t")) & (F.col("up_level") == F.col("l")) & (F.col("up_pos") == F.col("p")) & (F.col("of") == F.col("salt")))
    far = met.withColumns({"up_tree": F.col("t2"), "up_level": F.col("l2"), "up_pos": F.col("p2"), "path": F.concat("path", "more")})
    far = far.withColumn("done", (F.col("up_tree") == _TOP) & (F.col("up_level") == height))
    return nodes.filter("done").unionByName(far.select(*nodes.columns))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, leaf, tampered, subroot, root (digests as bytes) and path.

    ``tampered`` is the leaf after tampering, null where nothing is tampered with; ``path`` holds, from the leaf up
    to the root, the digests left and right of the way.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "lang", "n_chars", "text")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = docs.select(
        F.coalesce(F.concat(F.lit("+"), "lang"), F.lit("")).alias("tree"), "doc_id", "lang", _leaf(F.col("text")).alias("digest"),
        F.when(hit, _leaf(F.translate("text", _UPPER, _LOWER))).alias("tampered"))
    about = ["doc_id", "lang", "tampered"]
    leaves = _placed(rows, ["doc_id", "digest"])
    low = _levels(leaves, about)
    heads = leaves.filter("size = 1").select("tree", "digest")
    for runs in low:
        heads = heads.union(runs.filter(F.col("size") <= RUN).select("tree", "digest"))
    tops = materialize(_placed(heads.select(F.lit(_TOP).alias("tree"), F.col("tree").alias("name"), "digest"), ["name"]), "tops")
    high = _levels(tops, [])

    nodes = materialize(_nodes(leaves, low, high, tops, about), "nodes")
    count, distance = leaves.count(), 1
    while distance < max(len(low), 1) + len(high):
        nodes = materialize(_jump(nodes, distance, count, len(high)), "nodes")
        distance *= 2
    root = (high[-1] if high else tops).select("digest").first()  # one row, if there are any
    own = nodes.filter((F.col("tree") != _TOP) & (F.col("level") == 0))
    return own.select("doc_id", "lang", F.col("digest").alias("leaf"), "tampered", "subroot", F.lit(root and root[0]).cast("binary").alias("root"), "path")


def proofs(made: DataFrame) -> DataFrame:
    """The rows of ``manifest`` with digests in hex, the digest of each proof and the root that the proof gives.

    The fold starts from the tampered leaf where there is one, and never looks at the root.
    """
    siblings = F.array_join(F.transform("path", lambda s: _hex(F.concat(s["left"], s["right"]))), "")
    start = _hex(F.coalesce("tampered", "leaf"))
    folded = F.aggregate("path", start, lambda a, s: F.sha2(F.concat(_hex(s["left"]), a, _hex(s["right"])), 256))
    out = made.select("doc_id", *[_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")], F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_level(prefix: str, k: int) -> str:
    """Nodes of level ``k`` with the digests left and right of them, and the nodes of the next level."""
    run = f"PARTITION BY tree, pos // {RUN} ORDER BY pos ROWS BETWEEN"
    sides = f"""
{prefix}side{k} AS (SELECT tree, pos, n, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {prefix}{k})"""
    up = f"""
{prefix}{k + 1} AS (SELECT tree, pos // {RUN} AS pos, CASE WHEN n = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h, (n + {RUN - 1}) // {RUN} AS n
  FROM {prefix}{k} GROUP BY tree, pos // {RUN}, n)"""
    return sides + "," + up


def oracle_sql(low: int = 7, high: int = 3) -> str:
    """The contract as SQL, level by level; enough for 8^low rows of a language and 8^high languages."""
    field = "coalesce(strlen({0}) || ':' || {0}, '-')"
    parts = [field.format(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars")]

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(parts)} || {field.format(text)})"

    def fold(prefix: str, k: int, key: str, pos: str, before: str) -> str:
        return f"""
{before}f{k} AS (SELECT d.* REPLACE (CASE WHEN s.n = 1 THEN f ELSE sha256(s.l || f || s.r) END AS f, proof || s.l || s.r AS proof)
  FROM {before}f{k - 1 if k else ''} d JOIN {prefix}side{k} s ON s.tree = {key} AND s.pos = {pos} // {RUN**k})"""

    table = "list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)"
    crc = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, b: xor(c >> 8, entries[xor(c & 255, b) + 1])))"""
    made = [f"""
crc AS (SELECT list({table} ORDER BY i) AS entries FROM range(256) t(i)),
docs AS (SELECT doc_id, '+' || lang AS lang, {leaf('text')} AS leaf, CASE WHEN ({crc}) % 3 = 0 THEN {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS bad
  FROM documents, crc),
leaves AS (SELECT doc_id, coalesce(lang, '') AS tree, leaf, coalesce(bad, leaf) AS start,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM docs),
a0 AS (SELECT tree, pos, leaf AS h, n FROM leaves)"""]
    made += [_sql_level("a", k) for k in range(low)]
    made.append(f"""
b0 AS (SELECT '*' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, h, count(*) OVER () AS n, tree AS name FROM a{low})""")
    made += [_sql_level("b", k) for k in range(high)]
    made.append(f"""
lowf AS (SELECT doc_id, tree, leaf, leaves.pos, start AS f, '' AS proof FROM leaves)""")
    made += [fold("a", k, "d.tree", "d.pos", "low") for k in range(low)]
    made.append(f"""
highf AS (SELECT d.* REPLACE (b0.pos AS pos), b0.h AS subroot FROM lowf{low - 1} d JOIN b0 ON b0.name = d.tree)""")
    made += [fold("b", k, "'*'", "d.pos", "high") for k in range(high)]
    return f"""WITH {','.join(made)}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified FROM highf{high - 1}, b{high}"""
