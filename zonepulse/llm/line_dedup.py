"""Lines that recur across documents, by keys that generalise variable fields.

A log-template tree files a line under its number of tokens and its leading tokens and opens the fields that vary.
Here no tree is built: a line has a fixed number of keys, and no two lines are ever compared. The first key is the line
with ``<*>`` for every token with a digit; long lines also have four keys with the leading tokens and one fixed
quarter of the others open. A key that at least ``min_docs`` documents have recurs: its lines stay in the first document
that has them and go everywhere else. A line that varies elsewhere is not caught.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.functions.plan import evaluate_once
from zonepulse.llm.common import named, per_batch, salted_join
from zonepulse.sources.scratch import materialize

FIELD = "<*>"
_LETTER = regex.compile(rb"[A-Za-z\x80-\xff]")
_DIGIT = regex.compile(rb"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*")


@dataclass(frozen=True)
class Keys:
    """``min_docs``: documents that make a template recur; ``min_tokens``: shorter lines are left alone, unless
    ``short``: then they recur as they stand, fields with digits too; ``lead``: leading tokens on the path;
    ``open_from``: tokens from which a quarter may be open. With ``pairs``, a line of ``long_tokens`` tokens, or of
    ``long_bytes`` where there are few spaces, recurs from two documents on that have it word for word. With
    ``constant``, a template needs a letter outside its fields, else lines recur only as they stand."""

    min_docs: int = 3
    min_tokens: int = 3
    lead: int = 3
    open_from: int = 12
    short: bool = False
    pairs: bool = False
    long_tokens: int = 20
    long_bytes: int = 120
    constant: bool = False


#: Every line that is not blank may recur, however few tokens it has (text without spaces has one token a line), and
#: a passage that two documents share does; rows of numbers are told apart by their numbers.
WHOLE = Keys(short=True, pairs=True, constant=True)


def templates(line: bytes, rules: Keys) -> list[bytes]:
    """The templates of a line: its exact one first, then those with one quarter open; short lines have at most one."""
    tokens = _DIGIT.sub(FIELD.encode(), line).split()
    n = len(tokens)
    if n < rules.min_tokens:
        return [b" ".join(line.split())] if n and rules.short else []
    out = [b" ".join(tokens)]
    if n >= rules.open_from:
        rest = n - rules.lead
        for q in range(4):
            a, b = rules.lead + rest * q // 4, rules.lead + rest * (q + 1) // 4
            out.append(b" ".join(tokens[:a] + [b"<%d>" % (b - a)] + tokens[b:]))
    if rules.constant:
        out = [t if _LETTER.search(t) else b" ".join(line.split()) for t in out[:1]] + [t for t in out[1:] if _LETTER.search(t)]
    return out


def passage(line: bytes, rules: Keys) -> bytes | None:
    """What makes a long line recur from two documents on: all its tokens, numbers too; none for other lines."""
    tokens = line.split() if rules.pairs else []
    if len(tokens) >= rules.long_tokens or tokens and len(line) >= rules.long_bytes:
        return b"\n" + b" ".join(tokens)  # unlike any template
    return None


def line_keys(docs: DataFrame, rules: Keys) -> DataFrame:
    """(row, doc_id, key, least, at): the keys of every document's lines, from how many documents on they recur, and the
    lines they stand for, each key once."""
    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, ids, keys, leasts, ats = [], [], [], [], []
            for row, doc_id, text in zip(batch["row"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                places: dict[tuple[int, int], list[int]] = {}
                if text:
                    seen: dict[bytes, list[tuple[int, int]]] = {}
                    for i, line in enumerate(text.encode("utf-8", "replace").split(b"\n")):
                        if (known := seen.get(line)) is None:
                            known = seen[line] = [(xxhash.xxh3_64_intdigest(t) - (1 << 63), rules.min_docs) for t in templates(line, rules)]
                            if (whole := passage(line, rules)) is not None:
                                known.append((xxhash.xxh3_64_intdigest(whole) - (1 << 63), 2))
                        for key in known:
                            places.setdefault(key, []).append(i)
                rows += [row] * len(places)
                ids += [doc_id] * len(places)
                keys += [key for key, _ in places]
                leasts += [least for _, least in places]
                ats += places.values()
            return pa.record_batch({
                "row": pa.array(rows, pa.int64()), "doc_id": pa.array(ids, pa.int64()), "key": pa.array(keys, pa.int64()), "least": pa.array(leasts, pa.int32()), "at": pa.array(ats, pa.list_(pa.int32())),
            })

        return step

    return docs.mapInArrow(per_batch(make), "row bigint, doc_id bigint, key bigint, least int, at array<int>")


def _numbered(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``row``, which tells rows apart by id and text; equal rows are one document."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("row"))


def dropped_lines(docs: DataFrame, rules: Keys = Keys()) -> DataFrame:
    """(row, lines): for every document that loses lines, their sorted places, counted from 0."""
    keys = materialize(line_keys(_numbered(docs), rules), "lines")
    # a null id owns lines only where no other document has them
    owner = F.min(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("d"), F.col("row").alias("r")))
    recurring = keys.groupBy("key", "least").agg(F.count("*").alias("n_docs"), owner.alias("owner")).filter(F.col("n_docs") >= F.col("least"))
    recurring = recurring.select(F.col("key").alias("of"), F.col("owner.r").alias("first"))
    hit = salted_join(keys, recurring, lambda a, b: (a["key"] == b["of"]) & (a["row"] != b["first"]), F.col("row"), "inner")
    return hit.groupBy("row").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("at")))).alias("lines"))


def deduplicate(docs: DataFrame, rules: Keys = Keys()) -> DataFrame:
    """All rows and columns of ``docs``; ``text`` without the lines that recur elsewhere, and two counts.

    Added are ``n_lines`` and ``n_dropped`` (under other names if these are taken). Null texts stay null and have no
    lines; a text all of whose lines go becomes empty; equal rows are treated alike, so a repeated row
    keeps what its twin keeps. The order of kept lines does not change. An empty table gives no rows.
    """
    row, lines, parts, text = named("row", docs.columns), named("lines", docs.columns), named("parts", docs.columns), F.col("text")
    gone = dropped_lines(docs, rules).select(F.col("row").alias(row), F.col("lines").alias(lines))
    marked = docs.withColumn(row, F.xxhash64(F.col("doc_id").cast("bigint"), "text")).join(gone, row, "left")
    marked = evaluate_once(marked.withColumn(parts, F.split(text, "\n")))
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(lines))  # keeps the order
    left = F.array_join(F.transform(stay, lambda i: F.get(F.col(parts), i)), "\n")
    added = {
        _free("n_lines", docs): F.when(text.isNull(), 0).otherwise(F.size(parts)).cast("bigint"),
        _free("n_dropped", docs): F.coalesce(F.size(lines), F.lit(0)).cast("bigint"),
    }
    return marked.withColumns(added).withColumn("text", F.when(F.col(lines).isNull(), text).otherwise(left)).drop(row, lines, parts)


def _free(name: str, docs: DataFrame) -> str:
    return name if name not in {c.lower() for c in docs.columns} else named(name, docs.columns)


def clean_documents(docs: DataFrame, rules: Keys = Keys()) -> DataFrame:
    """The documents with their own columns, their texts without recurring lines; rows left without any text by that go."""
    done = deduplicate(docs, rules)
    dropped = _free("n_dropped", docs)
    return done.filter((F.col(dropped) == 0) | (F.trim("text") != "")).select(*[done[c] for c in docs.columns])


def oracle_sql(rules: Keys = Keys()) -> str:
    """doc_id, n_lines, n_dropped and the kept text's checksum, with templates written out, in DuckDB SQL."""
    lead = rules.lead
    masked, plain = "array_to_string(k, ' ')", "array_to_string(w, ' ')"
    letter = (lambda key: f"regexp_matches({key}, '[A-Za-z]|[^\\x00-\\x7F]')") if rules.constant else (lambda key: "true")
    first = f"CASE WHEN len(k) >= {rules.min_tokens} THEN CASE WHEN {letter(masked)} THEN {masked} ELSE {plain} END {f'ELSE {plain}' if rules.short else ''} END"
    keys = [f"struct_pack(key := {first}, least := {rules.min_docs})"]
    for q in range(4):
        start, end = f"{lead} + (len(k) - {lead}) * {q} // 4", f"{lead} + (len(k) - {lead}) * {q + 1} // 4"
        part = f"(array_to_string(k[:{start}], ' ') || ' <' || (({end}) - ({start})) || '> ' || array_to_string(k[{end} + 1:], ' '))"
        key = f"CASE WHEN len(k) >= greatest({rules.open_from}, {rules.min_tokens}) AND {letter(part)} THEN {part} END"
        keys.append(f"struct_pack(key := {key}, least := {rules.min_docs})")
    if rules.pairs:
        keys.append(f"struct_pack(key := CASE WHEN len(k) >= {rules.long_tokens} OR strlen(line) >= {rules.long_bytes} THEN chr(10) || {plain} END, least := 2)")
    return f"""
    WITH src AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
    lines AS (SELECT rid, doc_id, generate_subscripts(ls, 1) - 1 AS i, unnest(ls) AS line FROM (SELECT rid, doc_id, string_split(text, chr(10)) AS ls FROM src)),
    toks AS (SELECT *, list_transform(w, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{FIELD}' ELSE x END) AS k FROM
             (SELECT *, list_filter(string_split_regex(line, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM lines)),
    keys AS (SELECT rid, doc_id, i, e.key AS key, e.least AS least FROM (SELECT rid, doc_id, i, unnest([{', '.join(keys)}]) AS e FROM toks WHERE len(w) > 0) WHERE e.key IS NOT NULL),
    often AS (SELECT key, least, arg_min(rid, (coalesce(doc_id, 9223372036854775807), rid)) AS first FROM (SELECT DISTINCT key, least, rid, doc_id FROM keys)
              GROUP BY key, least HAVING count(*) >= least),
    gone AS (SELECT DISTINCT rid, i FROM keys JOIN often USING (key, least) WHERE rid <> first),
    counts AS (SELECT rid, count(*) AS n FROM gone GROUP BY rid),
    kept AS (SELECT rid, string_agg(line, chr(10) ORDER BY i) AS t FROM lines ANTI JOIN gone USING (rid, i) GROUP BY rid)
    SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_dropped,
           CASE WHEN text IS NULL THEN NULL ELSE md5(coalesce(t, '')) END AS text_md5
    FROM src LEFT JOIN counts USING (rid) LEFT JOIN kept USING (rid)"""
