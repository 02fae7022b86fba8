"""Quality rules whose thresholds follow the corpus: quantile sketches per language and source.

Every document gets a few scaled shares (symbols, repeated words, ...). Their distribution within each
language and source is kept as a mergeable quantile sketch: a log-linear histogram, whose rows are
(language, source, measure, bucket, count). Sketches merge by adding counts, so partitions, days or
sources can be combined in any order and the result is always the same; a bucket is at most 1/32 wide
relative to its value, and a sketch has at most a few hundred rows however large the group. The fences
of a measure lie a multiple of its interquartile range outside its quartiles. Most documents have no symbol and no
repeated line, so the range of such measures is often 0; a handful of occurrences in a document of the group's median
size then takes its place, so the fences of groups with short documents are wider. Groups with few documents
take the merged sketch of their language, and small languages that of the whole corpus.

The main path is DataFrame expressions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from zonepulse.functions.plan import evaluate_once
from zonepulse.llm.common import named, salted_join, words
from zonepulse.sources.scratch import materialize

#: Shares with fences, in thousandths: the part, the whole, and how many of the part are nothing special in a document
#: of usual size (18 repeated words: a phrase of nine said twice).
MEASURES = {
    "word_length": ("word_chars", "n_words", 0), "symbols": ("n_symbols", "word_chars", 5), "upper": ("_upper", "word_chars", 8),
    "marks": ("_marks", "word_chars", 5), "dup_lines": ("n_dup_lines", "_n_lines", 1), "repeat_words": ("n_repeat_words", "n_words", 18),
}
#: Wholes that are sketched as well, for their medians; they follow the measures in number.
WHOLES = ("n_words", "word_chars", "_n_lines")
_ROW_BYTES, _SENT_BYTES = 300, 8 << 20  # a row of thresholds without its names; thresholds up to this size are sent to every task
_EXACT = 64  # values below are their own bucket; above, five bits after the leading one are kept


@dataclass(frozen=True)
class Rules:
    """``reach``: spreads between a quartile and its fence; ``least`` and ``relative``: the least spread, in thousandths
    and in thousandths of the median; ``min_docs``: documents that a group needs to have thresholds of its own."""

    min_words: int = 50
    max_repeat_share: int = 50
    reach: int = 5
    least: int = 5
    relative: int = 25
    min_docs: int = 200


def _removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def measure(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and the base counts of every whole text.

    A null or empty text has no words and all counts 0. ``n_repeat_words`` counts the words covered by
    three-word windows that occur at least twice in the text; windows are compared by a 64-bit hash.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = evaluate_once(docs.select(
        *[F.col(c) for c in keep], words(F.col("text")).alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        _removed(text, "#*$%&|<>").cast("long").alias("n_symbols"),
        _removed(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("_upper"),
        _removed(text, "!?").cast("long").alias("_marks"),
    ))
    w = F.col("_words")
    counts = ["word_chars", "n_symbols", "_upper", "_marks"]
    windows = evaluate_once(split.select(
        *[F.col(c) for c in keep], *counts, F.size(w).cast("long").alias("n_words"), F.size("_lines").cast("long").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(w) >= 3, F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )).otherwise(F.array().cast("array<bigint>")).alias("_windows"),
    ))
    counts += ["n_words", "_n_lines", "n_dup_lines"]
    # only texts with a repeated window are sorted
    h = F.col("_windows")
    ordered = evaluate_once(windows.select(
        *[F.col(c) for c in keep], *counts,
        F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("_ordered"),
    ))
    o = F.col("_ordered")

    def twice(s: Column, k: Column) -> Column:
        same = lambda at: F.coalesce(F.get(o, at)["h"] == s["h"], F.lit(False))
        return same(k - 1) | same(k + 1)

    starts = evaluate_once(ordered.select(
        *[F.col(c) for c in keep], *counts, F.sort_array(F.transform(F.filter(o, twice), lambda s: s["i"])).alias("_starts"),
    ))
    s = F.col("_starts")
    covered = F.aggregate(
        F.transform(s, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(s, k + 1), x + 3) - x)), F.lit(0), lambda a, x: a + x,
    )
    return starts.select(*[F.col(c) for c in keep], *counts, covered.cast("long").alias("n_repeat_words"))


def shares(measured: DataFrame) -> DataFrame:
    """The measures in thousandths, whole numbers; 0 where the whole is empty."""
    def of(part: str, whole: str) -> Column:
        return F.expr(f"CASE WHEN {whole} > 0 THEN ({part} * 1000) DIV {whole} ELSE 0L END")

    return measured.withColumns({m: of(part, whole) for m, (part, whole, _) in MEASURES.items()})


def bucket(value: Column) -> Column:
    """Lowest value of the sketch bucket that holds ``value`` (a whole number, 0 or more)."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.when(value < _EXACT, value).otherwise(F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift))


def sketch(rows: DataFrame) -> DataFrame:
    """Quantile sketches of all measures and wholes per language and source: (lang, source, measure, bucket, n)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("measure"), bucket(F.col(m)).alias("bucket")) for i, m in enumerate([*MEASURES, *WHOLES])]))
    return rows.select("lang", "source", pairs.alias("p")).groupBy("lang", "source", "p.measure", "p.bucket").agg(F.count("*").alias("n"))


def merge(*sketches: DataFrame) -> DataFrame:
    """One sketch table from several, as if it had been built from all their rows at once."""
    total = sketches[0]
    for s in sketches[1:]:
        total = total.unionByName(s)
    return total.groupBy("lang", "source", "measure", "bucket").agg(F.sum("n").alias("n"))


def _fences(sketches: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    """Lowest and highest usual value of every group of ``keys`` and measure, and the group's size."""
    merged = sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "measure")
    ranked = merged.select(*keys, "measure", "bucket", F.sum("n").over(w).alias("total"), F.sum("n").over(w.orderBy("bucket")).alias("upto"))

    def quantile(part: int) -> Column:  # lowest bucket that at least part/4 of the rows do not exceed
        return F.min(F.when(F.col("upto") * 4 >= F.col("total") * part, F.col("bucket")))

    q = ranked.groupBy(*keys, "measure").agg(quantile(1).alias("q1"), quantile(2).alias("q2"), quantile(3).alias("q3"), F.max("total").alias("total"))
    # at most nine rows of a group meet here
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    sizes = F.array(*[F.max(F.when(F.col("measure") == len(MEASURES) + i, F.col("q2"))).over(group) for i in range(len(WHOLES))])
    whole = F.array(*[F.lit(WHOLES.index(w)) for _, w, _ in MEASURES.values()])
    few = F.array(*[F.lit(n) for _, _, n in MEASURES.values()])
    q = q.withColumns({"size": F.get(sizes, F.get(whole, F.col("measure"))), "few": F.get(few, F.col("measure"))}).filter(F.col("measure") < len(MEASURES))
    spread = F.expr(f"greatest(q3 - q1, {rules.least}L, (q2 * {rules.relative}) DIV 1000, (few * 1000L) DIV greatest(size, 1L))")
    return q.withColumn("reach", spread * rules.reach).select(*keys, "measure", "total", F.struct((F.col("q1") - F.col("reach")).alias("low"), (F.col("q3") + F.col("reach")).alias("high")).alias("fence"))


def thresholds(sketches: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Fences (``low``, ``high``) for every (lang, source) of the sketches: its own, its language's or the corpus's."""
    own = _fences(sketches, ["lang", "source"], rules)
    by_lang = _fences(sketches, ["lang"], rules).toDF("l_lang", "l_measure", "l_total", "l_fence")
    overall = _fences(sketches, [], rules).toDF("a_measure", "a_total", "a_fence")
    joined = own.join(by_lang, own["lang"].eqNullSafe(by_lang["l_lang"]) & (own["measure"] == by_lang["l_measure"]), "left")
    joined = joined.join(overall, joined["measure"] == overall["a_measure"], "left")
    fence = F.when(F.col("total") >= rules.min_docs, F.col("fence")).when(F.col("l_total") >= rules.min_docs, F.col("l_fence")).otherwise(F.col("a_fence"))
    return joined.groupBy(F.col("lang").alias("t_lang"), F.col("source").alias("t_source")).agg(
        *[F.max(F.when(F.col("measure") == i, fence)).alias(f"t_{m}") for i, m in enumerate(MEASURES)],
    )


def _with_ids(docs: DataFrame) -> DataFrame:
    """The columns that the rules read; a missing language or source column counts as null."""
    have = {c.lower() for c in docs.columns}
    return docs.select("doc_id", "text", *[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in ("lang", "source")])


def _verdict(rules: Rules) -> tuple[Column, Column]:
    """Whether the base rules fail, and the measures outside their fences, of a row with counts and thresholds."""
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_share * F.col("n_words"))
    broken = F.array_compact(F.array(*[F.when((F.col(m) < F.col(f"t_{m}.low")) | (F.col(m) > F.col(f"t_{m}.high")), F.lit(m)) for m in MEASURES]))
    return failed, broken


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per input row: doc_id, the base counts, ``base_failed``, ``kept`` and ``broken`` (measures outside their fences).

    Null language or source form groups of their own; repeated rows count and are judged each on their own;
    null and empty texts fail the base rules; an empty table gives no rows; a very long text counts whole, as any other
    does. The text is read once: its counts are kept as a narrow table, from which both the sketches and the joined filter are made.
    """
    measured = materialize(shares(measure(_with_ids(docs), ["doc_id", "lang", "source"])), "quality")
    table = thresholds(sketch(measured), rules)
    # a group's thresholds meet its rows in as many tasks as there are salts, so a hot source is split
    joined = salted_join(
        measured, table, lambda a, b: a["lang"].eqNullSafe(b["t_lang"]) & a["source"].eqNullSafe(b["t_source"]), F.struct("doc_id", "word_chars", "n_words"), "left",
    )
    failed, broken = _verdict(rules)
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.size(broken) == 0)).alias("kept"), F.concat_ws(",", broken).alias("broken"),
    )


def filter_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that the rules keep, with all their columns and nothing else.

    The counts are written beside the whole row, so the verdict is a condition on the row itself: no text is shuffled or
    joined back while the thresholds are few, and repeated ids and nulls need no care.
    """
    row = named("row", [*docs.columns, *MEASURES])
    whole = docs.withColumn(row, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    have = {c.lower() for c in docs.columns}
    read = whole.select("text", row, *[F.col(c).cast("string") if c in have else F.lit(None).cast("string").alias(c) for c in ("lang", "source")])
    measured = materialize(shares(measure(read, [row, "lang", "source"])), "quality")
    table = materialize(thresholds(sketch(measured), rules), "fences")
    on = lambda a, b: a["lang"].eqNullSafe(b["t_lang"]) & a["source"].eqNullSafe(b["t_source"])
    name = lambda c: F.coalesce(F.octet_length(c), F.lit(0))
    size = table.agg(F.sum(_ROW_BYTES + name("t_lang") + name("t_source"))).first()[0] or 0
    joined = measured.join(F.broadcast(table), on(measured, table), "left") if size <= _SENT_BYTES else salted_join(measured, table, on, F.struct(f"{row}.doc_id", "word_chars", "n_words"), "left")
    failed, broken = _verdict(rules)
    return joined.filter(~failed & (F.size(broken) == 0)).select(f"{row}.*")


def oracle_sql(rules: Rules = Rules()) -> str:
    """The same rows in DuckDB SQL, stated with lists and plain joins."""
    own = {"_upper": "up", "_marks": "marks_n", "_n_lines": "n_lines"}
    per = {m: (own.get(part, part), own.get(whole, whole), few) for m, (part, whole, few) in MEASURES.items()}
    cases = ", ".join(f"CASE WHEN {b} > 0 THEN ({a} * 1000) // {b} ELSE 0 END AS {m}" for m, (a, b, _) in per.items())
    sizes = {w: own.get(w, w) for w in WHOLES}
    long = " UNION ALL ".join(f"SELECT rid, lang, source, '{m}' AS m, {v} AS v FROM shares" for m, v in [*zip(MEASURES, MEASURES), *[(f"size {v}", v) for v in sizes.values()]])

    def level(name: str, keys: str) -> str:
        part = f"{keys}, m" if keys else "m"
        same = "".join(f" AND s.{k} IS NOT DISTINCT FROM q.{k}" for k in keys.split(", ") if k)
        rules_of = ", ".join(f"('{m}', 'size {w}', {few})" for m, (_, w, few) in per.items())
        return f"""
    {name}_c AS (SELECT {part}, b, count(*) AS n FROM buckets GROUP BY ALL),
    {name}_r AS (SELECT *, sum(n) OVER (PARTITION BY {part}) AS total, sum(n) OVER (PARTITION BY {part} ORDER BY b) AS upto FROM {name}_c),
    {name}_q AS (SELECT {part}, max(total) AS total, min(b) FILTER (upto * 4 >= total) AS q1, min(b) FILTER (upto * 4 >= total * 2) AS q2,
                 min(b) FILTER (upto * 4 >= total * 3) AS q3 FROM {name}_r GROUP BY {part}),
    {name} AS (SELECT q.*, {rules.reach} * greatest(q.q3 - q.q1, {rules.least}, (q.q2 * {rules.relative}) // 1000, (few * 1000) // greatest(s.q2, 1)) AS reach
               FROM {name}_q q JOIN (VALUES {rules_of}) r(m, whole, few) ON r.m = q.m JOIN {name}_q s ON s.m = r.whole{same})"""

    def pick(side: str) -> str:
        ways = {name: f"{name}.{side.format(name)}" for name in ("f2", "f1", "f0")}
        return f"CASE WHEN f2.total >= {rules.min_docs} THEN {ways['f2']} WHEN f1.total >= {rules.min_docs} THEN {ways['f1']} ELSE {ways['f0']} END"

    gap = r"[\x20\x09-\x0D]+"
    return f"""
    WITH src AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, list_filter(string_split_regex(t, '{gap}'), lambda x: x <> '') AS ws,
          list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM src),
    win AS (SELECT rid, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
    twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM win) WHERE n > 1),
    rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
    base AS (SELECT w.rid, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '{gap}', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS up,
             (length(t) - length(regexp_replace(t, '[!?]', '', 'g')))::BIGINT AS marks_n,
             len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
             FROM w LEFT JOIN rep ON rep.rid = w.rid),
    shares AS (SELECT *, {cases} FROM base),
    long AS ({long}),
    buckets AS (SELECT *, CASE WHEN v < 64 THEN v ELSE (v >> (length(bin(v)) - 6)) << (length(bin(v)) - 6) END AS b FROM long),
    {level("f2", "lang, source")}, {level("f1", "lang")}, {level("f0", "")},
    verdict AS (
      SELECT long.rid, string_agg(long.m, ',' ORDER BY CASE long.m {' '.join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(MEASURES))} END) AS broken
      FROM long JOIN f2 ON f2.lang IS NOT DISTINCT FROM long.lang AND f2.source IS NOT DISTINCT FROM long.source AND f2.m = long.m
      JOIN f1 ON f1.lang IS NOT DISTINCT FROM long.lang AND f1.m = long.m JOIN f0 ON f0.m = long.m
      WHERE long.v NOT BETWEEN {pick('q1 - {0}.reach')} AND {pick('q3 + {0}.reach')} GROUP BY long.rid)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_share} * n_words AS base_failed,
           NOT (n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_share} * n_words) AND verdict.rid IS NULL AS kept,
           coalesce(verdict.broken, '') AS broken
    FROM base LEFT JOIN verdict ON verdict.rid = base.rid"""
