import re

import pytest

from tests.llm.data import docs, rows
from zonepulse.llm import quality_rules as q


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, cover = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            cover |= {p + k for p in at for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover), n < 50 or 100 * len(cover) > 50 * n)


def test_counts_of_awkward_texts(spark):
    found = q.judge(docs(spark)).collect()
    got = sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found)
    assert got == sorted((r[0] or 0, *base(r[1])) for r in rows())
    assert all(not r.kept for r in found if r.base_failed)


def test_empty_table_and_filter_keeps_columns(spark):
    assert q.judge(docs(spark, [])).count() == 0
    kept = q.filter_documents(docs(spark))
    assert kept.columns == docs(spark).columns
    verdict = {(r.doc_id, r.n_words) for r in q.judge(docs(spark)).filter("kept").collect()}
    assert {(r.doc_id, base(r.text)[0]) for r in kept.collect()} == verdict
    assert sum(r.doc_id == 2 for r in kept.collect()) == 2  # repeated rows are treated alike


def test_sketches_merge(spark):
    whole = q.shares(q.measure(docs(spark), ["doc_id", "lang", "source"]))
    parts = [q.sketch(whole.filter(f"coalesce(doc_id, 0) % 3 = {k}")) for k in range(3)]
    as_set = lambda df: {tuple(r) for r in df.select("lang", "source", "measure", "bucket", "n").collect()}
    assert as_set(q.merge(*parts)) == as_set(q.sketch(whole))


@pytest.mark.parametrize("value", [0, 1, 63, 64, 65, 127, 1000, 123456])
def test_buckets_are_narrow(spark, value):
    from pyspark.sql import functions as F

    low = spark.range(1).select(q.bucket(F.lit(value).cast("bigint"))).first()[0]
    assert low <= value and (value - low) * 32 <= value


def test_threshold_follows_the_source(spark):
    """The same share of symbols is usual in one source and unusual in the other."""
    plain = "".join(f"word{i} other{i} thing{i} " for i in range(30))
    marked = "".join(f"word{i}& other{i}& thing{i}& " for i in range(30))
    some = [(i, marked if s == "code" else plain, "en", s, 0, "", "", "", "") for i, s in enumerate(["code", "web"] * 300)]
    some.append((9999, marked, "en", "web", 0, "", "", "", ""))
    found = {r.doc_id: r for r in q.judge(docs(spark, some), q.Rules(min_words=10)).collect()}
    assert found[0].kept and found[1].kept
    assert not found[9999].kept and "symbols" in found[9999].broken


def test_words_that_are_far_too_short_go(spark):
    usual = "".join(f"word{i} other{i} thing{i} " for i in range(30))
    short = "".join(f"{chr(97 + i)} {i} {chr(97 + j)} " for i in range(26) for j in range(3))
    some = [(i, usual, "en", "web", 0, "", "", "", "") for i in range(300)] + [(9999, short, "en", "web", 0, "", "", "", "")]
    found = {r.doc_id: r for r in q.judge(docs(spark, some), q.Rules(min_words=10, max_repeat_share=100)).collect()}
    assert found[0].kept and "word_length" in found[9999].broken


def test_fences_follow_the_given_table(spark):
    """Fences differ between groups in more than one measure, and bad documents go while good ones stay."""
    path = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{path}/documents.parquet")
    found = q.thresholds(q.sketch(q.shares(q.measure(table, ["doc_id", "lang", "source"])))).collect()
    differ = [m for m in q.MEASURES if len({r[f"t_{m}"].high for r in found}) > 1]
    assert {"word_length", "upper", "dup_lines", "repeat_words"} <= set(differ)
    assert len({r["t_word_length"].low for r in found}) > 1
    judged = q.judge(table).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").filter("quality IS NOT NULL AND NOT base_failed")
    bad, good = (judged.filter(f"quality = {k}").selectExpr("count(*)", "count_if(kept)").first() for k in (0, 1))
    assert bad[1] == 0 and good[0] - good[1] <= 11
