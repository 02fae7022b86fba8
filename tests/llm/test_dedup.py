import collections
import random

import duckdb
import pytest

import corpus_pipeline
from tests.llm.data import docs, prose, rows
from tests.oracle import differences
from zonepulse.llm import line_dedup, near_duplicates
from zonepulse.llm.components import components


def sets(texts):
    out = []
    for text in texts:
        w = (text or "").encode().lower().split()
        out.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def brute(found: list[tuple], share: int = 75) -> collections.Counter:
    """(doc_id, n_shingles, component_id) by comparing everything with everything."""
    s, up = sets([t for _, t in found]), list(range(len(found)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for i in range(len(found)):
        for j in range(i):
            both = len(s[i] & s[j])
            if s[i] and s[j] and 100 * both >= share * (len(s[i]) + len(s[j]) - both):
                up[root(i)] = root(j)
    ids = collections.defaultdict(list)
    for i, (d, _) in enumerate(found):
        ids[root(i)].append(d)
    least = {r: min((d for d in x if d is not None), default=None) for r, x in ids.items()}
    return collections.Counter((d, len(s[i]), least[root(i)] if s[i] else d) for i, (d, _) in enumerate(found))


def test_near_duplicates_against_brute_force(spark):
    rnd, some = random.Random(2), [(i, t) for i, t, *_ in rows() if i != 16]
    base = [prose(120, 50 + k) for k in range(6)]
    for n in range(150):  # chains of edits around the limit, copies of copies
        words = base[n % 6].split()
        for _ in range(rnd.randint(0, 6)):
            words[rnd.randrange(len(words))] = f"new{rnd.randint(0, 9)}"
        base.append(" ".join(words))
        some.append((1000 + n, base[rnd.randrange(len(base))] if n % 3 else " ".join(words)))
    frame = docs(spark, [(i, t, "en", "s", 0, "", "", "", "") for i, t in some])
    found = near_duplicates.link(frame).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(some)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in found)
    kept = near_duplicates.filter_documents(frame)
    assert kept.columns == frame.columns
    want = collections.Counter({(r.doc_id, r.n_shingles) for r in found if r.kept})
    assert collections.Counter((r.doc_id, len(sets([r.text])[0])) for r in kept.collect()) == want


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates.link(docs(spark, [])).count() == 0
    blank = near_duplicates.link(docs(spark, [(1, None, None, None, 0, "", "", "", ""), (2, " ", None, None, 0, "", "", "", ""), (3, "", None, None, 0, "", "", "", "")])).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in blank} == {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randint(-50, 50), rnd.randint(-50, 50)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)] + [(7, 7)]
    up = {}
    root = lambda a: a if up.setdefault(a, a) == a else root(up[a])
    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert all(root(a) == found.get(a, a) for a in up)


@pytest.mark.parametrize("rules", [line_dedup.Keys(), line_dedup.WHOLE])
def test_lines_against_sql(spark, rules):
    twice = "a passage of the same words in two documents and in no other one, with 7 numbers 8 and 9 more words than that"
    odd = ["Les.", "Les.\n 12  34\n12 34 56", "Les.\n12 35\n12 34 56\n1 2 3 4 5 6 7 8 9 10 11 12 13", "12 34 56\nv1 v2 v3", "日本語の長い行" * 9, "日本語の長い行" * 9 + "\nv4 v5 v6", twice, "x\n" + twice, "v7 é v8\nv7 v8 v9", "v1 é v2", "v3 é v4"]
    frame = docs(spark, rows() + [(100 + i, t, None, None, 0, "", "", "", "") for i, t in enumerate(odd)])
    con = duckdb.connect()
    con.register("documents", frame.toArrow())
    done = line_dedup.deduplicate(frame, rules)
    assert set(done.columns) > set(frame.columns)
    from pyspark.sql import functions as F

    counts = [c for c in done.columns if c not in frame.columns]  # n_lines is taken, so it has another name
    as_named = done.select("doc_id", done[counts[0]].alias("n_lines"), done[counts[1]].alias("n_dropped"), F.md5("text").alias("text_md5"))
    distinct = "SELECT * FROM (" + line_dedup.oracle_sql(rules).replace("FROM documents", "FROM (SELECT DISTINCT doc_id, text FROM documents)") + ")"
    assert differences(as_named.distinct(), con, distinct) == []


def test_lines_stay_once_and_clean_documents_stay(spark):
    frame = docs(spark)
    kept = {r.doc_id: r.text for r in line_dedup.clean_documents(frame).collect()}
    texts = dict((i, t) for i, t, *_ in rows())
    assert 12 not in kept and kept[4] is None and kept[5] == ""  # 12 had only lines that 9 keeps
    assert kept[9] == texts[9] and kept[11] == texts[11].split("\n")[0]
    assert kept[13] == texts[13] and kept[14] == "y" and kept[15] == "z"  # fields with digits are variable
    assert kept[16] == texts[16]
    assert line_dedup.clean_documents(docs(spark, [])).count() == 0


def test_one_open_quarter(spark):
    line = "The committee of the {} met on Monday and took note of the report that was laid before it"
    some = [(i, line.format(w), "en", "s", 0, "", "", "", "") for i, w in enumerate(["house", "senate", "council", "board"])]
    some.append((9, "The committee of the house came together for quite other reasons than those that are given here", "en", "s", 0, "", "", "", ""))
    assert {r.doc_id for r in line_dedup.clean_documents(docs(spark, some)).collect()} == {0, 9}


def left_by_pipeline(spark, texts: list[str]) -> dict[int, str]:
    frame = docs(spark, [(i, t, "en", "s", 0, "", "", "", "") for i, t in enumerate(texts)])
    return {r.doc_id: r.text for r in corpus_pipeline.lines(spark, frame, "").collect()}


def test_short_lines_recur_in_the_pipeline(spark):
    unspaced = "本页面的全部内容均由用户提供" * 4
    texts = [f"{prose(9, 70 + i)}\nLes.\n \nAnd  ornd.\nPage {i}\n{unspaced}\n" for i in range(4)]
    left = left_by_pipeline(spark, [*texts, "rare.\nx", "rare.\ny"])
    assert left[0] == texts[0] and left[4] == "rare.\nx" and left[5] == "rare.\ny"
    for i in (1, 2, 3):  # blank lines and other numbers stay
        assert left[i] == f"{texts[i].split(chr(10))[0]}\n \nPage {i}\n"


def test_passages_of_two_documents_recur_in_the_pipeline(spark):
    long, unspaced, short = prose(60, 90) + " on 12 May", "本页面的全部内容均由用户提供" * 6, prose(10, 91)
    table = " ".join(str(n) for n in range(1000, 1030))
    texts = [f"first\n{long}\n{unspaced}\n{short}\n{table}", f"second\n{long}\n{unspaced}\n{short}\n{table.replace('10', '77')}", f"third\n{prose(60, 92)} on 13 May"]
    left = left_by_pipeline(spark, texts)
    assert left[0] == texts[0]
    assert left[1] == f"second\n{short}\n{table.replace('10', '77')}"  # other numbers are another passage
    assert left[2] == texts[2]


def test_rows_of_numbers_stay_in_the_pipeline(spark):
    long = " ".join(["{0}"] * 14)
    texts = [f"{prose(9, 95 + i)}\n1{i} 2{i} 3{i}\n1{i} | 2{i} | 3{i}\n{long.format(40 + i)}\n7 8 9\nRow 1{i} of 20" for i in range(4)]
    left = left_by_pipeline(spark, texts)
    assert left[0] == texts[0]
    for i in (1, 2, 3):  # the same numbers, and fields beside words, go
        assert left[i] == "\n".join(texts[i].split("\n")[:4])
