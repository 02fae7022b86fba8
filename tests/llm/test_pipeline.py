"""The whole pipeline on a small table, against plain versions of its stages."""

import collections
import random
import re

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.data import docs
from tests.llm.test_dedup import brute
from tests.llm.test_models import ENDS, talk
from zonepulse.llm import quality_rules

SHARED = "this passage of more than twenty plain words stands word for word in a few of the documents and in no other way at all"
FOREIGN = " ".join("".join(chr(0x430 + (i * k + k) % 30) for k in range(1, 7)) for i in range(70))


def table() -> list[tuple]:
    """Clean texts, copies, near copies, a shared passage, symbols, short and foreign texts, nulls."""
    rnd, out = random.Random(4), []
    for i in range(200):
        lang = list(ENDS)[i % len(ENDS)]
        out.append((i, talk(lang, 90, i), lang))
    for i in range(200, 210):
        out.append((i, out[i - 200][1], out[i - 200][2]))  # copies
    for i in range(210, 220):
        words = out[i - 200][1].split()
        words[rnd.randrange(5, 80)] = "changed"
        out.append((i, " ".join(words), out[i - 200][2]))  # near copies
    for i in (30, 31, 32):
        out[i] = (i, out[i][1] + "\n" + SHARED, out[i][2])
    out.append((300, " ".join(w + "&&|" for w in out[40][1].split()), "en"))
    out += [(301, "too few words", "en"), (302, None, "en"), (303, "", None), (304, FOREIGN, None), (305, " ".join(str(7919 * k) for k in range(80)), None)]
    return out


def plain_lines(found: list[tuple]) -> list[tuple]:
    """Lines of 20 or more tokens that two documents have, without their later places."""
    where = collections.defaultdict(set)
    for i, text, _ in found:
        for line in text.split("\n"):
            where[line].add(i)
    return [(i, "\n".join(x for x in text.split("\n") if len(x.split()) < 20 or min(where[x]) == i), lang) for i, text, lang in found]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The folder with the table, and what each stage makes of the one before."""
    sf_dir = str(tmp_path_factory.mktemp("pipeline"))
    docs(spark, [(i, t, lang, "s", 0, "", "", "", "") for i, t, lang in table()]).write.parquet(f"{sf_dir}/documents.parquet")
    frame, made = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        frame = made[name] = stage(spark, frame, sf_dir).persist()
    return sf_dir, made


def test_stages_against_plain_versions(spark, stages):
    sf_dir, made = stages
    text_of = {i: (t, lang) for i, t, lang in table()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet/*.parquet'")
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality_rules.oracle_sql()}) WHERE kept").fetchall()}
    assert {r.doc_id for r in made["quality_rules"].collect()} == good
    assert not good & {300, 301, 302, 303} and len(good) > 200
    known = {i for i in good if i != 304 and re.search(r"[^\W\d_]", text_of[i][0])}
    assert {r.doc_id for r in made["language_id"].collect()} == known
    left = plain_lines([(i, *text_of[i]) for i in sorted(known)])
    want = {i: t for i, t, _ in left if t}  # documents left empty go
    assert {r.doc_id: r.text for r in made["line_dedup"].collect()} == want
    ids = {d for d, _, root in brute(sorted(want.items())) if d == root}
    assert {r.doc_id for r in made["near_duplicates"].collect()} == ids
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = collections.Counter()
    for r in made["packing"].collect():
        tokens[r.doc_id] += r.length
    assert tokens == {i: len(tokenizer.encode(want[i], add_special_tokens=False).ids) + 1 for i in ids}
    for name in list(made)[:-1]:
        assert made[name].columns == docs(spark, []).columns


def test_run_gives_the_last_stage(spark, stages):
    sf_dir, made = stages

    def texts(frame) -> dict[int, bytes]:  # the pieces of a document, put together again
        out = collections.defaultdict(bytes)
        for r in sorted(frame.collect(), key=lambda r: (r.doc_id, r.start)):
            out[r.doc_id] += bytes(r.ids)
        return out

    assert texts(corpus_pipeline.run(spark, sf_dir)) == texts(made["packing"])
