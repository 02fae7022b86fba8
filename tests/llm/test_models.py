import random

import numpy as np

from tests.llm.data import docs
from zonepulse.llm import language_id, quality_model

ENDS = {"en": ["ing", "tion", "the", "and", "of"], "de": ["ung", "keit", "der", "sch", "ein"], "fr": ["eau", "tion", "les", "que", "eux"], "es": ["ción", "os", "de", "ado", "ie"], "pt": ["ção", "os", "de", "ado", "nh"]}


def talk(lang: str, n: int, seed: int) -> str:
    rnd = random.Random(f"{lang}{seed}")
    return " ".join("".join(rnd.choice(ENDS[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def corpus(spark, each=60):
    made = [(i * 10 + k, talk(lang, 40, i), lang, None, 0, "", "", "", "") for i in range(each) for k, lang in enumerate(ENDS)]
    odd = [(900_001, None, "en", None), (900_002, "", "en", None), (900_003, "12 34 !!", "en", None), (900_004, talk("de", 30, 7), None, None), (None, talk("fr", 30, 8), "fr", None)]
    return docs(spark, made + [(*o, 0, "", "", "", "") for o in odd])


def test_language_held_out_accuracy_and_awkward_texts(spark):
    rows = corpus(spark)
    found = language_id.identify(rows).collect()
    truth = {r.doc_id: r.lang for r in rows.collect()}
    held = [r for r in found if r.held_out and r.doc_id < 900_000]
    assert len(held) > 50 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.95
    by_id = {r.doc_id: r for r in found}
    assert len(found) == rows.count()
    for i in (900_001, 900_002, 900_003):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[900_004].lang_pred == "de" and by_id[None].lang_pred == "fr" and not by_id[None].held_out
    assert all(0 <= r.score <= 1 for r in found)


def test_held_out_labels_are_not_read(spark):
    """Wrong languages on the held-out third change no prediction."""
    from pyspark.sql import functions as F

    from zonepulse.llm.common import is_held_out

    rows = corpus(spark, 20)
    wrong = rows.withColumn("lang", F.when(is_held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    as_set = lambda df: {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in language_id.identify(df).collect()}
    assert as_set(rows) == as_set(wrong)


def test_language_filter_and_nothing_to_learn(spark):
    rows = corpus(spark, 5)
    kept = language_id.filter_documents(rows)
    assert kept.columns == rows.columns
    assert {r.doc_id for r in rows.collect()} - {r.doc_id for r in kept.collect()} == {900_001, 900_002, 900_003}
    assert language_id.identify(docs(spark, [])).count() == 0
    alone = language_id.identify(docs(spark, [(1, "some words", None, None, 0, "", "", "", "")])).first()
    assert (alone.lang_pred, alone.score) == ("und", 0.0)


def test_pairs_are_within_families():
    langs = [x for x in ENDS for _ in range(8)]
    x = np.array([language_id.vector(talk(lang, 40, i)) for i, lang in enumerate(langs)])
    model = language_id.fit(x, langs)
    assert {frozenset(p) for p in model.pairs} == {frozenset(p) for p in [("de", "en"), ("es", "fr"), ("es", "pt"), ("fr", "pt")]}


def test_quality_held_out_accuracy_and_awkward_texts(spark):
    good = [(i, talk("en", 60, i), 1) for i in range(0, 300)]
    bad = [(i, " ".join(w + "&&&" for w in talk("en", 60, i).split()), 0) for i in range(300, 500)]
    rows = docs(spark, [(i, t, "en", "s", 0, "", "", "", "") for i, t, _ in good + bad] + [(9001, None, None, None, 0, "", "", "", ""), (9002, "", None, None, 0, "", "", "", ""), (None, "word", None, None, 0, "", "", "", "")])
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in good + bad] + [(7777, 1, 0), (5, None, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    found = quality_model.classify(rows, labels).collect()
    truth = {i: q for i, _, q in good + bad}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.95
    assert len(found) == rows.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    nothing = quality_model.classify(rows, labels.filter("quality = 1")).collect()
    assert {r.score for r in nothing} == {0.5}
    assert quality_model.classify(docs(spark, []), labels).count() == 0


def test_word_vectors_add_up_over_partitions(spark):
    rows = corpus(spark, 6)
    as_set = lambda df: {tuple(r) for r in quality_model.context_sums(quality_model.numbered(df)).collect()}
    assert as_set(rows.repartition(1)) == as_set(rows.repartition(5))


def test_word_vectors_against_plain_loops(spark, monkeypatch):
    """Sums over neighbours counted one by one, with a flush after few numbers."""
    monkeypatch.setattr(quality_model, "_NUMBERS_AT_ONCE", 100)
    texts = ["a b c a", "", None, "Word, word 12 !!", talk("de", 70, 1), "x", "é" * 5000 + "1" * 3000]
    rows = docs(spark, [(i, t, None, None, 0, "", "", "", "") for i, t in enumerate(texts)])
    places, signs = quality_model.index_vectors()
    want, times = {}, {}
    for t in texts:
        of = [int(x) for x in np.frombuffer(quality_model.Numbers().of(t), "<u2")]
        for i, word in enumerate(of):
            times[word] = times.get(word, 0) + 1
            vector = want.setdefault(word, [0] * quality_model.SIZE)
            for j in range(max(0, i - 4), min(len(of), i + 5)):
                if j != i:
                    for place, sign in zip(places[of[j]], signs[of[j]]):
                        vector[place] += int(sign)
    contexts = quality_model.Contexts()
    for r in quality_model.numbered(rows).collect():
        contexts.add(bytes(r.numbers))
    counts, sums = contexts.sums()
    assert {int(w): int(counts[w]) for w in np.flatnonzero(counts)} == times
    assert all(list(sums[w]) == v for w, v in want.items())
    assert {r.word: [r[i + 2] for i in range(quality_model.SIZE)] for r in quality_model.context_sums(quality_model.numbered(rows)).collect()} == want


def test_whole_shape_counts():
    """Words that differ after thousands of characters have different shapes."""
    numbers = quality_model.Numbers()
    assert numbers.of("-a" * 2000 + "9") != numbers.of("-a" * 2000 + "!")


def test_few_labels_leave_one_for_the_temperature():
    x = np.array([[0.0], [1.0], [0.1], [0.9]])
    p = quality_model.fit(x, np.array([0.0, 1.0, 0.0, 1.0])).probabilities(x)
    assert ((0 <= p) & (p <= 1)).all()


def test_temperature_makes_scores_fit():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 4))
    y = (rng.random(4000) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    p = quality_model.fit(x, y).probabilities(x)
    for low in (0.2, 0.4, 0.6):
        part = (p >= low) & (p < low + 0.2)
        assert abs(y[part].mean() - p[part].mean()) < 0.08
