"""Language identification in two steps: the family first, then the languages within it.

A text is its byte n-grams, hashed into a vector of fixed length; every byte of the whole text counts. A nearest
centroid in that space gives the language family; within a family every pair of languages has a linear support
vector machine of its own, and the language with most votes (then the largest sum of margins) wins.

Counting n-grams, the part that grows with the corpus, runs in tasks. The classifier is small: it is fitted on
a bounded sample of labelled documents (``per_language``), chosen by a hash of the text, and sent to the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonepulse.llm.common import held_out_id, is_held_out, per_batch

UNKNOWN = "und"
SIZE = 1 << 13
_LETTER = regex.compile(r"\p{L}")
_MULTIPLIER = np.uint32(2654435761)

#: Families of common languages by ISO 639-1 code; fixed values. Any other label is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "sa", "si", "ur"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "semitic": ("am", "ar", "he", "mt"),
    "austronesian": ("id", "jv", "mg", "ms", "su", "tl"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], lang)


def vector(text: str) -> np.ndarray:
    """Unit vector of the damped counts of a text's byte 1- to 4-grams; a text without letters gives zeros."""
    data = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8).astype(np.uint32)
    grams, counts = np.zeros(len(data), np.uint32), np.zeros(SIZE)
    for n in range(1, 5):
        if len(data) < n:
            break
        grams = grams[: len(data) - n + 1] * np.uint32(257) + data[n - 1 :] + np.uint32(1)
        counts += np.bincount((grams * _MULTIPLIER) >> np.uint32(32 - 13), minlength=SIZE)
    out = np.sqrt(counts)
    return (out / max(np.linalg.norm(out), 1e-12)).astype(np.float32)


@dataclass
class Model:
    """Centroids of families and one linear machine per pair of languages of one family."""

    families: list[str]
    centroids: np.ndarray
    languages: dict[str, list[str]]
    pairs: dict[tuple[str, str], tuple[np.ndarray, float]]
    #: Score under which a text counts as none of the languages.
    floor: float = 0.0

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        near = self.centroids @ x
        best = int(np.argmax(near))
        p = np.exp(40.0 * (near - near[best]))
        score = 1.0 / float(p.sum())
        langs = self.languages[self.families[best]]
        votes, margins, sure = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0), {}
        for (a, b), (w, bias) in self.pairs.items():
            if a in votes and b in votes:
                m = float(w @ x) + bias
                votes[a if m >= 0 else b] += 1
                margins[a] += m
                margins[b] -= m
                sure[a, b] = m
        lang = max(langs, key=lambda k: (votes[k], margins[k], k))
        for (a, b), m in sure.items():
            if lang in (a, b):
                score *= 1.0 / (1.0 + float(np.exp(-4.0 * (m if lang == a else -m))))
        return lang, min(1.0, max(0.0, score))


def _machine(x: np.ndarray, y: np.ndarray, rounds: int = 30, strength: float = 1e-4) -> tuple[np.ndarray, float]:
    """A linear support vector machine (squared hinge), by averaged sub-gradient steps in a fixed order."""
    rng = np.random.default_rng(7)
    z = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w, total, steps = np.zeros(z.shape[1]), np.zeros(z.shape[1]), 0
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * len(y)
    for turn in range(rounds):
        order = rng.permutation(len(z))
        for at in range(0, len(z), 64):
            i = order[at : at + 64]
            slack = np.maximum(0.0, 1.0 - y[i] * (z[i] @ w))
            w = w * (1 - strength) + 8.0 / (1 + turn) ** 0.5 * ((slack * y[i] * share[i]) @ z[i]) / len(i)
            total, steps = total + w, steps + 1
    mean = total / max(steps, 1)
    return mean[:-1].astype(np.float32), float(mean[-1])


def fit(x: np.ndarray, langs: list[str]) -> Model:
    labels = np.array(langs, dtype=object)
    known = sorted(set(langs))
    families: dict[str, list[str]] = {}
    for lang in known:
        families.setdefault(family_of(lang), []).append(lang)
    # a family's centroid is the mean of its languages' means, so a common language does not hide a rare one
    means = {lang: x[labels == lang].mean(0) for lang in known}
    centroids = np.array([np.mean([means[m] for m in members], axis=0) for members in families.values()])
    centroids = (centroids / np.linalg.norm(centroids, axis=1, keepdims=True)).astype(np.float32)
    pairs = {}
    for members in families.values():
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                rows = (labels == a) | (labels == b)
                pairs[a, b] = _machine(x[rows], np.where(labels[rows] == a, 1.0, -1.0))
    return Model(list(families), centroids, families, pairs)


def calibrated(x: np.ndarray, langs: list[str]) -> float:
    """The score under which a text counts as none of the languages learned.

    A model of four fifths of the sample scores the other fifth; of these scores all but a hundredth are at least ``usual``. A text has to
    fall short of 1 by twenty times as much as ``usual`` does, and by a quarter, to be rejected: rare clean texts stay. Where the
    scores of known languages are low themselves, nothing is rejected.
    """
    aside = np.arange(len(langs)) % 5 == 4
    if not aside.any():
        return 0.0
    model = fit(x[~aside], [lang for lang, out in zip(langs, aside, strict=True) if not out])
    scores = sorted(model.predict(v)[1] for v in x[aside])
    usual = scores[len(scores) // 100]
    return float(max(0.0, min(0.75, 1.0 - 20.0 * (1.0 - usual))))


def _sample(docs: DataFrame, per_language: int, most: int) -> DataFrame:
    """At most ``per_language`` labelled documents of each language: those with the smallest hash of id and text.

    Of very many languages, the first ``most`` documents in all are taken. Ranks are taken per language and shard first, so a language with most of the rows is split.
    """
    rows = docs.filter(F.col("lang").isNotNull() & (F.trim("lang") != "") & F.col("text").isNotNull() & ~is_held_out(F.col("doc_id")))
    rows = rows.select("lang", "doc_id", F.xxhash64("doc_id", "text").alias("h")).withColumn("shard", F.pmod("h", F.lit(64)))
    first = rows.withColumn("r", F.row_number().over(Window.partitionBy("lang", "shard").orderBy("h"))).filter(F.col("r") <= per_language)
    best = first.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("r") <= per_language)
    return best.orderBy("r", "h", "lang").limit(most).select("doc_id", "h")


def train(docs: DataFrame, per_language: int = 300, most: int = 6000, reject: bool = False) -> Model | None:
    """Fits on texts and languages of documents that are not held out; None if there are none. ``reject``: a floor for scores, too.

    The driver gets at most ``most`` sparse vectors, never texts.
    """
    rows = docs.select("doc_id", "text", "lang")
    chosen = F.broadcast(_sample(rows, per_language, most))  # bounded by the parameters
    labelled = rows.withColumn("h", F.xxhash64("doc_id", "text")).join(chosen, ["doc_id", "h"], "left_semi").filter(F.col("lang").isNotNull())
    labelled = labelled.dropDuplicates(["doc_id", "h", "lang"])

    def make():
        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            xs = [vector(t) for t in b["text"].to_pylist()]
            at = [np.flatnonzero(x) for x in xs]
            return pa.record_batch({
                "lang": b["lang"], "h": b["h"], "at": pa.array([i.astype(np.uint16).tobytes() for i in at], pa.binary()),
                "value": pa.array([x[i].astype(np.float16).tobytes() for x, i in zip(xs, at, strict=True)], pa.binary()),
            })

        return step

    found = labelled.select("lang", "h", "text").mapInArrow(per_batch(make), "lang string, h bigint, at binary, value binary").collect()
    if not found:
        return None
    found.sort(key=lambda r: (r["lang"], r["h"]))
    x = np.zeros((len(found), SIZE), np.float32)
    for i, r in enumerate(found):
        x[i, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["value"], np.float16)
    langs = [r["lang"] for r in found]
    model = fit(x, langs)
    if reject:
        model.floor = calibrated(x, langs)
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    ``und`` with score 0 for null texts, texts without a letter, and when there was nothing to learn from. The score
    is how clearly the family and the language stand out, 0 to 1. One row per input row, repeated ones too.
    """
    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded by the numbers of languages and n-gram cells

    def make():
        known = shared.value

        def one(text: str | None) -> tuple[str, float]:
            if known is None or not text or not _LETTER.search(text):
                return UNKNOWN, 0.0
            return known.predict(vector(text))

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            found = [one(t) for t in b["text"].to_pylist()]
            return pa.record_batch({
                "doc_id": b["doc_id"], "held_out": pa.array([held_out_id(d) for d in b["doc_id"].to_pylist()], pa.bool_()),
                "lang_pred": pa.array([f[0] for f in found], pa.string()), "score": pa.array([f[1] for f in found], pa.float64()),
            })

        return step

    return rows.mapInArrow(per_batch(make), "doc_id bigint, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, per_language: int = 300) -> DataFrame:
    """Trains on the documents that are not held out and predicts all of them.

    One row per input row, repeated ones too; an empty table, or one without labels, learns nothing and gives ``und``. Very long
    texts count whole.
    """
    return predict(docs, train(docs, per_language))


def filter_documents(docs: DataFrame, per_language: int = 300) -> DataFrame:
    """The documents whose language can be told, with their own columns.

    Those without text or letters go, and those whose score is under the model's calibrated floor: text of no language that was
    learned, or of none at all. Without labels to learn from all texts with letters stay.

    Prediction is part of the row, so nothing is shuffled; all other columns pass through as they are.
    """
    model = train(docs, per_language, reject=True) if "lang" in {c.lower() for c in docs.columns} else None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        known = shared.value

        def step(b: pa.RecordBatch) -> pa.RecordBatch:
            keep = [bool(t) and _LETTER.search(t) is not None and (known is None or known.predict(vector(t))[1] >= known.floor) for t in b["text"].to_pylist()]
            return b.filter(pa.array(keep, pa.bool_()))

        return step

    return docs.mapInArrow(per_batch(make), docs.schema)
