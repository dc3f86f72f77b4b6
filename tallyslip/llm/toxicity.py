"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learnt: the `LEXICON` words whose share of toxic documents stands out most among the labelled training rows. Features
are lexicon densities and counts, second-person proximity, capitals, punctuation and obfuscation rates. Trees and lexicon learn from
at most `TRAIN_ROWS` labelled rows, those with the smallest hashes; the calibration rows are those whose crc32(id) mod 5 is 4.

Defined results: null and empty texts have all features zero and get a score like any other. No labels, or
labels of one kind: the score is the (smoothed) share of toxic ones. A document labelled twice counts once, as toxic
if either label says so; null labels don't count. Very long texts are read whole; repeated rows give repeated results;
null ids are rows like others; extra columns pass through, but for score and predicted. Empty table: empty result.
"""

from __future__ import annotations

import math
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyslip.llm.boosting import BoostedTrees, isotonic
from tallyslip.llm.common import WordTable, add_from_text, crc32_mod, discard, materialize, sample_by_hash, worker_state

TRAIN_ROWS, LEXICON = 10_000, 60
#: A lexicon word stands in at least this share of the toxic training documents.
LEAST_SHARE = 0.02
#: Second-person words of the languages of the corpus.
SECOND_PERSON = "you your yours u ur tu te toi ton ta vous votre du dich dir dein ihr euch usted ustedes tus vosotros".split()
#: Characters that stand in for letters.
STAND_INS = str.maketrans("013457@$!", "oleastasi")
EDGE = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum())
NEAR = 4
FEATURES = ["hit_rate", "hits", "distinct", "weight_rate", "most", "near_rate", "caps", "exclaim", "question", "obfuscated", "hidden_hits", "words", "word_chars"]
SPLIT = r"[^\p{L}\p{N}]+"


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """word -> log odds, from (text, toxic) rows: the most telling words by document counts."""
    words = rows.select("toxic", F.explode(F.array_distinct(F.split(F.lower("text"), SPLIT))).alias("word")).filter("word != ''")
    totals = rows.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    bad, every = int(totals[0] or 0), int(totals[1])
    if not bad or bad == every:
        return {}
    good = every - bad
    counts = words.groupBy("word").agg(F.sum("toxic").alias("b"), F.count(F.lit(1)).alias("n"))
    odds = F.log((F.col("b") + 0.5) / (bad + 1)) - F.log((F.col("n") - F.col("b") + 0.5) / (good + 1))
    top = counts.filter(F.col("b") >= max(3, math.ceil(LEAST_SHARE * bad))).withColumn("odds", odds).filter("odds > 1.5")
    top = top.orderBy((F.col("odds") * F.sqrt("b")).desc(), "word").limit(LEXICON).collect()
    return {r["word"]: float(r["odds"]) for r in top}


class Featurizer:
    """Word rows for the table, and features of texts from them."""

    def __init__(self, lexicon: dict[str, float]):
        self.weight = lexicon
        self.code = {w: i + 1 for i, w in enumerate(sorted(lexicon))}
        self.parts = re.compile(r"[^\W_]+")
        self.table = WordTable(self.word_rows)

    def word_rows(self, words: list[str]) -> np.ndarray:
        """weight, lexicon code, second person, capitals, exclamation marks, question marks, obfuscated, hidden hit, letters."""
        out = np.zeros((len(words), 9), dtype=np.float32)
        second = set(SECOND_PERSON)
        for row, word in zip(out, words):
            low = word.lower()
            for part in self.parts.findall(low):
                if part in self.weight:
                    row[0], row[1] = self.weight[part], self.code[part]
                elif part in second:
                    row[2] = 1
            bare = low.strip(EDGE)
            if row[1] == 0 and not bare.isalpha() and any(c.isalpha() for c in bare):
                plain = re.sub(r"[^\w]|_", "", bare.translate(STAND_INS))
                row[6] = 1
                if plain in self.weight:
                    row[0], row[1], row[7] = self.weight[plain], self.code[plain], 1
            letters = sum(c.isalpha() for c in word)
            row[3] = letters > 1 and word.isupper()
            row[4], row[5], row[8] = word.count("!"), word.count("?"), letters
        return out

    def features(self, texts: list[str | None]) -> np.ndarray:
        self.table.learn(texts)
        out = np.zeros((len(texts), len(FEATURES)))
        for f, text in zip(out, texts):
            if not text or text.isspace():
                continue
            rows = self.table.of(text)
            n = len(rows)
            hit = rows[:, 1] > 0
            total = rows.sum(axis=0, dtype=np.float64)
            hits = int(hit.sum())
            near = 0
            if hits and total[2]:
                places = np.flatnonzero(rows[:, 2])
                at = np.flatnonzero(hit)
                i = np.searchsorted(places, at)
                gap = np.minimum(np.abs(at - places[np.minimum(i, len(places) - 1)]), np.abs(at - places[np.maximum(i - 1, 0)]))
                near = int((gap <= NEAR).sum())
            f[:] = (hits / n, hits, len(np.unique(rows[hit, 1])), total[0] / n, rows[:, 0].max(), near / n, total[3] / n, total[4] / n, total[5] / n, total[6] / n, total[7], math.log1p(n), total[8] / n)
        return out


class Model:
    def __init__(self, lexicon: dict[str, float], share: float):
        self.lexicon, self.share = lexicon, share
        self.trees: BoostedTrees | None = None
        self.steps: tuple[np.ndarray, np.ndarray] | None = None

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(features), self.share)
        margin = self.trees.margin(features)
        if self.steps is None:
            return 1 / (1 + np.exp(-margin))
        return np.clip(np.interp(margin, *self.steps), 0, 1)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Lexicon, trees and calibration from labelled documents (already without the held-out ones)."""
    labels = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("toxic"))
    labels = sample_by_hash(labels, ["id"], TRAIN_ROWS, labels.count())
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(labels), "id")  # at most TRAIN_ROWS labels
    rows = sample_by_hash(rows, ["id", "text"], TRAIN_ROWS, TRAIN_ROWS).withColumn("calibrate", crc32_mod("id", 5) == 4)  # an id may have many texts
    rows = materialize(rows)
    lexicon = learn_lexicon(rows.filter("not calibrate and text is not null"))
    feature_type = "toxic int, calibrate boolean, features array<double>"

    def make(stream):
        maker = Featurizer(lexicon)
        for batch in stream:
            yield pa.RecordBatch.from_pydict({"toxic": batch.column(1).cast(pa.int32()), "calibrate": batch.column(2), "features": pa.array(list(maker.features(batch.column(0).to_pylist())), pa.list_(pa.float64()))})

    sample = rows.select("text", "toxic", "calibrate").mapInArrow(make, feature_type).collect()  # at most TRAIN_ROWS short rows
    discard(rows)
    y = np.array([r[0] for r in sample], dtype=float)
    model = Model(lexicon, float((y.sum() + 0.5) / (len(y) + 1)))
    if 0 < y.sum() < len(y):
        x, held = np.array([r[2] for r in sample]), np.array([r[1] for r in sample])
        if not 0 < y[~held].sum() < (~held).sum():
            held[:] = False
        model.trees = BoostedTrees().fit(x[~held], y[~held])
        if 0 < y[held].sum() < held.sum():
            model.steps = isotonic(model.trees.margin(x[held]), y[held])
    return model


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    shared_key = uuid.uuid4().hex  # a worker keeps its cache while the model is the same

    def make(texts: list[str | None]) -> dict:
        maker = worker_state(("toxic", shared_key), lambda: Featurizer(shared.value.lexicon))
        return {"score": shared.value.score(maker.features(texts))}

    out = add_from_text(docs.drop("predicted"), text_col, make, {"score": "double"})
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(id_col: str = "doc_id"):
    return crc32_mod(id_col, 5) == 0
