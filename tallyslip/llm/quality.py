"""Quality classifier: a weak-label model over heuristic labellers and a hashed linear scorer.

Overlapping heuristics vote good, bad or abstain on every document. The counts of vote patterns over all documents
(at most 3 ** number of labellers rows) are all that expectation-maximisation needs: it estimates each labeller's
accuracies on good and bad documents and the posterior of every pattern. Posteriors are the soft labels of a
logistic scorer over hashed word shapes, words and repetition, trained on at most `TRAIN_ROWS` documents, those with the smallest
hashes of id and text; documents are scored whole.

Defined results: null or empty text, or only white space: score 0, not kept. Very long texts are read whole.
Repeated rows and null ids give results row by row; extra columns pass through, but for the model's own. Empty table: empty result.
"""

from __future__ import annotations

import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyslip.llm.common import WordTable, add_from_text, sample_by_hash, text_blocks, worker_state

TRAIN_ROWS, HASH_BITS = 4000, 18
EPOCHS, RATE, RIDGE = 150, 0.5, 1e-4
KEEP = 0.5
#: Pseudo counts of a labeller's own class, as a share of all documents.
OWN_PRIOR = 0.02
#: The thresholds of bad votes are such that at most this share of good documents gets one from a labeller; without
#: that bound a symptom that comes alone would be explained as well by the good class.
MOST_FALSE = 0.005
#: Votes.
BAD, ABSTAIN, GOOD = 0, 1, 2
#: (name, statistic, bad above, good below): what lies between abstains. Statistics are shares of a document's words.
LABELLERS = [
    ("symbol words", "symbols", 0.10, 0.02),
    ("symbol characters", "symbol_chars", 0.05, 0.01),
    ("lone marks", "lone", 0.10, 0.01),
    ("exclamations", "exclaim", 0.20, 0.02),
    ("capitals", "capitals", 0.30, 0.10),
    ("repeated marks", "repeats", 0.10, 0.01),
    ("digits", "digits", 0.30, 0.10),
    ("long words", "long", 0.10, 0.02),
    ("echoes", "echoes", 0.20, 0.02),
]
#: Those of single words, and the share of words that repeat the one before.
WORD_STATISTICS = ["symbols", "symbol_chars", "lone", "exclaim", "capitals", "repeats", "digits", "long"]
STATISTICS = [*WORD_STATISTICS, "echoes"]
PLAIN = re.compile(r"[\w.,;:!?'\"()\-’“”«»¿¡…–—]")
REPEAT = re.compile(r"([^\w\s.])\1")
RUNS = [(re.compile(r"[^\W\d_]*[a-zß-ÿ][^\W\d_]*"), "a"), (re.compile(r"[^\W\d_]+"), "A"), (re.compile(r"\d+"), "0")]


def word_statistics(words: list[str]) -> np.ndarray:
    """Per word the statistics, the characters being a share of the word's."""
    out = np.zeros((len(words), len(WORD_STATISTICS)), dtype=np.float32)
    for row, word in zip(out, words):
        if word.isalpha() or word[:-1].isalpha() and word[-1] in ".,":  # most words: no marks, no digits
            row[4] = len(word) > 1 and word[:2].isupper() and word.isupper()
            row[7] = len(word) > 40
            continue
        other = len(PLAIN.sub("", word))
        alnum = any(c.isalnum() for c in word)
        row[0] = other > 0 and alnum
        row[1] = other / len(word)
        row[2] = not alnum
        row[3] = "!" in word
        row[4] = sum(c.isalpha() for c in word) > 1 and word.isupper()
        row[5] = REPEAT.search(word) is not None
        row[6] = any(c.isdigit() for c in word) and not any(c.isalpha() for c in word)
        row[7] = len(word) > 40
    return out


def votes_of(shares: np.ndarray) -> np.ndarray:
    """Votes (documents, labellers) from statistics' shares."""
    out = np.full((len(shares), len(LABELLERS)), ABSTAIN, dtype=np.int8)
    for k, (_, statistic, bad, good) in enumerate(LABELLERS):
        x = shares[:, STATISTICS.index(statistic)]
        out[:, k] = np.where(x > bad, BAD, np.where(x < good, GOOD, ABSTAIN))
    return out


def pattern_of(votes: np.ndarray) -> np.ndarray:
    return votes.astype(np.int64) @ (3 ** np.arange(votes.shape[1]))


def votes_from(pattern: np.ndarray) -> np.ndarray:
    return np.stack([pattern // 3**k % 3 for k in range(len(LABELLERS))], axis=1)


def label_model(counts: dict[int, int], rounds: int = 200) -> tuple[dict[int, float], np.ndarray, float]:
    """Expectation-maximisation on pattern counts: (posterior of good per pattern, vote probabilities
    (class, labeller, vote), share of good). Junk shows few symptoms at once, so there is one hidden class per labeller, of documents
    with that symptom, beside the good one (class 0); in its own class a labeller's votes start as bad and are held there by pseudo
    counts in proportion to the documents, everything else is estimated, a good document's bad votes within MOST_FALSE."""
    patterns = np.array(sorted(counts))
    n = np.array([counts[p] for p in patterns.tolist()], dtype=float)
    votes = votes_from(patterns)
    k = np.arange(len(LABELLERS))
    prior = np.tile(np.array([0.2, 1.0, 2.0]), (len(k) + 1, len(k), 1))
    prior[k + 1, k] = np.array([0.9, 0.09, 0.01]) * max(1.0, OWN_PRIOR * n.sum())
    prob = np.empty_like(prior)
    prob[0], prob[1:] = (0.002, 0.098, 0.9), (0.1, 0.1, 0.8)
    prob[k + 1, k] = (0.9, 0.09, 0.01)
    share = np.append(0.8, np.full(len(k), 0.2 / len(k)))
    post = np.full(len(patterns), share[0])
    for _ in range(rounds):
        log = np.log(prob[:, k, votes]).sum(axis=2) + np.log(share)[:, None]
        weight = np.exp(log - log.max(axis=0))
        weight /= weight.sum(axis=0)
        done, post = np.abs(weight[0] - post).max() < 1e-6, weight[0]
        if done:
            break
        weight = weight * n
        for j in range(len(k)):
            hits = np.stack([weight[:, votes[:, j] == v].sum(axis=1) for v in (BAD, ABSTAIN, GOOD)], axis=1) + prior[:, j]
            prob[:, j] = hits / hits.sum(axis=1, keepdims=True)
        excess = np.maximum(prob[0, :, BAD] - MOST_FALSE, 0)
        prob[0, :, BAD] -= excess
        prob[0, :, GOOD] += excess
        share = np.maximum(weight.sum(axis=1), 1e-3 * n.sum())
        share /= share.sum()
    return dict(zip(patterns.tolist(), post.tolist())), prob, float(share[0])


def shape_of(word: str) -> str:
    if word.isalpha():
        return "A" if word.isupper() else "a"
    if word[:-1].isalpha():
        return ("A" if word.isupper() else "a") + ("0" if word[-1].isdigit() else word[-1])
    for run, mark in RUNS:
        word = run.sub(mark, word)
    return word[:16]


def slots_of(words: list[str]) -> np.ndarray:
    """Two hashed features per word: its shape and itself."""
    size = 1 << HASH_BITS
    return np.array([[zlib.crc32(b"s" + shape_of(w).encode()) % size, zlib.crc32(b"w" + w.lower().encode()) % size] for w in words], dtype=np.int64).reshape(-1, 2)


#: The hashed feature of repetition.
ECHO_SLOT = zlib.crc32(b"echo") % (1 << HASH_BITS)


def echoes(words: np.ndarray) -> float:
    """The share of words that equal the one before."""
    return float((words[1:] == words[:-1]).mean()) if len(words) > 1 else 0.0


class Scorer:
    """Logistic on mean hashed counts."""

    def __init__(self):
        self.weights, self.bias = np.zeros(1 << HASH_BITS, dtype=np.float32), 0.0

    def fit(self, slots: list[np.ndarray], shares: list[np.ndarray], target: np.ndarray) -> Scorer:
        row = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
        col, val = np.concatenate(slots), np.concatenate(shares)
        w, b = np.zeros(1 << HASH_BITS), 0.0
        gw, gb = np.full(len(w), 1e-6), 1e-6
        for _ in range(EPOCHS):
            p = 1 / (1 + np.exp(-(np.bincount(row, val * w[col], len(slots)) + b)))
            d = (p - target) / len(slots)
            g = np.bincount(col, val * d[row], len(w)) + RIDGE * w
            gw += g * g
            gb += d.sum() ** 2
            w -= RATE * g / np.sqrt(gw)
            b -= RATE * d.sum() / np.sqrt(gb)
        self.weights, self.bias = w.astype(np.float32), float(b)
        return self


class Reader:
    """A worker's word rows: statistics and, with a scorer, the weight of the word's hashed features."""

    def __init__(self, scorer: Scorer | None = None):
        self.scorer = scorer
        self.table = WordTable(self.word_rows)

    def word_rows(self, words: list[str]) -> np.ndarray:
        own = word_statistics(words)
        if self.scorer is None:
            return own
        return np.concatenate((own, self.scorer.weights[slots_of(words)].sum(axis=1, keepdims=True)), axis=1)

    def means(self, texts: list[str | None]) -> np.ndarray:
        """Mean row of each text's words, with its echoes; NaN where there are no words."""
        self.table.learn(texts)
        out = np.full((len(texts), len(STATISTICS) + (self.scorer is not None)), np.nan)
        n = len(WORD_STATISTICS)
        for i, text in enumerate(texts):
            if text and not text.isspace():
                at = self.table.at(text)
                mean = self.table.rows[at].mean(axis=0, dtype=np.float64)
                out[i, :n], out[i, n] = mean[:n], echoes(at)
                if self.scorer is not None:
                    out[i, -1] = mean[n] + out[i, n] * self.scorer.weights[ECHO_SLOT]
        return out


class Model:
    def __init__(self, posterior: dict[int, float], prob: np.ndarray, share: float, scorer: Scorer):
        self.posterior, self.prob, self.share, self.scorer = posterior, prob, share, scorer


def vote(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with the vote pattern; null where there are no words."""

    def make(texts: list[str | None]) -> dict:
        means = worker_state("quality votes", Reader).means(texts)
        return {"pattern": pa.array(pattern_of(votes_of(np.nan_to_num(means))), mask=np.isnan(means[:, 0]))}

    return add_from_text(docs, text_col, make, {"pattern": "long"})


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """The label model over all documents, and the scorer on a bounded sample; None without words."""
    counts = {r[0]: r[1] for r in vote(docs.select(text_col), text_col).groupBy("pattern").count().collect() if r[0] is not None}
    if not counts:
        return None
    posterior, prob, share = label_model(counts)
    sample = sample_by_hash(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["id", "text"], TRAIN_ROWS, sum(counts.values()))

    def make(stream):
        reader = Reader()
        for batch in text_blocks(stream, 1):
            texts = batch.column(1).to_pylist()
            means = reader.means(texts)
            pattern = pattern_of(votes_of(np.nan_to_num(means)))
            slots, shares = [], []
            for text in texts:
                words = (text or "").split()
                found, n = np.unique(slots_of(words).ravel(), return_counts=True)
                slots.append(np.append(found, ECHO_SLOT))
                shares.append(np.append(n / max(1, len(words)), echoes(np.array(words))))
            yield pa.RecordBatch.from_pydict({"pattern": pa.array(pattern, mask=np.isnan(means[:, 0])), "slots": pa.array(slots, pa.list_(pa.int64())), "shares": pa.array(shares, pa.list_(pa.float64()))})

    rows = sample.mapInArrow(make, "pattern long, slots array<long>, shares array<double>").filter("pattern is not null").collect()
    scorer = Scorer()
    if rows:
        scorer.fit([np.array(r[1]) for r in rows], [np.array(r[2]) for r in rows], np.array([posterior.get(r[0], 0.5) for r in rows]))
    return Model(posterior, prob, share, scorer)


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """`docs` with score, label_posterior and keep."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    shared_key = uuid.uuid4().hex  # a worker keeps its cache while the model is the same

    def make(texts: list[str | None]) -> dict:
        model = shared.value
        if model is None:
            return {"score": [0.0] * len(texts), "label_posterior": [0.0] * len(texts)}
        means = worker_state(("quality", shared_key), lambda: Reader(model.scorer)).means(texts)
        none = np.isnan(means[:, 0])
        score = np.where(none, 0, 1 / (1 + np.exp(-np.nan_to_num(means[:, -1]) - model.scorer.bias)))
        patterns = pattern_of(votes_of(np.nan_to_num(means)))
        posterior = [0.0 if x else model.posterior.get(p, model.share) for p, x in zip(patterns.tolist(), none.tolist())]
        return {"score": score, "label_posterior": posterior}

    out = add_from_text(docs.drop("keep"), text_col, make, {"score": "double", "label_posterior": "double"})
    return out.withColumn("keep", F.col("score") >= KEEP)
