"""Harder proofs: brute-force winnowing likeness, fast reading, isotonic blocks, the label model, held-out rates, odd tables."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyslip.llm import boosting, embedding, language_id, quality, simhash, toxicity, url_filter, winnowing
from tallyslip.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def long_hash(*values) -> int:
    """The chained 64-bit hash of texts and longs, seed 42, unsigned."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else v.to_bytes(8, "little"), seed)
    return seed


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def winnowed(text: str) -> set[int]:
    """Chosen hashes of five-word grams in windows of four, one window after the other, the rightmost of equal ones."""
    words = text.lower().split()
    one = [long_hash(w) for w in words]
    two = [long_hash(a, b) for a, b in zip(one, one[1:])]
    grams = [signed(long_hash(long_hash(two[i], two[i + 2]), one[i + 4])) >> 24 for i in range(len(words) - 4)]
    if len(grams) < 4:
        return {min(grams)} if grams else set()
    return {min((grams[i], -i) for i in range(at, at + 4))[0] for at in range(len(grams) - 3)}


def likeness(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def test_winnowing_likeness_as_by_brute_force(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in QUERIES["op4_winnowing"](spark, SF).collect()}
    order, compared = sorted(docs, reverse=True), 0
    for at, doc in enumerate(order):
        text, after = docs[doc], docs[order[(at + 1) % len(order)]]
        half = len(text) // 2
        if min(len(text[: len(text) - half].split()), len(after[: len(after) - len(after) // 2].split())) < 12:
            continue  # taken by characters
        edited = text[: len(text) - half] + after[:half]
        assert rows[doc]["near_edited"] == pytest.approx(likeness(winnowed(text), winnowed(edited)), abs=1e-12)
        assert rows[doc]["near_next"] == pytest.approx(likeness(winnowed(text), winnowed(after)), abs=1e-12)
        compared += 1
    assert compared > 100
    better = sum(r["near_edited"] > r["near_next"] for r in rows.values())
    assert better >= 0.97 * len(rows)


def test_reading_is_the_trained_network():
    """The fast reader gives the probabilities that training is about, at every byte of windows of all sizes."""
    rng = np.random.default_rng(3)
    net = language_id.ByteGRU(["a", "b", "c"])
    net.train([bytes(rng.integers(97 + 5 * k, 105 + 5 * k, 30, dtype=np.uint8)) for k in range(3) for _ in range(20)], np.repeat(np.arange(3), 20), np.ones(60), steps=20)
    parts = sorted((bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (1, 2, 3, 17, 48, 200, 480)), key=len)
    ids, mask = net.padded(parts)
    want = np.exp(net.log_probabilities(ids, mask))  # (steps, windows, languages)
    got = net.read(ids.astype(np.intp), np.array([len(p) for p in parts]))  # (languages, steps, windows)
    for k, p in enumerate(parts):
        assert np.allclose(got[:, : len(p), k].T, want[: len(p), k], atol=2e-5)


@pytest.mark.parametrize("size", [0, 1, 479, 480, 481, 2000])
def test_windows_cover_every_byte_once(size):
    data = ("aé€😀" * size).encode()[:size].decode(errors="ignore").encode()
    used = []
    for part, first, last in language_id.windows(data):
        part.decode()  # cut between characters
        used.append(part[first:last])
    assert b"".join(used) == data


def test_isotonic_is_the_least_squares_fit():
    """Blocks equal the max-min formula of monotone regression."""
    rng = np.random.default_rng(4)
    for _ in range(30):
        margin, y = rng.integers(0, 12, 40).astype(float), rng.integers(0, 2, 40).astype(float)
        xs, ys = boosting.isotonic(margin, y)
        levels = np.unique(margin)
        mean = lambda a, b: y[(margin >= a) & (margin <= b)].mean()
        best = {m: max(min(mean(a, b) for b in levels if b >= m) for a in levels if a <= m) for m in levels}
        assert ((0 < ys) & (ys < 1)).all()
        for m in levels:
            block = [k for k in levels if abs(best[k] - best[m]) < 1e-12]
            n = ((margin >= block[0]) & (margin <= block[-1])).sum()
            assert np.interp(m, xs, ys) == pytest.approx((best[m] * n + 0.25) / (n + 0.5), abs=1e-9)


def test_toxic_features_of_a_hand_made_text():
    """Densities are per word, and obfuscated words count like the ones they hide."""
    lexicon = {"stupid": 2.0, "hate": 1.0}
    f = toxicity.Featurizer(lexicon)
    plain, toxic, empty = f.features(["the quiet river runs by the mill", "YOU are stupid and i hate you !!!", ""])
    assert len(plain) == len(toxic) == len(empty) and not np.isnan([plain, toxic, empty]).any()
    assert (toxic != plain).sum() >= 4 and not empty.any()
    again = f.features(["the quiet river runs by the mill " * 400])[0]
    assert (np.abs(again - plain) > 0.02).sum() <= 1  # rates, but for the length itself


def test_label_model_on_a_known_table():
    """Patterns drawn from known classes: posteriors tell them apart, and the estimated accuracies are those of the draw."""
    rng = np.random.default_rng(5)
    k, n = len(quality.LABELLERS), 20_000
    good = rng.random(n) < 0.8
    symptom = rng.integers(0, k, n)
    votes = np.where(rng.random((n, k)) < 0.95, quality.GOOD, quality.ABSTAIN)
    votes[good] = np.where(rng.random((good.sum(), k)) < 0.002, quality.BAD, votes[good])
    bad = np.flatnonzero(~good)
    votes[bad, symptom[bad]] = np.where(rng.random(len(bad)) < 0.9, quality.BAD, quality.ABSTAIN)
    patterns, counts = np.unique(quality.pattern_of(votes), return_counts=True)
    posterior, prob, share = quality.label_model(dict(zip(patterns.tolist(), counts.tolist())))
    guess = np.array([posterior[p] for p in quality.pattern_of(votes).tolist()]) > 0.5
    shown = votes.min(axis=1) == quality.BAD
    assert (guess[good] == 1).mean() > 0.97 and (guess[~good & shown] == 0).mean() > 0.97
    assert abs(share - 0.8) < 0.05
    own = prob[np.arange(k) + 1, np.arange(k), quality.BAD]
    assert (abs(own - 0.9) < 0.08).all() and (prob[0, :, quality.BAD] <= quality.MOST_FALSE + 1e-9).all()
    assert quality.votes_from(quality.pattern_of(votes[:100])).tolist() == votes[:100].tolist()


def test_rates_on_labelled_documents(spark):
    """Junk that stays: at most 5 %, good documents that go: at most 2 %."""
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = QUERIES["op1_quality"](spark, "/root/testdata/sf0.1").join(labels, "doc_id")
    rate = {r["quality"]: r["kept"] for r in rows.groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    assert rate[0] <= 0.05 and rate[1] >= 0.98


def test_toxic_recall_on_held_out_documents(spark):
    rows = QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").filter("held_out")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in rows.groupBy("toxic", "predicted").count().collect()}
    found, all_toxic = n.get((1, 1), 0), n.get((1, 1), 0) + n.get((1, 0), 0)
    assert all_toxic > 80 and found / all_toxic >= 0.85 and n.get((0, 1), 0) / (n.get((0, 1), 0) + n[0, 0]) <= 0.01


@pytest.fixture(scope="module")
def models(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    return {"quality": quality.train(docs), "language": language_id.train(docs), "toxic": toxicity.train(docs, labels)}


def test_predictions_of_empty_and_repeated_rows(spark, models):
    texts = ["Das ist ein kurzer Text.", "!!! $$$ ###", None, "", "Das ist ein kurzer Text."]
    rows = spark.createDataFrame([(None if i == 1 else i % 3, t, "clash", 1.5) for i, t in enumerate(texts * 2)], "doc_id long, text string, lang_pred string, score double")
    for predict, model in ((quality.predict, "quality"), (language_id.predict, "language"), (toxicity.predict, "toxic")):
        assert predict(rows.limit(0), models[model]).count() == 0
        got = {}
        for r in predict(rows, models[model]).collect():
            got.setdefault(r["text"], set()).add(tuple(v for c, v in r.asDict().items() if c not in ("doc_id", "text")))
        assert len(got) == 4 and all(len(v) == 1 for v in got.values())
        assert predict(rows, models[model]).count() == len(texts) * 2


def test_null_ids_and_clashing_columns(spark):
    docs = spark.createDataFrame([(None, "one two three four five", "x"), (4, "one two three four five", "y"), (None, None, "z"), (9, "six seven eight nine ten eleven", "f")], "doc_id long, text string, fingerprint string")
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == 4
    by = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in rows}
    assert by[4, next(f for d, f in by if d == 4)] == 4
    vectors = [[1.0] + [0.0] * 63, [0.999] + [0.01] * 63, [0.0] * 63 + [1.0], None]
    frame = spark.createDataFrame([(i if i != 1 else None, v, 5) for i, v in enumerate(vectors)] + [(7, vectors[0], 6)], "vec_id long, embedding array<float>, n_links int")
    out = embedding.near_duplicates(frame).collect()
    assert len(out) == 5
    urls = spark.createDataFrame([(None, "http://x.net/fr/a", "h"), (None, "http://x.net/fr/a", "h"), (1, "http://" + "a." * 20_000 + "com/" + "p/" * 50_000, "h")], "page_id long, url string, rule string")
    out = url_filter.filter_urls(urls, url_filter.rules_frame(spark)).collect()
    assert sorted((r["page_id"] or 0, r["rule"], r["verdict"]) for r in out) == [(0, "net/fr/", "block"), (0, "net/fr/", "block"), (1, "com/", "allow")]


def test_random_texts_of_all_lengths_by_characters_and_words(spark):
    """Positions of chosen grams rise and are those of grams; equal texts have equal fingerprints."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["ab", "c", "déf", "g"]) for _ in range(n)) for n in list(range(40)) + [500]]
    rows = winnowing.fingerprints(spark.createDataFrame(list(enumerate(texts * 2)), "doc_id long, text string")).collect()
    by = {r["doc_id"]: r for r in rows}
    for i in range(len(texts)):
        assert by[i]["hashes"] == by[i + len(texts)]["hashes"] and by[i]["positions"] == by[i + len(texts)]["positions"]
        assert len(by[i]["hashes"]) == len(by[i]["positions"]) and by[i]["positions"] == sorted(by[i]["positions"])
