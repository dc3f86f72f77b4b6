"""Model hooks with fake models: blocks, contracts at load, bad images, orientation scores."""

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from tallyslip.functions.style import STYLE_CLASSES
from tallyslip.functions.text import LABELS
from tallyslip.operators import scoring
from tallyslip.operators.batch import choose_orientation


@pytest.fixture(scope="module")
def images(spark):
    """w x h images of one colour each: (blue, green, red) as stored."""
    rows = [(f"i{k}", 4 + k, 6, 3, bytearray(bytes([k, 2, 200 - k]) * (4 + k) * 6)) for k in range(40)]
    return spark.createDataFrame(rows, "image_id string, width int, height int, n_channels int, pixels binary").repartition(3)


def test_detector(images):
    class Detector:
        description = {"classes": list(LABELS)}

        def predict(self, block):
            if len(block) > 1 and any(a[0, 0, 2] == 7 for a in block):
                raise RuntimeError("a block with image 7")
            out = []
            for a in block:
                if a[0, 0, 2] == 7:
                    raise RuntimeError("image 7")
                n = int(a[0, 0, 2]) % 3
                out.append(([1 + k for k in range(n)], [0.5] * n, [[0, 0, a.shape[1], a.shape[0]]] * n))
            return out

    rows = scoring.detect(images, Detector, "detector").collect()
    by = {}
    for r in rows:
        by.setdefault(r["image_id"], []).append(r)
    assert [(r["error_type"], r["message"], r["pos"]) for r in by["i7"]] == [("RuntimeError", "image 7", None)]
    for k in set(range(40)) - {7}:
        got = sorted(by.get(f"i{k}", []), key=lambda r: r["pos"])
        assert [(r["pos"], r["class_id"], r["x2"], r["y2"], r["message"]) for r in got] == [(p, p + 1, 4.0 + k, 6.0, None) for p in range(k % 3)]


def test_blocks_are_bounded(images, monkeypatch):
    batch = images.coalesce(1).toArrow().to_batches()[0]
    assert [b.num_rows for b in scoring.blocks([batch])] == [32, 8]
    monkeypatch.setattr(scoring, "BLOCK_BYTES", 300)
    parts = list(scoring.blocks([batch]))
    assert sum(b.num_rows for b in parts) == 40 and all(b.num_rows == 1 or sum(len(x.as_py()) for x in b.column("pixels")) <= 300 for b in parts)


@pytest.mark.parametrize("description", [{"classes": LABELS[::-1]}, {"classes": None}, {}, ["classes"], None])
def test_wrong_models_end_the_job_at_load(images, description):
    class Wrong:
        def __init__(self):
            if description is not None:
                self.description = description

        def predict(self, block):
            raise AssertionError("never reached")

    for hook in (scoring.detect, scoring.classify_styles):
        with pytest.raises(PythonException, match="ContractError"):
            hook(images, Wrong, f"wrong {description}").collect()
    with pytest.raises(PythonException, match="ContractError"):
        scoring.read_texts(images.withColumn("label", F.lit("time")), Wrong, f"wrong reader {description}").collect()


def test_reader_and_classifier(images):
    class Reader:
        def recognize(self, block):
            return [(None, None) if a[0, 0, 2] == 3 else (5, 0.5) if a[0, 0, 2] == 4 else (f"{a[0, 0, 0]}", 0.25) for a in block]

    rows = {r["image_id"]: r for r in scoring.read_texts(images.withColumn("label", F.lit("time")), Reader, "reader").collect()}
    assert rows["i0"]["text"] == "200" and rows["i0"]["confidence"] == 0.25 and rows["i3"]["text"] is None and rows["i3"]["message"] is None
    assert rows["i4"]["error_type"] == "TypeError" and rows["i5"]["text"] == "195" and rows["i9"]["label"] == "time"

    class Classifier:
        description = {"classes": tuple(STYLE_CLASSES)}

        def predict(self, block):
            return [[0.1, 0.2, 0.7]] * len(block) if all(a[0, 0, 2] != 8 for a in block) else [[0.5, 0.5]] * len(block)

    rows = {r["image_id"]: r for r in scoring.classify_styles(images, Classifier, "classifier").collect()}
    assert rows["i1"]["probs"] == [0.1, 0.2, 0.7] and rows["i8"]["probs"] is None and rows["i8"]["error_type"] == "TypeError"


def test_orientation_scorer(spark):
    """The reference rules: a failing turn is minus infinity, upright turns get 0.02 more, the first best wins; if none has a finite
    score, wide images are turned by 90."""
    mark = lambda w, h: bytearray(b"".join(bytes([9 if (x, y) == (0, 0) else 0] * 3) for y in range(h) for x in range(w)))
    rows = [("corner", 4, 6), ("fails", 6, 4), ("half", 4, 6), ("endless", 6, 4), ("tie", 4, 6), ("bonus", 6, 4)]
    images = spark.createDataFrame([(n, w, h, 3, mark(w, h)) for n, w, h in rows], "image_id string, width int, height int, n_channels int, pixels binary")

    def scorer_for(name):
        class Scorer:
            def score(self, block):
                out = []
                for a in block:
                    upright = a.shape[0] >= a.shape[1]
                    if name == "fails" or (name == "half" and a[0, 0, 0] == 9):
                        raise RuntimeError("no text")
                    if name == "corner":  # the mark is bottom right after a turn by 180
                        out.append(1.0 if a[-1, -1, 0] == 9 else 0.0)
                    elif name == "half":
                        out.append(float("-inf") if not upright else 0.4)
                    else:
                        out.append({"endless": float("inf"), "tie": 0.5, "bonus": 0.5 if not upright else 0.49}[name])
                return out

        return Scorer

    got = {}
    for name, w, h in rows:
        one = images.filter(F.col("image_id") == name)
        turns = scoring.score_turns(one, scorer_for(name), f"turn {name}")
        assert turns.count() == 4
        ready = turns.join(one.selectExpr("image_id", "width AS w", "height AS h", "CAST(NULL AS INT) AS explicit_degrees"), "image_id")
        got[name] = choose_orientation(ready).first()["orientation"]
    assert got == {"corner": 180, "fails": 90, "half": 180, "endless": 90, "tie": 0, "bonus": 90}
