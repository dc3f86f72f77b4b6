"""Hooks for models: detectors, readers, style classifiers and orientation scorers over tables of images.

A model is made once per Python worker by `make_model` and its contract is checked then: a wrong one ends the job before the first
image. Models see whole blocks of images, never rows; only if a block fails is it taken image by image, so that a bad image
costs no other one its result."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyslip.functions.style import STYLE_CLASSES
from tallyslip.functions.text import LABELS

#: Images, and bytes of their pixels, that are in memory at once (a larger image is a block by itself).
BLOCK_IMAGES, BLOCK_BYTES = 32, 64 << 20
TURNS = (0, 90, 180, 270)
_loaded: dict[str, Any] = {}

DETECTIONS = "image_id {id}, pos int, class_id int, score double, x1 double, y1 double, x2 double, y2 double, error_type string, message string"
TEXTS = "image_id {id}, label string, text string, confidence double, error_type string, message string"
STYLES = "image_id {id}, probs array<double>, error_type string, message string"
SCORES = "image_id {id}, degrees int, confidence double, n_lines int"


class ContractError(ValueError):
    """The model isn't the one that the tables need."""


def check_classes(model: Any, expected: Iterable[str]) -> None:
    """`model.description` must be a mapping whose `classes` are the expected ones in order: another order would give every result
    another meaning without any sign of it."""
    expected = list(expected)
    found = getattr(model, "description", None)
    if not isinstance(found, Mapping):
        raise ContractError(f"the model's description must be a mapping, not {type(found).__name__}")
    classes = found.get("classes")
    if not isinstance(classes, (list, tuple)) or list(classes) != expected:
        raise ContractError(f"the model's classes must be {expected}, not {classes!r}")


def model_of(key: str, make_model: Callable[[], Any], check: Callable[[Any], None]) -> Any:
    """The worker's model of this name, checked when it is loaded."""
    if key not in _loaded:
        model = make_model()
        check(model)
        _loaded[key] = model
    return _loaded[key]


def image_arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Pixels (height, width, channels) of a block, red first; the image source stores blue first."""
    shape = zip(*[batch.column(c).to_pylist() for c in ("height", "width", "n_channels")])
    out = []
    for i, (h, w, n) in enumerate(shape):
        flat = np.frombuffer(batch.column("pixels")[i].as_buffer(), dtype=np.uint8).reshape(h, w, n)
        out.append(flat[:, :, ::-1] if n == 3 else flat)
    return out


def blocks(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        sizes = [len(batch.column("pixels")[i].as_buffer() or b"") for i in range(batch.num_rows)]
        first, held = 0, 0
        for i, size in enumerate(sizes):
            if i > first and (i - first >= BLOCK_IMAGES or held + size > BLOCK_BYTES):
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += size
        if first < batch.num_rows:
            yield batch.slice(first)


def each(call: Callable[[list], list], inputs: list) -> list:
    """Results of `call` on a block, or of its parts one by one where it fails; an exception is the result of a failing part."""
    try:
        out = list(call(inputs))
        if len(out) != len(inputs):
            raise TypeError(f"{len(out)} results for {len(inputs)} images")
        return out
    except Exception:
        singles = []
        for x in inputs:
            try:
                (one,) = call([x])
                singles.append(one)
            except Exception as error:
                singles.append(error)
        return singles


def _run(df: DataFrame, schema: str, load: Callable[[], Any], make_columns: Callable[[Any, pa.RecordBatch, list[np.ndarray]], dict]) -> DataFrame:
    kind = df.schema["image_id"].dataType.simpleString()
    empty = df.sparkSession.createDataFrame([], schema.format(id=kind)).toArrow().schema

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for batch in blocks(stream):
            cols = make_columns(model, batch, image_arrays(batch))
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in empty], schema=empty)

    return df.mapInArrow(run, schema.format(id=kind))


def _errors(results: list) -> list[tuple[int, str, str]]:
    return [(i, type(r).__name__, str(r)) for i, r in enumerate(results) if isinstance(r, Exception)]


def detect(images: DataFrame, make_model: Callable[[], Any], key: str) -> DataFrame:
    """Boxes of every image: `model.predict(arrays)` gives per image (class_ids, scores, boxes n x 4), numbers or arrays. Its classes must be
    the five labels in order, counted from 1. An image that fails has one row with error_type and message instead."""

    def columns(model: Any, batch: pa.RecordBatch, arrays: list[np.ndarray]) -> dict:
        def call(block: list) -> list:
            out = []
            for ids, scores, boxes in model.predict(block):
                boxes = np.asarray(boxes, dtype=np.float64).reshape(-1, 4)
                ids, scores = np.asarray(ids, dtype=np.int32), np.asarray(scores, dtype=np.float64)
                if not len(ids) == len(scores) == len(boxes):
                    raise TypeError("as many classes and scores as boxes are needed")
                out.append((ids, scores, boxes))
            return out

        results = each(call, arrays)
        bad = _errors(results)
        good = [(i, r) for i, r in enumerate(results) if not isinstance(r, Exception)]
        at = [np.full(len(r[0]), i) for i, r in good] + [np.array([i for i, _, _ in bad], dtype=int)]
        n, none = sum(len(r[0]) for _, r in good), [None] * len(bad)
        join = lambda parts: np.concatenate([np.zeros(0), *parts]).tolist() + none
        boxes = np.concatenate([np.zeros((0, 4)), *[r[2] for _, r in good]])
        return {
            "image_id": batch.column("image_id").take(pa.array(np.concatenate(at).astype(np.int64))),
            "pos": [int(p) for _, r in good for p in range(len(r[0]))] + none, "class_id": [int(c) for _, r in good for c in r[0]] + none,
            "score": join(r[1] for _, r in good), **{c: boxes[:, k].tolist() + none for k, c in enumerate(("x1", "y1", "x2", "y2"))},
            "error_type": [None] * n + [t for _, t, _ in bad], "message": [None] * n + [m for _, _, m in bad],
        }

    return _run(images, DETECTIONS, lambda: model_of(key, make_model, lambda m: check_classes(m, LABELS)), columns)


def read_texts(crops: DataFrame, make_model: Callable[[], Any], key: str) -> DataFrame:
    """Text and confidence of every crop (image_id, label, pixels): `model.recognize(arrays)` gives (text or None, confidence or None) per crop."""

    def check(model: Any) -> None:
        if not callable(getattr(model, "recognize", None)):
            raise ContractError("a reader needs recognize(arrays)")

    def columns(model: Any, batch: pa.RecordBatch, arrays: list[np.ndarray]) -> dict:
        def call(block: list) -> list:
            out = [(text, None if score is None else float(score)) for text, score in model.recognize(block)]
            if any(text is not None and not isinstance(text, str) for text, _ in out):
                raise TypeError("a reader's text must be a string or None")
            return out

        results = each(call, arrays)
        good = [(None, None) if isinstance(r, Exception) else r for r in results]
        errors = {i: (t, m) for i, t, m in _errors(results)}
        what = [errors.get(i, (None, None)) for i in range(len(results))]
        return {
            "image_id": batch.column("image_id"), "label": batch.column("label"), "text": [g[0] for g in good], "confidence": [g[1] for g in good],
            "error_type": [w[0] for w in what], "message": [w[1] for w in what],
        }

    return _run(crops, TEXTS, lambda: model_of(key, make_model, check), columns)


def classify_styles(crops: DataFrame, make_model: Callable[[], Any], key: str) -> DataFrame:
    """Class probabilities of every crop: `model.predict(arrays)` gives one row of three per crop, in the order of the style classes,
    which must be the model's."""

    def columns(model: Any, batch: pa.RecordBatch, arrays: list[np.ndarray]) -> dict:
        def call(block: list) -> list:
            rows = np.asarray(model.predict(block), dtype=np.float64)
            if rows.shape != (len(block), len(STYLE_CLASSES)):
                raise TypeError(f"probabilities must be {len(block)} x {len(STYLE_CLASSES)}, not {rows.shape}")
            return [r.tolist() for r in rows]

        results = each(call, arrays)
        errors = {i: (t, m) for i, t, m in _errors(results)}
        what = [errors.get(i, (None, None)) for i in range(len(results))]
        probs = [None if isinstance(r, Exception) else r for r in results]
        return {"image_id": batch.column("image_id"), "probs": probs, "error_type": [w[0] for w in what], "message": [w[1] for w in what]}

    return _run(crops, STYLES, lambda: model_of(key, make_model, lambda m: check_classes(m, STYLE_CLASSES)), columns)


def score_turns(images: DataFrame, make_model: Callable[[], Any], key: str) -> DataFrame:
    """Scores of the four turns of every image, for `choose_orientation`: `model.score(arrays)` gives a number per turned image. A turn that
    fails, or isn't a number, has no score, as if it were minus infinity. The score is final, so n_lines is 0."""

    def check(model: Any) -> None:
        if not callable(getattr(model, "score", None)):
            raise ContractError("an orientation scorer needs score(arrays)")

    def columns(model: Any, batch: pa.RecordBatch, arrays: list[np.ndarray]) -> dict:
        turned = [np.rot90(a, -d // 90) for a in arrays for d in TURNS]  # clockwise
        results = each(lambda block: [float(s) for s in model.score(block)], turned)
        scores = [None if isinstance(r, Exception) or np.isnan(r) or r == float("-inf") else r for r in results]
        ids = batch.column("image_id").take(pa.array(np.repeat(np.arange(len(arrays)), len(TURNS))))
        return {"image_id": ids, "degrees": list(TURNS) * len(arrays), "confidence": scores, "n_lines": [0] * len(scores)}

    return _run(images, SCORES, lambda: model_of(key, make_model, check), columns)
