"""Language ID by a bidirectional gated recurrent network over bytes, in numpy.

The network reads the UTF-8 bytes of the lower-cased text from both ends, in windows of `WINDOW` bytes that carry `CONTEXT` bytes of their
neighbours, cut between characters. It labels every position with a distribution over languages; a document pools
them as the mean probability over the positions of its letters, so the score doesn't rise with length. Every byte of the
whole text is read. Training is backpropagation through time with Adam on a bounded sample: the whole texts, in windows of
`TRAIN_WINDOW` bytes of equal weight per document, of at most `DOCS_PER_LANG` documents of every language, those with the smallest
hashes of id and text. The network has one output per language, so what the driver holds grows with the number of languages only.

Defined results: null text, or no letter (\\p{L}): `und` with score 0. Very long texts are read whole. Repeated rows give
repeated results, null ids too; extra columns pass through, but for lang_pred and score. Empty table: empty result. No labelled documents: everything is `und`. One language: it always wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyslip.llm.common import add_from_text, crc32_mod, forget

UNKNOWN = "und"
#: Sampled documents per language, and bytes of the windows into which their whole texts are cut for training.
DOCS_PER_LANG, TRAIN_WINDOW = 300, 48
HIDDEN, WINDOW, CONTEXT = 8, 480, 16
#: Windows that are read at once.
READ_AT_ONCE = 1024
STEPS, BATCH, RATE, SEED = 300, 160, 0.02, 42
LETTER = regex.compile(r"\p{L}")
#: Bytes that belong to letters: ASCII letters and all of longer characters.
LETTER_BYTE = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])


def char_start(data: bytes, at: int) -> int:
    """The start of the character that byte `at` belongs to; `data` is UTF-8."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return min(at, len(data))


def windows(data: bytes, size: int = WINDOW, context: int = CONTEXT) -> Iterator[tuple[bytes, int, int]]:
    """Windows with the places in them that are labelled there; together these are all bytes, once."""
    first = 0
    while first < len(data):
        last = char_start(data, first + size) if first + size < len(data) else len(data)
        before, after = char_start(data, max(0, first - context)), char_start(data, last + context)
        yield data[before:after], first - before, last - before
        first = last


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class ByteGRU:
    """Two gated recurrent layers (left to right, right to left) and a softmax at every position."""

    def __init__(self, langs: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.langs = langs
        h = HIDDEN
        self.w: dict[str, np.ndarray] = {}
        for side in "fb":
            self.w["x" + side] = rng.normal(0, 0.3, (256, 3 * h))
            self.w["u" + side] = rng.normal(0, 1 / np.sqrt(h), (h, 3 * h))
            self.w["c" + side] = np.zeros(3 * h)
        self.w["v"] = rng.normal(0, 1 / np.sqrt(2 * h), (2 * h, len(langs)))
        self.w["d"] = np.zeros(len(langs))
        self.w = {k: x.astype(np.float32) for k, x in self.w.items()}

    @staticmethod
    def padded(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        length = max(map(len, data))
        ids = np.zeros((length, len(data)), dtype=np.int64)
        mask = np.zeros((length, len(data)), dtype=np.float32)
        flat = np.frombuffer(b"".join(data), dtype=np.uint8)
        sizes = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        row = np.repeat(np.arange(len(data)), sizes)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids[at, row], mask[at, row] = flat, 1
        return ids, mask

    def _layer(self, side: str, ids: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        x, u, c, h = self.w["x" + side], self.w["u" + side], self.w["c" + side], HIDDEN
        steps, n = ids.shape
        state = np.zeros((n, h), dtype=np.float32)
        out = np.zeros((steps, n, h), dtype=np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            a = x[ids[t]] + c
            b = state @ u
            gates = _sigmoid(a[:, : 2 * h] + b[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(a[:, 2 * h :] + r * b[:, 2 * h :])
            m = mask[t][:, None]
            before, state = state, state + m * z * (new - state)
            out[t] = state
            if keep is not None:
                keep.append((t, before, z, r, new, b[:, 2 * h :], m))
        return out

    def log_probabilities(self, ids: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """(steps, words, languages)."""
        sides = [self._layer(s, ids, mask, None if keep is None else keep.setdefault(s, [])) for s in "fb"]
        both = np.concatenate(sides, axis=2)
        if keep is not None:
            keep["h"] = both
        y = both @ self.w["v"] + self.w["d"]
        y -= y.max(axis=2, keepdims=True)
        return y - np.log(np.exp(y).sum(axis=2, keepdims=True))

    def gradients(self, ids: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and its gradients: cross entropy at every position, a word's positions weighing 1 together."""
        keep: dict = {}
        logp = self.log_probabilities(ids, mask, keep)
        weight = mask / mask.sum(axis=0) / ids.shape[1]
        loss = -float((logp[:, np.arange(len(label)), label] * weight).sum())
        dy = np.exp(logp)
        dy[:, np.arange(len(label)), label] -= 1
        dy *= weight[:, :, None]
        h = HIDDEN
        grad = {"v": np.einsum("tnh,tnk->hk", keep["h"], dy), "d": dy.sum(axis=(0, 1))}
        dh_all = dy @ self.w["v"].T
        for i, side in enumerate("fb"):
            u = self.w["u" + side]
            gx, gu, gc = np.zeros_like(self.w["x" + side]), np.zeros_like(u), np.zeros(3 * h, dtype=np.float32)
            back = np.zeros((ids.shape[1], h), dtype=np.float32)
            for t, before, z, r, new, b_new, m in reversed(keep[side]):
                ds = back + dh_all[t][:, i * h : (i + 1) * h]
                dz = m * ds * (new - before) * z * (1 - z)
                da_new = m * ds * z * (1 - new * new)
                dr = da_new * b_new * r * (1 - r)
                da = np.concatenate((dz, dr, da_new), axis=1)
                db = np.concatenate((dz, dr, da_new * r), axis=1)
                back = ds * (1 - m * z) + db @ u.T
                gu += before.T @ db
                gc += da.sum(axis=0)
                np.add.at(gx, ids[t], da)
            grad |= {"x" + side: gx, "u" + side: gu, "c" + side: gc}
        return loss, grad

    def train(self, data: list[bytes], label: np.ndarray, weight: np.ndarray, steps: int = STEPS, seed: int = SEED) -> list[float]:
        """Adam on words drawn with equal shares of the languages, by weight within a language."""
        rng = np.random.default_rng(seed)
        share = weight.astype(float)
        for lang in np.unique(label):
            share[label == lang] /= share[label == lang].sum()
        share /= share.sum()
        m = {k: np.zeros_like(x) for k, x in self.w.items()}
        s = {k: np.zeros_like(x) for k, x in self.w.items()}
        losses = []
        for step in range(1, steps + 1):
            pick = rng.choice(len(data), size=min(BATCH, 4 * len(data)), p=share)
            loss, grad = self.gradients(*self.padded([data[i] for i in pick]), label[pick])
            losses.append(loss)
            rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
            for k, g in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                self.w[k] = (self.w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return losses

    def fast(self) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
        """Weights for reading: columns are windows, and gates' sigmoids are tanh of half their input."""
        h = HIDDEN
        half = np.repeat(np.array([0.5, 0.5, 1.0], dtype=np.float32), h)[:, None]
        sides = [(np.ascontiguousarray(((self.w["x" + s] + self.w["c" + s]).T * half)), np.ascontiguousarray(self.w["u" + s].T * np.float32(0.5))) for s in "fb"]
        return sides, np.ascontiguousarray(self.w["v"].T), self.w["d"][:, None]

    def read(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """(languages, steps, windows) probabilities at every position of windows given as columns of byte numbers, in order of size."""
        h, (steps, n) = HIDDEN, ids.shape
        sides, v, d = self.fast()
        states = np.empty((steps, 2 * h, n), dtype=np.float32)
        a, b, gates, new = (np.empty((k, n), dtype=np.float32) for k in (3 * h, 3 * h, 2 * h, h))
        for side, (x, u) in enumerate(sides):
            state = np.zeros((h, n), dtype=np.float32)
            for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
                np.take(x, ids[t], axis=1, out=a, mode="clip")
                np.matmul(u, state, out=b)
                np.add(a[: 2 * h], b[: 2 * h], out=gates)
                np.tanh(gates, out=gates)
                gates += 1
                np.multiply(gates[h:], b[2 * h :], out=new)
                new += a[2 * h :]
                np.tanh(new, out=new)
                new -= state
                new *= gates[:h]
                new *= 0.5
                state = np.add(state, new, out=states[t, side * h : side * h + h])
                if side and t >= sizes[0]:
                    state *= t < sizes  # beyond its end a window has no state
        y = np.matmul(v, states) + d  # (steps, languages, windows)
        y -= y.max(axis=1, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(axis=1, keepdims=True)
        return y.transpose(1, 0, 2)

    def pooled(self, texts: list[str | None]) -> np.ndarray:
        """Per text the mean probabilities over its letters' positions; NaN where it has no letter."""
        parts, owner = [], []
        for i, text in enumerate(texts):
            if text and LETTER.search(text):
                own = list(windows(text.lower().encode()))
                parts.extend(own)
                owner.extend([i] * len(own))
        total, count = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        order = sorted(range(len(parts)), key=lambda k: len(parts[k][0]))
        for p in range(0, len(order), READ_AT_ONCE):
            own = [parts[k] for k in order[p : p + READ_AT_ONCE]]
            sizes = np.array([len(w) for w, _, _ in own])
            data = np.frombuffer(b"".join([w.ljust(sizes[-1], b"\0") for w, _, _ in own]), dtype=np.uint8).reshape(len(own), -1).T
            at = np.arange(sizes[-1])[:, None]
            used = LETTER_BYTE[data] & (at >= np.array([a for _, a, _ in own])) & (at < np.array([b for _, _, b in own]))
            sums = np.einsum("ltn,tn->nl", self.read(data.astype(np.intp), sizes), used.astype(np.float32))
            who = np.array([owner[k] for k in order[p : p + READ_AT_ONCE]])
            np.add.at(total, who, sums)
            np.add.at(count, who, used.sum(axis=0))
        return total / np.where(count > 0, count, np.nan)[:, None]


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteGRU | None:
    """A network from documents with a language; None if there are none."""
    spark = labelled.sparkSession
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    shares = spark.createDataFrame([(lang, min(1.0, 1.5 * (DOCS_PER_LANG + 20) / n)) for lang, n in counts.items()], "lang string, share double")
    hashed = rows.withColumn("hash", F.xxhash64(F.lit(7), "id", "text")).join(F.broadcast(shares), "lang")
    few = hashed.filter(F.col("hash") / F.lit(2.0**64) + 0.5 < F.col("share")).dropDuplicates(["lang", "hash"])
    few = few.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("hash"))).filter(F.col("n") <= DOCS_PER_LANG)

    def cut(stream):
        for batch in stream:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                whole, data, first = text.lower().encode(), [], 0
                while first < len(whole):
                    last = max(char_start(whole, first + TRAIN_WINDOW), first + 1)
                    part = whole[first:last]
                    if LETTER.search(part.decode(errors="ignore")):
                        data.append(part)
                    first = last
                if data:
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(data), pa.string()), "part": pa.array(data, pa.binary()), "weight": pa.array([1 / len(data)] * len(data))})

    cuts = few.select("lang", "text").mapInArrow(cut, "lang string, part binary, weight double").toArrow()
    sample = sorted(zip(*[cuts.column(c).to_pylist() for c in ("lang", "part", "weight")]))
    langs = sorted(counts)
    model = ByteGRU(langs)
    if sample and len(langs) > 1:
        number = {lang: k for k, lang in enumerate(langs)}
        lang, parts, weight = zip(*sample)
        model.train(list(parts), np.array([number[x] for x in lang]), np.array(weight))
    return model


def predict(docs: DataFrame, model: ByteGRU | None, text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred and score."""
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: list[str | None]) -> dict:
        forget()
        net = shared.value
        mean = net.pooled(texts)
        none = np.isnan(mean[:, 0])
        best = np.nan_to_num(mean).argmax(axis=1)
        score = np.where(none, 0.0, np.clip(np.nan_to_num(mean).max(axis=1), 0, 1))
        return {"lang_pred": [UNKNOWN if x else net.langs[k] for x, k in zip(none, best)], "score": score}

    return add_from_text(docs, text_col, make, {"lang_pred": "string", "score": "double"})


def held_out(id_col: str = "doc_id"):
    return crc32_mod(id_col, 4) == 2
