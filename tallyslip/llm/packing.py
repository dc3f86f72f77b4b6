"""Packing of token sequences by sums of squares.

Documents of one length are interchangeable, so the packing is planned on the counts per length: at most
`capacity` numbers, however many documents there are. The plan takes lengths from long to short. Each goes
to the residual gap for which the sum over gaps of the squared number of open bins becomes smallest; opening a
bin is weighed as such a move too, until as many are open as the tokens need at least; from then on a bin opens only if
no open one holds the document. Equal documents move in steps of a share of those left, between which the sums are
looked at again, so the plan is short; its rows say which ranks of a length go to which bins at which
offset. Where short documents are few, weighing the opening costs a few sequences, so the plan is also made with bins that
open only for what fits nowhere, and the plan with fewer sequences is taken. Every piece then looks up its place by its length and its rank among pieces of that length: in the
broadcast plan, or by a join with it where it has over `plan_rows` rows.
Ranks are counted by (length, bucket) with buckets of hashed row numbers, their number by the largest count of a length, so
neither a very common length nor a very common id meets in one task.

Defined results: null text is an empty document, which is its end id alone. Repeated rows (same id) are
separate documents, and so are rows with a null id. Very long texts are encoded whole and cut into pieces of the capacity. Extra columns
are ignored. Empty table, empty result.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyslip.llm.common import materialize, text_blocks, without_gc, worker_state

CAPACITY = 2048
END_ID = 0
#: Share of a length's documents that one planning step moves (at least one document).
STEP = 1 / 24
#: Pieces of one length that are ranked together.
RANKED_TOGETHER = 50_000
#: Rows of the plan that are broadcast, 24 bytes each; a longer one is joined.
PLAN_ROWS = 1_000_000
#: Ranks per join key of such a plan.
RANKS_PER_KEY = 4096


class WordIds:
    """Ids of words. Words are what stands between spaces: this tokenizer drops white space before the merges and no
    normaliser step crosses a space.

    Most words are plain: letters up to U+00FF, then common marks. The tokenizer's pattern cuts such a word into its letters and
    its marks, and its normaliser only lower-cases them, so Arrow takes them apart. Each distinct part is merged once,
    many in one text, as the ids of word ends tell them apart. Other words of common characters are joined around a digit that none
    of them holds and cut by the tokenizer's own pattern; the rest is encoded one by one. Ids lie in one flat array; a block of
    documents is put together by index arithmetic."""

    #: The digit between joined words; digits are parts of their own.
    STOP = "0"
    #: Parts per text.
    JOINED = 256
    #: Letters and marks that the pattern splits just there; no apostrophes, and nothing that the special tokens hold.
    PLAIN = r"^(?P<stem>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+)(?P<tail>[!-&(-/:;=?@\[-`{}~]*)$"
    #: What keeps a word from being joined: anything but old white space, marks, digits other than STOP and
    #: letters up to U+00FF; and the bar, which the special tokens hold.
    ODD = re.compile(r"[^\t\n\r!-/1-{}~À-ÖØ-öø-ÿ]")
    #: Keys, and characters of all keys, beyond which the cache starts anew.
    CACHE_PARTS, CACHE_CHARS = 150_000, 8 << 20

    def __init__(self, tokenizer_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        cut = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.cut = regex.compile(cut).findall
        self.merger = Tokenizer.from_file(tokenizer_file)
        self.merger.normalizer = None
        self.merger.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        chars = [chr(b) for b in range(256)]
        for c in range(0xC0, 0x100):
            for byte, char in zip(chr(c).encode(), as_bytes.pre_tokenize_str(chr(c))[0][0]):
                chars[byte] = char
        self.byte_chars = "".join(chars)
        (self.stop,) = self.tokenizer.encode(self.STOP, add_special_tokens=False).ids
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        #: Rows of parts, and of whole words with a space before them.
        self.row: dict[str, int] = {}
        self.chars = 0
        self.flat, self.edge = np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)

    def add(self, keys: list[str], ids: list[np.ndarray], sizes: np.ndarray) -> None:
        """New rows: `ids` joined are the ids of all keys, `sizes` their numbers."""
        self.row.update(zip(keys, range(len(self.row), len(self.row) + len(keys))))
        self.chars += sum(map(len, keys))
        self.flat = np.concatenate((self.flat, *ids))
        self.edge = np.concatenate((self.edge, self.edge[-1] + np.cumsum(sizes, dtype=np.int64)))

    def merge(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lower-case parts of common characters, joined, and where each part's ids stop."""
        texts = [" ".join(parts[at : at + self.JOINED]) for at in range(0, len(parts), self.JOINED)]
        texts = [t if t.isascii() else codecs.charmap_decode(t.encode(), "strict", self.byte_chars)[0] for t in texts]
        ids = [np.array(e.ids, dtype="<u4") for e in self.merger.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate(ids) if ids else np.zeros(0, dtype="<u4")
        return flat, np.flatnonzero(self.ends[flat]) + 1

    def add_parts(self, parts: list[str]) -> None:
        if parts:
            flat, stops = self.merge(parts)
            self.add(parts, [flat], np.diff(stops, prepend=0))

    def add_words(self, words: list[str]) -> None:
        """Whole words that aren't plain."""
        joined, alone = [w for w in words if not self.ODD.search(w)], [w for w in words if self.ODD.search(w)]
        if joined:
            parts = self.cut(self.STOP.join([*joined, ""]).lower())
            coded = pa.array(parts).dictionary_encode()
            flat, stops = self.merge(coded.dictionary.to_pylist())
            ids = gathered(flat, np.append(0, stops), coded.indices.to_numpy())
            stop = np.flatnonzero(ids == self.stop)
            self.add([" " + w for w in joined], [np.delete(ids, stop)], np.diff(stop, prepend=-1) - 1)
        if alone:
            ids = [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)]
            self.add([" " + w for w in alone], ids, np.array([len(x) for x in ids]))

    def rows_of(self, keys: list[str], add) -> np.ndarray:
        get = self.row.get
        found = [get(k, -1) for k in keys]
        missing = [k for k, f in zip(keys, found) if f < 0]
        if missing:
            add(missing)
            found = [f if f >= 0 else self.row[k] for k, f in zip(keys, found)]
        return np.array(found, dtype=np.int64)

    def documents(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text (null: none) as little-endian 32-bit bytes: each distinct word is looked up once."""
        if len(self.row) > self.CACHE_PARTS or self.chars > self.CACHE_CHARS:
            self.forget()
        lists = pc.split_pattern(texts.fill_null(""), " ")
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary
        taken = pc.extract_regex(words, self.PLAIN)
        plain = taken.is_valid().to_numpy(zero_copy_only=False)
        segment = np.full((len(words), 2), -1, dtype=np.int64)  # rows of a word's first and second part
        if plain.any():
            taken = taken.drop_null()
            stems = pc.utf8_lower(taken.field("stem")).dictionary_encode()
            tails = taken.field("tail").dictionary_encode()
            stem_rows = self.rows_of(stems.dictionary.to_pylist(), self.add_parts)
            tail_rows = np.array([self.rows_of([t], self.add_parts)[0] if t else -1 for t in tails.dictionary.to_pylist()], dtype=np.int64)
            segment[plain, 0] = stem_rows[stems.indices.to_numpy()]
            segment[plain, 1] = tail_rows[tails.indices.to_numpy()]
        others = [" " + w for w in words.filter(pa.array(~plain)).to_pylist()]
        segment[~plain, 0] = self.rows_of(others, lambda keys: self.add_words([k[1:] for k in keys]))
        which = segment[coded.indices.to_numpy()].ravel()
        sizes = np.append(np.diff(self.edge), 0)  # the last one, by index -1, is of no part
        at = np.append(0, np.cumsum(sizes[which].reshape(-1, 2).sum(axis=1)))[lists.offsets.to_numpy()]
        ids = gathered(self.flat, self.edge, which[which >= 0]).tobytes()
        return [ids[4 * a : 4 * b] for a, b in zip(at.tolist(), at[1:].tolist())]


def gathered(flat: np.ndarray, edge: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The slices edge[r]:edge[r + 1] of `flat`, one after the other."""
    first, size = edge[rows], edge[rows + 1] - edge[rows]
    stop = np.cumsum(size)
    return flat[np.arange(stop[-1] if len(stop) else 0) + np.repeat(first - stop + size, size)]


def cut_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """(id, piece, start, length, ids_crc32, ids binary) for every piece of every document; `ids` only if asked for."""
    id_type = docs.schema[id_col].dataType
    end = np.array([END_ID], dtype="<u4").tobytes()
    schema = pa.schema([("id", to_arrow_type(id_type)), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), *[("ids", pa.binary())] * with_ids])

    def run(stream):
        for batch in text_blocks(stream, 1):
            words = worker_state(("words", tokenizer_file), lambda: WordIds(tokenizer_file))
            rows, pieces, starts, lengths, sums, ids = [], [], [], [], [], []
            with without_gc():
                of_documents = words.documents(batch.column(1))
            for row, own in enumerate(of_documents):
                whole = own + end
                for piece, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at : at + 4 * capacity]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()), *[pa.array(ids, pa.binary())] * with_ids], schema=schema)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)
    return out.withColumnRenamed("id", id_col)


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, step: float = STEP) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, number, first bin, offset): documents of that length and those ranks go to
    consecutive bins. Lengths go from long to short; see the module for the rule."""
    fewest = -(-sum(length * n for length, n in counts.items()) // capacity)
    plans = [_plan(counts, capacity, step, weighed) for weighed in (fewest, 0)]
    return min(plans, key=lambda p: p[1])[0]


def _plan(counts: dict[int, int], capacity: int, step: float, fewest: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """The plan in which opening is weighed until `fewest` bins are open, and its number of bins."""
    plan = []
    open_bins = np.zeros(capacity + 1, dtype=np.int64)  # by residual gap; gap 0 isn't open
    ranges: list[deque] = [deque() for _ in range(capacity + 1)]
    bins = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        exact = np.arange(length, capacity + 1) == length
        while left:
            here, to = open_bins[length:], open_bins[: capacity + 1 - length]
            # what one document changes in the sum of squares: a bin goes from gap h to h - length, or is full
            change = np.where(here > 0, np.where(exact, 1 - 2 * here, 2 * (to - here + 1)), np.iinfo(np.int64).max)
            opening = 2 * int(open_bins[capacity - length]) + 1 if length < capacity else 0
            best = int(np.argmin(change))
            number = min(left, max(1, int(left * step)))
            if here[best] > 0 and (change[best] <= opening or bins >= fewest):
                gap = best + length
                number = min(number, int(open_bins[gap]))
            else:
                gap = capacity
                number = min(number, fewest - bins) if here[best] > 0 else number
                ranges[gap].append((bins, number))
                open_bins[gap] += number
                bins += number
            open_bins[gap] -= number
            todo = number
            while todo:
                first, size = ranges[gap].popleft()
                take = min(size, todo)
                if take < size:
                    ranges[gap].appendleft((first + take, size - take))
                plan.append((length, rank, take, first, capacity - gap))
                if gap > length:
                    ranges[gap - length].append((first, take))
                rank += take
                todo -= take
            if gap > length:
                open_bins[gap - length] += number
            left -= number
    return plan, bins


def pack(pieces: DataFrame, capacity: int = CAPACITY, plan_rows: int = PLAN_ROWS) -> DataFrame:
    """`pieces` (id, piece, start, length, ...) with sequence_id and offset. Two shuffles of narrow rows."""
    spark = pieces.sparkSession
    narrow = materialize(pieces.withColumn("_row", F.monotonically_increasing_id()))
    counts = {r[0]: r[1] for r in narrow.groupBy("length").count().collect()}  # at most `capacity` rows
    buckets = 16 + max(counts.values(), default=0) // RANKED_TOGETHER
    ranked = narrow.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)).cast("int"))
    per_bucket = ranked.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_bucket = materialize(per_bucket.select("length", "_bucket", before.alias("_before")))
    rank = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("_row")) - 1
    ranked = ranked.withColumn("_rank", rank).join(per_bucket, ["length", "_bucket"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    plan = sorted(plan_packing(counts, capacity))
    if len(plan) > plan_rows:
        return _joined_places(ranked, plan).select(*pieces.columns, "sequence_id", "offset")
    key = np.array([p[0] << 44 | p[1] for p in plan], dtype=np.int64)
    first = np.array([p[3] - p[1] for p in plan], dtype=np.int64)
    offset = np.array([p[4] for p in plan], dtype=np.int64)
    shared = spark.sparkContext.broadcast((key, first, offset))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        key, first, offset = shared.value
        at = np.searchsorted(key, length.to_numpy(np.int64) << 44 | rank.to_numpy(np.int64), side="right") - 1
        return pd.DataFrame({"sequence_id": first[at] + rank.to_numpy(np.int64), "offset": offset[at]})

    return ranked.withColumn("_place", place("length", "_rank")).select(*pieces.columns, "_place.sequence_id", "_place.offset")


def _joined_places(ranked: DataFrame, plan: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """`ranked` (length, _rank, ...) with its places, by an equi join on length and stretches of RANKS_PER_KEY ranks."""
    rows = ranked.sparkSession.createDataFrame(plan, "length long, first long, number long, bin long, offset long")
    stretch = lambda rank: F.floor(rank / RANKS_PER_KEY)
    rows = materialize(rows.withColumn("_key", F.explode(F.sequence(stretch(F.col("first")), stretch(F.col("first") + F.col("number") - 1)))))
    inside = (F.col("_rank") >= F.col("first")) & (F.col("_rank") < F.col("first") + F.col("number"))
    return ranked.withColumn("_key", stretch(F.col("_rank"))).join(rows, ["length", "_key"]).filter(inside).withColumn("sequence_id", F.col("bin") + F.col("_rank") - F.col("first"))
