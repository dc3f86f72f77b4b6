"""Byte-level BPE encoding and decoding by merge replay over the distinct words of a block.

A task works on blocks of documents. The distinct pre-tokens of a block that its Python worker hasn't met lie
one after the other in flat arrays; an inverted index leads from merge ranks, that is token pairs, to the
positions in words where those pairs stand. Every merge is applied in rank order, at all its positions at once, and touches its
neighbours only, whose new pairs enter the index. Every word ends with the ids that the library gives, as each word
always has its lowest rank applied first and equal ranks leftmost first. No shuffle: looking up the distinct words of
the whole corpus instead of a block's would send every pre-token through one.

Defined results: null text counts as empty: no ids, the hashes of empty strings. Very long words pass through
the same replay and aren't cached; very long texts are blocks by themselves. Repeated rows and null ids give results row by row; extra
columns are ignored. Empty table: empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import ChainMap
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyslip.llm.common import CACHE_WORD_CHARS, batches, worker_state

#: White space by Unicode, and the separators that only Python counts as such.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0                　"
#: A space beside other white space: only then can the split at spaces differ from the pattern's.
BESIDE = [pair for s in SPACES for pair in {s + " ", " " + s}]

#: Characters that the installed `regex` knows as letters, numbers or otherwise by a newer Unicode than the library,
#: for which they are unassigned; found by encoding every character before an apostrophe and a letter.
NEWER_RANGES = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE
11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA
18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE
1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
""".split()
NEWER = re.compile("[" + "".join("-".join(chr(int(end, 16)) for end in r.split("-")) for r in NEWER_RANGES) + "]")
#: An unassigned character, which takes their place where a text is split.
STAND_IN = "\u0378"

#: Ids are below 2 ** PAIR_BITS - 1; NO_TOKEN marks words' ends and merged positions, NO_RANK pairs that don't merge.
PAIR_BITS = 21
NO_TOKEN = (1 << PAIR_BITS) - 1
NO_RANK = 1 << 40
#: Words that a worker keeps with their ids, about 400 bytes each.
CACHE_ENTRIES = 600_000


def read_ranks(rank_file: str) -> dict[bytes, int]:
    with open(rank_file, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PairTable:
    """(left id, right id) -> id of their union, as an open-addressed table with vectorised lookup."""

    def __init__(self, pairs: dict[int, int]):
        self.bits = max(8, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NO_RANK, dtype=np.int64)
        left, value = np.array(list(pairs), dtype=np.int64), np.array(list(pairs.values()), dtype=np.int64)
        slot = self._slot(left)
        while len(left):
            slot_free = self.keys[slot] < 0
            _, winners = np.unique(np.where(slot_free, slot, -1), return_index=True)
            winners = winners[slot_free[winners]]
            self.keys[slot[winners]], self.values[slot[winners]] = left[winners], value[winners]
            rest = np.setdiff1d(np.arange(len(left)), winners)
            left, value, slot = left[rest], value[rest], (slot[rest] + 1) % len(self.keys)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << PAIR_BITS | right
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.values[slot], NO_RANK)
        open_ = np.flatnonzero((found != key) & (found >= 0))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & (len(self.keys) - 1)
            found = self.keys[slot]
            hit = found == key[open_]
            out[open_[hit]] = self.values[slot[hit]]
            on = ~hit & (found >= 0)
            open_, slot = open_[on], slot[on]
        return out


class MergeReplay:
    """Ranks, the pair table and a cache of encoded words."""

    def __init__(self, rank_file: str, pattern: str):
        ranks = read_ranks(rank_file)
        self.pattern = regex.compile(pattern)
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.first = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.top = max(ranks.values()) + 1
        self.text_of = [""] * self.top
        for rank in ranks.values():
            self.text_of[rank] = str(rank)
        pairs: dict[int, int] = {}  # by left << PAIR_BITS | right
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << PAIR_BITS | right] = rank
        self.pairs = PairTable(pairs)
        # tokens that form a lower rank with some neighbour
        self.falling = {part for pair, rank in pairs.items() for part in (pair >> PAIR_BITS, pair & NO_TOKEN) if rank < part}
        self.cache: dict[str, tuple[str, bytes]] = {}

    def replay(self, words: list[str]) -> list[list[int]]:
        """The ids of each word.

        Words lie one after the other, a mark before each and after the last. `index` leads from a merge's rank, that is a token
        pair, to the positions where the pair was seen. Ranks are taken in order, each at all its positions at once: in a run of
        overlapping pairs every second one, from the left. Only what a merge touches, itself and its left neighbour, gets a new pair and
        enters the index anew. (Where the new token may form a pair of a lower rank, a run is merged one pair at a time, as that pair
        then comes first.)"""
        if not words:
            return []
        data = [w.encode() for w in words]
        sizes = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        word = np.repeat(np.arange(len(data)), sizes + 1)
        starts = np.cumsum(sizes + 1) - sizes - 1
        token = np.full(len(word) + 1, NO_TOKEN, dtype=np.int64)
        inside = np.ones(len(word), dtype=bool)
        inside[starts] = False
        token[:-1][inside] = self.first[np.frombuffer(b"".join(data), dtype=np.uint8)]
        word = np.append(word, len(data))
        after, before = np.arange(1, len(token) + 1), np.arange(-1, len(token) - 1)
        rank = np.append(self.pairs(token[:-1], token[1:]), NO_RANK)
        index: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def enter(places: np.ndarray) -> None:
            ranks = rank[places]
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            edge = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(places)]
            for r, p, q in zip(ranks[edge[:-1]].tolist(), edge, edge[1:]):
                if r in index:
                    index[r].append(places[p:q])
                else:
                    index[r] = [places[p:q]]
                    heappush(waiting, r)

        if len(found := np.flatnonzero(rank < NO_RANK)):
            enter(found)
        while waiting:
            now = heappop(waiting)
            found = index.pop(now)
            places = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            places = places[rank[places] == now]
            if len(places) > 1 and (joint := after[places[:-1]] == places[1:]).any():
                head = np.append(True, ~joint)
                at = np.arange(len(places))
                depth = at - np.maximum.accumulate(np.where(head, at, 0))
                kept = depth % 2 == 0
                if now in self.falling:
                    kept = depth == 0
                    enter(places[~kept])
                places = places[kept]
            if not len(places):
                continue
            right = after[places]
            beyond = after[right]
            token[places] = now
            token[right], rank[right] = NO_TOKEN, NO_RANK
            after[places], before[beyond] = beyond, places
            touched = np.concatenate((places, before[places]))
            ranks = self.pairs(token[touched], token[after[touched]])
            rank[touched] = ranks
            touched = touched[ranks < NO_RANK]
            if len(touched):
                enter(touched)
        left = token < NO_TOKEN
        ids = token[left].tolist()
        stops = np.cumsum(np.bincount(word[left], minlength=len(data))).tolist()
        return [ids[a:b] for a, b in zip([0, *stops[:-1]], stops)]

    def parts_of(self, text: str) -> list[str]:
        """The text as pieces that the pattern splits on their own: mostly words with the space before them."""
        if text[0] != " " and text[-1] != " " and not any(pair in text for pair in BESIDE):
            head, *rest = text.split(" ")
            return [head, *[" " + r for r in rest]]
        return self.split(text)

    def split(self, text: str) -> list[str]:
        """What the pattern finds in a text."""
        if not text.isascii() and NEWER.search(text):
            return [text[m.start() : m.end()] for m in self.pattern.finditer(NEWER.sub(STAND_IN, text))]
        return self.pattern.findall(text)

    def words_of(self, part: str) -> list[str]:
        if not part.isascii() and NEWER.search(part):
            return self.split(part)
        if part[1:].isalpha() and (part[0] == " " or part[0].isalpha()):
            return [part]
        if part[1:-1].isalpha() and part[0] == " " and part[-1] in ".,":
            return [part[:-1], part[-1]]
        return self.pattern.findall(part)

    def encode_parts(self, documents: list[list[str]]) -> dict[str, tuple[str, bytes]]:
        """part -> (ids as text, decoded bytes), complete for these documents; the cache is updated."""
        cache = self.cache
        missing = {p for parts in documents for p in parts if p not in cache}
        if not missing:
            return cache
        split = {p: self.words_of(p) for p in missing}
        words = list({w for ws in split.values() for w in ws if w not in cache})
        bytes_of, text_of = self.bytes_of.__getitem__, self.text_of.__getitem__
        done = {w: (" ".join(map(text_of, ids)), b"".join(map(bytes_of, ids))) for w, ids in zip(words, self.replay(words))}
        new = {}
        for part, ws in split.items():
            pieces = [done.get(w) or cache[w] for w in ws]
            new[part] = pieces[0] if len(pieces) == 1 else (" ".join([p[0] for p in pieces]), b"".join([p[1] for p in pieces]))
        if len(cache) + len(new) > CACHE_ENTRIES:  # start anew with the words of this block
            new |= {p: cache[p] for parts in documents for p in parts if p in cache}
            cache.clear()
        cache.update((p, v) for p, v in new.items() if len(p) <= CACHE_WORD_CHARS)
        if len(cache) >= len(new):
            long = {p: v for p, v in new.items() if len(p) > CACHE_WORD_CHARS}
            return ChainMap(long, cache) if long else cache
        return ChainMap(new, cache)


def _state(rank_file: str, pattern: str) -> MergeReplay:
    return worker_state(("bpe", rank_file, pattern), lambda: MergeReplay(rank_file, pattern))


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) per row."""
    id_type = docs.schema[id_col].dataType

    def make(batch: pa.RecordBatch) -> dict:
        state = _state(rank_file, pattern)
        parts = [state.parts_of(t) if t else [] for t in batch.column(1).to_pylist()]
        known = state.encode_parts(parts)
        return {"id": batch.column(0), "ids": [[int(i) for p in ps for i in known[p][0].split()] for ps in parts]}

    schema = pa.schema([("id", to_arrow_type(id_type)), ("ids", pa.list_(pa.int32()))])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(batches(make, schema), f"id {id_type.simpleString()}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, rank_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded binary) per row; null ids decode to no bytes. An id outside the ranks is an error."""
    id_type = encoded.schema[id_col].dataType

    def make(batch: pa.RecordBatch) -> dict:
        bytes_of = worker_state(("bpe bytes", rank_file), lambda: {r: t for t, r in read_ranks(rank_file).items()})
        return {"id": batch.column(0), "decoded": [b"".join([bytes_of[i] for i in ids or ()]) for ids in batch.column(1).to_pylist()]}

    schema = pa.schema([("id", to_arrow_type(id_type)), ("decoded", pa.binary())])
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(batches(make, schema), f"id {id_type.simpleString()}, decoded binary").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): both ways in one pass over the text, ids never leave the task."""
    id_type = docs.schema[id_col].dataType

    def make(batch: pa.RecordBatch) -> dict:
        state = _state(rank_file, pattern)
        n, a, b = [], [], []
        parts = [state.parts_of(t) if t else [] for t in batch.column(1).to_pylist()]
        known = state.encode_parts(parts)
        for ps in parts:
            found = [known[p] for p in ps]
            ids = " ".join([x[0] for x in found])
            n.append(ids.count(" ") + 1 if ids else 0)
            a.append(hashlib.sha256(ids.encode()).hexdigest())
            b.append(hashlib.sha256(b"".join([x[1] for x in found])).hexdigest())
        return {"id": batch.column(0), "n_tokens": n, "ids_sha256": a, "decoded_sha256": b}

    schema = pa.schema([("id", to_arrow_type(id_type)), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(batches(make, schema), f"id {id_type.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
