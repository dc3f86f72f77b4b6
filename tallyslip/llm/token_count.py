"""Token counts of a sentencepiece model by a map-side two-tier lookup, without a pre-token shuffle.

Pre-tokens are runs of spaces with the word behind them. That is exact for a model whose pieces hold the
space mark only at their start (checked on load) and whose normaliser is the identity: no merge then
crosses from a word into the next space. Tier 1 is a broadcast table of frequent pre-tokens with their
token counts, chosen by Misra-Gries summaries of all documents (merged in a tree, so at most
`table_entries` words pass anywhere). Tier 2 is a cache in each Python worker; what misses both is encoded by
the library in one call per batch.

Defined results: null text counts as empty (0 bytes, 0 tokens). Very long words are encoded but never
cached; very long texts are counted whole. Repeated rows and null ids give results row by row; extra columns are ignored; empty table,
empty result.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyslip.llm.common import CACHE_ENTRIES, CACHE_WORD_CHARS, batches, worker_state

MARK = "▁"
UNITS = re.compile(" *[^ ]+| +")
#: Entries of the broadcast table; with words of at most CACHE_WORD_CHARS characters this bounds its size.
TABLE_ENTRIES = 20_000
#: A document over this many tokens is over the limit.
TOKEN_LIMIT = 4096


class PieceCounter:
    """Token counts of pre-tokens. A unit is k spaces (the first also stands for the dummy prefix) and a word."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        for i in range(self.sp.get_piece_size()):
            if MARK in self.sp.id_to_piece(i).lstrip(MARK):
                raise ValueError("a piece holds the space mark inside; words can't be counted on their own")
        self.cache: dict[str, int] = {}

    def count_units(self, units: list[str]) -> list[int]:
        """A unit is a word with the spaces before it, less one; or spaces alone, at the end of a text."""
        spaces = [not u.strip(" ") for u in units]
        ids = self.sp.encode(["a" + u if s else u for u, s in zip(units, spaces)], num_threads=1)
        return [len(x) - s for x, s in zip(ids, spaces)]


def split_units(text: str) -> list[str]:
    """The units of a text; only spaces and the mark itself (which the model reads as one) separate."""
    if MARK in text:
        text = text.replace(MARK, " ")
    if not text:
        return []
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    units = UNITS.findall(" " + text)
    return [u if not u.strip(" ") else u[1:] for u in units]


def merge_summaries(a: Counter, b: Counter, entries: int) -> Counter:
    """Misra-Gries: adds counts, then takes the (entries+1)-th largest off all and drops what isn't positive."""
    a.update(b)
    if len(a) > entries:
        cut = sorted(a.values(), reverse=True)[entries]
        a = Counter({w: n - cut for w, n in a.items() if n > cut})
    return a


def frequent_units(docs: DataFrame, text_col: str, entries: int) -> list[str]:
    """The units that stay in the merged summaries of all documents; every unit with over 1/entries of all is in."""

    def summarize(stream):
        total: Counter = Counter()
        for batch in stream:
            for text in batch.column(0).to_pylist():
                if text:
                    total.update(u for u in split_units(text) if len(u) <= CACHE_WORD_CHARS)
                    if len(total) > 8 * entries:
                        total = merge_summaries(total, Counter(), entries)
        total = merge_summaries(total, Counter(), entries)
        for at in range(0, len(total), 10_000):
            part = list(total.items())[at : at + 10_000]
            yield pa.RecordBatch.from_pydict({"unit": [u for u, _ in part], "n": [n for _, n in part]})

    # one partition's summary has at most `entries` rows; merged summaries of groups of 32 partitions likewise
    parts = docs.select(text_col).mapInArrow(summarize, "unit string, n long")
    rows = parts.rdd.mapPartitions(lambda it: [Counter({r[0]: r[1] for r in it})])
    if rows.getNumPartitions() == 0:
        return []
    total = rows.treeReduce(lambda a, b: merge_summaries(a, b, entries), depth=3)
    return sorted(total, key=lambda u: (-total[u], u))


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", table_entries: int = TABLE_ENTRIES, limit: int = TOKEN_LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row."""
    spark = docs.sparkSession
    units = frequent_units(docs, text_col, table_entries)
    counts = dict(zip(units, PieceCounter(model_file).count_units(units))) if units else {}
    shared = spark.sparkContext.broadcast(counts)
    id_type = docs.schema[id_col].dataType

    def make(batch: pa.RecordBatch) -> dict:
        counter = worker_state(("pieces", model_file), lambda: PieceCounter(model_file))
        frequent, cache = shared.value, counter.cache
        texts = [split_units(t) if t else [] for t in batch.column(1).to_pylist()]
        missing = list({u for units in texts for u in units if u not in frequent and u not in cache})
        now = dict(zip(missing, counter.count_units(missing))) if missing else {}
        if len(cache) + len(now) > CACHE_ENTRIES:  # start anew with the units of this block
            now |= {u: cache[u] for units in texts for u in units if u in cache}
            cache.clear()
        get = frequent.get
        n = [sum([x if (x := get(u)) is not None else now[u] if u in now else cache[u] for u in units]) for units in texts]
        cache.update((u, k) for u, k in now.items() if len(u) <= CACHE_WORD_CHARS)
        return {"id": batch.column(0), "n_bytes": pa.compute.binary_length(batch.column(1).cast(pa.large_binary())).fill_null(0), "n_tokens": n}

    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("id", to_arrow_type(id_type)), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(batches(make, schema), f"id {id_type.simpleString()}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
