"""Document fingerprints by winnowing, in DataFrame functions only.

Words (lower-cased, split at white space) are hashed; hashes of `GRAM` consecutive words roll up by doubling
(one word, two, four, five). In every window of `WINDOW` consecutive gram hashes the smallest is chosen,
the rightmost of equal ones, so any passage of WINDOW + GRAM - 1 equal words gives an equal choice in both
texts. A hash of 40 bits and the position share a long, the position counted down, so the plain minimum
is rightmost on ties. Chosen (hash, position) pairs are kept in order of position.

The edited text of a document needs the text of the next one in descending id order. Ids are cut into
buckets at their quantiles; a window leads within each bucket, and each bucket also gets the first document
of the one after it as a guest row, so no task sees all rows and texts move through one shuffle. An id that repeats over
several quantiles (null ids too) is cut further by ranges of its texts' hashes, which order its rows.

A text whose first half (what an edited text keeps) has too few whole words to be sure of a shared choice is taken by
characters instead, lower-cased and with single spaces: grams and windows of 16 characters, or the largest of 8, 4, 2 and 1 that
the first half guarantees. The edited text and, for `near_next`, the next one are taken at the level of the text.

Defined results: null text counts as empty. Fewer units than a gram: one hash of all of them; no words: an empty
fingerprint. Two empty fingerprints are alike (1), an empty and another not at all (0). Very long texts are
taken whole; positions wrap at 2**24 grams, where only tie choices are affected. Repeated rows follow one another, equal ids ordered by text.
Null ids come last. A single document is its own next. Extra columns are ignored. Empty table: empty result.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM, WINDOW = 5, 4
POSITION_BITS = 24
#: Characters of grams and windows of texts with few words; level 0: by words.
LEVELS = (16, 8, 4, 2, 1)
#: Buckets per shuffle partition in which neighbours are found.
BUCKETS_PER_PARTITION = 8


def _pairwise(left: Column, right: Column, shift: int, f) -> Column:
    """f over (left[i], right[i + shift]) for every i where both are there."""
    n = F.greatest(F.size(right) - shift, F.lit(0))
    return F.zip_with(F.slice(left, 1, n), F.slice(right, shift + 1, n), f)


def gram_hashes(words: Column) -> Column:
    one = F.transform(words, lambda w: F.xxhash64(w))
    mix = lambda a, b: F.xxhash64(a, b)
    two = _pairwise(one, one, 1, mix)
    four = _pairwise(two, two, 2, mix)
    return _pairwise(four, one, 4, mix)


def _let(value: Column, f) -> Column:
    """f(value), with the value made once."""
    return F.transform(F.array(value), f)[0]


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def kept_half(text: Column) -> Column:
    """The first half of a text, which its edited version keeps."""
    return text.substr(F.lit(1), F.length(text) - F.floor(F.length(text) / 2).cast("int"))


def level_of(text: Column) -> Column:
    """0 if the kept half has WINDOW + GRAM whole words (a cut-off one follows), else the characters of a gram: the largest of
    LEVELS whose window and gram fit into the kept half."""
    pieces = WINDOW + GRAM + 1
    whole = F.size(F.filter(F.split(kept_half(text), r"\s+", pieces + 1), lambda w: w != "")) >= pieces
    kept = F.length(_normal(kept_half(text)))
    by_length = F.lit(LEVELS[-1])
    for n in reversed(LEVELS[:-1]):
        by_length = F.when(kept >= 2 * n - 1, F.lit(n)).otherwise(by_length)
    return F.when(whole, F.lit(0)).otherwise(by_length)


def _marked(grams: Column) -> Column:
    low = (1 << POSITION_BITS) - 1
    return F.transform(grams, lambda h, i: h.bitwiseAND(F.lit(~low)).bitwiseOR(F.lit(low).cast("long") - F.pmod(i, F.lit(low + 1))))


def by_characters(text: Column, level: Column) -> Column:
    """Chosen grams of `level` characters in windows of as many, marked as in with_winnow."""

    def rolled(values: Column, f) -> Column:
        for n in reversed(LEVELS[1:]):
            values = _let(values, lambda v, n=n: F.when(level > n, _pairwise(v, v, n, f)).otherwise(v))
        return values

    def grams(units: Column) -> Column:
        return F.when(F.size(units) >= level, rolled(F.transform(units, lambda c: F.xxhash64(c)), lambda a, b: F.xxhash64(a, b))).otherwise(
            F.when(F.size(units) > 0, F.array(F.xxhash64(units))).otherwise(F.array().cast("array<bigint>"))
        )

    def chosen(marked: Column) -> Column:
        few = F.when(F.size(marked) > 0, F.array(F.array_min(marked))).otherwise(marked)
        return F.when(F.size(marked) < level, few).otherwise(rolled(marked, lambda a, b: F.least(a, b)))

    units = F.filter(F.split(_normal(text), ""), lambda c: c != "")
    return F.array_distinct(_let(_marked(_let(units, grams)), chosen))


def with_winnow(df: DataFrame, text: Column, name: str, level: Column) -> DataFrame:
    """`df` with `name`: array of longs, each a chosen hash (upper 40 bits) and its position counted down."""
    words = f"_{name}_words"
    df = df.withColumn(words, F.when(level == 0, F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")).otherwise(F.array().cast("array<string>")))
    grams = F.when(F.size(words) >= GRAM, gram_hashes(F.col(words))).otherwise(
        F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
    )
    df = df.withColumn(name, _marked(grams)).drop(words)
    smaller = lambda a, b: F.least(a, b)
    df = df.withColumn(name, F.when(F.size(name) < WINDOW, F.when(F.size(name) > 0, F.array(F.array_min(name))).otherwise(F.col(name))).otherwise(
        _pairwise(_pairwise(F.col(name), F.col(name), 1, smaller), _pairwise(F.col(name), F.col(name), 1, smaller), 2, smaller)
    ))
    return df.withColumn(name, F.when(level == 0, F.array_distinct(name)).otherwise(by_characters(text, level)))


def hashes_of(chosen: Column) -> Column:
    return F.array_distinct(F.transform(chosen, lambda c: F.shiftright(c, POSITION_BITS)))


def positions_of(chosen: Column) -> Column:
    low = (1 << POSITION_BITS) - 1
    return F.transform(chosen, lambda c: F.lit(low).cast("long") - c.bitwiseAND(F.lit(low)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard of two hash arrays without repeats; two empty ones: 1."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def digest(chosen: Column) -> Column:
    """128 bits of the chosen hashes and positions, hex."""
    return F.lower(F.concat(F.lpad(F.hex(F.xxhash64(chosen)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit(1), chosen)), 16, "0")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, hashes array<long>, positions array<long>) per row."""
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).withColumn("_level", level_of(F.col("_text")))
    rows = with_winnow(rows, F.col("_text"), "_chosen", F.col("_level"))
    return rows.select(id_col, F.transform("_chosen", lambda c: F.shiftright(c, POSITION_BITS)).alias("hashes"), positions_of(F.col("_chosen")).alias("positions"))


def _bucket_of(key: Column, bounds: list[int]) -> Column:
    """How many bounds are below the key, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    edges = F.lit(bounds)
    n = len(bounds)

    def step(at, s):
        return F.when(at + s <= n, F.when(F.element_at(edges, F.least(at + s, F.lit(n))) < key, at + s).otherwise(at)).otherwise(at)

    return F.aggregate(F.lit(steps), F.lit(0), step)


def _buckets(docs: DataFrame, n: int) -> Column:
    """A number per row such that descending numbers follow the order of the rows (key descending, then hash of the text): key
    ranges between n-quantiles; a key that is several of the quantiles itself has as many buckets, by ranges of the hash."""
    row = docs.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 20 * n)).first()
    times = Counter(row[0] or [])
    bounds = sorted(times)
    at = _bucket_of(F.col("key"), bounds)
    parts = [times[k] if times[k] > 1 else 0 for k in bounds] + [0]
    most = max(parts)
    if not most:
        return at.cast("long")
    share = F.element_at(F.lit(parts), at + 1)
    hot = (share > 0) & (F.element_at(F.lit([*bounds, 0]), at + 1) == F.col("key"))
    part = F.floor((F.xxhash64("text") / F.lit(2.0**64) + 0.5) * share).cast("int")
    return at.cast("long") * (most + 1) + most - F.when(hot, F.least(part, share - 1)).otherwise(share)


def with_next(docs: DataFrame, prepare) -> DataFrame:
    """docs (key long, text string), prepared within their buckets by `prepare`, with `next` = struct of the next row's columns."""
    spark = docs.sparkSession
    text_hash = F.xxhash64("text")
    order = [F.col("key").desc(), text_hash, F.col("text")]
    n = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.withColumns({"bucket": _buckets(docs, n), "guest": F.lit(0)})
    first = F.min(F.struct(F.bitwise_not("key").alias("k"), text_hash.alias("h"))).alias("f")
    heads = sorted(docs.groupBy("bucket").agg(first).select("bucket", "f.k", "f.h").collect(), reverse=True)  # one row per bucket
    hosts = [(~heads[i][1], heads[i][2], heads[i - 1][0]) for i in range(len(heads))]  # the head of a bucket is a guest of the one above it
    if hosts:
        guests = F.broadcast(spark.createDataFrame(hosts, "key long, hash long, host long"))
        guests = docs.withColumn("hash", text_hash).join(guests, ["key", "hash"]).groupBy("host").agg(F.min_by(F.struct("key", "text"), "text").alias("g"))
        docs = docs.unionByName(guests.select("g.key", "g.text", F.col("host").alias("bucket"), F.lit(1).alias("guest")))
    rows = prepare(docs.repartition("bucket"))
    columns = [c for c in rows.columns if c not in ("bucket", "guest")]
    after = F.lead(F.struct(*[c for c in columns if c != "key"])).over(Window.partitionBy("bucket").orderBy("guest", *order))
    return rows.withColumn("next", after).filter("guest = 0").drop("bucket", "guest")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_chosen)."""
    none = -(1 << 63)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(none)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    level = F.col("level")
    rows = with_next(rows, lambda df: with_winnow(df.withColumn("level", level_of(F.col("text"))), F.col("text"), "chosen", level))
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.substring(F.col("next.text"), F.lit(1), half)))
    rows = with_winnow(rows, F.col("edited"), "edited_chosen", level)
    same = F.col("next.level") == level
    rows = rows.withColumn("_other", F.when(same, F.lit("")).otherwise(F.col("next.text")))
    rows = with_winnow(rows, F.col("_other"), "_other_chosen", level)
    rows = rows.withColumns({"_own": hashes_of(F.col("chosen")), "_edited": hashes_of(F.col("edited_chosen")), "_next": hashes_of(F.when(same, F.col("next.chosen")).otherwise(F.col("_other_chosen")))})
    return rows.select(
        F.when(F.col("key") != none, F.col("key")).alias(id_col),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        digest(F.col("chosen")).alias("fingerprint"),
        digest(F.col("edited_chosen")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_edited")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next")).alias("near_next"),
        F.size("chosen").alias("n_chosen"),
    )
