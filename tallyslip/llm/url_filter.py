"""URL filters: blocked Bloom filters of listed hosts and canonical URLs in front of exact hash joins.

Only DataFrame functions. A rule is a (host, path) pair with a verdict; it fits its host and every
subdomain if the url's path starts with the rule's path. A url's host suffixes that may be listed (blocked Bloom
filter: one 64-bit block per key, `PROBES` bits in it) meet the listed hosts in a hash join, which brings the path lengths
that the list has for the host. Its canonical keys, the host with the path cut to each of these lengths, pass a second filter of
all listed keys, and what may be listed goes on to the exact hash join, which removes false positives; the longest fitting rule wins.
Any number of rules, hosts and path lengths works: a url has as many keys as the list has lengths for its hosts.

Defined results: null url or no `://`: host and path empty, no rule, verdict `allow`. Empty table: empty
result. Repeated rows: one result each, null ids too. Very long urls: they have as many keys as the list has path lengths for their hosts. Extra columns are ignored. A rule given twice: `block` wins over
`allow`. Equal lengths can't tie between different fitting rules of one url unless host and path split
differently; then the longer host wins. Only A-Z are lower-cased in hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The rule list of the production query as (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Bits of a key in its block, and Bloom bits per listed key.
PROBES, BITS_PER_KEY = 6, 16
#: Largest filter that goes to all tasks, 64-bit blocks (8 MB, for 4 million keys); beyond it the filter only lets more keys through to
#: the join, which decides alone.
MAX_BLOCKS = 1 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _mask(key: Column) -> Column:
    """`PROBES` bits of a 64-bit word, from six bits each of a second hash."""
    h = F.xxhash64(F.lit(1), key)
    mask = F.lit(0).cast("long")
    for i in range(PROBES):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def blocked_bloom(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row: `bloom`, an array of `blocks` longs. Masks of a block are or-ed map-side first."""
    per_block = keys.groupBy(_block(F.col(key), blocks).alias("block")).agg(F.bit_or(_mask(F.col(key))).alias("mask"))
    packed = per_block.agg(F.map_from_entries(F.collect_list(F.struct("block", "mask"))).alias("m"))
    none = F.lit(0).cast("long")
    return packed.select(F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda i: F.coalesce(F.try_element_at("m", i), none)).alias("bloom"))


def _may_be_listed(keys: DataFrame, key: str, n: int) -> Column:
    """Whether column `key` may be one of the n keys."""
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * 64 < n * BITS_PER_KEY:
        blocks *= 2
    mask = _mask(F.col(key))
    return F.element_at(blocked_bloom(keys, key, blocks).scalar(), _block(F.col(key), blocks) + 1).bitwiseAND(mask) == mask


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) for every row of `pages` under `rules(host, path, verdict)`."""
    listed = rules.groupBy(F.col("host").alias("suffix"), F.col("path").alias("prefix")).agg(F.max("verdict").alias("listed")).withColumn("key", F.concat("suffix", "prefix"))
    hosts = listed.groupBy("suffix").agg(F.collect_set(F.length("prefix")).alias("lengths"))
    n, n_hosts, labels_most = listed.agg(F.count(F.lit(1)), F.count_distinct("suffix"), F.max(F.size(F.split("suffix", "[.]")))).first()

    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    urls = urls.groupBy("id", "url").agg(F.count(F.lit(1)).alias("copies"))
    urls = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    none = F.lit(None).cast("string")
    labels = F.split("host", "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(labels_most or 1))), lambda k: F.array_join(F.slice(labels, -k, k), "."))
    rows = urls.withColumn("suffix", F.explode(F.concat(suffixes, F.array(none))))  # the last one stands for the url without a rule
    if n:
        rows = rows.filter(F.col("suffix").isNull() | _may_be_listed(hosts, "suffix", n_hosts)).join(hosts, "suffix", "left")
        fitting = F.filter("lengths", lambda m: m <= F.length("path"))
        prefixes = F.transform(fitting, lambda m: F.substring(F.col("path"), F.lit(1), m))
        rows = rows.withColumn("prefix", F.explode_outer(prefixes)).withColumn("key", F.concat("suffix", "prefix"))
        rows = rows.filter(F.col("suffix").isNull() | _may_be_listed(listed, "key", n))
        rows = rows.join(listed.drop("key"), ["suffix", "prefix"], "left")
    else:
        rows = rows.filter("suffix is null").withColumns({"prefix": none, "key": none, "listed": none})
    fits = F.when(F.col("listed").isNotNull(), F.struct(F.length("key").alias("len"), F.length("suffix").alias("host_len"), "key", "listed"))
    best = rows.groupBy("id", "url", "host", "path", "copies").agg(F.max(fits).alias("best"))
    return best.select(
        F.col("id").alias(id_col), "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.listed", F.lit("allow")).alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy"),
    ).drop("_copy")


def rules_frame(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")
