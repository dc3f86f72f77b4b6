"""The training-data operators against libraries, brute force and defined edge cases."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers as tok
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyslip.llm import byte_bpe, common, embedding, language_id, packing, quality, simhash, tiles, token_count, toxicity, url_filter, winnowing
from tallyslip.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "  two  spaces ", "naïve été", "The the THE.", "x" * 30_000, "word " * 5000, "日本語 テキスト", "a\nb\r\n c\t\x1c d", "▁a ▁▁b", "don't you're 123 ###", "😀 é é", "a", "a"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i if i != 5 else None, t, "en", "s", 0, "clash") for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_byte_bpe(spark, odd, docs):
    import tiktoken

    ranks = byte_bpe.read_ranks(tok.path("byte_bpe_50k.tiktoken"))
    lib = tiktoken.Encoding("own", pat_str=tok.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for df in (odd, docs):
        got = by_id(byte_bpe.digests(df, tok.path("byte_bpe_50k.tiktoken"), tok.PATTERN).collect())
        ids_of = by_id(byte_bpe.encode(df, tok.path("byte_bpe_50k.tiktoken"), tok.PATTERN).collect())
        for r in df.collect():
            ids = lib.encode_ordinary(r["text"] or "")
            assert ids_of[r["doc_id"]]["ids"] == ids
            assert got[r["doc_id"]]["n_tokens"] == len(ids)
            assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    back = by_id(byte_bpe.decode(byte_bpe.encode(docs, tok.path("byte_bpe_50k.tiktoken"), tok.PATTERN), tok.path("byte_bpe_50k.tiktoken")).collect())
    assert all(bytes(back[r["doc_id"]]["decoded"]).decode() == r["text"] for r in docs.collect())


def test_replay_on_random_strings():
    import tiktoken

    state = byte_bpe.MergeReplay(tok.path("byte_bpe_50k.tiktoken"), tok.PATTERN)
    lib = tiktoken.Encoding("own", pat_str=tok.PATTERN, mergeable_ranks=byte_bpe.read_ranks(tok.path("byte_bpe_50k.tiktoken")), special_tokens={})
    rng = random.Random(1)
    words = ["".join(rng.choice("aabcdeinrst é") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    for w in words:
        parts = state.parts_of(w)
        known = state.encode_parts([parts])
        assert [int(i) for p in parts for i in known[p][0].split()] == lib.encode_ordinary(w)


def test_token_count(odd, docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tok.path("piece_bpe_32k.model"))
    for df in (odd, docs):
        got = by_id(token_count.count_tokens(df, tok.path("piece_bpe_32k.model"), table_entries=50).collect())
        for r in df.collect():
            assert got[r["doc_id"]]["n_tokens"] == len(sp.encode(r["text"] or "", num_threads=1)), r["text"]
            assert got[r["doc_id"]]["n_bytes"] == len((r["text"] or "").encode())


def test_packing(spark, odd, docs):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tok.path("word_bpe_49k.json"))
    for df in (odd, docs):
        pieces = common.materialize(packing.cut_pieces(df, tok.path("word_bpe_49k.json")))
        rows = packing.pack(pieces).collect()
        assert sorted(map(str, packing.pack(pieces, plan_rows=0).collect())) == sorted(map(str, rows))  # a joined plan
        bins = {}
        for r in rows:
            bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for places in bins.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 2048
        own = {}
        for r in rows:
            own.setdefault(r["doc_id"], []).append(r)
        total = 0
        for r in df.collect():
            ids = np.array([*lib.encode(r["text"] or "", add_special_tokens=False).ids, 0], dtype="<u4")
            pieces = sorted(own[r["doc_id"]], key=lambda p: p["piece"])
            assert b"".join(bytes(p["ids"]) for p in pieces) == ids.tobytes()
            assert [p["ids_crc32"] for p in pieces] == [zlib.crc32(ids[i : i + 2048].tobytes()) for i in range(0, len(ids), 2048)]
            total += len(ids)
        assert len(bins) <= -(-total // 2048) + 1


def test_packing_plan_is_about_as_good_as_first_fit_decreasing():
    rng = random.Random(8)
    counts = {n: rng.randint(1, 40) for n in rng.sample(range(1, 1500), 200)}
    plan = packing.plan_packing(counts)
    gaps = []  # first fit, longest first
    for n in sorted((n for n, k in counts.items() for _ in range(k)), reverse=True):
        at = next((i for i, gap in enumerate(gaps) if gap >= n), None)
        if at is None:
            gaps.append(2048 - n)
        else:
            gaps[at] -= n
    assert max(p[3] + p[2] for p in plan) <= 1.002 * len(gaps)
    assert sum(p[2] for p in plan) == sum(counts.values()) and packing.plan_packing({}) == [] and len(packing.plan_packing({1: 1})) == 1
    assert packing.plan_packing({}) == [] and packing.plan_packing({2048: 3}) and len(packing.plan_packing({1: 1})) == 1


def test_packing_plan_scales_by_counts():
    counts = {700: 90_000, 1300: 50_000, 41: 200_000, 2048: 10, 3: 7}
    plan = packing.plan_packing(counts)
    assert sum(p[2] for p in plan) == sum(counts.values())
    bins = max(p[3] + p[2] for p in plan)
    # each 1300 takes one 700, the other 40,000 of those go in pairs, short ones fill up: no packing has fewer
    assert bins == 50_000 + 20_000 + 10


def brute_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > n)


def classes(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("block_rows", [4096, 8])
def test_simhash(spark, block_rows):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(60)) for _ in range(12)]
    texts = [None, "", "One", *base]
    for b in base[:3]:
        for _ in range(40):
            w = b.split()
            w[rng.randrange(60)] = "zz"
            texts.append(" ".join(w))
    texts += base[:2]
    got = by_id(simhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), block_rows=block_rows).collect())
    prints = [brute_fingerprint(t, 4) for t in texts]
    assert [got[i]["fingerprint"] for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    want = classes(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    assert [got[i]["component_id"] for i in range(len(texts))] == want


@pytest.mark.parametrize("block_rows, most_blocks", [(8, 1), (32, 4)])
def test_simhash_hot_key_is_cut_by_the_third_segment(spark, block_rows, most_blocks):
    """Fingerprints of one value in two segments, where keys are large: the classes are those of brute force."""
    rng = random.Random(9)
    prints = set()
    for _ in range(25):
        base = rng.getrandbits(64) & ~((1 << 26) - 1) | 0x155_0AAA
        for _ in range(12):
            near = base
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                near ^= 1 << bit
            prints.add(near)
    prints = sorted(prints)
    df = spark.createDataFrame([(np.uint64(p).astype(np.int64).item(),) for p in prints], "fp long").repartition(4)
    at = {np.uint64(p).astype(np.int64).item(): i for i, p in enumerate(prints)}
    links = [(at[a], at[b]) for a, b in simhash.near_links(df, block_rows, most_blocks).collect()]
    want = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    assert classes(len(prints), links) == classes(len(prints), want)


def test_simhash_keys_meet_every_near_pair(spark):
    """Random pairs at up to 4 bits: every pair shares a chain key."""
    rng = random.Random(5)
    rows = []
    for i in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            b ^= 1 << bit
        rows += [(i, np.uint64(a).astype(np.int64).item()), (i, np.uint64(b).astype(np.int64).item())]
    df = spark.createDataFrame(rows, "pair long, fp long")
    found = simhash.near_links(df.select("fp")).collect()
    want = {tuple(sorted((rows[2 * i][1], rows[2 * i + 1][1]))) for i in range(300)}
    assert want <= {tuple(sorted(r)) for r in found}


def test_similar_documents(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choice("lorem ipsum dolor sit amet bona fide alma mater vox".split()) + str(rng.randrange(50)) for _ in range(300)) for _ in range(30)]
    near = []
    for t in texts[:10]:
        w = t.split()
        w[rng.randrange(300)] = "changed"
        w[rng.randrange(300)] = "also"
        near.append(" ".join(w))
    rows = list(enumerate([*texts, *near, texts[0], None, ""]))
    got = by_id(simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [got[30 + i]["component_id"] for i in range(10)] == list(range(10))
    assert [got[i]["component_id"] for i in range(30)] == list(range(30))
    assert got[40]["component_id"] == 0 and got[42]["component_id"] == got[41]["component_id"] == 41


def brute_print(text, k=5):
    """The wide fingerprint as bits, or None without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return None
    hashes = {xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))}
    top = (1 << 64) - 1
    bits = 0
    for lane in range(1, simhash.LANES + 1):
        ones = [0] * 64
        for h in hashes:
            h = (h + 0x9E3779B97F4A7C15 * lane) & top
            h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & top
            h = (h ^ h >> 27) * 0x94D049BB133111EB & top
            h ^= h >> 31
            for b in range(64):
                ones[b] += h >> b & 1
        bits |= sum(1 << b for b in range(64) if 2 * ones[b] > len(hashes)) << 64 * (lane - 1)
    return bits


def brute_groups(texts):
    prints = [brute_print(t) for t in texts]
    most = 64 * simhash.LANES // 5
    same = lambda p, q: p is q is None or None not in (p, q) and (p ^ q).bit_count() <= most
    return classes(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if same(prints[i], prints[j])])


@pytest.mark.parametrize("run_rows, chain", [(1024, 4), (6, 2)])
def test_similar_documents_as_by_brute_force(spark, run_rows, chain):
    """Repeated lines neither link different texts nor part copies; pairs around the similarity, short texts, and a group far larger
    than a run, as all pairs of fingerprints say."""
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    line = words(16)
    texts = [" ".join(words(104) + line * 10) for _ in range(4)]  # few common shingles, votes nearly all of the line
    texts += [" ".join(a + b * n + c) for a, b, c in [(words(50), words(14), words(50))] for n in (1, 5)]
    for n in (104, 304):
        for tail in range(n // 12, n // 4, 3):  # a cosine from about 0.92 to 0.7
            base = words(n)
            texts += [" ".join(base), " ".join(base[:-tail] + words(tail))]
    for n in (8, 9, 10, 13):
        base = words(n)
        texts += [" ".join(base), " ".join(base + words(1)), " ".join(words(1) + base), " ".join(base + words(2))]
    texts += [" ".join(line * n) for n in (1, 3)] + [texts[0], None, "", "one", "One", "one two"]
    base = words(120)
    for _ in range(40):  # one group of near copies
        copy = list(base)
        copy[rng.randrange(120)] = "changed"
        texts.append(" ".join(copy))
    passage = words(60)
    texts += [" ".join([*words(90), *passage]) for _ in range(30)]  # a passage that many different texts share
    rows = list(enumerate(texts))
    got = by_id(simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), run_rows=run_rows, chain=chain).collect())
    want = brute_groups(texts)
    assert [got[i]["component_id"] for i in range(4)] == [0, 1, 2, 3] and got[5]["component_id"] == 4
    assert [got[i]["component_id"] for i in range(len(texts))] == want


def test_similar_recall_near_the_bar(spark):
    """Planted pairs whose fingerprints agree in 80 to 84 % of the bits: at least 0.98 of them are found."""
    rng = random.Random(17)
    texts = []
    for _ in range(300):
        base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        copy = list(base)
        for at in rng.sample(range(120), 5):
            copy[at] = "x"
        texts += [" ".join(base), " ".join(copy)]
    prints = [brute_print(t) for t in texts]
    near = [i for i in range(0, 600, 2) if 0.16 * 1024 <= (prints[i] ^ prints[i + 1]).bit_count() <= 0.2 * 1024]
    got = by_id(simhash.similar_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    assert len(near) > 50 and sum(got[i + 1]["component_id"] == i for i in near) >= 0.98 * len(near)


def test_one_of_each_with_null_and_repeated_ids(spark):
    import corpus_pipeline

    rng = random.Random(13)
    own = [" ".join(f"v{rng.randrange(10**6)}" for _ in range(40)) for _ in range(8)]
    rows = [(None, own[0]), (None, own[1]), (None, own[2]), (5, own[3]), (5, own[4]), (5, own[5]), (6, own[5]), (None, own[6]), (7, own[6]), (7, own[7] + " end"), (7, own[7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = corpus_pipeline.one_of_each(spark, docs, SF)
    assert out.columns == docs.columns
    got = [(r["doc_id"], r["text"].removesuffix(" end")) for r in out.collect()]
    want = [(None, own[0]), (None, own[1]), (None, own[2]), (5, own[3]), (5, own[4]), (5, own[5]), (7, own[6]), (7, own[7])]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("block_rows", [2048, 10])
def test_embedding(spark, block_rows):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((120, 16))
    x = np.concatenate((x, x[:40] + 0.2 * rng.standard_normal((40, 16)), np.tile(x[:1], (5, 1)), x[1] * 3 + 0.35 * rng.standard_normal((40, 16))))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (904, []), (905, [1.0, 2.0])]
    got = {r["vec_id"]: r for r in embedding.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block_rows=block_rows).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    assert [got[i]["n_links"] for i in range(len(x))] == link.sum(axis=1).tolist()
    assert [got[i]["component_id"] for i in range(len(x))] == classes(len(x), np.argwhere(link).tolist())
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(900, 906))


def test_quantised_bounds_hold():
    rng = np.random.default_rng(2)
    u = rng.standard_normal((50, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    codes, scale, size, error = embedding.quantise(u)
    near = (codes.astype(float) @ codes.astype(float).T) * scale[:, None] * scale[None, :]
    bound = size[:, None] * error[None, :] + error[:, None] * size[None, :] + error[:, None] * error[None, :]
    assert (np.abs(near - u @ u.T) <= bound + 1e-12).all()


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 400), (7, 7), (None, 3)]
    got = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 400: 400, 500: 400}


def test_winnowing(spark, odd):
    rng = random.Random(2)
    texts = [None, "", "one two", *[" ".join(rng.choice("alpha beta gamma delta eps zeta".split()) for _ in range(rng.randint(1, 80))) for _ in range(60)]]
    rows = [(7 * i % 101, t) for i, t in enumerate(texts)]
    got = by_id(winnowing.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect())
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    for i, (k, t) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert got[k]["n_chars"] == len(t) and got[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[k]["near_edited"] <= 1 and 0 <= got[k]["near_next"] <= 1
        assert (got[k]["edited_fingerprint"] == got[k]["fingerprint"]) == (got[k]["near_edited"] == 1 and edited.lower().split() == t.lower().split()) or t == ""
    assert winnowing.edited_fingerprints(odd).count() == len(ODD)
    assert winnowing.edited_fingerprints(odd.limit(0)).count() == 0


def test_winnowing_next_of_ids_that_repeat(spark):
    """Null and repeated ids, many of the rows: the next one by descending id and the hash of the text, over all buckets."""
    rng = random.Random(8)
    rows = [(rng.choice([None, None, 7, 7, rng.randrange(50), -(1 << 62)]), f"{i} " + "abc " * rng.randint(0, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.xxhash64("text")).repartition(5)
    order = sorted(df.collect(), key=lambda r: (-r["doc_id"] if r["doc_id"] is not None else 1 << 63, r["h"], r["text"]))
    want = []
    for i, r in enumerate(order):
        t, after = r["text"], order[(i + 1) % len(order)]["text"]
        want.append((r["doc_id"], hashlib.sha256((t[: len(t) - len(t) // 2] + after[: len(t) // 2]).encode()).hexdigest()))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    got = [(r["doc_id"], r["edited_sha256"]) for r in winnowing.edited_fingerprints(df.drop("h")).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    keyed = df.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key"), "text")
    sizes = keyed.groupBy(winnowing._buckets(keyed, 40).alias("b")).count().agg(F.max("count")).first()[0]
    assert sizes <= 40


def test_winnowing_half_edited_texts_are_alike(spark):
    """Whatever keeps its first half shares a choice, from one word up and without white space; the next text shares none."""
    rng = random.Random(6)
    word = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    texts = [" ".join(word("abcdefghijklm", rng.randint(1, 14)) for _ in range(n)) for n in [*range(1, 41), 100, 300] for _ in range(2)]
    texts += [word("abcdefghijklm", n) for n in (2, 3, 30, 61, 5000)] + ["\u65e5\u672c\u8a9e\u306e" * 40, "x" * 200 + " a b c d e f g h i j", " A  b\tC  d\n"]
    others = [word("nopqrstuvwxyz", len(t)) for t in texts]
    rows = [r for i, (t, o) in enumerate(zip(texts, others)) for r in ((2 * i + 1, t), (2 * i, o))]
    got = by_id(winnowing.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    for i, t in enumerate(texts):
        r = got[2 * i + 1]
        assert 0 < r["near_edited"] and (r["near_edited"] < 1 or len(t) < 2 or "\u65e5" in t or t[0] in "x "), t
        if t[0] not in "x ":
            assert r["near_next"] == 0, t
    copies = [(3, "one two"), (2, "One  two"), (1, " ".join(["same"] * 3)), (0, "same same same")]
    got = by_id(winnowing.edited_fingerprints(spark.createDataFrame(copies, "doc_id long, text string")).collect())
    assert got[3]["near_next"] == got[1]["near_next"] == 1 and got[2]["near_next"] < 1


def test_winnowing_choice_and_guarantee(spark):
    """Chosen positions are those of a plain reading of the rule; a shared passage of window + gram - 1 words shares a hash."""
    words = "a b a b a b a b a b c d e f g h i j k l m n".split()
    shared = "p q r s t u v w".split()
    assert len(shared) == winnowing.WINDOW + winnowing.GRAM - 1
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(["x1", "x2", *shared, "x3"])), (3, " ".join([*shared, "y"]))], "doc_id long, text string")
    rows = by_id(winnowing.fingerprints(df).collect())
    grams = spark.createDataFrame([(words,)], "w array<string>").select(winnowing.gram_hashes(F.col("w")).alias("g")).first()["g"]
    low = (1 << winnowing.POSITION_BITS) - 1
    grams = [g & ~low for g in grams]
    want = sorted({min(range(i, i + winnowing.WINDOW), key=lambda p: (grams[p], -p)) for i in range(len(grams) - winnowing.WINDOW + 1)})
    assert sorted(rows[1]["positions"]) == want
    assert set(rows[2]["hashes"]) & set(rows[3]["hashes"])


def test_language_id_gradients():
    rng = np.random.default_rng(0)
    net = language_id.ByteGRU(["x", "y"])
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    ids, mask = net.padded([b"abc", b"de", b"f"])
    label = np.array([0, 1, 0])
    _, grad = net.gradients(ids, mask, label)
    for k in ("uf", "ub", "v", "cf", "d"):
        at = tuple(rng.integers(0, s) for s in net.w[k].shape)
        keep = net.w[k][at]
        net.w[k][at] = keep + 1e-3
        up, _ = net.gradients(ids, mask, label)
        net.w[k][at] = keep - 1e-3
        down, _ = net.gradients(ids, mask, label)
        net.w[k][at] = keep
        assert abs((up - down) / 2e-3 - grad[k][at]) < 2e-3


def test_language_id(spark, odd):
    rows = QUERIES["op5_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = rows.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held > 0.9
    model = language_id.train(odd)
    got = {r["text"]: r["lang_pred"] for r in language_id.predict(odd, model).collect()}
    assert got[None] == got[""] == got[" "] == "und" and got["a"] == "en"
    assert {r["lang_pred"] for r in language_id.predict(odd, None).collect()} == {"und"}


def test_toxicity(spark, odd):
    rows = QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    right = rows.filter("held_out").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert right > 0.9
    none = toxicity.train(odd, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.predict(odd, none).filter("score is null").count() == 0


def test_quality(spark, odd):
    rows = QUERIES["op1_quality"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    clean = rows.filter("quality = 1").agg(F.avg(F.col("keep").cast("int"))).first()[0]
    junk = rows.filter("quality = 0").agg(F.avg(F.col("keep").cast("int"))).first()[0]
    assert clean > 0.95 and junk < 0.6
    got = {r["text"]: r["keep"] for r in quality.predict(odd, quality.train(odd)).collect()}
    assert not got[None] and not got[""] and not got[" "]
    assert quality.train(odd.limit(0)) is None


def test_url_filter(spark):
    urls = [None, "", "no scheme", "HTTP://A.EXAMPLE.com/en/x?q#f", "http://www.Example.com/en/", "http://example.com/en", "http://com/", "http://x.net/fr/y", "http://net/es/", "http://x.net/FR/", "http://notexample.com/en/", "http://a.com", "http://xnet/es/", "http://a.com#/en/", "http://a.com/"]
    df = spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate(urls)] + [(2, "no scheme", "h", "x")], "page_id long, url string, html string, host string")
    rows = url_filter.filter_urls(df, url_filter.rules_frame(spark)).collect()
    assert len(rows) == len(urls) + 1
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in rows}
    for i, u in enumerate(urls):
        host, path = "", ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
            host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert got[i] == ((max(fits)[1], max(fits)[2]) if fits else (None, "allow")), u
    assert url_filter.filter_urls(df, url_filter.rules_frame(spark).limit(0)).filter("rule is not null").count() == 0


def test_url_filter_many_rules(spark):
    rng = random.Random(4)
    listed = sorted({(f"h{rng.randrange(200)}.org", f"/p{rng.randrange(30)}/") for _ in range(1500)})
    rules = spark.createDataFrame([(h, p, "block") for h, p in listed], "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, f"http://sub.h{rng.randrange(220)}.org/p{rng.randrange(32)}/x") for i in range(2000)], "page_id long, url string")
    for r in url_filter.filter_urls(pages, rules).collect():
        key = (r["host"].removeprefix("sub."), r["path"][:-1])
        assert (r["verdict"] == "block") == (key in listed)


def test_url_filter_with_very_many_path_lengths(spark):
    """More shapes of hosts and path lengths than any fixed limit: every rule is found, on subdomains too."""
    rng = random.Random(14)
    listed = [(".".join(["x" * (1 + i % 7)] * (1 + i % 9)) + f"{i % 300}.org", "/" + "p" * (i % 900) + "/") for i in range(6000)]
    rules = spark.createDataFrame([(h, p, "block") for h, p in listed], "host string, path string, verdict string")
    picked = rng.sample(listed, 200)
    pages = spark.createDataFrame([(i, f"http://sub.{h}{p}q?z" if i % 2 else f"http://{h}{p[:-1]}") for i, (h, p) in enumerate(picked)], "page_id long, url string")
    got = by_id([{"doc_id": r["page_id"], **r.asDict()} for r in url_filter.filter_urls(pages, rules).collect()])
    for i, (h, p) in enumerate(picked):
        path, host = (p + "q", "sub." + h) if i % 2 else (p[:-1], h)
        want = max((len(a + b), len(a), a + b) for a, b in [*listed, ("", "")] if path.startswith(b) and (host == a or host.endswith("." + a) or not a))[2] or None
        assert got[i]["rule"] == want
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    assert byte_bpe.digests(none, tok.path("byte_bpe_50k.tiktoken"), tok.PATTERN).count() == 0
    assert token_count.count_tokens(none, tok.path("piece_bpe_32k.model")).count() == 0
    assert packing.pack(packing.cut_pieces(none, tok.path("word_bpe_49k.json"))).count() == 0
    assert simhash.near_duplicates(none).count() == 0 and simhash.similar_documents(none).count() == 0
    assert embedding.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pipeline_stages_on_odd_rows(spark):
    """Nulls, empties, long texts, ties, repeated rows, an empty table and clashing names, stage by stage."""
    import corpus_pipeline

    rng = random.Random(21)
    text = lambda n: " ".join(rng.choice("the house of a man and his dog went to town with".split()) + rng.choice(["", "s", "er"]) for _ in range(n))
    texts = [None, "", " ", "12 %% 34", text(60), text(60), text(20_000), "y" * 30_000, text(50) + ".", "#$%# &&& *** !!! " * 30]
    rows = [(i if i % 3 else None, t, "en", "s", 1, "own score", "own row", i) for i, t in enumerate([*texts, texts[4], texts[4]])]
    names = "doc_id long, text string, lang string, source string, n_chars long, score string, _row string, keep long"
    docs = spark.createDataFrame(rows, names).repartition(3)
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, SF)
        assert out.schema.names == docs.schema.names
        got = out.collect()
        assert all(r["score"] == "own score" and r["_row"] == "own row" for r in got) and len({r["keep"] for r in got}) == len(got)
        assert stage(spark, docs.limit(0), SF).count() == 0
        kept = {r["keep"] for r in got}
        if name == "simhash_dedup":
            assert {k for k in kept if k not in (4, 10, 11)} == {1, 3, 5, 6, 7, 8, 9} and len(kept & {4, 10, 11}) == 1 and 0 not in kept
        else:
            assert not kept & {0, 1, 2} and {4, 5, 6, 8, 10, 11} <= kept
    packed = corpus_pipeline.packed(spark, docs, SF).collect()
    assert len({(r["doc_id"], r["piece"], r["sequence_id"], r["offset"]) for r in packed}) == len(packed)
    assert corpus_pipeline.packed(spark, docs.limit(0), SF).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    ids = {r["doc_id"] for r in rows}
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert 0.5 * n < len(ids) < n


def test_tile_bounds_leave_doubt_only_near_the_threshold(monkeypatch):
    """What a tile calls sure and what it recomputes equal brute force at the exact threshold."""
    monkeypatch.setattr(embedding, "PAIRS", 7)
    rng = np.random.default_rng(9)
    u = rng.standard_normal((40, 8))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    short = embedding.Short.unpacked(embedding.Short(*embedding.quantise(u)).packed())
    sure, maybe = embedding.tile_bounds(short, short, 0.5)
    want = np.einsum("ik,jk->ij", u, u) >= 0.5
    i, j = np.nonzero(maybe)
    good = embedding.exact_pairs(u, i, j, 0.5)
    assert (sure <= want).all() and (want <= sure | maybe).all() and maybe.any() and not maybe.all()
    sure[i[good], j[good]] = True
    assert (sure == want).all()
    assert tiles.FAN_OUT > 1 and duckdb is not None


def test_embedding_recall_near_the_threshold(spark):
    """Planted pairs at 0.90-0.92 among random vectors, as by brute force."""
    rng = np.random.default_rng(12)
    x = rng.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((1000, 64))
    z -= (z * x[:1000]).sum(axis=1, keepdims=True) * x[:1000]
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    c = rng.uniform(0.9, 0.92, (1000, 1))
    x = np.concatenate((x, c * x[:1000] + np.sqrt(1 - c * c) * z))
    got = embedding.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = int(((u @ u.T) >= 0.9).sum() - len(x))
    assert want >= 1990 and got.agg(F.sum("n_links")).first()[0] >= 0.99 * want


def test_packing_words_are_encoded_as_by_the_library():
    words = packing.WordIds(tok.path("word_bpe_49k.json"))
    texts = ["", None, "Don't  'S 0 100 a0b x7 don'", "ÀÖ÷ Éré, İstanbul ΣΑΣ é µm ²½ ß<|endoftext|> <|ENDOFTEXT|> </w> a</w>b", "a\nb\tc.\r\nd   \x85 \x1c 　e", "' " * 3 + "'ll 'LL ... !?<|>| ¿qué? 你好 🙂 ́", "Don't don't, don't", "x" * 300 + " 0", "Été, été; ÉTÉ! (word) a--b c... x_y _ `a` {b} ÿ×÷"]
    expected = [np.array(words.tokenizer.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    for _ in range(2):  # without and with the cache
        assert words.documents(pa.array(texts)) == expected
    assert words.documents(pa.array([], pa.string())) == []
