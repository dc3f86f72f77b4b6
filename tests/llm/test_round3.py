"""Whitening, conversation repair and line dedup against brute force and defined edge cases."""

import functools
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyslip.llm import conversation_repair, line_dedup, simhash, whitening
from tallyslip.llm.oracles import ORACLES
from tallyslip.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# --- whitening


@pytest.mark.parametrize("values", [
    np.geomspace(1, 1e-6, 64), np.r_[np.ones(8), np.full(8, 0.5), np.full(8, 0.5 + 1e-9), np.geomspace(0.4, 1e-3, 40)], 1 + 1e-7 * np.arange(64),
    np.r_[1 + 1e-13 * np.arange(10), np.linspace(0.1, 0.5, 54)], np.r_[np.ones(3), np.zeros(61)],
], ids=["spread", "clusters", "all near", "within rounding", "singular"])
def test_refined_eigenvectors(values):
    """A float32 start ends at double precision, in clusters too."""
    q, _ = np.linalg.qr(np.random.default_rng(0).normal(size=(64, 64)))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, x = whitening.eigen(a)
    assert np.abs(got - np.linalg.eigvalsh(a)[::-1]).max() < 4e-15
    assert np.abs(x.T @ x - np.eye(64)).max() < 2e-15 and np.abs(a @ x - x * got).max() < 1e-15


def test_float32_start_is_far_from_double():
    q, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(64, 64)))
    a = (q * np.geomspace(1, 1e-3, 64)) @ q.T
    _, start = np.linalg.eigh(a.astype(np.float32))
    assert np.abs(start.T.astype(float) @ start.astype(float) - np.eye(64)).max() > 1e-8


def brute_whitening(vectors, k=16):
    x = np.floor(64 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    y = (n * fit - s) / n
    values, vec = np.linalg.eigh(y.T @ y / n)
    values, vec = values[::-1], vec[:, ::-1]
    k = min(k, len(values))
    return n, ((n * x - s) ** 2).sum(axis=1), ((n * x - s) / n) @ vec[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def test_whitening_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    bad = spark.createDataFrame(
        [(-1, None, 0), (-2, [1.0, None], 0), (-3, [float("nan")] * 64, 0), (-4, [float("inf")] * 64, 0), (-5, [], 0), (-6, [0.5] * 3, 0)],
        "vec_id long, embedding array<float>, label int",
    )
    twice = rows.unionByName(rows.limit(20)).withColumn("n", F.lit("clash")).unionByName(bad.withColumn("n", F.lit("")))
    kept = twice.filter("vec_id >= 0").collect()
    n, deviation, white, explained = brute_whitening([r["embedding"] for r in kept])
    out = whitening.whiten(twice).collect()
    assert len(out) == 16 * len(kept) and {r["n"] for r in out} == {n}
    got = {(r["vec_id"], r["component"]): r for r in out}
    mine = np.array([[got[r["vec_id"], c]["whitened"] for c in range(1, 17)] for r in kept])
    assert np.abs(mine * np.sign((mine * white).sum(axis=0)) - white).max() < 1e-9
    assert all(got[r["vec_id"], 1]["deviation"] == int(d) for r, d in zip(kept, deviation))
    assert all(abs(got[kept[0]["vec_id"], c]["explained"] - explained[c - 1]) < 1e-12 for c in range(1, 17))
    assert len({r["identity_error"] for r in out}) == 1 and out[0]["identity_error"] < 1e-9


def test_whitening_edge_cases(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.whiten(frame([])).count() == 0
    same = whitening.whiten(frame([(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.5, 1.0])])).collect()
    assert len(same) == 6 and {(r["n"], r["deviation"], r["whitened"], r["identity_error"]) for r in same} == {(1, 0, 0.0, 0.0)}
    line = whitening.whiten(frame([(i, [float(i), 0.25]) for i in range(5)])).collect()  # the second direction has no variance
    assert [r["whitened"] for r in line if r["component"] == 2] == [0.0] * 5 and line[0]["identity_error"] < 1e-12
    assert sum(r["explained"] for r in line if r["vec_id"] == 0) == pytest.approx(1)
    large = whitening.whiten(frame([(1, [1e18, 0.0]), (2, [0.0, 1.0]), (3, [-1e18, 2.0])])).collect()
    assert {r["deviation"] for r in large if r["vec_id"] == 1} == {None} and all(np.isfinite(r["whitened"]) for r in large)
    exact = whitening.whiten(frame([(i, [2.0**34 + i, 3.0 * i * i]) for i in range(40)])).collect()
    _, deviation, _, _ = brute_whitening([[float(i), 3.0 * i * i] for i in range(40)])
    assert [r["deviation"] for r in sorted(exact, key=lambda r: r["vec_id"]) if r["component"] == 1] == [int(d) for d in deviation]


# --- conversation repair


def damaged(rows):
    """Rows (conv_id, turn, role, text) of a conversation after damage, in order of turn."""
    out = []
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def brute_repair(rows):
    """All edit sequences by recursion on (cost, audit) as a number and a string."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}

    @functools.cache
    def best(i, last, inserts):
        ways = [(0, "", ())] if i == len(rows) and last in ("", "a") else []

        def step(cost, letter, turn, then):
            if then:
                ways.append((then[0] + cost, letter + then[1], turn + then[2]))

        role = after[last]
        if inserts < 3:
            step(3, "I", ((full[role], ""),), best(i, role, inserts + 1))
        if i < len(rows):
            _, own, text = rows[i]
            step(4, "D", (), best(i + 1, last, 0))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                step(3 + more, "R", ((full[role], text),), best(i + 1, role, 0))
                if own[:1] == role or (own[:1] == "s" and last == ""):
                    step(more, "K", ((own, text),), best(i + 1, own[:1], 0))
        return min(ways, default=None)

    cost, audit, turns = best(0, "", 0)
    at = [t for t, _, _ in rows if t is not None]
    gaps = max(at) - min(at) + 1 - len(set(at)) if at else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest), turns


def check_repair(df, **options):
    out = conversation_repair.repair(conversation_repair.damage(df), **options)
    assert out.columns == ["conv_id", *conversation_repair.NUMBERS, "audit", "repaired_sha256"]
    got, want = {r[0]: tuple(r)[1:] for r in out.collect()}, {}
    for r in df.select("conv_id", "turn", "role", "text").collect():
        want.setdefault(r[0], []).append(tuple(r))
    assert got == {c: brute_repair(damaged(rows))[0] for c, rows in want.items()}


def test_repair_of_the_table(spark):
    check_repair(spark.read.parquet(f"{SF}/conversations.parquet").withColumn("cost", F.lit("clash")))


def test_repair_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    cursor = con.execute(ORACLES["op12_conversation_repair"])
    names = [c[0] for c in cursor.description]
    assert sorted(map(tuple, QUERIES["op12_conversation_repair"](spark, SF).select(*names).collect())) == sorted(cursor.fetchall())


@pytest.mark.parametrize("piece_rows", [2, 7, 2000])
def test_repair_in_pieces_of_any_size(spark, piece_rows):
    """Odd roles, nulls and long conversations; cutting them into pieces changes nothing."""
    rng = random.Random(4)
    rows = {}
    for conv in range(120):
        for turn in rng.sample(range(60), rng.choice([1, 2, 3, 5, 9, 40])):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            rows[conv or None, turn if turn else None] = (role, rng.choice(["a.", "b", "c!", " ", None, "d?\n", "e f g.", "h"]))
    df = spark.createDataFrame([(*k, *v) for k, v in rows.items()], "conv_id long, turn long, role string, text string")
    check_repair(df, piece_rows=piece_rows)


def test_repaired_turns(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    got = {}
    for r in conversation_repair.repaired_turns(conversation_repair.damage(df)).orderBy("conv_id", "part", "piece", "number").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    convs = {}
    for r in df.select("conv_id", "turn", "role", "text").collect():
        convs.setdefault(r[0], []).append(tuple(r))
    for c, rows in convs.items():
        want = list(brute_repair(damaged(rows))[1])
        mine = got.get(c, [])
        assert mine == want or mine == want[: len(mine)] and all(t == "" for _, t in want[len(mine):])


def test_repair_edge_cases(spark):
    frame = lambda rows: spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    none = conversation_repair.repair(frame([]).selectExpr("conv_id", "cast(turn as long) turn", "role", "text", "true alive"))
    assert none.count() == 0
    alive = lambda rows: frame(rows).selectExpr("conv_id", "cast(turn as long) turn", "role", "text", "role != 'gone' AS alive")
    rows = [("a", 0, "gone", "x."), ("b", None, "user", "x."), ("b", 3, "user", "x."), ("c", 1, "user", "word. " * 200_000), ("c", 7, "assistant", "y.")]
    got = {r["conv_id"]: r for r in conversation_repair.repair(alive(rows)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(got["a"])[1:] == (0, 0, 0, 0, 0, 0, "", empty)
    assert got["b"]["duplicate"] == 1 and got["b"]["audit"] == "KDI" and got["b"]["cost"] == 7 and got["b"]["illegal"] == 1
    assert got["c"]["audit"] == "KK" and got["c"]["gaps"] == 5
    assert got["c"]["repaired_sha256"] == hashlib.sha256(("user:" + "word. " * 200_000 + "\nassistant:y.").encode()).hexdigest()


def test_one_conversation_over_many_tasks(spark):
    """All rows in one conversation: the sort spreads it, and the pieces give what one table of weights gives."""
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["a.", "b", f"{t}.", f"{t}!"])) for t in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = [(r, True) for r in damaged(rows)]
    seen, unit = set(), []
    for (turn, role, text), alive in whole:
        bare = text.strip()
        unit.append((turn, role, text, alive, not bare, bool(bare) and bare[-1] not in ".!?", (role, text) in seen))
        seen.add((role, text))
    want, _ = conversation_repair._whole(conversation_repair.Unit(unit))
    for piece_rows in (50, 2000):
        assert list(conversation_repair.repair(conversation_repair.damage(df), piece_rows=piece_rows).first())[1:] == want


# --- line dedup


def brute_lines(rows):
    """rows: (doc_id, text); every document with the lines it keeps."""
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    below = lambda i: (i is not None, i or 0)
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(holders.get(key(x), ())) < 3 or doc == max(holders[key(x)], key=below)]
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def test_line_dedup_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = QUERIES["op13_line_dedup"](spark, SF).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(ORACLES["op13_line_dedup"]).fetchall()) and sum(r["n_dropped"] for r in got)


@pytest.mark.parametrize("batches", [1, 3, 8])
def test_line_dedup_against_brute_force(spark, batches):
    """Hot lines, nulls, repeated ids and rows, white space and letters of all kinds."""
    rng = random.Random(5)
    pool = [f"shared line number {i} of them all" for i in range(12)] + ["short", "", " \t ", "Été in Paris à Noël 2020", "exactly twenty chars"]
    odd = lambda s: rng.choice([s, s.upper() if s.isascii() else s, f"  {s}\t", s + "\r", s + " "])
    rows = []
    for i in range(150):
        lines = [odd(rng.choice(pool)) for _ in range(rng.randrange(6))] + (["the one hot line of a third of all"] if i % 3 == 0 else [])
        rows.append((rng.choice([i, i, i, None, 7]), rng.choice(["\n".join(lines)] * 9 + [None])))
    rows += rows[:10]
    rows.append((1000, "\n".join(f"line {i} of a very long text, not repeated" for i in range(20_000))))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, n_dropped string, _n int")
    got = line_dedup.dedup_lines(df, batches=batches)
    assert got.columns == ["doc_id", "text", "_n", "n_lines", "n_dropped"]
    assert sorted([(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect()], key=str) == brute_lines(rows)


def test_line_dedup_of_an_empty_table(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_line_dedup_stays_in_the_jvm(spark, capsys):
    QUERIES["op13_line_dedup"](spark, SF).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- near-dedup of the pipeline under a passage that many texts share


@pytest.mark.parametrize("passage_words", [60, 110])
def test_links_under_a_passage_that_many_texts_share(spark, passage_words):
    """Pairs that agree in 80 to 84 % of the bits, all within a passage shared by over 25 times the rows of a run, are found as if
    buckets had no limit."""
    rng = random.Random(passage_words)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    passage = [word() for _ in range(passage_words)]
    texts = []
    for _ in range(420):
        own = [word() for _ in range(90)]
        edited = list(own)
        for at in rng.sample(range(90), rng.choice([4, 5, 6, 7])):
            edited[at] = word()
        texts += [" ".join(own[:45] + passage + own[45:]), " ".join(edited[:45] + passage + edited[45:])]
    assert len(texts) > 25 * 32
    prints = []
    for t in texts:
        hashes = np.unique(simhash.shingle_hashes(t, simhash.SIMILAR_SHINGLE))
        prints.append(np.frombuffer(simhash.sketch(hashes)[0], dtype="<u8"))
    near = []
    for i in range(0, len(texts), 2):
        agree = 1 - np.bitwise_count(prints[i] ^ prints[i + 1]).sum() / (64 * simhash.LANES)
        if 0.80 <= agree <= 0.84:
            near.append(i)
    assert len(near) > 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(docs, run_rows=32).collect()}
    assert np.mean([got[i] == got[i + 1] for i in near]) >= 0.98


def test_near_dedup_stage_joins_by_pigeonring(spark, monkeypatch):
    """Pairs within four of the first 64 bits meet without any lane, in groups over and under the size of a run, and are decided by all bits."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(rng.choice(words, 300)) for _ in range(30)]
    for text in texts[:10]:  # copies with one other word
        split = text.split()
        for _ in range(4):
            split[rng.integers(300)] = "other"
            texts.append(" ".join(split))
    wide = np.array([np.frombuffer(simhash.sketch(np.unique(simhash.shingle_hashes(t, 5)))[0], dtype="<u8") for t in texts])
    apart = np.bitwise_count(wide[:, None] ^ wide[None]).astype(int)
    near = [(i, j) for i in range(len(texts)) for j in range(i) if apart[i, j, 0] <= 4 and apart[i, j].sum() <= 204]
    assert len(near) >= 20
    # no two texts share a lane
    monkeypatch.setattr(simhash, "_buckets", lambda sketches, run_rows, chain: (sketches.select(F.col("rep").alias("run"), "rep").limit(0), sketches.selectExpr("rep AS run", "rep", "1L AS n").limit(0), []))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for run_rows in (1024, 2):
        got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(docs, run_rows=run_rows).collect()}
        assert all(got[i] == got[j] for i, j in near)
        assert all(got[i] == i for i in range(30))


def test_forests_join_what_links_join(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(2)
    a, b = rng.integers(-500, 500, (2, 900))

    def parts(x, y):
        label = {}
        find = lambda v: v if label.setdefault(v, v) == v else find(label[v])
        for p, q in zip(x.tolist(), y.tolist()):
            p, q = sorted((find(p), find(q)))
            label[q] = p
        return {v: find(v) for v in list(label) if find(v) != v}

    stream = [pa.RecordBatch.from_pydict({"a": a[i : i + 100], "b": b[i : i + 100]}) for i in range(0, 900, 100)]
    for size in (500_000, 250, 1):
        monkeypatch.setattr(simhash, "BLOCK_LINKS", size)
        out = pa.Table.from_batches(simhash._forests(iter(stream)))
        assert parts(out["a"].to_numpy(), out["b"].to_numpy()) == parts(a, b) and (size < 500_000 or out.num_rows < 900)
    assert not list(simhash._forests(iter([])))
