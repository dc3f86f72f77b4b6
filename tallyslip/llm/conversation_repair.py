"""Repair of conversation structure: the cheapest edits that bring turns into the order system?, (user, assistant)+.

Edits of a conversation are a path through a graph of (row, state of the role pattern). Every path weighs one integer: its cost in the
high digits, below them a fixed number of digits with its edit letters in order, the first letter highest, zeros behind the last. So the
smaller integer is the cheaper path and, at equal cost, the letters that come first in ASCII order. The table of smallest weights is
filled from the last row to the first: an edge moves the letters behind it one digit down and puts its own in front.

Rows are sorted by ranges of (conversation, turn), so one large conversation is spread over many tasks. A conversation that lies inside
one range and in one piece of at most PIECE_ROWS rows and PIECE_BYTES bytes is repaired where it is read. Others, those at the edges of
ranges and the large ones, go on as pieces: inserts stand in front of a row, so no path through a piece is the beginning of another one,
and a piece is summed up by the costs and the order of its 16 smallest weights (from each state to each). These are put together per
conversation, each piece is then repaired by itself, and digests are taken in a stream over the pieces.

Faults (first one counts): blank, duplicate (role and text seen earlier in the conversation), truncated (last character that isn't white
space isn't one of .!?). Edits: Keep 0; Rerole to user or assistant 3; Delete 4, the only one for blank and duplicate rows; Insert a user
or assistant turn with empty text 3; a truncated row that stays costs 3 more.

Defined results: null role or text: one space (blank; a role with another initial can't stay as it is, nor can an empty one). Null turns
come first; rows of equal turn by role, then by a hash of the text; equal rows are duplicates. Null conversation ids are one conversation.
Without rows (all dropped): zeros, empty audit, digest of nothing. Very long texts are never cut; very long conversations: see above.
Empty table: empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyslip.llm.common import discard, materialize

PIECE_ROWS, PIECE_BYTES = 2000, 8 << 20
#: Costs, letters in ASCII order (0 ends an audit), white space.
RETAIN, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
LETTERS = " DIKR"
D, I, K, R = 1, 2, 3, 4
SPACES = " \t\n\x0b\x0c\r"
#: States: nothing yet, after system, after user, after assistant; the role that has to follow, and the state behind it.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: What is inserted behind the last row, by state.
TAIL = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
LEGAL = {"su", "ua", "au"}


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv_id, turn, role, text, alive) with the faults that crc32 of `conv:turn` modulo 20 calls for; dropped rows stay as not alive."""
    key = F.concat(F.coalesce(F.col(conv).cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col(turn).cast("string"), F.lit(" ")))
    fault = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (fault != 0).alias("alive"), F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _fault_columns() -> dict[str, Column]:
    bare = F.btrim(F.col("text"), F.lit(SPACES))
    return {"blank": bare == "", "cut": ~F.right(bare, F.lit(1)).isin(".", "!", "?"), "hash": F.xxhash64("role", "text"), "hash2": F.xxhash64(F.lit(1), "role", "text")}


class Paths:
    """Smallest weights of the paths through some rows, from their end to their beginning.

    A row is (initial, stays, cut): the first letter of its role, whether it may stay, whether it is truncated."""

    def __init__(self, rows: list[tuple[str, bool, bool]], end: dict[int, tuple[int, list[int]]]):
        digits = 3 * len(rows) + 8
        self.bits = 3 * digits
        self.top, self.low = self.bits - 3, (1 << self.bits) - 1
        best: list[int | None] = [self.weight(*end[q]) if q in end else None for q in range(4)]
        for row in reversed(rows):
            best = self._before(row, best)
        self.best = best

    def weight(self, cost: int, letters: Iterable[int]) -> int:
        w, at = cost << self.bits, self.top
        for letter in letters:
            w, at = w | letter << at, at - 3
        return w

    def _edge(self, cost: int, letter: int, w: int) -> int:
        behind = w & self.low
        return w - behind + (cost << self.bits) + (letter << self.top) + (behind >> 3)

    def _before(self, row: tuple[str, bool, bool], after: list[int | None]) -> list[int | None]:
        initial, stays, cut = row
        more = TRUNCATED if cut else 0
        out: list[int | None] = []
        for q in range(4):
            ways = []
            if after[q] is not None:
                ways.append(self._edge(DELETE, D, after[q]))
            if stays:
                then = NEXT[q]
                if after[then] is not None:
                    ways.append(self._edge(REROLE + more, R, after[then]))
                    if initial == ROLE_OF[then][0]:
                        ways.append(self._edge(RETAIN + more, K, after[then]))
                if q == START and initial == "s" and after[SYSTEM] is not None:
                    ways.append(self._edge(RETAIN + more, K, after[SYSTEM]))
            out.append(min(ways, default=None))
        base = out
        for _ in range(2):  # more than two inserts in front of a row lead back to a state
            grown = []
            for q in range(4):
                ways = [w for w in (base[q],) if w is not None]
                if out[NEXT[q]] is not None:
                    ways.append(self._edge(INSERT, I, out[NEXT[q]]))
                grown.append(min(ways, default=None))
            out = grown
        return out

    def cost(self, q: int) -> int:
        return self.best[q] >> self.bits

    def letters(self, q: int) -> list[int]:
        w, at, out = self.best[q], self.top, []
        while at >= 0 and w >> at & 7:
            out.append(w >> at & 7)
            at -= 3
        return out


#: Ends of a whole conversation, and of a piece that has to end in one state.
WHOLE = {q: (INSERT * n, [I] * n) for q, n in TAIL.items()}


def replay(letters: list[int], q: int, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that the edits leave, starting in state q."""
    at = 0
    for letter in letters:
        if letter == I:
            q = NEXT[q]
            yield "I", ROLE_OF[q], ""
            continue
        if letter == K:
            q = SYSTEM if q == START and roles[at][:1] == "s" else NEXT[q]
            yield "K", roles[at], texts[at]
        elif letter == R:
            q = NEXT[q]
            yield "R", ROLE_OF[q], texts[at]
        at += 1


class Unit:
    """Rows of a conversation, all or a piece, in order, dropped ones among them."""

    def __init__(self, rows: list[tuple]):
        """rows: (turn, role, text, alive, blank, cut, seen)"""
        rows = [r for r in rows if r[3]]
        self.turns = [r[0] for r in rows if r[0] is not None]
        self.roles, self.texts = [r[1] for r in rows], [r[2] for r in rows]
        blank, seen = [r[4] for r in rows], [r[6] and not r[4] for r in rows]
        cut = [r[5] and not r[4] and not r[6] for r in rows]
        self.faults = [sum(blank), sum(seen), sum(cut)]
        self.initials = [r[:1] for r in self.roles]
        self.illegal = sum(a + b not in LEGAL for a, b in zip(self.initials, self.initials[1:]))
        self.rows = [(i, not (b or s), c) for i, b, s, c in zip(self.initials, blank, seen, cut)]

    def distinct_turns(self) -> int:
        return len(set(self.turns))


def _long(x: int) -> int:
    return min(x, 2**63 - 1)


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
RESULT = ", ".join(f"{c} long" for c in NUMBERS) + ", audit string, repaired_sha256 string"
TURN = "edit string, role string, text string"


def _whole(unit: Unit) -> tuple[list, list[tuple[str, str, str]]]:
    """Result columns of a whole conversation, and its repaired turns."""
    paths = Paths(unit.rows, WHOLE)
    letters = paths.letters(START)
    turns = list(replay(letters, START, unit.roles, unit.texts))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in turns).encode()).hexdigest()
    gaps = max(unit.turns) - min(unit.turns) + 1 - unit.distinct_turns() if unit.turns else 0
    return [_long(gaps), *unit.faults, unit.illegal, paths.cost(START), "".join(LETTERS[x] for x in letters), digest], turns


def _frame(cols: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in schema], schema=schema)


def _first_pass(id_type: pa.DataType, with_turns: bool, piece_rows: int):
    """Whole conversations get their result; rows of the others come out as pieces (part, piece, at)."""
    names = [*NUMBERS, "audit", "repaired_sha256", "turns", "part", "piece", "at", "turn", "role", "text", "alive"]
    struct = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
    kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [struct, pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
    schema = pa.schema([("conv_id", id_type), *zip(names, kinds)])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: dict[str, list] = {f.name: [] for f in schema}
        held = 0

        def put(**values):
            for name, col in out.items():
                col.append(values.get(name))

        state = {"conv": None, "rows": [], "bytes": 0, "piece": 0, "first": True, "begun": False}

        def spill():
            nonlocal held
            for at, r in enumerate(state["rows"]):
                put(conv_id=state["conv"], part=part, piece=state["piece"], at=at, turn=r[0], role=r[1], text=r[2], alive=r[3])
            held += state["bytes"]
            state.update(rows=[], bytes=0, piece=state["piece"] + 1)

        def finish(last: bool):
            nonlocal held
            if state["first"] or last or state["piece"]:
                spill()
            else:
                seen, rows = set(), []
                for turn, role, text, alive, blank, cut in state["rows"]:
                    rows.append((turn, role, text, alive, blank, cut, alive and (role, text) in seen))
                    if alive:
                        seen.add((role, text))
                result, turns = _whole(Unit(rows))
                put(conv_id=state["conv"], **dict(zip([*NUMBERS, "audit", "repaired_sha256"], result)), turns=turns if with_turns else None)
                held += state["bytes"] if with_turns else 0
            state.update(rows=[], bytes=0, piece=0, first=False)

        for batch in stream:
            for conv, *row in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "alive", "blank", "cut")]):
                if not state["begun"] or conv != state["conv"]:
                    if state["begun"]:
                        finish(last=False)
                    state.update(conv=conv, begun=True)
                elif len(state["rows"]) >= piece_rows or state["bytes"] >= PIECE_BYTES:
                    spill()
                state["rows"].append(row)
                state["bytes"] += len(row[2])
                if len(out["conv_id"]) >= 4096 or held >= PIECE_BYTES:
                    yield _frame(out, schema)
                    out, held = {f.name: [] for f in schema}, 0
        if state["begun"]:
            finish(last=True)
        if out["conv_id"]:
            yield _frame(out, schema)

    return run


def _unit_of(group: pa.Table) -> Unit:
    cols = ("turn", "role", "text", "alive", "blank", "cut", "seen")
    return Unit(list(zip(*[group.sort_by("at").column(c).to_pylist() for c in cols])))


def _ends(q: int) -> dict[int, tuple[int, list[int]]]:
    return {q: (0, [])}


def _summary(group: pa.Table) -> pa.Table:
    """Costs of a piece from state to state (-1: no way), and the place of its letters among all 16."""
    unit = _unit_of(group)
    costs, letters = [], []
    for end in range(4):
        paths = Paths(unit.rows, _ends(end))
        costs += [-1 if w is None else w >> paths.bits for w in paths.best]
        letters += [None if w is None else w & paths.low for w in paths.best]
    order = {w: i for i, w in enumerate(sorted({w for w in letters if w is not None}))}
    return pa.table({
        "conv_id": group.column("conv_id").slice(0, 1), "part": group.column("part").slice(0, 1), "piece": group.column("piece").slice(0, 1),
        "costs": pa.array([costs], pa.list_(pa.int64())), "places": pa.array([[-1 if w is None else order[w] for w in letters]], pa.list_(pa.int32())),
    })


def _choose(group: pa.Table) -> pa.Table:
    """The states between the pieces of a conversation: by cost, then by the letters of a piece, then by what is behind it."""
    pieces = sorted(group.to_pylist(), key=lambda r: (r["part"], r["piece"]))
    behind = {q: (INSERT * n, n) for q, n in TAIL.items()}  # state: cost, place in ASCII order
    picks = []
    for piece in reversed(pieces):
        best = {}
        for q in range(4):
            ways = [
                (piece["costs"][4 * end + q] + behind[end][0], piece["places"][4 * end + q], behind[end][1], end)
                for end in range(4) if piece["costs"][4 * end + q] >= 0 and end in behind
            ]
            if ways:
                best[q] = min(ways)
        picks.append({q: w[3] for q, w in best.items()})
        order = {w: i for i, w in enumerate(sorted({w[1:3] for w in best.values()}))}
        behind = {q: (w[0], order[w[1:3]]) for q, w in best.items()}
    q, start, end = START, [], []
    for pick in reversed(picks):
        start.append(q)
        q = pick[q]
        end.append(q)
    return pa.table({
        "conv_id": pa.array([p["conv_id"] for p in pieces], group.schema.field("conv_id").type), "part": pa.array([p["part"] for p in pieces], pa.int32()),
        "piece": pa.array([p["piece"] for p in pieces], pa.int32()), "start": pa.array(start, pa.int32()), "end": pa.array(end, pa.int32()),
    })


PIECE = (
    "part int, piece int, turns array<struct<edit:string,role:string,text:string>>, n_faults array<long>, illegal long, cost long, "
    "audit string, initials string, n_turns long, low long, high long, end int"
)


def _repair_piece(group: pa.Table) -> pa.Table:
    unit = _unit_of(group)
    start, end = group.column("start")[0].as_py(), group.column("end")[0].as_py()
    paths = Paths(unit.rows, _ends(end))
    letters = paths.letters(start)
    turns = [dict(zip(("edit", "role", "text"), t)) for t in replay(letters, start, unit.roles, unit.texts)]
    ends = [unit.initials[0], unit.initials[-1]] if unit.rows else []
    one = lambda c: group.column(c).slice(0, 1)
    return pa.table({
        "conv_id": one("conv_id"), "part": one("part"), "piece": one("piece"),
        "turns": pa.array([turns], pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))),
        "n_faults": pa.array([unit.faults], pa.list_(pa.int64())), "illegal": pa.array([unit.illegal], pa.int64()), "cost": pa.array([paths.cost(start)], pa.int64()),
        "audit": pa.array(["".join(LETTERS[x] for x in letters)]), "initials": pa.array(["".join(e or " " for e in ends)], pa.string()),
        "n_turns": pa.array([unit.distinct_turns()], pa.int64()), "low": pa.array([min(unit.turns, default=None)], pa.int64()),
        "high": pa.array([max(unit.turns, default=None)], pa.int64()), "end": one("end"),
    })


def _join_pieces(id_type: pa.DataType):
    """One result per conversation from its pieces, which come one behind the other; only the audit and a digest are kept."""
    schema = pa.schema([("conv_id", id_type), *[(c, pa.int64()) for c in NUMBERS], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None

        def result() -> pa.RecordBatch:
            tail, q = [], now["end"]
            for _ in range(TAIL[q]):
                q = NEXT[q]
                tail.append({"role": ROLE_OF[q], "text": ""})
            digest(tail)
            gaps = now["high"] - now["low"] + 1 - now["n"] if now["n"] else 0
            row = [now["conv"], _long(gaps), *now["faults"], now["illegal"], now["cost"] + INSERT * len(tail), "".join(now["audit"]) + "I" * len(tail), now["sha"].hexdigest()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        def digest(turns: list[dict]) -> None:
            for t in turns:
                now["sha"].update(f"{now['mark']}{t['role']}:{t['text']}".encode())
                now["mark"] = "\n"

        for batch in stream:
            for at in range(batch.num_rows):
                p = batch.slice(at, 1).to_pylist()[0]
                if now is None or p["conv_id"] != now["conv"]:
                    if now is not None:
                        yield result()
                    now = {"conv": p["conv_id"], "sha": hashlib.sha256(), "mark": "", "faults": [0, 0, 0], "illegal": 0, "cost": 0}
                    now |= {"audit": [], "last": "", "n": 0, "low": None, "high": None}
                digest(p["turns"])
                now["faults"] = [a + b for a, b in zip(now["faults"], p["n_faults"])]
                now["illegal"] += p["illegal"]
                if p["initials"]:
                    now["illegal"] += bool(now["last"]) and now["last"] + p["initials"][0] not in LEGAL
                    now["last"] = p["initials"][1]
                now["cost"] += p["cost"]
                now["audit"].append(p["audit"])
                if p["n_turns"]:
                    now["n"] += p["n_turns"] - (now["n"] > 0 and now["high"] == p["low"])  # turns rise, so only the edge may be shared
                    now["low"] = p["low"] if now["low"] is None else now["low"]
                    now["high"] = p["high"]
                now["end"] = p["end"]
        if now is not None:
            yield result()

    return run


def _passes(rows: DataFrame, with_turns: bool, piece_rows: int) -> tuple[DataFrame, DataFrame]:
    """Written results of the first pass (whole conversations and loose rows), and the repaired pieces of loose rows."""
    spark = rows.sparkSession
    ready = rows.withColumns(_fault_columns())
    order = ["conv_id", "turn", "role", "hash", "alive"]
    ready = ready.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "alive", "blank", "cut")
    kind = rows.schema["conv_id"].dataType.simpleString()
    arrow = rows.limit(0).select("conv_id").toArrow().schema.field(0).type
    turns = "turns array<struct<edit:string,role:string,text:string>>"
    schema = f"conv_id {kind}, {RESULT}, {turns}, part int, piece int, at int, turn long, role string, text string, alive boolean"
    first = materialize(ready.mapInArrow(_first_pass(arrow, with_turns, piece_rows), schema))

    loose = first.filter("part is not null").select("conv_id", "part", "piece", "at", "turn", "role", "text", "alive").withColumns(_fault_columns())
    place = F.struct("part", "piece", "at")
    firsts = loose.filter("alive").groupBy("conv_id", "hash", "hash2").agg(F.min(place).alias("f"))
    firsts = firsts.select(F.col("conv_id").alias("c"), F.col("hash").alias("h"), F.col("hash2").alias("h2"), "f")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("hash") == F.col("h")) & (F.col("hash2") == F.col("h2"))
    loose = materialize(loose.join(firsts, same, "left").withColumn("seen", F.col("alive") & (place > F.col("f"))).drop("c", "h", "h2", "f", "hash", "hash2"))
    piece_key = ["conv_id", "part", "piece"]
    bare = loose.withColumns({"text": F.lit(""), "role": F.substring("role", 1, 1)})
    sums = bare.groupBy(*piece_key).applyInArrow(lambda g: _summary(g), f"conv_id {kind}, part int, piece int, costs array<long>, places array<int>")
    chosen = sums.groupBy("conv_id").applyInArrow(lambda g: _choose(g), f"conv_id {kind}, part int, piece int, start int, end int")
    chosen = chosen.withColumnsRenamed({"conv_id": "c", "part": "p", "piece": "i"})
    both = loose.join(chosen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("piece") == F.col("i"))).drop("c", "p", "i")
    return first, both.groupBy(*piece_key).applyInArrow(lambda g: _repair_piece(g), f"conv_id {kind}, {PIECE}")


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. `rows` as of `damage`."""
    first, pieces = _passes(rows, False, piece_rows)
    kind = rows.schema["conv_id"].dataType.simpleString()
    arrow = rows.limit(0).select("conv_id").toArrow().schema.field(0).type
    cols = ["conv_id", *NUMBERS, "audit", "repaired_sha256"]
    in_order = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    joined = in_order.mapInArrow(_join_pieces(arrow), f"conv_id {kind}, {RESULT}")
    return first.filter("part is null").select(*cols).unionByName(joined)


def repaired_turns(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The turns that are left and inserted: (conv_id, part, piece, number, edit, role, text); part and piece order the numbers of a large
    conversation. Turns inserted behind the last row of a conversation in pieces are told by `repair` alone (its audit ends with them)."""
    first, pieces = _passes(rows, True, piece_rows)
    whole = first.filter("part is null").select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("piece"), F.posexplode("turns").alias("number", "t"))
    rest = pieces.select("conv_id", "part", "piece", F.posexplode("turns").alias("number", "t"))
    return whole.unionByName(rest).select("conv_id", "part", "piece", "number", "t.*")
