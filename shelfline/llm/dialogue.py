"""Conversation structure repair by divide and conquer over four-state cost vectors.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Four states tell how far a prefix has come: nothing
yet, after the system turn, after a user turn, after an assistant turn. A row, or a run of rows, is a 4 x 4 table: the
least cost of the edits that lead from a state before it to a state behind it, and the order of the audits that do. As in Hirschberg's
method, costs are carried forward to the middle and backward to it; the crossing is the state of least total whose audit so far is least, and
both halves are solved in the same way, in space that grows with the rows alone. An edit's initial says what it does in a
given state, so an audit is one path, and no audit that reaches the middle is the beginning of another.

Rows of all conversations stand in one order and are cut into chunks of ``CHUNK``, one for each task at a time. A conversation that is cut has
a table for each of its portions; those are joined, ``FAN`` at a time, and split again by the same method.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from shelfline.llm.groups import starts, whole
from shelfline.plans.ordering import with_row_number
from shelfline.plans.staging import Stage, WrittenTables

CHUNK, FAN, SOME = 16_384, 1_024, 8
BLANKS = " \t\n\x0b\x0c\r"
FAR = 10 ** 15
STATES = range(4)
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: state after an inserted or rewritten turn, and its role
MADE = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
INSERT, REROLE, DELETE, CUT_SHORT = 2, 2, 3, 1

Table = tuple[tuple[tuple[int, int], ...], ...]  # [before][behind] -> (cost, order of the audit)


def _ranked(best: Sequence[tuple]) -> tuple[tuple[int, int], ...]:
    """(cost, key) of each state behind, the key as its place among the four."""
    order = sorted(STATES, key=lambda e: (best[e][0] >= FAR, best[e][1:]))
    return tuple((best[e][0], order.index(e)) if best[e][0] < FAR else (FAR, 4) for e in STATES)


@functools.cache
def scripts(code: str) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest (cost, audit) of one row for each pair of states; ``code`` is ``D`` for a row that must go, or else the role's
    initial, in upper case if its text is cut short. The empty code stands for the end of a conversation."""
    out: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(before: int, behind: int, cost: int, audit: str) -> None:
        out[before, behind] = min(out.get((before, behind), (FAR, "")), (cost, audit))

    for before in STATES:
        state = before
        for inserts in range(3):
            cost, audit = INSERT * inserts, "I" * inserts
            if not code:
                if state in (0, 3):
                    offer(before, 0, cost, audit)
            else:
                offer(before, state, cost + DELETE, audit + "D")
            if code not in ("", "D"):
                short = CUT_SHORT if code.isupper() else 0
                if (state, code.lower()) in KEEP:
                    offer(before, KEEP[state, code.lower()], cost + short, audit + "K")
                offer(before, MADE[state][0], cost + REROLE + short, audit + "R")
            state = MADE[state][0]
    return out


@functools.cache
def row_table(code: str) -> Table:
    found = scripts(code)
    return tuple(_ranked([found.get((s, e), (FAR, "")) for e in STATES]) for s in STATES)


def _start(state: int) -> tuple[tuple[int, int], ...]:
    return tuple((0, 0) if s == state else (FAR, 4) for s in STATES)


def advance(vector: Sequence[tuple[int, int]], table: Table) -> tuple[tuple[int, int], ...]:
    """Costs and audits' order one table further. Ties go to the audit that is less where it first differs."""
    return _ranked([min((vector[s][0] + table[s][e][0], vector[s][1], table[s][e][1]) for s in STATES) for e in STATES])


def retreat(table: Table, costs: Sequence[int]) -> list[int]:
    """Costs to the end from before the table."""
    return [min(table[s][e][0] + costs[e] for e in STATES) for s in STATES]


def joined(tables: Sequence[Table]) -> Table:
    return tuple(functools.reduce(advance, tables, _start(s)) for s in STATES)


def crossings(tables: Sequence[Table], before: int, behind: int) -> list[int]:
    """State behind each table on the cheapest way between two states, of the least audit."""
    if len(tables) == 1:
        return [behind]
    middle = len(tables) // 2
    ahead = functools.reduce(advance, tables[:middle], _start(before))
    back = functools.reduce(lambda costs, table: retreat(table, costs), reversed(tables[middle:]), [0 if s == behind else FAR for s in STATES])
    state = min(STATES, key=lambda s: (ahead[s][0] + back[s], ahead[s][1]))
    return crossings(tables[:middle], before, state) + crossings(tables[middle:], state, behind)


@functools.lru_cache(100_000)
def some_table(codes: tuple[str, ...]) -> Table:
    return joined([row_table(c) for c in codes])


@functools.lru_cache(100_000)
def _some_rows(codes: tuple[str, ...], before: int, behind: int) -> list[tuple[int, str]]:
    states = [before, *crossings([row_table(c) for c in codes], before, behind)]
    return [(a, scripts(c)[a, b][1]) for c, a, b in zip(codes, states[:-1], states[1:], strict=True)]


def solve(codes: Sequence[str], before: int, behind: int) -> list[tuple[int, str]]:
    """State before each row, and the initials of what is inserted there and of what becomes of the row."""
    few = [tuple(codes[k:k + SOME]) for k in range(0, len(codes), SOME)]
    states = [before, *crossings([some_table(c) for c in few], before, behind)]
    return [row for c, a, b in zip(few, states[:-1], states[1:], strict=True) for row in _some_rows(c, a, b)]


def _roles(state: int, audit: str) -> list[str]:
    """Roles that the inserted and rewritten turns of an audit get."""
    out = []
    for edit in audit:
        if edit in "IR":
            state, role = MADE[state]
            out.append(role)
    return out


FLAT = "costs array<long>, orders array<long>"


def _flat(table: Table) -> tuple[list[int], list[int]]:
    cells = list(itertools.chain.from_iterable(table))
    return [c for c, _ in cells], [r for _, r in cells]


def _square(costs: list[int], orders: list[int]) -> Table:
    cells = list(zip(costs, orders, strict=True))
    return tuple(tuple(cells[4 * s:4 * s + 4]) for s in STATES)


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tables of the first and the last conversation of each chunk; all others lie within it."""
    for rows, chunks in whole(batches, ["k"]):
        codes, at, flat = rows["code"].to_pylist(), [], []
        for first, past in itertools.pairwise(chunks):
            cuts = [first + k for k in starts(rows.slice(first, past - first), ["conv_id"])]
            for a in sorted({cuts[0], cuts[-1]}):
                b = past if a == cuts[-1] else cuts[1]
                at.append(a)
                flat.append(_flat(joined([some_table(tuple(codes[k:min(k + SOME, b)])) for k in range(a, b, SOME)])))
        yield _named(rows, at, "k", flat)


def _named(rows: pa.Table, at: list[int], place: str, flat: list[tuple[list[int], list[int]]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        rows["conv_id"].take(at).combine_chunks(), rows[place].take(at).combine_chunks(),
        pa.array([c for c, _ in flat], pa.list_(pa.int64())), pa.array([o for _, o in flat], pa.list_(pa.int64()))], ["conv_id", "k", "costs", "orders"])


def _join_some(batches):
    for rows, cuts in whole(batches, ["conv_id", "group"]):
        costs, orders = rows["costs"].to_pylist(), rows["orders"].to_pylist()
        flat = [_flat(joined([_square(costs[k], orders[k]) for k in range(a, b)])) for a, b in itertools.pairwise(cuts)]
        yield _named(rows, cuts[:-1], "group", flat)


def _split_some(batches):
    """States of the portions of each group, from those of the group, which stand in its first row (``k`` -1)."""
    for rows, cuts in whole(batches, ["conv_id", "group"]):
        costs, orders, before, behind = (rows[c].to_pylist() for c in ("costs", "orders", "before", "behind"))
        at, first, last = [], [], []
        for a, b in itertools.pairwise(cuts):
            tables = [_square(costs[k], orders[k]) for k in range(a + 1, b)]
            ending = behind[a] < 0
            states = [before[a], *crossings([*tables, row_table("")] if ending else tables, before[a], 0 if ending else behind[a])]
            at.extend(range(a + 1, b))
            first.extend(states[:len(tables)])
            last.extend([*states[1:len(tables)], behind[a]])
        yield pa.RecordBatch.from_arrays([rows["conv_id"].take(at).combine_chunks(), rows["k"].take(at).combine_chunks(),
                                          pa.array(first, pa.int32()), pa.array(last, pa.int32())], ["conv_id", "k", "before", "behind"])


EDITS = "at long, script string, inserted array<string>, role_now string, appended array<string>"


def _edits(batches):
    """Edits of each row; a conversation's first row in a chunk may be a message (``at`` -1) with its states."""
    for rows, cuts in whole(batches, ["k", "conv_id"]):
        at, codes, before, behind = (rows[c].to_pylist() for c in ("at", "code", "before", "behind"))
        out: list[tuple] = []
        for a, b in itertools.pairwise(cuts):
            first, last = (before[a], behind[a]) if at[a] < 0 else (0, -1)
            a += at[a] < 0
            own = codes[a:b] if last >= 0 else [*codes[a:b], ""]
            found = solve(own, first, max(last, 0))
            tail = _roles(*found[-1]) if last < 0 else []
            for k, (state, audit) in enumerate(found[:b - a]):
                roles = _roles(state, audit)
                end = tail if k == b - a - 1 else []
                out.append((at[a + k], audit + "I" * len(end), roles[:len(audit) - 1], roles[-1] if audit[-1] == "R" else None, end))
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        text = pa.list_(pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), text, pa.string(), text), strict=True)],
                                         ["at", "script", "inserted", "role_now", "appended"])


def faulty(turns: DataFrame, stage: Stage) -> DataFrame:
    """Turns in their place ``at`` among all rows, in order of conversation, turn (nulls first), role and text, with each
    row's first ``fault``: blank, duplicate, truncated, or an empty string."""
    texts = turns.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    placed = with_row_number(texts, ["conv_id", "turn", "role", "text"], "at", stage=stage)
    first = placed.groupBy("conv_id", "role", F.sha2("text", 256).alias("digest")).agg(F.min("at").alias("_at")).select("_at")
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    return stage(placed.join(first, F.col("at") == F.col("_at"), "left").withColumn(
        "fault", F.when(last == "", "blank").when(F.col("_at").isNull(), "duplicate").when(~last.isin(".", "!", "?"), "truncated").otherwise("")).drop("_at"), "turns")


def _states(codes: DataFrame, kind: str, stage: Stage) -> DataFrame:
    """conv_id, chunk and the states before and behind it (-1: to the end) of each conversation at the edge of a chunk."""
    tables = [stage(codes.repartition("k").sortWithinPartitions("k", "at").mapInArrow(_portions, f"conv_id {kind}, k long, {FLAT}"), "portions_0")]
    group = F.floor(F.col("k") / FAN).cast("long").alias("group")

    def grouped(rows: DataFrame) -> DataFrame:
        return rows.repartition("conv_id", "group").sortWithinPartitions("conv_id", "group", "k")

    while (tables[-1].groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0) > 1:
        tables.append(stage(grouped(tables[-1].withColumn("group", group)).mapInArrow(_join_some, f"conv_id {kind}, k long, {FLAT}"), f"portions_{len(tables)}"))
    states = tables[-1].select("conv_id", "k", F.lit(0).alias("before"), F.lit(-1).alias("behind"))
    for turn, table in enumerate(reversed(tables[:-1])):
        told = states.select("conv_id", F.col("k").alias("group"), F.lit(-1).cast("long").alias("k"), "before", "behind")
        rows = grouped(table.withColumn("group", group).unionByName(told, allowMissingColumns=True))
        states = stage(rows.mapInArrow(_split_some, f"conv_id {kind}, k long, before int, behind int"), f"states_{turn}")
    return states


def repair(turns: DataFrame, stage: Stage | None = None) -> DataFrame:
    """One row per row of ``turns`` (conv_id, turn, role, text): those columns (null role or text: a space), at, fault, script, inserted,
    role_now and appended.

    The edits of a conversation are the cheapest that make it well formed: keep a row (0), insert an empty user or assistant turn (2),
    give a row such a role (2), delete it (3; a must for blank rows and duplicates); a truncated row that stays adds 1. Of equal costs the
    audit that is least in ASCII is taken. ``inserted`` holds the roles of the turns put before the row, ``appended`` those behind a
    conversation's last one, ``role_now`` the new role of a rewritten row, ``script`` the initials of all these edits. Rows of a null
    conv_id are one conversation; roles with other initials than s, u and a, empty ones included, can't be kept as they are; an empty
    table has no rows. Equal rows of a turn stand side by side, so all but the first are duplicates. Extra columns are left out.
    """
    stage = stage or WrittenTables(turns.sparkSession)
    kind = dict(turns.dtypes)["conv_id"]
    placed = faulty(turns, stage)
    initial = F.substring("role", 1, 1)
    code = (F.when(F.col("fault").isin("blank", "duplicate"), "D").when(~initial.isin("s", "u", "a"), F.lit("x")).otherwise(initial))
    code = F.when((F.col("fault") == "truncated"), F.upper(code)).otherwise(code)
    codes = placed.select("at", "conv_id", F.floor((F.col("at") - 1) / CHUNK).cast("long").alias("k"), code.alias("code"))
    told = _states(codes, kind, stage).withColumn("at", F.lit(-1).cast("long"))
    rows = codes.unionByName(told, allowMissingColumns=True).repartition("k").sortWithinPartitions("k", "conv_id", "at")
    return placed.join(stage(rows.mapInArrow(_edits, EDITS), "edits"), "at")


def lines(rows: DataFrame) -> Column:
    """What stands in place of a row: ``role:text`` lines of the inserted turns, of the row and of the appended ones; null for none."""
    def empty(roles: str) -> Column:
        return F.transform(roles, lambda role: F.concat(role, F.lit(":")))

    stays = F.regexp_replace("script", "I", "").isin("K", "R")
    own = F.when(stays, F.array(F.concat(F.coalesce("role_now", "role"), F.lit(":"), F.col("text")))).otherwise(F.array().cast("array<string>"))
    every = F.concat(empty("inserted"), own, empty("appended"))
    return F.when(F.size(every) > 0, F.array_join(every, "\n"))


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Running:
    """Figures of one conversation, row by row."""

    def __init__(self):
        self.digest, self.empty, self.audit = sha256(), True, []
        self.least = self.turn = self.initial = None
        self.turns = self.illegal = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        self.cost = 0

    def take(self, turn, initial, fault, script, text):
        if turn is not None and (self.turn is None or turn != self.turn):
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.turn = turn
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self.faults[fault] += 1
        self.audit.append(script)
        self.cost += INSERT * script.count("I") + REROLE * script.count("R") + DELETE * script.count("D")
        self.cost += CUT_SHORT * (fault == "truncated" and "D" not in script)
        if text is not None:
            self.digest.update((text if self.empty else "\n" + text).encode())
            self.empty = False

    def told(self):
        gaps = 0 if self.turn is None else self.turn - self.least + 1 - self.turns
        return (gaps, self.faults["blank"], self.faults["duplicate"], self.faults["truncated"], self.illegal, self.cost,
                "".join(self.audit), self.digest.hexdigest())


def _reports(names: list[str]):
    def run(batches):
        now = key = held = None
        kinds = [pa.int64()] * 6 + [pa.string()] * 2

        def close(done):
            columns = list(zip(*[r.told() for _, r in done], strict=True))
            ids = pa.concat_arrays([k for k, _ in done])
            return pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]], names)

        for batch in batches:
            done = []
            ids = batch.column("conv_id")
            columns = zip(ids.to_pylist(), *[batch.column(c).to_pylist() for c in ("at", "turn", "initial", "fault", "script", "lines")], strict=True)
            for k, (conv, at, *rest) in enumerate(columns):
                if now is None or conv != key:
                    if now is not None:
                        done.append((held, now))
                    now, key, held = _Running(), conv, ids.slice(k, 1)
                if at >= 0:
                    now.take(*rest)
            if done:
                yield close(done)
        if now is not None:
            yield close([(held, now)])
    return run


def report(repaired: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations``: gaps in the turns, rows by first fault, illegal neighbours, cost, audit and the SHA-256
    of the repaired ``role:text`` lines.

    The rows of a conversation go through one task in their order, as their digest must be taken in it; nothing but the
    audit is kept of them.
    """
    kind = dict(conversations.dtypes)["conv_id"]
    every = conversations.select("conv_id").distinct().withColumn("at", F.lit(-1).cast("long"))
    rows = repaired.select("conv_id", "at", F.col("turn").cast("long").alias("turn"), F.substring("role", 1, 1).alias("initial"), "fault", "script", lines(repaired).alias("lines"))
    rows = rows.unionByName(every, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "at")
    names = ["conv_id", *(x.split()[0] for x in REPORT.split(", "))]
    return rows.mapInArrow(_reports(names), f"conv_id {kind}, {REPORT}")
