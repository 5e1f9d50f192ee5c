"""Conversation repair against all edits of small conversations, and over chunks and portions of a few rows."""

import hashlib
import itertools
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfline.llm import dialogue
from shelfline.llm.queries import damaged

CODES = ["s", "u", "a", "x", "S", "U", "A", "X", "D"]
GOOD = re.compile("(s?(ua)+)?")


def cheapest(codes):
    """Least (cost, audit) by trying every edit of every row and every place of an insert."""
    best = None
    for edits in itertools.product("KRD", repeat=len(codes)):
        if any(c == "D" and e != "D" for c, e in zip(codes, edits, strict=True)):
            continue
        for inserts in itertools.product(range(3), repeat=len(codes) + 1):
            cost = 2 * sum(inserts) + sum({"K": 0, "R": 2, "D": 3}[e] + (e != "D" and c.isupper()) for c, e in zip(codes, edits, strict=True))
            if best and cost > best[0]:
                continue
            audit = "".join("I" * n + e for n, e in zip(inserts, [*edits, ""], strict=True))
            slots = [x for n, c, e in zip(inserts, [*codes, ""], [*edits, "D"], strict=True) for x in ["ua"] * n + ([c.lower()] if e == "K" else ["ua"] if e == "R" else [])]
            if any(GOOD.fullmatch("".join(roles)) for roles in itertools.product(*slots)) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


@given(st.lists(st.sampled_from(CODES), max_size=4))
@settings(max_examples=40, deadline=None)
def test_least_audit_of_the_cheapest_edits(codes):
    audit = "".join(part for _, part in dialogue.solve([*codes, ""], 0, 0))
    cost = sum({"K": 0, "R": 2, "D": 3, "I": 2}[e] for e in audit)
    cost += sum(c.isupper() and c != "D" and e != "D" for c, e in zip(codes, audit.replace("I", ""), strict=True))
    assert (cost, audit) == cheapest(codes)


@given(st.lists(st.sampled_from(CODES), min_size=1, max_size=40), st.data())
@settings(max_examples=60, deadline=None)
def test_portions_give_what_the_whole_gives(codes, data):
    whole = "".join(part for _, part in dialogue.solve([*codes, ""], 0, 0))
    cuts = sorted(data.draw(st.sets(st.integers(1, max(1, len(codes) - 1)), max_size=4)) - {len(codes)})
    parts = [codes[a:b] for a, b in itertools.pairwise([0, *cuts, len(codes)])]
    tables = [dialogue.joined([dialogue.row_table(c) for c in part]) for part in parts]
    states = [0, *dialogue.crossings([*tables, dialogue.row_table("")], 0, 0)]
    made = "".join(part for k, own in enumerate(parts) for _, part in dialogue.solve(own, states[k], states[k + 1]))
    assert made + dialogue.scripts("")[states[-2], 0][1] == whole


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        last = text.rstrip(dialogue.BLANKS)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_report(rows):
    """Figures of one conversation's rows (turn, role, text), nulls filled."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    found = faults(rows)
    codes = ["D" if f in ("blank", "duplicate") else (r[1][:1] if r[1][:1] in ("s", "u", "a") else "x") for f, r in zip(found, rows, strict=True)]
    codes = [c.upper() if f == "truncated" else c for c, f in zip(codes, found, strict=True)]
    solved = dialogue.solve([*codes, ""], 0, 0)
    lines, cost = [], 0
    for k, (state, part) in enumerate(solved):
        for edit in part:
            cost += {"K": 0, "R": 2, "D": 3, "I": 2}[edit] + (edit in "KR" and found[k] == "truncated")
            if edit in "IR":
                state, role = dialogue.MADE[state]
                lines.append(f"{role}:{rows[k][2] if edit == 'R' else ''}")
            elif edit == "K":
                lines.append(f"{rows[k][1]}:{rows[k][2]}")
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, found.count("blank"), found.count("duplicate"), found.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, "".join(part for _, part in solved),
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.mark.parametrize("chunk,fan", [(16_384, 1_024), (7, 2)])
def test_messy_conversations(spark, monkeypatch, chunk, fan):
    monkeypatch.setattr(dialogue, "CHUNK", chunk)
    monkeypatch.setattr(dialogue, "FAN", fan)
    roles = ["user", "assistant", "system", None, "", "tool", "user"]
    texts = ["One.", "Two!", " \n", None, "cut", "", "Ünï  \x85end?", "x" * 50_000 + ".", "One."]
    rows = [(1, k, roles[k * 5 % 7], texts[k * 4 % 9], "z") for k in range(90)]  # longer than several chunks
    rows += [(2, 0, "user", "Hi.", "z"), (2, 1, "assistant", "Yes.", "z"), (None, 3, "user", "no id.", "z"), (None, None, "user", "no turn.", "z"),
             (3, None, "assistant", "a", "z"), (3, None, "assistant", "a", "z"), (4, 9, None, None, "z"), (5, 5, "system", "Only.", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, script string").withColumn("k", F.lit(0)).repartition(4)
    repaired = dialogue.repair(turns)
    assert repaired.count() == len(rows)
    got = {r[0]: tuple(r)[1:] for r in dialogue.report(repaired, turns).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        want[conv] = plain_report([(t, " " if r is None else r, " " if x is None else x) for c, t, r, x, _ in rows if c == conv])
    assert got == want


def test_empty_table_and_conversations_without_rows(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert dialogue.report(dialogue.repair(turns), turns).collect() == []
    every = spark.createDataFrame([(7,), (None,)], "conv_id long")
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, dialogue.report(dialogue.repair(turns), every).collect()), key=str) == [(7, 0, 0, 0, 0, 0, 0, "", empty), (None, 0, 0, 0, 0, 0, 0, "", empty)]


def test_damage_follows_the_digest(spark):
    import zlib
    rows = [(c, t, "assistant", "So. it! goes?") for c in range(20) for t in range(5)] + [(None, 1, None, None)]
    got = sorted(map(tuple, damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=str)
    want = []
    for conv, turn, role, text in rows:
        role, text = role or " ", text or " "
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        want += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    assert got == sorted(want, key=str)
