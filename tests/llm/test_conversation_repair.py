"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pyarrow.parquet as pq
import pytest
from conftest import DATA

from namewright.llm import conversation_repair as repair
from namewright.llm import queries

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(BLANKS)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults, visit_once=True):
    """Uniform-cost search over (cost, audit); states are the rows used up and the roles kept so far."""
    fits = re.compile(r"(s?(ua)+)?").fullmatch
    begins = lambda roles: fits(roles) or fits(roles + "a") or fits(roles + "ua")
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, roles, lines = heapq.heappop(queue)
        state = (at, roles[-1:])
        if visit_once and state in done:
            continue
        done.add(state)
        if at == len(rows) and fits(roles):
            return cost, audit, lines
        steps = [(3, "I", 0, r[0], ((r, ""),)) for r in ("user", "assistant")]
        if at < len(rows):
            (role, text), fault = rows[at], faults[at]
            extra = 3 if fault == "truncated" else 0
            steps.append((4, "D", 1, "", ()))
            if fault not in ("blank", "duplicate"):
                steps.append((extra, "K", 1, role[:1] or "?", ((role, text),)))
                steps += [(3 + extra, "R", 1, r[0], ((r, text),)) for r in ("user", "assistant")]
        for more, letter, rows_used, initial, added in steps:
            if not initial or begins(roles + initial):
                heapq.heappush(queue, (cost + more, audit + letter, at + rows_used, roles + initial, lines + added))


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def brute(rows, damage=True):
    conversations = {row[0]: [] for row in rows}
    for conv, turn, role, text in damaged(rows) if damage else rows:
        conversations[conv].append((turn is not None, turn or 0, role, text))
    want = {}
    for conv, group in conversations.items():
        group.sort()
        turns = [turn for known, turn, _, _ in group if known]
        rows = [(role, text) for _, _, role, text in group]
        faults = faults_of(rows)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, lines = cheapest(rows, faults)
        digest = sha("\n".join(f"{role}:{text}" for role, text in lines))
        want[conv] = (gaps, *[faults.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)
    return want


def test_query_against_search(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{DATA}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    got = queries.op13_conversation_repair(spark, DATA).collect()
    want = brute(rows)
    assert len(got) == len(want) and {r.conv_id: tuple(r)[1:] for r in got} == want
    assert any(cost for *_, cost, _, _ in want.values())


def odd_rows():
    """Missing values, ties, repeats, other roles, conversations that the damage empties, long ones."""
    draw = random.Random(8)
    rows = [(None, None, None, None), (None, 3, "user", "x."), (None, 3, "assistant", "y")]
    for conv in range(150):
        for turn in range(draw.randrange(1, 14)):
            place = draw.choice([turn, turn, turn, None, turn - 1, turn * 3])
            role = draw.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            rows.append((conv, place, role, draw.choice(["Yes.", "No!", "cut off", "", " \t", None, "Why? ", "é…", f"{turn}."])))
    rows += [(1000 + i, 0, "user", "alone.") for i in range(60)]
    return rows + rows[:20]


def test_damage_and_repair(spark):
    rows = odd_rows()
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rank", "'x' as conv", "2 as fault").repartition(5)
    got = repair.damage_and_repair(table).collect()
    want = brute(rows)
    assert len(got) == len(want) and {r.conv_id: tuple(r)[1:] for r in got} == want
    assert any(not audit for *_, audit, _ in want.values())
    assert repair.damage_and_repair(table.limit(0)).collect() == []


def test_long_conversation_is_merged_from_segments(spark, monkeypatch):
    """One conversation fills most of the table; three rows a segment and two segments a merge take many rounds."""
    monkeypatch.setattr(repair, "SEGMENT", 3)
    monkeypatch.setattr(repair, "FAN", 2)
    draw = random.Random(2)
    texts = ["a.", "b", "", "c!"] + [f"{i}?" for i in range(300)]
    rows = [(7, t, draw.choice(["system", "user", "assistant"]), draw.choice(texts)) for t in range(400)]
    rows += [(c, t, "user", f"{t}.") for c in (8, 9) for t in range(5)]
    report, repaired = repair.repair_conversations(spark.createDataFrame(rows, SCHEMA).repartition(4))
    digests = {r.conv: r.repaired_sha256 for r in repair.conversation_digests(repaired).collect()}
    got = {r.conv: (*tuple(r)[1:], digests[r.conv]) for r in report.collect()}
    assert got == brute(rows, damage=False)


def test_every_small_conversation():
    """All rows of up to four, searched without any shortcut, whole and from segments."""
    kinds = [(role, text) for role in ("system", "user", "assistant", "tool") for text in ("ok.", "cut", "")]
    initials = {"s": repair.SYSTEM, "u": repair.USER, "a": repair.ASSISTANT}
    draw = random.Random(6)
    cases = [c for n in (1, 2) for c in itertools.product(kinds, repeat=n)]
    cases += [tuple(draw.choice(kinds) for _ in range(draw.choice((3, 4)))) for _ in range(250)]
    for case in cases:
        rows = [(role, f"{text and i}{text}") for i, (role, text) in enumerate(case)]
        faults = faults_of(rows)
        codes = [initials.get(role[0], 0) + 4 * ("", "blank", "duplicate", "truncated").index(f) for (role, _), f in zip(rows, faults)]
        cost, audit, lines = cheapest(rows, faults, visit_once=len(rows) > 3)
        for cut in range(len(codes)):
            parts = [repair.summarised(part) for part in (codes[:cut], codes[cut:]) if part]
            assert repair.finished(repair.merged(parts)) == (cost, audit), (rows, cut)
        spread = [(role if edit == "R" else rows[place][0]) if edit in ("K", "R") else None for place, edit, role, _ in repair.edited_rows(audit)]
        assert [r for r in spread if r] == [r for r, t in lines if t]


@pytest.mark.parametrize("role, audit", [("system", "KII"), ("user", "KI"), ("assistant", "IK"), ("tool", "D")])
def test_one_row(role, audit):
    code = {"system": 1, "user": 2, "assistant": 3, "tool": 0}[role]
    cost, edits = repair.finished(repair.summarised([code]))
    assert (cost, edits) == min((cost, edits), (4, "D")) and edits in (audit, "D")
