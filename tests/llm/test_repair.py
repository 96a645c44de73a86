"""Conversation repair against a search over edits, on whole charts and on cut conversations."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cestero.llm import repair

SPOKEN = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}


def cheapest(rows):
    """Least (cost, audit) and the repaired lines of (symbol, role, text), by Dijkstra's search."""
    queue, seen = [(0, "", 0, 0, ())], set()
    while queue:
        cost, audit, at, state, lines = heapq.heappop(queue)
        if (at, state) in seen:
            continue
        if at == len(rows) and state in (0, 3):
            return cost, audit, list(lines)
        seen.add((at, state))
        for name, initial in (("user", "u"), ("assistant", "a")):
            if state in SPOKEN[initial]:
                heapq.heappush(queue, (cost + 2, audit + "I", at, SPOKEN[initial][state], (*lines, (name, ""))))
        if at == len(rows):
            continue
        symbol, role, text = rows[at]
        heapq.heappush(queue, (cost + 3, audit + "D", at + 1, state, lines))
        if symbol == "-":
            continue
        more = symbol.isupper()
        if state in SPOKEN.get(symbol.lower(), {}):
            heapq.heappush(
                queue, (cost + more, audit + "K", at + 1, SPOKEN[symbol.lower()][state], (*lines, (role, text)))
            )
        for name, initial in (("user", "u"), ("assistant", "a")):
            if state in SPOKEN[initial]:
                step = cost + 2 + more, audit + "R", at + 1, SPOKEN[initial][state], (*lines, (name, text))
                heapq.heappush(queue, step)


def every_span(symbols):
    """The chart over all spans and all places to split them at."""
    n = len(symbols)
    cells = {(i, i + 1): repair.LEAVES[s] for i, s in enumerate(symbols)}
    for width in range(2, n + 1):
        for i in range(n - width + 1):
            splits = [repair.joined(cells[i, m], cells[m, i + width]) for m in range(i + 1, i + width)]
            options = [(p, q, v) for cell in splits for p, row in cell.items() for q, v in row.items()]
            cells[i, i + width] = repair._least(options)
    return cells.get((0, n), repair.EMPTY)


@settings(max_examples=300, deadline=None)
@given(st.text("suaxSUAX-", max_size=9))
def test_one_split_a_span_gives_the_cells_of_all_splits(symbols):
    cell = repair.chart(symbols)
    assert cell == every_span(symbols) == repair.chart(symbols, repair.Memo())
    cost, audit, _ = cheapest([(s, "", "") for s in symbols])
    assert min(cell[0][q] for q in (0, 3) if q in cell[0]) == (cost, audit)


def expected(rows):
    """Of one conversation's damaged rows: (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    turns = [t for t, _, _ in rows if t is not None]
    counts, seen, symbols = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
    for _, role, text in rows:
        initial = role[:1] if role[:1] in "sua" and role else "x"
        if not re.search(r"[^\x20\x09-\x0D]", text):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1] not in ".!?":
            fault = "truncated"
        else:
            fault = ""
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        symbol = "-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
        symbols.append((symbol, role, text))
    pairs = zip(rows, rows[1:])
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs)
    cost, audit, lines = cheapest(symbols)
    joined = "\n".join(f"{role}:{text}" for role, text in lines)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256(joined.encode()).hexdigest()
    return (gaps, *counts.values(), illegal, cost, audit, digest), lines


def hurt(rows):
    """The damage of the contract."""
    found = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        found += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return found


COLUMNS = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def compare(rows, damaged, got, lines):
    own = {conv: [] for conv, *_ in rows}
    for conv, *row in damaged:
        own[conv].append(row)
    want = {conv: expected(part) for conv, part in own.items()}
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got.collect()} == {c: w for c, (w, _) in want.items()}
    assert got.count() == len(want)
    turns = {conv: [] for conv in want}
    for r in sorted(lines.collect(), key=lambda r: r.position):
        turns[r.conv_id].append((r.role, r.text))
    assert turns == {c: own_lines for c, (_, own_lines) in want.items()}


@pytest.fixture(scope="module")
def odd_rows():
    rnd = random.Random(8)
    roles = ["system", "user", "assistant", "tool", "", None, "user", "assistant"]
    texts = ["Hello.", "What?", "cut off", "", " \t ", None, "Fine!\n", "é. ", " ", "ok ", "a.b"]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rnd.randint(1, 9)):
            turn = rnd.choice([turn, turn, turn + 3, None])
            rows.append((conv, turn, rnd.choice(roles), rnd.choice(texts)))
            if rnd.random() < 0.1:
                rows.append(rows[-1])
    rows += [(99, t, "user" if t % 3 else "assistant", f"{t % 40}.") for t in range(300)]
    rows += [(98, 5, "user", "Same.")] * 50 + [(97, 1, "tool", None)]
    return rows


@pytest.fixture(scope="module")
def conversations(spark, odd_rows):
    schema = "conv_id long, turn long, role string, text string, n string, first string, task string, lines string"
    return spark.createDataFrame([(*row, "own", "own", "own", "own") for row in odd_rows], schema).repartition(3)


def test_damaged_conversations_against_a_search(conversations, odd_rows):
    rows = repair.damaged(conversations)
    compare(odd_rows, hurt(odd_rows), repair.repair(rows), repair.repaired_turns(rows))


def test_conversations_as_they_are_in_small_blocks(conversations, odd_rows, monkeypatch):
    """Blocks of few rows, so that conversations are cut within and between tasks."""
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in odd_rows]
    rows = repair.turns(conversations)
    for size in (1, 3):
        monkeypatch.setattr(repair, "BLOCK", size)
        compare(odd_rows, plain, repair.repair(rows), repair.repaired_turns(rows))


def test_a_long_conversation_keeps_little_open():
    rnd = random.Random(2)
    reading, rows = repair.Reading(), []
    for k in range(400):
        block = repair.Block()
        for _ in range(8):
            role = rnd.choice(["user", "assistant"])
            text = f"{len(rows)}" + rnd.choice([".", ""])
            rows.append((role[0] if text.endswith(".") else role[0].upper(), role, text))
            block.add(len(rows), role, text, "whole" if text.endswith(".") else "truncated", 1, True)
        reading.add(block)
        assert all(len(audit) < 200 for _, audit, _ in reading.states.values())
    assert reading.end()[:2] == cheapest(rows)[:2]


def test_nothing(conversations):
    rows = repair.damaged(conversations.limit(0))
    assert repair.repair(rows).count() == 0 and repair.repaired_turns(rows).count() == 0
