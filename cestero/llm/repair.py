"""Conversations brought into turn order by weighted interval parsing (CYK).

A sound conversation's role initials are ``(s?(ua)+)?``. That language has four
states: nothing said, system heard, user heard, assistant heard. The repair
grammar is in Chomsky normal form: a nonterminal ``(p, q)`` derives the spans of
rows that lead from state p to state q, by ``(p, q) -> (p, r) (r, q)`` and, for
a single row, by its edits: keep it (free), rerole it to user or assistant (2),
delete it (3), with 1 more for a truncated row that stays. Turns inserted at 2
each around a row are closed in at the spans of one row, which is enough, as
closing in twice changes nothing.

A span's cell holds for each nonterminal the least (cost, audit), where the audit
is the initials of the edits in order. Cells are made bottom-up by span length:
rows, pairs, spans of four and so on. As a nonterminal names both states, every
place to split a span at gives the same cell, so that one is enough; audits of
equal cost never begin with one another (each reads the same rows, and a further
insertion costs more), so that the least of two parts makes the least whole.

1. Rows alike are counted, and of rows of equal role and text in a conversation
   the first is found, both by grouping, which combines before it shuffles.
2. Rows are dealt out by ranges of conversation, turn, role and text digest, so
   that a conversation of any length is spread over tasks. A task parses
   conversations that end within it, and cuts others into blocks of at most
   ``BLOCK`` rows or ``TEXT`` characters.
3. The blocks of a conversation are joined from left to right. What all states
   still possible agree on is final and let go, so that a task holds a few
   blocks, and the audit, which is one value of the result.

In roles and texts a null is one space. Rows without a conversation id are one
conversation. Null turns come first; rows of one turn are ordered by role and the
text's MD5. A blank or repeated row has to be deleted, whatever its role; an empty
role, like any other initial, is not sound. A conversation without rows is sound
and empty. Other columns are not read, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cestero.llm.text import Memo, staged

# Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows and characters of text in a block, at most (a single text may be longer).
BLOCK, TEXT = 1024, 1 << 20
#: What a text may end with, and white space.
ENDS, SPACE = ".!?", " \t\n\x0b\x0c\r"

_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
#: Where an initial leads to from each state.
_NEXT = {
    "s": {_NOTHING: _SYSTEM},
    "u": {_NOTHING: _USER, _SYSTEM: _USER, _ASSISTANT: _USER},
    "a": {_USER: _ASSISTANT},
}
_SOUND = (_NOTHING, _ASSISTANT)

#: Least cost and audit by state before and state after.
Cell = dict[int, dict[int, tuple[int, str]]]


def _least(options: Iterable[tuple[int, int, tuple[int, str]]]) -> Cell:
    cell: Cell = {}
    for p, q, value in options:
        row = cell.setdefault(p, {})
        if q not in row or value < row[q]:
            row[q] = value
    return cell


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans as one: ``(p, q) -> (p, r) (r, q)``."""
    return _least(
        (p, q, (cost + more, audit + rest))
        for p, row in left.items()
        for r, (cost, audit) in row.items()
        for q, (more, rest) in right.get(r, {}).items()
    )


def _closure() -> Cell:
    """Insertions alone, as many as it takes."""
    cell = _least((p, p, (0, "")) for p in range(4))
    step = _least((p, q, (INSERT, "I")) for n in "ua" for p, q in _NEXT[n].items())
    for p in range(4):
        step.setdefault(p, {})[p] = (0, "")
    for _ in range(4):
        cell = joined(cell, step)
    return cell


EMPTY = _closure()


def _leaf(symbol: str) -> Cell:
    """The cell of one row: an initial, in upper case if truncated, or ``-`` if it has to go."""
    options = [(p, p, (DELETE, "D")) for p in range(4)]
    if symbol != "-":
        more = TRUNCATED if symbol.isupper() else 0
        kept = _NEXT.get(symbol.lower(), {})
        options += [(p, q, (more, "K")) for p, q in kept.items()]
        options += [(p, q, (REROLE + more, "R")) for n in "ua" for p, q in _NEXT[n].items()]
    return joined(joined(EMPTY, _least(options)), EMPTY)


LEAVES = {symbol: _leaf(symbol) for symbol in "suaxSUAX-"}


def chart(symbols: str, memo: Memo | None = None) -> Cell:
    """The cell of all rows, from cells of spans of 1, 2, 4, ... rows."""
    cells, width = [LEAVES[s] for s in symbols], 1
    while len(cells) > 1:
        whole = []
        for k in range(0, len(cells) - 1, 2):
            if memo is not None and width <= 4:
                span = symbols[k * width : (k + 2) * width]
                cell = memo.recall(span)
                if cell is None:
                    cell = joined(cells[k], cells[k + 1])
                    memo.keep(span, cell)
            else:
                cell = joined(cells[k], cells[k + 1])
            whole.append(cell)
        cells, width = whole + cells[len(whole) * 2 :], 2 * width
    return cells[0] if cells else EMPTY


@dataclass
class Block:
    """Consecutive rows of a conversation, and what they have in faults and turns."""

    symbols: list[str] = field(default_factory=list)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    initials: str = ""  # of the first and of the last row
    turns: int = 0  # different ones
    first_turn: int | None = None
    last_turn: int | None = None
    size: int = 0

    def add(self, turn: int | None, role: str, text: str, kind: str, n: int, first: bool) -> None:
        """``n`` rows alike; ``first`` if no earlier row has their role and text."""
        initial = role[:1] if role[:1] in _NEXT else "x"
        if self.initials:
            self.illegal += self.initials[1] + initial not in ("su", "ua", "au")
        self.illegal += n - 1
        self.initials = (self.initials[:1] or initial) + initial
        if turn is not None:
            if turn != self.last_turn:
                self.turns += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        gone = n
        if kind == "blank":
            self.blank += n
        else:
            gone -= first
            self.duplicate += gone
            if first:
                self.truncated += kind == "truncated"
                self.symbols.append(initial.upper() if kind == "truncated" else initial)
                self.roles.append(role)
                self.texts.append(text)
                self.size += len(text)
        self.symbols.append("-" * gone)

    def lines(self, state: int, audit: str) -> list[tuple[str, str, str]]:
        """Edit, role and text of what stays or comes in, from a state and the edits."""
        symbols, at, row, found = "".join(self.symbols), 0, 0, []
        for edit in audit:
            symbol = "-" if edit == "I" else symbols[at]
            at += edit != "I"
            if edit in "RI":
                initial = "a" if state == _USER else "u"
                role = "assistant" if state == _USER else "user"
            else:
                initial, role = symbol.lower(), self.roles[row] if symbol != "-" else ""
            if edit != "D":
                found.append((edit, role, "" if edit == "I" else self.texts[row]))
                state = _NEXT[initial][state]
            row += symbol != "-"
        return found


#: What a state costs more, at most, than the state it is compared with; above that it cannot win.
_WORSE = {
    _NOTHING: {_ASSISTANT: DELETE, _USER: DELETE + INSERT},
    _SYSTEM: {_ASSISTANT: 0, _USER: INSERT},
    _USER: {_ASSISTANT: INSERT},
    _ASSISTANT: {_USER: INSERT},
}


class Reading:
    """The blocks of one conversation, read from left to right."""

    def __init__(self) -> None:
        self.total = Block()
        self.audit: list[str] = []  # final
        # By state: cost, and audit and lines since what is final.
        self.states: dict[int, tuple[int, str, list]] = {_NOTHING: (0, "", [])}

    def add(self, block: Block, memo: Memo | None = None) -> list[tuple[str, str, str]]:
        """Takes the next block; returns lines that have become final."""
        self._count(block)
        cell = chart("".join(block.symbols), memo)
        best: dict[int, tuple[tuple[int, str], int, str]] = {}
        for p, (cost, audit, _) in self.states.items():
            for q, (more, rest) in cell.get(p, {}).items():
                value = (cost + more, audit + rest)
                if q not in best or value < best[q][0]:
                    best[q] = (value, p, rest)
        costs = {q: value[0] for q, (value, _, _) in best.items()}
        for q, others in _WORSE.items():
            if q in best and any(costs[q] > costs[o] + w for o, w in others.items() if o in costs):
                del best[q]
        before = {p for _, p, _ in best.values()}
        final: list[tuple[str, str, str]] = []
        if len(before) == 1:
            (p,) = before
            _, audit, final = self.states[p]
            self.audit.append(audit)
            self.states = {p: (self.states[p][0], "", [])}
        self.states = {
            q: (value[0], self.states[p][1] + rest, self.states[p][2] + block.lines(p, rest))
            for q, (value, p, rest) in best.items()
        }
        return final

    def _count(self, block: Block) -> None:
        t = self.total
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(t, name, getattr(t, name) + getattr(block, name))
        if t.initials and block.initials:
            t.illegal += t.initials[1] + block.initials[0] not in ("su", "ua", "au")
        if block.initials:
            t.initials = (t.initials[:1] or block.initials[0]) + block.initials[1]
        if block.first_turn is not None:
            t.turns -= t.last_turn == block.first_turn
            t.first_turn = block.first_turn if t.first_turn is None else t.first_turn
            t.last_turn = block.last_turn

    def end(self) -> tuple[int, str, list[tuple[str, str, str]]]:
        """Cost, whole audit, and the lines that were not final yet."""
        cost, audit, lines = min(
            self.states[q] for q in _SOUND if q in self.states
        )
        return cost, "".join(self.audit) + audit, lines

    def gaps(self) -> int:
        t = self.total
        return 0 if t.first_turn is None else t.last_turn - t.first_turn + 1 - t.turns


class Digest:
    """SHA-256 of ``role:text`` lines, joined by newlines."""

    def __init__(self) -> None:
        self.sha, self.started = hashlib.sha256(), False

    def add(self, lines: Iterable[tuple[str, str, str]]) -> None:
        for _, role, text in lines:
            line = f"{role}:{text}".encode()
            self.sha.update(b"\n" + line if self.started else line)
            self.started = True


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_SUMMARY = f"conv_id {{}}, {_COUNTS}, audit string, repaired_sha256 string"
_BLOCK = (
    "task int, number int, symbols string, roles array<string>, texts array<string>, "
    "blank_rows long, duplicate_rows long, truncated_rows long, illegal_pairs long, "
    "initials string, turns long, first_turn long, last_turn long"
)
_LINE = "conv_id {}, part long, lines array<struct<edit: string, role: string, text: string>>"


def _packed(block: Block) -> dict:
    return {
        "symbols": "".join(block.symbols),
        "roles": block.roles,
        "texts": block.texts,
        "blank_rows": block.blank,
        "duplicate_rows": block.duplicate,
        "truncated_rows": block.truncated,
        "illegal_pairs": block.illegal,
        "initials": block.initials,
        "turns": block.turns,
        "first_turn": block.first_turn,
        "last_turn": block.last_turn,
    }


def _unpacked(row: dict) -> Block:
    return Block(
        [row["symbols"]],
        row["roles"],
        row["texts"],
        row["blank_rows"],
        row["duplicate_rows"],
        row["truncated_rows"],
        row["illegal_pairs"],
        row["initials"],
        row["turns"],
        row["first_turn"],
        row["last_turn"],
    )


def _summary(conv_id, blocks: Iterable[Block], memo: Memo) -> dict:
    reading, digest = Reading(), Digest()
    for block in blocks:
        digest.add(reading.add(block, memo))
    cost, audit, lines = reading.end()
    digest.add(lines)
    t = reading.total
    return {
        "conv_id": conv_id,
        "gaps": reading.gaps(),
        "blank": t.blank,
        "duplicate": t.duplicate,
        "truncated": t.truncated,
        "illegal": t.illegal,
        "cost": cost,
        "audit": audit,
        "repaired_sha256": digest.sha.hexdigest(),
    }


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            yield from batch.slice(k, 256).to_pylist()


def _cut(rows: Iterable[dict]) -> Iterator[tuple[object, Block, bool]]:
    """Conversation, block, and whether the next block is of the same one."""
    conv, block = None, None
    for row in rows:
        if block is None or row["conv_id"] != conv:
            if block is not None:
                yield conv, block, False
            conv, block = row["conv_id"], Block()
        n, first = row["n"], row["first"]
        while n:
            # A string of symbols per run, so its length is what counts.
            held = sum(map(len, block.symbols))
            if held and (held >= BLOCK or block.size + len(row["text"]) > TEXT):
                yield conv, block, True
                block, held = Block(), 0
            taken = min(n, BLOCK - held)
            block.add(row["turn"], row["role"], row["text"], row["kind"], taken, first)
            n, first = n - taken, False
    if block is not None:
        yield conv, block, False


def _parser(schema: StructType):
    """From ordered rows: summaries of whole conversations, blocks of those that may go on
    in another task or have several blocks."""
    arrow = to_arrow_schema(schema)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, out = Memo(), []
        task = TaskContext.get().partitionId()
        ordinal = number = 0  # of the conversation within the task, of its block
        chars = 0
        held: tuple | None = None  # the last block, which may be the task's last

        def opened(conv, block: Block, number: int) -> dict:
            return {"conv_id": conv, "task": task, "number": number, **_packed(block)}

        for conv, block, goes_on in _cut(_rows(batches)):
            if held is not None:
                out.append(_summary(*held, memo))
                held = None
            if ordinal == 0 or number or goes_on:
                out.append(opened(conv, block, number))
                chars += block.size
            else:
                held = (conv, [block])
            number = number + 1 if goes_on else 0
            ordinal += not goes_on
            if len(out) >= 1000 or chars >= TEXT:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out, chars = [], 0
        if held is not None:
            out.append(opened(held[0], held[1][0], 0))
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    return parse


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, bool, Block]]:
    """Conversation, whether it is a new one, and block, from ordered block rows."""
    before: tuple = ()
    for batch in batches:
        for k in range(batch.num_rows):
            (row,) = batch.slice(k, 1).to_pylist()
            yield row["conv_id"], before != (row["conv_id"],), _unpacked(row)
            before = (row["conv_id"],)


def _joiner(schema: StructType):
    """Summaries from blocks in order."""
    arrow = to_arrow_schema(schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo()
        blocks = _blocks(batches)
        ahead = next(blocks, None)
        while ahead is not None:
            conv = ahead[0]

            def own() -> Iterator[Block]:
                nonlocal ahead
                yield ahead[2]
                while (ahead := next(blocks, None)) is not None and not ahead[1]:
                    yield ahead[2]

            yield pa.RecordBatch.from_pylist([_summary(conv, own(), memo)], arrow)

    return join


def _liner(schema: StructType):
    """Repaired turns from blocks in order, as they become final."""
    arrow = to_arrow_schema(schema)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, reading, conv, part = Memo(), None, None, 0

        def made(found: list) -> pa.RecordBatch:
            names = ("edit", "role", "text")
            rows = [dict(zip(names, line)) for line in found]
            return pa.RecordBatch.from_pylist([{"conv_id": conv, "part": part, "lines": rows}], arrow)

        for own, new, block in _blocks(batches):
            if new:
                if reading is not None:
                    yield made(reading.end()[2])
                reading, conv, part = Reading(), own, 0
            if found := reading.add(block, memo):
                yield made(found)
                part += 1
        if reading is not None:
            yield made(reading.end()[2])

    return lines


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` of rows as they are."""
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")),
        F.lit(1).alias("copies"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """``turns`` with a fault in a fifth or so of the rows, by the CRC-32 of ``conv_id:turn``.

    Modulo 20, 0 drops a row (no copies, so that its conversation stays), 1
    empties its text, 2 takes the marks that may end a sentence out of it, 3
    repeats it and 4 makes it the user's.
    """
    names = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(names[0], F.lit(":"), names[1]).cast("binary")) % 20
    text, role = F.col("text"), F.col("role")
    gone = F.col("fault") == 0
    return (
        turns(conversations)
        .withColumn("fault", fault)
        .select(
            "conv_id",
            "turn",
            F.when(gone, "").when(F.col("fault") == 4, "user").otherwise(role).alias("role"),
            F.when(gone | (F.col("fault") == 1), "")
            .when(F.col("fault") == 2, F.translate(text, ENDS, ""))
            .otherwise(text)
            .alias("text"),
            F.when(gone, 0).when(F.col("fault") == 3, 2).otherwise(1).alias("copies"),
        )
    )


def ordered(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, kind, n, first``: rows alike as one, in order within tasks."""
    trimmed = F.rtrim("text", F.lit(SPACE))
    kind = (
        F.when(trimmed == "", "blank")
        .when(F.substring(trimmed, -1, 1).isin(*ENDS), "whole")
        .otherwise("truncated")
    )
    alike = (
        rows.groupBy("conv_id", "turn", "role", "text")
        .agg(F.sum("copies").alias("n"))
        .select("*", F.md5(F.col("text").cast("binary")).alias("digest"), kind.alias("kind"))
    )
    # A row per role and text that a conversation has in several turns.
    again = (
        alike.where("n > 0 AND kind <> 'blank'")
        .groupBy("conv_id", "role", "digest")
        .agg(F.min(F.struct("turn")).alias("earliest"), F.count("*").alias("seen"))
        .where("seen > 1")
        .select(F.col("conv_id").alias("conv"), F.col("role").alias("r"), F.col("digest").alias("d"), "earliest")
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("conv"))
        & (F.col("role") == F.col("r"))
        & (F.col("digest") == F.col("d"))
    )
    first = F.col("earliest").isNull() | F.col("earliest")["turn"].eqNullSafe(F.col("turn"))
    order = ("conv_id", "turn", "role", "digest")
    return (
        alike.join(again, same, "left")
        .select("conv_id", "turn", "role", "digest", "text", "kind", "n", first.alias("first"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("digest")
    )


def _schema(rows: DataFrame, template: str) -> StructType:
    return StructType.fromDDL(template.format(rows.schema["conv_id"].dataType.simpleString()))


def repair(rows: DataFrame) -> DataFrame:
    """A row per conversation of ``turns``: faults, cost, audit and digest of the repaired one."""
    summary = _schema(rows, _SUMMARY)
    either = _schema(rows, f"{_SUMMARY}, {_BLOCK}")
    parsed = staged(ordered(rows).mapInArrow(_parser(either), either))
    whole = parsed.where("task IS NULL").select(*summary.names)
    return whole.unionByName(_open(parsed).mapInArrow(_joiner(summary), summary))


def _open(parsed: DataFrame) -> DataFrame:
    """Blocks of conversations, those of each in order in one task."""
    order = ("conv_id", "task", "number")
    blocks = parsed.where("task IS NOT NULL")
    return blocks.repartition("conv_id").sortWithinPartitions(*order)


def _all_open(schema: StructType):
    """Every conversation as blocks."""
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for conv, block, goes_on in _cut(_rows(batches)):
            row = {"conv_id": conv, "task": task, "number": number, **_packed(block)}
            yield pa.RecordBatch.from_pylist([row], arrow)
            number = number + 1 if goes_on else 0

    return cut


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, position, edit, role, text`` of every turn."""
    blocks, lines = _schema(rows, f"conv_id {{}}, {_BLOCK}"), _schema(rows, _LINE)
    cut = ordered(rows).mapInArrow(_all_open(blocks), blocks)
    parts = _open(cut).mapInArrow(_liner(lines), lines)
    return parts.select("conv_id", "part", F.posexplode("lines").alias("at", "line")).select(
        "conv_id", F.struct("part", "at").alias("position"), "line.*"
    )
