"""Cheapest repair of the turn structure of conversations.

A repair keeps, reroles or deletes each row and may insert empty turns, so that the
roles read ``(s?(ua)+)?``.  It is a path through a graph of (row, automaton
state); the weight of a path is one integer: its cost in the high digits, below
it the letters of its edits, a byte each, the first letter highest and zeros after the
last.  The least integer thus is the cheapest repair, and of these the one whose letters
come first in ASCII order, and putting the same edit in front of two paths does not change which
is less, so a dynamic program over integers from the last row to the first decides all.

Rows are sorted over all partitions and cut into blocks of a conversation.  A
block is solved for every pair of states before and after it; two paths of one pair
and cost differ in a letter before either ends (all letters but inserts count rows, and
a round of inserts costs something), so least paths of blocks add up to the least path of the
conversation.  A conversation of any length is spread over tasks; what is gathered
for it are the letters of its edits, of which its result holds one set anyway.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small

#: States: nothing yet, after a system, a user and an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FINAL = (START, ASSISTANT)
#: The state after a kept turn, by state and role initial.
KEPT = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT,
}
#: The state after an inserted or reroled turn; the state tells the role.
MADE = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
#: Costs of the edits, and of a truncated row that stays.
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
#: No gap takes more inserts: a third one leads to a state that one leads to.
GAP = 2
#: A block ends after so many rows, copies of rows or characters.
BLOCK_ROWS, BLOCK_COPIES, BLOCK_CHARS = 256, 4096, 1 << 20
#: Copies of keys with repeated turns in the join that finds repeats.
SALTS = 16


class Row(NamedTuple):
    """Equal rows of one turn: the first one and ``copies - 1`` repeats.

    ``dead``: the first one is blank or a repeat too, and must go.
    """

    role: str
    text: str
    copies: int
    dead: bool
    truncated: bool


def _put(letters: bytes, cost: int, rest: int | None, bits: int) -> int | None:
    """The weight of ``letters`` in front of the path of weight ``rest``, if there is such a path."""
    if rest is None:
        return None
    n = 8 * len(letters)
    paid, code = rest >> bits, rest & ((1 << bits) - 1)
    return ((paid + cost) << bits) + (int.from_bytes(letters) << (bits - n)) + (code >> n)


def _least(*weights: int | None) -> int | None:
    return min((w for w in weights if w is not None), default=None)


def _gap(after: list, bits: int) -> list:
    """Least weights from each state before a gap, where ``after`` has them for the states behind it."""
    found = after
    for _ in range(GAP):
        found = [_least(after[q], _put(b"I", INSERT, found[MADE[q]], bits)) for q in STATES]
    return found


def _row(row: Row, after: list, bits: int) -> list:
    """Least weights from each state before ``row``."""
    repeats = b"D" * (row.copies - 1)
    gone = DELETE * len(repeats)
    stays = gone + TRUNCATED * row.truncated
    found = []
    for q in STATES:
        options = [_put(b"D" + repeats, DELETE + gone, after[q], bits)]
        if not row.dead:
            if (kept := KEPT.get((q, row.role[:1]))) is not None:
                options.append(_put(b"K" + repeats, stays, after[kept], bits))
            options.append(_put(b"R" + repeats, REROLE + stays, after[MADE[q]], bits))
        found.append(_least(*options))
    return found


def least_edits(rows: list[Row], end: bool = False) -> list[list[tuple[int, str] | None]]:
    """(cost, letters) of the least path for each state before and after ``rows``.

    Each row's gap is the one in front of it; with ``end`` the one behind the last row belongs to them too.
    """
    bits = 8 * (sum(r.copies for r in rows) + GAP * (len(rows) + 1))
    table = [[None] * len(STATES) for _ in STATES]
    for goal in STATES:
        weights = [0 if q == goal else None for q in STATES]
        if end:
            weights = _gap(weights, bits)
        for row in reversed(rows):
            weights = _gap(_row(row, weights, bits), bits)
        for q, w in enumerate(weights):
            if w is not None:
                letters = (w & ((1 << bits) - 1)).to_bytes(bits // 8).rstrip(b"\0")
                table[q][goal] = (w >> bits, letters.decode())
    return table


def _weight(cost: int, letters: str, width: int) -> int:
    return (cost << 8 * width) + int.from_bytes(letters.encode().ljust(width, b"\0"))


def _cheapest(options: list[tuple]) -> tuple | None:
    """The option (cost, letters, ...) of least weight."""
    width = max((len(o[1]) for o in options), default=0)
    return min(options, key=lambda o: _weight(o[0], o[1], width), default=None)


def _onward(reached: dict, table: list) -> dict:
    """state -> (cost, letters, state before) behind a block, from the least paths up to it."""
    found = {}
    for goal in STATES:
        options = [
            (cost + table[q][goal][0], letters + table[q][goal][1], q)
            for q, (cost, letters, _) in reached.items()
            if table[q][goal] is not None
        ]
        if options:
            found[goal] = _cheapest(options)
    return found


def rebuilt(rows: list[Row], letters: str, state: int) -> list[tuple[str, str]]:
    """The turns (role, text) that ``letters`` make of ``rows``, from ``state`` on."""
    said, at, copy = [], 0, 0
    for letter in letters:
        if letter == "I":
            state = MADE[state]
            said.append((ROLES[state], ""))
            continue
        row = rows[at]
        if letter == "K":
            state = KEPT[state, row.role[:1]]
            said.append((row.role, row.text))
        elif letter == "R":
            state = MADE[state]
            said.append((ROLES[state], row.text))
        copy += 1
        if copy == row.copies:
            at, copy = at + 1, 0
    return said


def blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def truncated(text: Column) -> Column:
    """The last character that is not blank is no full stop, exclamation or question mark."""
    return ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def _faults(turns: DataFrame, id_col: str) -> DataFrame:
    """Equal rows of a turn as one, with their number and the faults of the first one."""
    rows = (
        turns.select(
            F.col(id_col).alias("conv"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit(" ")).alias("role"),
            F.coalesce("text", F.lit(" ")).alias("text"),
        )
        .groupBy("conv", "turn", "role", "text")
        .agg(F.count("*").alias("copies"))
        .withColumn("key", F.unhex(F.sha2("text", 256)))
    )
    # Turns of a conversation that say the same: only these are joined, dealt over salts.
    repeated = (
        rows.filter(~blank(F.col("text")))
        .groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("key").alias("k"))
        .agg(
            F.count("*").alias("turns"),
            F.max(F.col("turn").isNull()).alias("unnumbered"),
            F.min("turn").alias("first"),
        )
        .filter("turns > 1")
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("turn"), F.lit(SALTS)).cast("int"))
    same = (
        F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
        & (F.col("key") == F.col("k")) & (F.col("salt") == F.col("s"))
    )
    seen = F.coalesce(
        F.when(F.col("unnumbered"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first")), F.lit(False)
    )
    empty = blank(F.col("text"))
    return salted.join(repeated, same, "left").select(
        "conv", "turn", "role", "text", "copies",
        empty.alias("blank"),
        (~empty & seen).alias("seen"),
        (~empty & ~seen & truncated(F.col("text"))).alias("truncated"),
    )


_EDITS = pa.list_(pa.struct([("cost", pa.int64()), ("letters", pa.string())]))
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_ROWS = pa.list_(
    pa.struct(
        [("role", pa.string()), ("text", pa.string()), ("copies", pa.int64()), ("dead", pa.bool_()),
         ("truncated", pa.bool_())]
    )
)
EDITS = "array<struct<cost:bigint,letters:string>>"
TURNS = "array<struct<role:string,text:string>>"
ROWS = "array<struct<role:string,text:string,copies:bigint,dead:boolean,truncated:boolean>>"
#: Behind all blocks: the gap after the last row.
LAST_PART = (1 << 31) - 1


_FACTS = ["blank", "duplicate", "truncated", "illegal", "numbers", "low", "high"]


def _facts(rows: list[Row], marks: list[dict]) -> dict:
    """What the result counts, for one block; numbers are its different turn numbers from low to high."""
    initials, turns = [r.role[:1] for r in rows], [m["turn"] for m in marks if m["turn"] is not None]
    return {
        "blank": sum(m["copies"] for m in marks if m["blank"]),
        "duplicate": sum(m["copies"] - (not m["seen"]) for m in marks if not m["blank"]),
        "truncated": sum(m["truncated"] for m in marks),
        "illegal": sum(r.copies - 1 for r in rows)
        + sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        "numbers": len(set(turns)),
        "low": turns[0] if turns else None,
        "high": turns[-1] if turns else None,
    }


def _to_blocks(batches):
    """Blocks (conv, part, seq, rows, edits, first, last, facts) of rows in order."""
    part, seq = TaskContext.get().partitionId(), 0
    kind, conv, rows, marks = None, None, [], []
    copies, chars = 0, 0

    def block():
        edits = [e and {"cost": e[0], "letters": e[1]} for line in least_edits(rows) for e in line]
        facts = list(_facts(rows, marks).values())
        values = [conv, part, seq, [r._asdict() for r in rows], edits, rows[0].role[:1], rows[-1].role[:1], *facts]
        kinds = [kind, pa.int32(), pa.int64(), _ROWS, _EDITS, pa.string(), pa.string(), *[pa.int64()] * len(_FACTS)]
        names = ["conv", "part", "seq", "rows", "edits", "first", "last", *_FACTS]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    for batch in small(batches):
        kind = batch.schema.field(0).type
        for r in batch.to_pylist():
            full = len(rows) >= BLOCK_ROWS or copies >= BLOCK_COPIES or chars >= BLOCK_CHARS
            if rows and (full or r["conv"] != conv):
                yield block()
                rows, marks, copies, chars, seq = [], [], 0, 0, seq + 1
            conv = r["conv"]
            rows.append(Row(r["role"], r["text"], r["copies"], r["blank"] or r["seen"], r["truncated"]))
            marks.append(r)
            copies, chars = copies + r["copies"], chars + len(r["text"])
    if rows:
        yield block()


class _Conversation:
    """The least paths through the blocks of one conversation so far."""

    def __init__(self, conv):
        self.conv, self.reached, self.back, self.last = conv, {START: (0, "", START)}, [], None
        self.facts = dict.fromkeys(_FACTS[:5], 0) | {"low": None, "high": None}

    def add(self, r: dict) -> None:
        flat = [e and (e["cost"], e["letters"]) for e in r["edits"]]
        table = [flat[k : k + len(STATES)] for k in range(0, len(flat), len(STATES))]
        self.reached = _onward(self.reached, table)
        self.back.append((r["part"], r["seq"], {q: w[2] for q, w in self.reached.items()}, table))
        facts = self.facts
        for name in _FACTS[:5]:
            facts[name] += r[name]
        facts["illegal"] += self.last is not None and self.last + r["first"] not in LEGAL
        if r["numbers"]:
            facts["numbers"] -= facts["high"] == r["low"]  # one turn on both sides of a cut
            facts["low"] = r["low"] if facts["low"] is None else facts["low"]
            facts["high"] = r["high"]
        self.last = r["last"]

    def lines(self):
        """One row of the result (part null), and the state and edits of each block."""
        cost, letters, state = _cheapest(
            [w for q, w in _onward(self.reached, least_edits([], end=True)).items() if q in FINAL]
        )
        facts = self.facts
        gaps = facts["high"] - facts["low"] + 1 - facts["numbers"] if facts["numbers"] else 0
        yield (self.conv, None, None, None, letters, cost, gaps, *[facts[n] for n in _FACTS[:4]])
        none = (None,) * 6
        yield (self.conv, LAST_PART, 0, state, letters[len(self.reached[state][1]) :], *none)
        for part, seq, before, table in reversed(self.back):
            goal, state = state, before[state]
            yield (self.conv, part, seq, state, table[state][goal][1], *none)


def _decide(batches):
    names = ["conv", "part", "seq", "state", "letters", "cost", "gaps", *_FACTS[:4]]
    kind, open_one = None, None

    def result():
        kinds = [kind, pa.int32(), pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 6]
        columns = zip(*open_one.lines(), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in small(batches):
        kind = batch.schema.field(0).type
        for r in batch.to_pylist():
            if open_one is None or r["conv"] != open_one.conv:
                if open_one is not None:
                    yield result()
                open_one = _Conversation(r["conv"])
            open_one.add(r)
    if open_one is not None:
        yield result()


def _rebuild(batches):
    for batch in small(batches, 20):
        said = []
        for r in batch.to_pylist():
            rows = [Row(**x) for x in r["rows"] or []]
            said.append([{"role": a, "text": b} for a, b in rebuilt(rows, r["letters"], r["state"])])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(said, _TURNS)],
            ["conv", "part", "seq", "turns"],
        )


class Repaired(NamedTuple):
    """``conversations``: ``id_col``, gaps, blank, duplicate, truncated, illegal, cost, audit.

    ``pieces``: ``id_col``, part, seq, turns; the repaired turns (role, text) of a conversation
    are those of its pieces in the order of part and seq.
    """

    conversations: DataFrame
    pieces: DataFrame


def repair(turns: DataFrame, id_col: str = "conv_id") -> Repaired:
    """The cheapest repair of each conversation of ``turns`` (``id_col``, turn, role, text).

    Rows are taken by turn, rows without a number first; rows of one turn by role, then
    text, so repeated rows lie side by side.  A null role or text is one space.  A
    row's first fault counts: blank; duplicate, if role and text came before;
    truncated, if its last character is no stop.  Blank and duplicate rows are
    deleted.  Only a role's initial counts; an empty role has none and cannot be kept.
    gaps is the number of turn numbers missing between the least and the greatest;
    illegal the number of neighbouring rows whose initials are not su, ua or
    au.  Rows without a conversation id form one conversation.  Other columns are not read.
    An empty table gives two empty results.
    """
    rows = _faults(turns, id_col)
    kind = rows.schema["conv"].dataType.simpleString()
    numbers = ", ".join(f"{n} bigint" for n in _FACTS)
    order = ["conv", "turn", "role", "text"]
    blocks = cut(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _to_blocks,
            f"conv {kind}, part int, seq bigint, rows {ROWS}, edits {EDITS}, first string, last string, {numbers}",
        )
    )
    numbers = ", ".join(f"{n} bigint" for n in ["cost", "gaps", *_FACTS[:4]])
    decided = cut(
        blocks.drop("rows").repartition("conv").sortWithinPartitions("conv", "part", "seq").mapInArrow(
            _decide, f"conv {kind}, part int, seq bigint, state int, letters string, {numbers}"
        )
    )
    ways = decided.filter("part IS NOT NULL").select("conv", "part", "seq", "state", "letters")
    inside = blocks.select("part", "seq", "rows").join(ways.filter(F.col("part") != LAST_PART), ["part", "seq"])
    behind = ways.filter((F.col("part") == LAST_PART) & (F.col("letters") != "")).withColumn("rows", F.lit(None).cast(ROWS))
    pieces = (
        inside.unionByName(behind).select("conv", "part", "seq", "state", "letters", "rows")
        .mapInArrow(_rebuild, f"conv {kind}, part int, seq bigint, turns {TURNS}")
    )
    conversations = decided.filter("part IS NULL").select(
        F.col("conv").alias(id_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
        F.col("letters").alias("audit"),
    )
    return Repaired(conversations, pieces.withColumnRenamed("conv", id_col))


def digests(pieces: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(``id_col``, sha256) of the repaired turns as `role:text` lines; a conversation is read as a stream."""
    kind = pieces.schema[id_col].dataType.simpleString()
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    ordered = (
        pieces.select(F.col(id_col).alias("conv"), "part", "seq", (F.size("turns") > 0).alias("any"), lines.alias("lines"))
        .repartition("conv").sortWithinPartitions("conv", "part", "seq")
    )

    def run(batches):
        kind, conv, state, empty = None, None, None, True
        for batch in small(batches, 100):
            kind, done = batch.schema.field(0).type, []
            for r in batch.to_pylist():
                if state is None or r["conv"] != conv:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state, empty = r["conv"], hashlib.sha256(), True
                if r["any"]:
                    state.update(b"" if empty else b"\n")
                    state.update(r["lines"].encode())
                    empty = False
            yield _digest_batch(done, kind)
        if state is not None:
            yield _digest_batch([(conv, state.hexdigest())], kind)

    return ordered.mapInArrow(run, f"conv {kind}, sha256 string").withColumnRenamed("conv", id_col)


def _digest_batch(rows, kind):
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())], ["conv", "sha256"]
    )
