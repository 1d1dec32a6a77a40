"""Repairing the structure of conversations by weighted interval parsing (CYK).

A conversation should have an optional system turn and then pairs of a user and an
assistant turn, or no turn at all. Edits turn any conversation into such a one:

    Keep 0   Rerole 1 (to user or assistant)   Delete 2   Insert 5 (an empty turn, anywhere)

A blank or duplicate turn must be deleted; a truncated one costs 5 more unless deleted.

The repair grammar is in Chomsky normal form. Its nonterminals X[p,q] read "these turns
take the dialogue from state p to state q"; states are the start and the last role said
(system, user, assistant). Rules are X[p,q] -> X[p,r] X[r,q], and X[p,q] -> turn for each
edit of a turn, closed under insertions before it. A cell holds for every (p, q) the least
(cost, audit), the audit being the initials of the edits in order. Cells of longer spans
come bottom-up from those of shorter ones. Any inner place splits X[p,q], because the
state there names the two halves, so a span takes one split and not all.

Ties go to the ASCII-least audit. Equally dear audits of a span are never prefixes of
one another (the longer one would have more insertions), so the least audit of a span is
the least audits of its halves, one after the other.

Rows are dealt by range of (conversation, turn), so that a conversation of a third of
all rows takes many tasks. Inside a task, whole conversations of up to SPAN_ROWS turns are
parsed at once. The first and the last conversation of a task, which may go on in the
next one, and longer ones are cut into spans; each span is parsed by itself, and Spark
combines the cells of FAN spans at a time, level by level. Only then is it known which state
each span starts and ends in; the repaired lines of the spans are then hashed in order as
they stream through a task.

Defined results. Nulls become one space before anything else: a null turn counts as no
number and comes first, a null conversation is one of its own. A role's initial is its first
character, so an empty or null role must be changed or deleted. Turns of equal number are
ordered by role and by a digest of role and text; equal rows are duplicates. A conversation
without rows after the damage has zeros, an empty audit and the hash of nothing. Very long
texts stay in Arrow batches and are hashed as a stream; very long conversations are cut as
said above, only the audit grows with them. An empty table gives an empty table. Columns of other
names are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from penmark.llm.common import stored

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5

# States of the dialogue: the start, and the last role said.
START, SYSTEM, USER, ASSISTANT = range(4)
# The roles that may follow a state, as the state they lead to.
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ROLES = {"u": "user", "a": "assistant"}
ENDS = (START, ASSISTANT)

SPAN_ROWS = 4096
FAN = 16
# Spans whose cells are worth remembering.
REMEMBER = 64
MOST_KNOWN = 1 << 16

BLANK_CHARS = r"\x20\x09-\x0D"
MUST_GO, CUT_SHORT, SOUND = "-", "!", "."

Cell = dict[tuple[int, int], tuple[int, str]]


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, turn, role, text of the rows after the damage that the CRC of ``conv:turn`` deals them."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col, role_col, text_col)]
    drawn = rows.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("bigint").alias("turn"),
        shown[2].alias("role"),
        shown[3].alias("text"),
        (F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20).alias("fate"),
    ).where("fate != 0")
    fate = F.col("fate")
    text = F.when(fate == 1, F.lit("")).when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(fate == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(fate == 3, 2).otherwise(1)
    return drawn.select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), times)).alias("again")).drop("again")


def as_turns(rows: DataFrame) -> DataFrame:
    """Rows of conv, turn, role and text with the flags and the digest that parsing needs."""
    tail = F.regexp_extract("text", rf"([^{BLANK_CHARS}])[{BLANK_CHARS}]*$", 1)
    return rows.select(
        "conv",
        "turn",
        "role",
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
        # Equal rows are apart by this number, so that many of them fill more than one task.
        F.monotonically_increasing_id().alias("salt"),
        F.when(tail == "", "b").when(~tail.isin(".", "!", "?"), "t").otherwise("").alias("fault"),
        "text",
    )


# -- cells ---------------------------------------------------------------------


def _better(cell: Cell, key: tuple[int, int], value: tuple[int, str]) -> None:
    if key not in cell or value < cell[key]:
        cell[key] = value


def insertions() -> Cell:
    """What no turn at all can become: the closure under insertions."""
    cell: Cell = {(p, p): (0, "") for p in NEXT}
    for _ in NEXT:
        for (p, q), (cost, audit) in list(cell.items()):
            for role, state in NEXT[q].items():
                if role in ROLES:
                    _better(cell, (p, state), (cost + COST[INSERT], audit + INSERT))
    return cell


CLOSURE = insertions()


def leaf(symbol: str) -> Cell:
    """Cell of one turn, by its initial (s, u, a or another) and its fault; insertions may come before it."""
    initial, fault = symbol
    edits: Cell = {}
    more = TRUNCATED if fault == CUT_SHORT else 0
    for p, following in NEXT.items():
        _better(edits, (p, p), (COST[DELETE], DELETE))
        if fault == MUST_GO:
            continue
        for role, state in following.items():
            if role == initial:
                _better(edits, (p, state), (COST[KEEP] + more, KEEP))
            if role in ROLES:
                _better(edits, (p, state), (COST[REROLE] + more, REROLE))
    return combined(CLOSURE, edits)


def combined(left: Cell, right: Cell) -> Cell:
    """X[p,q] -> X[p,r] X[r,q]."""
    cell: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(len(NEXT)):
            other = right.get((r, q))
            if other:
                _better(cell, (p, q), (cost + other[0], audit + other[1]))
    return cell


class Parser:
    """Cells of spans of symbols, two characters a turn. Those of short spans are remembered: few kinds of them occur."""

    def __init__(self):
        self.known: dict[str, Cell] = {}

    def cell(self, symbols: str) -> Cell:
        found = self.known.get(symbols)
        if found is None:
            half = len(symbols) // 4 * 2
            found = combined(self.cell(symbols[:half]), self.cell(symbols[half:])) if half else leaf(symbols)
            if len(symbols) <= 2 * REMEMBER:
                if len(self.known) >= MOST_KNOWN:
                    self.known.clear()
                self.known[symbols] = found
        return found


def best(cell: Cell) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation; insertions may follow the last turn."""
    closed = combined(cell, CLOSURE)
    return min(closed[START, q] for q in ENDS if (START, q) in closed)


def repaired_lines(state: int, audit: str, turns: list[tuple[str, str]]) -> tuple[list[str], int]:
    """The lines that the edits make of (role, text) turns from a state on, and the state they end in."""
    lines, at = [], iter(turns)
    for edit in audit:
        role, text = next(at) if edit != INSERT else ("", "")
        if edit == DELETE:
            continue
        if edit == KEEP:
            initial = role[:1]
        else:
            (initial,) = [r for r in NEXT[state] if r in ROLES]
            role = ROLES[initial]
        state = NEXT[state][initial]
        lines.append(f"{role}:{text}")
    return lines, state


# -- what a span of turns has -------------------------------------------------------


class Tally:
    """Counts over turns in order; two tallies of neighbouring spans add up to that of both."""

    NAMES = ("low", "high", "n_turns", "blank", "duplicate", "truncated", "illegal", "first_role", "last_role", "first_turn", "last_turn")

    def __init__(self, *values):
        self.v = list(values) if values else [None, None, 0, 0, 0, 0, 0, None, None, None, None]

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        low, high, n, blank, duplicate, truncated, illegal, first, last, first_turn, last_turn = self.v
        if turn is not None:
            low, high = turn if low is None else min(low, turn), turn if high is None else max(high, turn)
            n += turn != last_turn
            first_turn, last_turn = turn if first_turn is None else first_turn, turn
        if last is not None:
            illegal += last + initial not in ("su", "ua", "au")
        self.v = [
            low, high, n, blank + (fault == "b"), duplicate + (fault == "d"), truncated + (fault == "t"),
            illegal, initial if first is None else first, initial, first_turn, last_turn,
        ]

    def then(self, other: Tally) -> Tally:
        a, b = dict(zip(self.NAMES, self.v)), dict(zip(self.NAMES, other.v))
        both = {k: a[k] + b[k] for k in ("n_turns", "blank", "duplicate", "truncated", "illegal")}
        ends = [x for x in (a["low"], a["high"], b["low"], b["high"]) if x is not None]
        both |= {"low": min(ends, default=None), "high": max(ends, default=None)}
        if a["last_turn"] is not None and a["last_turn"] == b["first_turn"]:
            both["n_turns"] -= 1
        if a["last_role"] is not None and b["first_role"] is not None:
            both["illegal"] += a["last_role"] + b["first_role"] not in ("su", "ua", "au")
        for k, x, y in (("first_role", a, b), ("first_turn", a, b), ("last_role", b, a), ("last_turn", b, a)):
            both[k] = x[k] if x[k] is not None else y[k]
        return Tally(*[both[k] for k in self.NAMES])

    def counts(self) -> list[int]:
        low, high, n = self.v[:3]
        return [high - low + 1 - n if n else 0, *self.v[3:7]]


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]


def symbol(initial: str, fault: str) -> str:
    return (initial if initial in "sua" else "o") + {"b": MUST_GO, "d": MUST_GO, "t": CUT_SHORT}.get(fault, SOUND)


def _initial(role: str) -> str:
    return role[:1] or " "


# -- whole conversations, and what is cut ----------------------------------------------


def _parse(id_type: pa.DataType):
    """Results of the conversations that a task holds whole; the turns of the others."""
    turn_fields = [("conv", id_type), ("part", pa.int32()), ("span", pa.int64()), ("i", pa.int32()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.string()), ("fault", pa.string()), ("text", pa.string())]
    result_fields = [("whole", pa.bool_()), *[(c, pa.int64()) for c in COUNTS], ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
    schema = pa.schema([*turn_fields, *result_fields])
    at = {f: k for k, (f, _) in enumerate([*turn_fields, *result_fields])}

    parser = Parser()

    def result(conv, turns):
        tally, seen, marks = Tally(), set(), []
        for turn, role, digest, fault, _ in turns:
            fault = fault if fault == "b" else "d" if digest in seen else fault
            seen.add(digest)
            tally.add(turn, _initial(role), fault)
            marks.append(symbol(_initial(role), fault))
        cost, audit = best(parser.cell("".join(marks)))
        lines, _ = repaired_lines(START, audit, [(t[1], t[4]) for t in turns])
        row = [None] * len(at)
        row[0], row[at["whole"]] = conv, True
        row[at["gaps"] :] = [*tally.counts(), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()]
        return row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, turns, spans, n_convs, started = None, [], 0, 0, False
        out: list[list] = []

        def cut():
            nonlocal spans, turns
            for i, (turn, role, digest, fault, text) in enumerate(turns):
                out.append([conv, part, spans, i, turn, role, digest, fault, text, False, *[None] * (len(COUNTS) + 3)])
            spans, turns = spans + 1, []

        def finish(last: bool):
            # A task does not know whether its first and last conversations go on elsewhere.
            nonlocal spans, turns, n_convs
            if spans or not n_convs or last:
                cut()
            else:
                out.append(result(conv, turns))
            spans, turns, n_convs = 0, [], n_convs + 1

        def batch():
            nonlocal out
            ready = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
            return ready

        for rows in batches:
            columns = [rows.column(rows.schema.get_field_index(c)).to_pylist() for c in ("conv", "turn", "role", "digest", "fault", "text")]
            for own, *turn in zip(*columns):
                if started and own != conv:
                    finish(False)
                conv, started = own, True
                turns.append(turn)
                if len(turns) == SPAN_ROWS:
                    cut()
                if len(out) >= SPAN_ROWS:
                    yield batch()
        if started:
            finish(True)
        if out:
            yield batch()

    return run


# -- cut conversations --------------------------------------------------------------

CELL = "array<struct<p:int,q:int,cost:bigint,audit:string,path:string>>"
TALLY = "low bigint, high bigint, n_turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_role string, last_role string, first_turn bigint, last_turn bigint"


def _cell_rows(cell: Cell, paths: dict | None = None) -> list[dict]:
    return [{"p": p, "q": q, "cost": c, "audit": a, "path": (paths or {}).get((p, q), "")} for (p, q), (c, a) in cell.items()]


def _table(rows: list[list], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


CELL_TYPE = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("path", pa.string())]))
TALLY_TYPES = [pa.string() if "role" in n else pa.int64() for n in Tally.NAMES]


def _span_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("conv", id_type), ("place", pa.int64()), ("cell", CELL_TYPE), *zip(Tally.NAMES, TALLY_TYPES)])


def _parse_span(schema: pa.Schema):
    parser = Parser()

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("i")
        tally, marks = Tally(), []
        for turn, role, fault, first in zip(*[table.column(c).to_pylist() for c in ("turn", "role", "fault", "first_seen")]):
            fault = fault if fault == "b" or first else "d"
            tally.add(turn, _initial(role), fault)
            marks.append(symbol(_initial(role), fault))
        conv, place = table.column("conv")[0].as_py(), table.column("place")[0].as_py()
        return _table([[conv, place, _cell_rows(parser.cell("".join(marks))), *tally.v]], schema)

    return run


def _join_spans(schema: pa.Schema):
    """The cell of up to FAN neighbouring spans; a path holds the states between them."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        cell, paths, tally = None, {}, None
        for k in range(table.num_rows):
            entries = table.column("cell")[k].as_py()
            own: Cell = {(e["p"], e["q"]): (e["cost"], e["audit"]) for e in entries}
            inner = {(e["p"], e["q"]): e["path"] for e in entries}
            own_tally = Tally(*[table.column(n)[k].as_py() for n in Tally.NAMES])
            if cell is None:
                cell, paths, tally = own, inner, own_tally
                continue
            both: Cell = {}
            ways = {}
            for (p, r), (cost, audit) in cell.items():
                for q in range(len(NEXT)):
                    if (r, q) in own:
                        value = (cost + own[r, q][0], audit + own[r, q][1])
                        if (p, q) not in both or value < both[p, q]:
                            both[p, q], ways[p, q] = value, paths[p, r] + str(r) + inner[r, q]
            cell, paths, tally = both, ways, tally.then(own_tally)
        conv, place = table.column("conv")[0].as_py(), table.column("place")[0].as_py()
        return _table([[conv, place // FAN, _cell_rows(cell, paths), *tally.v]], schema)

    return run


def _finish(id_type: pa.DataType):
    """Result of a conversation from the cell over all its spans, and the states its spans start in."""
    schema = pa.schema([("conv", id_type), *[(c, pa.int64()) for c in COUNTS], ("cost", pa.int64()), ("audit", pa.string()), ("starts", pa.string()), ("end", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                entries = batch.column(1)[k].as_py()
                ways = []
                for e in entries:
                    for (r, q), (cost, audit) in CLOSURE.items():
                        if e["p"] == START and r == e["q"] and q in ENDS:
                            ways.append((e["cost"] + cost, e["audit"] + audit, e["path"] + str(r), audit))
                cost, audit, path, end = min(ways)
                tally = Tally(*[batch.column(2 + n)[k].as_py() for n in range(len(Tally.NAMES))])
                rows.append([batch.column(0)[k].as_py(), *tally.counts(), cost, audit, str(START) + path, end])
            yield from _table(rows, schema).to_batches() if rows else []

    return run


def _lines(schema: pa.Schema):
    """The repaired lines of a span whose two states are known."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("i")
        turns = list(zip(table.column("role").to_pylist(), table.column("text").to_pylist()))
        first = {c: table.column(c)[0].as_py() for c in ("conv", "place", "start", "audit", "end")}
        lines, state = repaired_lines(first["start"], first["audit"], turns)
        lines += repaired_lines(state, first["end"] or "", [])[0]
        return _table([[first["conv"], first["place"], len(lines), "\n".join(lines)]], schema)

    return run


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest per conversation of its spans' lines, which come in order."""
    conv, digest, any_line, out = None, None, False, []
    for batch in batches:
        for own, _, n, lines in zip(*[c.to_pylist() for c in batch.columns]):
            if digest is None or own != conv:
                if digest is not None:
                    out.append((conv, digest.hexdigest()))
                conv, digest, any_line = own, hashlib.sha256(), False
            if n:
                digest.update((("\n" if any_line else "") + lines).encode())
                any_line = True
    if digest is not None:
        out.append((conv, digest.hexdigest()))
        kind = batch.column(0).type
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], kind), pa.array([d for _, d in out])], ["conv", "repaired_sha256"])


def _same(left: DataFrame, right: DataFrame, *keys: str):
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[k])
    return condition


def _cut_results(parsed: DataFrame, kind: str, id_type: pa.DataType) -> DataFrame:
    """Results of the conversations that were cut into spans."""
    turns = stored(parsed.where("not whole").select("conv", "part", "span", "i", "turn", "role", "digest", "fault", "text"), "cut-turns")
    # Spans are numbered by a window over spans, of which there is one for thousands of turns.
    spans = turns.select("conv", "part", "span").distinct()
    place = F.row_number().over(Window.partitionBy("conv").orderBy("part", "span")) - 1
    spans = stored(spans.withColumn("place", place.cast("bigint")), "spans")
    where = turns.join(spans, _same(turns, spans, "conv", "part", "span")).select(*[turns[c] for c in turns.columns], "place")
    where = where.withColumn("key", F.sha2(F.concat_ws("\n", F.coalesce(F.col("conv").cast("string"), F.lit("-")), "digest"), 256))
    firsts = where.groupBy("key").agg(F.min(F.struct("place", "i")).alias("at")).withColumnRenamed("key", "first_key")
    marked = where.join(firsts, F.col("key") == F.col("first_key"))
    marked = marked.withColumn("first_seen", F.col("at") == F.struct("place", "i"))
    schema = _span_schema(id_type)
    ddl = f"conv {kind}, place bigint, cell {CELL}, {TALLY}"
    slim = marked.select("conv", "part", "span", "place", "i", "turn", "role", "fault", "first_seen")
    level = stored(slim.groupBy("conv", "part", "span").applyInArrow(_parse_span(schema), ddl), "cells")
    parsed_spans = level
    while (level.agg(F.max("place")).first()[0] or 0) > 0:
        level = stored(level.groupBy("conv", F.floor(F.col("place") / FAN)).applyInArrow(_join_spans(schema), ddl), "cells")
    whole = level.select("conv", "cell", *Tally.NAMES)
    done = whole.mapInArrow(
        _finish(id_type), f"conv {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", cost bigint, audit string, starts string, end string"
    )
    done = stored(done, "finished")
    # Which cell each span takes: its states are known now.
    states = done.select("conv", F.posexplode(F.split("starts", "")).alias("place", "start"), F.length("starts").alias("n"), "starts", "end")
    states = states.where(F.col("place") < F.col("n") - 1).select(
        "conv",
        F.col("place").cast("bigint").alias("place"),
        F.col("start").cast("int").alias("start"),
        F.substring("starts", F.col("place") + 2, F.lit(1)).cast("int").alias("stop"),
        F.when(F.col("place") == F.col("n") - 2, F.col("end")).alias("end"),
    )
    cells = parsed_spans.select("conv", "place", F.inline("cell"))
    taken = cells.join(states, _same(cells, states, "conv", "place") & (cells["p"] == states["start"]) & (cells["q"] == states["stop"]))
    taken = stored(taken.select(cells["conv"], cells["place"], "start", "audit", "end"), "edits")
    edited = where.join(taken, _same(where, taken, "conv", "place")).select(where["conv"], where["place"], "i", "role", "text", "start", "audit", "end")
    line_schema = pa.schema([("conv", id_type), ("place", pa.int64()), ("n", pa.int64()), ("lines", pa.string())])
    lines = edited.groupBy("conv", "place").applyInArrow(_lines(line_schema), f"conv {kind}, place bigint, n bigint, lines string")
    ordered = lines.repartition("conv").sortWithinPartitions("conv", "place")
    hashes = ordered.mapInArrow(_hash, f"conv {kind}, repaired_sha256 string")
    return done.join(hashes, _same(done, hashes, "conv")).select(done["conv"], *COUNTS, "cost", "audit", "repaired_sha256")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv, turn, role, text): counts, cost, audit and hash of the repair."""
    kind = rows.schema["conv"].dataType.simpleString()
    id_type = to_arrow_type(rows.schema["conv"].dataType)
    keys = ["conv", "turn", "role", "digest", "salt"]
    dealt = as_turns(rows).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ddl = (
        f"conv {kind}, part int, span bigint, i int, turn bigint, role string, digest string, fault string, text string, whole boolean, "
        + ", ".join(f"{c} bigint" for c in COUNTS)
        + ", cost bigint, audit string, repaired_sha256 string"
    )
    parsed = stored(dealt.mapInArrow(_parse(id_type), ddl), "parsed")
    whole = parsed.where("whole").select("conv", *COUNTS, "cost", "audit", "repaired_sha256")
    return whole.unionByName(_cut_results(parsed, kind, id_type))


def repair_damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repair of every conversation after its damage; conversations of which nothing is left are there too."""
    found = repair(damage(rows, conv_col, turn_col, role_col, text_col))
    every = rows.select(F.col(conv_col).alias("_conv")).distinct()
    joined = every.join(found, F.col("_conv").eqNullSafe(F.col("conv")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in (*COUNTS, "cost")]
    nothing = F.lit(hashlib.sha256().hexdigest())
    return joined.select(F.col("_conv").alias(conv_col), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
