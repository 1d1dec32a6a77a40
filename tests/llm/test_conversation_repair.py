import hashlib
import random
import zlib

import pytest

from penmark.llm import conversation_repair as cr

BLANKS = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        fate = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2], shown[3]
        if fate == 0:
            continue
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        role = "user" if fate == 4 else role
        out += [(conv, turn, role, text)] * (2 if fate == 3 else 1)
    return out


def repaired(turns):
    """Turn by turn, keeping the cheapest edits of every role said last."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest()))
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    counts, seen, initials = dict.fromkeys(cr.COUNTS, 0), set(), [t[1][:1] for t in turns]

    def inserted(states):
        states = dict(states)
        for _ in range(4):
            for last, (cost, audit, lines) in list(states.items()):
                for r in follow[last]:
                    if r in names:
                        new = (cost + 5, audit + "I", lines + [names[r] + ":"])
                        states[r] = min(states.get(r, new), new)
        return states

    states = {"": (0, "", [])}
    for turn, role, text in turns:
        body = text.strip(BLANKS)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        following = {}
        for last, (cost, audit, lines) in inserted(states).items():
            ways = [(last, cost + 2, "D", [])]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault else 0
                ways += [(r, cost + more, "K", [f"{role}:{text}"]) for r in follow[last] if r == role[:1]]
                ways += [(r, cost + more + 1, "R", [f"{names[r]}:{text}"]) for r in follow[last] if r in names]
            for state, c, edit, line in ways:
                new = (c, audit + edit, lines + line)
                following[state] = min(following.get(state, new), new)
        states = following
    done = inserted(states)
    cost, audit, lines = min(done[s] for s in ("", "a") if s in done)
    numbers = [t[0] for t in turns if t[0] is not None]
    counts["gaps"] = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    counts["illegal"] = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (*counts.values(), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    groups = {r[0]: [] for r in rows}
    for conv, *turn in damaged(rows):
        groups[conv].append(tuple(turn))
    return {conv: repaired(turns) for conv, turns in groups.items()}


def table(spark, rows, n=4):
    # Columns with names that the operator uses inside.
    rows = [(*r, "x", "x", "x") for r in rows]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, conv string, digest string, place string").repartition(n)


def results(df):
    return {r.conv_id: (*[r[c] for c in cr.COUNTS], r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def random_rows(seed, n_convs, most):
    draw = random.Random(seed)
    roles = ["user", "assistant"] * 6 + ["system", "tool", None, "", "ucla", "User"]
    texts = ["One. ", "Two!\n", "three", "Why?", "", " \t", None, "é.", "x" * 3000 + "."]
    rows = []
    for conv in range(n_convs):
        for turn in range(draw.randint(1, most)):
            rows.append((conv or None, draw.choice([turn, turn, turn, turn + 1, None]), draw.choice(roles), draw.choice(texts)))
    return rows


@pytest.mark.parametrize("span_rows, partitions", [(4096, 3), (3, 8)])
def test_equals_turn_by_turn_repair(spark, monkeypatch, span_rows, partitions):
    monkeypatch.setattr(cr, "SPAN_ROWS", span_rows)
    monkeypatch.setattr(cr, "FAN", 2)
    rows = random_rows(span_rows, 150, 14)
    assert results(cr.repair_damaged(table(spark, rows, partitions))) == expected(rows)


def test_one_conversation_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(cr, "SPAN_ROWS", 64)
    rows = [(7, i, "user" if i % 3 else "assistant", f"turn {i}" + ".!"[i % 2] * (i % 5 > 0)) for i in range(3000)]
    # Among them many equal rows of one turn.
    rows += [(7, 5, "user", "again.")] * 800 + random_rows(5, 40, 5)
    assert results(cr.repair_damaged(table(spark, rows, 6))) == expected(rows)


def test_every_split_gives_the_same_cell():
    draw = random.Random(3)
    for _ in range(60):
        symbols = "".join(cr.symbol(draw.choice("suaox"), draw.choice(["", "", "t", "b"])) for _ in range(7))
        cells = [cr.combined(cr.Parser().cell(symbols[:k]), cr.Parser().cell(symbols[k:])) for k in range(2, len(symbols), 2)]
        assert all(c == cells[0] == cr.Parser().cell(symbols) for c in cells)


def test_empty_and_emptied(spark):
    assert results(cr.repair_damaged(table(spark, []))) == {}
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert results(cr.repair_damaged(table(spark, [(gone, 0, "user", "Hi.")]))) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
