"""Repairs against a plain dynamic programme over (cost, audit)."""

import hashlib
import re
import zlib
from functools import cache

import numpy as np
import pytest

from demandspark.llm import op13_repair as op
from demandspark.llm.registry import QUERIES

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SPACE = " \t\n\x0b\x0c\r"


def spoiled(conv, turn, role, text):
    role, text = " " if role is None else role, " " if text is None else text
    key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
    what = zlib.crc32(key.encode()) % 20
    if what == 0:
        return []
    text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
    row = (turn, "user" if what == 4 else role, text)
    return [row, row] if what == 3 else [row]


def least(rows, faults):
    @cache
    def go(i, state, inserted):
        """(cost, audit, lines) with states as the initial of what was written last."""
        after = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        name = {"u": "user", "a": "assistant"}[after]
        out = []
        if i == len(rows):
            if state in ("", "a"):
                out.append((0, "", ()))
        else:
            _, role, text = rows[i]
            c, a, lines = go(i + 1, state, 0)
            out.append((c + 3, "D" + a, lines))
            if faults[i] in ("", "truncated"):
                extra, first = int(faults[i] == "truncated"), role[:1]
                if first == after or (first == "s" and state == ""):
                    c, a, lines = go(i + 1, first, 0)
                    out.append((c + extra, "K" + a, (f"{role}:{text}", *lines)))
                c, a, lines = go(i + 1, after, 0)
                out.append((c + 2 + extra, "R" + a, (f"{name}:{text}", *lines)))
        if inserted < 2:
            c, a, lines = go(i, after, inserted + 1)
            out.append((c + 2, "I" + a, (f"{name}:", *lines)))
        return min(out, default=(10**9, "", ()))

    return go(0, "", 0)


def brute(rows):
    convs = {}
    for conv, *row in rows:
        convs.setdefault(conv, []).extend(spoiled(conv, *row))
    out = []
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for _, role, text in mine:
            end = text.rstrip(SPACE)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated")
            seen.add((role, text))
        numbers = [t for t, _, _ in mine if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [r[:1] for _, r, _ in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = least(mine, faults)
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_query_against_plain_python(spark, folder):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    got = QUERIES["op13_repair"][0](spark, folder)
    assert got.columns == list(COLUMNS)
    assert found(got) == brute(rows)


@pytest.mark.parametrize("block", [64, 3])
def test_any_roles_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(op, "BLOCK", block)
    rng = np.random.default_rng(7)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    texts = ["Fine.", "Yes! ", "cut off", "", " \t", None, "Why?\n", "a.b"]
    rows = []
    for conv in range(120):
        for turn in range(int(rng.integers(1, 12))):
            rows.append((conv, int(turn * rng.integers(1, 3)) if conv % 9 == 0 else turn, roles[rng.integers(0, 8)], f"{texts[rng.integers(0, 8)] or ''}"))
        if conv % 7 == 0:
            rows.append((conv, None, "user", "No turn."))
    rows = list(dict.fromkeys((c, t, r, x) for c, t, r, x in rows))
    # Rows of one turn are ordered by a hash of the text, which plain Python lacks: one row per turn.
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())
    rows += [(500, t, ("user", "assistant", "user")[t % 3], f"Line {t // 2}.") for t in range(150)]
    rows += [(600, 0, "user", "y" * 200_000 + "."), (601, 5, None, None), (None, 1, "user", "Null id."), (-3, 2, "assistant", "x.")]
    rows += [(700, None, "user", "Alone."), (701, 3, "user", "Twice."), (701, 3, "user", "Twice.")]
    rows += [(c, 0, "user", "Hi.") for c in range(800, 860)]  # some lose their only row
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    frame = frame.selectExpr("*", "1 as place", "2 as code", "3 as audit", "4 as ROLE2", "5 as what", "6 as block")
    got = found(op.repair(frame))
    assert got == brute(rows)
    assert any(r[7] == "" for r in got)


def test_auction_against_all_sequences():
    """Every short text of codes, each state: least cost and ASCII-least edits by trying all."""
    import itertools

    for codes in ["", *map("".join, itertools.product("AEINFG", repeat=2)), *map("".join, itertools.product("AEIJ", repeat=4))]:
        best = {}

        def go(node, cost, edits, inserted, codes=codes, best=best):
            if cost > 14:
                return
            for spent, to, letter in op.arcs(codes, node // 4, node % 4, (0, op.NEVER, op.NEVER, 0), True):
                if to == 4 * len(codes) + 4:
                    best["x"] = min(best.get("x", (99, "")), (cost, edits))
                elif letter != "I" or inserted < 2:
                    go(to, cost + spent, edits + letter, inserted + 1 if letter == "I" else 0)

        go(0, 0, "", 0)
        _, cost, edits = op.repaired(codes, 0, (0, op.NEVER, op.NEVER, 0), True)
        assert (cost, edits) == best["x"], codes


def test_no_rows(spark):
    assert op.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
