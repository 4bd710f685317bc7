"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib

import pytest

from textmill.llm import conversations
from textmill.llm.queries import QUERIES

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, name string, digest string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        show = [" " if v is None else str(v) for v in (conv, turn)]
        fault = zlib.crc32(":".join(show).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def cheapest(turns):
    """(cost, audit, lines) over all edits, turn by turn: the least of each automaton state."""
    ways = {0: (0, "", [])}

    def inserted_chains(ways):
        # Two in a row reach every state.
        out = [(s, w) for s, w in ways]
        for state, way in out:
            if len(way[1]) - len(way[1].rstrip("I")) < 2:
                role, after = conversations.GIVEN[state]
                out.append((after, (way[0] + 5, way[1] + "I", way[2] + [f"{role}:"])))
        return out

    for role, text, doomed, cut in turns:
        met = []
        for state, (cost, audit, lines) in inserted_chains(ways.items()):
            met.append((state, (cost + 2, audit + "D", lines)))
            if not doomed:
                extra = 5 if cut else 0
                kept = conversations.KEPT[state].get(role[:1])
                if kept is not None:
                    met.append((kept, (cost + extra, audit + "K", lines + [f"{role}:{text}"])))
                given, after = conversations.GIVEN[state]
                met.append((after, (cost + 1 + extra, audit + "R", lines + [f"{given}:{text}"])))
        ways = {}
        for state, way in met:
            if state not in ways or way[:2] < ways[state][:2]:
                ways[state] = way
    ended = [w for s, w in inserted_chains(ways.items()) if s in (0, 3)]
    return min(ended, key=lambda w: w[:2])


def plain(rows, ids):
    out = []
    for conv in set(ids):
        mine = [r for r in rows if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        seen, turns, counts = set(), [], [0, 0, 0]
        for _, _, role, text in mine:
            bare = text.strip(WHITE)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            if fault is not None:
                counts[fault] += 1
            seen.add((role, text))
            turns.append((role, text, fault in (0, 1), fault == 2))
        numbers = [r[1] for r in mine if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [t[0][:1] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest(turns) if turns else (0, "", [])
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def codes_of(rng, n, faults):
    return "".join(
        rng.choice("suaoSUAO0123") if rng.random() < faults else "ua"[i % 2] for i in range(n)
    )


def as_turns(codes):
    names = ["system", "user", "assistant", "tool"]
    every = conversations.SOUND + conversations.DOOMED + conversations.CUT_OFF
    return [(names[every.index(c) % 4], "", 4 <= every.index(c) < 8, every.index(c) >= 8) for c in codes]


@pytest.mark.parametrize("faults", [0.1, 0.4, 1.0])
def test_search_finds_the_cheapest_and_least_edits(faults):
    rng = random.Random(int(faults * 10))
    for n in [*range(8)] * 25 + [20, 47, 48, 49, 96, 97, 250]:
        codes = codes_of(rng, n, faults)
        cost, audit, _ = cheapest(as_turns(codes))
        assert conversations.repair(codes) == (cost, audit), codes


ODD = [
    (None, None, None, None), (None, 1, "user", "x."), (1, 3, "user", "hi."), (1, 3, "user", "hi."), (1, 7, "assistant", "yes"),
    (1, 7, "assistant", " "), (2, 0, "", "a!"), (2, 1, "system", "b?  \n"), (2, None, "user", " \t"), (3, 5, "tool", None),
    (4, 9, "assistant", "word " * 200_000 + "."), (4, 10, "user", "é漢\U0001f600."), (4, 10, "user", "b."), (5, 1, None, "."),
    (6, -4, "ship", "s."), (6, 400, "user", "u."), (7, 2, "User", "Big."), (7, 3, "assistant", "."),
]


def check(spark, rows):
    # Names the operator uses for its own columns.
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = conversations.repair_report(conversations.damage(df), df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(damaged(rows), [r[0] for r in rows])


def test_odd_rows(spark):
    check(spark, ODD)


def test_long_conversations_cross_pieces_and_stretches(spark):
    rng = random.Random(5)
    rows = [(c, i, rng.choice(["user", "assistant", "system"]), f"t{rng.randrange(900)}{rng.choice('.!?xy')}") for c in (1, 2) for i in range(1500)]
    check(spark, rows + [(3, 0, "user", "a."), (3, 1, "assistant", "b.")])


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.repair_report(conversations.damage(empty), empty).count() == 0


def test_query_against_the_plain_search(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_conversation_repair"](spark, sf).collect()
    assert sorted(map(tuple, got), key=str) == plain(damaged(rows), [r[0] for r in rows])


def test_repaired_rows_are_well_formed(spark, sf):
    rows = conversations.turns(conversations.damage(spark.read.parquet(f"{sf}/conversations.parquet")))
    plans = conversations.repair_plans(rows)
    found = {}
    for r in conversations.repaired_rows(rows, plans).orderBy("name", "place").collect():
        found.setdefault(r["name"], []).append(r)
        assert r["place"] == len(found[r["name"]]) - 1 and (r["edit"] != "I" or r["text"] == "")
    assert found and all(re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in v)) for v in found.values())
