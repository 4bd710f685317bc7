"""Conversation structure repair by iterative-deepening A*.

A conversation is a list of turns whose role initials should read
``(s?(ua)+)?``. Edits put it right: Keep (0), Rerole to user or assistant (1),
Delete (2, the only edit for blank and duplicate turns), Insert an empty user or
assistant turn (5); a truncated turn that is not deleted adds 5. The search is
depth first in ASCII order of the edits' initials under a cost bound that rises
to the smallest cost that was cut off. States that failed are kept in a
transposition table with the least cost they still need, so the first path that
ends in time is the cheapest, and of equals the ASCII-least.

Turns get their places from sorted ranges, so a conversation with a third of all
rows is numbered like any other; what is searched is one character per turn, no
longer than the audit. Conversations of more than STRETCH turns are searched in
stretches, from the last to the first for each state they may begin in, then
forwards from the state they do begin in, which keeps the work linear. Texts move
once, sorted behind their conversation's audit, and are edited as they stream by.

Defined results
    null roles and texts are one space, so such texts are blank; null turns
    come first; a null id is a conversation of its own.
    Empty roles have an initial of no kind: illegal, reroled or deleted.
    Turns with one number are ordered by role and digest of the text.
    Repeated rows are duplicates but for the first. Very long texts stream whole.
    Empty table: no conversations. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textmill.llm.rows import left_lookup, ranked
from textmill.session import materialize

STRETCH = 48
PIECE = 1024
# One character per turn: row by what must happen to it, column by role initial s, u, a or another.
SOUND, DOOMED, CUT_OFF = "suao", "SUAO", "0123"
# Automaton of (s?(ua)+)?: 0 start, 1 after s, 2 after u, 3 after a; ends in 0 or 3.
KEPT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
GIVEN = [("user", 2), ("user", 2), ("assistant", 3), ("user", 2)]
LEGAL = {"su", "ua", "au"}
INSERT, DELETE, REROLE, TRUNCATED = 5, 2, 1, 5
# Inserts still needed when the turns have run out.
LACKING = [0, 2, 1, 0]
BLANK = r"\A[\x20\x09-\x0D]*\z"


# Search ------------------------------------------------------------------------


def search(codes: str, start: int, ends: list[int]) -> tuple[int, str, int]:
    """Least cost from state ``start``, its ASCII-least edits and the state they end in.

    ``ends`` is what each state still costs after the last turn.
    """
    n = len(codes)
    kinds = [(SOUND + DOOMED + CUT_OFF).index(c) for c in codes]
    at_least = [min(ends)] * (n + 1)
    for i in range(n - 1, -1, -1):
        kind = kinds[i]
        at_least[i] = at_least[i + 1] + (DELETE if kind >= 4 else REROLE if kind == 3 else 0)
    needs: dict[tuple[int, int], int] = {}
    edits: list[str] = []

    def descend(i: int, state: int, left: int) -> tuple[bool, int]:
        """Whether the rest fits into ``left``; if so the end state, if not the least it needs."""
        need = needs.get((i, state), at_least[i])
        if i == n:
            need = ends[state]
            return (True, state) if need <= left else (False, need)
        if need > left:
            return False, need
        kind, steps = kinds[i], [("D", i + 1, state, DELETE), ("I", i, GIVEN[state][1], INSERT)]
        if kind < 4 or kind >= 8:
            extra = TRUNCATED if kind >= 8 else 0
            kept = KEPT[state].get(SOUND[kind % 4])
            if kept is not None:
                steps.append(("K", i + 1, kept, extra))
            steps.append(("R", i + 1, GIVEN[state][1], REROLE + extra))
        least = None
        for edit, j, after, cost in steps:
            if cost > left:
                # Not opened: the estimate counts instead.
                rest = cost + needs.get((j, after), at_least[j])
            else:
                edits.append(edit)
                done, rest = descend(j, after, left - cost)
                if done:
                    return True, rest
                edits.pop()
                rest += cost
            least = rest if least is None else min(least, rest)
        needs[i, state] = least
        return False, least

    bound = at_least[0]
    while True:
        done, found = descend(0, start, bound)
        if done:
            return bound, "".join(edits), found
        bound = found


def repair(codes: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a whole conversation."""
    if not codes:
        return 0, ""
    lacking = [INSERT * k for k in LACKING]
    stretches = [codes[i : i + STRETCH] for i in range(0, len(codes), STRETCH)]
    ends = [lacking]
    for stretch in stretches[:0:-1]:
        ends.append([search(stretch, state, ends[-1])[0] for state in range(4)])
    state, audit, cost = 0, [], None
    for stretch, rest in zip(stretches, reversed(ends)):
        least, edits, state = search(stretch, state, rest)
        cost = least if cost is None else cost
        audit.append(edits)
    return cost, "".join(audit) + "I" * LACKING[state]


def illegal_pairs(codes: str) -> int:
    plain = codes.translate(str.maketrans(DOOMED + CUT_OFF, SOUND + SOUND))
    return sum(plain[i : i + 2] not in LEGAL for i in range(len(plain) - 1))


# Facts of turns ------------------------------------------------------------------


def conversation_name(conv: Column) -> Column:
    """A name that is never null."""
    return F.coalesce(F.concat(F.lit("."), conv.cast("string")), F.lit(""))


def turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(name, turn, role, text, digest) of all rows; nulls in role and text are one space."""
    rows = df.select(
        conversation_name(F.col(conv)).alias("name"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    return rows.withColumn("digest", F.unhex(F.substring(F.sha2("text", 256), 1, 32)))


def damage(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with faults dealt by crc32(conv_id:turn) % 20."""
    space = F.lit(" ")
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text")
    )
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("_fault", F.crc32(key) % 20).where("_fault <> 0")
    text = F.when(F.col("_fault") == 1, F.lit("")).when(F.col("_fault") == 2, F.regexp_replace("text", "[.!?]", ""))
    copies = F.when(F.col("_fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("_fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("_cut"), "text", copies.alias("_copies"), "_fault",
    ).select("conv_id", "turn", "role", F.coalesce("_cut", "text").alias("text"), F.explode("_copies").alias("_copy")).drop("_copy")


def placed_turns(rows: DataFrame) -> DataFrame:
    """(name, turn, _pos, blank, duplicate, truncated, code) of the rows of ``turns``; no text travels."""
    facts = rows.select(
        "name", "turn", "role", "digest",
        F.col("text").rlike(BLANK).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("unended"),
    )
    facts = facts.withColumn("_row", F.monotonically_increasing_id())
    placed = ranked(facts, ["name"], ["turn", "role", "digest", "_row"], "turns")
    # Most texts stand once in their conversation; only the others are looked up.
    again = placed.groupBy("name", "role", "digest").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    known = left_lookup(placed, again.drop("_n"), ["name", "role", "digest"], F.col("_pos"))
    duplicate = ~F.col("blank") & F.coalesce(F.col("_first") < F.col("_pos"), F.lit(False))
    truncated = ~F.col("blank") & ~F.col("duplicate") & F.col("unended")
    known = known.withColumn("duplicate", duplicate).withColumn("truncated", truncated)
    kind = F.when(F.col("blank") | F.col("duplicate"), 1).when(F.col("truncated"), 2).otherwise(0)
    initial = F.substring("role", 1, 1)
    column = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    code = F.substring(F.lit(SOUND + DOOMED + CUT_OFF), 1 + 4 * kind + column, F.lit(1))
    return known.select("name", "turn", "_pos", "blank", "duplicate", "truncated", code.alias("code"))


def joined(rows: DataFrame, group: list[str], place: str, value: str) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct(place, value)))
    return rows.groupBy(*group).agg(F.array_join(F.transform(ordered, lambda x: x[value]), "").alias(value))


def repair_plans(rows: DataFrame) -> DataFrame:
    """Per conversation of the rows of ``turns``: counts of faults, cost and audit."""

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Most conversations look like many others.
        known = lru_cache(maxsize=1 << 15)(lambda codes: (illegal_pairs(codes), *repair(codes)))
        for batch in batches:
            found = [known(c) for c in batch.column("code").to_pylist()]
            columns = [pa.array(c) for c in zip(*found)] if found else [pa.array([], t) for t in ("int64", "int64", "string")]
            yield pa.RecordBatch.from_arrays([batch.column("name"), *columns], ["name", "illegal", "cost", "audit"])

    placed = materialize(placed_turns(rows), "placed")
    pieces = joined(placed.withColumn("_piece", F.floor(F.col("_pos") / PIECE)), ["name", "_piece"], "_pos", "code")
    codes = joined(pieces, ["name"], "_piece", "code")
    counts = placed.groupBy("name").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    plans = codes.mapInArrow(solved, "name string, illegal long, cost long, audit string")
    return counts.join(plans, "name")


# Repaired rows ---------------------------------------------------------------------


def repaired_rows(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(name, place, edit, role, text) of all turns of repaired conversations, in order inside a partition.

    All rows of a conversation lie in one partition and stream by; none are collected.
    """
    schema = "name string, place long, edit string, role string, text string"

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, audit, at, state, place = None, "", 0, 0, 0
        out: list[tuple] = []

        def given(edit: str, text: str) -> None:
            nonlocal state, place
            role, state = GIVEN[state]
            out.append((name, place, edit, role, text))
            place += 1

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("name", "kind", "role", "text")]
            for its_name, kind, role, text in zip(*columns):
                if kind == 0:
                    name, audit, at, state, place = its_name, text, 0, 0, 0
                else:
                    edit = audit[at]
                    at += 1
                    if edit == "K":
                        out.append((name, place, edit, role, text))
                        state, place = KEPT[state][role[0]], place + 1
                    elif edit == "R":
                        given(edit, text)
                while at < len(audit) and audit[at] == "I":
                    given("I", "")
                    at += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["name", "place", "edit", "role", "text"])
                out.clear()

    heads = plans.where("audit <> ''").select("name", F.lit(0).alias("kind"), "audit")
    missing = {"turn": F.lit(None).cast(rows.schema["turn"].dataType), "role": F.lit(""), "digest": F.lit(b"")}
    heads = heads.withColumns(missing).withColumnRenamed("audit", "text")
    both = rows.withColumn("kind", F.lit(1)).unionByName(heads)
    laid = both.repartition("name").sortWithinPartitions("name", "kind", "turn", "role", "digest")
    return laid.select("name", "kind", "role", "text").mapInArrow(edited, schema)


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """(name, sha256) over the ``role:text`` lines of each conversation as ``repaired_rows`` returns them."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, running = None, None
        for batch in batches:
            done = []
            for its_name, role, text in zip(*[batch.column(c).to_pylist() for c in ("name", "role", "text")]):
                if its_name != name:
                    if running:
                        done.append((name, running.hexdigest()))
                    name, running = its_name, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["name", "sha256"])
        if running:
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([running.hexdigest()])], ["name", "sha256"])

    return repaired.mapInArrow(hashed, "name string, sha256 string")


def repair_report(rows: DataFrame, ids: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per id of ``ids``: faults of its rows, cost and audit of the repair, digest of the result."""
    told = turns(rows, conv)
    plans = materialize(repair_plans(told), "plans")
    digests = conversation_digests(repaired_rows(told, plans))
    every = ids.select(F.col(conv).alias("conv_id")).distinct().withColumn("name", conversation_name(F.col("conv_id")))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(plans, "name", "left").join(digests, "name", "left").select(
        "conv_id", *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
